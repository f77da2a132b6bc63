"""Chat formatting: render conversations to one text and prove it by parsing it back.

A turn is ``open body close`` with one space on either side of the body:

    system      <<SYS>> body <</SYS>>
    user        [INST] body [/INST]
    assistant   <s> body </s>
    any other   [ROLE 6162] body [/ROLE]      (the role's UTF-8 in hexadecimal; - for null)

A text may hold any of these control strings. First every turn is rendered as it is and the
result is parsed; where the turns that come back differ from the source, the conversation is
rendered again with its conflicting texts escaped and must then come back unchanged. The
escape is a backslash before a control string, behind any that stand there already; the
parser takes one away. Texts without control strings are never changed.

Defined results: a null text is empty, null roles and null conversation ids are values of
their own. Turns are in the order of ``turn`` (null first), then role and text, so repeated
rows have one order. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN = r"<<SYS>>|\[INST\]|<s>|\[ROLE (?:-|[0-9A-F]*)\]"
CLOSE = r"<</SYS>>|\[/INST\]|</s>|\[/ROLE\]"
CONTROL = f"{OPEN}|{CLOSE}"


def _open(role: Column) -> Column:
    other = F.concat(F.lit("[ROLE "), F.coalesce(F.hex(F.encode(role, "UTF-8")), F.lit("-")), F.lit("]"))
    return F.when(role == "system", "<<SYS>>").when(role == "user", "[INST]").when(role == "assistant", "<s>").otherwise(other)


def _close(role: Column) -> Column:
    return F.when(role == "system", "<</SYS>>").when(role == "user", "[/INST]").when(role == "assistant", "</s>").otherwise("[/ROLE]")


# A run of backslashes is tried from its beginning only, and never given back.


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(rf"(?<!\\)(\\*+)({CONTROL})"), F.lit(r"$1\\$2"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(rf"(?<!\\)\\(\\*+)({CONTROL})"), F.lit("$1$2"))


def render(turns: Column, escaped: bool) -> Column:
    """The text of an array of (role, text)."""

    def turn(t: Column) -> Column:
        body = escape(t["text"]) if escaped else t["text"]
        return F.concat(_open(t["role"]), F.lit(" "), body, F.lit(" "), _close(t["role"]))

    return F.array_join(F.transform(turns, turn), "")


def parse(rendered: Column) -> Column:
    """The turns of a rendered text as an array of (role, text)."""
    whole = F.regexp_extract_all(rendered, F.lit(rf"(?s)(?<!\\)(?:{OPEN}) .*? (?<!\\)(?:{CLOSE})"), F.lit(0))

    def turn(t: Column) -> Column:
        start = F.regexp_extract(t, rf"^({OPEN})", 1)
        coded = F.regexp_extract(start, r"^\[ROLE (.*)\]$", 1)
        role = (
            F.when(start == "<<SYS>>", "system")
            .when(start == "[INST]", "user")
            .when(start == "<s>", "assistant")
            # Bytes as they are: what is no UTF-8 then equals no role.
            .when(coded != "-", F.unhex(coded).cast("string"))
        )
        # The body lies between the two markers and a space on either side.
        end = F.length(F.regexp_extract(t, rf"({CLOSE})$", 1))
        body = F.substring(t, F.length(start) + 2, F.length(t) - F.length(start) - end - 2)
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    return F.transform(whole, turn)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row for each ``conv_id``: ``formatted``, ``escaped`` (whether that was needed) and ``turns``.

    ``turns`` is what the parser reads back from ``formatted``: an array of (role, text),
    proven equal to the source. A conversation is one row of the result, so its turns meet in
    one task; nothing else does.
    """
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))))
    source = (
        conversations.groupBy("conv_id")
        .agg(ordered.alias("rows"))
        .select("conv_id", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("source"))
    )
    plain = source.withColumn("plain", render(F.col("source"), False))
    tried = plain.withColumn("escaped", ~parse(F.col("plain")).eqNullSafe(F.col("source")))
    rendered = tried.withColumn("formatted", F.when(F.col("escaped"), render(F.col("source"), True)).otherwise(F.col("plain")))
    read = rendered.withColumn("turns", parse(F.col("formatted")))
    sure = F.when(F.col("turns").eqNullSafe(F.col("source")), F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not survive the round trip")))
    return read.select("conv_id", sure.alias("formatted"), "escaped", "turns")


def loss_text(turns: Column) -> Column:
    """All text under the loss mask: the assistant's, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
