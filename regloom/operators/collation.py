"""Keys compared under a collation, while rows keep the spelling they came with.

A key is compared by a folded form, kept as a column of its own. Joins, collapse and buckets
use that column like any other key, so every sink takes a collated table as it is. Of a key's
spellings the table holds the first one, or the last one on request.
"""

from __future__ import annotations

import unicodedata
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.operators.upsert import Upsert

COLLATIONS = ("ci", "ci_ai")


def _accented() -> tuple[str, str]:
    """Lower-case Latin letters that are an ASCII letter with marks, and those letters."""
    pairs = []
    for c in map(chr, (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))):
        base = unicodedata.normalize("NFD", c)[0]
        if c == c.lower() and base != c and base.isascii():
            pairs.append((c, base))
    return "".join(c for c, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accented()
#: Marks that follow their letter; they have no counterpart and vanish.
MARKS = "".join(map(chr, range(0x300, 0x370)))


def folded(column: Column, collation: str) -> Column:
    """The form that is equal for all spellings a collation holds equal; null stays null.

    ``ci`` ignores case, ``ci_ai`` also the accents of Latin letters. Both ignore spaces at the end.
    """
    if collation not in COLLATIONS:
        raise ValueError(f"unknown collation {collation!r}, known are {', '.join(COLLATIONS)}")
    lowered = F.lower(F.rtrim(column))
    return lowered if collation == "ci" else F.translate(lowered, ACCENTED + MARKS, PLAIN)


def folded_name(key: str) -> str:
    return f"{key}_folded"


def collated(spec: Upsert, spelling: str = "first") -> Upsert:
    """The upsert by folded keys; the keys become columns that hold the first or the last spelling."""
    if spelling not in ("first", "last"):
        raise ValueError(f"spelling is first or last, not {spelling!r}")
    names = {folded_name(k): folded_name(k) for k in spec.keys}
    update = {c: s for c, s in spec.update.items() if c not in spec.keys}
    if spelling == "last":
        update |= {k: spec.insert[k] for k in spec.keys}
    return replace(spec, keys=tuple(names), insert={**names, **spec.insert}, update=update)


def with_folded_keys(source: DataFrame, spec: Upsert, collation: str) -> DataFrame:
    """Source rows with the folded keys that ``collated(spec)`` reads."""
    return source.withColumns({folded_name(k): folded(F.col(spec.insert[k]), collation) for k in spec.keys})


def join_collated(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, collation: str
) -> DataFrame:
    """Inner join of facts to a dimension whose codes are equal under a collation; both spellings stay."""
    same = folded(facts[fact_key], collation) == folded(dimension[dimension_key], collation)
    return facts.join(dimension, same, "inner")
