"""Code-list lookups and the join to a dimension table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.functions.codes import COMPANY_TYPES, HEADCOUNTS, NO_HEADCOUNT


def code_list(spark: SparkSession, codes: Mapping[str, str]) -> DataFrame:
    """An inline relation (code, label)."""
    rows = ", ".join(
        "('{}', '{}')".format(*(text.replace("\\", "\\\\").replace("'", "\\'") for text in item))
        for item in codes.items()
    )
    return spark.sql(f"SELECT code, label FROM VALUES {rows} AS codes(code, label)")


def _with_label(df: DataFrame, code: Column, codes: Mapping[str, str], label: str) -> DataFrame:
    # Broadcast on purpose: the list is written out in the code, a few dozen rows.
    names = code_list(df.sparkSession, codes).select(
        F.col("code").alias("_code"), F.col("label").alias(label)
    )
    return df.join(F.broadcast(names), code == F.col("_code"), "left").drop("_code")


def type_code(category: Column) -> Column:
    return F.substring(category, 1, 2)


def with_company_type(
    df: DataFrame,
    category: str = "LegalCategory",
    codes: Mapping[str, str] = COMPANY_TYPES,
) -> DataFrame:
    """Add ``company_type``; null for a code outside the list."""
    return _with_label(df, type_code(F.col(category)), codes, "company_type")


def with_employee_count(
    df: DataFrame,
    code: str = "EmployeeCountCategory",
    codes: Mapping[str, str] = HEADCOUNTS,
) -> DataFrame:
    """Add ``EmployeeCount``; ``NA`` for no code, null for one outside the list."""
    labelled = _with_label(df, F.col(code), codes, "EmployeeCount")
    return labelled.withColumn(
        "EmployeeCount", F.when(F.col(code).isNull(), NO_HEADCOUNT).otherwise(F.col("EmployeeCount"))
    )


def unknown_codes(df: DataFrame, code: Column, codes: Mapping[str, str]) -> DataFrame:
    """Rows whose code is given but not in the list, with that code as ``code``."""
    known = code_list(df.sparkSession, codes).select(F.col("code").alias("_code"))
    coded = df.withColumn("code", code).filter(F.col("code").isNotNull())
    return coded.join(F.broadcast(known), F.col("code") == F.col("_code"), "left_anti")


def join_dimension(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str
) -> DataFrame:
    """Inner join of facts to a dimension table of unknown size.

    Spark takes a broadcast when the dimension is under its size threshold, and else
    splits the partitions of hot codes at run time.
    """
    return facts.join(dimension, facts[fact_key] == dimension[dimension_key], "inner")


#: Codes the summary follows, and codes it may return: what reaches the driver and is broadcast.
TRACKED, MOST_HOT = 10_000, 1_000
#: Dimension rows of hot codes are broadcast up to so many bytes.
MOST_HOT_BYTES = 10 << 20


def hot_codes(facts: DataFrame, key: str, share: float) -> list:
    """Codes that hold at least this share of the rows with a code, by one mergeable summary.

    The summary counts a code too high by less than a thousandth of the rows, never too low, so no
    code from the share on is missed while the share is at least 1 / ``MOST_HOT``.
    """
    coded = facts.select(F.col(key).alias("code")).where("code is not null")
    found = coded.agg(
        F.expr(f"approx_top_k(code, {MOST_HOT}, {TRACKED})").alias("top"), F.count("code").alias("rows")
    ).first()
    return sorted(item for item, n in found["top"] or [] if n >= share * found["rows"])


def join_dimension_split(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    *,
    share: float | None = None,
    salts: int | None = None,
    most_bytes: int = MOST_HOT_BYTES,
) -> DataFrame:
    """The inner join of ``join_dimension``, even under hot codes and fixed plans.

    Codes with at least ``share`` of the rows (by default a quarter of an even partition) are
    joined apart, all others plainly. The dimension rows of hot codes are broadcast if
    they are few (checked: rows and bytes), so hot facts do not move; else these rows are repeated
    for each of ``salts`` parts, among which the hot facts are dealt. The result does not depend on which
    codes are held to be hot. Facts are read once more, by their key alone, and null codes leave.
    """
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1 / MOST_HOT, 0.25 / parts) if share is None else share
    hot = hot_codes(facts, fact_key, share)
    if not hot:
        return join_dimension(facts, dimension, fact_key, dimension_key)
    is_hot = facts[fact_key].isin(hot)
    few = dimension.where(dimension[dimension_key].isin(hot))
    others = dimension.where(~dimension[dimension_key].isin(hot))
    plain = join_dimension(facts.where(~is_hot), others, fact_key, dimension_key)
    size = few.limit(MOST_HOT + 1).select(F.length(F.to_json(F.struct("*"))).alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    ).first()
    if size["rows"] <= MOST_HOT and size["bytes"] <= most_bytes:
        apart = join_dimension(facts.where(is_hot), F.broadcast(few), fact_key, dimension_key)
    else:
        apart = _join_salted(facts.where(is_hot), few, fact_key, dimension_key, salts or parts)
    return plain.union(apart)


def _join_salted(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, salts: int) -> DataFrame:
    # By content and task: a task that runs again gives each row the same part, and equal rows
    # of different tasks have different ones.
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[facts[c] for c in facts.columns]), F.lit(salts)).cast("int")
    left = facts.withColumn("_salt", salt)
    right = dimension.withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same = (left[fact_key] == right[dimension_key]) & (left["_salt"] == right["_salt_of"])
    return left.join(right, same, "inner").drop("_salt", "_salt_of")
