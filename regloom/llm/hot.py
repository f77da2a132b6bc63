"""Joining a small table of values per key to rows of which one key may hold a large share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of all rows is hot; there are fewer than 1/SHARE of them.
SHARE = 1 / 64


def join_values(rows: DataFrame, values: DataFrame, key: str, count: str) -> DataFrame:
    """Adds the columns of ``values`` (one row for each key, null included) to the rows of its key.

    ``count`` is how many rows each key has. Fewer than 64 keys can hold more than 1/64 of all
    rows each: these are broadcast, so their rows are not moved. The others are joined plainly.
    ``key`` may be of any type that can be compared.
    """
    total = F.lit(SHARE) * (values.agg(F.sum(count)).first()[0] or 0)
    hot = values.where(F.col(count) > total)
    added = [c for c in values.columns if c not in (key, count)]

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select(F.col(key).alias("_key"), *added)
        return left.join(right, left[key].eqNullSafe(right["_key"])).drop("_key")

    flagged = hot.select(F.col(key).alias("_hot_key"), F.lit(True).alias("_hot"))
    marked = rows.join(F.broadcast(flagged), rows[key].eqNullSafe(flagged["_hot_key"]), "left").drop("_hot_key")
    cold = values.where(F.col(count) <= total)
    at_once = joined(marked.where("_hot").drop("_hot"), F.broadcast(hot))
    return at_once.unionByName(joined(marked.where("_hot is null").drop("_hot"), cold))
