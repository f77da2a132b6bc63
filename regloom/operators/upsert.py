"""Keyed upsert: insert new keys, overwrite some columns of known ones.

Rows are applied in the order of a sequence column, as if one by one. The first
row of a new key is inserted. Every later row with that key overwrites only the
update columns. Columns outside the update list keep what the first row wrote.

A key's rows combine into one *change*: how many there were, what the first would
insert and what the last would write. Changes combine again, so a hot key shrinks
in each map task before the shuffle, and batches can be collapsed when they arrive
and applied together later.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNT, FIRST, LAST = "_rows", "_first_seq", "_last_seq"


@dataclass(frozen=True)
class Constant:
    """A literal in SQL, written as it is rather than read from a source column."""

    sql: str

    @staticmethod
    def text(value: str) -> Constant:
        return Constant("'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'")


@dataclass(frozen=True)
class Upsert:
    """Which target columns an insert and an update write, and from what.

    Both map a target column to a source column name or a ``Constant``. ``complete``
    says that every source row has a whole key; plans then have no branch for others.
    """

    table: str
    keys: tuple[str, ...]
    insert: Mapping[str, str | Constant]
    update: Mapping[str, str | Constant]
    complete: bool = False

    @property
    def columns(self) -> list[str]:
        return list(self.insert)

    @property
    def written_first(self) -> dict[str, str | Constant]:
        """Columns whose inserted value differs from what an update would write."""
        return {
            c: source
            for c, source in self.insert.items()
            if c not in self.keys and self.update.get(c) != source
        }

    @property
    def written_last(self) -> dict[str, str | Constant]:
        return {c: source for c, source in self.update.items() if c not in self.keys}

    def updating_all(self) -> Upsert:
        """The same upsert with every column but the keys overwritten.

        Constants given for updates stay.
        """
        return replace(self, update={**self.insert, **_constants(self.update)})


def _constants(sources: Mapping[str, str | Constant]) -> dict[str, Constant]:
    return {c: s for c, s in sources.items() if isinstance(s, Constant)}


def _read(sources: Mapping[str, str | Constant]) -> dict[str, str]:
    return {c: s for c, s in sources.items() if isinstance(s, str)}


def _sql(source: str | Constant) -> str:
    return source.sql if isinstance(source, Constant) else source


def split_by_key(
    df: DataFrame, names: list[str], complete: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    """Rows with a complete key, and the others; None if there are none by the plan or by promise.

    A row without a complete key matches nothing. Apart from the rest, such rows
    need no shuffle and cannot pile up in one partition.
    """
    if complete or not any(df.schema[name].nullable for name in names):
        return df, None
    present = " and ".join(f"{n} is not null" for n in names)
    absent = " or ".join(f"{n} is null" for n in names)
    return df.filter(present), df.filter(absent)


def _grouped(
    df: DataFrame,
    keys: Mapping[str, str],
    count: str,
    order: tuple[str, str],
    sources: tuple[Mapping[str, str], Mapping[str, str]],
) -> DataFrame:
    """Per key: rows, first and last position, and a struct from each of the two.

    The aggregate of structs is sort-based. Rows are therefore put into shape and
    sorted by key before it, in each map task: it then handles a row's columns as one
    block, where structs made within the aggregate would be copied field by field.
    """
    first, last = (", ".join(f"{s} as {c}" for c, s in part.items()) for part in sources)
    low, high = (FIRST, LAST) if order[0] != order[1] else (FIRST, FIRST)
    shaped = [f"{source} as {key}" for key, source in keys.items()]
    shaped += [f"{source} as {name}" for name, source in {low: order[0], high: order[1]}.items()]
    shaped.append(f"{count} as {COUNT}")
    aggregates = [f"sum({COUNT}) as {COUNT}", f"min({low}) as {FIRST}", f"max({high}) as {LAST}"]
    if first:
        shaped.append(f"struct({first}) as _first")
        aggregates.append(f"min_by(_first, {low}) as _first")
    if last:
        shaped.append(f"struct({last}) as _last")
        aggregates.append(f"max_by(_last, {high}) as _last")
    ready = df.selectExpr(*shaped).sortWithinPartitions(*keys)
    return ready.groupBy(*keys).agg(*[F.expr(a) for a in aggregates])


def collapse(source: DataFrame, spec: Upsert, sequence: str) -> DataFrame:
    """One change per key, from source rows whose key is complete.

    Constants join the change after the aggregate, so they are never shuffled.
    """
    read = _read(spec.written_first), _read(spec.written_last)
    keys = {k: spec.insert[k] for k in spec.keys}
    grouped = _grouped(source, keys, "1L", (sequence, sequence), read)

    def part(sources: Mapping[str, str | Constant], row: str) -> list[str]:
        return [
            f"{s.sql if isinstance(s, Constant) else f'{row}.{c}'} as {row}_{c}"
            for c, s in sources.items()
        ]

    return grouped.selectExpr(
        *spec.keys,
        COUNT,
        FIRST,
        LAST,
        *part(spec.written_first, "_first"),
        *part(spec.written_last, "_last"),
    )


def single_changes(source: DataFrame, spec: Upsert, sequence: str) -> DataFrame:
    """Every source row as a change of its own, for rows without a complete key."""
    return source.selectExpr(
        *[f"{spec.insert[k]} as {k}" for k in spec.keys],
        f"1L as {COUNT}",
        f"{sequence} as {FIRST}",
        f"{sequence} as {LAST}",
        *[f"{_sql(s)} as _first_{c}" for c, s in spec.written_first.items()],
        *[f"{_sql(s)} as _last_{c}" for c, s in spec.written_last.items()],
    )


def combine(changes: DataFrame, spec: Upsert) -> DataFrame:
    """One change per key from the changes of several batches."""
    firsts = [f"_first_{c}" for c in spec.written_first]
    lasts = [f"_last_{c}" for c in spec.written_last]
    keys = {k: k for k in spec.keys}
    stored = {c: c for c in firsts}, {c: c for c in lasts}
    grouped = _grouped(changes, keys, COUNT, (FIRST, LAST), stored)
    return grouped.selectExpr(
        *spec.keys,
        COUNT,
        FIRST,
        LAST,
        *[f"_first.{name} as {name}" for name in firsts],
        *[f"_last.{name} as {name}" for name in lasts],
    )


def inserts(source: DataFrame, spec: Upsert) -> DataFrame:
    """Every source row as a target row of its own."""
    return source.selectExpr(*[f"{_sql(s)} as {c}" for c, s in spec.insert.items()])


def apply_changes(target: DataFrame | None, changes: DataFrame, spec: Upsert) -> DataFrame:
    """The target after the changes; ``None`` stands for an empty target.

    Both sides hold one row per key, and the changes are already partitioned by it,
    so the full outer join adds at most a shuffle of the target, and none if the
    target is bucketed by the key.
    """
    first, last = spec.written_first, spec.written_last

    def fresh(c: str) -> str:
        """Value of a key that the target lacks."""
        if c in first and c in last:
            return f"case when {COUNT} > 1 then _last_{c} else _first_{c} end"
        return f"_first_{c}" if c in first else f"_last_{c}"

    if target is None:
        return changes.selectExpr(
            *[c if c in spec.keys else f"{fresh(c)} as {c}" for c in spec.columns]
        )

    def merged(c: str) -> str:
        if c in spec.keys:
            return f"coalesce(old.{c}, new.{c})"
        if c not in last:
            return f"case when _known then old.{c} else _first_{c} end"
        if c not in first:
            return f"case when {COUNT} is null then old.{c} else _last_{c} end"
        return (
            f"case when {COUNT} is null then old.{c} when _known then _last_{c}"
            f" else {fresh(c)} end"
        )

    old = target.selectExpr(*spec.columns, "true as _known").alias("old")
    same = F.expr(" and ".join(f"old.{k} = new.{k}" for k in spec.keys))
    joined = old.join(changes.alias("new"), same, "full_outer")
    return joined.selectExpr(*[f"{merged(c)} as {c}" for c in spec.columns])


def by_event(changes: DataFrame) -> DataFrame:
    """Changes whose count says only whether a key had one row or several.

    Two rows of a key never share a position, so the two positions tell. What is left of a change
    is the least and the greatest of what was seen: taken in twice, or in another order, it is
    the same.
    """
    return changes.withColumn(COUNT, F.expr(f"case when {FIRST} = {LAST} then 1L else 2L end"))


def merge_changes(stored: DataFrame | None, changes: DataFrame, spec: Upsert) -> DataFrame:
    """Stored changes, one for each key, after later ones: earliest insert, latest update.

    Keys are complete. The stored side may be bucketed by the key; it is then not shuffled.
    Late and repeated deliveries are merged by position, not by arrival.
    """
    changes = by_event(changes)
    if stored is None:
        return changes
    firsts = [FIRST, *[f"_first_{c}" for c in spec.written_first]]
    lasts = [LAST, *[f"_last_{c}" for c in spec.written_last]]
    same = F.expr(" and ".join(f"old.{k} = new.{k}" for k in spec.keys))
    joined = stored.alias("old").join(changes.alias("new"), same, "full_outer")
    sooner = f"(old.{FIRST} is null or new.{FIRST} < old.{FIRST})"
    later = f"(old.{LAST} is null or new.{LAST} > old.{LAST})"
    return by_event(
        joined.selectExpr(
            *[f"coalesce(old.{k}, new.{k}) as {k}" for k in spec.keys],
            f"1L as {COUNT}",
            *[f"case when {sooner} then new.{c} else old.{c} end as {c}" for c in firsts],
            *[f"case when {later} then new.{c} else old.{c} end as {c}" for c in lasts],
        ).select(*changes.columns)
    )


def merge(
    target: DataFrame | None,
    changes: DataFrame,
    unkeyed: DataFrame | None,
    spec: Upsert,
) -> DataFrame:
    """Apply changes to the target and append the rows that have no key."""
    extra = [] if unkeyed is None else [unkeyed]
    if target is not None and unkeyed is not None:
        target, old_unkeyed = split_by_key(target, list(spec.keys))
        if old_unkeyed is not None:
            extra.append(old_unkeyed.select(*spec.columns))
    result = apply_changes(target, changes, spec)
    return reduce(lambda a, b: a.unionByName(b), extra, result)


def upsert(
    target: DataFrame | None, source: DataFrame, spec: Upsert, sequence: str
) -> DataFrame:
    """The target after inserting or updating every source row in order.

    ``sequence`` must be unique among rows that share a key. Source rows without a
    complete key never conflict and are appended.
    """
    keyed, loose = split_by_key(source, [spec.insert[k] for k in spec.keys], spec.complete)
    unkeyed = None if loose is None else inserts(loose, spec)
    return merge(target, collapse(keyed, spec, sequence), unkeyed, spec)
