"""Row updates as joins and projections.

A plain Spark table takes no MERGE, UPDATE or DELETE, and needs none: an update
from a source is a left join to that source plus one projection. ``attach`` does
the join and ``assign`` the projection, so a chain of updates that share a key
can attach all sources first (one shuffle of the wide side) and assign later.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Keys = Sequence[str] | Mapping[str, "Column | str"]


def _pairs(on: Keys) -> dict[str, Column]:
    """Source key column -> target key expression."""
    items = on.items() if isinstance(on, Mapping) else ((k, k) for k in on)
    return {k: F.col(v) if isinstance(v, str) else v for k, v in items}


def _expr(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _again(target: DataFrame, side: DataFrame, keys: Mapping[str, Column]) -> Column | None:
    """A second condition that follows from an equal key of one type on both sides.

    It asks both inputs for a partitioning neither has yet, so both come as fresh
    exchanges: only then can adaptive execution split the partitions that it
    measures as skewed.
    """
    for k, v in keys.items():
        if target.select(v).schema[0].dataType == side.schema[k].dataType:
            return F.xxhash64(v) == F.xxhash64(F.col(k))
    return None


def _prefixed(source: DataFrame, as_: str) -> DataFrame:
    return source.select(*[F.col(c).alias(f"{as_}__{c}") for c in source.columns])


def _joined(target, source, as_, keys, extra, split):
    """Left join on ``target expression = {as_}__key``; plain key columns keep their partitioning."""
    return _join_prefixed(target, _prefixed(source, as_), {f"{as_}__{k}": v for k, v in keys.items()}, extra, split)


def _join_prefixed(target, side, keys, extra, split):
    conds = [v == F.col(k) for k, v in keys.items()]
    again = _again(target, side, keys) if split else None
    conds += [c for c in (again, extra) if c is not None]
    return target.join(side, reduce(lambda a, b: a & b, conds), "left")


def _one_each(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per non-null key, and ``_many`` where the source has several.

    One aggregate, combined before the shuffle, so copies of a key never meet in one sorted
    group. With numbers and dates as values it is a hash aggregate; texts make Spark sort.
    Values of a repeated key are of no use, since an update that reads them raises.
    """
    usable = source.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    values = [F.first(c).alias(c) for c in source.columns if c not in keys]
    return usable.groupBy(*keys).agg(*values, (F.count(F.lit(1)) > 1).alias("_many"))


def matched(as_: str, when: Column | str | None = None) -> Column:
    """True where a row has a match in an attached source and ``when`` holds.

    Raises where several source rows match such a row, as an ambiguous update does;
    rows that ``when`` leaves out may match as many as they like. ``when`` reads the
    target: a condition on the source alone belongs in a filter of the source.
    """
    hit = F.col(f"{as_}__hit")
    cond = hit if when is None else hit & _expr(when)
    error = F.raise_error(F.lit(f"several rows of '{as_}' match one target row")).cast("boolean")
    return F.when(cond, F.when(F.col(f"{as_}__many"), error).otherwise(F.lit(True))).otherwise(F.lit(False))


def attach(
    target: DataFrame, source: DataFrame, on: Keys, as_: str, split: bool = False, packed: bool = False
) -> DataFrame:
    """Left-join ``source`` as columns ``{as_}__*`` plus the flags ``{as_}__hit`` and ``{as_}__many``.

    A target row stays one row; whether several source rows match it shows in the
    second flag, and ``matched`` raises on it. Null keys match nothing. Use ``split``
    for keys shared by many target rows: adaptive execution then splits the
    partitions that it measures as too large. With ``packed`` the columns wait in one
    struct named ``as_`` until ``unpack``.
    """
    if packed:
        return attach_all(target, {as_: source}, _pairs(on), split, packed)
    keys = _pairs(on)
    out = _joined(target, _one_each(source, list(keys)), as_, keys, None, split)
    return _flagged(out, as_)


def _flagged(df: DataFrame, as_: str) -> DataFrame:
    many = F.col(f"{as_}___many")
    return df.withColumns(
        {f"{as_}__hit": many.isNotNull(), f"{as_}__many": F.coalesce(many, F.lit(False))}
    ).drop(f"{as_}___many")


def attach_all(
    target: DataFrame,
    sources: Mapping[str, DataFrame],
    on: Mapping[str, "Column | str"],
    split: bool = False,
    packed: bool = False,
) -> DataFrame:
    """``attach`` several sources that share a key with one join of the target.

    The sources, each already grouped by the key for its duplicate count, are joined
    to one another first, so the wide target is shuffled once for all of them.
    With ``packed`` a source is one struct until ``unpack``: every join of a wide row
    copies it column by column, but a struct in one piece.
    """
    if not sources:
        return target
    keys = _pairs(on)
    side = None
    for as_, source in sources.items():
        one = _one_each(source, list(keys))
        values = [c for c in one.columns if c not in keys]
        held = [F.struct(*values, F.lit(True).alias("_hit")).alias(as_)] if packed else [F.col(c).alias(f"{as_}__{c}") for c in values]
        part = one.select(*[F.col(k).alias(f"_q_{k}") for k in keys], *held)
        side = part if side is None else side.join(part, [f"_q_{k}" for k in keys], "full")
    out = _join_prefixed(target, side, {f"_q_{k}": v for k, v in keys.items()}, None, split)
    out = out.drop(*[f"_q_{k}" for k in keys])
    return out if packed else reduce(_flagged, sources, out)


def unpack(df: DataFrame, *names: str) -> DataFrame:
    """The structs of packed sources as the columns and flags that ``attach`` adds; flags are null without a match.

    Names that ``df`` lacks are left out. All columns are plain fields, so the projection
    merges with the one that reads them.
    """
    held = [n for n in names if n in df.columns]
    fields = [F.col(n)[c].alias(f"{n}__{c.removeprefix('_')}") for n in held for c in df.schema[n].dataType.names]
    return df.select(*[c for c in df.columns if c not in held], *fields)


def detach(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns of attached sources."""
    return df.drop(*[c for c in df.columns if any(c.startswith(f"{n}__") for n in names)])


def assign(df: DataFrame, set: Mapping[str, Column | str], when: Column | str | None = None) -> DataFrame:
    """Simultaneous update: every right-hand side reads the row as it was.

    Existing columns keep their type. Rows where ``when`` is not true stay as they are.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cond = None if when is None else _expr(when)
    values = {}
    for name, value in set.items():
        new = _expr(value)
        if name in types:
            new = new.cast(types[name])
        if cond is not None:
            new = F.when(cond, new).otherwise(F.col(name) if name in types else F.lit(None))
        values[name] = new
    return df.withColumns(values)


def update_where(df: DataFrame, when: Column | str, set: Mapping[str, Column | str]) -> DataFrame:
    """Row-local conditional update."""
    return assign(df, set, when)


def merge_update(
    target: DataFrame,
    source: DataFrame,
    on: Keys,
    set: Mapping[str, Column | str],
    when: Column | str | None = None,
    as_: str = "s",
    split: bool = False,
) -> DataFrame:
    """Update matched target rows; expressions name source columns ``{as_}__x``.

    ``when`` is an extra condition; only rows that pass it must match one source row.
    The row count never changes.
    """
    return detach(assign(attach(target, source, on, as_, split), set, matched(as_, when)), as_)


def overlay(
    target: DataFrame,
    source: DataFrame,
    on: Keys,
    columns: Sequence[str] | Mapping[str, str],
    prefer: str = "source",
    as_: str = "s",
    split: bool = False,
) -> DataFrame:
    """Take the preferred side's value where it has one, else the other's."""
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    pick = {
        t: F.coalesce(*((f"{as_}__{s}", t) if prefer == "source" else (t, f"{as_}__{s}")))
        for t, s in names.items()
    }
    return merge_update(target, source, on, pick, as_=as_, split=split)


def delete_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Remove rows whose (non-null) key is in ``keys``."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def keep_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep rows whose (non-null) key is in ``keys``."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def null_column(dtype: T.DataType | str) -> Column:
    return F.lit(None).cast(dtype)
