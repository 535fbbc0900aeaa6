"""Lookup joins. Only a list of bounded length is broadcast by hint; Spark broadcasts what it measures as small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.operators.updates import Keys, _joined, _pairs

#: Rows of one key that a single join task should handle at most.
ROWS_PER_TASK = 2_000_000
#: Keys that are split at most, the largest first. Keys beyond them stay whole.
HOT_KEYS = 100_000


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    weight: str,
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Null-safe join to one row per key, splitting keys that hold too many rows.

    ``right[weight]`` is the number of left rows of the key. A key above
    ``rows_per_task`` is cut into as many parts as it needs: its left rows hash to
    a part, its right row is copied once per part. The broadcast list of such keys
    has at most ``HOT_KEYS`` entries. ``weight`` is dropped from the result.

    ``spread_by`` names columns that tell the rows of a key apart, by default all of
    them. A row's part follows from its values, so it is the same when a task is run
    again; copies of one row share a part.
    """
    parts = F.ceil(F.col(weight) / F.lit(rows_per_task)).cast("int")
    hot = right.where(F.col(weight) > rows_per_task).orderBy(F.desc(weight), *on).limit(HOT_KEYS).select(
        *[F.col(k).alias(f"_h_{k}") for k in on], parts.alias("_parts")
    )
    is_hot = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in on])
    row_hash = F.xxhash64(*(spread_by or left.columns))
    part = F.coalesce(F.pmod(row_hash, F.col("_parts")), F.lit(0)).cast("int")
    marked = left.join(F.broadcast(hot), is_hot, "left").withColumn("_part", part)
    marked = marked.drop("_parts", *[f"_h_{k}" for k in on])
    copies = F.explode(F.sequence(F.lit(0), F.greatest(parts - 1, F.lit(0))))
    side = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in on],
        *[c for c in right.columns if c not in on and c != weight],
        copies.alias("_copy"),
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on])
    out = marked.join(side, same & (F.col("_part") == F.col("_copy")), how)
    return out.drop("_part", "_copy", *[f"_r_{k}" for k in on])


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Keys,
    as_: str,
    split: bool = False,
) -> DataFrame:
    """Left join that adds the dimension as ``{as_}__*`` and keeps every match."""
    return _joined(df, dim, as_, _pairs(on), None, split)


def cascade_lookup(
    df: DataFrame,
    steps: Sequence[tuple[DataFrame, Keys, str]],
    name: str,
    first: Column | str | None = None,
    default: object | None = None,
    split: bool = False,
) -> DataFrame:
    """First non-null of: ``first``, each ``(dimension, keys, value)`` step, ``default``."""
    columns = list(df.columns)
    candidates = [] if first is None else [F.col(first) if isinstance(first, str) else first]
    out = df
    for i, (dim, on, value) in enumerate(steps):
        out = lookup(out, dim, on, f"_c{i}", split)
        candidates.append(F.col(f"_c{i}__{value}"))
    if default is not None:
        candidates.append(F.lit(default))
    out = out.withColumn(name, F.coalesce(*candidates))
    return out.select(*columns, *([] if name in columns else [name]))


def attach_either(
    df: DataFrame,
    source: DataFrame,
    exact: Sequence[str],
    wildcard: Sequence[str],
    columns: Sequence[str],
    as_: str,
) -> DataFrame:
    """Attach by row id, or by a business key for source rows that carry no id, as one packed source.

    An OR join condition would compare all pairs; two equi-joins do the same work.
    A row that matches both ways is ambiguous and raises.
    """
    from gridledger.operators.updates import attach, detach, matched, unpack

    ids = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in exact])
    no_ids = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in exact])
    out = attach(df, source.where(ids).select(*exact, *columns), list(exact), "x", packed=True)
    keyed = source.where(no_ids).select(*[F.col(c).alias(f"k_{c}") for c in wildcard], *columns)
    out = unpack(attach(out, keyed, {f"k_{c}": c for c in wildcard}, "w", split=True, packed=True), "x", "w")
    both = F.raise_error(F.lit("a row matches by id and by key")).cast("boolean")
    hit = F.when(F.col("x__hit") & F.col("w__hit"), both).otherwise(matched("x") | matched("w"))
    fields = [F.coalesce(f"x__{c}", f"w__{c}").alias(c) for c in columns]
    one = F.struct(*fields, F.lit(False).alias("_many"), F.lit(True).alias("_hit"))
    return detach(out.withColumn(as_, F.when(hit, one)), "x", "w")


def exact_or_wildcard(
    df: DataFrame,
    source: DataFrame,
    exact: Sequence[str],
    wildcard: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Overlay by row id, or by a business key for source rows that carry no id."""
    from gridledger.operators.updates import assign, detach, matched, unpack

    out = unpack(attach_either(df, source, exact, wildcard, columns, "x"), "x")
    return detach(assign(out, {c: F.coalesce(f"x__{c}", c) for c in columns}, matched("x")), "x")


def filter_pairs(df: DataFrame, group: Column | str, member: Column | str, allowed: Mapping[str, Sequence[str]]):
    """Keep rows whose (group, member) pair is on a short literal list; a pushable filter."""
    g = F.col(group) if isinstance(group, str) else group
    m = F.col(member) if isinstance(member, str) else member
    return df.where(reduce(lambda a, b: a | b, [(g == k) & m.isin(*v) for k, v in allowed.items()], F.lit(False)))


def anti_join(df: DataFrame, blocked: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows without a match; ``on`` maps blocked columns to columns of ``df``."""
    side = blocked.select(*[F.col(b).alias(f"_b_{b}") for b in on]).distinct()
    cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_b_{b}") for b, c in on.items()])
    return df.join(side, cond, "left_anti")
