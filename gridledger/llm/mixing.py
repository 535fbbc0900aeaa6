"""Mixing sources to target weights by Pfair scheduling.

Each source's rows form blocks of equal size. With weight a/q of the slots, a source's block j
is released at slot floor(j q / a) and due by slot ceil((j + 1) q / a); the released block of
earliest deadline takes the slot. Every source then always has its share of the slots so far,
less than one block more or less. Weights are fractions, never rounded. When a source runs out
the rest go on by their weights from that slot on.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridledger.session import Workspace

#: Rows of a block, rows of a source that are numbered together.
BLOCK_ROWS, RUN_ROWS = 64, 4096


def takers(weights: Mapping[int, int]) -> Iterator[int]:
    """The source that takes each slot, without end, by earliest deadline among released blocks."""
    q = sum(weights.values())
    waiting = [(0, s, 0) for s in sorted(weights)]
    ready: list[tuple[int, int, int]] = []
    for slot in itertools.count():
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * q // weights[s]), s, j))
        due, s, j = heapq.heappop(ready)
        assert slot < due
        yield s
        heapq.heappush(waiting, ((j + 1) * q // weights[s], s, j + 1))


def schedule(blocks: Mapping[int, int], weights: Mapping[int, int]) -> Iterator[tuple[int, int]]:
    """Source and block of each slot.

    A phase lasts until a source runs out. Sources of weight 0 follow in phases of equal weights.
    """
    left, done = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0)
    while left:
        for s in takers({s: weights[s] for s in left if weights[s]} or dict.fromkeys(left, 1)):
            yield s, done[s]
            done[s] += 1
            if done[s] == left[s]:
                del left[s]
                break


def period(weights: Mapping[int, int]) -> list[int]:
    """The sources that take the slots of one period, by earliest deadline among released blocks."""
    return list(itertools.islice(takers(weights), sum(weights.values())))


def phases(blocks: Mapping[int, int], weights: Mapping[int, int]) -> list[tuple[int, ...]]:
    """For each phase and slot of its period a row: phase, source, its first and last block (exclusive)
    in the phase, the phase's first slot, its weight, its period, its block in the period, and slot.

    The schedule in short, for weights of a small sum; ``mix_sources`` doesn't use it. A phase
    lasts until a source runs out. Sources of weight 0 follow in phases of equal weights.
    """
    left = {s: n for s, n in blocks.items() if n}
    phase, start, rows = 0, 0, []
    while left:
        share = {s: weights[s] for s in left if weights[s]} or {s: 1 for s in left}
        slots, q = period(share), sum(share.values())
        at: dict[int, list[int]] = {s: [] for s in share}
        for slot, s in enumerate(slots):
            at[s].append(slot)
        last = lambda s: (left[s] - 1) // share[s] * q + at[s][(left[s] - 1) % share[s]]
        length = min(map(last, share)) + 1
        for s, own in at.items():
            whole, rest = divmod(length, q)
            taken = whole * share[s] + sum(x < rest for x in own)
            done = blocks[s] - left[s]
            rows += [(phase, s, done, done + taken, start, share[s], q, i, slot) for i, slot in enumerate(own)]
            left[s] -= taken
        phase, start = phase + 1, start + length
        left = {s: n for s, n in left.items() if n}
    return rows


def whole_weights(target: Mapping, sizes: Mapping, power: float = 0.5) -> dict:
    """Whole weights for all sources in exactly the proportion of the targets, or of each size to ``power``.

    A source without a target has weight 0.
    """
    raw = {s: Fraction(target.get(s, 0)) for s in sizes} if target else {s: Fraction(n**power) for s, n in sizes.items()}
    if any(w < 0 for w in raw.values()):
        raise ValueError("weights can't be negative")
    unit = math.lcm(*(w.denominator for w in raw.values()))
    return {s: int(w * unit) for s, w in raw.items()}


def mix_sources(
    docs: DataFrame, target: Mapping[str | None, float] | None = None, *, source_col: str = "source", id_col: str = "doc_id",
    block_rows: int = BLOCK_ROWS, run_rows: int = RUN_ROWS, space: Workspace | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``mix_block``, ``mix_slot`` and ``mix_place``.

    ``mix_block`` numbers a source's blocks, ``mix_slot`` is the slot the block takes, no two
    blocks the same, and ``mix_place`` the row's place in its block. Ordered by slot and place
    every source has, at every slot, its weight's part of the slots so far to within one block,
    as long as no source has run out; from then on the rest share by their weights from that
    slot on. Every row is kept and none is repeated.

    ``target`` maps sources to weights, taken exactly; without it a source weighs the square
    root of its rows. Sources without a target come last. A null source is a source of its
    own. Rows are ordered in a source by a hash of id and all columns that can be compared, so
    rows that repeat fall next to one another. Columns with one of the new names are replaced.
    No rows give no rows.

    The hottest source isn't numbered in one task: it is cut into runs by hash, rows are
    numbered within a run, and the runs' counts are summed up. What the driver sees is one
    count a source. One task writes the schedule, a row for each block, and holds only one
    block a source; each run gets the slots of its blocks, so rows meet the schedule in the
    join that brings them their run's count. A phase costs the task a step for each source left.
    """
    spark, space = docs.sparkSession, space or Workspace(docs.sparkSession)
    new = ("mix_block", "mix_slot", "mix_place")
    docs = docs.select(*(c for c in docs.columns if c not in new))
    # Flat columns, so that those nobody reads later are left out of the exchange.
    flat = [F.col(c).alias(f"row{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*flat, F.col(source_col).cast("string").alias("source"), F.xxhash64(
        id_col, *(c for c, t in docs.dtypes if c != id_col and not t.startswith(("map", "variant")))).alias("mixed"))
    sizes = {r.source: r["count"] for r in rows.groupBy("source").count().collect()}
    if not sizes:
        return docs.selectExpr("*", *(f"cast(null as bigint) AS {c}" for c in new))
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(ordered)}
    weights = whole_weights(target or {}, sizes)
    table = spark.createDataFrame(
        [(s, number[s], -(-sizes[s] // run_rows)) for s in ordered], "source string, number int, runs int")
    # One row a source.
    placed = rows.join(F.broadcast(table), rows.source.eqNullSafe(table.source)).drop("source")
    placed = placed.withColumn("run", F.pmod("mixed", "runs").cast("int"))
    counts = placed.groupBy("number", "run").count()
    before = F.sum("count").over(Window.partitionBy("number").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    held = F.sequence(F.floor(F.col("before") / block_rows), F.floor((F.col("before") + F.col("count") - 1) / block_rows))

    blocks, shares = {number[s]: -(-n // block_rows) for s, n in sizes.items()}, {number[s]: weights[s] for s in sizes}

    def each(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = ((s, j, slot) for slot, (s, j) in enumerate(schedule(blocks, shares)))
        while rows := list(itertools.islice(slots, 65_536)):
            columns = zip(*rows, strict=True)
            types = [pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["number", "block", "slot"])

    slots = space.stage(spark.range(0, 1, 1, 1).mapInArrow(each, "number int, block long, slot long"), "slots")
    runs = counts.select("number", "run", "before", F.explode(held).alias("block")).join(slots, ["number", "block"])
    runs = runs.groupBy("number", "run", "before").agg(
        F.min("block").alias("first"), F.array_sort(F.collect_list("slot")).alias("slots"))  # slots grow with blocks
    runs = space.stage(runs, "runs")

    within = F.row_number().over(Window.partitionBy("number", "run").orderBy("mixed"))
    ranked = placed.withColumn("within", within - 1).join(runs, ["number", "run"])
    rank = F.col("before") + F.col("within")
    ranked = ranked.withColumns({"block": F.floor(rank / block_rows), "place": rank % block_rows})
    slot = F.get("slots", (F.col("block") - F.col("first")).cast("int"))
    return ranked.select(
        *(F.col(f"row{i}").alias(c) for i, c in enumerate(docs.columns)), F.col("block").cast("long").alias("mix_block"),
        slot.alias("mix_slot"), F.col("place").cast("long").alias("mix_place"))
