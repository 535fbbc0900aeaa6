"""Hard negatives by threshold joins with bounds on what is left of a product.

A block of rows is an inverted index: per group of dimensions the rows that have entries
there. The dimensions are ordered by the anchors' weight, so the length of the rest of a vector
falls fast, and the dimensions in which the rest alone can't reach the threshold with any
anchor are left out of the index. A join adds up partial scores list by list, drops rows whose
partial score plus the product of both remaining lengths stays below the threshold, and
multiplies out only the pairs that are left. The threshold starts near the top of what an
anchor asks for and is lowered until each of its windows is full or has no scores left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.llm.vectors import matrix, usable
from gridledger.session import Workspace

#: Anchors that one task holds, rows it indexes at a time, anchors that join together.
BLOCK_ANCHORS, BLOCK_ROWS, ABREAST = 16_384, 4096, 64
#: Rows of one lane on small tables, lanes that a block of anchors meets the rows in at most
#: (a lane then streams more rows), and shuffle partitions at most (a task then has several lanes).
LANE_ROWS, LANES, PARTITIONS = 8192, 256, 50_000
#: Dimensions of one list group, and how far down a window the thresholds go before its end.
CHUNK, LOWER = 8, (0.1, 0.4)
_OPEN = np.iinfo(np.int64).max


class Index:
    """Inverted lists of one block of rows, for anchors whose dimensions are ordered alike."""

    def __init__(self, rows: np.ndarray, order: np.ndarray):
        self.whole, self.values = rows, rows[:, order].astype(np.float64)
        self.rest = rest_lengths(self.values)

    def reach(self, anchors: np.ndarray, rest: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (anchor, row) whose score may be ``least[anchor]`` or more; no other pair reaches it."""
        length = rest[:, 0]
        slack = 1e-9 * (1 + length[:, None] * self.rest[:, 0].max(initial=0))
        least = least[:, None] - slack
        # Boundaries at which a row's rest still matters to some anchor; the entries behind aren't indexed.
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.nanmin(np.where(length > 0, least[:, 0] / length, np.where(least[:, 0] <= 0, -np.inf, np.inf)))
        listed = (self.rest[:, :-1] >= ratio).sum(axis=1)
        place = np.argsort(-listed, kind="stable")
        listed, values = listed[place], self.values[place]
        partial = np.zeros((len(anchors), len(place)))
        for c in range(rest.shape[1]):
            # Rows are sorted by the length of their lists: those that end here come last.
            n = int(np.searchsorted(-listed, -c, side="left"))
            if n < len(place):
                a, r = np.nonzero(partial[:, n:] + rest[:, c][:, None] * self.rest[place[n:], c][None, :] >= least)
                if len(a):
                    yield a, place[n + r]
                place, listed, values, partial = place[:n], listed[:n], values[:n], partial[:, :n]
            if not n or c == rest.shape[1] - 1:
                break
            part = slice(c * CHUNK, (c + 1) * CHUNK)
            partial = partial + anchors[:, part] @ values[:, part].T
            able = (partial + rest[:, c + 1][:, None] * self.rest[place, c + 1][None, :] >= least).any(axis=0)
            if not able.all():
                place, listed, values, partial = place[able], listed[able], values[able], partial[:, able]


def rest_lengths(values: np.ndarray) -> np.ndarray:
    """Length of what a vector has from each group of dimensions on; the last column is zero."""
    squares = values**2
    sums = np.add.reduceat(squares, np.arange(0, values.shape[1], CHUNK), axis=1) if values.shape[1] else np.zeros((len(values), 0))
    rest = np.cumsum(sums[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([rest, np.zeros((len(values), 1))], axis=1))


class Meeting:
    """Anchors of one block, their windows, and the best rows that the windows have so far."""

    def __init__(self, k: int, same: bool):
        self.k, self.same, self.parts = k, same, []

    def add(self, rows: pa.RecordBatch) -> None:
        self.parts.append(rows)

    def _ready(self, width: int) -> None:
        held = pa.Table.from_batches(self.parts)
        self.row, self.label = held["row"].to_numpy(), held["label"].to_numpy(zero_copy_only=False)
        self.whole = matrix(held["whole"], width)
        self.order = np.argsort(-(self.whole.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.values = self.whole[:, self.order].astype(np.float64)
        self.rest = rest_lengths(self.values)
        #: Per anchor its windows (lowest and highest score asked for) and what each holds.
        self.windows = held["windows"].to_pylist()
        self.best = [[(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in w] for w in self.windows]

    def meet(self, rows: pa.RecordBatch, width: int) -> None:
        if not hasattr(self, "row"):
            self._ready(width)
        whole, ids = matrix(rows["whole"], width), rows["id"].to_numpy()
        number, label = rows["row"].to_numpy(), rows["label"].to_numpy(zero_copy_only=False)
        top = max(1, width) * int(np.abs(whole).max(initial=0)) * int(np.abs(self.whole).max(initial=0))
        if top * 100 >= 1 << 63:
            raise ArithmeticError("a multiple of a score of these vectors may not fit a long")
        for i in range(0, len(whole), BLOCK_ROWS):
            s = slice(i, i + BLOCK_ROWS)
            self._block(whole[s], ids[s], number[s], label[s])

    def _block(self, whole, ids, number, label) -> None:
        if self.same:
            # Only rows of the anchor's own label matter.
            for one in np.unique(label):
                mine = np.flatnonzero(self.label == one)
                theirs = np.flatnonzero(label == one)
                if len(mine):
                    self._lower(mine, whole[theirs], ids[theirs], number[theirs], label[theirs])
        else:
            self._lower(np.arange(len(self.row)), whole, ids, number, label)

    def _start(self, a: int, longest: float, level: int) -> float:
        """The threshold of an anchor on a level: the least of its windows'."""
        least = np.inf
        top = float(self.rest[a, 0]) * longest
        for w, (scores, _) in zip(self.windows[a], self.best[a], strict=True):
            if w["low"] > w["high"]:
                continue
            high = min(w["high"], top)
            low = float(w["low"]) if w["low"] > -_OPEN else -top - 1
            at = max(low, high - (high - low) * LOWER[level]) if level < len(LOWER) else low
            least = min(least, float(scores[-1]) if len(scores) == self.k else at)
        return least

    def _lower(self, anchors, whole, ids, number, label) -> None:
        """Join the anchors with a block of rows, at falling thresholds while a window wants rows."""
        index = Index(whole, self.order)
        longest = float(index.rest[:, 0].max(initial=0))
        for level in range(len(LOWER) + 1):
            least = np.array([self._start(a, longest, level) for a in anchors])
            # What no row of this block can reach is settled.
            open_ = least <= self.rest[anchors, 0] * longest * (1 + 1e-9) + 1e-6
            anchors, least = anchors[open_], least[open_]
            if not len(anchors):
                return
            with np.errstate(divide="ignore", invalid="ignore"):
                alike = np.argsort(least / self.rest[anchors, 0], kind="stable")
            left = []
            for i in range(0, len(alike), ABREAST):
                at = alike[i : i + ABREAST]
                left += self._join(index, anchors[at], least[at], ids, number, label, level == len(LOWER))
            anchors = np.array(left, np.int64)
            if not len(anchors):
                return

    def _join(self, index, anchors, least, ids, number, label, last) -> list[int]:
        """Take what scores the threshold; return the anchors that still want rows below it."""
        pairs = list(index.reach(self.values[anchors], self.rest[anchors], least))
        a = np.concatenate([p[0] for p in pairs]) if pairs else np.empty(0, np.int64)
        r = np.concatenate([p[1] for p in pairs]) if pairs else np.empty(0, np.int64)
        fits = (label[r] == self.label[anchors[a]]) == self.same
        fits &= number[r] != self.row[anchors[a]]
        a, r = a[fits], r[fits]
        score = np.empty(len(a), np.int64)
        for i in range(0, len(a), 1 << 16):
            s = slice(i, i + (1 << 16))
            score[s] = np.einsum("ij,ij->i", self.whole[anchors[a[s]]], index.whole[r[s]])
        take = score >= least[a]
        a, r, score = a[take], r[take], score[take]
        order = np.lexsort((ids[r], -score, a))
        a, found_ids, score = a[order], ids[r[order]], score[order]
        bounds = np.searchsorted(a, np.arange(len(anchors) + 1))
        wanting = []
        for i, anchor in enumerate(anchors):
            s = slice(bounds[i], bounds[i + 1])
            new, full = [], True
            for w, (scores, who) in zip(self.windows[anchor], self.best[anchor], strict=True):
                inside = (score[s] >= w["low"]) & (score[s] <= w["high"])
                both = np.concatenate([scores, score[s][inside]]), np.concatenate([who, found_ids[s][inside]])
                first = np.lexsort((both[1], -both[0]))[: self.k]
                new.append((both[0][first], both[1][first]))
                # Below the threshold nothing was looked at: the window is done if k rows are above it.
                kth = both[0][first[-1]] if len(first) == self.k else -_OPEN
                full &= kth >= least[i] or least[i] <= w["low"] or w["low"] > w["high"]
            if full or last:
                self.best[anchor] = new
            else:
                wanting.append(int(anchor))
        return wanting

    def result(self) -> pa.RecordBatch | None:
        if not hasattr(self, "row"):
            return None
        out = [
            (self.row[a], w, scores, who)
            for a, held in enumerate(self.best) for w, (scores, who) in enumerate(held) if len(scores)
        ]
        if not out:
            return None
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.full(len(o[2]), o[0], np.int64) for o in out])),
            pa.array(np.concatenate([np.full(len(o[2]), o[1], np.int32) for o in out])),
            pa.array(np.concatenate([o[3] for o in out]).astype(np.int64)),
            pa.array(np.concatenate([o[2] for o in out]).astype(np.int64)),
        ], ["anchor", "place", "id", "score"])


def _meetings(k: int, same: bool):
    """Streams sorted rows: the anchors of a key, then the rows that they meet."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, meeting = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("width", "block", "lane", "kind")], axis=1)
            edges = np.r_[0, np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1, len(keys)] if len(keys) else [0]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                now, part = tuple(keys[i][:3]), batch.slice(int(i), int(j - i))
                if now != key:
                    if meeting is not None and (out := meeting.result()) is not None:
                        yield out
                    key, meeting = now, Meeting(k, same)
                if keys[i][3] == 0:
                    meeting.add(part)
                elif meeting.parts:
                    meeting.meet(part, int(keys[i][0]))
        if meeting is not None and (out := meeting.result()) is not None:
            yield out

    return each


def _search(anchors: DataFrame, rows: DataFrame, blocks: int, lanes: int, k: int, same: bool) -> DataFrame:
    """The k best rows of each window of each anchor: ``anchor``, ``place`` (of the window), ``id``, ``score``."""
    key = ["width", "block", "lane", "kind"]
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = lambda count: F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    asked = anchors.withColumns({"kind": F.lit(0), "block": dealt(blocks)}).withColumn("lane", every(lanes))
    none = F.lit(None).cast(anchors.schema["windows"].dataType)
    held = rows.withColumns({"kind": F.lit(1), "lane": dealt(lanes), "windows": none}).withColumn("block", every(blocks))
    columns = [*key, "row", "id", "label", "whole", "windows"]
    met = asked.select(*columns).unionByName(held.select(*columns))
    met = met.repartition(min(PARTITIONS, blocks * lanes), *key[:3]).sortWithinPartitions(*key, "row")
    found = met.mapInArrow(_meetings(k, same), "anchor long, place int, id long, score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
    block_anchors: int = BLOCK_ANCHORS, lane_rows: int = LANE_ROWS, space: Workspace | None = None,
) -> DataFrame:
    """For each anchor and each of its positives the hardest negatives in a window of scores.

    Components become ``floor(scale * x)`` in double precision; a score is the integer inner
    product with the anchor. ``is_anchor`` tells by ``id_col`` which rows are anchors. Positives
    are the anchor's first ``positives`` other rows of its label, negatives the first
    ``negatives`` rows of other labels with ``low * p <= 100 * score <= high * p``, p being
    the positive's score; first means of higher score, then of smaller id. Columns:
    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score``. A pair whose window is empty has no row.

    Rows take no part if their id or label is null, or their vector is null or holds a null,
    NaN or infinite component. Vectors meet those of the same length only; an empty vector scores 0
    with its like. Rows that repeat an id are rows of their own: each may be an anchor, a
    positive (of another row with that id too) and a negative. Scores a hundredth of which may
    not fit a long raise. Other columns aren't read. No rows give no rows.

    A task holds one block of anchors and streams the rows of one lane past it, so its memory is
    bounded by ``block_anchors`` and by what a window holds. A row is sent once for every
    block of anchors; ``LANES`` bounds how many partial windows come back for an anchor.
    """
    space = space or Workspace(vectors.sparkSession)
    whole = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale))
    fits = usable(F.col(vector_col)) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    # The number is of a written row, so it stays the same when a task runs again.
    rows = space.stage(
        vectors.where(fits).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
            F.col(label_col).cast("string").alias("label"), whole.alias("whole"), F.size(vector_col).alias("width"),
            F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        ),
        "rows",
    )
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    blocks = max(1, -(-asking // block_anchors))
    lanes = min(LANES, max(1, -(-n // lane_rows)))
    window = F.struct(F.lit(-_OPEN).alias("low"), F.lit(_OPEN).alias("high"))
    anchors = rows.where("asks").drop("asks")
    rows = rows.drop("asks")
    found = _search(anchors.withColumn("windows", F.array(window)), rows, blocks, lanes, positives, True)
    near = space.stage(
        found.select("anchor", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    # Whole bounds of the window; a negative positive score leaves none.
    least = F.expr(f"(positive_score * {low} + pmod(-positive_score * {low}, 100)) div 100")
    most = F.expr(f"(positive_score * {high} - pmod(positive_score * {high}, 100)) div 100")
    asked = near.withColumns({"low": least, "high": most}).groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("windows")  # at most ``positives``
    )
    asked = asked.withColumn("windows", F.transform("windows", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"))))
    hard = _search(anchors.join(asked, F.col("row") == F.col("anchor")).drop("anchor"), rows, blocks, lanes, negatives, False)
    named = near.join(rows.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return hard.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
