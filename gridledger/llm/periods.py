"""Periodic runs of words, by online dyadic square catching.

Words are appended in pieces of any size. For every power of two L, each completed block of L
words becomes a catcher: it waits for the words 2L - 1 to 4L - 2 places on and reports where
its own content comes again. Every period p has one size of block, the one with
2L - 1 <= p <= 4L - 2. A square of period p is new evidence once four blocks in a row come
again at distance p: more than p words in a row then equal those p places on. Squares of one period
that follow each other merge into a run, which word comparisons extend to both sides.

The catchers of one size advance together, as one comparison of block hashes; hashes only
choose what is compared, so every reported run rests on equal words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Words of a run, and periods it holds, at least.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Words of short texts that are looked at together, words of a text that is looked at alone, and
#: hash comparisons in memory at a time.
BATCH_WORDS, LONG, PIECE = 1 << 16, 4096, 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbours; sums and products wrap."""
    both = (left ^ (left >> np.uint64(29))) * _MIX + right
    return (both ^ (both >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


class Catchers:
    """The growing sequence of words, as numbers, and what its catchers have reported so far.

    Numbers below zero are marks that occur once: no run crosses them, so marks part texts.
    """

    def __init__(self):
        self.words = np.empty(0, np.int64)
        #: Per block size: the next word to start a block, and squares as rows (period, start).
        self.next: list[int] = []
        self.squares: list[list[np.ndarray]] = []

    def append(self, words: np.ndarray, longest: int | None = None) -> None:
        """Append words; catchers whose last awaited word has come advance. ``longest`` bounds a text's words."""
        self.words = np.concatenate([self.words, np.asarray(words, np.int64)])
        self._advance(len(self.words), len(self.words) if longest is None else longest)

    def finish(self, longest: int | None = None) -> list[tuple[int, int, int]]:
        """All maximal runs as (start, length, smallest period), by start and period; the catchers stop waiting."""
        longest = len(self.words) if longest is None else longest
        # Marks behind the last word complete what the catchers still wait for.
        words, marks = self.words, -1 - (1 << 62) - np.arange(longest + 16)
        self.words = np.concatenate([words, marks])
        self._advance(len(self.words), longest, len(words))
        self.words = words
        return self._runs()

    def _advance(self, end: int, longest: int, real: int | None = None) -> None:
        """Compare the blocks whose awaited words are all there; ``real`` words aren't marks behind the last one."""
        hashes, low, level = None, 0, 0
        while MIN_PERIODS * (2 * (size := 1 << level) - 1) <= longest:
            if level == len(self.next):
                self.next.append(0)
                self.squares.append([])
            first = self.next[level]
            # The last awaited word for the block at s and three more blocks is at s + 8 size - 3.
            blocks = (end - first - 8 * size + 2) // size + 1
            if real is not None:
                blocks = min(blocks, -(-(real - first) // size))
            if blocks <= 0:
                level, hashes = level + 1, None
                continue
            if hashes is None or first < low:
                hashes, low = self._hashes(first, level), first
            else:
                hashes = _joined(hashes[: -size // 2], hashes[size // 2 :])
            self._catch(level, first - low, low, blocks, hashes)
            self.next[level] = first + blocks * size
            level += 1

    def _hashes(self, first: int, level: int) -> np.ndarray:
        """Hashes of all windows of ``2 ** level`` words from ``first`` on."""
        out = (self.words[first:].astype(np.uint64) + np.uint64(1)) * _MIX
        for k in range(level):
            out = _joined(out[: -(1 << k)], out[1 << k :])
        return out

    def _catch(self, level: int, at: int, low: int, blocks: int, hashes: np.ndarray) -> None:
        size = 1 << level
        awaited = np.arange(2 * size - 1, 4 * size - 1)
        step = max(1, PIECE // len(awaited))
        for i in range(0, blocks, step):
            n = min(step, blocks - i)
            starts = at + (i + np.arange(n + 3)) * size
            again = hashes[starts][:, None] == hashes[starts[:, None] + awaited[None, :]]
            row, column = np.nonzero(again[:-3] & again[1:-2] & again[2:-1] & again[3:])
            if len(row):
                self.squares[level].append(np.stack([awaited[column], low + starts[row]]))

    def _equal_ahead(self, at: int, period: int, step: int) -> int:
        """How many words from ``at`` on, or back from it, equal those a period later."""
        words, found, width = self.words, 0, 64
        while True:
            if step > 0:
                right = words[at + found + period : at + found + period + width]
                left = words[at + found : at + found + len(right)]
            else:
                left = words[max(0, at - found - width) : at - found][::-1]
                right = words[max(0, at - found - width) + period : at - found + period][::-1]
            unequal = np.flatnonzero(left != right)
            if len(unequal):
                return found + int(unequal[0])
            found += len(left)
            if len(left) < width:
                return found
            width *= 2

    def _runs(self) -> list[tuple[int, int, int]]:
        """Merge squares of one period that follow each other, extend them, leave out multiples of a period."""
        found: dict[tuple[int, int], int] = {}
        # For each word the furthest end of a run of a smaller period that holds it.
        covered = None
        for level, caught in enumerate(self.squares):
            if not caught:
                continue
            size = 1 << level
            period, start = np.concatenate(caught, axis=1)
            if covered is not None:
                # A square inside a run of a smaller period only repeats that run.
                new = covered[start] < start + 4 * size + period
                period, start = period[new], start[new]
            order = np.lexsort((start, period))
            period, start = period[order], start[order]
            opens = np.flatnonzero(np.r_[True, (np.diff(period) != 0) | (np.diff(start) != size)]) if len(start) else []
            stretches = []
            done = (0, 0)
            for i, k in enumerate(opens):
                p, a = int(period[k]), int(start[k])
                if done[0] == p and a < done[1]:
                    continue  # reached by the extension of the former one
                last = int(start[(opens[i + 1] if i + 1 < len(opens) else len(start)) - 1]) + 4 * size
                b = last if np.array_equal(self.words[a:last], self.words[a + p : last + p]) else a
                b += self._equal_ahead(b, p, 1)
                a -= self._equal_ahead(a, p, -1)
                done = (p, b)
                if b - a >= p:
                    stretches.append((a, b + p, p))
            for a, b, p in stretches:
                if b - a >= max(MIN_WORDS, MIN_PERIODS * p):
                    found[a, b] = min(p, found.get((a, b), p))
            if stretches:
                ends = np.zeros(len(self.words), np.int64)
                for a, b, _ in stretches:
                    ends[a] = max(ends[a], b)
                ends = np.maximum.accumulate(ends)
                covered = ends if covered is None else np.maximum(covered, ends)
        return sorted(((a, b - a, p) for (a, b), p in found.items()), key=lambda r: (r[0], r[2]))


def runs_of(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text, a list of words."""
    numbers: dict = {}
    starts, parts, at = [], [], 0
    for i, words in enumerate(texts):
        starts.append(at)
        parts.append(np.fromiter(map(numbers.setdefault, words, count(at)), np.int64, len(words)))
        parts.append(np.array([-1 - i]))
        at += len(words) + 1
    longest = max(map(len, texts), default=0)
    catchers = Catchers()
    catchers.append(np.concatenate(parts) if parts else np.empty(0, np.int64), longest)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in catchers.finish(longest):
        i = int(np.searchsorted(starts, start, side="right")) - 1
        out[i].append((start - starts[i], length, period))
    return out


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, gone in zip(words, np.cumsum(edge[:-1]), strict=True) if not gone]


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", "n_words", "runs", "collapsed"]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    types = [pa.int64(), pa.list_(run), pa.string()]

    def flush(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(texts)
        columns = [
            [len(t) for t in texts], [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in found],
            [b" ".join(collapsed(t, rs)).decode() for t, rs in zip(texts, found, strict=True)],
        ]
        return pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names)

    for batch in batches:
        rows, texts, held = [], [], 0
        for i, text in enumerate(batch.column(1)):
            # Bytes split at 20 and 09 to 0D in hex, as the words do.
            words = (text.as_py() or b"").split()
            if len(words) > LONG:
                yield flush(batch.column(0).slice(i, 1), [words])
                continue
            rows.append(i)
            texts.append(words)
            held += len(words)
            if held >= BATCH_WORDS:
                yield flush(batch.column(0).take(pa.array(rows)), texts)
                rows, texts, held = [], [], 0
        if texts:
            yield flush(batch.column(0).take(pa.array(rows)), texts)


def find_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``runs`` (structs of start, length, period; by start, then period) and
    ``collapsed``, the text's words outside the repeats, joined by one space, for every row.

    Words are runs of characters other than blank and 09 to 0D in hex, numbered from 0. A run
    is a stretch of words with smallest period q and at least ``MIN_WORDS`` words and
    ``MIN_PERIODS`` periods that no word beside it extends. A word goes from ``collapsed`` if
    any run holds it after its first q words.

    A null or empty text has no words, no runs and an empty ``collapsed``. Each row is looked at
    alone, so null and repeated ids, copies and ties are rows like others. Other columns
    aren't read. No rows give no rows.

    One pass over the scan, no shuffle: a text of n words takes n log n steps and memory in
    proportion to its words; texts of up to ``LONG`` words share a step until they hold ``BATCH_WORDS`` words.
    """
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_words long, " + (
        "runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _each(batches):
            yield out.rename_columns([id_col, *out.schema.names[1:]])

    return docs.selectExpr(f"`{id_col}`", f"CAST(CAST(`{text_col}` AS STRING) AS BINARY) AS `_text`").mapInArrow(each, schema)
