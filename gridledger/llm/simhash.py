"""SimHash near-dedup over a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank: neighbours in that order differ in few
bits, so a run of them shares a long masked bit pattern. A block is a run of the order.
Inside a block, groups of ``FAN`` neighbours form a node, groups of nodes a higher node;
a node keeps only the shared bits its parent hasn't got. A search goes down from the top,
adds up the differences met on the way and drops a whole group once they exceed the limit.
The same test on the blocks' own patterns, themselves put in a tree, tells which blocks a
fingerprint has to visit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.links import Forest, components
from gridledger.session import Workspace

SHINGLE, MAX_BITS = 3, 2
#: Fingerprints a block should have, and blocks there are at most. The second bounds what is
#: sent to the tasks: 24 bytes for each block, 1.5 MB in all. The fewer the blocks, the fewer
#: a fingerprint has to visit; a block is held by one task, at 8 bytes a fingerprint.
BLOCK_ROWS, MAX_BLOCKS = 65_536, 65_536
FAN = 16
#: Queries that go down a tree together.
ABREAST = 1024
_PIECE = 1 << 22


def _shingle_hashes(data: bytes, width: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, piece by piece, so memory doesn't grow with the text."""
    tail: list[bytes] = []
    start, whole = 0, True
    while start < len(data):
        stop = start + _PIECE
        while stop < len(data) and data[stop] not in b" \t\n\v\f\r":
            stop += 1
        words = tail + data[start:stop].lower().split()
        start = stop
        if len(words) < width:
            tail = words
            continue
        whole = False
        grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
        yield np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64, len(words) - width + 1)
        tail = words[len(words) - width + 1 :]
    if whole and tail:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), 42)], np.uint64)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit SimHash of the words' shingles; 0 for a text without words.

    ASCII letters are lower-cased, words are split at ASCII white space, repeats count.
    A bit is 1 if it is set in over half of the shingles' XXH64 values.
    """
    ones, n = np.zeros(64, np.int64), 0
    for hashes in _shingle_hashes((text or "").encode(), width):
        for i in range(0, len(hashes), 1 << 16):
            part = hashes[i : i + (1 << 16)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
        n += len(hashes)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id`` and ``fp`` (the fingerprint's bits as a long) for every row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(each, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a 64-bit word in Gray order, as a long that sorts the same way."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def _place(bounds: list[int]):
    """Adds the block of each word: how many of the bounds its Gray rank has reached."""
    reached = np.array(bounds, np.int64)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(reached, batch.column(1).to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), batch.column(0)], ["block", "fp"])

    return each


class Tree:
    """Masked bit patterns over a run of words or of patterns, level by level.

    ``value`` holds the bits and ``mask`` tells which of them are fixed; words have all
    bits fixed. ``levels`` goes from the top to the rows; each mask is without the bits
    that the parent's mask has.
    """

    def __init__(self, value: np.ndarray, mask: np.ndarray):
        self.levels = [(value, mask)]
        while len(value) > 1:
            at = np.arange(0, len(value), FAN)
            shared = np.bitwise_and.reduceat(mask, at)
            ones = np.bitwise_and.reduceat(value, at)
            some = np.bitwise_or.reduceat(value, at)
            parent = shared & ~(ones ^ some)
            own = np.repeat(parent, FAN)[: len(value)]
            self.levels[0] = (self.levels[0][0], mask & ~own)
            value, mask = ones & parent, parent
            self.levels.insert(0, (value, mask))

    def search(self, words: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (word, row) at ``limit`` or fewer differing fixed bits."""
        word, node = np.arange(len(words)), np.zeros(len(words), np.int64)
        far = np.zeros(len(words), np.uint8)
        for depth, (value, mask) in enumerate(self.levels):
            if depth:
                child = (node[:, None] * FAN + np.arange(FAN)).ravel()
                there = child < len(value)
                word, far, node = np.repeat(word, FAN)[there], np.repeat(far, FAN)[there], child[there]
            far = far + np.bitwise_count((words[word] ^ value[node]) & mask[node])
            near = far <= limit
            word, node, far = word[near], node[near], far[near]
        return word, node


def _visits(patterns: list[tuple[int, int, int]], limit: int):
    """Maps (block, fp) to a row for the own block and for each later block to visit."""
    block = np.array([p[0] for p in patterns])
    ones = np.array([p[1] for p in patterns], np.int64).view(np.uint64)
    some = np.array([p[2] for p in patterns], np.int64).view(np.uint64)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(ones, ~(ones ^ some))
        for batch in batches:
            own, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.zeros(len(fp), bool)), pa.array(fp)], ["block", "guest", "fp"])
            for i in range(0, len(fp), ABREAST):
                word, node = tree.search(fp[i : i + ABREAST].view(np.uint64), limit)
                # A pair in two blocks is found once: by the guest from the earlier one.
                later = block[node] > own[i : i + ABREAST][word]
                to, who = block[node[later]], fp[i : i + ABREAST][word[later]]
                yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), pa.array(np.ones(len(to), bool)), pa.array(who)], ["block", "guest", "fp"])

    return each


def _search_blocks(limit: int):
    """Links among rows that come by block, a block's own ones in Gray order before its guests.

    A block's own rows stay in memory, its guests stream by.
    """

    class Block:
        def __init__(self, own: np.ndarray):
            self.words = own.view(np.uint64)
            self.tree = Tree(self.words, np.full(len(own), ~np.uint64(0)))
            self.forest = Forest(len(own))
            for i in range(0, len(own), ABREAST):
                word, row = self.tree.search(self.words[i : i + ABREAST], limit)
                self.forest.join(word + i, row)

        def meet(self, guests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Links of guests to the first row each meets; all it meets become one group."""
            a, b = [], []
            for i in range(0, len(guests), ABREAST):
                word, row = self.tree.search(guests[i : i + ABREAST].view(np.uint64), limit)
                who, first = np.unique(word, return_index=True)
                lead = np.zeros(ABREAST, np.int64)
                lead[who] = row[first]
                self.forest.join(lead[word], row)
                a.append(guests[i : i + ABREAST][who])
                b.append(self.words[row[first]].view(np.int64))
            return np.concatenate(a), np.concatenate(b)

    def table(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def ended(block: Block) -> pa.RecordBatch:
        member, lead = block.forest.tree()
        words = block.words.view(np.int64)
        return table(words[member], words[lead])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, block = None, [], None
        for batch in batches:
            ids, guest, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero((np.diff(ids) != 0) | (np.diff(guest.view(np.int8)) != 0)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(ids)], strict=True):
                if i == j:
                    continue
                if ids[i] != at:
                    if at is not None:
                        yield ended(block or Block(np.concatenate(parts)))
                    at, parts, block = ids[i], [], None
                if not guest[i]:
                    parts.append(fp[i:j])
                else:
                    block = block or Block(np.concatenate(parts))
                    yield table(*block.meet(fp[i:j]))
        if at is not None:
            yield ended(block or Block(np.concatenate(parts)))

    return each


def links(fps: DataFrame, limit: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that connect the distinct words ``fp`` just as all pairs at ``limit`` bits do."""
    n = fps.count()
    blocks = max(1, min(MAX_BLOCKS, -(-n // block_rows)))
    rank = gray_rank(F.col("fp"))
    ranked = fps.select("fp", rank.alias("rank"))
    parts = [i / blocks for i in range(1, blocks)]
    # MAX_BLOCKS bounds and patterns at most.
    bounds = ranked.agg(F.percentile_approx("rank", parts, max(10_000, 8 * blocks))).first()[0] if n and parts else []
    placed = ranked.mapInArrow(_place(bounds), "block int, fp long")
    patterns = placed.groupBy("block").agg(F.bit_and("fp"), F.bit_or("fp")).sort("block").collect()
    if not patterns:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    visits = placed.mapInArrow(_visits([tuple(p) for p in patterns], limit), "block int, guest boolean, fp long")
    met = visits.repartition(blocks, "block").sortWithinPartitions("block", "guest", rank)
    return met.mapInArrow(_search_blocks(limit), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
    max_bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS, space: Workspace | None = None,
) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row.

    Rows link when their fingerprints differ in at most ``max_bits`` bits;
    ``component_id`` is the smallest id reachable by links. A null or empty text has
    fingerprint zero. Rows with one fingerprint, exact copies among them, are one node:
    they are counted before anything is compared. A null id stays null and takes its
    component's id, null if no row of the component has an id; rows that repeat an id
    are kept. Columns other than the two named aren't read. No rows give no rows.
    """
    space = space or Workspace(docs.sparkSession)
    rows = space.stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = space.stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    found = components(links(nodes, max_bits, block_rows), space, "links")
    rooted = nodes.join(found, nodes.fp == found.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = space.stage(rooted, "rooted")
    least = space.stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = space.stage(rooted.join(least, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
