"""Byte-level BPE with a rank queue of hierarchical bitmaps.

The symbols of a pre-token form a doubly linked list. Each merge rank that some neighbouring
pair has owns a bucket of list positions; two levels of 256-bit words mark the ranks whose
buckets aren't empty, so the lowest rank is two find-first-set steps away. A popped position
whose pair has changed meanwhile is stale and skipped. The work is proportional to the length
of the pre-token, however long it is. Many short pre-tokens share one queue: their symbols lie
in one list that is cut between them.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

#: Bytes of results that a worker remembers, by the estimate in ``_learn``, and the longest piece of text among them.
REMEMBERED, LONGEST = 320 << 20, 64
#: Bytes of a remembered piece and its ids beyond their characters: two strings and a place in a dictionary.
ENTRY = 200
#: Characters of the texts that are encoded together.
TOGETHER = 1 << 21

_CUT = re.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r"\s\s")


class Codec:
    """Encoder and decoder for a rank file and a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        # Whether texts may be cut at spaces first; of other patterns a match might span one.
        self.at_spaces = pattern == public_tokenizers.PATTERN
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    self.pairs[left, right] = rank
        # Bits of the ranks that have a bucket, 256 a word; they are all zero between pre-tokens.
        self.words = [0] * (max(self.bytes) // 256 + 1)
        self.named = {str(rank): token for rank, token in self.bytes.items()}
        self.forget()

    def forget(self) -> None:
        """Let go of all remembered results."""
        # Ids by piece of text. There are two generations, of which the older one is dropped whole.
        self.fresh: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.held = 0
        # Pieces that are forgotten once their texts are done.
        self.long: list[str] = []

    def merge(self, tokens: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens: the pair of lowest rank merges first, of equal ones the leftmost."""
        data = b"".join(tokens)
        n, rank_of, words = len(data), self.pairs.get, self.words
        ids = list(map(self.single.__getitem__, data))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = list(map(rank_of, zip(ids, ids[1:], strict=False)))
        ends = list(accumulate(map(len, tokens)))
        for end in ends[:-1]:
            after[end - 1], before[end], pairs[end - 1] = n, -1, None
        buckets: dict[int, list[int]] = {}
        # Bits of the words that have a bit.
        top = 0
        for i, rank in enumerate(pairs):
            if rank in buckets:
                buckets[rank].append(i)
            elif rank is not None:
                buckets[rank] = [i]
                words[rank >> 8] |= 1 << (rank & 255)
                top |= 1 << (rank >> 8)
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            rank = w << 8 | (word & -word).bit_length() - 1
            word &= word - 1
            words[w] = word
            if not word:
                top &= top - 1
            bucket = buckets.pop(rank)
            if len(bucket) > 1:
                bucket.sort()
            for at, i in enumerate(bucket):
                j = after[i]
                # Stale: i has been merged away or is followed by another symbol now.
                if ids[i] < 0 or j >= n or rank_of((ids[i], ids[j])) != rank:
                    continue
                k, h = after[j], before[i]
                ids[i], ids[j], after[i] = rank, -1, k
                right = left = None
                if k < n:
                    before[k] = i
                    right = rank_of((rank, ids[k]))
                if h >= 0:
                    left = rank_of((ids[h], rank))
                again = False
                for new, place in ((right, i), (left, h)):
                    if new is not None:
                        again = again or new < rank
                        if new in buckets:
                            buckets[new].append(place)
                        else:
                            buckets[new] = [place]
                            words[new >> 8] |= 1 << (new & 255)
                            top |= 1 << (new >> 8)
                if again and at + 1 < len(bucket):
                    # A new pair comes before the rest of this bucket, which waits again.
                    buckets[rank] = bucket[at + 1 :]
                    words[rank >> 8] |= 1 << (rank & 255)
                    top |= 1 << (rank >> 8)
                    break
        return [[x for x in ids[i:j] if x >= 0] for i, j in zip([0, *ends], ends, strict=False)]

    def parts(self, text: str) -> list[str]:
        """A text cut before the single spaces in it, or into its pre-tokens.

        With the pattern of the public tokenizers, a space between two other characters that
        aren't white space starts a pre-token whatever surrounds it, so the parts can be
        encoded apart from one another. Other patterns cut the text themselves.
        """
        if not text:
            return []
        if not self.at_spaces:
            return [m.group() for m in self.pattern.finditer(text)]
        plain = not (_WIDE.search(text) or text[0].isspace() or text[-1].isspace())
        first, *rest = text.split(" ") if plain else _CUT.split(text)
        return [first, *map(" ".__add__, rest)]

    def _learn(self, pieces: set[str]) -> None:
        """Put the ids of all pieces into the fresh generation."""
        if self.held >= REMEMBERED // 2:
            self.older, self.fresh, self.held = self.fresh, {}, 0
        fresh, older = self.fresh, self.older
        known, new = len(fresh), []
        for piece in pieces.difference(fresh):
            made = older.get(piece)
            if made is None:
                new.append(piece)
            else:
                fresh[piece] = made
        # Pieces of another pattern are pre-tokens already.
        split = list(map(self.pattern.findall, new)) if self.at_spaces else [[piece] for piece in new]
        unknown = [t for t in {t for tokens in split for t in tokens}.difference(fresh) if t not in older]
        encoded = [t.encode() for t in unknown]
        merged = iter(self.merge([t for t in encoded if t not in self.ranks]))
        for token, data in zip(unknown, encoded, strict=True):
            # A pre-token that is a token is never merged.
            fresh[token] = str(self.ranks[data]) if data in self.ranks else " ".join(map(str, next(merged)))
        for piece, tokens in zip(new, split, strict=True):
            if piece not in fresh:
                fresh[piece] = " ".join([fresh.get(t) or older[t] for t in tokens])
        self.long = [p for p in {*new, *unknown} if len(p) > LONGEST]
        # Short pieces and their ids hold some 16 characters each.
        self.held += (len(fresh) - known) * (ENTRY + 32)

    def results(self, texts: list[str | None]) -> Iterator[str]:
        """For each text its ids, joined by blanks."""
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size < TOGETHER):
                size += len(texts[stop] or "")
                stop += 1
            cut = [self.parts(text or "") for text in texts[start:stop]]
            self._learn({piece for parts in cut for piece in parts})
            for parts in cut:
                yield " ".join(map(self.fresh.__getitem__, parts))
            for piece in self.long:
                del self.fresh[piece]
            start = stop

    def encode(self, text: str | None) -> list[int]:
        return list(map(int, next(self.results([text])).split()))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """The worker's codec; it is read once, and its memory of ``REMEMBERED`` bytes at most lasts over tasks."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """All rows and columns of ``docs`` with the token ids of whole texts; a null or empty text has none.

    A column that has the new name is replaced. ``path`` is a rank file that every executor
    has (a tokenizer is installed with the Python packages), ``pattern`` its pre-token pattern.
    """
    docs = docs.select(*(c for c in docs.columns if c != name))
    at = docs.columns.index(text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            found = own.results(batch.column(at).to_pylist())
            ids = pa.array([list(map(int, ids.split())) for ids in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, name])

    return docs.mapInArrow(each, StructType([*docs.schema, StructField(name, ArrayType(IntegerType()))]))


def decode(tokens: DataFrame, path: str, pattern: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """All rows and columns of ``tokens`` with the bytes that the ids stand for; null ids give no bytes."""
    tokens = tokens.select(*(c for c in tokens.columns if c != name))
    at = tokens.columns.index(ids_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            made = pa.array([own.decode(ids.as_py() or []) for ids in batch.column(at)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])

    return tokens.mapInArrow(each, StructType([*tokens.schema, StructField(name, BinaryType())]))


def digests(
    docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", lasting: bool = True
) -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` for every row.

    The digests are of the decimal ids joined by one space and of the bytes that the ids
    decode to. A null text is empty: no tokens, digests of nothing. Rows that repeat an id
    stay rows of their own. Other columns aren't read. No rows give no rows.

    A worker remembers results for its later tasks; without ``lasting`` they go with each
    task, so that operators that run afterwards have the worker's memory to themselves.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for joined in own.results(batch.column(1).to_pylist()):
                names = joined.split()
                counts.append(len(names))
                ids.append(sha(joined.encode()))
                decoded.append(sha(b"".join(map(own.named.__getitem__, names))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        if not lasting:
            own.forget()

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(each, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
