"""Language-model scores from a weighted backoff automaton.

The model is an n-gram model with Dirichlet smoothing: with c the count of an n-gram and h
its context, p(w | h) = (c(h w) + MU p(w | h')) / (c(h) + MU), where h' is h without its first
word and the unigrams are smoothed by adding 0.5. As an automaton: a state is a context that
the corpus has, an arc from it is a word that followed it, and every state has a failure arc
to the next shorter context with weight MU / (c(h) + MU). A text is read once from left to
right: each token moves the state and adds the logarithm of the arcs taken.

Nobody holds the whole automaton. Texts form blocks. A block sends the n-grams it has, with
its own counts of training tokens, to shards by hash; a shard adds up and answers with what
other blocks have counted. So a block gets the part of the automaton that its texts can reach,
and reads all of them through it side by side.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Order of the model, weight of the shorter context in tokens, bytes of text of a block, and
#: n-grams of a shard. Larger blocks and shards take more memory and fewer, larger messages.
ORDER, MU, BLOCK_BYTES, SHARD_GRAMS = 2, 200.0, 10_000_000, 4_000_000
#: Tokens beyond the words: hashes of the start and of the end of a text.
_START, _END = np.uint64(1), np.uint64(2)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from the hashes of its context and of its last word."""
    x = (context * _FACTOR) ^ word
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


class Block:
    """The tokens of a block's texts, one after the other, and their n-grams' hashes by order.

    Hashes have 64 bits: among a billion n-grams two clash with a probability of 3 %, and
    a clash adds up two counts.
    """

    def __init__(self, texts: list[str | None], order: int):
        known: dict[bytes, int] = {}
        parts, self.lengths = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            words = (text or "").encode().lower().split()
            parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
            self.lengths[i] = len(words) + 1
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
        self.ends = np.cumsum(self.lengths)
        word = np.full(int(self.lengths.sum()), _END, np.uint64)
        if parts:
            inside = np.ones(len(word), bool)
            inside[self.ends - 1] = False
            word[inside] = hashes[np.concatenate(parts)]
        self.starts = self.ends - self.lengths
        # grams[k] is the hash of the k + 1 tokens that end at a place; at the start of a
        # text the contexts begin with the start mark.
        self.grams = [word]
        context = self.before(word, _START)
        for k in range(1, order):
            self.grams.append(_mix(context + np.uint64(k), word))
            context = self.before(self.grams[k], _START + np.uint64(k << 8))

    def before(self, x: np.ndarray, first) -> np.ndarray:
        """What stands one place to the left, and ``first`` at the start of a text."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.starts] = first
        return out

    def distinct(self, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Sorted distinct n-grams of all orders, their training counts, and each place's n-grams among them.

        The n-grams are let go.
        """
        order = len(self.grams)
        every = np.concatenate([g ^ np.uint64(k << 60) for k, g in enumerate(self.grams)])
        self.grams.clear()
        keys, place = np.unique(every, return_inverse=True)
        counted = np.tile(np.repeat(train, self.lengths), order)
        counts = np.bincount(place[counted], minlength=len(keys))
        return keys, counts, np.split(place, order)


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers from zero up, in as few bytes as their largest needs, compressed."""
    for kind in (np.uint8, np.uint16, np.uint32, np.uint64):
        if not len(x) or x.max() <= np.iinfo(kind).max:
            return np.dtype(kind).char.encode() + zlib.compress(x.astype(kind).tobytes(), 1)
    raise AssertionError


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), np.dtype(data[:1].decode()))


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as gaps, their bytes by significance, so that the high ones compress."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return zlib.compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack_keys(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T.copy()
    return np.cumsum(gaps.reshape(-1).view(np.uint64), dtype=np.uint64)


def _limits(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's part of sorted keys begins; a shard has an equal part of the hash range."""
    step = (1 << 64) // shards
    return np.append(np.searchsorted(keys, np.array([s * step for s in range(shards)], np.uint64)), len(keys))


_ASK = "shard int, block int, keys binary, counts binary, unigrams binary"
_ANSWER = "block int, shard int, others binary, tokens long, types long"


def _ask(order: int, shards: int):
    def each(key: tuple, rows: pa.Table) -> pa.Table:
        block = Block(rows["text"].to_pylist(), order)
        keys, counts, places = block.distinct(rows["train"].to_numpy(zero_copy_only=False))
        single = np.zeros(len(keys), np.uint8)
        single[places[0]] = 1
        at = _limits(keys, shards)
        parts = [slice(i, j) for i, j in zip(at[:-1], at[1:], strict=True)]
        return pa.table([
            pa.array(range(shards), pa.int32()), pa.array([key[0].as_py()] * shards, pa.int32()),
            pa.array([_pack_keys(keys[p]) for p in parts]), pa.array([_pack(counts[p]) for p in parts]),
            pa.array([_pack(single[p]) for p in parts]),
        ], ["shard", "block", "keys", "counts", "unigrams"])

    return each


def _answer(key: tuple, asked: pa.Table) -> pa.Table:
    """To each block, for its n-grams in its order, the count of the other blocks; and the shard's unigram tokens and types."""
    keys = [_unpack_keys(x) for x in asked["keys"].to_pylist()]
    counts = np.concatenate([_unpack(x).astype(np.int64) for x in asked["counts"].to_pylist()])
    single = np.concatenate([_unpack(x) for x in asked["unigrams"].to_pylist()]).astype(bool)
    ends = np.cumsum([len(k) for k in keys])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
    others = total[place] - counts
    unigram = np.zeros(len(distinct), bool)
    unigram[place[single]] = True
    n = len(keys)
    return pa.table([
        asked["block"].combine_chunks(), asked["shard"].combine_chunks(),
        pa.array([_pack(x) for x in np.split(others, ends[:-1])]),
        pa.array([int(total[unigram].sum())] * n, pa.int64()), pa.array([int((total[unigram] > 0).sum())] * n, pa.int64()),
    ], ["block", "shard", "others", "tokens", "types"])


def _read(order: int, mu: float):
    def each(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(rows["text"].to_pylist(), order)
        train = rows["train"].to_numpy(zero_copy_only=False)
        _, counts, places = block.distinct(train)
        by_shard = sorted(zip(answers["shard"].to_pylist(), answers["others"].to_pylist(), strict=True))
        counts = counts + np.concatenate([_unpack(x) for _, x in by_shard]).astype(np.int64)
        tokens, types = (int(answers[c].to_numpy().sum()) for c in ("tokens", "types"))
        own = counts[places[0]]
        p = (own + 0.5) / (tokens + 0.5 * (types + 1))
        base = np.log10(p)
        # Every training text has one end, so the ends count the starts too.
        context = block.before(own, 0)
        starts = answers["texts"][0].as_py()
        context[block.starts] = starts
        for k in range(1, order):
            arc = counts[places[k]]
            p = np.where(context > 0, (arc + mu * p) / (context + mu), p)
            context = block.before(arc, starts)
        add = lambda x: np.add.reduceat(x, block.starts)
        return pa.table(
            [rows["id"].combine_chunks(), pa.array(~train), pa.array(block.lengths), pa.array(add((own > 0).astype(np.int64))),
             pa.array(np.full(len(train), tokens)), pa.array(add(base)), pa.array(add(np.log10(p)))],
            ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return each


def score_texts(
    docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, mu: float = MU,
    block_bytes: int = BLOCK_BYTES, shard_grams: int = SHARD_GRAMS,
) -> DataFrame:
    """Log10 probabilities of all texts under a model that is learnt from those where ``train`` is true.

    Result: ``id_col``, ``held_out`` (not learnt from), ``n_tokens``, ``n_known`` (tokens that
    training has), ``train_tokens``, ``base_score`` (unigrams alone) and ``score``. A text's
    tokens are its words, with ASCII letters lower-cased and cut at ASCII white space, and one
    end.

    A null or empty text has one token, the end. A null ``train`` counts as true. Rows that
    repeat an id or a text are texts of their own and count each time. Without training
    texts all counts are zero. Other columns aren't read. No rows give no rows.

    A block of texts and a shard of n-grams fit one task's memory by their sizes; texts go to
    blocks by a hash of id and text. A frequent n-gram costs a block one entry however often
    it stands there. There is no collected or broadcast model: all exchanges are lineage.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(train, F.lit(True)).alias("train"))
    size, texts = rows.agg(F.sum(F.octet_length("text")), F.count_if("train")).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    # A word has five bytes or more on average, and half as many n-grams are distinct in a block.
    shards = max(1, -(-(size or 0) * order // (10 * shard_grams)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int"))
    # One exchange of texts serves both passes.
    rows = rows.repartition(blocks, "block")
    asked = rows.groupBy("block").applyInArrow(_ask(order, shards), _ASK)
    answered = asked.groupBy("shard").applyInArrow(_answer, _ANSWER).withColumn("texts", F.lit(texts))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        _read(order, mu), f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    ).withColumnRenamed("id", id_col)
