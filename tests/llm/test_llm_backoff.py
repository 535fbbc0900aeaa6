import math
import zlib
from collections import Counter

import messy
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridledger.llm import backoff

MU = backoff.MU


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def walk(texts, train, order):
    """The automaton as a dictionary, one token at a time."""
    grams = [Counter() for _ in range(order)]
    for text, learn in zip(texts, train, strict=True):
        if learn:
            t = ["start"] * (order - 1) + tokens(text)
            for k in range(order):
                grams[k].update(tuple(t[i - k : i + 1]) for i in range(order - 1, len(t)))
    n, v, starts = sum(grams[0].values()), len(grams[0]), sum(train)
    for text in texts:
        t, base, score, known = ["start"] * (order - 1) + tokens(text), 0.0, 0.0, 0
        for i in range(order - 1, len(t)):
            c = grams[0][t[i],]
            known += c > 0
            p = (c + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            for k in range(1, order):
                context = tuple(t[i - k : i])
                h = starts if all(x == "start" for x in context) else grams[k - 1][context]
                if h:
                    p = (grams[k][(*context, t[i])] + MU * p) / (h + MU)
            score += math.log10(p)
        yield len(t) - order + 1, known, n, base, score


@pytest.mark.parametrize(("order", "block_bytes", "shard_grams"), [(2, 24_000_000, 4_000_000), (2, 500, 20), (3, 2000, 50)])
def test_scores(spark, order, block_bytes, shard_grams):
    docs = messy.documents(spark)
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    got = backoff.score_texts(docs, train, order=order, block_bytes=block_bytes, shard_grams=shard_grams).collect()
    rows = docs.collect()
    learn = [r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 != 1 for r in rows]
    want = [(str(r.doc_id), not t, *w) for r, t, w in zip(rows, learn, walk([r.text for r in rows], learn, order), strict=True)]
    key = lambda r: (str(r[0]), r[2], r[5])
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert (str(a[0]), *a[1:5]) == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_messages_are_whole():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert np.array_equal(backoff._unpack_keys(backoff._pack_keys(keys)), keys)
    for top in (1, 200, 60_000, 1 << 31, 1 << 40):
        x = rng.integers(0, top, 50)
        assert np.array_equal(backoff._unpack(backoff._pack(x)).astype(np.int64), x)
    assert len(backoff._unpack(backoff._pack(keys[:0]))) == len(backoff._unpack_keys(backoff._pack_keys(keys[:0]))) == 0


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    row = backoff.score_texts(docs, train).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > row[1]


def test_empty_and_untrained(spark):
    assert backoff.score_texts(messy.empty(spark), F.lit(True)).collect() == []
    rows = backoff.score_texts(messy.documents(spark), F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in rows} == {(0, 0)} and all(r.score == r.base_score for r in rows)
