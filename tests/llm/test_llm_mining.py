import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_vectors import SCHEMA, fine, vectors

from gridledger.llm import mining


def brute(rows, anchor, positives=5, negatives=10, low=30, high=90):
    """``rows``: (id, label, whole numbers); rows are told apart by their place."""
    out = []
    for a, (anchor_id, label, w) in enumerate(rows):
        if not anchor(anchor_id):
            continue
        scored = [
            (-sum(map(int.__mul__, w, v)), i, other) for b, (i, other, v) in enumerate(rows) if b != a and len(v) == len(w)
        ]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            hard = sorted((s, i) for s, i, other in scored if other != label and low * -p <= 100 * -s <= high * -p)
            out += [(anchor_id, positive, n + 1, i, -p, -s) for n, (s, i) in enumerate(hard[:negatives])]
    return sorted(out)


def whole(df):
    return [
        (r.vec_id, r.label, [int(np.floor(256 * x)) for x in r.embedding])
        for r in df.collect() if r.vec_id is not None and r.label is not None and fine(r.embedding)
    ]


@pytest.mark.parametrize("lane", [60, 100_000])
@pytest.mark.parametrize("block", [7, 10_000])
def test_equal_to_brute_force(spark, lane, block):
    df = vectors(spark, n=400)
    got = mining.hard_negatives(df, F.col("vec_id") % 10 == 0, block_anchors=block, lane_rows=lane)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(whole(df), lambda i: i % 10 == 0)


def test_ties_copies_and_repeated_ids(spark):
    rows = [(i, [1.0, 2.0, -1.0], i % 3) for i in range(60)] + [(i, [0.5, 1.0, 0.0], i % 2) for i in range(60, 120)]
    rows += [(0, [1.0, 2.0, -1.0], 0), (3, [0.25, 1.0, 0.0], 0), (200, [0.0, 0.0, 0.0], 0), (210, [-1.0, -2.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    for lane in (16, 10_000):
        got = mining.hard_negatives(df, F.col("vec_id") % 10 == 0, lane_rows=lane)
        assert sorted(map(tuple, got.collect())) == brute(whole(df), lambda i: i % 10 == 0)


def test_wide_vectors_and_other_windows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=37) + 3 * (i % 4)], f"l{i % 4}") for i in range(160)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = mining.hard_negatives(df, F.col("vec_id") < 9, positives=2, negatives=3, low=-50, high=70)
    assert sorted(map(tuple, got.collect())) == brute(whole(df), lambda i: i < 9, 2, 3, -50, 70)


def test_bounds_drop_rows_and_lose_no_pair():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 32)) * 300
    rows = np.floor(centres[rng.integers(0, 5, 600)] + rng.normal(size=(600, 32)) * 40).astype(np.int64)
    order = np.argsort(-(rows[:20].astype(float) ** 2).sum(axis=0), kind="stable")
    index = mining.Index(rows, order)
    anchors = rows[:20][:, order].astype(float)
    scores = rows[:20] @ rows.T
    for share in (0.9, 0.5, 0.0, -1.0):
        least = share * np.sort(scores, axis=1)[:, -2]
        found = list(index.reach(anchors, mining.rest_lengths(anchors), least))
        pairs = {(int(a), int(r)) for part in found for a, r in zip(*part, strict=True)}
        assert len(pairs) == sum(len(a) for a, _ in found)
        assert pairs >= {(int(a), int(r)) for a, r in zip(*np.nonzero(scores >= least[:, None]), strict=True)}
        if share == 0.9:
            assert len(pairs) < scores.size / 3


def test_large_values_raise_and_nothing_gives_nothing(spark):
    empty = mining.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0)
    assert empty.count() == 0
    none = mining.hard_negatives(vectors(spark), F.lit(False))
    assert none.count() == 0
    huge = spark.createDataFrame([(i, [1e8, 1e8], i % 2) for i in range(4)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="may not fit"):
        mining.hard_negatives(huge, F.col("vec_id") == 0).collect()
