import itertools
import math

import messy
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridledger.llm import cells, topk

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, a int, width string, cell int, rank int"


def vectors(spark, n=300, width=8, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    rows = []
    for i in range(n):
        v = centres[i % 6] + rng.normal(size=width) * rng.choice([0.05, 0.2, 1])
        rows.append((i, [float(np.float32(x)) for x in v], i % 3))
    for i in range(40):
        rows.append((1000 + i, rows[6][1], rows[6][2]))  # copies
    rows += [
        (2000, None, 1), (2001, [], 1), (2002, [0.0] * width, 1), (2003, [1.0] * (width - 1) + [None], 1),
        (2004, [float("nan")] * width, 1), (2005, [float("inf")] + [1.0] * (width - 1), 1), (2006, [1.0, 2.0], 1),
        (2007, [1.0, 2.0], 1), (2008, rows[6][1], None), (None, rows[6][1], rows[6][2]), (5, rows[5][1], rows[5][2]),
        (2050, [2.0, 4.0], 1),
    ]
    return spark.createDataFrame([(*r, 1, 2, "w", 3, 4) for r in rows], SCHEMA).repartition(4)


def fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("block", [50, 10_000])
def test_top_k(spark, block):
    df = vectors(spark)
    rows = {r.vec_id: [math.floor(256 * x) for x in r.embedding] for r in df.collect() if fine(r.embedding) and r.vec_id is not None}
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, 5, block_rows=block, block_queries=block // 10).collect()
    want = []
    for q, w in rows.items():
        if q % 50 == 0:
            scores = [(-sum(map(int.__mul__, w, v)), i) for i, v in rows.items() if i != q and len(v) == len(w)]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:5])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_of_large_and_of_tied_values(spark):
    big = [(i, [1e6 * (i % 7), -1e6, 3e5 * i]) for i in range(60)]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") == 0, 3).collect()
    whole = {i: [math.floor(256 * x) for x in v] for i, v in big}
    scores = sorted((-sum(map(int.__mul__, whole[0], v)), i) for i, v in whole.items() if i)
    assert [tuple(r) for r in got] == [(0, n + 1, i, -s) for n, (s, i) in enumerate(scores[:3])]
    tied = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(200)], "vec_id long, embedding array<double>")
    assert sorted(r.vec_id for r in topk.top_k(tied, F.col("vec_id") == 100, 5).collect()) == [0, 1, 2, 3, 4]
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(few, F.col("vec_id") == 0, 5).collect()] == [(0, 1, 1, 256 * 512)]


def test_top_k_refuses_scores_beyond_a_long(spark):
    df = spark.createDataFrame([(0, [1e12]), (1, [1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="may not fit a long"):
        topk.top_k(df, F.col("vec_id") == 0, 1).collect()


@pytest.mark.parametrize(("cell_rows", "block_rows"), [(20, 16), (2000, 2048)])
def test_cells(spark, cell_rows, block_rows):
    df = vectors(spark)
    got = cells.near_duplicate_vectors(df, cell_rows=cell_rows, block_rows=block_rows).collect()
    rows = df.collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(str(r.vec_id) for r in rows)
    takes = [r for r in rows if fine(r.embedding) and r.label is not None and any(r.embedding)]
    links, pairs = {}, []
    for x, y in itertools.combinations(takes, 2):
        if x.label == y.label and len(x.embedding) == len(y.embedding):
            u, v = np.array(x.embedding), np.array(y.embedding)
            if u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.98:
                links[x.vec_id] = links.get(x.vec_id, 0) + 1
                links[y.vec_id] = links.get(y.vec_id, 0) + 1
                pairs.append((x.vec_id, y.vec_id))
    named = [(a, b) for a, b in pairs if a is not None and b is not None]
    root = messy.groups({r.vec_id for r in rows if r.vec_id is not None}, named)
    for r in got:
        if r.vec_id is None:
            assert r.component_id == min(root[b] for a, b in [*pairs, *((y, x) for x, y in pairs)] if a is None and b is not None)
        elif r.vec_id != 5:
            assert (r.vec_id, r.n_links, r.component_id) == (r.vec_id, links.get(r.vec_id, 0), root[r.vec_id])
            assert r.kept == (r.vec_id == r.component_id)


def test_cells_of_null_and_repeated_ids(spark):
    rows = [(3, [1.0, 0.0], 1), (None, [1.0, 0.05], 1), (None, [1.0, -0.05], 1), (9, [0.0, 1.0], 1), (9, [-1.0, 0.0], 1),
            (11, [-1.0, 0.01], 1), (None, [-1.0, -1.0], 1), (None, [-1.0, -1.01], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in cells.near_duplicate_vectors(df).collect())
    # Links through rows without id count; the two vectors of id 9 are apart.
    assert got == sorted([
        ("3", 2, "3", True), ("None", 2, "3", False), ("None", 2, "3", False), ("9", 0, "9", True), ("9", 1, "9", True),
        ("11", 1, "9", False), ("None", 1, "None", True), ("None", 1, "None", True)])


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect() == []
    assert cells.near_duplicate_vectors(df).collect() == []


def test_centres_are_unit_vectors():
    points = np.random.default_rng(0).normal(size=(500, 6))
    centres = cells.fit_centres(points, 9)
    assert np.allclose(np.linalg.norm(centres, axis=1), 1) and len(centres) == 9
