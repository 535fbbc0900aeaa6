import itertools
import random

import messy
import numpy as np
import pytest
import xxhash

from gridledger.llm import simhash
from gridledger.llm.links import components
from gridledger.session import Workspace


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprint(spark, monkeypatch):
    texts = [r.text for r in messy.documents(spark).collect()]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "_PIECE", 40)
    assert [simhash.fingerprint(t) for t in texts if len(t or "") < 1000] == [
        plain_fingerprint(t) for t in texts if len(t or "") < 1000]


def test_matches_the_hash_of_the_engine(spark):
    df = spark.createDataFrame([("a bé c",)], "s string").selectExpr("xxhash64(s) AS h")
    assert df.first().h % (1 << 64) == xxhash.xxh64_intdigest("a bé c".encode(), 42)


@pytest.mark.parametrize("block_rows", [4, 16_384])
def test_groups(spark, block_rows):
    docs = messy.documents(spark)
    got = simhash.near_duplicates(docs, block_rows=block_rows).collect()
    want = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{f:016x}") for i, f in want)
    nodes = {f for _, f in want}
    root = messy.groups(nodes, [(a, b) for a, b in itertools.combinations(nodes, 2) if (a ^ b).bit_count() <= 2])
    least = {}
    for i, f in want:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    for r in got:
        assert r.component_id == least.get(root[int(r.fingerprint, 16)])


@pytest.mark.parametrize("block_rows", [7, 64])
def test_no_link_is_lost(spark, block_rows):
    """Dense clusters, so that links run within and between blocks."""
    rng = random.Random(3)
    words = set()
    for _ in range(40):
        at = rng.getrandbits(64)
        for _ in range(12):
            at ^= 1 << rng.randrange(64)
            words.add(at)
    words |= {0, (1 << 64) - 1, 1, 3}
    df = spark.createDataFrame([(w - (1 << 64) if w >> 63 else w,) for w in words], "fp long")
    space = Workspace(spark)
    links = simhash.links(df, 2, block_rows)
    found = {r.node % (1 << 64): r.root % (1 << 64) for r in components(links, space, "t").collect()}
    want = messy.groups(words, [(a, b) for a, b in itertools.combinations(words, 2) if (a ^ b).bit_count() <= 2])
    groups = lambda root: {frozenset(w for w in words if root(w) == r) for r in map(root, words)}
    assert groups(lambda w: found.get(w, w)) == groups(want.get)


def test_search_is_exact():
    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64) & np.uint64(0xFFFF))
    tree = simhash.Tree(words, np.full(len(words), ~np.uint64(0)))
    a, b = tree.search(words, 2)
    near = np.bitwise_count(words[:, None] ^ words[None, :]) <= 2
    assert {*zip(a.tolist(), b.tolist(), strict=True)} == {*zip(*(x.tolist() for x in np.nonzero(near)), strict=True)}


def test_gray_rank(spark):
    df = spark.createDataFrame([(i ^ (i >> 1),) for i in range(50)], "fp long")
    rows = df.select("fp", simhash.gray_rank(df.fp).alias("r")).sort("r").collect()
    assert [r.fp for r in rows] == [i ^ (i >> 1) for i in range(50)]


def test_empty(spark):
    assert simhash.near_duplicates(messy.empty(spark)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000), (None, 3)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components(df, Workspace(spark), "c").collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 300)}
