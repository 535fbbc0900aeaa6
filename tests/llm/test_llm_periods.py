import random
import re

import messy
import numpy as np
import pytest

from gridledger.llm import periods


def brute(words):
    """(start, length, period) of all runs, from the equal stretches of every period."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted(((a, b - a, p) for (a, b), p in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng):
    letters, out = rng.randint(1, 4), []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.randint(0, letters) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 13, 14, 15, 16, 29, 30, 31, 40]))]
        out += (unit * rng.randint(1, 9))[: rng.randint(1, 400)] if rng.random() < 0.6 else unit
    return out


def test_runs_of_many_texts_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        texts = [repetitive(rng) for _ in range(rng.randint(0, 6))]
        assert periods.runs_of(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("piece", [1, 3, 64])
def test_words_may_come_in_pieces(piece):
    rng = random.Random(piece)
    for _ in range(40):
        words, catchers = repetitive(rng), periods.Catchers()
        for i in range(0, len(words), piece):
            catchers.append(np.array(words[i : i + piece]))
        assert catchers.finish() == brute(words)


def test_squares_are_reported_while_words_come():
    catchers = periods.Catchers()
    catchers.append(np.arange(100))
    assert not any(catchers.squares)
    catchers.append(np.tile(np.arange(200, 205), 40))
    assert any(catchers.squares)
    catchers.append(np.arange(300, 320))
    assert catchers.finish() == [(100, 200, 5)]


def test_long_texts():
    assert periods.runs_of([["a"] * 50_000]) == [[(0, 50_000, 1)]]
    words = [str(i) for i in range(3000)]
    assert periods.runs_of([words * 4 + ["end"], words]) == [[(0, 12_000, 3000)], []]
    assert periods.runs_of([words * 3]) == [[]]


def test_find_runs(spark):
    rows = [(0, "x a a a a a a y"), (1, "a b " * 5), (2, None), (3, ""), (4, " \n "), (5, "a b " * 7), (5, "a b " * 7), (None, "q " * 9)]
    docs = messy.documents(spark).unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    want = []
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = brute(words) if len(words) < 2000 else periods.runs_of([words])[0]
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
        want.append((r.doc_id, len(words), runs, " ".join(kept)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periods.find_runs(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert (0, 8, [(1, 6, 1)], "x a y") in got
    assert periods.find_runs(messy.empty(spark)).count() == 0
