import random
from collections import Counter

import messy
import pytest

from gridledger.llm import mixing


def lags(slots, weights):
    """Largest deviation of any source from its share at any slot."""
    q, worst, taken = sum(weights.values()), 0.0, Counter()
    for t, s in enumerate(slots, 1):
        taken[s] += 1
        worst = max(worst, max(abs(taken[x] - weights[x] * t / q) for x in weights))
    return worst


@pytest.mark.parametrize("weights", [{0: 1}, {0: 1, 1: 1}, {0: 500, 1: 499, 2: 1}, {i: i + 1 for i in range(20)}, {i: 7 + (i == 3) * 90 for i in range(30)}])
def test_period(weights):
    slots = mixing.period(weights)
    assert Counter(slots) == weights and lags(slots, weights) < 1


def test_periods_at_random():
    rng = random.Random(0)
    for _ in range(150):
        weights = {i: rng.choice([1, 2, 3, 10, 100]) for i in range(rng.randint(1, 12))}
        assert lags(mixing.period(weights), weights) < 1


def test_phases_take_every_block_once():
    rng = random.Random(1)
    for _ in range(60):
        blocks = {i: rng.randint(0, 40) for i in range(rng.randint(1, 7))}
        weights = {i: rng.randint(0, 5) for i in blocks}
        slot = {}
        for _, s, begin, end, start, weight, period, turn, at in mixing.phases(blocks, weights):
            for j in range(begin + turn, end, weight):
                slot[s, j] = start + (j - begin) // weight * period + at
        assert {*slot} == {(s, j) for s, n in blocks.items() for j in range(n)}
        assert sorted(slot.values()) == list(range(sum(blocks.values())))


def mixed(spark, target, sizes, **more):
    rows = [(i, s, "x") for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "doc_id long, source string, mix_slot string").repartition(5)
    return mixing.mix_sources(df, target, **more).collect(), rows


def test_deviation_is_less_than_a_block_until_a_source_runs_out(spark):
    sizes, target = {"a": 700, "b": 300, None: 90, "z": 10}, {"a": 0.5, "b": 0.3, None: 0.2}
    got, rows = mixed(spark, target, sizes, block_rows=5, run_rows=40)
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    block = {(r.source, r.mix_block): r.mix_slot for r in got}
    assert Counter((r.source, r.mix_block) for r in got) == {k: 5 for k in block}
    assert sorted(block.values()) == list(range(220))
    order = [s for (s, _), _ in sorted(block.items(), key=lambda x: x[1])]
    out = order.index("z") if "z" in order else 220
    assert set(order[out:]) == {"z"}  # no target: last
    taken, last = Counter(), max(t for (s, _), t in block.items() if s is None)
    for t, s in enumerate(order[: last + 1], 1):
        taken[s] += 1
        assert all(abs(taken[x] - w * t) < 1 for x, w in target.items())
    for s in sizes:
        slots = [block[s, j] for j in range(sizes[s] // 5)]
        assert slots == sorted(slots)


def worst_lag(blocks, target):
    """Largest deviation from the exact target until the first source runs out, over whole weights of it."""
    weights = mixing.whole_weights(target, {s: n * mixing.BLOCK_ROWS for s, n in blocks.items()})
    total, taken, worst = sum(weights.values()), Counter(), 0
    order = mixing.schedule(blocks, weights)
    for t, (s, j) in enumerate(order, 1):
        taken[s] += 1
        # A source's lag is largest when it has just taken a slot, or just before it does.
        worst = max(worst, taken[s] - t * weights[s] / total, (t - 1) * weights[s] / total - (taken[s] - 1))
        if j + 1 == blocks[s]:
            return worst, t, taken, {s: w / total for s, w in weights.items()}


def test_no_rounding_of_targets():
    blocks = {0: 15_625} | {i: 1_563 for i in range(1, 21)}
    worst, slots, _, share = worst_lag(blocks, {})
    assert worst < 1 and slots > 10_000 and abs(share[0] - 10 / (10 + 20 * 10**0.5)) < 1e-4
    worst, _, taken, share = worst_lag({i: 3_000 if i == 0 else 5 for i in range(4_001)}, {i: 0.5 if i == 0 else 0.5 / 4_000 for i in range(4_001)})
    assert worst < 1 and abs(taken[0] / taken.total() - 0.5) < 1e-3
    worst, slots, taken, _ = worst_lag({0: 40_000, 1: 40}, {0: 0.9999, 1: 0.0001})
    assert worst < 1 and taken[1] in (3, 4, 5) and slots >= 40_000


def test_small_weights_reach_the_rows(spark):
    got, _ = mixed(spark, {"a": 0.9997, "b": 0.0003}, {"a": 6_000, "b": 5}, block_rows=1, run_rows=512)
    assert sorted(r.mix_slot for r in got) == list(range(6_005))
    assert sum(r.source == "b" for r in got if r.mix_slot < 5_000) in (1, 2)


def test_places_and_repeats(spark):
    got, _ = mixed(spark, None, {"a": 130, "b": 65}, block_rows=64, run_rows=32)
    for s, n in (("a", 130), ("b", 65)):
        assert sorted(r.mix_block * 64 + r.mix_place for r in got if r.source == s) == list(range(n))


def test_messy_and_empty(spark):
    docs = messy.documents(spark)
    got = mixing.mix_sources(docs, block_rows=4)
    assert got.columns == [*docs.columns, "mix_block", "mix_slot", "mix_place"]
    assert sorted(map(str, (r[:16] for r in got.collect()))) == sorted(map(str, (tuple(r) for r in docs.collect())))
    none = mixing.mix_sources(messy.empty(spark))
    assert none.columns == got.columns and none.collect() == []
    with pytest.raises(ValueError, match="negative"):
        mixing.mix_sources(docs, {"hot": -1})
