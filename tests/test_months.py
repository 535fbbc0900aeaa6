"""Month bit maps against plain sets of months."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridledger.operators import first_month, gap_months, last_month, map_gaps, month_date, month_maps, months_of_year


def histories():
    rng, out = random.Random(11), {"one": [24_000], "border": [24_059, 24_060, 24_062]}
    for i in range(40):
        start = rng.randint(23_900, 24_200)
        out[f"k{i}"] = sorted({start + rng.randint(0, rng.choice([3, 20, 150])) for _ in range(rng.randint(1, 40))})
    return out


def day(number):
    return dt.date(number // 12, number % 12 + 1, 1)


@pytest.fixture(scope="module")
def booked(spark):
    rows = [(k, day(m), m % 2 == 0) for k, months in histories().items() for m in months for _ in range(m % 3 + 1)]
    return spark.createDataFrame(rows, "k string, d date, even boolean").repartition(5)


def test_first_last_and_months_of_the_year(booked):
    maps = month_maps(booked, ["k"], "d", {"every": F.lit(True), "even": F.col("even")})
    got = maps.groupBy("k").agg(
        month_date(F.min(first_month("every"))).alias("lo"), month_date(F.max(last_month("every"))).alias("hi"),
        F.bit_or(months_of_year("every")).alias("seen"), month_date(F.min(first_month("even"))).alias("even"),
    )
    want = {}
    for k, months in histories().items():
        even = [m for m in months if m % 2 == 0]
        seen = sum(1 << n for n in {m % 12 for m in months})
        want[k] = (day(months[0]), day(months[-1]), seen, day(even[0]) if even else None)
    assert {r.k: (r.lo, r.hi, r.seen, r.even) for r in got.collect()} == want


def test_gaps_of_every_key(booked):
    want = []
    for k, months in histories().items():
        for a, b in zip(months, months[1:], strict=False):
            want += [(k, day(m), day(a), b - a <= 4) for m in range(a + 1, b)]
    order = ["k", "MESE_BUCO", "PREV_DATA_DELIVERY", "RIEMPIBILE"]
    assert sorted(map(tuple, gap_months(booked, ["k"], "d", 4).select(*order).collect())) == sorted(want)
    # Maps that come in several rows per key are joined first.
    halves = month_maps(booked.withColumn("part", F.col("even")), ["k", "part"], "d", {"every": F.lit(True)})
    assert sorted(map(tuple, map_gaps(halves, ["k"], "every", 4).select(*order).collect())) == sorted(want)
    lo, hi = day(24_010), day(24_060)
    calendar = [day(m) for m in range(24_010, 24_061)]
    clipped = sorted(w for w in want if lo <= w[1] <= hi)
    assert sorted(map(tuple, gap_months(booked, ["k"], "d", 4, calendar).select(*order).collect())) == clipped


def test_a_day_inside_a_month_raises_and_nulls_are_left_out(spark):
    with pytest.raises(Exception, match="not the first day"):
        gap_months(spark.createDataFrame([("a", dt.date(2024, 1, 15))], "k string, d date"), ["k"], "d", 4).collect()
    rows = [("a", None), ("a", day(24_000)), ("a", day(24_002)), (None, day(24_000)), (None, day(24_002))]
    got = gap_months(spark.createDataFrame(rows, "k string, d date"), ["k"], "d", 4)
    assert sorted((r.k or "", r.MESE_BUCO) for r in got.collect()) == [("", day(24_001)), ("a", day(24_001))]
