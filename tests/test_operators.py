"""Row updates, lookups, windows and sources on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridledger.operators import (
    append_common,
    assert_unique,
    attach_all,
    attach_range,
    count_distinct_over,
    diff_tables,
    exact_or_wildcard,
    expand_between,
    gap_months,
    keep_extreme,
    matched,
    merge_update,
    overlay,
    project_on_calendar,
    range_lookup,
    spread_join,
    top1,
    update_where,
)
from gridledger.sources import append_snapshot, changed_months, diff_published, publish, reset_status


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_update_keeps_rows_and_ignores_null_keys(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("a", 10), (None, 30)], "k string, v int")
    for split in (False, True):
        out = merge_update(target, source, ["k"], {"v": "s__v"}, split=split)
        assert rows(out) == rows(spark.createDataFrame([("a", 10), ("b", 2), (None, 3)], "k string, v int"))


def test_two_source_rows_for_one_target_raise(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("a", 10), ("a", 11), ("z", 1), ("z", 2)], "k string, v int")
    with pytest.raises(Exception, match="several rows"):
        merge_update(target, source, ["k"], {"v": "s__v"}).collect()
    unmatched = spark.createDataFrame([("b", 1)], "k string, v int")
    assert rows(merge_update(unmatched, source, ["k"], {"v": "s__v"})) == [("b", 1)]


def test_duplicates_outside_the_condition_are_no_error(spark):
    target = spark.createDataFrame([("a", 1, "G"), ("b", 2, "E")], "k string, v int, g string")
    source = spark.createDataFrame([("a", 10), ("a", 11), ("b", 20)], "k string, v int")
    assert rows(merge_update(target, source, ["k"], {"v": "s__v"}, "g = 'E'")) == [("a", 1, "G"), ("b", 20, "E")]
    with pytest.raises(Exception, match="several rows"):
        merge_update(target, source, ["k"], {"v": "s__v"}, "g = 'G'").collect()


def test_update_reads_old_values(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert rows(update_where(df, "true", {"a": "b", "b": "a + b"})) == [(2.0, 3.0)]


def test_overlay_prefers_either_side(spark):
    target = spark.createDataFrame([("a", "x", None)], "k string, u string, v string")
    source = spark.createDataFrame([("a", "y", "z")], "k string, u string, v string")
    assert rows(overlay(target, source, ["k"], ["u", "v"])) == [("a", "y", "z")]
    assert rows(overlay(target, source, ["k"], ["u", "v"], prefer="target")) == [("a", "x", "z")]


def test_attach_all_keeps_sources_apart(spark):
    target = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    one = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    two = spark.createDataFrame([("b", 3)], "k string, v int")
    out = attach_all(target, {"one": one, "two": two}, {"k": "k"}, split=True)
    got = rows(out.select("k", "one__v", "one__hit", "two__v", "two__hit"))
    assert got == [("a", 1, True, None, False), ("b", 2, True, 3, True), ("c", None, False, None, False)]


def test_overlapping_versions_raise_only_where_both_hold(spark):
    d = dt.date
    versions = spark.createDataFrame(
        [("a", d(2024, 1, 1), d(2024, 6, 30), 1), ("a", d(2024, 6, 1), d(2024, 12, 31), 2)], "k string, lo date, hi date, v int"
    )

    def at(day):
        target = spark.createDataFrame([("a", day)], "k string, d date")
        return attach_range(target, versions, ["k"], "d", "lo", "hi", "s").where(matched("s")).select("s__v").collect()

    assert at(d(2024, 5, 1))[0][0] == 1
    assert at(d(2024, 7, 1))[0][0] == 2
    assert at(d(2025, 7, 1)) == []
    with pytest.raises(Exception, match="several rows"):
        at(d(2024, 6, 15))


def test_range_lookup_finds_every_version_that_holds_the_date(spark):
    start, rng = dt.date(2020, 1, 1), random.Random(3)
    versions = [(None, start, start, 1), ("a", None, start, 2), ("a", start + dt.timedelta(9), start, 3)]
    for key, count, longest in (("a", 1, 0), ("b", 7, 5), ("c", 40, 15), ("overlapping", 12, 30)):
        at = 0
        for i in range(count):
            lo = at + rng.randint(0, 20)
            hi = lo + rng.randint(0, longest)
            at = lo if key == "overlapping" else hi + 1
            versions.append((key, start + dt.timedelta(lo), start + dt.timedelta(hi), i))
    days = [None if i % 50 == 0 else start + dt.timedelta(rng.randint(-5, 500)) for i in range(600)]
    target = [(rng.choice(["a", "b", "c", "overlapping", "z", None]), day, i) for i, day in enumerate(days)]
    expected = []
    for key, day, i in target:
        held = [v for k, lo, hi, v in versions if key is not None and k == key and lo and day and lo <= day <= hi]
        expected += [(i, v) for v in held] or [(i, None)]
    left = spark.createDataFrame(target, "k string, d date, i int")
    right = spark.createDataFrame(versions, "k string, lo date, hi date, v int")
    for split in (False, True):
        assert rows(range_lookup(left, right, ["k"], "d", "lo", "hi", "s", split).select("i", "s__v")) == sorted(expected, key=str)
    assert rows(range_lookup(left, right.limit(0), ["k"], "d", "lo", "hi", "s").select("i", "s__v")) == sorted(
        [(i, None) for i in range(600)], key=str
    )


def test_spread_join_splits_hot_keys_and_keeps_all_rows(spark):
    left = spark.range(200).select(
        F.when(F.col("id") < 120, "hot").when(F.col("id") < 150, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    side = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    for spread in (None, ["id"]):
        out = spread_join(left, side, ["k"], "n", "inner", rows_per_task=7, spread_by=spread)
        assert out.count() == 200
        assert out.where("k = 'hot'").agg(F.min("top"), F.max("top")).first()[:] == (119, 119)
        assert out.where("k is null").count() == 30


def test_group_helpers_equal_windows(spark):
    df = spark.range(300).select(
        (F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("v"), F.when(F.col("id") % 11 > 0, F.col("id") % 5).alias("w")
    )
    w = Window.partitionBy("g")
    assert rows(keep_extreme(df, ["g"], "v", rows_per_task=10)) == rows(
        df.withColumn("r", F.dense_rank().over(w.orderBy(F.desc("v")))).where("r = 1").drop("r")
    )
    assert rows(count_distinct_over(df, ["g"], "w", "n", rows_per_task=10)) == rows(
        df.withColumn("n", F.size(F.collect_set("w").over(w)).cast("long"))
    )


def test_top1_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", None, "z")], "k string, v int, t string")
    assert rows(top1(df, ["k"], ["v", "t"], ["t"])) == [("a", "y")]


def test_gaps(spark):
    d = dt.date
    df = spark.createDataFrame(
        [("k", d(2027, 1, 1)), ("k", d(2027, 3, 1)), ("k", d(2027, 9, 1)), ("k", d(2027, 9, 1))], "k string, m date"
    )
    months = [d(2027, m, 1) for m in range(2, 7)]
    got = rows(gap_months(df, ["k"], "m", 4, months).select("MESE_BUCO", "RIEMPIBILE"))
    assert got == [(d(2027, 2, 1), True), (d(2027, 4, 1), False), (d(2027, 5, 1), False), (d(2027, 6, 1), False)]


def test_expand_between_is_strict_for_days_inside_a_month(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2024, 1, 15), d(2024, 3, 15)), (d(2024, 1, 1), d(2024, 2, 1))], "lo date, hi date")
    assert rows(expand_between(df, "lo", "hi", "m").select("m")) == [(d(2024, 2, 1),), (d(2024, 3, 1),)]


def test_projection_hits_every_year(spark):
    d = dt.date
    months = [d(2027 + i // 12, i % 12 + 1, 1) for i in range(1, 24)]
    df = spark.createDataFrame([(d(2026, 1, 1),), (d(2027, 2, 1),)], "m date")
    got = rows(project_on_calendar(df, "m", months, "t", skip_own=True))
    assert got == [(d(2026, 1, 1), d(2028, 1, 1)), (d(2027, 2, 1), d(2028, 2, 1))]


def test_id_or_wildcard(spark):
    target = spark.createDataFrame([(1, "a", "-"), (2, "a", "-"), (3, "b", "-")], "id int, k string, v string")
    source = spark.createDataFrame([(1, None, "x"), (None, "b", "y")], "id int, k string, v string")
    assert rows(exact_or_wildcard(target, source, ["id"], ["k"], ["v"])) == [(1, "a", "x"), (2, "a", "-"), (3, "b", "y")]
    both = spark.createDataFrame([(1, None, "x"), (None, "a", "y")], "id int, k string, v string")
    with pytest.raises(Exception, match="by id and by key"):
        exact_or_wildcard(target, both, ["id"], ["k"], ["v"]).collect()


def test_append_common_and_unique(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2, 9)], "a int, c int")
    assert rows(append_common(a, b)) == [(1, "x"), (2, None)]
    with pytest.raises(Exception, match="repeated key"):
        assert_unique(a.union(a), ["a"]).collect()


def test_diff_lists_only_failures(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 1.0)], "id int, m double")
    b = spark.createDataFrame([(1, 10.4), (2, 7.0)], "id int, m double")
    out = diff_tables(a, b, ["id"], ["m"], failing="m").select("id", "DELTA_m", "CHECK_m")
    assert rows(out) == [(2, -2.0, "KO")]


MONTHS = "case when id % 4 < 3 then date '2024-01-01' + make_interval(0, cast(id % 4 as int)) end"


def test_publish_and_snapshots(spark, tmp_path):
    df = spark.range(50).select("id", F.expr(MONTHS).cast("date").alias("DATA_DELIVERY"))
    publish(df, str(tmp_path / "p"), cluster_by=["id"])
    assert len(list((tmp_path / "p").glob("DATA_DELIVERY=*"))) == 4
    assert rows(spark.read.parquet(str(tmp_path / "p"))) == rows(df)
    for day in (1, 2, 2):
        append_snapshot(df, str(tmp_path / "h"), dt.date(2024, 5, day))
    history = spark.read.parquet(str(tmp_path / "h")).groupBy("DATA_LANCIO").count().collect()
    assert sorted(r["count"] for r in history) == [df.count()] * 2


def test_publish_writes_changed_months_and_runs_its_input_once(spark, tmp_path):
    path, seen = str(tmp_path / "p"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(60).select("id", F.expr(MONTHS).cast("date").alias("DATA_DELIVERY"), F.lit(1).alias("v"))
    first = publish(df.mapInArrow(counted, df.schema), path, totals={"n": F.count(F.lit(1)), "v": F.sum("v")})
    assert (first["n"], first["v"], seen.value, len(first["months"])) == (60, 60, 60, 4)
    files = {str(f.relative_to(path)) for f in (tmp_path / "p").rglob("part-*") if "_months" not in str(f)}

    again = publish(df.select("v", "DATA_DELIVERY", "id"), path)
    assert again["months"] == []
    # February changes a value, the rows without month change, March goes, a copy is added in January.
    changed = df.withColumn("v", F.when(F.expr("id = 1 or DATA_DELIVERY is null"), 2).otherwise(F.col("v")))
    changed = changed.where("DATA_DELIVERY is null or month(DATA_DELIVERY) < 3").unionByName(df.where("id = 4"))
    written = publish(changed, path)["months"]
    assert written == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), None]
    assert rows(spark.read.parquet(path).select("id", "DATA_DELIVERY", "v")) == rows(changed)
    left = {str(f.relative_to(path)) for f in (tmp_path / "p").rglob("part-*") if "_months" not in str(f)}
    assert not files & left

    # Only one month changes: the others keep their files.
    publish(changed.where("not id <=> 5"), path)
    kept = {str(f.relative_to(path)) for f in (tmp_path / "p").rglob("part-*") if "_months" not in str(f)}
    assert {f.split("/")[0] for f in left - kept} == {"DATA_DELIVERY=2024-02-01"}

    # A run that stopped before its digests were written is done over as a whole.
    for f in (tmp_path / "p" / "_months" / "digests").iterdir():
        f.unlink()
    assert len(publish(df, path)["months"]) == 4
    assert rows(spark.read.parquet(path).select("id", "DATA_DELIVERY", "v")) == rows(df)


def test_versions_are_compared_by_changed_month(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    df = spark.range(60).select("id", F.expr(MONTHS).cast("date").alias("DATA_DELIVERY"), F.lit(1.0).alias("v"))
    publish(df, old)
    publish(df.withColumn("v", F.when(F.col("id").isin(1, 9), 4.0).otherwise(F.col("v"))), new)
    assert changed_months(spark, old, new) == [dt.date(2024, 2, 1)]
    diff = diff_published(spark, old, new, ["id"], ["v"], "v")
    assert [(r.id, r.DELTA_v) for r in diff.collect()] == [(1, -3.0), (9, -3.0)]
    # Other months' files are never read.
    for f in (tmp_path / "old" / "DATA_DELIVERY=2024-01-01").glob("*"):
        f.write_bytes(b"")
    assert diff.count() == 2
    with pytest.raises(ValueError):
        changed_months(spark, old, str(tmp_path / "none"))


def test_reset_status(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "STATO int")
    assert rows(reset_status(df)) == [(0,), (0,), (2,)]
