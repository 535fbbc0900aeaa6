"""What a plan moves and writes, on rows built here."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gridledger.session import Workspace, tune


@pytest.fixture
def shuffled(spark):
    """Joins shuffle as they do on large tables, and plans keep their partitions."""
    tune(spark)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_request_code_spread_over_tasks(shuffled):
    from gridledger.plans.keyset import add_usage_class

    core = shuffled.range(800).select(
        F.col("id").alias("ID_OFFERTA"), F.concat(F.lit("O"), "id").alias("COD_OFFERTA"), F.lit("P").alias("COD_OPPORTUNITY_CORRETTO"),
        F.lit("MMK").alias("SISTEMA"), F.lit("X").alias("TIPOLOGIA_USO"))
    schema = "CODICE_OFFERTA string, CODICE_OPPORTUNITY string, EXPIRY_TS timestamp, FK_STATI_PRATICHE bigint, TIPOLOGIA_PDR string"
    out = add_usage_class(core, shuffled.createDataFrame([("O1", "P", None, 99, "0")], schema))
    assert out.where("TIPOLOGIA_USO = 'X'").count() == 800
    most = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 300


def test_wide_key_rows_are_not_moved_again(shuffled):
    """The distinct runs where offers and details were joined."""
    from gridledger.catalog.keysets import key_set

    # The coefficients are few at any size, which adaptive execution measures.
    shuffled.conf.set("spark.sql.autoBroadcastJoinThreshold", "30k")
    shuffled.conf.set("spark.sql.adaptive.enabled", "true")
    out = key_set(shuffled, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
    out.collect()
    final = _plan(out).split("Initial Plan")[0]
    top = [x for x in final.splitlines() if "HashAggregate" in x or "Exchange" in x]
    assert "HashAggregate" in top[0] and "HashAggregate" in top[1]


def test_lines_are_shuffled_once_to_their_order_and_party(shuffled):
    from gridledger.catalog.registry import load

    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    shuffled.conf.set("spark.sql.shuffle.partitions", "8")
    plan = _plan(load(shuffled, path, "published").select("ID_DETTAGLIO", "P_IVA_OFFERTABILE"))
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in x]
    assert len(moved) == 1
    under = plan[plan.index(moved[0]) :]
    assert "orders" in under and "lineitem" not in under


def test_cells_carry_what_a_query_reads(shuffled):
    import gridledger.plans.forecasting as plan
    from gridledger.catalog import forecast_sql as S
    from gridledger.catalog.registry import load

    base = plan.base_rows(load(shuffled, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"), "published"), S.RUN)
    few = plan.month_cells(base, S.RUN, (plan.VOLUME,), ())
    assert set(few.columns) == {*plan.CELL, "_n", "VOLUME_DISTINTO", plan.VOLUME, "TUTTI_ID"}
    both = plan.month_cells(base, S.RUN).select(*few.columns)
    assert few.exceptAll(both).count() == both.exceptAll(few).count() == 0


def test_rows_without_a_key_are_told_apart_by_two_numbers(shuffled):
    from gridledger.operators import row_digests

    import gridledger.plans.forecasting as plan
    from gridledger.catalog import forecast_sql as S
    from gridledger.catalog.registry import load

    base = plan.base_rows(load(shuffled, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"), "published_twice"), S.RUN_NO_KEY)
    assert "sha2" not in _plan(plan.month_cells(base, S.RUN_NO_KEY))
    rows = [("x", None, 0.0), ("x", None, -0.0), (None, "x", 0.0), ("", "x", 0.0), ("x", None, None)]
    df = shuffled.createDataFrame(rows, "a string, b string, v double")
    got = [tuple(r) for r in df.select(*row_digests(df.columns)).collect()]
    assert got[0] == got[1] and len(set(got)) == 4 and all(isinstance(h, int) for g in got for h in g)


def test_wide_lines_join_what_their_offer_has_found(shuffled):
    from gridledger.catalog.registry import load

    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    plan = _plan(load(shuffled, path, "wide_rows").select("ID_DETTAGLIO", "CONTRATTO_OLD"))
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in x]
    assert moved and "l_linenumber" not in plan[plan.index(moved[0]) :].split("Exchange hashpartitioning(l_orderkey")[0]


def test_a_first_publication_is_written_once(shuffled, tmp_path):
    from gridledger.sources import publish

    work = Workspace(shuffled)
    rows = shuffled.createDataFrame([(1, dt.date(2001, 1, 1)), (2, dt.date(2001, 2, 1)), (2, None)], "v long, DATA_DELIVERY date")
    path = str(tmp_path / "t")
    done = publish(rows, path, totals={"n": F.count(F.lit(1))}, work=work)
    assert done == {"n": 3, "months": [dt.date(2001, 1, 1), dt.date(2001, 2, 1), None]}
    assert os.listdir(work.path) == []
    assert sorted(map(str, shuffled.read.parquet(path).select("v", "DATA_DELIVERY").collect())) == sorted(map(str, rows.collect()))
    # The same rows again leave every month as it is, copies counted.
    assert publish(rows, path, work=work)["months"] == []
    assert publish(rows.union(rows.where("v = 1")), path, work=work)["months"] == [dt.date(2001, 1, 1)]


def test_only_changing_rows_meet_the_sums_of_former_offers(shuffled):
    from gridledger.plans.margins import net_predecessors
    from gridledger.tables import MASTER_SCHEMA

    names = {"ID_OFFERTA": "o", "ID_DETTAGLIO": "d", "COD_OFFERTA": "N", "CONTRATTO_OLD": "A", "PDP": "p", "INDICE": "i"}
    rows = [(f"{i}", f"d{i}", "A" if i else "N", None if i else "A", "p", "i", 7 if i else 1) for i in range(4)]
    given = shuffled.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + ", TIPO_CONTRATTO bigint")
    wide = given.select(*[
        F.col(f.name) if f.name in given.columns else F.lit(dt.date(2001, 1, 1)).alias(f.name) if f.name == "DATA_DELIVERY"
        else F.lit(2.0).alias(f.name) if f.dataType.simpleString() == "double" else F.lit(None).cast(f.dataType).alias(f.name)
        for f in MASTER_SCHEMA.fields])
    kinds = shuffled.createDataFrame([(1, "CP001"), (7, "x")], "ID_TIPO_CONTRATTO bigint, DESC_TIPO_CONTRATTO string")
    wide = Workspace(shuffled).stage(wide, "wide")
    out = net_predecessors(wide, kinds, "CP001")
    assert "Union" in _plan(out)
    got = {r.ID_OFFERTA: r for r in out.collect()}
    assert len(got) == 4 and out.columns == wide.columns
    assert got["0"].CCR_EUR == 2.0 - 3 * 2.0 and all(got[str(i)].CCR_EUR == 2.0 for i in (1, 2, 3))


def _joins(node):
    found = [node] if node.nodeName() == "Join" else []
    children = node.children()
    return found + [j for i in range(children.size()) for j in _joins(children.apply(i))]


def test_joins_of_the_margin_table_carry_few_columns(shuffled):
    from gridledger.params import MasterParams
    from gridledger.plans.margins import attach_sources
    from gridledger.tables import KEYS_SCHEMA, UNIT_COLUMNS

    keys = shuffled.createDataFrame([], KEYS_SCHEMA)
    wide = shuffled.range(0).selectExpr("CAST(id AS STRING) AS ID_DETTAGLIO", *[f"1D AS {c}" for c in UNIT_COLUMNS])
    t = {"unit_costs": wide, "prices": wide.withColumn("p", F.lit("x")), "fixing": wide.withColumn("f", F.lit("y"))}
    df = attach_sources(keys, t, MasterParams(as_of=dt.date(2026, 12, 3)))
    read = df.selectExpr("*", *[f"{n}.{UNIT_COLUMNS[0]} AS _{n}" for n in t]).drop(*t)
    joins = _joins(read._jdf.queryExecution().optimizedPlan())
    assert len(joins) == 3 and max(j.output().size() for j in joins) < 20


def test_an_import_is_joined_before_rows_are_wide(shuffled):
    from gridledger.params import MasterParams
    from gridledger.plans import master
    from gridledger.tables import KEYS_SCHEMA

    base = dict.fromkeys(KEYS_SCHEMA.names) | {"COD_OFFERTA": "O1", "DATA_DELIVERY": dt.date(2001, 1, 1), "FLG_PUBBLICATO_S_N": "S"}
    stamp = dt.datetime(2001, 2, 1)
    given = [base | {"ID_OFFERTA": "1", "ID_DETTAGLIO": d, "DATA_COPERTURA": t} for d, t in (("a", None), ("b", stamp), ("c", None))]
    keys = shuffled.createDataFrame([tuple(r[n] for n in KEYS_SCHEMA.names) for r in given], KEYS_SCHEMA)
    bulk = shuffled.createDataFrame(
        [("1", "a", "O2", None, stamp, "s"), (None, None, "O1", dt.date(2001, 1, 1), stamp, "t")],
        "ID_OFFERTA string, ID_DETTAGLIO string, COD_OFFERTA string, DATA_DELIVERY date, DATA_COPERTURA timestamp, VENDITORE string")
    flags = shuffled.createDataFrame(
        [("O2", stamp, "N", None), ("O1", stamp, "X", None)],
        "COD_OFFERTA string, DATA_COPERTURA timestamp, FLG_PUBBLICATO_S_N string, DATA_PUBBLICAZIONE_FUTURA date")
    out = master(keys, {"bulk_import": bulk, "published_flags": flags}, MasterParams(as_of=dt.date(2026, 12, 3)))
    # Only reversals and their parents meet after the table was written.
    wide = [j for j in _joins(out._jdf.queryExecution().optimizedPlan()) if j.output().size() > 100]
    assert len(wide) == 1
    got = {r.ID_DETTAGLIO: (r.COD_OFFERTA, r.VENDITORE, r.FLG_PUBBLICATO_S_N) for r in out.collect()}
    assert got == {"a": ("O2", "s", "N"), "b": ("O1", "t", "X"), "c": ("O1", None, "S")}


def test_packed_sources_unpack_to_the_same_columns(spark):
    from gridledger.operators import attach, matched, unpack

    target = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    source = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    packed = attach(target, source, ["k"], "s", packed=True)
    assert packed.columns == ["k", "s"]
    both = [unpack(packed, "s", "t"), attach(target, source, ["k"], "s", split=True)]
    got = [{(r.k, r.s__v, r.m) for r in df.withColumn("m", matched("s")).collect()} for df in both]
    assert got[0] == got[1] == {("a", 1, True), ("b", None, False), (None, None, False)}
    twice = source.union(source)
    with pytest.raises(Exception, match="several rows"):
        unpack(attach(target, twice, ["k"], "s", packed=True), "s").where(matched("s")).collect()


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    from gridledger.session import Workspace

    sizes = []
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    for _ in range(2):
        before = tracker.shuffleStatuses().size()
        Workspace(spark).stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t")
        sizes.append(tracker.shuffleStatuses().size() - before)
    assert max(sizes) <= 0


def test_lookups_of_the_key_set_are_written_before_wide_rows_are_formed(shuffled):
    """Their shuffle files are gone then: the last step moves offers and details once."""
    from gridledger.catalog.keysets import key_set

    work = Workspace(shuffled)
    shuffled.conf.set("spark.sql.autoBroadcastJoinThreshold", "30k")
    out = key_set(shuffled, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"), work=work)
    assert sorted(os.listdir(work.path)) == ["coefficients", "found_offers", "priced_details"]
    moved = [x for x in _plan(out).splitlines() if "Exchange hashpartitioning" in x]
    assert len(moved) == 3 and sum("TENSIONE" in x.split("hashpartitioning")[1][:20] for x in moved) == 1


def test_related_parties_are_found_before_rows_are_wide(shuffled):
    """After the table was written, only reversals are moved to meet parties, since they may take their parent's vat number."""
    from gridledger.params import MasterParams, RelatedPartyRules
    from gridledger.plans import master
    from gridledger.plans.margins import attach_sources
    from gridledger.tables import KEYS_SCHEMA

    base = dict.fromkeys(KEYS_SCHEMA.names) | {"DATA_DELIVERY": dt.date(2001, 1, 1), "FLG_PUBBLICATO_S_N": "S", "COMMODITY_G_E": "G"}
    given = [("1", "a", "O1", "P1", None), ("1", "b", "O1", "P2", None), ("2", "c", "S-1", None, "O1"), ("3", "d", "S-2", None, "O2"), ("4", "e", "O2", "ND", None)]
    rows = [base | dict(zip(("ID_OFFERTA", "ID_DETTAGLIO", "COD_OFFERTA", "PDP", "OFFERTA_STORNO_FIXING"), r)) for r in given]
    keys = shuffled.createDataFrame([tuple(r[n] for n in KEYS_SCHEMA.names) for r in rows], KEYS_SCHEMA)
    customers = shuffled.createDataFrame(
        [("O1", "P1", None, "x"), ("O1", "NO_PDP", "V1", None), ("S-2", "NO_PDP", "V2", None), ("O2", "NO_PDP", "V1", None)],
        "COD_OFFERTA string, PDP string, P_IVA_OFFERTABILE string, COD_ATECO_OFFERTABILE string")
    kinds = shuffled.createDataFrame([("k", "Reseller")], "PK_TIPI_SOGGETTI string, TIPO_SOGGETTO_DESCR string")
    parties = shuffled.createDataFrame(
        [("V1", "one", "k", None), ("V2", "two", "k", None)],
        "PARTITA_IVA string, RAGIONE_SOCIALE string, FK_TIPI_SOGGETTI string, EXPIRY_TS timestamp")
    rules = RelatedPartyRules(group_vats=("V9",), group_area="g", intercompany_seller="s", intercompany_manager="m", reseller_manager="r")
    t, run = {"customers": customers, "party_types": kinds, "parties": parties}, MasterParams(as_of=dt.date(2026, 12, 3), related=rules)
    out = master(keys, t, run)
    wide = [j.toString() for j in _joins(out._jdf.queryExecution().optimizedPlan()) if j.output().size() > 100]
    assert len(wide) == 2 and not any("Union" in j for j in wide)
    got = {r.ID_DETTAGLIO: (r.P_IVA_OFFERTABILE, r.CLIENTE) for r in out.collect()}
    assert got == {"a": ("V1", "one"), "b": ("V1", "one"), "c": ("V1", "one"), "d": ("V2", "two"), "e": ("V1", "one")}
    # Files of earlier joins are gone once the rows they formed are written.
    work = Workspace(shuffled)
    attach_sources(keys, t, run, work)
    assert os.listdir(work.path) == ["customers"]


def test_the_last_booked_month_comes_with_the_points(shuffled):
    """Cells know the last month of their key, so they aren't grouped and joined for it."""
    import gridledger.plans.forecasting as plan
    from gridledger.params import ForecastParams
    from gridledger.tables import SELLER_COLUMNS

    run = ForecastParams(as_of=dt.date(2001, 1, 15))
    days = [("A", "IT1", dt.date(2001, 1, 1)), ("A", "IT1", dt.date(2001, 3, 1)), ("B", "IT1", dt.date(2001, 2, 1)), ("C", "IT2", dt.date(1995, 1, 1))]
    rows = shuffled.createDataFrame([("G", *d, "O1", 2.0) for d in days], f"{plan.G} string, {plan.PARTY} string, PDP string, {plan.DATE} date, COD_OFFERTA string, {plan.VOLUME} double")
    base = rows.select("*", *[F.lit("s").alias(c) for c in SELLER_COLUMNS])
    booked = plan.with_regular(rows)
    points = plan.customers(plan.point_months(booked), run, Workspace(shuffled))
    last = {r[plan.PARTY]: r.ULTIMA_DATA for r in points.collect()}
    assert last == {"A": dt.date(2001, 3, 1), "B": dt.date(2001, 3, 1), "C": None}
    cells = Workspace(shuffled).stage(plan.classify(booked.select(*plan.CELL, F.lit(1).cast("bigint").alias("_n")), points), "cells")
    out = plan.last_booked_rows(base, cells)
    assert len(_joins(out._jdf.queryExecution().optimizedPlan())) == 2
    assert [(r[plan.KEY], r[plan.VOLUME]) for r in out.collect()] == [("IT1", 2.0)]


def test_mean_rows_meet_their_own_months_only(shuffled):
    import gridledger.plans.forecasting as plan

    text = [*plan.IDENTITY, *plan.ORIGIN]
    known = [("G", "k", dt.date(2001, m, 1), *[f"{m}"] * 6) for m in (1, 3)]
    cells = shuffled.createDataFrame(known, f"{plan.G} string, {plan.KEY} string, {plan.DATE} date, " + ", ".join(f"{c} string" for c in text))
    means = shuffled.createDataFrame([("G", "k", dt.date(2001, 2, 1))], f"{plan.G} string, {plan.KEY} string, {plan.DATE} date")
    out = plan.enrich_means(means, cells.withColumnRenamed(plan.DATE, "MESE_PROIETTATO").where("false"), cells)
    assert "_own" not in out.columns and [tuple(r[c] for c in text) for r in out.collect()] == [("3", "3", "3", "1", "1", "1")]
    top = _joins(out._jdf.queryExecution().optimizedPlan())[0].toString()
    assert any("Filter" in x and "_own" in x for x in top.splitlines())
