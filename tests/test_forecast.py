"""Forecast cases on a small published table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import gridledger.plans.forecasting as plan
from gridledger import params as P
from gridledger.params import ForecastParams
from gridledger.plans import forecast
from gridledger.tables import MARGIN_PARTS, SELLER_COLUMNS

AS_OF = dt.date(2026, 12, 3)
MEASURES = [*MARGIN_PARTS, "BONUS_TOTALE_EUR", "MARGINE_TOTALE_EUR"]
TEXT = [
    "COMMODITY_G_E", "ID_OFFERTA", "ID_DETTAGLIO", "COD_OFFERTA", "FLG_PUBBLICATO_S_N", "PDP", "P_IVA_OFFERTABILE",
    "COD_FISC_OFFERTABILE", "RAG_SOC_OFFERTABILE", "P_IVA_TITOLARE", "COD_FISC_TITOLARE", "RAG_SOC_TITOLARE", "CLIENTE",
    *SELLER_COLUMNS,
]


def published(spark, cases):
    """Rows from (party, point, year, month, volume) plus overrides."""
    data = []
    for i, (party, point, year, month, volume, *more) in enumerate(cases):
        row = dict.fromkeys(TEXT) | {
            "COMMODITY_G_E": "E", "ID_OFFERTA": str(i), "ID_DETTAGLIO": str(i), "COD_OFFERTA": f"O{i}", "FLG_PUBBLICATO_S_N": "S",
            "PDP": point, "P_IVA_OFFERTABILE": party, "CLIENTE": party, "ACCOUNT_NEW": f"A{i}",
        } | (more[0] if more else {})
        data.append((*[row[c] for c in TEXT], dt.date(year, month, 1), float(volume), *[1.0] * len(MEASURES)))
    schema = ", ".join(f"{c} string" for c in TEXT) + ", DATA_DELIVERY date, VOLUME_COPERTO_MC_MWH double, "
    return spark.createDataFrame(data, schema + ", ".join(f"{m} double" for m in MEASURES))


def run(spark, cases, **kw):
    return forecast(published(spark, cases), ForecastParams(as_of=AS_OF, **kw)).cache()


def notes(df, **where):
    for c, v in where.items():
        df = df.where(F.col(c) == v)
    return sorted((r.DATA_DELIVERY.isoformat()[:7], r.NOTE_FORECAST, r.VOLUME_COPERTO_MC_MWH) for r in df.collect())


LIVE = [("V", None, 2026, m, 1) for m in range(1, 13)]


def test_booked_and_projected_volumes_meet(spark):
    # January 2027 is booked, and the January row of 2026 projects onto it, too, when it is the better rank.
    for booked, expect in ((84, P.NOTE_REPLACED), (85, P.NOTE_BOOKED)):
        out = run(spark, [*LIVE, ("V", None, 2026, 1, 99), ("V", None, 2027, 1, booked)], row_key=("ID_DETTAGLIO",))
        at = out.where("DATA_DELIVERY = date '2027-01-01'")
        kinds = {r.NOTE_FORECAST for r in at.collect()}
        assert expect in kinds, (booked, kinds)
        assert (P.NOTE_REPLACING in kinds) == (expect == P.NOTE_REPLACED)


def test_equal_volume_drops_the_projection(spark):
    cases = [*LIVE, ("V", None, 2027, 1, 50), ("V", None, 2028, 1, 50)]
    out = run(spark, cases)
    # 2028 is within tolerance of 2027 and is projected onto 2027, where it meets its own volume.
    assert notes(out, DATA_DELIVERY=dt.date(2027, 1, 1)) == [("2027-01", P.NOTE_BOOKED, 50.0)]


def test_point_blocked_by_other_commodity_unless_id_is_missing(spark):
    base = [("V", "IT1", 2026, m, 1) for m in range(10, 13)]
    blocked = run(spark, [*base, ("W", "IT1", 2027, 11, 1, {"COMMODITY_G_E": "G"})])
    assert notes(blocked, COMMODITY_G_E="E", DATA_DELIVERY=dt.date(2027, 11, 1)) == []
    open_ = run(spark, [*base, ("W", "IT1", 2027, 11, 1, {"COMMODITY_G_E": "G"}),
                        ("W", "IT1", 2027, 11, 1, {"COMMODITY_G_E": "G", "ID_OFFERTA": None})])
    assert [n[1] for n in notes(open_, COMMODITY_G_E="E", DATA_DELIVERY=dt.date(2027, 11, 1))] == [P.NOTE_PROJECTED]


def test_lapsed_customers_are_not_projected(spark):
    out = run(spark, [("V", None, 2026, 8, 1), ("V", None, 2026, 9, 1), ("W", None, 2026, 10, 1)])
    assert {n[1] for n in notes(out, PIVA_CFISC_FORECAST="V")} == {P.NOTE_LAPSED}
    assert P.NOTE_PROJECTED in {n[1] for n in notes(out, PIVA_CFISC_FORECAST="W")}


def test_gaps_are_filled_or_left_open(spark):
    short = run(spark, [("V", None, 2026, m, 1) for m in range(1, 13)] + [("V", None, 2027, 2, 1)])
    assert [n[1] for n in notes(short, DATA_DELIVERY=dt.date(2027, 1, 1))] == [P.NOTE_GAP]
    long = run(spark, [("V", None, 2026, m, 1) for m in range(1, 13)] + [("V", None, 2027, 6, 1)])
    assert notes(long, DATA_DELIVERY=dt.date(2027, 3, 1)) == []
    assert [n[1] for n in notes(long, DATA_DELIVERY=dt.date(2027, 7, 1))] == [P.NOTE_PROJECTED]


@pytest.mark.parametrize("point, kind", [(None, P.NEVER_POINT), ("IT9", P.ALWAYS_POINT)])
def test_missing_month_gets_the_mean(spark, point, kind):
    cases = [("V", point, 2026, m, m) for m in range(2, 13)]
    out = run(spark, cases)
    mean = out.where(F.col("PROIEZIONE_NOTE") == P.WHY_MEAN).orderBy("DATA_DELIVERY").collect()
    # No month before the first booked one, and January 2027 and 2028 are on the calendar.
    assert [r.DATA_DELIVERY for r in mean] == [dt.date(2027, 1, 1), dt.date(2028, 1, 1)]
    assert all(r.VOLUME_COPERTO_MC_MWH == sum(range(2, 13)) / 11 for r in mean)
    assert {r.PDP for r in mean} == {"ND"} and {r.TIPO_PIVA_CFISC_FORECAST for r in mean} == {kind}
    assert {r.ACCOUNT_NEW for r in mean} == {"A10"} and {r.COD_OFFERTA for r in mean} == {"O10"}


def test_null_and_adjustment_codes_do_not_classify(spark):
    out = run(spark, [("V", "IT1", 2026, 11, 1), ("V", None, 2026, 11, 1, {"COD_OFFERTA": None}), ("V", "ND", 2026, 12, 1, {"COD_OFFERTA": "S-1"})])
    assert {r.TIPO_PIVA_CFISC_FORECAST for r in out.collect()} == {P.ALWAYS_POINT}


def test_copies_stay_booked_and_project_once(spark):
    cases = [("V", None, 2026, 11, 5), ("V", None, 2026, 11, 5)]
    df = published(spark, cases[:1])
    out = forecast(df.union(df), ForecastParams(as_of=AS_OF))
    by_note = {r.NOTE_FORECAST: r.n for r in out.where("DATA_DELIVERY in (date '2026-11-01', date '2027-11-01')").groupBy("NOTE_FORECAST").agg(F.count("*").alias("n")).collect()}
    assert by_note == {P.NOTE_BOOKED: 2, P.NOTE_PROJECTED: 1}


def test_only_cells_with_copies_are_searched_for_them(spark):
    df = published(spark, [("V", None, 2026, 11, 5), ("V", None, 2026, 10, 5), ("V", None, 2026, 10, 5)])
    df = df.union(df.where("ID_DETTAGLIO = '0'"))
    params = ForecastParams(as_of=AS_OF)
    cells = plan.month_cells(plan.base_rows(df, params), params).collect()
    assert {r.DATA_DELIVERY.month: (r._n, r._copies) for r in cells} == {11: (2, True), 10: (2, False)}
    out = forecast(df, params).where("PROIEZIONE_NOTE IS NOT NULL AND year(DATA_DELIVERY) = 2027 AND month(DATA_DELIVERY) IN (10, 11)")
    assert sorted((r.DATA_DELIVERY.month, r.ID_DETTAGLIO) for r in out.collect()) == [(10, "1"), (10, "2"), (11, "0")]


def test_row_key_path_gives_the_same_rows(spark):
    cases = [(p, q, y, m, y % 7 + m) for p, q in (("V", None), ("W", "IT1"), ("X", "IT2"), ("X", None)) for y in (2025, 2026, 2027) for m in range(1, 12, 2)]
    a = run(spark, cases)
    b = run(spark, cases, row_key=("ID_DETTAGLIO",))
    assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0
    calendar = set(ForecastParams(as_of=AS_OF).calendar)
    projected = a.where(F.col("PROIEZIONE_NOTE").isNotNull()).select("DATA_DELIVERY").distinct().collect()
    assert {r.DATA_DELIVERY for r in projected} <= calendar


def test_exchanged_nulls_are_two_rows(spark):
    df = published(spark, [("V", None, 2026, 11, 10)])
    a = df.withColumn("P_IVA_TITOLARE", F.lit("X")).withColumn("COD_FISC_TITOLARE", F.lit(None).cast("string"))
    b = df.withColumn("P_IVA_TITOLARE", F.lit(None).cast("string")).withColumn("COD_FISC_TITOLARE", F.lit("X"))
    both = a.unionByName(b).unionByName(b)
    base = plan.base_rows(both, ForecastParams(as_of=AS_OF))
    cell = plan.month_cells(base, ForecastParams(as_of=AS_OF)).collect()
    assert [(r.VOLUME_DISTINTO, r.VOLUME_COPERTO_MC_MWH) for r in cell] == [(20.0, 30.0)]


def test_a_row_key_that_repeats_raises(spark):
    df = published(spark, [("V", None, 2026, 11, 10)])
    with pytest.raises(Exception, match="repeated key"):
        forecast(df.union(df), ForecastParams(as_of=AS_OF, row_key=("ID_DETTAGLIO",)))
