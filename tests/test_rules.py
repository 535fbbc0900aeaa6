"""Hand-made cases of the business rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridledger import params as P
from gridledger.functions import (
    before_f,
    has_point,
    is_regular_offer,
    month_diff,
    party_key,
    strip_version,
    tender_agreement,
    tender_lot,
    usage_class,
)
from gridledger.params import ForecastParams


def one(spark, expr, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    "day, first, last, n",
    [
        (dt.date(2026, 12, 3), dt.date(2027, 1, 1), dt.date(2028, 12, 1), 24),
        (dt.date(2026, 12, 1), dt.date(2027, 1, 1), dt.date(2029, 1, 1), 25),
        (dt.date(2027, 1, 31), dt.date(2027, 2, 1), dt.date(2029, 12, 1), 35),
    ],
)
def test_calendar(day, first, last, n):
    months = ForecastParams(as_of=day).calendar
    assert (months[0], months[-1], len(months)) == (first, last, n)


def test_lapse_cutoff_crosses_the_year():
    assert ForecastParams(as_of=dt.date(2026, 2, 20)).lapse_cutoff == dt.date(2025, 11, 1)


@pytest.mark.parametrize(
    "vat, tax, hvat, htax, name, client, key, origin",
    [
        ("V", "T", "H", None, "N", "C", "V", P.ORIGIN_OFFER),
        (None, "T", "H", None, "N", "C", "T", P.ORIGIN_OFFER),
        ("ND", "T", "H", None, "N", "C", "H", P.ORIGIN_HOLDER),  # the sentinel hides a valid tax code
        ("***", None, "00000000000", "HT", "N", "C", "N", P.ORIGIN_NAME),
        (None, None, None, None, None, "C", "C", P.ORIGIN_NAME),
    ],
)
def test_party_key(spark, vat, tax, hvat, htax, name, client, key, origin):
    row = dict(
        P_IVA_OFFERTABILE=vat, COD_FISC_OFFERTABILE=tax, P_IVA_TITOLARE=hvat, COD_FISC_TITOLARE=htax,
        RAG_SOC_OFFERTABILE=name, CLIENTE=client,
    )
    k, o = party_key()
    assert one(spark, k, **row) == key
    assert one(spark, o, **row) == origin


@pytest.mark.parametrize(
    "point, real", [("IT1", True), ("DSB1", False), ("SA-9", False), ("ND", False), ("***", False), (None, False)]
)
def test_has_point(spark, point, real):
    assert one(spark, has_point("p"), p=point) is real


@pytest.mark.parametrize("code, regular", [("O1", True), ("O1F2", False), ("S-1", False), (None, None)])
def test_regular_offer_is_unknown_for_null(spark, code, regular):
    assert one(spark, is_regular_offer("c"), c=code) is regular


def test_month_difference_counts_boundaries(spark):
    assert one(spark, month_diff(F.to_date("a"), F.to_date("b")), a="2024-02-01", b="2024-01-31") == 1


def test_underscore_is_a_wildcard(spark):
    assert one(spark, F.col("c").like("%_PPA%"), c="PPA") is False
    assert one(spark, F.col("c").like("%_PPA%"), c="X_PPA") is True


@pytest.mark.parametrize("code, clean", [("O1_02A", "O1"), ("O1_01_02", "O1"), ("O_0_021", "O1"), ("O1", "O1")])
def test_strip_version_one_after_the_other(spark, code, clean):
    expected = code
    for s in P.VERSION_SUFFIXES:
        expected = expected.replace(s, "")
    assert one(spark, strip_version("c"), c=code) == expected
    if code != "O_0_021":
        assert expected == clean


def test_before_f(spark):
    assert one(spark, before_f("c"), c="O1F2") == "O1"
    assert one(spark, before_f("c"), c="O1") == "O1"


def test_tender_text(spark):
    assert one(spark, tender_agreement("s"), s="CON20L12") == "CONSIP20"
    assert one(spark, tender_lot("s"), s="CON20L12") == "12"
    assert one(spark, tender_agreement("s"), s="CON2880L18") == "CONSIP23"
    assert one(spark, tender_lot("s"), s="CON2880L18") == "18"
    assert one(spark, tender_agreement("s"), s="CONX") is None


@pytest.mark.parametrize("code, own, out", [("1", None, "DOM"), ("2", "X", "AU"), ("3", "X", "IP"), ("9", "X", "X"), (None, None, "AU")])
def test_usage_class(spark, code, own, out):
    assert one(spark, usage_class("c", "o"), c=code, o=own) == out
