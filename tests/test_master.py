"""Margin-table cases on a few rows."""

import datetime as dt

import pytest

from gridledger.params import MasterParams
from gridledger.plans import master
from gridledger.plans.margins import apply_layer, on
from gridledger.tables import KEYS_SCHEMA, UNIT_COLUMNS

RUN = MasterParams(as_of=dt.date(2026, 12, 3))
MONTH = dt.date(2026, 1, 1)


def keys(spark, *rows):
    base = dict.fromkeys(KEYS_SCHEMA.names) | {"DATA_DELIVERY": MONTH, "FLG_PUBBLICATO_S_N": "S", "NUMERO_PDP": 1}
    return spark.createDataFrame([tuple((base | r)[n] for n in KEYS_SCHEMA.names) for r in rows], KEYS_SCHEMA)


def costs(spark, *rows):
    return spark.createDataFrame(
        [tuple(r) for r in rows], "ID_DETTAGLIO string, COSTO_MP_CEURMC_EURMWH double, VALORE_INDICE_VEND_CEURMC_EURMWH double"
    )


def by_row(df):
    return {r.ID_DETTAGLIO: r for r in df.collect()}


def test_gas_amounts_are_in_cents(spark):
    k = keys(spark, *[
        {"ID_OFFERTA": "1", "ID_DETTAGLIO": d, "COD_OFFERTA": "O1", "COMMODITY_G_E": c, "VOLUME_COPERTO_MC_MWH": 200.0}
        for d, c in (("g", "G"), ("e", "E"))
    ])
    out = by_row(master(k, {"unit_costs": costs(spark, ("g", 30.0, None), ("e", 30.0, None))}, RUN))
    assert out["g"].COSTO_MP_EUR == 60.0 and out["e"].COSTO_MP_EUR == 6000.0
    assert out["g"].MARGINE_TOTALE_EUR == 0.0 and out["g"].MARGINE_TOTALE_CEURMC_EURMWH is None


def test_reversals_inherit_once(spark):
    k = keys(
        spark,
        {"ID_OFFERTA": "1", "ID_DETTAGLIO": "a", "COD_OFFERTA": "O1", "COMMODITY_G_E": "G", "VOLUME_COPERTO_MC_MWH": 100.0},
        {"ID_OFFERTA": "2", "ID_DETTAGLIO": "b", "COD_OFFERTA": "S-1", "OFFERTA_STORNO_FIXING": "O1", "COMMODITY_G_E": "G", "VOLUME_COPERTO_MC_MWH": -100.0},
        {"ID_OFFERTA": "3", "ID_DETTAGLIO": "c", "COD_OFFERTA": "S-S-1", "OFFERTA_STORNO_FIXING": "S-1", "COMMODITY_G_E": "G", "VOLUME_COPERTO_MC_MWH": 100.0},
    )
    out = by_row(master(k, {"unit_costs": costs(spark, ("a", 30.0, 5.0), ("b", 99.0, 9.0), ("c", 98.0, 9.0))}, RUN))
    assert out["b"].COSTO_MP_CEURMC_EURMWH == 30.0 and out["b"].COSTO_MP_EUR == -30.0
    assert all(out["c"][x] is None for x in UNIT_COLUMNS)


def test_ambiguous_parent_raises(spark):
    rows = [
        {"ID_OFFERTA": "1", "ID_DETTAGLIO": d, "COD_OFFERTA": "O1", "PDP": p, "COMMODITY_G_E": "G"} for d, p in (("a", "P1"), ("b", "P2"))
    ]
    rows.append({"ID_OFFERTA": "2", "ID_DETTAGLIO": "c", "COD_OFFERTA": "S-1", "OFFERTA_STORNO_FIXING": "O1", "COMMODITY_G_E": "G"})
    customers = spark.createDataFrame([("O1", "P1", "V1"), ("O1", "P2", "V2")], "COD_OFFERTA string, PDP string, P_IVA_OFFERTABILE string")
    with pytest.raises(Exception, match="several rows"):
        master(keys(spark, *rows), {"customers": customers}, RUN).collect()


def test_published_flags_in_order(spark):
    stamp = dt.datetime(2026, 1, 5)
    k = keys(spark, *[
        {"ID_OFFERTA": c, "ID_DETTAGLIO": c, "COD_OFFERTA": c, "COMMODITY_G_E": "E", "DATA_COPERTURA": stamp} for c in ("A", "B", "MMK1", "C")
    ])
    flags = spark.createDataFrame(
        [("A", stamp, "N", None), ("B", stamp, "N", None), ("B", stamp, "S", RUN.as_of), ("C", stamp, "N", dt.date(2027, 1, 1))],
        "COD_OFFERTA string, DATA_COPERTURA timestamp, FLG_PUBBLICATO_S_N string, DATA_PUBBLICAZIONE_FUTURA date",
    )
    out = by_row(master(k, {"published_flags": flags}, RUN))
    assert {d: r.FLG_PUBBLICATO_S_N for d, r in out.items()} == {"A": "N", "B": "S", "MMK1": "N", "C": "S"}


def test_manual_and_imported_rows(spark):
    manual = keys(spark, {"ID_OFFERTA": "IMP7", "ID_DETTAGLIO": "m"}).select("ID_OFFERTA", "ID_DETTAGLIO", "DATA_DELIVERY", "FLG_PUBBLICATO_S_N")
    from gridledger.plans.margins import MANUAL

    for c in MANUAL.values():
        if c not in manual.columns:
            manual = manual.selectExpr("*", f"CAST(NULL AS STRING) AS {c}")
    out = by_row(master(keys(spark, {"ID_OFFERTA": "1", "ID_DETTAGLIO": "a", "COD_OFFERTA": "O1"}), {"manual_rows": manual}, RUN))
    assert out["m"].COD_OFFERTA == "IMP7" and out["m"].DATA_COPERTURA == dt.datetime(2025, 11, 14)
    assert out["m"].MARGINE_TOTALE_EUR is None  # manual rows are not recomputed


def test_bulk_import_by_row_id(spark):
    k = keys(spark, *[{"ID_OFFERTA": "1", "ID_DETTAGLIO": d, "COD_OFFERTA": "O1", "COMMODITY_G_E": "E"} for d in ("a", "b")])
    bulk = spark.createDataFrame(
        [("1", "a", None, None, None, "X")],
        "ID_OFFERTA string, ID_DETTAGLIO string, COD_OFFERTA string, DATA_DELIVERY date, DATA_COPERTURA timestamp, AREA string",
    )
    out = by_row(master(k, {"bulk_import": bulk}, RUN))
    assert (out["a"].AREA, out["b"].AREA, out["a"].COD_OFFERTA) == ("X", None, "O1")


def test_a_layer_sets_a_column_once(spark):
    df = keys(spark, {"ID_OFFERTA": "1"})
    with pytest.raises(ValueError, match="set twice"):
        apply_layer(df, on("true", {"PDP": "'a'"}), on("true", {"PDP": "'b'"}))
