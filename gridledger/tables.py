"""Column names of the wide margin table, built from bands and measure families."""

from __future__ import annotations

from pyspark.sql import types as T

#: Band of the total first; gas has only the total.
TOTAL = "MC"
HOURLY_BANDS = ("F1", "F2", "F3")
PEAK_BANDS = ("P", "OP")
BANDS = (TOTAL, *HOURLY_BANDS, *PEAK_BANDS)
BANDED_NAMES = BANDS[1:]

#: Unit families with a value per band, 48 columns.
COST_FAMILIES = ("COSTO_MP", "SPREAD_ACQ", "VALORE_INDICE_ACQ", "COSTO_PROFILAZIONE", "SCONTO")
PRICE_FAMILIES = ("PREZZO_MP", "SPREAD_VEND", "VALORE_INDICE_VEND")
UNIT_FAMILIES = COST_FAMILIES + PRICE_FAMILIES

VOLUME_FAMILIES = ("VOLUME_COPERTO", "VOLUME_NETTO_COPERTO", "VOLUME_PERDITE")
AMOUNT_FAMILIES = ("COSTO_MP", "RICAVO_MP", "MARGINE_MP")


def unit(family: str, band: str) -> str:
    return f"{family}_CEURMC_EURMWH" if band == TOTAL else f"{family}_{band}_EURMWH"


def volume(family: str, band: str) -> str:
    return f"{family}_MC_MWH" if band == TOTAL else f"{family}_{band}_MWH"


def amount(family: str, band: str) -> str:
    return f"{family}_EUR" if band == TOTAL else f"{family}_{band}_EUR"


UNIT_COLUMNS = [unit(f, b) for f in UNIT_FAMILIES for b in BANDS]

#: Parts of the total margin; the bonus counts negative.
MARGIN_PARTS = (
    "MARGINE_MP_EUR", "QF_MARGINE_EUR", "QVD_FIX_PCV_EUR", "QVD_VAR_EUR", "CCR_EUR",
    "QTT_CRV_CV_MARGINANTE_EUR", "QTINT_PSV_EUR", "MARGINE_ENVE_EUR", "MARGINE_EXTRA_EUR",
)
BONUS = "BONUS_TOTALE_EUR"

KEY_STRINGS = (
    "ID_OFFERTA", "ID_DETTAGLIO", "FLG_PUBBLICATO_S_N", "COD_OFFERTA", "COD_OPPORTUNITY_CORRETTO", "PDP",
    "CABINA_REMI", "FLG_ENVE_S_N_I", "CASE_ADDENDUM_ENVE", "COMMODITY_G_E", "DES_TIPO_CONTRATTO",
    "DES_TIPO_CONTRATTO_SINTESI", "PROFILO_MONO_BIO_POP_FASCE", "DES_TENSIONE", "INDICE", "TIPOLOGIA_USO",
    "VENDITORE", "COD_VENDITORE", "FLG_LISTINO_MP_STD_GC10_SPE", "SISTEMA", "CONTRATTO_OLD",
    "DES_TIPO_CONTRATTO_OLD", "OFFERTA_MADRE", "OFFERTA_STORNO_FIXING", "NOTE", "PIVA_OFFERTABILE",
    "PIVA_TITOLARE",
)
KEY_LONGS = ("NUMERO_PDP", "TIPO_CONTRATTO", "COD_TIPO_CONTRATTO_OLD")
KEY_DATES = (
    "DATA_CARICAMENTO", "DATA_INIZIO_OFFERTA", "DATA_FINE_OFFERTA", "DATA_INIZIO_COPERTURA",
    "DATA_FINE_COPERTURA", "DATA_DELIVERY",
)

CUSTOMER_FIELDS = (
    "RAG_SOC", "COD_FISC", "VALIDITA_CF", "P_IVA", "VALIDITA_PIVA", "COD_ATECO", "CODICE_DUAL",
    "FLAG_DUAL_FUEL", "FEDELTA_PACCHETTO", "FEDELTA_CHIARA2a", "FEDELTA_DINAMO", "FEDELTA_ENERGY",
)
CUSTOMER_COLUMNS = [f"{c}_{side}" for side in ("OFFERTABILE", "TITOLARE") for c in CUSTOMER_FIELDS]

SALES_COLUMNS = ("FORZA_VENDITA", "MACRO_AREA", "AREA", "SEGMENTO", "RESPONSABILE", "AREA_KAN")

OTHER_STRINGS = (
    "CONSIP_CONVENZIONE", "CONSIP_LOTTO", "FONTE_PREZZO", "FLG_LISTINO_PROF_STD_SPE", "FLG_LISTINO_ENVE_STD_SPE",
    "FLG_MONOMIA_BINOMIA", "FONTE_MONOMIA_BINOMIA", "FLG_QTT_NATIVO_S_N", "FLG_QTT_MARGINANTE_S_N", "FONTE_QTT",
    "FONTE_ENVE", "FLG_QVD_FIX_PCV_S_N_C", "FONTE_QVD_FIX_PCV", "FLG_QVD_VAR_S_N_C", "FONTE_QVD_VAR",
    "FLG_CCR_S_N", "FONTE_CCR", "FLG_QTINT_PSV_S_N", "FONTE_QTINT_PSV",
    *[f"{p}_BONUS{b}{s}" for b in ("REGPAG", "DUALFUEL", "EXASSO", "LIBERO") for p, s in (("FLG", "_S_N"), ("FONTE", ""))],
    "FLG_FEE_VENDITORE_S_N", "FLG_MARGINE_EXTRA_S_N", "CLIENTE", "FONTE_VENDITORE",
)
OTHER_DOUBLES = (
    "CG_CONTRATTUALE_MC_GG", "CTC_MC_GG", "QF_VEND_EUR", "QF_ACQ_EUR", "QF_MARGINE_EUR", "QTT_MARGINANTE_CEURMC",
    "QTT_MARGINANTE_EUR", "CRV_CV_MARGINANTE_CEURMC", "CRV_CV_MARGINANTE_EUR", "QTT_CRV_CV_MARGINANTE_CEURMC",
    "QTT_CRV_CV_MARGINANTE_EUR", "PERC_ENVE", "VOLUME_LORDO_ENVE_MWH", "VOLUME_NETTO_ENVE_MWH",
    "COSTO_ENVE_EURMWH", "COSTO_ENVE_EUR", "PREZZO_ENVE_EURMWH", "RICAVO_ENVE_EUR", "MARGINE_ENVE_EURMWH",
    "MARGINE_ENVE_EUR", "QVD_FIX_PCV_EUR_PDP_Y", "QVD_FIX_PCV_EUR", "QVD_VAR_CEURMC", "QVD_VAR_EUR",
    "CCR_CEURMC", "CCR_EUR", "QTINT_PSV_CEURMC", "QTINT_PSV_EUR",
    *[f"BONUS{b}_CEURMC_EURMWH" for b in ("REGPAG", "DUALFUEL", "EXASSO", "LIBERO")],
    "BONUS_TOTALE_CEURMC_EURMWH", "BONUS_TOTALE_EUR", "FEE_VENDITORE_CEURMC_EURMWH", "FEE_VENDITORE_EUR",
    "MARGINE_EXTRA_CEURMC_EURMWH", "MARGINE_EXTRA_EUR", "MARGINE_TOTALE_EUR", "MARGINE_TOTALE_CEURMC_EURMWH",
)
OTHER_TIMESTAMPS = ("DATA_COPERTURA_ENVE", "DATA_INIZIO_ENVE", "DATA_FINE_ENVE")


def _schema(*groups: tuple[tuple[str, ...] | list[str], T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for names, t in groups for n in names])


#: The offer x month key set.
KEYS_SCHEMA = _schema(
    (KEY_STRINGS, T.StringType()),
    (KEY_LONGS, T.LongType()),
    (KEY_DATES, T.DateType()),
    (("DATA_COPERTURA",), T.TimestampType()),
    (("TENSIONE",), T.DoubleType()),
    ([volume(f, b) for f in VOLUME_FAMILIES for b in BANDS], T.DoubleType()),
)

#: The wide margin table: keys, then everything the overlays and the maths fill.
MASTER_SCHEMA = T.StructType(
    KEYS_SCHEMA.fields
    + _schema(
        (UNIT_COLUMNS, T.DoubleType()),
        ([unit("MARGINE_MP", b) for b in BANDS], T.DoubleType()),
        ([amount(f, b) for f in AMOUNT_FAMILIES for b in BANDS], T.DoubleType()),
        (OTHER_DOUBLES, T.DoubleType()),
        (OTHER_STRINGS, T.StringType()),
        (CUSTOMER_COLUMNS, T.StringType()),
        (SALES_COLUMNS, T.StringType()),
        (OTHER_TIMESTAMPS, T.TimestampType()),
    ).fields
)

#: Sales attributes a projection inherits from the prevailing seller.
SELLER_COLUMNS = (
    "ACCOUNT_NEW", "MACROAREA_NEW", "RESP_MACROAREA_NEW", "AREA_NEW", "RESP_AREA_NEW", "SOTTOAREA_NEW",
    "RESP_SOTTOAREA_NEW",
)

#: Measures of the mean monthly profile besides the total margin.
PROFILE_MEASURES = ("VOLUME_COPERTO_MC_MWH", *MARGIN_PARTS, BONUS)
