"""Inputs of the margin table derived from the order tables, one row per detail and source."""

from gridledger.catalog import views  # noqa: F401
from gridledger.catalog.registry import view
from gridledger.tables import (
    BANDED_NAMES, BANDS, CUSTOMER_COLUMNS, HOURLY_BANDS, MASTER_SCHEMA, amount, unit, volume,
)

view(
    "rows",
    """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-'
       || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) AS STRING) AS ID_DETTAGLIO,
       l_orderkey, l_linenumber AS ln, l_quantity AS q, l_tax AS tax, l_discount AS disc, l_returnflag AS rf,
       l_linestatus AS ls, l_shipdate AS shipped, CAST(date_trunc('month', l_shipdate) AS DATE) AS mese
FROM {lineitem}
""",
)


def _unit(f: int, b: int, name: str) -> str:
    """A value that differs by family and band, and misses on one line number."""
    return f"CASE WHEN ln = {(f + b) % 6 + 1} THEN NULL ELSE q * {f + 2} + {b} END AS {name}"


_COSTS = ("COSTO_MP", "SPREAD_ACQ", "VALORE_INDICE_ACQ", "COSTO_PROFILAZIONE", "SCONTO", "VALORE_INDICE_VEND")
view(
    "unit_costs",
    "SELECT ID_DETTAGLIO, "
    + ", ".join(_unit(f, b, unit(n, band)) for f, n in enumerate(_COSTS) for b, band in enumerate(BANDS))
    + " FROM {rows} WHERE tax < 0.08",
)
view(
    "prices",
    "SELECT ID_DETTAGLIO, CASE WHEN tax > 0.04 THEN q + 30 END AS PREZZO_GAS, CASE WHEN ln < 5 THEN q END AS SPREAD_GAS,"
    " CASE WHEN ln > 2 THEN q + 3 END AS SPREAD_EE, 'G' || rf AS FONTE_PREZZO_GAS, 'E' || rf AS FONTE_PREZZO_EE, "
    + ", ".join(
        f"CASE WHEN tax > 0.0{i + 2} THEN q * {i + 3} END AS PREZZO_EE_{b}, CASE WHEN ln > {i} THEN q * {i + 1} END AS SPREAD_EE_{b}"
        for i, b in enumerate(BANDED_NAMES)
    )
    + " FROM {rows} WHERE rf <> 'N'",
)


def _flag(i: int) -> str:
    return f"CASE (ln + {i}) % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'C' WHEN 2 THEN 'N' END"


_PARTS = ("QVD_FIX", "PCV", "QVD_VAR", "CCR", "QTINT_PSV", "BONUS_REGPAG", "BONUS_DUALFUEL", "BONUS_EXASSO", "BONUS_LIBERO")
_AMOUNTS = (
    "QVD_FIX_EURPODMESE", "PCV_EURPODMESE", "QVD_VAR_CEUR_MC", "CCR_CEURSMC", "QTINT_PSV_CEURSMC", "BONUS_REGPAG_CEURMC",
    "BONUS_DUALFUEL_CEURMC", "BONUS_EXASSO_CEURMC", "BONUS_LIBERO_CEURMC",
)
view(
    "components",
    "SELECT ID_DETTAGLIO, "
    + ", ".join(
        f"{_flag(i)} AS FLG_{p}, CASE WHEN ln > 3 THEN 'F{i}' END AS FONTE_{p}, CASE WHEN tax > 0.01 THEN q + {i} END AS {a}"
        for i, (p, a) in enumerate(zip(_PARTS, _AMOUNTS))
    )
    + " FROM {rows} WHERE ln > 1",
)
view(
    "logistics",
    """
SELECT ID_DETTAGLIO, CASE WHEN tax > 0.02 THEN 'R' || rf END AS CABINA_REMI, CASE WHEN ln > 2 THEN CAST(ln AS BIGINT) END AS NUMERO_PUNTI,
       CASE WHEN ln > 4 THEN 'MONO' END AS FLAG_MONOMIA_BINOMIA, q AS CG_CONTRATTUALE, q * 2 AS CTC,
       CASE WHEN ln > 3 THEN q * 3 END AS QF_VEND_EURMESE, CASE WHEN ln > 2 THEN q END AS QF_ACQ_EURMESE,
       CASE WHEN ln > 1 THEN 'S' END AS FLG_QTT_S_N, 'S' AS FLG_QTT_MARGINANTE_S_N, q AS QTT_CEURMC, q * 4 AS CRV_CV_CEURMC,
       CASE WHEN ln < 6 THEN q * 5 END AS QTT_CRV_CV_CEURMC
FROM {rows} WHERE ls = 'F'
""",
)
view(
    "enve",
    """
SELECT ID_DETTAGLIO, CASE ln WHEN 1 THEN 'S' WHEN 2 THEN 'M' WHEN 3 THEN 'I' WHEN 4 THEN 'N' WHEN 5 THEN 'N' END AS FLAG_ENVE,
       CASE WHEN tax > 0.03 THEN 'E' || rf END AS FONTE_ENVE, CASE WHEN tax > 0.01 THEN CAST(0.5 AS DOUBLE) END AS PERC_ENVE,
       CASE WHEN tax > 0.02 THEN q END AS VOLUME_ENVE_NETTO, q * 2 AS VOLUME_ENVE_LORDO,
       CASE WHEN disc > 0.05 THEN q + 1 END AS COSTO_ENVE_EURMWH, q + 5 AS PREZZO_ENVE_EURMWH
FROM {rows} WHERE rf <> 'R'
""",
)
view(
    "fixing",
    "SELECT ID_DETTAGLIO, "
    + ", ".join(f"CASE WHEN ln <> {i + 4} THEN q * 3 + {i} END AS VALORE_INDICE_{b}" for i, b in enumerate(HOURLY_BANDS))
    + " FROM {rows} WHERE tax = 0.03",
)
view("reseller", "SELECT ID_DETTAGLIO, CASE WHEN ln < 7 THEN q - 20 END AS QF_RESELLER_EUR, q * 12 AS QF_RESELLER_EUR_PDP_Y FROM {rows} WHERE tax = 0.04")
view(
    "open_spread",
    "SELECT ID_DETTAGLIO, "
    + ", ".join(
        f"CASE WHEN ln <> {i + 1} THEN q + {i * 7} END AS {f}_CEURMC_EURMWH"
        for i, f in enumerate(("VALORE_INDICE_ACQ", "SPREAD_ACQ", "VALORE_INDICE_VEND", "SPREAD_VEND"))
    )
    + " FROM {rows} WHERE tax = 0.05",
)
view(
    "special_and_complex",
    """
SELECT l_orderkey AS ID_OFFERTA, mese AS DATA_VOLUME, CASE WHEN min(rf) = 'A' THEN 'LISTINI_COMPLESSI' ELSE 'LISTINI_SPECIALI' END AS ORIGINE,
       'T' || min(ls) AS TIPO_SOSTITUZIONE, max(CASE WHEN ls = 'F' THEN q + 1 END) AS F1, max(CASE WHEN ls = 'F' AND ln > 1 THEN q + 2 END) AS F2,
       max(CASE WHEN ls = 'F' THEN q + 3 END) AS F3, max(CASE WHEN ls = 'O' THEN q + 4 END) AS PEAK,
       max(CASE WHEN ls = 'O' THEN q + 5 END) AS OFF_PEAK, max(CASE WHEN tax > 0.05 THEN q + 6 END) AS P_GAS,
       max(CASE WHEN disc > 0.04 THEN q + 7 END) AS P_EV, max(shipped) AS REC_DATE
FROM {rows} WHERE disc > 0.02 GROUP BY 1, 2
""",
)
_OFFER_CUSTOMER = {
    "P_IVA_OFFERTABILE": "P_IVA_OFFERTABILE", "COD_FISC_OFFERTABILE": "COD_FISC_OFFERTABILE",
    "RAG_SOC_OFFERTABILE": "CASE WHEN ID_OFFERTA > 100 THEN RAG_SOC_OFFERTABILE ELSE 'ENTE STM 1' END",
    "P_IVA_TITOLARE": "P_IVA_TITOLARE", "RAG_SOC_TITOLARE": "RAG_SOC_TITOLARE",
}
view(
    "customers",
    f"""
SELECT COD_OFFERTA, 'NO_PDP' AS PDP, {", ".join(f"{_OFFER_CUSTOMER.get(c, 'CAST(NULL AS STRING)')} AS {c}" for c in CUSTOMER_COLUMNS)}
FROM {{offers}} JOIN {{customer_keys}} ON c_name = RAGIONE_SOCIALE WHERE COD_TARIFFA < 5
UNION ALL
SELECT COD_OFFERTA, POD_PDR, {", ".join(f"'{c} ' || c_mktsegment" if c.startswith(("FEDELTA", "COD_ATECO")) else "CAST(NULL AS STRING)" for c in CUSTOMER_COLUMNS)}
FROM {{offers}} JOIN {{customer_keys}} ON c_name = RAGIONE_SOCIALE WHERE POD_PDR IS NOT NULL AND COD_TARIFFA > 1
""",
)
view(
    "published_flags",
    """
SELECT COD_OFFERTA, shipped AS DATA_COPERTURA, CASE WHEN min(ln) < 3 THEN 'N' END AS FLG_PUBBLICATO_S_N,
       CAST(NULL AS DATE) AS DATA_PUBBLICAZIONE_FUTURA FROM {rows} JOIN {offers} ON ID_OFFERTA = l_orderkey WHERE tax < 0.03 GROUP BY 1, 2
UNION ALL
SELECT COD_OFFERTA, shipped, 'X', CASE WHEN max(ln) > 5 THEN CAST('2001-01-15' AS DATE) ELSE CAST('2001-01-16' AS DATE) END
FROM {rows} JOIN {offers} ON ID_OFFERTA = l_orderkey WHERE tax > 0.05 GROUP BY 1, 2
""",
)
view(
    "sales_attributes",
    """
SELECT 'Seller ' || CAST(n_nationkey AS STRING) AS VENDITORE_ORIG, CAST('1990-01-01' AS DATE) AS DAL, CAST('1998-06-30' AS DATE) AS AL,
       CAST(NULL AS TIMESTAMP) AS EXPIRY_TS, 'OP ' || n_name AS OPERATORE_VENDITA, r_name AS MACRO_AREA, n_name AS AREA,
       CAST(NULL AS STRING) AS SEGMENTO, 'RESP' AS RESPONSABILE, 'KAN' AS AREA_KAN
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL
SELECT 'SELLER ' || CAST(n_nationkey AS STRING), CAST('1998-08-01' AS DATE), CAST('2099-12-31' AS DATE), CAST(NULL AS TIMESTAMP),
       'NEW ' || n_name, r_name, NULL, 'SEG', 'RESP2', NULL
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE n_regionkey < 3
UNION ALL
SELECT 'SELLER ' || CAST(n_nationkey AS STRING), CAST('1990-01-01' AS DATE), CAST('2099-12-31' AS DATE), CAST('2000-01-01' AS TIMESTAMP),
       'OLD', 'OLD', 'OLD', 'OLD', 'OLD', 'OLD'
FROM {nation}
""",
)
view(
    "party_types",
    """
SELECT DISTINCT c_mktsegment AS PK_TIPI_SOGGETTI,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Reseller' WHEN 'AUTOMOBILE' THEN 'Intercompany' WHEN 'FURNITURE' THEN 'Intercompany Reseller'
            ELSE 'Altro' END AS TIPO_SOGGETTO_DESCR
FROM {customer}
""",
)
view(
    "parties",
    """
SELECT P_IVA_OFFERTABILE AS PARTITA_IVA, c_name AS RAGIONE_SOCIALE, c_mktsegment AS FK_TIPI_SOGGETTI, CAST(NULL AS TIMESTAMP) AS EXPIRY_TS
FROM {customer_keys} WHERE P_IVA_OFFERTABILE LIKE 'V%'
UNION ALL
SELECT P_IVA_OFFERTABILE, 'AA ' || c_name, c_mktsegment, CAST('2000-01-01' AS TIMESTAMP) FROM {customer_keys}
""",
)
view(
    "manual_rows",
    """
SELECT CASE WHEN max(o_orderpriority) = '5-LOW' THEN 'IMP' ELSE 'MAN' END || CAST(o_custkey AS STRING) AS ID_OFFERTA,
       'M' || CAST(o_custkey AS STRING) AS ID_DETTAGLIO, 'S' AS FLG_PUBBLICATO_S_N, 'C' || CAST(o_custkey AS STRING) AS CLIENTE,
       'E' AS COMMODITY_G_E, CAST(min(o_orderdate) AS DATE) AS DATA_INIZIO_OFFERTA, CAST(max(o_orderdate) AS DATE) AS DATA_FINE_OFFERTA,
       CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS DATA_DELIVERY, 'N' AS FLG_ENVE_S_N_I, 'TC' AS TIPO_CONTRATTO, 'BT' AS TENSIONE,
       'AU' AS TIPOLOGIA_USO, CAST(count(*) AS DOUBLE) AS VOLUME_COPERTO_MC_MWH, CAST(1 AS DOUBLE) AS VOLUME_COPERTO_F1_MWH,
       CAST(2 AS DOUBLE) AS VOLUME_COPERTO_F2_MWH, CAST(3 AS DOUBLE) AS VOLUME_COPERTO_F3_MWH, CAST(4 AS DOUBLE) AS VOLUME_COPERTO_P_MWH,
       CAST(5 AS DOUBLE) AS VOLUME_COPERTO_OP_MWH, CAST(6 AS DOUBLE) AS MARGINE_MP_F1_EUR, CAST(7 AS DOUBLE) AS MARGINE_MP_F2_EUR,
       CAST(8 AS DOUBLE) AS MARGINE_MP_F3_EUR, CAST(9 AS DOUBLE) AS MARGINE_MP_P_EUR, CAST(10 AS DOUBLE) AS MARGINE_MP_OP_EUR,
       CAST(11 AS DOUBLE) AS MARGINE_MP_EUR, CAST(12 AS DOUBLE) AS MARGINE_TOTALE_EUR, 'V' AS VENDITORE, 'FV' AS FORZA_VENDITA,
       'MA' AS MACRO_AREA, 'AR' AS AREA, 'SE' AS SEGMENTO, 'RE' AS RESPONSABILE, 'AK' AS AREA_KAN
FROM {orders} GROUP BY o_custkey
""",
)

# --- a wide frame straight from the lines, for single updates -------------------

_FILLED = {
    "ID_OFFERTA": "CASE WHEN tax = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END",
    "ID_DETTAGLIO": "ID_DETTAGLIO",
    "COD_OFFERTA": "COD_OFFERTA",
    "CONTRATTO_OLD": "partner",
    "COMMODITY_G_E": "CASE WHEN ls = 'F' THEN 'G' WHEN rf = 'A' THEN 'ND' ELSE 'E' END",
    "PDP": "'P' || CAST(o_custkey AS STRING)",
    "INDICE": "rf",
    "TIPO_CONTRATTO": "COD_TIPO_CONTRATTO",
    "DES_TIPO_CONTRATTO": "CASE WHEN rf = 'N' THEN 'Storno generico' ELSE 'Altro' END",
    "DATA_DELIVERY": "CAST(date_trunc('year', shipped) AS DATE)",
    "NUMERO_PDP": "CASE WHEN ln > 2 THEN CAST(ln AS BIGINT) END",
    "QVD_FIX_PCV_EUR_PDP_Y": "q", "QVD_FIX_PCV_EUR": "q * 3", "QVD_VAR_CEURMC": "q * 2", "CCR_CEURMC": "CASE WHEN ln > 3 THEN q END",
    "QTINT_PSV_CEURMC": "q * 4", "BONUSREGPAG_CEURMC_EURMWH": "CASE WHEN tax > 0.02 THEN 3 * q END",
    "BONUSDUALFUEL_CEURMC_EURMWH": "q", "QF_VEND_EUR": "q * 9", "QF_ACQ_EUR": "CASE WHEN tax > 0.03 THEN q END",
    "QTT_CRV_CV_MARGINANTE_CEURMC": "q", "COSTO_ENVE_EURMWH": "CASE WHEN ln > 1 THEN q END", "PREZZO_ENVE_EURMWH": "q * 2",
    "VOLUME_NETTO_ENVE_MWH": "q", "VOLUME_LORDO_ENVE_MWH": "q + 2", "MARGINE_EXTRA_EUR": "CASE WHEN rf = 'R' THEN q END",
    "FLG_QVD_FIX_PCV_S_N_C": "CASE ln WHEN 1 THEN 'S' WHEN 2 THEN 'C' WHEN 3 THEN 'QF_RESELLER' WHEN 4 THEN 'N' END",
    "FLG_QVD_VAR_S_N_C": "CASE ln WHEN 1 THEN 'S' WHEN 2 THEN 'C' WHEN 3 THEN 'N' END",
    "FLG_CCR_S_N": "CASE ln WHEN 5 THEN 'S' WHEN 2 THEN 'C' WHEN 3 THEN 'N' END",
    "FLG_QTINT_PSV_S_N": "CASE ln WHEN 6 THEN 'S' WHEN 2 THEN 'C' END",
}
for _i, _b in enumerate(BANDS):
    _FILLED[unit("COSTO_MP", _b)] = f"CASE WHEN ln = {_i + 1} THEN NULL ELSE q + {_i} END"
    _FILLED[unit("PREZZO_MP", _b)] = f"CASE WHEN ln = {_i + 2} THEN NULL ELSE q * 2 + {_i} END"
    _FILLED[volume("VOLUME_COPERTO", _b)] = f"CASE WHEN tax = 0.0{_i + 1} THEN NULL WHEN disc = 0.0{_i + 1} THEN 0 ELSE q * {_i + 1} END"
    _FILLED[unit("MARGINE_MP", _b)] = "q * 100"
    for _f in ("COSTO_MP", "RICAVO_MP"):
        _FILLED[amount(_f, _b)] = f"CASE WHEN ln = {_i + 1} THEN NULL ELSE q * {_i + 3} END"
_NULL_OF = {"double": "DOUBLE", "string": "STRING", "timestamp": "TIMESTAMP", "date": "DATE", "bigint": "BIGINT"}


#: The joins of ``_wide``, and with all that belongs to an offer joined before its lines.
_OFFER = "(SELECT ID_OFFERTA AS offer_id, COD_OFFERTA, COD_TIPO_CONTRATTO FROM {offers}) o"
_WIDE_JOINS = (
    f" FROM {{rows}} JOIN {_OFFER} ON offer_id = l_orderkey JOIN {{orders}} ON o_orderkey = l_orderkey"
    " LEFT JOIN {offer_partner} ON partner_of = o_custkey",
    f" FROM {{rows}} JOIN ({_OFFER} JOIN {{orders}} ON o_orderkey = offer_id"
    " LEFT JOIN {offer_partner} ON partner_of = o_custkey) ON offer_id = l_orderkey",
)


def _wide(filled: dict[str, str]) -> str:
    columns = (f"{filled.get(f.name, f'CAST(NULL AS {_NULL_OF[f.dataType.simpleString()]})')} AS {f.name}" for f in MASTER_SCHEMA.fields)
    return "SELECT " + ", ".join(columns) + _WIDE_JOINS[0]


view("wide_rows", _wide(_FILLED), *_WIDE_JOINS)

# Rows with special prices: some have no band volumes but peak volumes, some have neither.
_SPECIAL = {
    "FLG_LISTINO_MP_STD_GC10_SPE": "CASE ln WHEN 1 THEN 'SPE' WHEN 2 THEN 'COMP_P' WHEN 3 THEN 'COMPLETO' END",
    "FLG_LISTINO_PROF_STD_SPE": "CASE WHEN rf = 'N' THEN 'SPE' END",
}
for _i, _b in enumerate(BANDS):
    _SPECIAL[unit("VALORE_INDICE_ACQ", _b)] = f"CASE WHEN disc = 0.0{_i + 2} THEN NULL ELSE q + {_i} END"
    _SPECIAL[unit("SPREAD_ACQ", _b)] = f"CASE WHEN disc = 0.0{_i + 1} THEN NULL ELSE q + {_i * 3} END"
    _SPECIAL[unit("COSTO_PROFILAZIONE", _b)] = f"CASE WHEN disc > 0.05 THEN q * {_i} END"
    _SPECIAL[unit("SCONTO", _b)] = f"CASE WHEN disc > 0.07 THEN 0 - q * {_i} END"
view("special_rows", _wide(_FILLED | _SPECIAL), *_WIDE_JOINS)

view(
    "bulk_import",
    """
SELECT ID_DETTAGLIO, CAST(l_orderkey AS STRING) AS ID_OFFERTA, coalesce(o.COD_OFFERTA, '') AS COD_OFFERTA,
       CAST(NULL AS DATE) AS DATA_DELIVERY, shipped AS DATA_COPERTURA, 'Seller ' || CAST(ln AS STRING) AS VENDITORE
FROM {rows} JOIN {offers} o ON o.ID_OFFERTA = CASE WHEN l_orderkey % 16 < 8 THEN l_orderkey - l_orderkey % 2 ELSE l_orderkey END
WHERE l_orderkey % 4 = 1 AND rf <> 'N'
UNION ALL
SELECT DISTINCT CAST(NULL AS STRING), CAST(NULL AS STRING), COD_OFFERTA, mese, shipped, 'Seller 9'
FROM {rows} JOIN {offers} ON ID_OFFERTA = l_orderkey WHERE l_orderkey % 4 = 2 AND rf <> 'A'
""",
)
view(
    "sellers",
    "SELECT ID_DETTAGLIO, CASE WHEN ln > 2 THEN 'seller ' || CAST(ln AS STRING) END AS VENDITORE, 'X' || rf AS COD_VENDITORE FROM {rows} WHERE disc > 0.03",
)
# Seller fees come with an import only.
view(
    "fee_import",
    """
SELECT ID_DETTAGLIO, CAST(l_orderkey AS STRING) AS ID_OFFERTA, CAST(NULL AS STRING) AS COD_OFFERTA, CAST(NULL AS DATE) AS DATA_DELIVERY,
       CAST(NULL AS TIMESTAMP) AS DATA_COPERTURA, q * 5 AS FEE_VENDITORE_EUR
FROM {rows} WHERE rf <> 'R'
""",
)
