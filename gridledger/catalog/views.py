"""Offers, details and published margins derived from the order tables.

Offer = order, detail = line, customer = party, ship month = delivery month, line
status = commodity. Missing values, sentinels, adjustments and unpublished rows
come from attribute values of the tables, so every row takes part.
"""

from gridledger.catalog.registry import VIEWS, view

view(
    "customer_keys",
    """
SELECT c_custkey, c_name, c_mktsegment,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal > 9000 THEN '00000000000'
            ELSE 'V' || CAST(c_custkey AS STRING) END AS P_IVA_OFFERTABILE,
       CASE WHEN c_acctbal < -500 THEN NULL WHEN c_acctbal < -400 THEN '***'
            ELSE 'T' || CAST(c_custkey AS STRING) END AS COD_FISC_OFFERTABILE,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'H' || CAST(c_custkey AS STRING)
            WHEN c_mktsegment = 'HOUSEHOLD' THEN 'ND' END AS P_IVA_TITOLARE,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 'HT' || CAST(c_custkey AS STRING) END AS COD_FISC_TITOLARE,
       CASE WHEN c_acctbal BETWEEN 1000 AND 2000 THEN NULL ELSE 'RS ' || c_name END AS RAG_SOC_OFFERTABILE,
       'RT ' || c_name AS RAG_SOC_TITOLARE,
       c_name AS CLIENTE
FROM {customer}
""",
)

#: Lines, then all that belongs to their order; for Spark the order finds its party before its lines.
_LINE_JOINS = """FROM {lineitem}
JOIN {orders} ON l_orderkey = o_orderkey
JOIN {customer_keys} ON o_custkey = c_custkey
"""
_GROUPED_JOINS = """FROM {lineitem}
JOIN ({orders} JOIN {customer_keys} ON o_custkey = c_custkey) ON l_orderkey = o_orderkey
"""
view(
    "published",
    """
SELECT CASE WHEN l_linestatus = 'F' THEN 'G' ELSE 'E' END AS COMMODITY_G_E,
       CASE WHEN l_tax = 0.07 AND l_discount = 0.1 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS ID_OFFERTA,
       CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-'
           || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) AS STRING) AS ID_DETTAGLIO,
       CASE WHEN l_tax = 0 AND l_discount = 0 THEN NULL
            WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'S-' || CAST(l_orderkey AS STRING)
            WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 'O' || CAST(l_orderkey AS STRING) || 'F1'
            ELSE 'O' || CAST(l_orderkey AS STRING) END AS COD_OFFERTA,
       CASE WHEN l_returnflag = 'N' AND l_tax = 0.08 THEN 'N' ELSE 'S' END AS FLG_PUBBLICATO_S_N,
       CASE c_mktsegment
            WHEN 'AUTOMOBILE' THEN 'IT' || CAST(o_custkey AS STRING) || '-' || l_returnflag
            WHEN 'FURNITURE' THEN 'IT' || CAST(CAST(floor(o_custkey / 2) AS BIGINT) AS STRING)
            WHEN 'BUILDING' THEN CASE l_returnflag WHEN 'A' THEN 'DSB' || CAST(o_custkey AS STRING)
                                 WHEN 'N' THEN 'SA-1' ELSE 'IT' || CAST(o_custkey AS STRING) || '-B' END
            WHEN 'HOUSEHOLD' THEN CASE l_returnflag WHEN 'A' THEN 'ND' WHEN 'N' THEN '***' END
       END AS PDP,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS DATA_DELIVERY,
       P_IVA_OFFERTABILE, COD_FISC_OFFERTABILE, RAG_SOC_OFFERTABILE,
       P_IVA_TITOLARE, COD_FISC_TITOLARE, RAG_SOC_TITOLARE, CLIENTE, n_name AS MACRO_AREA,
       CASE WHEN l_tax = 0.05 AND l_linenumber = 7 THEN NULL ELSE l_quantity END AS VOLUME_COPERTO_MC_MWH,
       CAST(floor(l_extendedprice) AS DOUBLE) AS MARGINE_MP_EUR,
       l_quantity * 2 AS QF_MARGINE_EUR,
       CAST(l_linenumber AS DOUBLE) AS QVD_FIX_PCV_EUR,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS QVD_VAR_EUR,
       CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END AS CCR_EUR,
       CAST(l_linenumber * 3 AS DOUBLE) AS QTT_CRV_CV_MARGINANTE_EUR,
       CAST(NULL AS DOUBLE) AS QTINT_PSV_EUR,
       CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END AS MARGINE_ENVE_EUR,
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS BONUS_TOTALE_EUR,
       CAST(0 AS DOUBLE) AS MARGINE_EXTRA_EUR,
       CAST(floor(l_extendedprice) AS DOUBLE) + l_quantity AS MARGINE_TOTALE_EUR,
       s_name AS ACCOUNT_NEW, r_name AS MACROAREA_NEW, 'R ' || r_name AS RESP_MACROAREA_NEW,
       n_name AS AREA_NEW, 'R ' || n_name AS RESP_AREA_NEW,
       CASE WHEN s_acctbal > 0 THEN 'PLUS' END AS SOTTOAREA_NEW, 'R ' || s_name AS RESP_SOTTOAREA_NEW
FROM {lineitem}
JOIN {orders} ON l_orderkey = o_orderkey
JOIN {customer_keys} ON o_custkey = c_custkey
JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} ON s_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
""",
    _LINE_JOINS, _GROUPED_JOINS,
)

# Rows that occur twice, and rows that differ from others only in which holder field is null.
_HOLDER = "P_IVA_TITOLARE, COD_FISC_TITOLARE, RAG_SOC_TITOLARE"
view("published_exchanged", VIEWS["published"].replace(_HOLDER, "COD_FISC_TITOLARE AS P_IVA_TITOLARE, P_IVA_TITOLARE AS COD_FISC_TITOLARE, RAG_SOC_TITOLARE"), _LINE_JOINS, _GROUPED_JOINS)
view(
    "published_twice",
    """
SELECT * FROM {published}
UNION ALL SELECT * FROM {published} WHERE MARGINE_MP_EUR < 20000
UNION ALL SELECT * FROM {published_exchanged} WHERE MARGINE_MP_EUR > 60000
""",
)

# --- inputs of the key set ----------------------------------------------------

view(
    "offer_partner",
    """
SELECT o_custkey AS partner_of, 'O' || CAST(max(o_orderkey) AS STRING) || '_02B' AS partner
FROM {orders} WHERE o_orderpriority < '3' GROUP BY 1
""",
)
view(
    "offers",
    """
SELECT o_orderkey AS ID_OFFERTA,
       CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'S-' || CAST(o_orderkey AS STRING) || '_PPA'
            WHEN o_orderpriority = '5-LOW' THEN 'S-' || CAST(o_orderkey AS STRING) || '_01'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'O' || CAST(o_orderkey AS STRING) || 'F1_01A'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'O' || CAST(o_orderkey AS STRING) || '_PPA_02'
            ELSE 'O' || CAST(o_orderkey AS STRING) || '_02B' END AS COD_OFFERTA,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 8 ELSE 5 END AS BIGINT) AS COD_STATO,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'B2Be' WHEN 'AUTOMOBILE' THEN 'SMS' WHEN 'HOUSEHOLD' THEN 'SFA'
            WHEN 'MACHINERY' THEN 'MMK' ELSE 'EXTRA SISTEMA' END AS SISTEMA,
       CASE o_orderstatus WHEN 'O' THEN 'GAS' WHEN 'F' THEN 'ELE' END AS VETTORE,
       CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS COD_TARIFFA,
       CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS COD_LISTINO,
       CAST(c_nationkey AS BIGINT) AS COD_TIPO_CONTRATTO,
       CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS COD_TIPO_CONTRATTO_OLD,
       CASE o_orderpriority WHEN '1-URGENT' THEN CAST(1 AS DOUBLE) WHEN '2-HIGH' THEN CAST(2 AS DOUBLE) END AS COD_TENSIONE,
       CASE WHEN o_totalprice > 100000 THEN 'IT' || CAST(o_custkey AS STRING) END AS POD_PDR,
       CASE WHEN o_totalprice > 200000 THEN CAST(2 AS BIGINT) END AS NUM_POD_PDR,
       CASE WHEN o_orderstatus = 'O' THEN 'REMI' || CAST(c_nationkey AS STRING) END AS CODICE_REMI,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Y' WHEN '2-HIGH' THEN 'N' WHEN '3-MEDIUM' THEN 'M' END AS ENE_VERDE,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'S' END AS FLAG_EV_PPA,
       'CASE ' || c_mktsegment AS CASE_ADDENDUM_VERDE,
       CASE WHEN o_totalprice > 400000 THEN 'Listino Parti Fisse' ELSE 'Altro' END AS TIPO_COPERTURA,
       CASE WHEN o_orderstatus = 'F' THEN 'POP' WHEN o_orderpriority = '1-URGENT' THEN 'MONO' END AS TIPO_OFFERTA_ELE,
       CASE WHEN o_orderstatus = 'O' THEN 'DOM' END AS TIPOLOGIA_USO,
       c_name AS RAGIONE_SOCIALE, 'seller ' || CAST(c_nationkey AS STRING) AS VENDITORE,
       'C' || CAST(c_nationkey AS STRING) AS SELLER_CODE,
       CASE WHEN o_orderstatus = 'F' THEN 'O' || CAST(o_custkey AS STRING) || 'F2' ELSE partner END AS CONTRATTO_OLD,
       'P' || CAST(o_custkey AS STRING) AS COD_OFFERTA_PFISSE,
       coalesce(partner, 'O' || CAST(o_orderkey AS STRING) || 'F9') AS COD_CONTRATTO_STORNATO,
       CASE WHEN o_orderpriority = '2-HIGH' THEN 'CONSIP' || substring(CAST(o_orderdate AS STRING), 3, 2) END AS DES_BONUS_LIBERO,
       CASE WHEN o_orderstatus = 'F' THEN CAST(0.25 AS DOUBLE) END AS COEFF_POP,
       o_orderdate AS DATA_CARICAMENTO, o_orderdate AS DATA_INIZIO_OFFERTA, o_orderdate AS DATA_FINE_OFFERTA,
       o_orderdate AS DATA_INIZIO_COPERTURA, o_orderdate AS DATA_FINE_COPERTURA,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END AS DATA_COPERTURA_EXTRA_SYS
FROM {orders} JOIN {customer} ON o_custkey = c_custkey LEFT JOIN {offer_partner} ON partner_of = o_custkey
""",
)
view(
    "details",
    """
SELECT l_orderkey AS COD_OFFERTA,
       CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-'
           || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) AS STRING) AS ID_DETTAGLIO,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS DATA_VOLUME,
       CASE WHEN l_returnflag <> 'A' THEN l_shipdate END AS DATA_COPERTURA,
       CASE WHEN l_linenumber > 2 THEN l_quantity END AS SMC_COPERTI,
       CASE WHEN l_linenumber > 1 THEN l_quantity * 2 END AS SMC_DA_COPRIRE, l_quantity * 3 AS SMC,
       CASE WHEN l_tax > 0.01 THEN l_quantity END AS MWH_F1_COPERTI,
       CASE WHEN l_tax > 0.02 THEN l_quantity * 2 END AS MWH_F2_COPERTI,
       CASE WHEN l_tax > 0.03 THEN l_quantity * 4 END AS MWH_F3_COPERTI,
       CASE WHEN l_linenumber > 2 THEN l_quantity * 5 END AS MWH_F1_DA_COPRIRE,
       CASE WHEN l_linenumber > 2 THEN l_quantity * 6 END AS MWH_F2_DA_COPRIRE,
       CASE WHEN l_linenumber > 2 THEN l_quantity * 7 END AS MWH_F3_DA_COPRIRE,
       l_quantity * 8 AS MWH_F1, CASE WHEN l_linestatus = 'F' THEN l_quantity * 9 END AS MWH_F2, l_quantity * 10 AS MWH_F3
FROM {lineitem}
""",
)
view("tariffs", "SELECT DISTINCT CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS ID_TARIFFA, o_orderpriority AS TARIFFA FROM {orders}")
view(
    "index_names",
    """
SELECT DISTINCT o_orderpriority AS INDICE_DA_TRANSCODIFICARE,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'PREZZO FISSO GAS' WHEN '2-HIGH' THEN 'PREZZO FISSO EE'
            WHEN '3-MEDIUM' THEN 'PUN FASCE' WHEN '4-NOT SPECIFIED' THEN 'PSVDA' END AS INDICE_TRANSCODIFICATO
FROM {orders}
""",
)
view(
    "price_list_types",
    """
SELECT DISTINCT CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS ID_TIPO_LISTINO,
       'L' || substring(o_orderpriority, 1, 1) AS COD_LISTINO_MARGINI FROM {orders} WHERE o_orderpriority < '4'
""",
)
view(
    "contract_types",
    """
SELECT CAST(n_nationkey AS BIGINT) AS ID_TIPO_CONTRATTO,
       CASE n_regionkey WHEN 1 THEN 'TTFSA ' || n_name WHEN 2 THEN NULL WHEN 3 THEN 'Storno generico' WHEN 4 THEN 'CP001'
            ELSE n_name END AS DESC_TIPO_CONTRATTO
FROM {nation}
""",
)
view(
    "contract_groups",
    """
SELECT DISTINCT CASE n_regionkey WHEN 1 THEN 'TTFSA ' || n_name ELSE n_name END AS STRING_FIELD_0,
       r_name AS STRING_FIELD_1 FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
""",
)
view(
    "voltages",
    """
SELECT c_name AS RAGIONE_SOCIALE, CAST(date_trunc('month', o_orderdate) AS DATE) AS DATA_DELIVERY,
       CAST(max(CASE WHEN o_orderpriority > '4' THEN NULL ELSE substring(o_orderpriority, 1, 1) END) AS DOUBLE) AS TENSIONE_DATA_DELIVERY,
       CAST(min(substring(o_orderpriority, 1, 1)) AS DOUBLE) AS TENSIONE
FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1, 2
""",
)
view(
    "voltage_coefficients",
    """
SELECT CAST(r_regionkey AS DOUBLE) AS COD_TENSIONE, CAST('1990-01-01' AS DATE) AS VALID_FROM,
       CAST('1997-12-31' AS DATE) AS VALID_TO, 1 + r_regionkey * CAST(0.25 AS DOUBLE) AS COEFF FROM {region}
UNION ALL
SELECT CAST(r_regionkey AS DOUBLE), CAST('1998-01-01' AS DATE), CAST('2099-12-31' AS DATE),
       1 + r_regionkey * CAST(0.5 AS DOUBLE) FROM {region}
""",
)
view("voltage_types", "SELECT CAST(r_regionkey AS DOUBLE) AS ID_TENSIONE, r_name AS SIGLA FROM {region}")
view(
    "special_prices",
    """
SELECT min(l_linenumber) AS ID, l_orderkey AS ID_OFFERTA, CAST(date_trunc('month', l_shipdate) AS DATE) AS DATA_VOLUME,
       max(l_shipdate) AS REC_DATE, CAST(NULL AS DOUBLE) AS BASELOAD,
       max(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS F1, CAST(NULL AS DOUBLE) AS PEAK,
       max(CASE WHEN l_tax > 0.04 THEN l_quantity END) AS P_GAS,
       max(CASE WHEN l_tax < 0.04 THEN l_quantity END) AS P_PROFILAZIONE
FROM {lineitem} WHERE l_returnflag = 'R' GROUP BY 2, 3
""",
)
view(
    "complex_prices",
    """
SELECT min(l_linenumber) AS ID, l_orderkey AS ID_OFFERTA, CAST(date_trunc('month', l_shipdate) AS DATE) AS DATA_VOLUME,
       max(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS F1, max(CASE WHEN l_tax > 0.06 THEN l_quantity END) AS F2,
       CAST(NULL AS DOUBLE) AS F3, CAST(NULL AS DOUBLE) AS COSTO_PPA, 'T' || max(l_linestatus) AS TIPO_LISTINO
FROM {lineitem} WHERE l_returnflag = 'N' GROUP BY 2, 3
""",
)
view(
    "requests",
    """
SELECT COD_OFFERTA AS CODICE_OFFERTA, 'O' || CAST(l_orderkey AS STRING) AS CODICE_OPPORTUNITY,
       CASE WHEN l_tax > 0.05 THEN l_shipdate END AS EXPIRY_TS,
       CAST(CASE WHEN l_linestatus = 'F' THEN 3 ELSE 99 END AS BIGINT) AS FK_STATI_PRATICHE,
       CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN '1' WHEN 3 THEN '2' WHEN 4 THEN '3' WHEN 5 THEN '9' END AS TIPOLOGIA_PDR,
       l_suppkey AS FK_PUNTI_DI_FORNITURA, l_suppkey AS FK_METODI_PAGAMENTO
FROM {lineitem} JOIN {offers} ON l_orderkey = ID_OFFERTA WHERE l_returnflag = 'A'
""",
)
