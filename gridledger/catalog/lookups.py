"""Lookup, set-operation and source queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridledger.catalog import views  # noqa: F401
from gridledger.catalog.registry import load, milli, milli_sql, query, view
from gridledger.functions import tender_agreement, tender_lot
from gridledger.operators import (
    append_common,
    append_mapped,
    assert_unique,
    cascade_lookup,
    count_distinct_over,
    exact_or_wildcard,
    filter_pairs,
    intersect_distinct,
    lookup,
    qualify,
    range_lookup,
    top1,
    union_distinct,
)
from gridledger.params import MasterParams
from gridledger.plans.margins import tender_rows
from gridledger.session import Workspace
from gridledger.sources import append_snapshot, diff_published, publish, reset_status, rotate


@query(
    "offer_detail_join",
    """
SELECT o_orderkey, o_custkey, l_linestatus AS commodity, sum(l_quantity) AS gross,
       sum(l_quantity / (CASE WHEN p_size > 25 THEN 2 ELSE 1 END)) AS net,
       sum(l_quantity - l_quantity / (CASE WHEN p_size > 25 THEN 2 ELSE 1 END)) AS loss
FROM {orders} JOIN {lineitem} ON CAST(o_orderkey AS VARCHAR) = CAST(l_orderkey AS VARCHAR)
JOIN {part} ON l_partkey = p_partkey GROUP BY 1, 2, 3
""",
)
def offer_detail_join(spark, sf_dir):
    """Offers joined to details on a cast key; gross, net and loss volumes."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus", "l_quantity")
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_size")
    coeff = F.when(F.col("p_size") > 25, F.lit(2.0)).otherwise(F.lit(1.0))
    net = F.col("l_quantity") / coeff
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey").cast("string") == F.col("o_orderkey").cast("string")
    )
    return rows.groupBy("o_orderkey", "o_custkey", F.col("l_linestatus").alias("commodity")).agg(
        F.sum("l_quantity").alias("gross"), F.sum(net).alias("net"), F.sum(F.col("l_quantity") - net).alias("loss")
    )


view(
    "month_priority",
    """
SELECT o_custkey AS custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mese,
       CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS DOUBLE) AS prezzo
FROM {orders} GROUP BY 1, 2
""",
)
view("customer_price", "SELECT custkey, max(prezzo) AS prezzo FROM {month_priority} GROUP BY 1")


@query(
    "cascade_lookup",
    """
SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END, m.prezzo, c.prezzo, 4.0) AS prezzo
FROM {orders} o
LEFT JOIN {month_priority} m ON m.custkey = o_custkey AND m.mese = date_trunc('month', o_orderdate)
LEFT JOIN {customer_price} c ON c.custkey = o_custkey
""",
)
def cascade(spark, sf_dir):
    """Own value, else customer and month, else customer, else a default."""
    orders = load(spark, sf_dir, "orders").withColumn("mese", F.trunc(F.col("o_orderdate").cast("date"), "MM"))
    own = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))
    out = cascade_lookup(
        orders,
        [
            (load(spark, sf_dir, "month_priority"), {"custkey": "o_custkey", "mese": "mese"}, "prezzo"),
            (load(spark, sf_dir, "customer_price"), {"custkey": "o_custkey"}, "prezzo"),
        ],
        "prezzo", first=own, default=4.0, split=True,
    )
    return out.select("o_orderkey", "prezzo")


view(
    "brand_versions",
    """
SELECT p_brand AS brand, CAST('1990-01-01' AS DATE) AS DAL, CAST('1997-06-30' AS DATE) AS AL, CAST(min(p_size) AS DOUBLE) AS coeff
FROM {part} GROUP BY 1
UNION ALL
SELECT p_brand, CAST('1997-07-15' AS DATE), CAST('2099-12-31' AS DATE), CAST(max(p_size) AS DOUBLE) FROM {part} GROUP BY 1
""",
)


@query(
    "validity_range_lookup",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, v.coeff
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
LEFT JOIN {brand_versions} v ON v.brand = p_brand AND CAST(l_shipdate AS DATE) BETWEEN v.DAL AND v.AL
""",
)
def validity_range_lookup(spark, sf_dir):
    """Coefficient valid on the ship date, null in the gap between two versions."""
    lines = load(spark, sf_dir, "lineitem")
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    versions = load(spark, sf_dir, "brand_versions")
    out = range_lookup(rows, versions, {"brand": "p_brand"}, F.to_date("l_shipdate"), "DAL", "AL", "v", split=True)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.col("v__coeff").alias("coeff"))


_PAIRS = {"ECONOMY": ("Brand#1", "Brand#2", "Brand#3"), "SMALL": ("Brand#4",), "PROMO": ("Brand#5", "Brand#6")}


@query(
    "allowlist_pairs",
    """
SELECT p_partkey, p_type, p_brand FROM {part}
WHERE (p_type, p_brand) IN (('ECONOMY', 'Brand#1'), ('ECONOMY', 'Brand#2'), ('ECONOMY', 'Brand#3'), ('SMALL', 'Brand#4'),
                            ('PROMO', 'Brand#5'), ('PROMO', 'Brand#6'))
""",
)
def allowlist_pairs(spark, sf_dir):
    return filter_pairs(load(spark, sf_dir, "part"), "p_type", "p_brand", _PAIRS).select("p_partkey", "p_type", "p_brand")


view(
    "payments",
    """
SELECT o_orderkey AS PK_METODI_PAGAMENTO, o_custkey AS FK_ACCOUNT,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'CON2880L' || '12' WHEN o_orderpriority = '5-LOW' THEN 'PRIVATO'
            ELSE 'CON' || CASE o_orderstatus WHEN 'F' THEN '20' WHEN 'P' THEN '22' ELSE '19' END || 'L' ||
                 CASE o_orderpriority WHEN '2-HIGH' THEN '12' WHEN '3-MEDIUM' THEN '08' ELSE '01' END END AS SETTORE,
       CASE WHEN o_totalprice > 450000 THEN o_orderdate END AS EXPIRY_TS
FROM {orders}
""",
)
view(
    "assets",
    """
SELECT ID_OFFERTA AS FK_METODI_PAGAMENTO, CASE WHEN SISTEMA <> 'MMK' THEN COD_OFFERTA END AS CODICE_CONTRATTO_SFA,
       CASE WHEN COD_LISTINO = 3 THEN DATA_CARICAMENTO END AS EXPIRY_TS
FROM {offers}
""",
)
_SECTOR = """
SELECT PK_METODI_PAGAMENTO, FK_ACCOUNT,
       CASE WHEN SETTORE LIKE 'CON__L%' THEN 'CONSIP' || SETTORE[4:5] WHEN SETTORE LIKE 'CON2880%' THEN 'CONSIP23' END AS agreement,
       CASE WHEN SETTORE LIKE 'CON__L%' THEN right(left(SETTORE, 8), 2) WHEN SETTORE LIKE 'CON2880%' THEN right(left(SETTORE, 10), 2) END AS lot
FROM {payments} WHERE SETTORE LIKE 'CON%' AND EXPIRY_TS IS NULL
"""
_ALLOWED = " OR ".join(
    f"(agreement = '{a}' AND lot IN ({', '.join(repr(x) for x in lots)}))"
    for a, lots in MasterParams(as_of=dt.date(2001, 1, 15)).tender_lots.items()
)
view("tender_sql", _SECTOR)
view(
    "tender_offers",
    f"""
SELECT COD_OFFERTA, max(agreement) AS CONSIP, min(lot) AS LOTTO
FROM (SELECT CODICE_CONTRATTO_SFA AS COD_OFFERTA, agreement, lot FROM {{assets}} a
      JOIN {{tender_sql}} s ON s.PK_METODI_PAGAMENTO = a.FK_METODI_PAGAMENTO WHERE a.EXPIRY_TS IS NULL
      UNION SELECT coalesce(CODICE_OFFERTA, CODICE_OPPORTUNITY), agreement, lot FROM {{requests}} r
      JOIN {{tender_sql}} s ON s.PK_METODI_PAGAMENTO = r.FK_METODI_PAGAMENTO WHERE r.EXPIRY_TS IS NULL)
WHERE COD_OFFERTA IS NOT NULL AND ({_ALLOWED}) GROUP BY 1
""",
)


@query("tender_agreements", "SELECT COD_OFFERTA, CONSIP, LOTTO FROM {tender_offers}")
def tender_agreements(spark, sf_dir):
    """Agreement and lot per offer over two join paths and an allow-list."""
    payments, assets, requests = (load(spark, sf_dir, n) for n in ("payments", "assets", "requests"))
    return tender_rows(payments, assets, requests, MasterParams(as_of=dt.date(2001, 1, 15)))


@query(
    "sector_decode",
    """
SELECT PK_METODI_PAGAMENTO, SETTORE,
       CASE WHEN SETTORE LIKE 'CON__L%' THEN 'CONSIP' || SETTORE[4:5] WHEN SETTORE LIKE 'CON2880%' THEN 'CONSIP23' END AS CONSIP,
       CASE WHEN SETTORE LIKE 'CON__L%' THEN right(left(SETTORE, 8), 2) WHEN SETTORE LIKE 'CON2880%' THEN right(left(SETTORE, 10), 2) END AS LOTTO
FROM {payments}
""",
)
def sector_decode(spark, sf_dir):
    rows = load(spark, sf_dir, "payments")
    return rows.select("PK_METODI_PAGAMENTO", "SETTORE", tender_agreement().alias("CONSIP"), tender_lot().alias("LOTTO"))


@query(
    "lookup_fan_out",
    """
SELECT n_nationkey, n_name, s_suppkey FROM {nation} LEFT JOIN {supplier} ON s_nationkey * 2 = n_nationkey
""",
)
def lookup_fan_out(spark, sf_dir):
    """Left lookup that keeps every match and every unmatched row."""
    doubled = load(spark, sf_dir, "supplier").withColumn("s_nationkey", F.col("s_nationkey") * 2)
    out = lookup(load(spark, sf_dir, "nation"), doubled, {"s_nationkey": "n_nationkey"}, "s")
    return out.select("n_nationkey", "n_name", F.col("s__s_suppkey").alias("s_suppkey"))


@query(
    "specific_or_wildcard",
    """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'riga ' || o_orderpriority WHEN 'O' THEN 'cliente ' || c_mktsegment ELSE 'base' END AS note
FROM {orders} JOIN {customer} ON c_custkey = o_custkey
""",
)
def specific_or_wildcard(spark, sf_dir):
    """One overlay whose source has rows with a row id and rows with a business key instead."""
    keys = ["o_orderkey", "o_custkey", "o_orderstatus"]
    orders = load(spark, sf_dir, "orders")
    rows = orders.select(*keys, F.lit("base").alias("note"))
    by_id = orders.where("o_orderstatus = 'F'").select(
        "o_orderkey", F.lit(None).cast("bigint").alias("o_custkey"), F.lit(None).cast("string").alias("o_orderstatus"),
        F.concat(F.lit("riga "), "o_orderpriority").alias("note"),
    )
    by_key = load(spark, sf_dir, "customer").select(
        F.lit(None).cast("bigint").alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.concat(F.lit("cliente "), "c_mktsegment").alias("note"),
    )
    return exact_or_wildcard(rows, by_id.unionByName(by_key), ["o_orderkey"], ["o_custkey", "o_orderstatus"], ["note"])


@query(
    "count_distinct_over",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       count(DISTINCT l_suppkey) OVER (PARTITION BY l_returnflag, l_linestatus, l_linenumber) AS n_suppliers FROM {lineitem}
""",
)
def distinct_over(spark, sf_dir):
    """Exact distinct count over very large groups, on every row."""
    keys = ["l_returnflag", "l_linestatus", "l_linenumber"]
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", *keys)
    return count_distinct_over(rows, keys, "l_suppkey", "n_suppliers").drop("l_returnflag", "l_linestatus")


@query(
    "previous_month",
    """
SELECT o_custkey, CAST(mese AS VARCHAR) AS mese, CAST(prima AS VARCHAR) AS prima
FROM (SELECT o_custkey, mese, lag(mese) OVER (PARTITION BY o_custkey ORDER BY mese) AS prima FROM {customer_months})
WHERE prima IS NOT NULL
""",
)
def previous_month(spark, sf_dir):
    """Previous month of each customer, rows without one dropped (filter on a window)."""
    rows = load(spark, sf_dir, "customer_months").select("o_custkey", "mese")
    prior = F.lag("mese").over(Window.partitionBy("o_custkey").orderBy("mese"))
    return qualify(rows.withColumn("prima", prior), {"_p": prior}, F.col("_p").isNotNull())


@query(
    "top1_per_group",
    """
SELECT o_custkey, o_orderkey, o_totalprice FROM {orders}
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) = 1
""",
)
def top1_per_group(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top1(orders, ["o_custkey"], ["o_totalprice", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@query(
    "append_common_columns",
    """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment FROM {customer}
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM {supplier}
""",
)
def append_common_columns(spark, sf_dir):
    """Append suppliers to customers by the columns both have."""
    target = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"),
    )
    source = load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("balance"),
    )
    return append_common(target, source)


@query(
    "append_mapped_columns",
    """
SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS code, c_name AS name, c_acctbal AS balance FROM {customer}
UNION ALL SELECT s_suppkey, CAST(s_suppkey AS VARCHAR), s_name, NULL FROM {supplier}
""",
)
def append_mapped_columns(spark, sf_dir):
    """Append with a column list that renames and uses one source column twice."""
    target = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    return append_mapped(target, load(spark, sf_dir, "supplier"), {"id": "s_suppkey", "code": "s_suppkey", "name": "s_name"})


@query(
    "union_distinct",
    """
SELECT c_nationkey AS nationkey FROM {customer} UNION SELECT s_nationkey FROM {supplier} UNION SELECT n_regionkey FROM {nation}
""",
)
def union_of_three(spark, sf_dir):
    return union_distinct(
        load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey")),
        load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey")),
        load(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("nationkey")),
    )


@query(
    "intersect_rows",
    """
SELECT c_nationkey AS nationkey, CAST(floor(c_acctbal / 1000) AS BIGINT) AS bucket FROM {customer}
INTERSECT SELECT s_nationkey, CAST(floor(s_acctbal / 1000) AS BIGINT) FROM {supplier}
""",
)
def intersect_rows(spark, sf_dir):
    a = load(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nationkey"), F.floor(F.col("c_acctbal") / 1000).alias("bucket")
    )
    b = load(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), F.floor(F.col("s_acctbal") / 1000).alias("bucket")
    )
    return intersect_distinct(a, b)


@query(
    "snapshot_append",
    """
SELECT o_custkey, sum(o_totalprice > 200000)::BIGINT AS alti, '2001-01-14' AS DATA_LANCIO FROM {orders} GROUP BY 1
UNION ALL SELECT o_custkey, sum(o_totalprice > 300000)::BIGINT, '2001-01-15' FROM {orders} GROUP BY 1
""",
)
def snapshot_append(spark, sf_dir):
    """Two dated runs in one history; the second one is run again with another limit and replaces itself."""
    path = f"{Workspace(spark).path}/history"
    orders = load(spark, sf_dir, "orders")
    for day, least in ((14, 200000), (15, 100000), (15, 300000)):
        n = F.count(F.when(F.col("o_totalprice") > least, F.lit(1)))
        append_snapshot(orders.groupBy("o_custkey").agg(n.alias("alti")), path, dt.date(2001, 1, day))
    return spark.read.parquet(path)


view(
    "published_corrected",
    """
SELECT COMMODITY_G_E, ID_DETTAGLIO, VOLUME_COPERTO_MC_MWH, DATA_DELIVERY, CASE WHEN month(DATA_DELIVERY) = 3 AND COMMODITY_G_E = 'E'
       THEN MARGINE_MP_EUR + 5 ELSE MARGINE_MP_EUR END AS MARGINE_MP_EUR
FROM {published} WHERE DATA_DELIVERY <> CAST('1997-05-01' AS DATE)
""",
)
_PUBLISHED = ["COMMODITY_G_E", "ID_DETTAGLIO", "VOLUME_COPERTO_MC_MWH", "DATA_DELIVERY", "MARGINE_MP_EUR"]


@query(
    "publish_by_month",
    """
SELECT COMMODITY_G_E, ID_DETTAGLIO, VOLUME_COPERTO_MC_MWH, MARGINE_MP_EUR, CAST(DATA_DELIVERY AS VARCHAR) AS DATA_DELIVERY
FROM {published_corrected}
""",
)
def publish_by_month(spark, sf_dir):
    """Full publication into month folders, then one that changes the months of March and drops a month; read back."""
    work = Workspace(spark)
    new, _ = rotate(work.path, "published", "2001-01-15", "2001-01-14")
    publish(load(spark, sf_dir, "published").select(*_PUBLISHED), new, "DATA_DELIVERY", ["COMMODITY_G_E"], work=work)
    publish(load(spark, sf_dir, "published_corrected").select(*_PUBLISHED), new, "DATA_DELIVERY", ["COMMODITY_G_E"], work=work)
    return spark.read.parquet(new)


@query(
    "diff_published_months",
    """
SELECT a.ID_DETTAGLIO, CAST(a.DATA_DELIVERY AS VARCHAR) AS DATA_DELIVERY, a.MARGINE_MP_EUR AS MARGINE_MP_EUR_OLD,
       b.MARGINE_MP_EUR AS MARGINE_MP_EUR_NEW, round(a.MARGINE_MP_EUR - b.MARGINE_MP_EUR, 0) AS DELTA_MARGINE_MP_EUR,
       'KO' AS CHECK_MARGINE_MP_EUR
FROM {published} a JOIN {published_corrected} b ON b.ID_DETTAGLIO = a.ID_DETTAGLIO AND b.DATA_DELIVERY = a.DATA_DELIVERY
WHERE round(a.MARGINE_MP_EUR - b.MARGINE_MP_EUR, 0) <> 0
""",
)
def diff_published_months(spark, sf_dir):
    """Rows that differ between two published versions; months with equal digests aren't read."""
    work = Workspace(spark)
    new, old = rotate(work.path, "published", "2001-01-15", "2001-01-14")
    for view_name, path in (("published", old), ("published_corrected", new)):
        publish(load(spark, sf_dir, view_name).select(*_PUBLISHED), path, work=work)
    return diff_published(spark, old, new, ["ID_DETTAGLIO"], ["MARGINE_MP_EUR"], "MARGINE_MP_EUR")


@query(
    "publish_totals",
    f"""
SELECT {milli_sql('sum(MARGINE_MP_EUR)')} AS TOTALE, count(*) AS RIGHE, count(*) - count(VOLUME_COPERTO_MC_MWH) AS SENZA_VOLUME
FROM {{published}}
""",
)
def publish_totals(spark, sf_dir):
    """Control totals observed by the write of a publication, without a pass of their own."""
    work = Workspace(spark)
    totals = {
        "TOTALE": milli(F.sum("MARGINE_MP_EUR")), "RIGHE": F.count(F.lit(1)),
        "SENZA_VOLUME": F.count_if(F.col("VOLUME_COPERTO_MC_MWH").isNull()),
    }
    seen = publish(load(spark, sf_dir, "published").select(*_PUBLISHED), f"{work.path}/published", totals=totals, work=work)
    return spark.createDataFrame([tuple(seen[n] for n in totals)], "TOTALE string, RIGHE long, SENZA_VOLUME long")


@query(
    "status_reset",
    "SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END AS BIGINT) AS STATO FROM {orders}",
)
def status_reset(spark, sf_dir):
    """Running states go back to 0, other states stay."""
    state = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "P", 0).otherwise(2)
    return reset_status(load(spark, sf_dir, "orders").select("o_orderkey", state.alias("STATO")))


@query("row_key_check", "SELECT ID_DETTAGLIO, CAST(1 AS BIGINT) AS n FROM {details}")
def row_key_check(spark, sf_dir):
    """Counts per row key; a repeated key raises."""
    return assert_unique(load(spark, sf_dir, "details"), ["ID_DETTAGLIO"])
