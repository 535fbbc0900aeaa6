"""Row-update queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridledger.catalog import views  # noqa: F401
from gridledger.catalog.registry import load, milli, milli_sql, query, view
from gridledger.operators import (
    assign,
    attach,
    attach_range,
    control_total,
    delete_matching,
    detach,
    diff_tables,
    keep_matching,
    matched,
    merge_update,
    overlay,
    update_where,
)
from gridledger.session import Workspace
from gridledger.sources import rotate

view(
    "order_sums",
    """
SELECT o_custkey AS custkey, count(*) AS n, sum(CAST(floor(o_totalprice) AS DOUBLE)) AS total,
       max(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS priority
FROM {orders} GROUP BY 1
""",
)
_LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "merge_update_matched",
    """
SELECT c_custkey, CASE WHEN s.custkey IS NULL THEN c_mktsegment ELSE s.priority END AS segment,
       CASE WHEN s.custkey IS NULL THEN c_acctbal ELSE s.total + s.n END AS balance
FROM {customer} LEFT JOIN {order_sums} s ON s.custkey = c_custkey
""",
)
def merge_update_matched(spark, sf_dir):
    """Matched rows take source values, nulls included; others stay."""
    target = load(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    new = {"segment": "s__priority", "balance": "s__total + s__n"}
    return merge_update(target, load(spark, sf_dir, "order_sums"), {"custkey": "c_custkey"}, new)


@query(
    "merge_conditional",
    """
SELECT c_custkey, c_mktsegment AS segment,
       CASE WHEN s.total > 600000 AND c_mktsegment NOT LIKE 'F%' THEN s.total ELSE c_acctbal END AS balance
FROM {customer} LEFT JOIN {order_sums} s ON s.custkey = c_custkey
""",
)
def merge_conditional(spark, sf_dir):
    """Update under an extra condition on both sides, on a split key."""
    target = load(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    when = "s__total > 600000 AND segment NOT LIKE 'F%'"
    return merge_update(
        target, load(spark, sf_dir, "order_sums"), {"custkey": "c_custkey"}, {"balance": "s__total"}, when,
        split=True,
    )


@query(
    "merge_duplicates_outside",
    """
SELECT c_custkey, c_mktsegment AS segment,
       CASE WHEN c_custkey % 3 = 0 THEN coalesce((SELECT max(o_totalprice) FROM {orders} WHERE o_custkey = c_custkey AND c_custkey % 3 = 0), c_acctbal)
            ELSE c_acctbal END AS balance
FROM {customer}
""",
)
def merge_duplicates_outside(spark, sf_dir):
    """Source rows that repeat a key are no error where the condition leaves the target row out."""
    target = load(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    best = orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("o_totalprice")).where("o_custkey % 3 = 0")
    source = best.unionByName(orders.where("o_custkey % 3 <> 0"))
    return merge_update(target, source, {"o_custkey": "c_custkey"}, {"balance": "s__o_totalprice"}, "c_custkey % 3 = 0")


view(
    "part_named",
    "SELECT p_partkey, CASE WHEN p_size > 20 THEN p_name END AS name, CASE WHEN p_size > 30 THEN p_brand END AS brand FROM {part}",
)


@query(
    "merge_target_first",
    """
SELECT a.p_partkey, coalesce(a.name, b.p_type) AS name, coalesce(a.brand, b.p_brand) AS brand
FROM {part_named} a LEFT JOIN {part} b ON b.p_partkey + 7 = a.p_partkey
""",
)
def merge_target_first(spark, sf_dir):
    """Fill missing target values from the source."""
    source = load(spark, sf_dir, "part").withColumn("p_partkey", F.col("p_partkey") + 7)
    return overlay(load(spark, sf_dir, "part_named"), source, ["p_partkey"], {"name": "p_type", "brand": "p_brand"}, "target")


@query(
    "overlay_two_pass",
    """
SELECT o_orderkey, coalesce(p.tag, g.tag) AS tag, coalesce(p.level, g.level, 'nessuno') AS level
FROM {orders}
LEFT JOIN (SELECT c_custkey, c_mktsegment AS tag, CASE WHEN c_acctbal > 0 THEN 'credito' END AS level FROM {customer}) g
       ON g.c_custkey = o_custkey
LEFT JOIN (SELECT o_custkey, o_orderpriority, max(CASE WHEN o_totalprice > 400000 THEN 'grande' END) AS tag,
                  max(CASE WHEN o_orderstatus = 'F' THEN 'chiuso' END) AS level FROM {orders} GROUP BY 1, 2) p
       ON p.o_custkey = {orders}.o_custkey AND p.o_orderpriority = {orders}.o_orderpriority
""",
)
def overlay_two_pass(spark, sf_dir):
    """Values per customer, then values per customer and priority over them."""
    orders = load(spark, sf_dir, "orders")
    rows = orders.select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.lit(None).cast("string").alias("tag"), F.lit("nessuno").alias("level")
    )
    general = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("tag"),
        F.when(F.col("c_acctbal") > 0, "credito").alias("level"),
    )
    special = orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.max(F.when(F.col("o_totalprice") > 400000, "grande")).alias("tag"),
        F.max(F.when(F.col("o_orderstatus") == "F", "chiuso")).alias("level"),
    )
    rows = overlay(rows, general, ["o_custkey"], ["tag", "level"], split=True)
    rows = overlay(rows, special, ["o_custkey", "o_orderpriority"], ["tag", "level"], split=True)
    return rows.select("o_orderkey", "tag", "level")


@query(
    "simultaneous_update",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_returnflag = 'R' THEN l_quantity * 2 ELSE l_quantity END AS quantity,
       CASE WHEN l_returnflag = 'R' THEN l_quantity + l_linenumber ELSE l_extendedprice END AS price
FROM {lineitem}
""",
)
def simultaneous_update(spark, sf_dir):
    """Both right-hand sides read the old quantity."""
    rows = load(spark, sf_dir, "lineitem").select(
        *_LINES, "l_returnflag", F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price")
    )
    return update_where(rows, "l_returnflag = 'R'", {"quantity": "quantity * 2", "price": "quantity + l_linenumber"}).drop(
        "l_returnflag"
    )


view(
    "seller_versions",
    """
SELECT lower(s_name) AS VENDITORE_ORIG, CAST('1990-01-01' AS DATE) AS DAL, CAST('1998-12-31' AS DATE) AS AL, n_name AS AREA,
       CASE WHEN s_acctbal > 0 THEN r_name END AS MACRO_AREA
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
UNION ALL
SELECT upper(s_name), CAST('1999-01-01' AS DATE), CAST('2099-12-31' AS DATE), 'NUOVA ' || n_name, r_name
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey WHERE s_acctbal > 2000
""",
)


@query(
    "seller_attributes_range",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(v.AREA, 'ND') AS AREA, coalesce(v.MACRO_AREA, 'ND') AS MACRO_AREA
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
LEFT JOIN {seller_versions} v ON upper(v.VENDITORE_ORIG) = upper(s_name) AND CAST(l_shipdate AS DATE) BETWEEN v.DAL AND v.AL
""",
)
def seller_attributes_range(spark, sf_dir):
    """Sales attributes of the seller version valid on the date, names compared without case."""
    names = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = load(spark, sf_dir, "lineitem").join(names, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.select(*_LINES, "l_shipdate", "s_name", F.lit("ND").alias("AREA"), F.lit("ND").alias("MACRO_AREA"))
    versions = load(spark, sf_dir, "seller_versions").withColumn("k", F.upper("VENDITORE_ORIG"))
    out = attach_range(rows, versions, {"k": F.upper("s_name")}, F.to_date("l_shipdate"), "DAL", "AL", "v", split=True)
    new = {c: F.coalesce(f"v__{c}", c) for c in ("AREA", "MACRO_AREA")}
    return detach(assign(out, new, matched("v")), "v").drop("l_shipdate", "s_name")


@query(
    "delete_semi",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {lineitem}
WHERE NOT (l_returnflag = 'R' AND EXISTS (SELECT 1 FROM {orders} WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F'
                                          AND o_orderpriority < '4'))
""",
)
def delete_semi(spark, sf_dir):
    """Delete rows with a note and a key on a list, on real columns."""
    rows = load(spark, sf_dir, "lineitem").select(*_LINES, "l_returnflag")
    listed = load(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_orderpriority < '4'")
    listed = listed.select(F.col("o_orderkey").alias("l_orderkey"), F.lit("R").alias("l_returnflag"))
    return delete_matching(rows, listed, ["l_orderkey", "l_returnflag"]).drop("l_returnflag")


@query(
    "keep_semi",
    "SELECT o_orderkey FROM {orders} WHERE o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_acctbal > 3000)",
)
def keep_semi(spark, sf_dir):
    rich = load(spark, sf_dir, "customer").where("c_acctbal > 3000").select(F.col("c_custkey").alias("o_custkey"))
    return keep_matching(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), rich, ["o_custkey"]).drop("o_custkey")


view(
    "order_margin",
    """
SELECT l_orderkey AS ID, sum(CAST(floor(l_extendedprice) AS DOUBLE)) AS MARGINE, sum(l_quantity) AS VOLUME FROM {lineitem} GROUP BY 1
""",
)
view(
    "order_margin_changed",
    """
SELECT l_orderkey AS ID, sum(CAST(floor(l_extendedprice) AS DOUBLE) + CASE WHEN l_tax = 0.03 THEN 0.25 WHEN l_tax = 0.04 THEN 7 ELSE 0 END) AS MARGINE,
       CASE WHEN max(l_discount) > 0.09 THEN NULL ELSE sum(l_quantity) END AS VOLUME
FROM {lineitem} WHERE l_tax < 0.08 GROUP BY 1
""",
)


@query(
    "diff_versions",
    """
SELECT a.ID, a.MARGINE AS MARGINE_OLD, b.MARGINE AS MARGINE_NEW, round(a.MARGINE - b.MARGINE, 0) AS DELTA_MARGINE, 'KO' AS CHECK_MARGINE,
       a.VOLUME AS VOLUME_OLD, b.VOLUME AS VOLUME_NEW, round(a.VOLUME - b.VOLUME, 0) AS DELTA_VOLUME,
       CASE WHEN round(a.VOLUME - b.VOLUME, 0) <> 0 THEN 'KO' ELSE 'OK' END AS CHECK_VOLUME
FROM {order_margin} a LEFT JOIN {order_margin_changed} b ON b.ID = a.ID WHERE round(a.MARGINE - b.MARGINE, 0) <> 0
""",
)
def diff_versions(spark, sf_dir):
    """Rows whose rounded margin differs between two versions."""
    old, new = load(spark, sf_dir, "order_margin"), load(spark, sf_dir, "order_margin_changed")
    return diff_tables(old, new, ["ID"], ["MARGINE", "VOLUME"], failing="MARGINE")


@query(
    "rotate_and_compare",
    """
SELECT a.ID, a.MARGINE AS MARGINE_OLD, b.MARGINE AS MARGINE_NEW, round(a.MARGINE - b.MARGINE, 2) AS DELTA_MARGINE,
       CASE WHEN round(a.MARGINE - b.MARGINE, 2) <> 0 THEN 'KO' ELSE 'OK' END AS CHECK_MARGINE
FROM {order_margin} a LEFT JOIN {order_margin_changed} b ON b.ID = a.ID
""",
)
def rotate_and_compare(spark, sf_dir):
    """Keep the former version, write the new one beside it, read both back and compare them."""
    new, old = rotate(Workspace(spark).path, "margins", "2001-01-15", "2001-01-14")
    load(spark, sf_dir, "order_margin").write.parquet(old)
    load(spark, sf_dir, "order_margin_changed").write.parquet(new)
    return diff_tables(spark.read.parquet(old), spark.read.parquet(new), ["ID"], ["MARGINE"], decimals=2)


@query("control_total", f"SELECT {milli_sql('sum(MARGINE)')} AS TOTALE FROM {{order_margin}}")
def control(spark, sf_dir):
    return control_total(load(spark, sf_dir, "order_margin"), "MARGINE").select(milli("TOTALE").alias("TOTALE"))


@query(
    "published_flag_rules",
    """
SELECT ID_OFFERTA, CASE WHEN o.COD_OFFERTA LIKE '%PPA%' OR (o.COD_OFFERTA LIKE '%F%' AND RAGIONE_SOCIALE LIKE '%00%') THEN 'N'
            ELSE coalesce(b.flag, a.flag, 'S') END AS FLG
FROM {offers} o
LEFT JOIN (SELECT CODICE_OFFERTA AS c, min(CASE WHEN TIPOLOGIA_PDR < '2' THEN 'N' END) AS flag FROM {requests}
           WHERE EXPIRY_TS IS NULL GROUP BY 1) a ON a.c = o.COD_OFFERTA
LEFT JOIN (SELECT CODICE_OFFERTA AS c, max(CASE WHEN TIPOLOGIA_PDR > '2' THEN 'X' END) AS flag FROM {requests}
           WHERE EXPIRY_TS < TIMESTAMP '2001-01-15' GROUP BY 1) b ON b.c = o.COD_OFFERTA
""",
)
def published_flag_rules(spark, sf_dir):
    """Two flag updates in order, then flags forced by pattern."""
    rows = load(spark, sf_dir, "offers").select("ID_OFFERTA", "COD_OFFERTA", "RAGIONE_SOCIALE", F.lit("S").alias("FLG"))
    requests = load(spark, sf_dir, "requests")
    code = F.col("CODICE_OFFERTA").alias("COD_OFFERTA")
    tip = F.col("TIPOLOGIA_PDR")
    now = requests.where(F.col("EXPIRY_TS").isNull()).groupBy(code).agg(F.min(F.when(tip < "2", "N")).alias("flag"))
    before = F.col("EXPIRY_TS") < F.lit("2001-01-15").cast("timestamp_ntz")
    due = requests.where(before).groupBy(code).agg(F.max(F.when(tip > "2", "X")).alias("flag"))
    for source in (now, due):
        rows = overlay(rows, source, ["COD_OFFERTA"], {"FLG": "flag"}, split=True)
    forced = "COD_OFFERTA LIKE '%PPA%' OR (COD_OFFERTA LIKE '%F%' AND RAGIONE_SOCIALE LIKE '%00%')"
    return update_where(rows, forced, {"FLG": "'N'"}).select("ID_OFFERTA", "FLG")


@query(
    "own_source_coefficient",
    """
SELECT o_orderkey, o_totalprice * coalesce(c.k, 1) AS peak FROM {orders}
LEFT JOIN (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 0.25 END AS k FROM {customer}) c ON c.c_custkey = o_custkey
""",
)
def own_source_coefficient(spark, sf_dir):
    """Row-local formula with a coefficient looked up per offer."""
    coeff = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_acctbal") > 0, F.lit(0.25)).alias("k")
    )
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("peak"))
    out = attach(rows, coeff, ["o_custkey"], "c", split=True)
    return detach(assign(out, {"peak": "peak * coalesce(c__k, 1)"}, matched("c")), "c").drop("o_custkey")
