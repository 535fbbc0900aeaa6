"""Registration of queries and the views they share.

A view template is plain SQL that Spark and the checking engine both read: table
names stand in braces, and Spark fills them with DataFrames.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.session import tune
from gridledger.sources import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The given tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
}

#: The run date of all registered queries.
AS_OF = dt.date(2001, 1, 15)

VIEWS: dict[str, str] = {}
#: View -> (joins as registered, the same inner and left joins in another order for Spark).
JOIN_ORDERS: dict[str, tuple[str, str]] = {}


def view(name: str, sql: str, joins: str | None = None, grouped: str | None = None) -> str:
    """Register a shared view template.

    Spark joins tables in the order of the text. ``grouped`` replaces the part ``joins`` of the
    text for Spark: the same joins in another order, so that short rows meet before long ones.
    """
    VIEWS[name] = sql.strip()
    if joins is not None:
        if VIEWS[name].count(joins) != 1:
            raise ValueError(f"{name} doesn't have these joins once")
        JOIN_ORDERS[name] = (joins, grouped)
    return name


def load(spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame] | None = None) -> DataFrame:
    """A given table or a shared view.

    ``known`` holds what was loaded before, so views that share views build them once.
    """
    known = {} if known is None else known
    if name not in known:
        if name in SCHEMAS:
            known[name] = _table(spark, sf_dir, name)
        else:
            sql = VIEWS[name]
            if name in JOIN_ORDERS:
                sql = sql.replace(*JOIN_ORDERS[name])
            used = sorted(set(re.findall(r"\{(\w+)\}", sql)))
            known[name] = spark.sql(sql, **{t: load(spark, sf_dir, t, known) for t in used})
    return known[name]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name, SCHEMAS[name], ".parquet")


def _with_views(sql: str) -> str:
    """Prefix the common table expressions a statement refers to."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\{(\w+)\}", text):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(sql)
    body = re.sub(r"\{(\w+)\}", r"\1", sql.strip())
    ctes = ",\n".join(f"{n} AS ({re.sub(r'{(\w+)}', r'\1', VIEWS[n])})" for n in ordered)
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def query(name: str, oracle: str | None):
    """Register ``fn(spark, sf_dir)`` and the SQL for the same rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(tune(spark), sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = _with_views(oracle)
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that any client compares them the same way."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        kind = f.dataType.simpleString()
        if kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def milli(c: Column | str) -> Column:
    """Thousandths, cut away from ties so that summation order cannot show."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 1000 + 0.37).cast("string")


def milli_sql(c: str) -> str:
    return f"CAST(CAST(floor(({c}) * 1000 + 0.37) AS BIGINT) AS VARCHAR)"
