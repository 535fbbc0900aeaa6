"""Forecast queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

import gridledger.plans.forecasting as plan
from gridledger import params as P
from gridledger.catalog import forecast_sql as S
from gridledger.catalog.registry import AS_OF, load, milli, query, view
from gridledger.operators import (
    calendar_frame,
    delete_matching,
    fill_last,
    first_month,
    keep_extreme,
    keep_matching,
    last_month,
    month_date,
)
from gridledger.session import Workspace
from gridledger.sources import append_snapshot, publish, rotate
from gridledger.tables import SELLER_COLUMNS

G, DATE, KEY, KIND = plan.G, plan.DATE, plan.KEY, plan.KIND


@query("forecast_pipeline", S.RESULT_SQL)
def forecast_pipeline(spark, sf_dir):
    """Booked rows, projections, mean rows and their reconciliation."""
    return _shown(_forecast(spark, sf_dir, "published", S.RUN))


@query("forecast_pipeline_no_key", S.RESULT_NO_KEY_SQL)
def forecast_pipeline_no_key(spark, sf_dir):
    """The same without a row key, over rows with copies and with exchanged nulls."""
    return _shown(_forecast(spark, sf_dir, "published_twice", S.RUN_NO_KEY))


@query("forecast_published", S.RESULT_SQL)
def forecast_published(spark, sf_dir):
    """The forecast written by month, read back, and kept as a dated snapshot that is read back."""
    work = Workspace(spark)
    new, _ = rotate(work.path, "forecast", "2001-01-15", "2001-01-14")
    out = _forecast(spark, sf_dir, "published", S.RUN)
    publish(out, new, DATE, [G], work=work)
    append_snapshot(spark.read.parquet(new).select(*out.columns), f"{work.path}/history", AS_OF)
    history = spark.read.parquet(f"{work.path}/history")
    return _shown(history.where(F.col("DATA_LANCIO") == F.lit(AS_OF)).select(*out.columns))


def _forecast(spark, sf_dir, table, run):
    work = Workspace(spark)
    return plan.forecast(work.stage(load(spark, sf_dir, table), "published"), run, work)


def _shown(out):
    return out.select(
        *S.PLAIN,
        *[milli(m).alias(m) for m in S.MEASURES],
        "DATA_DELIVERY", "PIVA_CFISC_FORECAST", "NOTE_PIVA_CFISC_FORECAST", "TIPO_PIVA_CFISC_FORECAST",
        F.col("PROIEZIONE_RANK").cast("string").alias("PROIEZIONE_RANK"), "PROIEZIONE_NOTE",
        F.col("PROIEZIONE_DATA_DELIVERY").cast("date").alias("PROIEZIONE_DATA_DELIVERY"),
        F.col("CODE_MIN_DATA_DELIVERY").cast("date").alias("CODE_MIN_DATA_DELIVERY"),
        "CHIAVE_CLIENTE_FORECAST", "NOTE_FORECAST",
    )


def _base(spark, sf_dir):
    return plan.base_rows(load(spark, sf_dir, "published"), S.RUN)


def _points(spark, sf_dir):
    """Month maps of the points, from one pass over the published rows."""
    work = Workspace(spark)
    return work.stage(plan.customers(plan.point_months(plan.with_regular(_base(spark, sf_dir))), S.RUN, work), "points")


def _staged(spark, sf_dir, measures=(plan.VOLUME,)):
    """Classified cells and the points' month maps, with the measures that a query reads and no identity texts."""
    work = Workspace(spark)
    cells = work.stage(plan.month_cells(_base(spark, sf_dir), S.RUN, measures, ()), "month_cells")
    points = work.stage(plan.customers(plan.point_months(cells), S.RUN, work), "points")
    return work.stage(plan.classify(cells, points), "cells"), points


def _cells(spark, sf_dir, measures=(plan.VOLUME,)):
    return _staged(spark, sf_dir, measures)[0]


#: What choices and projections read of a key's month.
_CHOICE = (G, KEY, "SEMPRE", DATE, "PRIMA_DATA", plan.VOLUME, "TUTTI_ID")


def _targets(cells, months=None, more=()):
    months = plan.key_months(cells) if months is None else months
    chosen = plan.choose_sources(months.select(*_CHOICE, *more), S.RUN)
    return plan.project_sources(chosen, cells, S.RUN)


@query(
    "party_key_fallback",
    "SELECT ID_DETTAGLIO, party AS PIVA_CFISC_FORECAST, origin AS NOTE_PIVA_CFISC_FORECAST FROM {f_base}",
)
def party_key_fallback(spark, sf_dir):
    return _base(spark, sf_dir).select("ID_DETTAGLIO", "PIVA_CFISC_FORECAST", "NOTE_PIVA_CFISC_FORECAST")


@query("classify_key_presence", "SELECT COMMODITY_G_E, party AS PIVA_CFISC_FORECAST, kind AS TIPO FROM {f_kind}")
def classify_key_presence(spark, sf_dir):
    """Customers that always, never or sometimes have a supply point."""
    kinds = _points(spark, sf_dir).where(F.col(KIND).isNotNull())
    return kinds.select(G, "PIVA_CFISC_FORECAST", F.col(KIND).alias("TIPO")).distinct()


@query(
    "first_last_month",
    """
SELECT COMMODITY_G_E, ckey AS CHIAVE, CAST(min(DATA_DELIVERY) AS VARCHAR) AS PRIMA, CAST(max(DATA_DELIVERY) AS VARCHAR) AS ULTIMA
FROM {f_keyed} WHERE ckey IS NOT NULL GROUP BY 1, 2
""",
)
def first_last_month(spark, sf_dir):
    keyed = _points(spark, sf_dir).where(F.col(KEY).isNotNull())
    ends = keyed.groupBy(G, F.col(KEY).alias("CHIAVE")).agg(
        F.min(first_month("MESI")).alias("PRIMA"), F.max(last_month("MESI")).alias("ULTIMA")
    )
    return ends.withColumns({c: month_date(F.col(c)) for c in ("PRIMA", "ULTIMA")})


@query(
    "lapsed_keys",
    f"SELECT DISTINCT COMMODITY_G_E, party AS PIVA_CFISC_FORECAST FROM {{f_booked}} WHERE note = '{P.NOTE_LAPSED}'",
)
def lapsed_keys(spark, sf_dir):
    return _points(spark, sf_dir).where("CESSATO").select(G, "PIVA_CFISC_FORECAST").distinct()


@query(
    "month_calendar",
    """
SELECT CAST(month AS VARCHAR) AS MESE, count(b.DATA_DELIVERY) AS RIGHE, coalesce(sum(b.VOLUME_COPERTO_MC_MWH), 0) AS VOLUME
FROM {f_calendar} LEFT JOIN {f_base} b ON b.DATA_DELIVERY = month GROUP BY 1
""",
)
def month_calendar(spark, sf_dir):
    """Booked rows and volume on each month of the projection calendar."""
    booked = _base(spark, sf_dir).groupBy(DATE).agg(
        F.count(F.lit(1)).alias("RIGHE"), F.sum("VOLUME_COPERTO_MC_MWH").alias("VOLUME")
    )
    out = calendar_frame(spark, S.RUN.calendar).join(booked, DATE, "left")
    return out.select(
        F.col(DATE).alias("MESE"), F.coalesce("RIGHE", F.lit(0)).alias("RIGHE"), F.coalesce("VOLUME", F.lit(0.0)).alias("VOLUME")
    )


@query(
    "gap_months",
    """
SELECT COMMODITY_G_E, ckey AS CHIAVE_CLIENTE_FORECAST, CAST(month AS VARCHAR) AS MESE_BUCO,
       CAST(prev AS VARCHAR) AS PREV_DATA_DELIVERY, fill AS RIEMPIBILE FROM {f_gaps}
""",
)
def gaps(spark, sf_dir):
    return plan.key_gaps(_points(spark, sf_dir), S.RUN)


@query(
    "latest_per_month_of_year",
    """
SELECT ID_DETTAGLIO, PDP, COMMODITY_G_E, CAST(DATA_DELIVERY AS VARCHAR) AS DATA_DELIVERY FROM {published}
QUALIFY dense_rank() OVER (PARTITION BY PDP, month(DATA_DELIVERY), COMMODITY_G_E ORDER BY DATA_DELIVERY DESC) = 1
""",
)
def latest_per_month_of_year(spark, sf_dir):
    """Latest rows per point, month of the year and commodity, ties kept."""
    rows = load(spark, sf_dir, "published").select("ID_DETTAGLIO", "PDP", G, DATE).withColumn("MESE", F.month(DATE))
    return keep_extreme(rows, ["PDP", "MESE", G], DATE).drop("MESE")


_TARGET_SQL = """
SELECT DISTINCT COMMODITY_G_E, ckey AS CHIAVE, CAST(source_month AS VARCHAR) AS ORIGINE,
       CAST(DATA_DELIVERY AS VARCHAR) AS MESE_PROIETTATO, year_rank AS PROIEZIONE_RANK, why AS PROIEZIONE_NOTE FROM {%s}
"""


def _target_columns(df):
    return df.select(
        G, F.col(KEY).alias("CHIAVE"), F.col(DATE).alias("ORIGINE"), "MESE_PROIETTATO", "PROIEZIONE_RANK", "PROIEZIONE_NOTE"
    )


@query("project_point", _TARGET_SQL % "f_point")
def project_point(spark, sf_dir):
    """Latest months of point customers on the calendar, where the point is not booked."""
    return _target_columns(_targets(_cells(spark, sf_dir)).where("SEMPRE"))


@query("project_party", _TARGET_SQL % "f_party")
def project_party(spark, sf_dir):
    """Chosen months of the other customers on the calendar."""
    return _target_columns(_targets(_cells(spark, sf_dir)).where(~F.col("SEMPRE")))


@query(
    "tolerance_choice",
    """
SELECT COMMODITY_G_E, party AS CHIAVE, CAST(DATA_DELIVERY AS VARCHAR) AS DATA_DELIVERY, rk AS PROIEZIONE_RANK,
       why AS PROIEZIONE_NOTE FROM {f_chosen}
""",
)
def tolerance_choice(spark, sf_dir):
    """Year rank to project: not too far below the next older year."""
    months = plan.key_months(_cells(spark, sf_dir)).select(*_CHOICE)
    chosen = plan.choose_sources(months, S.RUN).where(~F.col("SEMPRE"))
    return chosen.select(G, F.col(KEY).alias("CHIAVE"), DATE, "PROIEZIONE_RANK", "PROIEZIONE_NOTE")


@query("month_grid_missing", "SELECT COMMODITY_G_E, ckey AS CHIAVE, CAST(moy AS BIGINT) AS MESE FROM {f_missing}")
def month_grid_missing(spark, sf_dir):
    """Months of the year in which a projected key was never booked."""
    cells, points = _staged(spark, sf_dir)
    seen = keep_matching(plan.seen_months(points), _targets(cells), [G, KEY])
    grid = seen.withColumn("MESE", F.explode(F.sequence(F.lit(1), F.lit(12))))
    return grid.where(F.getbit("_seen", F.col("MESE") - 1) == 0).select(G, F.col(KEY).alias("CHIAVE"), "MESE")


@query(
    "mean_profile",
    f"""
SELECT COMMODITY_G_E, ckey AS CHIAVE, CAST(DATA_DELIVERY AS VARCHAR) AS DATA_DELIVERY,
       {", ".join(f"{S.milli_sql(m)} AS {m}" for m in S.MEASURES)} FROM {{f_mean}}
""",
)
def mean_profile(spark, sf_dir):
    """Mean of monthly means, on calendar months without history."""
    cells = _cells(spark, sf_dir, S.MEASURES)
    months = Workspace(spark).stage(plan.key_months(cells).drop("PIVA_CFISC_FORECAST", KIND), "months")
    out = plan.mean_rows(months, _targets(cells, months), cells, S.RUN)
    return out.select(G, F.col(KEY).alias("CHIAVE"), DATE, *[milli(m).alias(m) for m in S.MEASURES])


@query("prevailing_seller", f"SELECT COMMODITY_G_E, ckey AS CHIAVE, {S.SELLERS} FROM {{f_seller}}")
def prevailing_seller(spark, sf_dir):
    """Seller with the largest volume in the last booked month."""
    last = plan.last_booked_rows(_base(spark, sf_dir), _cells(spark, sf_dir))
    return plan.prevailing(last, SELLER_COLUMNS).select(G, F.col(KEY).alias("CHIAVE"), *SELLER_COLUMNS)


view(
    "customer_months",
    """
SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mese,
       max(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS priority,
       max(CASE WHEN o_totalprice > 250000 THEN o_totalprice END) AS price
FROM {orders} GROUP BY 1, 2
""",
)
_FILL = """
SELECT o_custkey, CAST(mese AS VARCHAR) AS mese,
       last_value(priority IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY mese%s ROWS UNBOUNDED PRECEDING) AS priority,
       last_value(price IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY mese%s ROWS UNBOUNDED PRECEDING) AS price
FROM {customer_months}
"""


@query("fill_last_desc", _FILL % (" DESC", " DESC"))
def fill_last_desc(spark, sf_dir):
    """Missing values from the nearest later month."""
    rows = load(spark, sf_dir, "customer_months")
    return fill_last(rows, ["priority", "price"], Window.partitionBy("o_custkey").orderBy(F.col("mese").desc()))


@query("fill_last_asc", _FILL % ("", ""))
def fill_last_asc(spark, sf_dir):
    """Missing values from the nearest earlier month."""
    rows = load(spark, sf_dir, "customer_months")
    return fill_last(rows, ["priority", "price"], Window.partitionBy("o_custkey").orderBy("mese"))


@query(
    "reconcile_choice",
    "SELECT COMMODITY_G_E, ckey AS CHIAVE, CAST(DATA_DELIVERY AS VARCHAR) AS DATA_DELIVERY, loser AS PERDENTE FROM {f_losers}",
)
def reconcile_choice(spark, sf_dir):
    """Booked against projected volume where a key has both in a month."""
    work = Workspace(spark)
    cells, points = _staged(spark, sf_dir)
    months = work.stage(plan.key_months(cells), "months")
    targets = work.stage(_targets(cells, months, ("VOLUME_DISTINTO", *plan.ORIGIN[::2])), "targets")
    means = work.stage(plan.mean_rows(months, targets, cells, S.RUN), "means")
    means = plan.enrich_means(means, targets, cells)
    never = plan.key_gaps(points, S.RUN).where(~F.col("RIEMPIBILE"))
    targets = delete_matching(targets, never.withColumnRenamed("MESE_BUCO", "MESE_PROIETTATO"), [G, KEY, "MESE_PROIETTATO"])
    means = delete_matching(means, never.withColumnRenamed("MESE_BUCO", DATE), [G, KEY, DATE])
    return plan.reconcile(cells, targets, means).select(G, F.col(KEY).alias("CHIAVE"), DATE, "PERDENTE")
