"""Volume and margin forecast: booked rows, projections, mean rows, reconciliation.

The published table is wide and large, the decisions need a dozen of its columns.
So the plan first reduces it to *cells*, one row per (commodity, party, point,
delivery date, regular offer or not), decides everything on cells and on the few
rows per customer key that follow from them, and touches the wide rows once: one
join to the cells, which carry the notes of the booked rows and the list of months
to project to. Customer keys may be very uneven, so joins back to cells split keys
by their known row counts, and windows run only on one row per key and month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridledger import params as P
from gridledger.functions import has_point, is_regular_offer, party_key
from gridledger.operators import (
    anti_join,
    append_common,
    assert_unique,
    delete_matching,
    fill_last,
    first_month,
    keep_matching,
    last_month,
    map_gaps,
    month_date,
    month_maps,
    months_of_year,
    project_on_calendar,
    row_digests,
    spread_join,
    top1,
)
from gridledger.operators.months import MAP_MONTHS, month_array, month_number
from gridledger.params import ForecastParams
from gridledger.session import Workspace
from gridledger.tables import BONUS, MARGIN_PARTS, PROFILE_MEASURES, SELLER_COLUMNS

G, DATE, KEY = "COMMODITY_G_E", "DATA_DELIVERY", "CHIAVE_CLIENTE_FORECAST"
PARTY, KIND, NOTE = "PIVA_CFISC_FORECAST", "TIPO_PIVA_CFISC_FORECAST", "NOTE_FORECAST"
VOLUME = "VOLUME_COPERTO_MC_MWH"
CELL = (G, PARTY, "PDP", DATE, "REGOLARE")
IDENTITY = ("RAG_SOC_OFFERTABILE", "COD_FISC_OFFERTABILE", "P_IVA_OFFERTABILE")
ORIGIN = (PARTY, "NOTE_PIVA_CFISC_FORECAST", KIND)
MEASURES = (*PROFILE_MEASURES, "MARGINE_TOTALE_EUR")


def base_rows(published: DataFrame, params: ForecastParams) -> DataFrame:
    """Published rows of the scenario with the party key, its origin and a booked note."""
    key, origin = party_key()
    scope = (F.col(DATE) < F.lit(params.scenario_end)) & (F.col("FLG_PUBBLICATO_S_N") == "S")
    return published.where(scope).select(
        "*",
        key.alias(PARTY),
        origin.alias("NOTE_PIVA_CFISC_FORECAST"),
        F.lit(None).cast("string").alias(KIND),
        F.lit(None).cast("bigint").alias("PROIEZIONE_RANK"),
        F.lit(None).cast("string").alias("PROIEZIONE_NOTE"),
        F.lit(None).cast("timestamp_ntz").alias("PROIEZIONE_DATA_DELIVERY"),
        F.lit(None).cast("timestamp_ntz").alias("CODE_MIN_DATA_DELIVERY"),
        F.lit(None).cast("string").alias(KEY),
        F.lit(P.NOTE_BOOKED).alias(NOTE),
    )


def with_regular(df: DataFrame) -> DataFrame:
    return df.withColumn("REGOLARE", F.coalesce(is_regular_offer(), F.lit(False)))


def _total_margin() -> Column:
    total = sum((F.coalesce(c, F.lit(0.0)) for c in map(F.col, MARGIN_PARTS)), F.lit(0.0))
    return total - F.coalesce(F.col(BONUS), F.lit(0.0))


def month_cells(
    base: DataFrame,
    params: ForecastParams,
    measures: Sequence[str] = MEASURES,
    texts: Sequence[str] = (*IDENTITY, "NOTE_PIVA_CFISC_FORECAST"),
) -> DataFrame:
    """Counts, sums and identity values per cell.

    Projections drop rows that are copies of each other, so cells also carry the
    volume of distinct rows. Without a declared row key, rows are told apart by two
    hashes of all their columns, and ``_copies`` tells the cells that hold copies;
    with one, no row has a copy. A caller that reads few ``measures`` (the
    volume among them) or ``texts`` names them, since cells may be nearly as many as rows.
    """
    rows = with_regular(base).withColumn("MARGINE_TOTALE_EUR", _total_margin())
    values = [*measures, *texts, "ID_OFFERTA"]
    if params.row_key is None:
        rows = rows.withColumns(dict(zip(("_row", "_row2"), row_digests(base.columns))))
        # The values follow from the digests; as grouping columns they keep this a hash aggregate.
        rows = rows.groupBy(*CELL, "_row", "_row2", *values).agg(F.count(F.lit(1)).alias("_m"))
    else:
        rows = rows.select(*CELL, F.lit(1).cast("bigint").alias("_m"), *values)
    copies = [] if params.row_key is not None else [(F.sum("_m") > F.count(F.lit(1))).alias("_copies")]
    # One aggregate, so that rows are shuffled once; maxima of texts make it sort within tasks.
    return rows.groupBy(*CELL).agg(
        F.sum("_m").alias("_n"),
        *copies,
        F.sum(VOLUME).alias("VOLUME_DISTINTO"),
        *[F.sum(F.col(m) * F.col("_m")).alias(m) for m in measures],
        F.bool_and(F.col("ID_OFFERTA").isNotNull()).alias("TUTTI_ID"),
        *[F.max(c).alias(c) for c in texts],
    )


def point_months(rows: DataFrame) -> DataFrame:
    """Bit maps of the booked months of every point of a party: all rows, and regular ones.

    One pass over rows (or cells) leaves a row per point and five years; kinds, keys, first
    and last months, lapses and gaps all follow from these few rows.
    """
    known = rows.where(F.col(G).isNotNull() & F.col(PARTY).isNotNull())
    return month_maps(known, [G, PARTY, "PDP"], DATE, {"MESI": F.lit(True), "MESI_REGOLARI": F.col("REGOLARE")})


def customers(points: DataFrame, params: ForecastParams, work: Workspace) -> DataFrame:
    """The points' maps with kind of customer, customer key, its first and last booked month, and lapse.

    The last month is that of the customers of the key that haven't lapsed.
    """
    regular = "FILTER (WHERE MESI_REGOLARI <> 0)"
    points = work.stage(points, "point_months")
    parties = (
        points.withColumn("_point", F.coalesce(has_point(), F.lit(False)))
        .groupBy(G, PARTY)
        .agg(
            F.expr(f"bool_and(_point) {regular}").alias("_all"),
            F.expr(f"bool_or(_point) {regular}").alias("_any"),
            (month_date(F.max(last_month("MESI"))) <= F.lit(params.lapse_cutoff)).alias("CESSATO"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .withColumn(
            KIND,
            F.when(F.col("_all"), P.ALWAYS_POINT)
            .when(~F.col("_any"), P.NEVER_POINT)
            .when(F.col("_any"), P.SOMETIMES_POINT),
        )
        .drop("_all", "_any")
    )
    out = spread_join(points, parties, [G, PARTY], "_rows", spread_by=["PDP", "_years"])
    out = out.withColumns(
        {
            "SEMPRE": F.coalesce(F.col(KIND) == P.ALWAYS_POINT, F.lit(False)),
            KEY: F.when(F.col(KIND) == P.ALWAYS_POINT, F.col("PDP")).when(F.col(KIND).isNotNull(), F.col(PARTY)),
        }
    )
    out = work.stage(out, "keyed_months")
    work.release("point_months")
    live = F.coalesce(~F.col("CESSATO"), F.lit(True))
    ends = (
        out.where(F.col(KEY).isNotNull())
        .groupBy(G, KEY)
        .agg(
            month_date(F.min(first_month("MESI"))).alias("PRIMA_DATA"),
            month_date(F.max(F.when(live, last_month("MESI")))).alias("ULTIMA_DATA"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    return spread_join(out, ends, [G, KEY], "_rows", spread_by=[PARTY, "PDP", "_years"])


def classify(cells: DataFrame, points: DataFrame) -> DataFrame:
    """Cells with what is known of their point; a row of ``points`` meets at most two cells a month."""
    part = F.floor(month_number(DATE) / MAP_MONTHS).cast("int")
    facts = ["CESSATO", KIND, "SEMPRE", KEY, "PRIMA_DATA", "ULTIMA_DATA"]
    side = points.select(*[F.col(c).alias(f"_{c}") for c in (G, PARTY, "PDP")], F.col("_years").alias("_span"), *facts)
    same = (F.col(G) == F.col(f"_{G}")) & (F.col(PARTY) == F.col(f"_{PARTY}"))
    same = same & F.col("PDP").eqNullSafe(F.col("_PDP")) & (part == F.col("_span"))
    out = cells.join(side, same, "left").drop(*[f"_{c}" for c in (G, PARTY, "PDP")], "_span")
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("CESSATO", "SEMPRE")})


def key_gaps(points: DataFrame, params: ForecastParams) -> DataFrame:
    """Months missing inside the history of each customer key."""
    keyed = points.where(F.col(KEY).isNotNull())
    return map_gaps(keyed, [G, KEY], "MESI", params.lapse_months + 1, params.calendar)


def seen_months(points: DataFrame) -> DataFrame:
    """Twelve bits per projectable key: the months of the year its regular rows were booked in."""
    live = points.where(~F.col("CESSATO") & F.col(KEY).isNotNull() & (F.col("MESI_REGOLARI") != 0))
    return live.groupBy(G, KEY).agg(F.bit_or(months_of_year("MESI_REGOLARI")).alias("_seen"))


def _carried(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of ``names`` that the caller's cells carry."""
    return [n for n in names if n in df.columns]


def key_months(cells: DataFrame) -> DataFrame:
    """Projectable history: regular rows of live customers, one row per key and date.

    Measures and texts are those the cells have.
    """
    live = cells.where(F.col("REGOLARE") & ~F.col("CESSATO") & F.col(KEY).isNotNull())
    return live.groupBy(G, KEY, "SEMPRE", DATE).agg(
        F.min("PRIMA_DATA").alias("PRIMA_DATA"),
        F.sum("VOLUME_DISTINTO").alias("VOLUME_DISTINTO"),
        *[F.sum(m).alias(m) for m in _carried(cells, MEASURES)],
        F.bool_and("TUTTI_ID").alias("TUTTI_ID"),
        *[F.max(c).alias(c) for c in _carried(cells, (*IDENTITY, *ORIGIN))],
    )


def choose_sources(months: DataFrame, params: ForecastParams) -> DataFrame:
    """For each key and month of the year, the date whose rows are projected.

    Point customers repeat their latest date. The others rank years: with a future
    latest date, the best rank whose volume is not too far below the next older
    year's; otherwise the latest year. The years of a key and month are one short array,
    oldest first, since dates are first days of months; the choice is an element of it.
    """
    keys = [G, KEY, "SEMPRE"]
    row = F.struct(DATE, *[c for c in months.columns if c not in (*keys, DATE)])
    years = F.sort_array(F.collect_list(row)).alias("_years")
    out = months.groupBy(*keys, F.month(DATE).alias("_month")).agg(years).withColumn("_n", F.size("_years"))
    today = F.lit(params.as_of)

    def passing(year: Column, at: Column) -> Column:
        volume, older = year[VOLUME], F.get("_years", at - 1)[VOLUME]
        change = F.when(older == 0, F.lit(0.0)).otherwise((volume - older) / F.nullif(older, F.lit(0.0)))
        change = F.round(change, 2)
        return F.when((change >= -params.tolerance_pct / 100) | change.isNull() | (year[DATE] <= today), at)

    future = F.get("_years", F.col("_n") - 1)[DATE] > today
    by_volume = ~F.col("SEMPRE") & (F.col("_n") > 1) & future
    latest = F.col("_n") - 1
    out = out.withColumn("_at", F.when(by_volume, F.array_max(F.transform("_years", passing))).otherwise(latest))
    why = (
        F.when(F.col("SEMPRE"), P.WHY_LATEST_POINT)
        .when(F.col("_n") == 1, P.WHY_SINGLE)
        .when(future, P.WHY_FUTURE)
        .otherwise(P.WHY_PAST)
    )
    rank = F.when(F.col("SEMPRE"), F.lit(1)).otherwise(F.col("_n") - F.col("_at")).cast("bigint")
    out = out.withColumn("_one", F.get("_years", F.col("_at")))
    return out.select(*keys, "_one.*", rank.alias("PROIEZIONE_RANK"), why.alias("PROIEZIONE_NOTE"))


def project_sources(chosen: DataFrame, cells: DataFrame, params: ForecastParams) -> DataFrame:
    """Chosen dates on the calendar, column ``MESE_PROIETTATO``.

    A point is not projected to a month in which it is booked under any commodity.
    Party customers may renew in part, so only their own source month is skipped.
    """
    out = project_on_calendar(chosen, DATE, params.calendar, "MESE_PROIETTATO", not_before="PRIMA_DATA")
    party = out.where(~F.col("SEMPRE") & (F.col("MESE_PROIETTATO") != F.col(DATE)))
    booked = _blocked(cells.where(F.col(DATE).isin(params.calendar)), "PDP", DATE)
    point = anti_join(out.where("SEMPRE"), booked, {"PDP": KEY, DATE: "MESE_PROIETTATO"})
    return point.unionByName(party)


def _blocked(rows: DataFrame, key: str, date: str) -> DataFrame:
    """Key and month pairs whose rows all carry an offer id; a missing id does not block."""
    return rows.where(F.col(key).isNotNull()).groupBy(key, date).agg(
        F.bool_and("TUTTI_ID").alias("_all")
    ).where("_all").drop("_all")


def mean_rows(months: DataFrame, targets: DataFrame, cells: DataFrame, params: ForecastParams) -> DataFrame:
    """Rows for months of the year a projected key was never booked in.

    Every measure is the mean, over months of the year, of the mean per date. A key has at
    most two rows a month, so its rows meet in one task and all three aggregates follow there.
    """
    measures = _carried(months, MEASURES)
    own = months.select(G, KEY, DATE, "PRIMA_DATA", *measures).repartition(G, KEY)
    by_date = own.groupBy(G, KEY, DATE).agg(
        F.min("PRIMA_DATA").alias("PRIMA_DATA"), *[F.sum(m).alias(m) for m in measures]
    )
    by_month = by_date.groupBy(G, KEY, F.month(DATE).alias("MESE")).agg(
        F.min("PRIMA_DATA").alias("PRIMA_DATA"), *[(F.sum(m) / F.count(F.lit(1))).alias(m) for m in measures]
    )
    profile = by_month.groupBy(G, KEY).agg(
        F.min("PRIMA_DATA").alias("PRIMA_DATA"),
        F.bit_or(F.expr("shiftleft(1L, MESE - 1)")).alias("_seen"),
        *[F.avg(m).alias(m) for m in measures],
    )
    profile = keep_matching(profile, targets, [G, KEY])
    out = profile.withColumn(DATE, F.explode(month_array(params.calendar)))
    open_month = (F.getbit("_seen", F.month(DATE) - 1) == 0) & (F.col(DATE) >= F.col("PRIMA_DATA"))
    out = out.where(open_month).drop("_seen")
    taken = (
        cells.where(F.col(DATE).isin(params.calendar))
        .select(KEY, DATE, "TUTTI_ID")
        .unionByName(targets.select(KEY, F.col("MESE_PROIETTATO").alias(DATE), "TUTTI_ID"))
    )
    out = anti_join(out, _blocked(taken, KEY, DATE), {KEY: KEY, DATE: DATE})
    return out.withColumn("PROIEZIONE_NOTE", F.lit(P.WHY_MEAN))


def enrich_means(means: DataFrame, targets: DataFrame, cells: DataFrame) -> DataFrame:
    """Identity of mean rows from the nearest later month, party from the nearest earlier.

    Point and holder fields become ND, also for point customers: a mean row has no
    kind of customer when they are filled.
    """
    identity, origin = _carried(cells, IDENTITY), _carried(cells, ORIGIN)
    fields = (*identity, *origin)
    no, yes = F.lit(False).alias("_own"), F.lit(True).alias("_own")
    history = cells.where(F.col(KEY).isNotNull()).select(G, KEY, DATE, *fields, no)
    projected = targets.select(G, KEY, F.col("MESE_PROIETTATO").alias(DATE), *fields, no)
    own = means.select(G, KEY, DATE, *[F.lit(None).cast("string").alias(c) for c in fields], yes)
    known = keep_matching(history.unionByName(projected).unionByName(own), means, [G, KEY])
    per_month = known.groupBy(G, KEY, DATE).agg(*[F.max(c).alias(c) for c in fields], F.max("_own").alias("_own"))
    by_key = Window.partitionBy(G, KEY)
    filled = fill_last(per_month, identity, by_key.orderBy(F.col(DATE).desc())) if identity else per_month
    # Other months only lend their values; they needn't move to the mean rows.
    filled = fill_last(filled, origin, by_key.orderBy(DATE)).where("_own").drop("_own")
    nd = F.lit("ND")
    return means.join(filled, [G, KEY, DATE], "inner").withColumns(
        {
            "FLG_PUBBLICATO_S_N": F.lit("S"),
            "PDP": nd,
            "RAG_SOC_TITOLARE": nd,
            "P_IVA_TITOLARE": nd,
            "COD_FISC_TITOLARE": nd,
        }
    )


def prevailing(rows: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Attributes with the largest volume in the last booked month of each key.

    Ties go to the greatest attributes, compared in the given order.
    """
    volumes = rows.groupBy(G, KEY, *attributes).agg(F.sum(VOLUME).alias("_volume"))
    return top1(volumes, [G, KEY], ["_volume", *attributes], attributes)


def last_booked_rows(base: DataFrame, cells: DataFrame) -> DataFrame:
    """Volume per seller and offer code in the last booked month of each live key."""
    live = cells.where(F.col(KEY).isNotNull() & ~F.col("CESSATO"))
    at_last = live.where(F.col(DATE) == F.col("ULTIMA_DATA")).select(*CELL, KEY, "_n")
    narrow = with_regular(base).select(*CELL, *SELLER_COLUMNS, "COD_OFFERTA", VOLUME)
    booked = spread_join(narrow, at_last, list(CELL), "_n", "inner")
    return booked.groupBy(G, KEY, *SELLER_COLUMNS, "COD_OFFERTA").agg(F.sum(VOLUME).alias(VOLUME))


def reconcile(cells: DataFrame, targets: DataFrame, means: DataFrame) -> DataFrame:
    """Per key and month with booked and projected rows, the note of the smaller side.

    Only customers without a fixed point are compared.
    """
    zero = F.lit(0.0)
    booked = cells.where(F.col(KEY).isNotNull() & ~F.col("SEMPRE") & ~F.col("CESSATO")).select(
        G, KEY, DATE, F.col(VOLUME).alias("_booked"), zero.alias("_projected"), F.lit(1).alias("_side")
    )
    projected = targets.where(~F.col("SEMPRE")).select(
        G, KEY, F.col("MESE_PROIETTATO").alias(DATE), zero.alias("_booked"),
        F.col("VOLUME_DISTINTO").alias("_projected"), F.lit(2).alias("_side"),
    )
    mean = means.where(F.col(KIND) != P.ALWAYS_POINT).select(
        G, KEY, DATE, zero.alias("_booked"), F.col(VOLUME).alias("_projected"), F.lit(2).alias("_side")
    )
    sums = booked.unionByName(projected).unionByName(mean).groupBy(G, KEY, DATE).agg(
        F.min("_side").alias("_lo"), F.max("_side").alias("_hi"),
        F.coalesce(F.sum("_booked"), zero).alias("_booked"),
        F.coalesce(F.sum("_projected"), zero).alias("_projected"),
    )
    loser = F.when(F.col("_booked") < F.col("_projected"), P.NOTE_BOOKED).otherwise(P.NOTE_PROJECTED)
    return sums.where(F.col("_lo") != F.col("_hi")).select(G, KEY, DATE, loser.alias("PERDENTE"))


def _final_note(targets: DataFrame, month: str, losers: DataFrame, gaps: DataFrame) -> DataFrame:
    """Drop projections that lose, and name those that replace booked rows or fill gaps."""
    out = targets.join(losers.withColumnRenamed(DATE, month), [G, KEY, month], "left")
    out = out.where(F.coalesce(F.col("PERDENTE") != P.NOTE_PROJECTED, F.lit(True)))
    fill = gaps.where("RIEMPIBILE").select(G, KEY, F.col("MESE_BUCO").alias(month), F.lit(True).alias("_fill"))
    out = out.join(fill, [G, KEY, month], "left")
    note = (
        F.when(F.col("_fill"), P.NOTE_GAP)
        .when(F.col("PERDENTE") == P.NOTE_BOOKED, P.NOTE_REPLACING)
        .otherwise(P.NOTE_PROJECTED)
    )
    return out.withColumn(NOTE, note).drop("PERDENTE", "_fill")


def forecast(published: DataFrame, params: ForecastParams, workspace: Workspace | None = None) -> DataFrame:
    """Booked rows plus projections up to the scenario end, with their notes."""
    work = workspace or Workspace(published.sparkSession)
    base = base_rows(published, params)
    if params.row_key is not None:
        assert_unique(base, params.row_key).agg(F.sum("n")).collect()
    cells = work.stage(month_cells(base, params), "month_cells")
    points = work.stage(customers(point_months(cells), params, work), "points")
    work.release("keyed_months")
    cells = work.stage(classify(cells, points), "cells")
    work.release("month_cells")
    months = work.stage(key_months(cells), "months")
    gaps = work.stage(key_gaps(points, params), "gaps")
    work.release("points")
    never = gaps.where(~F.col("RIEMPIBILE")).withColumnRenamed("MESE_BUCO", "MESE_PROIETTATO")
    chosen = choose_sources(months, params)
    targets = work.stage(project_sources(chosen, cells, params), "targets")
    means = work.stage(mean_rows(months, targets, cells, params), "mean_rows")
    work.release("months")
    means = enrich_means(means, targets, cells)

    # Projections into gaps that stay open go first, then booked and projected volumes meet.
    targets = delete_matching(targets, never, [G, KEY, "MESE_PROIETTATO"])
    means = work.stage(
        delete_matching(means, never.withColumnRenamed("MESE_PROIETTATO", DATE), [G, KEY, DATE]), "means"
    )
    work.release("mean_rows")
    losers = reconcile(cells, targets, means)
    targets = _final_note(targets, "MESE_PROIETTATO", losers, gaps)
    means = _final_note(means, DATE, losers, gaps)

    last = work.stage(last_booked_rows(base, cells), "last_booked")
    sellers = prevailing(last, SELLER_COLUMNS)
    offers = prevailing(last, ["COD_OFFERTA"])

    plans = work.stage(_cell_plans(cells, targets, losers, sellers), "plans")
    rows = _assemble(base, plans, params, work)
    mean_out = (
        means.join(offers, [G, KEY], "left")
        .join(sellers, [G, KEY], "left")
        .withColumn("CODE_MIN_DATA_DELIVERY", F.col("PRIMA_DATA").cast("timestamp_ntz"))
    )
    return append_common(rows, mean_out)


def _cell_plans(cells: DataFrame, targets: DataFrame, losers: DataFrame, sellers: DataFrame) -> DataFrame:
    """What the wide rows of a cell need: booked note, projection months and notes, seller.

    All of it depends on the key and the date, so it is put together on one row per
    key and date; the cells of a large key then fetch it with a split join.
    """
    on_date = [G, KEY, "SEMPRE", DATE, "REGOLARE", "CESSATO"]
    month = F.struct(F.col("MESE_PROIETTATO").alias("mese"), F.col(NOTE).alias("nota"))
    per_source = targets.groupBy(G, KEY, "SEMPRE", DATE).agg(
        F.collect_list(month).alias("_months"),  # at most one entry per calendar month
        F.max("PROIEZIONE_RANK").alias("_rank"),
        F.max("PROIEZIONE_NOTE").alias("_why"),
        F.lit(True).alias("REGOLARE"),
        F.lit(False).alias("CESSATO"),
    )
    dates = cells.groupBy(*on_date).agg(F.count(F.lit(1)).alias("_cells"))
    dates = dates.join(per_source, on_date, "left").join(losers, [G, KEY, DATE], "left")
    dates = dates.join(sellers.select(G, KEY, F.struct(*SELLER_COLUMNS).alias("_seller")), [G, KEY], "left")
    note = (
        F.when(F.col("CESSATO"), P.NOTE_LAPSED)
        .when(F.col("PERDENTE") == P.NOTE_BOOKED, P.NOTE_REPLACED)
        .otherwise(P.NOTE_BOOKED)
    )
    dates = dates.withColumn("_note", note).drop("PERDENTE")
    copies = _carried(cells, ["_copies"])
    out = cells.select(*CELL, "_n", *copies, KIND, KEY, "PRIMA_DATA", "CESSATO", "SEMPRE")
    out = spread_join(out, dates, on_date, "_cells", "inner", spread_by=[PARTY, "PDP"])
    return out.select(
        *CELL, "_n", *copies, F.col(KIND).alias("_kind"), F.col(KEY).alias("_key"),
        F.col("PRIMA_DATA").cast("timestamp_ntz").alias("_first"),
        "_note", "_months", "_rank", "_why", "_seller",
    )


def _assemble(base: DataFrame, plans: DataFrame, params: ForecastParams, work: Workspace) -> DataFrame:
    """Join the wide rows to their cell and unfold booked rows and projections.

    The wide rows are joined once. Without a row key the joined rows are written, since
    those of cells with copies are read again for the distinct rows to project.
    """
    rows = spread_join(with_regular(base), plans, list(CELL), "_n", "inner")
    rows = rows.withColumns({KIND: F.col("_kind"), KEY: F.col("_key"), "CODE_MIN_DATA_DELIVERY": F.col("_first")})
    entries = "array<struct<mese:date,nota:string,proiettata:boolean>>"
    booked = F.array(F.struct(F.col(DATE).alias("mese"), F.col("_note").alias("nota"), F.lit(False).alias("proiettata")))
    months = F.transform("_months", lambda m: F.struct(m.mese, m.nota, F.lit(True).alias("proiettata"))).cast(entries)
    none = F.array().cast(entries)
    both = F.concat(booked, F.coalesce(months, none))
    if params.row_key is None:
        # Copies of a row stay among the booked rows and go from the projections.
        rows = work.stage(rows, "planned")
        sources = rows.where(F.col("_copies") & F.col("_months").isNotNull()).distinct()
        rows = rows.withColumn("_entries", F.when(F.col("_copies"), booked.cast(entries)).otherwise(both)).unionByName(
            sources.withColumn("_entries", months)
        )
    else:
        rows = rows.withColumn("_entries", both)
    rows = rows.withColumn("_e", F.explode("_entries"))
    projected = F.col("_e.proiettata")

    def if_projected(new: Column, old: str) -> Column:
        return F.when(projected, new).otherwise(F.col(old))

    rows = rows.withColumns(
        {
            "PROIEZIONE_DATA_DELIVERY": if_projected(F.col(DATE).cast("timestamp_ntz"), "PROIEZIONE_DATA_DELIVERY"),
            DATE: F.col("_e.mese"),
            NOTE: F.col("_e.nota"),
            "PROIEZIONE_RANK": if_projected(F.col("_rank"), "PROIEZIONE_RANK"),
            "PROIEZIONE_NOTE": if_projected(F.col("_why"), "PROIEZIONE_NOTE"),
            **{c: if_projected(F.col(f"_seller.{c}"), c) for c in SELLER_COLUMNS},
        }
    )
    return rows.select(*base.columns)
