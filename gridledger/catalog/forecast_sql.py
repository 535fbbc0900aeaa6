"""The forecast stated in SQL over single rows, as a chain of named steps.

It shares nothing with the Spark plan, which decides on cells: here every step
keeps all rows, so agreement of the two is a check of the cell plan.
"""

from gridledger import params as P
from gridledger.catalog import views  # noqa: F401
from gridledger.catalog.registry import AS_OF, VIEWS, milli_sql, view
from gridledger.params import ForecastParams
from gridledger.tables import BONUS, MARGIN_PARTS, PROFILE_MEASURES, SELLER_COLUMNS

RUN = ForecastParams(as_of=AS_OF, row_key=("ID_DETTAGLIO",))
REGULAR = "COD_OFFERTA NOT LIKE '%F%' AND COD_OFFERTA NOT LIKE 'S-%'"
SELLERS = ", ".join(SELLER_COLUMNS)
PARTY_NONE = "('ND', '00000000000', '***')"
MEASURES = (*PROFILE_MEASURES, "MARGINE_TOTALE_EUR")

view(
    "f_base",
    f"""
SELECT *, CASE WHEN offer_key IS NOT NULL AND offer_key NOT IN {PARTY_NONE} THEN offer_key
               WHEN holder_key IS NOT NULL AND holder_key NOT IN {PARTY_NONE} THEN holder_key
               ELSE coalesce(RAG_SOC_OFFERTABILE, CLIENTE) END AS party,
       CASE WHEN offer_key IS NOT NULL AND offer_key NOT IN {PARTY_NONE} THEN '{P.ORIGIN_OFFER}'
            WHEN holder_key IS NOT NULL AND holder_key NOT IN {PARTY_NONE} THEN '{P.ORIGIN_HOLDER}'
            ELSE '{P.ORIGIN_NAME}' END AS origin
FROM (SELECT *, coalesce(P_IVA_OFFERTABILE, COD_FISC_OFFERTABILE) AS offer_key,
             coalesce(P_IVA_TITOLARE, COD_FISC_TITOLARE) AS holder_key
      FROM {{published}}
      WHERE DATA_DELIVERY < DATE '{RUN.scenario_end}' AND FLG_PUBBLICATO_S_N = 'S')
""",
)
view(
    "f_kind",
    f"""
SELECT COMMODITY_G_E, party,
       CASE WHEN min(pt) = 1 THEN '{P.ALWAYS_POINT}' WHEN max(pt) = 0 THEN '{P.NEVER_POINT}'
            ELSE '{P.SOMETIMES_POINT}' END AS kind
FROM (SELECT COMMODITY_G_E, party,
             CASE WHEN PDP IS NOT NULL AND PDP NOT IN ('00000000000000', '***', 'ND')
                       AND PDP NOT LIKE 'DSB%' AND PDP NOT LIKE 'SA-%' THEN 1 ELSE 0 END AS pt
      FROM {{f_base}} WHERE {REGULAR})
GROUP BY 1, 2
""",
)
view(
    "f_keyed",
    f"""
SELECT b.*, k.kind, CASE WHEN k.kind = '{P.ALWAYS_POINT}' THEN b.PDP
                         WHEN k.kind IS NOT NULL THEN b.party END AS ckey
FROM {{f_base}} b LEFT JOIN {{f_kind}} k ON k.COMMODITY_G_E = b.COMMODITY_G_E AND k.party = b.party
""",
)
view(
    "f_booked",
    f"""
SELECT b.*, m.first_month, CAST(NULL AS DATE) AS source_month, CAST(NULL AS BIGINT) AS year_rank,
       CAST(NULL AS VARCHAR) AS why,
       CASE WHEN l.party IS NOT NULL THEN '{P.NOTE_LAPSED}' ELSE '{P.NOTE_BOOKED}' END AS note
FROM {{f_keyed}} b
LEFT JOIN (SELECT COMMODITY_G_E, ckey, min(DATA_DELIVERY) AS first_month FROM {{f_keyed}} GROUP BY 1, 2) m
       ON m.COMMODITY_G_E = b.COMMODITY_G_E AND m.ckey = b.ckey
LEFT JOIN (SELECT COMMODITY_G_E, party FROM {{f_base}} GROUP BY 1, 2
           HAVING max(DATA_DELIVERY) <= DATE '{RUN.lapse_cutoff}') l
       ON l.COMMODITY_G_E = b.COMMODITY_G_E AND l.party = b.party
""",
)
view(
    "f_calendar",
    f"""
SELECT CAST(m AS DATE) AS month
FROM generate_series(DATE '{RUN.calendar[0]}', DATE '{RUN.calendar[-1]}', INTERVAL 1 MONTH) AS t(m)
""",
)
view(
    "f_gaps",
    f"""
SELECT COMMODITY_G_E, ckey, month,
       datediff('month', prev, DATA_DELIVERY) BETWEEN 2 AND {RUN.lapse_months + 1} AS fill, prev
FROM (SELECT COMMODITY_G_E, ckey, DATA_DELIVERY,
             lag(DATA_DELIVERY) OVER (PARTITION BY COMMODITY_G_E, ckey ORDER BY DATA_DELIVERY) AS prev
      FROM (SELECT DISTINCT COMMODITY_G_E, ckey, DATA_DELIVERY FROM {{f_booked}} WHERE ckey IS NOT NULL))
JOIN {{f_calendar}} ON month > prev AND month < DATA_DELIVERY
""",
)
PROJECTED = """b.* EXCLUDE (DATA_DELIVERY, source_month, year_rank, why, note), c.month AS DATA_DELIVERY,
       b.DATA_DELIVERY AS source_month"""
view(
    "f_point",
    f"""
SELECT DISTINCT {PROJECTED}, CAST(1 AS BIGINT) AS year_rank, '{P.WHY_LATEST_POINT}' AS why, '{P.NOTE_PROJECTED}' AS note
FROM (SELECT * FROM {{f_booked}}
      WHERE kind = '{P.ALWAYS_POINT}' AND note = '{P.NOTE_BOOKED}' AND {REGULAR}
      QUALIFY dense_rank() OVER (PARTITION BY PDP, month(DATA_DELIVERY), COMMODITY_G_E
                                 ORDER BY DATA_DELIVERY DESC) = 1) b
JOIN {{f_calendar}} c ON month(c.month) = month(b.DATA_DELIVERY) AND c.month >= b.first_month
LEFT JOIN {{f_booked}} f ON f.DATA_DELIVERY = c.month AND f.PDP = b.PDP
WHERE f.ID_OFFERTA IS NULL
""",
)
view(
    "f_years",
    f"""
SELECT COMMODITY_G_E, party, month(DATA_DELIVERY) AS moy, DATA_DELIVERY, rk, sum(VOLUME_COPERTO_MC_MWH) AS volume
FROM (SELECT *, dense_rank() OVER (PARTITION BY COMMODITY_G_E, party, month(DATA_DELIVERY)
                                   ORDER BY year(DATA_DELIVERY) DESC) AS rk
      FROM {{f_booked}}
      WHERE kind <> '{P.ALWAYS_POINT}' AND note = '{P.NOTE_BOOKED}' AND {REGULAR})
GROUP BY ALL
""",
)
view(
    "f_checked",
    f"""
SELECT *, round(CASE WHEN older = 0 THEN 0 ELSE (volume - older) / older END, 2) AS change
FROM (SELECT *, count(DISTINCT rk) OVER (PARTITION BY COMMODITY_G_E, party, moy) AS ranks,
             max(DATA_DELIVERY) OVER (PARTITION BY COMMODITY_G_E, party, moy) AS latest,
             lag(volume) OVER (PARTITION BY COMMODITY_G_E, party, moy ORDER BY rk DESC, DATA_DELIVERY) AS older
      FROM {{f_years}})
""",
)
PASSES = f"(change >= {-RUN.tolerance_pct / 100} OR change IS NULL OR DATA_DELIVERY <= DATE '{AS_OF}')"
view(
    "f_chosen",
    f"""
SELECT COMMODITY_G_E, party, moy, DATA_DELIVERY, rk, '{P.WHY_FUTURE}' AS why FROM {{f_checked}}
WHERE ranks > 1 AND latest > DATE '{AS_OF}' AND {PASSES}
QUALIFY rk = min(rk) OVER (PARTITION BY COMMODITY_G_E, party, moy)
UNION ALL
SELECT COMMODITY_G_E, party, moy, DATA_DELIVERY, rk, '{P.WHY_SINGLE}' FROM {{f_checked}} WHERE ranks = 1
UNION ALL
SELECT COMMODITY_G_E, party, moy, DATA_DELIVERY, rk, '{P.WHY_PAST}' FROM {{f_checked}}
WHERE ranks > 1 AND rk = 1 AND latest <= DATE '{AS_OF}'
""",
)
view(
    "f_party",
    f"""
SELECT DISTINCT {PROJECTED}, u.rk AS year_rank, u.why, '{P.NOTE_PROJECTED}' AS note
FROM {{f_booked}} b
JOIN {{f_chosen}} u ON u.COMMODITY_G_E = b.COMMODITY_G_E AND u.party = b.party AND u.DATA_DELIVERY = b.DATA_DELIVERY
JOIN {{f_calendar}} c ON month(c.month) = u.moy AND c.month <> b.DATA_DELIVERY AND c.month >= b.first_month
WHERE b.kind <> '{P.ALWAYS_POINT}' AND b.note = '{P.NOTE_BOOKED}' AND {REGULAR.replace("COD_", "b.COD_")}
""",
)
view(
    "f_known",
    """
SELECT * FROM {f_booked} UNION ALL BY NAME SELECT * FROM {f_point} UNION ALL BY NAME SELECT * FROM {f_party}
""",
)
_TOTAL = " + ".join(f"coalesce({c}, 0)" for c in MARGIN_PARTS) + f" - coalesce({BONUS}, 0)"
view(
    "f_profile_month",
    f"""
SELECT COMMODITY_G_E, ckey, first_month, month(DATA_DELIVERY) AS moy,
       {", ".join(f"sum({m}) / count(DISTINCT DATA_DELIVERY) AS {m}" for m in PROFILE_MEASURES)},
       sum({_TOTAL}) / count(DISTINCT DATA_DELIVERY) AS MARGINE_TOTALE_EUR
FROM {{f_booked}} WHERE note = '{P.NOTE_BOOKED}' AND {REGULAR} AND ckey IS NOT NULL
GROUP BY 1, 2, 3, 4
""",
)
view(
    "f_profile",
    f"""
SELECT COMMODITY_G_E, ckey, first_month, {", ".join(f"avg({m}) AS {m}" for m in MEASURES)}
FROM {{f_profile_month}} GROUP BY 1, 2, 3
""",
)
view(
    "f_missing",
    """
SELECT DISTINCT k.COMMODITY_G_E, k.ckey, n AS moy
FROM (SELECT DISTINCT COMMODITY_G_E, ckey FROM {f_known} WHERE source_month IS NOT NULL) k
CROSS JOIN generate_series(1, 12) AS t(n)
LEFT JOIN {f_profile_month} m ON m.COMMODITY_G_E = k.COMMODITY_G_E AND m.ckey = k.ckey AND m.moy = n
WHERE m.moy IS NULL
""",
)
view(
    "f_mean",
    f"""
SELECT DISTINCT p.*, c.month AS DATA_DELIVERY, '{P.WHY_MEAN}' AS why, '{P.NOTE_PROJECTED}' AS note
FROM {{f_missing}} t
JOIN {{f_profile}} p ON p.COMMODITY_G_E = t.COMMODITY_G_E AND p.ckey = t.ckey
JOIN {{f_calendar}} c ON month(c.month) = t.moy AND c.month >= p.first_month
LEFT JOIN {{f_known}} f ON f.DATA_DELIVERY = c.month AND f.ckey = t.ckey
WHERE f.ID_OFFERTA IS NULL
""",
)
_LAST = f"""SELECT * FROM {{f_booked}} WHERE note = '{P.NOTE_BOOKED}'
      QUALIFY DATA_DELIVERY = max(DATA_DELIVERY) OVER (PARTITION BY COMMODITY_G_E, ckey)"""
view(
    "f_seller",
    f"""
SELECT COMMODITY_G_E, ckey, {SELLERS}
FROM (SELECT COMMODITY_G_E, ckey, {SELLERS}, sum(VOLUME_COPERTO_MC_MWH) AS v FROM ({_LAST}) GROUP BY ALL)
WHERE ckey IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY COMMODITY_G_E, ckey
    ORDER BY v DESC NULLS LAST, {", ".join(f"{c} DESC NULLS LAST" for c in SELLER_COLUMNS)}) = 1
""",
)
view(
    "f_offer",
    f"""
SELECT COMMODITY_G_E, ckey, COD_OFFERTA
FROM (SELECT COMMODITY_G_E, ckey, COD_OFFERTA, sum(VOLUME_COPERTO_MC_MWH) AS v FROM ({_LAST}) GROUP BY ALL)
WHERE ckey IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY COMMODITY_G_E, ckey ORDER BY v DESC NULLS LAST, COD_OFFERTA DESC NULLS LAST) = 1
""",
)
_DESC = "(PARTITION BY COMMODITY_G_E, ckey ORDER BY DATA_DELIVERY DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_ASC = _DESC.replace(" DESC", "")
view(
    "f_identity",
    f"""
SELECT COMMODITY_G_E, ckey, DATA_DELIVERY,
       {", ".join(f"last_value({c} IGNORE NULLS) OVER {_DESC} AS {c}" for c in ("RAG_SOC_OFFERTABILE", "COD_FISC_OFFERTABILE", "P_IVA_OFFERTABILE"))},
       {", ".join(f"last_value({c} IGNORE NULLS) OVER {_ASC} AS {c}" for c in ("party", "origin", "kind"))}
FROM (SELECT COMMODITY_G_E, ckey, DATA_DELIVERY, max(RAG_SOC_OFFERTABILE) AS RAG_SOC_OFFERTABILE,
             max(COD_FISC_OFFERTABILE) AS COD_FISC_OFFERTABILE, max(P_IVA_OFFERTABILE) AS P_IVA_OFFERTABILE,
             max(party) AS party, max(origin) AS origin, max(kind) AS kind
      FROM (SELECT * FROM {{f_known}} UNION ALL BY NAME SELECT * FROM {{f_mean}})
      WHERE ckey IS NOT NULL GROUP BY 1, 2, 3)
""",
)
view(
    "f_all",
    f"""
SELECT k.* EXCLUDE ({SELLERS}, offer_key, holder_key),
       {", ".join(f"CASE WHEN k.source_month IS NULL THEN k.{c} ELSE s.{c} END AS {c}" for c in SELLER_COLUMNS)}
FROM {{f_known}} k LEFT JOIN {{f_seller}} s ON s.COMMODITY_G_E = k.COMMODITY_G_E AND s.ckey = k.ckey
UNION ALL BY NAME
SELECT m.*, 'S' AS FLG_PUBBLICATO_S_N, 'ND' AS PDP, 'ND' AS P_IVA_TITOLARE, 'ND' AS COD_FISC_TITOLARE,
       'ND' AS RAG_SOC_TITOLARE, i.* EXCLUDE (COMMODITY_G_E, ckey, DATA_DELIVERY), o.COD_OFFERTA,
       {", ".join(f"s.{c}" for c in SELLER_COLUMNS)}
FROM {{f_mean}} m
JOIN {{f_identity}} i ON i.COMMODITY_G_E = m.COMMODITY_G_E AND i.ckey = m.ckey AND i.DATA_DELIVERY = m.DATA_DELIVERY
LEFT JOIN {{f_seller}} s ON s.COMMODITY_G_E = m.COMMODITY_G_E AND s.ckey = m.ckey
LEFT JOIN {{f_offer}} o ON o.COMMODITY_G_E = m.COMMODITY_G_E AND o.ckey = m.ckey
""",
)
view(
    "f_pruned",
    f"""
SELECT a.* FROM {{f_all}} a
WHERE NOT (a.note = '{P.NOTE_PROJECTED}' AND EXISTS (
    SELECT 1 FROM {{f_gaps}} g WHERE NOT g.fill AND g.COMMODITY_G_E = a.COMMODITY_G_E
       AND g.ckey = a.ckey AND g.month = a.DATA_DELIVERY))
""",
)
view(
    "f_losers",
    f"""
SELECT COMMODITY_G_E, ckey, DATA_DELIVERY,
       CASE WHEN sum(CASE WHEN note = '{P.NOTE_BOOKED}' THEN VOLUME_COPERTO_MC_MWH ELSE 0 END)
               < sum(CASE WHEN note = '{P.NOTE_PROJECTED}' THEN VOLUME_COPERTO_MC_MWH ELSE 0 END)
            THEN '{P.NOTE_BOOKED}' ELSE '{P.NOTE_PROJECTED}' END AS loser
FROM {{f_pruned}} WHERE note <> '{P.NOTE_LAPSED}' AND kind <> '{P.ALWAYS_POINT}'
GROUP BY 1, 2, 3 HAVING count(DISTINCT note) = 2
""",
)
view(
    "f_result",
    f"""
SELECT a.* EXCLUDE (note),
       CASE WHEN g.month IS NOT NULL THEN '{P.NOTE_GAP}'
            WHEN l.loser = '{P.NOTE_BOOKED}' AND a.note = '{P.NOTE_PROJECTED}' THEN '{P.NOTE_REPLACING}'
            WHEN l.loser = '{P.NOTE_BOOKED}' AND a.note = '{P.NOTE_BOOKED}' THEN '{P.NOTE_REPLACED}'
            ELSE a.note END AS note
FROM {{f_pruned}} a
LEFT JOIN {{f_losers}} l ON l.COMMODITY_G_E = a.COMMODITY_G_E AND l.ckey = a.ckey AND l.DATA_DELIVERY = a.DATA_DELIVERY
LEFT JOIN {{f_gaps}} g ON g.fill AND g.COMMODITY_G_E = a.COMMODITY_G_E AND g.ckey = a.ckey AND g.month = a.DATA_DELIVERY
WHERE NOT (a.note = '{P.NOTE_PROJECTED}' AND l.loser IS NOT NULL AND l.loser = '{P.NOTE_PROJECTED}')
""",
)

PLAIN = (
    "COMMODITY_G_E", "ID_OFFERTA", "ID_DETTAGLIO", "COD_OFFERTA", "FLG_PUBBLICATO_S_N", "PDP",
    "P_IVA_OFFERTABILE", "COD_FISC_OFFERTABILE", "RAG_SOC_OFFERTABILE", "P_IVA_TITOLARE",
    "COD_FISC_TITOLARE", "RAG_SOC_TITOLARE", "CLIENTE", *SELLER_COLUMNS,
)
RESULT_SQL = f"""
SELECT {", ".join(PLAIN)}, {", ".join(f"{milli_sql(m)} AS {m}" for m in MEASURES)},
       CAST(DATA_DELIVERY AS VARCHAR) AS DATA_DELIVERY, party AS PIVA_CFISC_FORECAST,
       origin AS NOTE_PIVA_CFISC_FORECAST, kind AS TIPO_PIVA_CFISC_FORECAST, CAST(year_rank AS VARCHAR) AS PROIEZIONE_RANK,
       why AS PROIEZIONE_NOTE, CAST(source_month AS VARCHAR) AS PROIEZIONE_DATA_DELIVERY,
       CAST(first_month AS VARCHAR) AS CODE_MIN_DATA_DELIVERY, ckey AS CHIAVE_CLIENTE_FORECAST, note AS NOTE_FORECAST
FROM {{f_result}}
"""


# The same steps over rows without a key.
RUN_NO_KEY = ForecastParams(as_of=AS_OF)


def _renamed(sql: str) -> str:
    return sql.replace("{f_", "{g_").replace("{published}", "{published_twice}")


for _name in [n for n in VIEWS if n.startswith("f_")]:
    view(f"g{_name[1:]}", _renamed(VIEWS[_name]))
RESULT_NO_KEY_SQL = _renamed(RESULT_SQL)
