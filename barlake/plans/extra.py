"""Registered queries beyond the analytic set: calendar, symbols, quality, monitoring,
incremental refresh, upsert/time travel, layout and dimension joins."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions.symbols import normalize_interval
from ..operators import calendar_ops as CO
from ..operators import incremental as INC
from ..operators import ledger as LED
from ..operators import monitoring as MON
from ..operators import quality as DQ
from ..operators.clean import (BRONZE_DROP_EXPECTATIONS, DAILY_WARN_EXPECTATIONS,
                               SILVER_WARN_EXPECTATIONS, clean_bronze_to_silver, expect_or_drop,
                               expectations)
from ..operators.daily import daily_ohlcv
from ..operators.indicators import indicators
from ..operators.joins import enrich_suppliers
from ..operators.layout import cluster_rewrite, compact
from ..operators.upsert import append_evolve, snapshot_asof, snapshot_asof_series, upsert, upsert_path
from ..session import checkpoint_dir
from ..sources import fixtures as FX
from ..sources import html as H
from ..sources import landing as L
from ..sources.tables import write_partitioned
from .medallion import market_graph
from .oracle import INGEST_BASE, RUN_TS, add, with_ctes
from .registry import bronze, daily, daily_bars, daily_sup, reg, silver

BASE = FX.INGEST_BASE
MON_ASOF = RUN_TS                     # stands in for CURRENT_DATE() in monitoring
MON_NOW = "2024-02-03 00:00:00"       # stands in for CURRENT_TIMESTAMP()
PREV_GOLD_CUTOFF = "2024-01-16 00:00:00"
BATCHES = ["20240110", "20240111", "20240112"]


def _scratch(s) -> str:
    """A new folder in the shared one, for the stored layers of a query."""
    return f"{checkpoint_dir(s).rstrip('/')}/barlake-layers-{uuid.uuid4().hex}"


def _stored(df):
    """A stored layer: a reliable checkpoint in the shared folder, so that no reference derives it again."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


# ================================================================= calendar
def _order_dates(s, d):
    return FX.table(s, d, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()


add("odates", (), "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders")
# Days after 1 March of the Paschal full moon by golden number, for the years 1900 to 2199.
PASCHAL_MOONS = [44, 33, 22, 41, 30, 48, 38, 27, 46, 35, 24, 43, 32, 21, 40, 29, 47, 36, 26]
add("gf", (), f"""SELECT y AS year, moon + CAST(5 - dayofweek(moon) AS INTEGER) AS good_friday
    FROM (SELECT y, make_date(y, 3, 1) + {PASCHAL_MOONS}[y % 19 + 1] AS moon
          FROM (SELECT CAST(unnest(generate_series(min(year(o_orderdate)) - 1, max(year(o_orderdate)))) AS INTEGER) AS y
                FROM orders) years) moons""")


def _obs(x: str) -> str:
    return f"(CASE isodow({x}) WHEN 6 THEN {x} - 1 WHEN 7 THEN {x} + 1 ELSE {x} END)"


_HOLIDAY = f"""(d = (CASE isodow(make_date(y, 1, 1)) WHEN 6 THEN make_date(y, 1, 3)
                  WHEN 7 THEN make_date(y, 1, 2) ELSE make_date(y, 1, 1) END)
     OR (mo = 1 AND wd = 1 AND dd BETWEEN 15 AND 21) OR (mo = 2 AND wd = 1 AND dd BETWEEN 15 AND 21)
     OR d = good_friday OR (mo = 5 AND wd = 1 AND dd >= 25)
     OR (y >= 2021 AND d = {_obs('make_date(y, 6, 19)')}) OR d = {_obs('make_date(y, 7, 4)')}
     OR (mo = 9 AND wd = 1 AND dd <= 7) OR (mo = 11 AND wd = 4 AND dd BETWEEN 22 AND 28)
     OR d = {_obs('make_date(y, 12, 25)')})"""
add("ocal", ("gf",), f"""SELECT d AS date, {_HOLIDAY} AS is_holiday, isodow(d) < 6 AND NOT {_HOLIDAY} AS is_trading_day
    FROM (SELECT d, CAST(year(d) AS INTEGER) AS y, month(d) AS mo, day(d) AS dd, isodow(d) AS wd, gf.good_friday
          FROM (SELECT CAST(unnest(generate_series(
                   (SELECT min(CAST(o_orderdate AS DATE)) FROM orders) - INTERVAL 40 DAY,
                   (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d) g
          JOIN gf ON gf.year = year(g.d)) c""")
_PREV = "(SELECT max(c.date) FROM ocal c WHERE c.is_trading_day AND c.date < {x} AND c.date >= {x} - 14)"


def _prev(x: str) -> str:
    return f"coalesce({_PREV.format(x=x)}, {x} - 15)"


reg("cal_good_friday", with_ctes("gf") + """SELECT year, good_friday FROM gf
    WHERE year IN (SELECT DISTINCT year(o_orderdate) FROM orders)""")(
    lambda s, d: (FX.table(s, d, "orders").select(F.year("o_orderdate").alias("year")).distinct()
                  .select("year", C.good_friday("year").alias("good_friday"))))

reg("cal_trading_days", with_ctes("odates", "ocal") + """SELECT o.date, c.is_holiday, c.is_trading_day
    FROM odates o JOIN ocal c ON o.date = c.date""")(
    lambda s, d: CO.with_calendar_flags(_order_dates(s, d), "date").select("date", "is_holiday",
                                                                           "is_trading_day"))

reg("cal_holidays", with_ctes("ocal") + """SELECT date, is_trading_day FROM ocal
    WHERE is_holiday AND date >= (SELECT min(CAST(o_orderdate AS DATE)) FROM orders)""")(
    lambda s, d: CO.calendar_frame(
        s, FX.table(s, d, "orders").select(F.min(F.to_date("o_orderdate"))).scalar(),
        FX.table(s, d, "orders").select(F.max(F.to_date("o_orderdate"))).scalar())
    .filter("is_holiday").select("date", "is_trading_day"))

reg("cal_prev_trading_day", with_ctes("odates", "ocal") + f"""SELECT o.date, {_prev('o.date')} AS last_trading_day
    FROM odates o""")(
    lambda s, d: CO.with_calendar_flags(_order_dates(s, d), "date").select("date", "last_trading_day"))

reg("cal_target_day", with_ctes("odates", "ocal") + f"""SELECT date, CASE WHEN ltd >= date - 2
        THEN {_prev('(ltd - 3)')} ELSE ltd END AS target_day
    FROM (SELECT o.date, {_prev('o.date')} AS ltd FROM odates o) t""")(
    lambda s, d: CO.with_calendar_flags(_order_dates(s, d), "date").select("date", "target_day"))

reg("q_missing_days", with_ctes("daily") + f"""SELECT s.symbol, CAST(g.d AS DATE) AS expected_date,
        'Missing' AS status
    FROM (SELECT DISTINCT symbol FROM daily) s,
         (SELECT unnest(generate_series(CAST((SELECT min(trade_date) FROM daily) AS DATE), CAST((SELECT max(trade_date) FROM daily) AS DATE),
                                        INTERVAL 1 DAY)) AS d) g
    WHERE isodow(g.d) < 6 AND NOT EXISTS (SELECT 1 FROM daily a WHERE a.symbol = s.symbol
                                          AND CAST(a.trade_date AS DATE) = CAST(g.d AS DATE))""")(
    lambda s, d: CO.missing_days(daily(s, d)))

reg("q_missing_trading_days", with_ctes("daily", "ocal") + f"""SELECT s.symbol, c.date AS expected_date,
        'Missing' AS status
    FROM (SELECT DISTINCT symbol FROM daily) s, ocal c
    WHERE c.is_trading_day AND c.date >= CAST((SELECT min(trade_date) FROM daily) AS DATE)
      AND c.date <= CAST((SELECT max(trade_date) FROM daily) AS DATE)
      AND NOT EXISTS (SELECT 1 FROM daily a WHERE a.symbol = s.symbol AND CAST(a.trade_date AS DATE) = c.date)""")(
    # C6 holiday-aware variant: expected days are exchange trading days
    lambda s, d: CO.missing_days(daily(s, d), trading_days_only=True))

# ================================================================= symbols, provider frames
_CAND = """SELECT page_id, href, upper(replace(rtrim(string_split(href, '/')[2], '/'), 'ß', 'SS')) AS candidate
    FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS href FROM pages)
    WHERE contains(href, '/')"""
_VALID = """coalesce(regexp_full_match(candidate, '[\\p{Lu}\\p{N}.]{1,5}') AND regexp_matches(candidate, '\\p{Lu}')
      AND NOT starts_with(candidate, '.') AND NOT ends_with(candidate, '.'), false)"""
reg("valid_symbols", f"SELECT page_id, href, candidate, {_VALID} AS is_valid FROM ({_CAND}) c")(
    lambda s, d: H.link_candidates(FX.table(s, d, "pages"), "/"))
reg("extract_symbols", f"""SELECT candidate AS symbol, count(DISTINCT page_id) AS n_pages FROM ({_CAND}) c
    WHERE {_VALID} GROUP BY 1""")(
    lambda s, d: H.extract_symbols(FX.table(s, d, "pages"), "/"))

# the pages have no tables: each one's first list becomes one, a numbered row for each item, so that all that is found is page content
_LISTED_LINKS = """SELECT page_id, regexp_extract(item, 'href="([^"]*)"', 1) AS href,
           trim(regexp_replace(item, '<[^>]*>', '', 'g')) AS label
    FROM (SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1), '(?s)<li>(.*?)</li>', 1)) AS item
          FROM pages) items"""
_NAMED = f"""SELECT page_id, unnest([upper(replace(rtrim(string_split(href, '/')[2], '/'), 'ß', 'SS')),
           upper(replace(label, 'ß', 'SS'))]) AS candidate, unnest([1, 2]) AS turn, href FROM ({_LISTED_LINKS}) l"""
reg("extract_table_symbols", f"""SELECT candidate AS symbol, count(DISTINCT page_id) AS n_pages
    FROM (SELECT page_id, arg_min(candidate, turn) AS candidate FROM (SELECT * FROM ({_NAMED}) n WHERE {_VALID}) valid
          GROUP BY page_id, href) first_valid GROUP BY 1""")(
    lambda s, d: H.table_symbols(_lists_as_tables(FX.table(s, d, "pages")), "/"))


def _lists_as_tables(pages: DataFrame) -> DataFrame:
    html = F.col("html")
    for old, new in (("<ul>", "<table>"), ("</ul>", "</table>"), ("<li>", "<tr><td>*</td><td>"), ("</li>", "</td></tr>")):
        html = F.replace(html, F.lit(old), F.lit(new))
    return pages.select("page_id", html.alias("html"))


_INTERVALS = "('1m', '2m', '5m', '15m', '30m', '60m', '90m', '1h', '1d', '5d', '1wk', '1mo', '3mo')"
reg("normalize_interval", f"""SELECT event_id, requested,
        CASE WHEN requested IN {_INTERVALS} THEN requested ELSE '1d' END AS interval
    FROM (SELECT event_id, json_extract_string(props, '$.k') || 'm' AS requested FROM events)""")(
    lambda s, d: (FX.table(s, d, "events")
                  .select("event_id", F.concat(F.get_json_object("props", "$.k"), F.lit("m")).alias("requested"))
                  .withColumn("interval", normalize_interval("requested"))))


def _provider_frame(s, d):
    b = FX.bars(s, d)
    return b.select("symbol", F.col("ts").alias("Datetime"), F.col("open").alias("Open"),
                    F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"),
                    F.col("volume").alias("Volume"))


def _z(c):
    return f"coalesce(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 0.0)"


reg("normalize_bars", with_ctes("bars") + f"""SELECT symbol, ts AS "timestamp", {_z('open')} AS open,
        {_z('high')} AS high, {_z('low')} AS low, {_z('close')} AS close, coalesce(volume, 0) AS volume
    FROM bars""")(lambda s, d: L.normalize_bars(_provider_frame(s, d), F.col("symbol")))

reg("session_hours", with_ctes("bronze") + """SELECT * FROM bronze
    WHERE hour("timestamp") * 60 + minute("timestamp") >= 570 AND hour("timestamp") * 60 + minute("timestamp") < 960""")(
    lambda s, d: L.session_hours(bronze(s, d)))

reg("symbols_registry", with_ctes("bronze") + f"""SELECT DISTINCT symbol, 'events' AS source,
        TIMESTAMP '{RUN_TS}' AS ingestion_timestamp, 1 AS is_active FROM bronze WHERE symbol IS NOT NULL""")(
    lambda s, d: L.symbols_registry(bronze(s, d), "events", RUN_TS))

# ================================================================= expectations
reg("expect_drop_bronze", with_ctes("bronze") + """SELECT * FROM bronze
    WHERE coalesce(symbol IS NOT NULL AND symbol != '', false) AND "timestamp" IS NOT NULL""")(
    lambda s, d: expect_or_drop(bronze(s, d), expectations(BRONZE_DROP_EXPECTATIONS)))


def _exp_sql(dataset: str, src: str, preds: dict[str, str]) -> str:
    parts = [f"""SELECT '{name}' AS expectation, '{dataset}' AS dataset,
        CAST(sum(CASE WHEN coalesce({p}, false) THEN 1 ELSE 0 END) AS BIGINT) AS passed_records,
        CAST(count(*) - sum(CASE WHEN coalesce({p}, false) THEN 1 ELSE 0 END) AS BIGINT) AS failed_records,
        count(*) AS input_records,
        sum(CASE WHEN coalesce({p}, false) THEN 1 ELSE 0 END) * 100.0 / count(*) AS pass_rate_pct
        FROM {src}""" for name, p in preds.items()]
    return "\nUNION ALL\n".join(parts)


reg("expectation_report", with_ctes("bronze", "silver", "daily_bars") + "\nUNION ALL\n".join([
    _exp_sql("bronze_bars", "bronze", BRONZE_DROP_EXPECTATIONS).replace('timestamp IS', '"timestamp" IS'),
    _exp_sql("silver_bars", "silver", SILVER_WARN_EXPECTATIONS),
    _exp_sql("gold_daily_ohlcv", "daily_bars", DAILY_WARN_EXPECTATIONS)]), ("pass_rate_pct",))(
    lambda s, d: _union([DQ.expectation_counts(bronze(s, d), "bronze_bars", BRONZE_DROP_EXPECTATIONS),
                         DQ.expectation_counts(silver(s, d), "silver_bars", SILVER_WARN_EXPECTATIONS),
                         DQ.expectation_counts(daily_bars(s, d), "gold_daily_ohlcv",
                                               DAILY_WARN_EXPECTATIONS)]))

reg("medallion_end_to_end", with_ctes("analytics_bars") + "SELECT * FROM analytics_bars",
    ("sma_5", "sma_20", "sma_50", "volatility"))(
    lambda s, d: market_graph(bronze(s, d), RUN_TS).read("gold_analytics"))

# ================================================================= quality reports


def _nulls_sql(layer, src, cols):
    return "\nUNION ALL\n".join(
        f"""SELECT '{layer}' AS layer, '{c}' AS column_name,
        CAST(sum(CASE WHEN {('symbol IS NULL OR symbol = ' + "''") if c == 'symbol' else f'"{c}" IS NULL'}
                 THEN 1 ELSE 0 END) AS BIGINT) AS null_count FROM {src}""" for c in cols)


def _analytics_bars(s, d):
    return indicators(daily_bars(s, d), RUN_TS)


reg("dq_nulls", with_ctes("bronze", "silver", "daily_bars") + "\nUNION ALL\n".join(
    _nulls_sql(lay, src, DQ.NULL_COLUMNS[lay]) for lay, src in
    (("bronze", "bronze"), ("silver", "silver"), ("daily", "daily_bars"))))(
    lambda s, d: _union([DQ.null_report(bronze(s, d), "bronze"), DQ.null_report(silver(s, d), "silver"),
                         DQ.null_report(daily_bars(s, d), "daily")]))

reg("dq_ranges", with_ctes("bronze") + """SELECT min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp,
    min(close) AS min_close, max(close) AS max_close, min(volume) AS min_volume, max(volume) AS max_volume
    FROM bronze""")(lambda s, d: DQ.range_report(bronze(s, d)))

_DAYT = "CAST(date_trunc('day', \"timestamp\") AS TIMESTAMP)"
reg("dq_completeness", with_ctes("bronze", "silver", "daily_bars", "analytics_bars") + f"""
    SELECT 'bronze' AS layer, count(DISTINCT symbol) AS unique_symbols, count(DISTINCT {_DAYT}) AS unique_dates,
           count(DISTINCT batch_id) AS unique_batches, CAST(NULL AS DOUBLE) AS avg_bars_per_day FROM bronze
    UNION ALL SELECT 'silver', count(DISTINCT symbol), count(DISTINCT {_DAYT}), NULL, NULL FROM silver
    UNION ALL SELECT 'daily', count(DISTINCT symbol), count(DISTINCT trade_date), NULL, avg(num_bars) FROM daily_bars
    UNION ALL SELECT 'analytics', count(DISTINCT symbol), count(DISTINCT trade_date), NULL, NULL
    FROM analytics_bars""", ("avg_bars_per_day",))(
    lambda s, d: _union([DQ.completeness(bronze(s, d), "bronze", "timestamp", batch_col="batch_id"),
                         DQ.completeness(silver(s, d), "silver", "timestamp"),
                         DQ.completeness(daily_bars(s, d), "daily", "trade_date", bars_col="num_bars"),
                         DQ.completeness(_analytics_bars(s, d), "analytics", "trade_date")]))

reg("dq_quality_stats", with_ctes("silver") + """SELECT min(quality_score) AS min_quality,
    max(quality_score) AS max_quality, avg(quality_score) AS avg_quality, stddev(quality_score) AS stddev_quality
    FROM silver""", ("avg_quality", "stddev_quality"))(lambda s, d: DQ.quality_stats(silver(s, d)))

reg("dq_batch_metrics", with_ctes("silver") + """SELECT count(*) AS records,
    CAST(sum(CASE WHEN is_valid = 1 THEN 1 ELSE 0 END) AS BIGINT) AS valid_records,
    max(quality_score) AS max_quality, avg(quality_score) AS avg_quality FROM silver""", ("avg_quality",))(
    lambda s, d: DQ.batch_metrics(silver(s, d)))

reg("dq_validity", with_ctes("silver") + """SELECT is_valid, count(*) AS records,
    count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM silver GROUP BY is_valid""", ("pct",))(
    lambda s, d: DQ.validity_distribution(silver(s, d)))


def _rules_sql(layer, src, rules):
    return "\nUNION ALL\n".join(
        f"""SELECT '{layer}' AS layer, '{n}' AS rule,
        CAST(sum(CASE WHEN {r} THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM {src}""" for n, r in rules.items())


reg("dq_consistency", with_ctes("silver", "daily_bars") + _rules_sql("silver", "silver", DQ.SILVER_RULES)
    + "\nUNION ALL\n" + _rules_sql("daily", "daily_bars", DQ.DAILY_RULES))(
    lambda s, d: _union([DQ.consistency_violations(silver(s, d), "silver", DQ.SILVER_RULES),
                         DQ.consistency_violations(daily_bars(s, d), "daily", DQ.DAILY_RULES)]))

reg("dq_indicator_cov", with_ctes("analytics_bars") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS indicator, count({c}) AS non_null, count({c}) * 100.0 / count(*) AS pct FROM analytics_bars"
    for c in DQ.INDICATORS), ("pct",))(lambda s, d: DQ.indicator_coverage(_analytics_bars(s, d)))

reg("dq_indicator_stats", with_ctes("analytics_bars") + "SELECT " + ", ".join(
    f"avg({c}) AS avg_{c}" for c in DQ.INDICATORS) + " FROM analytics_bars",
    tuple(f"avg_{c}" for c in DQ.INDICATORS))(lambda s, d: DQ.indicator_stats(_analytics_bars(s, d)))

reg("dq_layer_ranges", with_ctes("bronze", "silver", "daily_bars") + f"""
    SELECT 'bronze' AS layer, min({_DAYT}) AS min_date, max({_DAYT}) AS max_date FROM bronze
    UNION ALL SELECT 'silver', min({_DAYT}), max({_DAYT}) FROM silver
    UNION ALL SELECT 'gold', min(trade_date), max(trade_date) FROM daily_bars""")(
    lambda s, d: DQ.layer_date_ranges(bronze(s, d), silver(s, d), daily_bars(s, d)))

# inputs with gaps: silver without the symbol that comes first, gold without the one that comes last
reg("symbol_lineage_gaps", with_ctes("bronze", "silver", "daily_bars") + """
    SELECT 'bronze_not_silver' AS gap, symbol FROM bronze
    WHERE symbol NOT IN (SELECT symbol FROM silver) OR symbol = (SELECT min(symbol) FROM silver) GROUP BY ALL
    UNION ALL SELECT 'bronze_not_silver', NULL FROM bronze WHERE symbol IS NULL GROUP BY ALL
    UNION ALL SELECT 'silver_not_gold', max(symbol) FROM silver""")(
    lambda s, d: DQ.symbol_lineage_gaps(
        bronze(s, d),
        silver(s, d).filter(F.col("symbol") > silver(s, d).select(F.min("symbol")).scalar()),
        daily_bars(s, d).filter(F.col("symbol") < silver(s, d).select(F.max("symbol")).scalar())))

# ================================================================= monitoring (mon_*)
_MA = f"TIMESTAMP '{MON_ASOF}'"
reg("mon_bronze", with_ctes("bronze") + f"""SELECT day AS ingestion_date, n AS total_records, unique_symbols,
        n - named AS null_symbols, n - timed AS null_timestamps, n - closed AS null_closes, first_ingestion, last_ingestion
    FROM (SELECT CAST(ingestion_timestamp AS DATE) AS day, count(*) AS n, count(symbol) AS named, count("timestamp") AS timed,
                 count(close) AS closed, count(DISTINCT symbol) AS unique_symbols, min(ingestion_timestamp) AS first_ingestion,
                 max(ingestion_timestamp) AS last_ingestion
          FROM bronze WHERE {_MA} - ingestion_timestamp <= INTERVAL 7 DAY GROUP BY day) days""")(
    lambda s, d: MON.bronze_daily(bronze(s, d), MON_ASOF))

reg("mon_silver", with_ctes("silver") + f"""SELECT day AS process_date, valid + invalid AS total_records, valid AS valid_records,
        invalid AS invalid_records, list_avg(scores) AS avg_quality_score, list_min(scores) AS min_quality_score,
        list_max(scores) AS max_quality_score, valid * 100.0 / (valid + invalid) AS validity_rate_pct
    FROM (SELECT CAST(stamp AS DATE) AS day, count(*) FILTER (is_valid = 1) AS valid, count(*) FILTER (is_valid = 0) AS invalid,
                 list(quality_score) AS scores
          FROM (SELECT *, processed_timestamp - INTERVAL (hour("timestamp")) DAY AS stamp FROM silver) spread
          WHERE {_MA} - stamp <= INTERVAL 7 DAY GROUP BY day) days""",
    ("avg_quality_score", "validity_rate_pct"))(
    # stamps spread over a day for each hour: several process days, and older ones that the report leaves out
    lambda s, d: MON.silver_daily(silver(s, d).withColumn(
        "processed_timestamp", F.col("processed_timestamp") - F.make_dt_interval(days=F.hour("timestamp"))), MON_ASOF))

# symbols with few rows; they miss days if they span over one and a half days a row
_GC = """SELECT symbol, n AS trading_days, days[1] AS first_date, days[-1] AS last_date, span::INT AS date_range_days,
        ['Complete', 'Missing Days Detected'][1 + (2 * span > 3 * n)::INT] AS completeness_status
    FROM (SELECT symbol, days, len(days) AS n, CAST(days[-1] AS DATE) - CAST(days[1] AS DATE) AS span
          FROM (SELECT symbol, list_sort(list(trade_date)) AS days FROM {src} GROUP BY symbol) listed) spans
    WHERE n < {n}"""
# all of daily_bars, and beside each symbol two more of the same bars: .W traded on every fifth day of the month only (days
# missing), .N up to the tenth only (few days, none missing); the symbols themselves have days enough and stay out
_LISTED = """SELECT symbol, trade_date FROM daily_bars
    UNION ALL SELECT symbol || '.W', trade_date FROM daily_bars WHERE day(trade_date) % 5 = 0
    UNION ALL SELECT symbol || '.N', trade_date FROM daily_bars WHERE day(trade_date) <= 10"""


def _listed(daily: DataFrame) -> DataFrame:
    day, symbol = F.dayofmonth("trade_date"), F.col("symbol")
    listed = F.array(symbol, F.when(day % 5 == 0, F.concat(symbol, F.lit(".W"))),
                     F.when(day <= 10, F.concat(symbol, F.lit(".N"))))
    return daily.select(F.explode(F.array_compact(listed)).alias("symbol"), "trade_date")


reg("mon_gold_completeness", with_ctes("daily_bars") + _GC.format(src=f"({_LISTED}) l", n=20))(
    lambda s, d: MON.gold_completeness(_listed(daily_bars(s, d))))

_LAYER_DAYS = f"""SELECT 'b' AS layer, "timestamp" AS moment, symbol FROM bronze WHERE "timestamp" >= {_MA} - INTERVAL 7 DAY
    UNION ALL SELECT 's', "timestamp", symbol FROM silver WHERE processed_timestamp >= {_MA} - INTERVAL 7 DAY
    UNION ALL SELECT 'g', trade_date, symbol FROM daily_bars WHERE trade_date >= {_MA} - INTERVAL 7 DAY"""
_PER_LAYER = ", ".join(f"""max(symbols) FILTER (layer = '{x[0]}') AS {x}_symbols,
        max(records) FILTER (layer = '{x[0]}') AS {x}_records""" for x in ("bronze", "silver", "gold"))
reg("mon_cross_layer", with_ctes("bronze", "silver", "daily_bars") + f"""SELECT *, CASE
        WHEN silver_records / bronze_records < 0.9 THEN 'Warning: High Silver Filter Rate'
        WHEN gold_records / silver_records < 0.8 THEN 'Warning: High Gold Filter Rate' ELSE 'OK' END AS consistency_status
    FROM (SELECT trade_date, {_PER_LAYER}
          FROM (SELECT layer, CAST(moment AS DATE) AS trade_date, count(DISTINCT symbol) AS symbols, count(*) AS records
                FROM ({_LAYER_DAYS}) r GROUP BY ALL) layers GROUP BY trade_date) days""")(
    lambda s, d: MON.cross_layer(bronze(s, d), silver(s, d), daily_bars(s, d), MON_ASOF))

reg("mon_symbol_days", with_ctes("silver", "daily_bars") + """
    SELECT COALESCE(s.trade_date, g.trade_date) AS trade_date, s.silver_symbol_days, g.gold_rows,
        CASE WHEN coalesce(s.silver_symbol_days, 0) = coalesce(g.gold_rows, 0) THEN 'OK' ELSE 'Mismatch' END AS status
    FROM (SELECT CAST("timestamp" AS DATE) AS trade_date, count(DISTINCT symbol) AS silver_symbol_days
          FROM silver WHERE is_valid = 1 GROUP BY 1) s
    FULL OUTER JOIN (SELECT CAST(trade_date AS DATE) AS trade_date, count(*) AS gold_rows
          FROM daily_bars GROUP BY 1) g ON s.trade_date = g.trade_date""")(
    lambda s, d: MON.symbol_day_consistency(silver(s, d), daily_bars(s, d)))

reg("mon_alerts", with_ctes("silver") + f"""SELECT * FROM (SELECT CAST(processed_timestamp AS DATE) AS process_date,
    avg(quality_score) AS avg_quality,
    CAST(sum(CASE WHEN is_valid = 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_count
    FROM (SELECT quality_score * 0.5 AS quality_score, is_valid, processed_timestamp + INTERVAL (hour("timestamp")) HOUR
              AS processed_timestamp FROM silver) worse
    WHERE processed_timestamp >= {_MA} - INTERVAL 1 DAY GROUP BY 1)
    WHERE avg_quality < 0.8 OR invalid_count > 100""", ("avg_quality",))(
    # halved scores, spread over stamps: the alert fires
    lambda s, d: MON.alerts(silver(s, d).withColumns({
        "quality_score": F.col("quality_score") * 0.5,
        "processed_timestamp": F.col("processed_timestamp") + F.make_dt_interval(hours=F.hour("timestamp"))}), MON_ASOF))

# every row of the three layers with the stamp that tells its age and the one that tells its last change
_STAMPED = """SELECT * FROM (SELECT 'Bronze' AS layer, symbol, ingestion_timestamp AS aged, ingestion_timestamp AS changed FROM bronze
    UNION ALL SELECT 'Silver', symbol, processed_timestamp, processed_timestamp FROM silver
    UNION ALL SELECT 'Gold', symbol, trade_date, updated_timestamp FROM daily_bars) stacked"""
HEALTH_ASOF = "2024-01-31 00:00:00"     # the day after gold's last one

reg("mon_health", with_ctes("bronze", "silver", "daily_bars") + f"""SELECT layer, count(*) AS total_records,
        count(DISTINCT symbol) AS unique_symbols, max(changed) AS last_update
    FROM ({_STAMPED}) rows WHERE TIMESTAMP '{HEALTH_ASOF}' - aged <= INTERVAL 1 DAY GROUP BY layer""")(
    lambda s, d: MON.health(bronze(s, d), silver(s, d), daily_bars(s, d), HEALTH_ASOF))

reg("mon_freshness", with_ctes("bronze", "silver", "daily_bars") + f"""SELECT layer, last_update,
        datediff('hour', last_update, TIMESTAMP '{MON_NOW}') AS hours_since_update
    FROM (SELECT layer, max(changed) AS last_update FROM ({_STAMPED}) rows GROUP BY layer) layers""")(
    lambda s, d: MON.freshness(bronze(s, d), silver(s, d), daily_bars(s, d), MON_NOW))

# ================================================================= incremental
reg("incremental_bronze", with_ctes("bronze1") + "SELECT * FROM bronze1")(
    lambda s, d: INC.incremental_bronze(bronze(s, d), last_ts=BASE))

reg("incremental_bronze_batch", with_ctes("bronze") + "SELECT * FROM bronze WHERE batch_id IN "
    + "(" + ", ".join(f"'{b}'" for b in BATCHES) + ")")(
    lambda s, d: INC.incremental_bronze(bronze(s, d), batch_ids=BATCHES))

def _stamped(silver_rows):
    """Silver as if the rows of even hours had been processed with the first load."""
    even = F.hour("timestamp") % 2 == 0
    return silver_rows.withColumn("processed_timestamp", F.when(even, F.lit(BASE).cast("timestamp_ntz"))
                                  .otherwise(F.col("processed_timestamp")))


reg("incremental_silver", with_ctes("silver") + """SELECT * FROM silver WHERE hour("timestamp") % 2 = 1""")(
    lambda s, d: INC.incremental_silver(_stamped(silver(s, d)), BASE))

reg("watermarks", with_ctes("bronze", "silver", "daily_bars") + """
    SELECT 'bronze' AS layer, max(ingestion_timestamp) AS high_water_mark FROM bronze
    UNION ALL SELECT 'silver', max(processed_timestamp) FROM silver
    UNION ALL SELECT 'gold', max(updated_timestamp) FROM daily_bars""")(
    lambda s, d: INC.watermarks(bronze(s, d), silver(s, d), daily_bars(s, d)))


def _prev_gold(s, d):
    return daily_bars(s, d).filter(F.col("trade_date") < F.lit(PREV_GOLD_CUTOFF).cast("timestamp_ntz"))


_SDAYS = f"""SELECT DISTINCT symbol, {_DAYT} AS trade_date FROM silver WHERE is_valid = 1"""
_NEW = f"""SELECT * FROM ({_SDAYS}) n WHERE NOT EXISTS (SELECT 1 FROM daily_bars g
    WHERE g.trade_date < TIMESTAMP '{PREV_GOLD_CUTOFF}' AND g.symbol = n.symbol AND g.trade_date = n.trade_date)"""
reg("new_dates", with_ctes("silver", "daily_bars") + _NEW)(
    lambda s, d: INC.new_dates(silver(s, d), _prev_gold(s, d)))

def _pending_silver(s, d):
    """Stored silver of the symbol-days that gold, which ends at the cutoff, hasn't seen by the ledger."""
    root = _scratch(s)
    rows = _stored(silver(s, d))
    write_partitioned(rows, f"{root}/silver", "timestamp")
    old = F.col("timestamp") < F.lit(PREV_GOLD_CUTOFF).cast("timestamp_ntz")
    LED.note(f"{root}/ledger", 0, rows.filter(old))
    LED._noted(s.range(1), f"{root}/ledger/seen", 0)
    LED.note(f"{root}/ledger", 1, rows.filter(~old & (F.col("is_valid") == 1)))
    touched, _ = LED.pending(s, f"{root}/ledger")
    return LED.touched_silver(s, f"{root}/silver", touched).drop(LED.PART)


reg("incremental_daily", with_ctes("silver", "daily_bars") + f"""SELECT * FROM daily_bars
    WHERE (symbol, trade_date) IN (SELECT (symbol, trade_date) FROM ({_NEW}) x)""")(
    lambda s, d: daily_ohlcv(_pending_silver(s, d), RUN_TS))

# ================================================================= upsert / refresh / time travel


def _first_load(s, d):
    return INC.incremental_bronze(bronze(s, d)).filter(F.col("ingestion_timestamp") <= F.lit(BASE).cast("timestamp_ntz"))


def _late(s, d):
    return INC.incremental_bronze(bronze(s, d), last_ts=BASE)


_SKEY = '"timestamp"'
reg("silver_upsert", with_ctes("silver0", "silver1") + f"""
    SELECT * FROM silver0 t WHERE NOT EXISTS (SELECT 1 FROM silver1 u WHERE u.symbol = t.symbol
                                               AND u.{_SKEY} = t.{_SKEY})
    UNION ALL SELECT * FROM silver1""")(
    lambda s, d: upsert(clean_bronze_to_silver(_first_load(s, d), RUN_TS),
                        clean_bronze_to_silver(_late(s, d), RUN_TS), ["symbol", "timestamp"]))

def _delete_day(s, d):
    """Silver on disk loses all rows of its first day through the merge's deletes."""
    path = f"{_scratch(s)}/silver"
    rows = silver(s, d).withColumn("part_date", F.to_date("timestamp"))
    first = rows.filter(F.col("part_date") == rows.select(F.min("part_date")).scalar())
    upsert_path(s, rows, path, ["symbol", "timestamp"], "part_date")
    upsert_path(s, rows.limit(0), path, ["symbol", "timestamp"], "part_date",
                deletes=first.select("symbol", "timestamp", "part_date"))
    return s.read.parquet(path).drop("part_date")


reg("upsert_delete_day", with_ctes("silver") + f"""SELECT * FROM silver
    WHERE CAST({_SKEY} AS DATE) > (SELECT min(CAST({_SKEY} AS DATE)) FROM silver)""")(_delete_day)

reg("bronze_upsert3", with_ctes("bronze0", "bronze1") + f"""
    SELECT * FROM bronze0 t WHERE NOT EXISTS (SELECT 1 FROM bronze1 u WHERE u.symbol = t.symbol
                                               AND u.{_SKEY} = t.{_SKEY} AND u.batch_id = t.batch_id)
    UNION ALL SELECT * FROM bronze1""")(
    lambda s, d: upsert(_first_load(s, d), _late(s, d), ["symbol", "timestamp", "batch_id"]))


def _refresh(s, d):
    silver0 = _stored(clean_bronze_to_silver(_first_load(s, d), RUN_TS))
    changed = _stored(clean_bronze_to_silver(_late(s, d), RUN_TS))
    daily0 = _stored(daily_ohlcv(silver0, RUN_TS))
    silver_all = _stored(upsert(silver0, changed, ["symbol", "timestamp"]))
    new_daily, _ = INC.refresh_daily(silver_all, daily0, changed, RUN_TS, complete=True)
    return daily0, changed, new_daily


reg("gold_upsert", with_ctes("daily_bars") + "SELECT * FROM daily_bars")(
    # incremental refresh == full recompute (touched + missing symbol-days upserted into gold)
    lambda s, d: _refresh(s, d)[2])


def _analytics_refresh(s, d):
    daily0, changed, new_daily = _refresh(s, d)
    analytics0 = _stored(indicators(daily0, RUN_TS))
    return INC.refresh_indicators(_stored(new_daily), analytics0, INC.touched_days(changed), RUN_TS)


reg("analytics_refresh", with_ctes("analytics_bars") + "SELECT * FROM analytics_bars",
    ("sma_5", "sma_20", "sma_50", "volatility"))(_analytics_refresh)

def _ledger_refresh(s, d, layer):
    """Stored layers by ledger: the first load, then the late corrections."""
    root = _scratch(s)
    at = {x: f"{root}/{x}" for x in ("silver", "daily", "analytics", "ledger")}
    for run, bars in enumerate(clean_bronze_to_silver(b, RUN_TS) for b in (_first_load(s, d), _late(s, d))):
        LED.merge_bars(s, bars, at["silver"], at["ledger"], run)
        LED.refresh_gold(s, at["silver"], at["daily"], at["analytics"], at["ledger"], RUN_TS)
    return s.read.parquet(at[layer]).drop(LED.PART)


reg("gold_ledger", with_ctes("daily_bars") + "SELECT * FROM daily_bars")(lambda s, d: _ledger_refresh(s, d, "daily"))
reg("analytics_ledger", with_ctes("analytics_bars") + "SELECT * FROM analytics_bars",
    ("sma_5", "sma_20", "sma_50", "volatility"))(lambda s, d: _ledger_refresh(s, d, "analytics"))

reg("snapshot_asof", with_ctes("bronze0") + """SELECT symbol, "timestamp", open, high, low, close, volume,
        ingestion_timestamp, batch_id FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol, "timestamp" ORDER BY ingestion_timestamp DESC,
             batch_id DESC, open DESC, high DESC, low DESC, close DESC, volume DESC) AS rn
      FROM bronze0 WHERE symbol IS NOT NULL AND "timestamp" IS NOT NULL) WHERE rn = 1""")(
    lambda s, d: snapshot_asof(bronze(s, d), BASE))

STAMPS = ["2024-01-31 12:00:00", BASE, "2024-02-01 00:30:00", "2024-02-01 01:00:00", "2024-02-01 09:00:00"]
reg("snapshot_asof_series", with_ctes("bronze") + f"""SELECT as_of, symbol, "timestamp", open, high, low, close, volume,
        ingestion_timestamp, batch_id FROM (
      SELECT *, row_number() OVER (PARTITION BY as_of, symbol, "timestamp" ORDER BY ingestion_timestamp DESC,
             batch_id DESC, open DESC, high DESC, low DESC, close DESC, volume DESC) AS rn
      FROM bronze, (SELECT unnest([{", ".join(f"TIMESTAMP '{x}'" for x in STAMPS)}]) AS as_of) s
      WHERE ingestion_timestamp <= as_of AND symbol IS NOT NULL AND "timestamp" IS NOT NULL) WHERE rn = 1""")(
    lambda s, d: snapshot_asof_series(bronze(s, d), STAMPS))

reg("append_evolve", with_ctes("bronze0", "bronze1") + """
    SELECT symbol, "timestamp", open, high, low, close, volume, ingestion_timestamp,
           CAST(NULL AS VARCHAR) AS batch_id FROM bronze0
    UNION ALL SELECT * FROM bronze1""")(
    lambda s, d: append_evolve(_first_load(s, d).drop("batch_id"), _late(s, d)))

# ================================================================= layout and dimension joins
reg("cluster_rewrite", with_ctes("daily_sup") + "SELECT * FROM daily_sup")(
    lambda s, d: cluster_rewrite(daily_sup(s, d), ["trade_date", "symbol"]))

def _compacted(s, d):
    """Daily rows stored by year in many small files, read back after compaction."""
    path = f"{_scratch(s)}/daily"
    rows = daily_sup(s, d)
    rows.withColumn("year", F.year("trade_date")).repartition(40).write.partitionBy("year").parquet(path)
    compact(s, path, target=4 << 20)
    return s.read.parquet(path).select(*rows.columns)


reg("compacted_daily", with_ctes("daily_sup") + "SELECT * FROM daily_sup")(_compacted)

reg("broadcast_dim_join", with_ctes("daily_sup") + """SELECT d.symbol, d.trade_date, d.close, s.s_name, n.n_name
    FROM daily_sup d JOIN supplier s ON d.symbol = CAST(s.s_suppkey AS VARCHAR)
    JOIN nation n ON s.s_nationkey = n.n_nationkey""")(
    lambda s, d: enrich_suppliers(daily_sup(s, d), FX.table(s, d, "supplier"), FX.table(s, d, "nation")))
