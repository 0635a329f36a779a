"""DuckDB SQL for the oracle side of every registered query.

The oracle is an independent, straightforward SQL statement of each query's
semantics (row_number dedup, self-join correlation, full expected-date grid...),
written against the driver's pre-registered views. The Spark side computes the
same result with plans chosen for scale; the two meet only in the result.

``with_ctes(*names)`` emits a WITH clause containing the named derived tables and
everything they depend on, in dependency order.
"""

from __future__ import annotations

RUN_TS = "2024-02-02 00:00:00"
_RUN = f"TIMESTAMP '{RUN_TS}'"


def _daily_tail(src: str) -> str:
    return f"""SELECT symbol, trade_date, open, high, low, close, volume, num_bars,
           CASE WHEN open != 0 THEN (close - open) / open END AS daily_return,
           high - low AS price_range, (high + low) / 2.0::DOUBLE AS avg_price,
           {_RUN} AS updated_timestamp
    FROM ({src}) _d"""


def _analytics(daily: str) -> str:
    return f"""SELECT symbol, trade_date,
           avg(close) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS sma_5,
           avg(close) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS sma_20,
           avg(close) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS sma_50,
           stddev_samp(daily_return) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS volatility,
           {_RUN} AS updated_timestamp
    FROM {daily}"""


SCORE = ("0.4::DOUBLE * 1.0::DOUBLE + ((high >= low)::DOUBLE + (high >= close)::DOUBLE + (high >= open)::DOUBLE"
         " + (low <= close)::DOUBLE + (low <= open)::DOUBLE) / 5.0::DOUBLE * 0.4::DOUBLE"
         " + ((open > 0)::DOUBLE + (high > 0)::DOUBLE + (low > 0)::DOUBLE + (close > 0)::DOUBLE"
         " + (volume >= 0)::DOUBLE) / 5.0::DOUBLE * 0.2::DOUBLE")

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "bars_g": ((), """SELECT event_type AS symbol, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hr,
           min(event_id) AS bar_id, min_by(value, event_id) AS o, max(value) AS h, min(value) AS l,
           max_by(value, event_id) AS c, CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS v
    FROM events GROUP BY 1, 2"""),
    "bars": (("bars_g",), """SELECT bar_id, symbol, hr,
           CASE WHEN bar_id % 97 = 0 THEN NULL ELSE hr END AS ts,
           CASE WHEN bar_id % 89 = 0 THEN NULL ELSE o END AS open,
           CASE WHEN bar_id % 31 = 0 THEN l - 1.0 ELSE h END AS high,
           l AS low,
           CASE WHEN bar_id % 53 = 0 THEN NULL WHEN bar_id % 37 = 0 THEN -c ELSE c END AS close,
           v AS volume, 0 AS ingest_seq
    FROM bars_g
    UNION ALL
    SELECT bar_id, symbol, hr, hr, o, h, l, c, v + 1, 1 FROM bars_g WHERE bar_id % 20 = 0"""),
    "bronze": (("bars",), """SELECT symbol, ts AS "timestamp", open, high, low, close, volume,
           TIMESTAMP '2024-02-01 00:00:00' + ingest_seq * INTERVAL 1 HOUR AS ingestion_timestamp,
           strftime(hr, '%Y%m%d') AS batch_id
    FROM bars"""),
    "bronze_keys": (("bronze",), """SELECT * FROM bronze
    WHERE symbol IS NOT NULL AND "timestamp" IS NOT NULL AND close IS NOT NULL"""),
    "bronze_dedup": (("bronze_keys",), """SELECT symbol, "timestamp", open, high, low, close, volume,
           ingestion_timestamp, batch_id FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol, "timestamp"
             ORDER BY ingestion_timestamp DESC, batch_id DESC, open DESC, high DESC, low DESC,
                      close DESC, volume DESC) AS rn
      FROM bronze_keys) WHERE rn = 1"""),
    "silver": (("bronze_dedup",), f"""SELECT symbol, "timestamp", open, high, low, close, volume,
           {_RUN} AS processed_timestamp,
           CASE WHEN qs >= 0.8 THEN 1 ELSE 0 END AS is_valid, qs AS quality_score
    FROM (SELECT *, {SCORE} AS qs FROM bronze_dedup
          WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND volume IS NOT NULL) _s"""),
    "daily_bars": (("silver",), _daily_tail("""SELECT symbol, CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS trade_date,
           min_by(open, "timestamp") AS open, max(high) AS high, min(low) AS low,
           max_by(close, "timestamp") AS close, CAST(sum(volume) AS BIGINT) AS volume,
           CAST(count(*) AS INTEGER) AS num_bars
    FROM silver WHERE is_valid = 1 GROUP BY 1, 2""")),
    "analytics_bars": (("daily_bars",), _analytics("daily_bars")),
    "daily": ((), _daily_tail("""SELECT o_orderpriority AS symbol, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS trade_date,
           min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
           max_by(o_totalprice, o_orderkey) AS close, CAST(count(*) AS BIGINT) AS volume,
           CAST(count(*) AS INTEGER) AS num_bars
    FROM orders GROUP BY 1, 2""")),
    "analytics": (("daily",), _analytics("daily")),
    "asof": (("daily",), "SELECT max(trade_date) AS asof FROM daily"),
    "sticks": ((), """SELECT CAST(l_suppkey AS VARCHAR) AS symbol,
           CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS trade_date,
           l_orderkey * 100000000 + CAST(l_linenumber AS BIGINT) * 10000000 + l_partkey AS seq,
           l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume
    FROM lineitem"""),
    "daily_sup": (("sticks",), _daily_tail("""SELECT symbol, trade_date, min_by(price, seq) AS open, max(price) AS high,
           min(price) AS low, max_by(price, seq) AS close, CAST(sum(volume) AS BIGINT) AS volume,
           CAST(count(*) AS INTEGER) AS num_bars
    FROM sticks GROUP BY 1, 2""")),
    "analytics_sup": (("daily_sup",), _analytics("daily_sup")),
}


def add_silver_chain(name: str, src: str) -> None:
    """Register CTEs ``<name>_keys -> <name>_dedup -> <name>`` cleaning bronze-like ``src``."""
    CTES[f"{name}_keys"] = ((src,), f"""SELECT * FROM {src}
    WHERE symbol IS NOT NULL AND "timestamp" IS NOT NULL AND close IS NOT NULL""")
    CTES[f"{name}_dedup"] = ((f"{name}_keys",), CTES["bronze_dedup"][1].replace("bronze_keys", f"{name}_keys"))
    CTES[name] = ((f"{name}_dedup",), CTES["silver"][1].replace("bronze_dedup", f"{name}_dedup"))


def add_daily(name: str, silver: str) -> None:
    CTES[name] = ((silver,), CTES["daily_bars"][1].replace("FROM silver WHERE", f"FROM {silver} WHERE"))


def add(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


INGEST_BASE = "TIMESTAMP '2024-02-01 00:00:00'"
add("bronze0", ("bronze",), f"SELECT * FROM bronze WHERE ingestion_timestamp <= {INGEST_BASE}")
add("bronze1", ("bronze",), f"SELECT * FROM bronze WHERE ingestion_timestamp > {INGEST_BASE}")
add_silver_chain("silver0", "bronze0")
add_silver_chain("silver1", "bronze1")
add_daily("daily0", "silver0")


def with_ctes(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n    {CTES[n][1]}\n)" for n in order) + "\n"


def rounded(sql: str, cols: list[str], digits: int = 6) -> str:
    """Wrap ``sql`` so the listed double columns are rounded like the Spark side."""
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _q"
