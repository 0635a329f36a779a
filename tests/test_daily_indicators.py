"""Daily roll-up and rolling indicators (reference unit cases) plus plan shape."""

from datetime import datetime, timedelta

from barlake.operators.daily import daily_ohlcv
from barlake.operators.indicators import indicators, with_indicators
from barlake.schemas import GOLD_DAILY_OHLCV_SCHEMA, SILVER_BARS_SCHEMA

RUN = "2024-01-03 00:00:00"
P = datetime(2024, 1, 2, 0, 0)


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER_BARS_SCHEMA)


def test_daily_ohlcv_exact(spark):
    d = datetime(2024, 1, 2)
    rows = [("AAPL", d.replace(hour=10), 150.0, 152.0, 149.0, 151.0, 1000000, P, 1, 1.0),
            ("AAPL", d.replace(hour=11), 151.0, 154.0, 150.0, 152.0, 1200000, P, 1, 1.0),
            ("AAPL", d.replace(hour=12), 152.0, 153.0, 151.0, 153.0, 1100000, P, 1, 1.0),
            ("MSFT", d.replace(hour=10), 370.0, 372.0, 369.0, 371.0, 900000, P, 1, 1.0)]
    out = {r.symbol: r for r in daily_ohlcv(silver(spark, rows), RUN).collect()}
    a = out["AAPL"]
    assert (a.open, a.high, a.low, a.close, a.volume, a.num_bars) == (150.0, 154.0, 149.0, 153.0, 3300000, 3)
    assert a.price_range == 5.0 and a.avg_price == 151.5
    assert abs(a.daily_return - (153.0 - 150.0) / 150.0) < 1e-12
    assert a.trade_date == d


def test_daily_filters_invalid(spark):
    d = datetime(2024, 1, 2)
    rows = [("AAPL", d.replace(hour=10), 150.0, 152.0, 149.0, 151.0, 100, P, 1, 1.0),
            ("AAPL", d.replace(hour=11), 151.0, 140.0, 150.0, 152.0, 100, P, 0, 0.72)]
    out = daily_ohlcv(silver(spark, rows), RUN).collect()
    assert len(out) == 1 and out[0].num_bars == 1


def daily10(spark):
    rows = []
    for i in range(10):
        c = 100.0 + 0.5 * i
        rows.append(("AAPL", datetime(2024, 1, 1) + timedelta(days=i), c, c + 1, c - 1, c, 1000, 1,
                     0.0, 2.0, c, P))
    return spark.createDataFrame(rows, GOLD_DAILY_OHLCV_SCHEMA)


def test_indicators_rows_and_columns(spark):
    out = indicators(daily10(spark), RUN).orderBy("trade_date").collect()
    assert len(out) == 10
    assert [f for f in out[0].asDict()] == ["symbol", "trade_date", "sma_5", "sma_20", "sma_50", "volatility",
                                            "updated_timestamp"]
    assert all(r.sma_5 is not None for r in out[4:])
    assert out[4].sma_5 == sum(100.0 + 0.5 * i for i in range(5)) / 5


def test_indicators_min_periods(spark):
    out = indicators(daily10(spark), RUN, min_periods=5).orderBy("trade_date").collect()
    assert out[3].sma_5 is None and out[4].sma_5 is not None


def test_indicators_single_window_single_sort(spark):
    plan = with_indicators(daily10(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 or plan.count("Window ") >= 1
    assert plan.count("Sort [") == 1
