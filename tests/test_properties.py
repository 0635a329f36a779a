"""Property tests: daily roll-up invariants on randomly generated consistent bars."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barlake.operators.clean import clean_bronze_to_silver
from barlake.operators.daily import daily_ohlcv
from barlake.schemas import BRONZE_BARS_SCHEMA

bar = st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 4 * 24 - 1),
                st.floats(1.0, 500.0), st.floats(0.0, 5.0), st.floats(0.0, 5.0),
                st.floats(0.0, 1.0), st.floats(0.0, 1.0), st.integers(0, 10_000))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(bar, min_size=1, max_size=60))
def test_daily_rollup_invariants(spark, bars):
    rows = []
    for sym, hour, base, up, down, fo, fc, vol in bars:
        low, high = base - down * 0.1, base + up
        o, c = low + fo * (high - low), low + fc * (high - low)
        ts = datetime(2024, 1, 1) + timedelta(hours=hour)
        rows.append((sym, ts, o, high, low, c, vol, datetime(2024, 2, 1), "b"))
    silver = clean_bronze_to_silver(spark.createDataFrame(rows, BRONZE_BARS_SCHEMA), "2024-02-02 00:00:00")
    s_rows = silver.collect()
    assert all(r.is_valid == 1 and r.quality_score == 1.0 for r in s_rows)
    daily = daily_ohlcv(silver, "2024-02-02 00:00:00").collect()
    for d in daily:
        assert d.low <= min(d.open, d.close) and max(d.open, d.close) <= d.high
        assert d.price_range >= 0
    assert sum(d.num_bars for d in daily) == len(s_rows)
    assert sum(d.volume for d in daily) == sum(r.volume for r in s_rows)
