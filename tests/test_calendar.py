"""Calendar expressions vs an independent pure-Python implementation, 2000-2035."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from barlake.functions import calendar as C
from barlake.operators.calendar_ops import calendar_frame, missing_days


def easter_py(y):
    # Meeus/Jones/Butcher, written independently with divmod
    a = y % 19
    b, c = divmod(y, 100)
    d, e = divmod(b, 4)
    g = (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 19 * l_) // 433
    month = (h + l_ - 7 * m + 90) // 25
    day = (h + l_ - 7 * m + 33 * month + 19) % 32
    return date(y, month, day)


def nth_weekday(y, m, wd, n):
    d = date(y, m, 1)
    d += timedelta(days=(wd - d.weekday()) % 7)
    return d + timedelta(weeks=n - 1)


def last_weekday(y, m, wd):
    d = date(y, m + 1, 1) - timedelta(days=1)
    return d - timedelta(days=(d.weekday() - wd) % 7)


def observed(d):
    return d - timedelta(days=1) if d.weekday() == 5 else d + timedelta(days=1) if d.weekday() == 6 else d


def holidays_py(y):
    ny = date(y, 1, 1)
    ny = date(y, 1, 3) if ny.weekday() == 5 else date(y, 1, 2) if ny.weekday() == 6 else ny
    hs = {ny, nth_weekday(y, 1, 0, 3), nth_weekday(y, 2, 0, 3), easter_py(y) - timedelta(days=2),
          last_weekday(y, 5, 0), observed(date(y, 7, 4)), nth_weekday(y, 9, 0, 1),
          nth_weekday(y, 11, 3, 4), observed(date(y, 12, 25))}
    if y >= 2021:
        hs.add(observed(date(y, 6, 19)))
    return hs


def test_calendar_matches_independent_python(spark):
    cal = calendar_frame(spark, "2000-01-01", "2035-12-31").collect()
    hol = set().union(*[holidays_py(y) for y in range(2000, 2036)])
    assert len(cal) == (date(2035, 12, 31) - date(2000, 1, 1)).days + 1
    for r in cal:
        assert r.is_holiday == (r.date in hol), r.date
        assert r.is_trading_day == (r.date.weekday() < 5 and r.date not in hol), r.date


def test_good_friday(spark):
    rows = spark.range(2000, 2036).select(F.col("id").alias("y"), C.good_friday("id").alias("gf")).collect()
    for r in rows:
        assert r.gf == easter_py(r.y) - timedelta(days=2)


def test_last_trading_day_cases(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 5),), (date(2024, 1, 7),),
                                (date(2024, 1, 8),)], "d date")
    out = {r.d: r.ltd for r in df.select("d", C.last_trading_day("d").alias("ltd")).collect()}
    assert out[date(2024, 1, 1)] == date(2023, 12, 29)
    assert out[date(2024, 1, 5)] == date(2024, 1, 4) and out[date(2024, 1, 5)].weekday() == 3
    assert out[date(2024, 1, 7)].weekday() < 5 and out[date(2024, 1, 8)] == date(2024, 1, 5)


def test_last_trading_day_vs_python(spark):
    hol = set().union(*[holidays_py(y) for y in range(2009, 2026)])

    def ltd(d):
        c = d - timedelta(days=1)
        for _ in range(14):
            if c.weekday() < 5 and c not in hol:
                return c
            c -= timedelta(days=1)
        return c

    cal = calendar_frame(spark, "2010-01-01", "2025-12-31").select("date", C.last_trading_day("date").alias("l"))
    for r in cal.collect():
        assert r.l == ltd(r.date)


def test_target_collection_day(spark):
    df = spark.createDataFrame([(date(2024, 1, 10),)], "d date")
    r = df.select(C.target_collection_day("d").alias("t")).collect()[0]
    # ltd = 2024-01-09 >= today-2 -> trading day before 2024-01-06 -> Friday 2024-01-05
    assert r.t == date(2024, 1, 5)


def test_missing_days_gap_expansion(spark):
    from datetime import datetime
    rows = [("A", datetime(2024, 1, d)) for d in (2, 3, 5, 10)] + [("B", datetime(2024, 1, 4))]
    daily = spark.createDataFrame(rows, "symbol string, trade_date timestamp_ntz")
    got = {(r.symbol, r.expected_date) for r in missing_days(daily, "2024-01-01", "2024-01-12").collect()}
    exp = set()
    for s, present in (("A", {2, 3, 5, 10}), ("B", {4})):
        for d in range(1, 13):
            dd = date(2024, 1, d)
            if dd.weekday() < 5 and d not in present:
                exp.add((s, dd))
    assert got == exp


def test_calendar_join_equals_expressions(spark):
    from barlake.operators.calendar_ops import with_calendar_flags
    days = calendar_frame(spark, "2019-12-01", "2025-01-31").select("date")
    got = with_calendar_flags(days, "date")
    exp = days.select("date", C.is_holiday("date").alias("h"), C.is_trading_day("date").alias("t"),
                      C.last_trading_day("date").alias("l"), C.target_collection_day("date").alias("g"))
    a = {r.date: (r.is_holiday, r.is_trading_day, r.last_trading_day, r.target_day) for r in got.collect()}
    b = {r.date: (r.h, r.t, r.l, r.g) for r in exp.collect()}
    assert a == b


def test_saturday_new_year_flag(spark):
    # 2022-01-01 is a Saturday: the default rule observes Monday 3 Jan, the flag observes nothing
    df = spark.createDataFrame([(date(2022, 1, 3),), (date(2021, 12, 31),)], "d date")
    default = {r.d: r.h for r in df.select("d", C.is_holiday("d").alias("h")).collect()}
    flagged = {r.d: r.h for r in df.select("d", C.is_holiday("d", observe_saturday_new_year=True).alias("h")).collect()}
    assert default == {date(2022, 1, 3): True, date(2021, 12, 31): False}
    assert flagged == {date(2022, 1, 3): False, date(2021, 12, 31): False}
