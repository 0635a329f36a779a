"""Per-row bar metrics: quality score, validity flag, daily return metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the reference's quality score (must stay equal):
# weights completeness 0.4, consistency 0.4, reasonableness 0.2; valid when score >= 0.8.
W_COMPLETE, W_CONSISTENT, W_REASONABLE = 0.4, 0.4, 0.2
VALID_THRESHOLD = 0.8


def _c(name):
    return F.col(name) if isinstance(name, str) else name


def consistency_checks(o="open", h="high", l="low", c="close") -> list[Column]:
    """The five price relations: high>=low, high>=close, high>=open, low<=close, low<=open."""
    o, h, l, c = map(_c, (o, h, l, c))
    return [h >= l, h >= c, h >= o, l <= c, l <= o]


def reasonableness_checks(o="open", h="high", l="low", c="close", v="volume") -> list[Column]:
    """Positive prices and a non-negative volume."""
    o, h, l, c, v = map(_c, (o, h, l, c, v))
    return [o > 0, h > 0, l > 0, c > 0, v >= 0]


def _share(checks: list[Column]) -> Column:
    total = checks[0].cast("double")
    for ck in checks[1:]:
        total = total + ck.cast("double")
    return total / 5.0


def quality_score(o="open", h="high", l="low", c="close", v="volume") -> Column:
    """0.4 * completeness + 0.4 * consistency share + 0.2 * reasonableness share.

    Completeness is 1.0 because null OHLCV rows are removed before scoring; the
    multiplication order is kept so that scores land exactly on the 0.8 boundary
    the same way in every engine.
    """
    return (F.lit(1.0) * W_COMPLETE + _share(consistency_checks(o, h, l, c)) * W_CONSISTENT
            + _share(reasonableness_checks(o, h, l, c, v)) * W_REASONABLE)


def is_valid(score="quality_score") -> Column:
    return F.when(_c(score) >= VALID_THRESHOLD, F.lit(1)).otherwise(F.lit(0))


def daily_return(o="open", c="close") -> Column:
    """(close - open) / open, NULL when open is 0 (never divides by zero under ANSI)."""
    o, c = _c(o), _c(c)
    return F.when(o != 0, (c - o) / o)


def price_range(h="high", l="low") -> Column:
    return _c(h) - _c(l)


def avg_price(h="high", l="low") -> Column:
    return (_c(h) + _c(l)) / 2.0


def safe_div(num, den) -> Column:
    """Division that yields NULL for a zero/NULL divisor (ANSI-safe ``try_divide``)."""
    return F.try_divide(_c(num), _c(den))
