"""Symbol and request-parameter predicates as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must stay equal to the reference): symbols are 1-5 characters of
# upper-case letters, digits and dots, with at least one letter and no leading or
# trailing dot. Letters and digits follow Unicode categories (Lu, N) as the
# reference's str.isalnum/isupper checks do.
SYMBOL_CHARS = r"^[\p{Lu}\p{N}.]{1,5}$"
SYMBOL_LETTER = r"\p{Lu}"

# The provider's accepted bar intervals; anything else falls back to "1d".
VALID_INTERVALS = ["1m", "2m", "5m", "15m", "30m", "60m", "90m", "1h",
                   "1d", "5d", "1wk", "1mo", "3mo"]
DEFAULT_INTERVAL = "1d"


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def is_valid_symbol(s) -> Column:
    """Null-safe symbol predicate (NULL or '' -> False)."""
    s = _c(s)
    ok = (s.rlike(SYMBOL_CHARS) & s.rlike(SYMBOL_LETTER)
          & ~s.startswith(".") & ~s.endswith("."))
    return F.coalesce(ok, F.lit(False))


def normalize_interval(interval) -> Column:
    i = _c(interval)
    return F.when(i.isin(VALID_INTERVALS), i).otherwise(F.lit(DEFAULT_INTERVAL))
