"""Validation of bar read requests: eagerly for one request's arguments, as a column for a table of requests."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.symbols import DEFAULT_INTERVAL, VALID_INTERVALS


@dataclass(frozen=True)
class BarRequest:
    symbols: tuple[str, ...]
    start: datetime
    end: datetime
    interval: str


def bar_request(symbols: Sequence[str] | str, start: datetime, end: datetime, interval: str = "1d") -> BarRequest:
    """Reject empty symbols / symbol lists and ``start >= end``; unknown intervals become ``1d``."""
    syms = (symbols,) if isinstance(symbols, str) else tuple(symbols)
    if not syms:
        raise ValueError("no symbols given")
    if any(not s or not s.strip() for s in syms):
        raise ValueError("a symbol is blank")
    if start >= end:
        raise ValueError("the request ends before it starts")
    return BarRequest(syms, start, end, interval if interval in VALID_INTERVALS else DEFAULT_INTERVAL)


def request_problem(symbols: Column, start: Column, end: Column) -> Column:
    """What :func:`bar_request` would reject in a row's request, null if nothing.

    ``symbols`` is an array; a null array counts as empty, a null symbol as blank, a missing start or end as a period
    that ends before it starts. The first problem in this order is named.
    """
    blank = lambda s: s.isNull() | ~s.rlike(r"\S")
    return (F.when(F.coalesce(F.size(symbols), F.lit(-1)) <= 0, "no symbols given")
            .when(F.exists(symbols, blank), "a symbol is blank")
            .when(~F.coalesce(start < end, F.lit(False)), "the request ends before it starts"))
