"""The declarative layer graph bronze -> silver -> daily -> analytics.

A layer is a named ``DataFrame -> DataFrame`` function with drop/warn
expectations; ``MedallionGraph.read(name)`` composes the lazy plan of a layer from
its inputs (each layer built once per graph). This is plain function composition:
Spark plans and schedules the result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators.clean import (BRONZE_DROP_EXPECTATIONS, DAILY_WARN_EXPECTATIONS,
                               SILVER_WARN_EXPECTATIONS, clean_bronze_to_silver, expect_or_drop,
                               expectations)
from ..operators.daily import daily_ohlcv
from ..operators.indicators import indicators
from ..operators.quality import expectation_counts
from ..session import checkpoint_dir


@dataclass
class Layer:
    name: str
    fn: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    expect_or_drop: dict[str, str] = field(default_factory=dict)
    expect: dict[str, str] = field(default_factory=dict)


class MedallionGraph:
    """``cut_lineage=True`` checkpoints every built layer into the session's
    ``spark.checkpoint.dir`` (the cluster's shared folder), so a lost executor
    late in a long pipeline recomputes from the last layer, not from the raw files."""

    def __init__(self, sources: dict[str, DataFrame], layers: list[Layer], cut_lineage: bool = False):
        self.sources = dict(sources)
        self.layers = {lay.name: lay for lay in layers}
        self.cut_lineage = cut_lineage
        self._built: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name in self.sources:
            return self.sources[name]
        if name not in self._built:
            lay = self.layers[name]
            df = lay.fn(*[self.read(i) for i in lay.inputs])
            if lay.expect_or_drop:
                df = expect_or_drop(df, expectations(lay.expect_or_drop))
            if self.cut_lineage:
                checkpoint_dir(df.sparkSession)
                df = df.checkpoint(eager=True)
            self._built[name] = df
        return self._built[name]

    def expectation_report(self) -> DataFrame:
        """Passed/failed counts of every layer's expectations (drop ones on the layer input)."""
        parts = []
        for lay in self.layers.values():
            if lay.expect_or_drop:
                parts.append(expectation_counts(lay.fn(*[self.read(i) for i in lay.inputs]),
                                                lay.name, lay.expect_or_drop))
            if lay.expect:
                parts.append(expectation_counts(self.read(lay.name), lay.name, lay.expect))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def market_graph(raw_bronze: DataFrame, run_ts=None, cut_lineage: bool = False) -> MedallionGraph:
    """The reference pipeline's four layers with their expectations."""
    return MedallionGraph({"landing": raw_bronze}, cut_lineage=cut_lineage, layers=[
        Layer("bronze_bars", lambda r: r, ("landing",), expect_or_drop=BRONZE_DROP_EXPECTATIONS),
        Layer("silver_bars", lambda b: clean_bronze_to_silver(b, run_ts), ("bronze_bars",),
              expect=SILVER_WARN_EXPECTATIONS),
        Layer("gold_daily_ohlcv", lambda s: daily_ohlcv(s, run_ts), ("silver_bars",),
              expect=DAILY_WARN_EXPECTATIONS),
        Layer("gold_analytics", lambda d: indicators(d, run_ts), ("gold_daily_ohlcv",)),
    ])
