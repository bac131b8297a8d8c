"""The close as one lazy plan: raw tables in, every processed and reporting table out.

Nothing runs while a ``Close`` is built.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from closeworks.config import DEFAULT_CONFIG, CloseConfig
from closeworks.operators import fx, ledger, metrics, publish, quality
from closeworks.sources import tables


class RawTables:
    """The six raw tables. Each is opened when first used."""

    def __init__(self, opener: Callable[[str], DataFrame]):
        self._open = opener

    @staticmethod
    def read(spark: SparkSession, root: str) -> RawTables:
        return RawTables(lambda name: tables.read_table(spark, root, name))

    @cached_property
    def exchange_rates(self) -> DataFrame:
        return self._open("exchange_rates_raw")

    @cached_property
    def ledger(self) -> DataFrame:
        return self._open("bu_preliminary_close_raw")

    @cached_property
    def cuts(self) -> DataFrame:
        return self._open("accounting_cuts_raw")

    @cached_property
    def segments(self) -> DataFrame:
        return self._open("segmented_files_raw")

    @cached_property
    def forecasts(self) -> DataFrame:
        return self._open("forecast_files_raw")

    @cached_property
    def forecast_fx(self) -> DataFrame:
        return self._open("forecast_fx_raw")


@dataclass
class Close:
    """Close of one ``period``, or of the whole history when ``period`` is None.

    ``fx_period`` stamps the rates. ``published_preliminary`` and ``published_final``
    are earlier results; with them the close of one period reads only that period. ``stored_rates`` are
    processed rates that have been written already; with them raw rates are not processed again to convert amounts.
    """

    raw: RawTables
    fx_period: str
    period: str | None = None
    cfg: CloseConfig = field(default_factory=lambda: DEFAULT_CONFIG)
    fx_order: Sequence[str] = fx.RATE_ORDER
    published_preliminary: DataFrame | None = None
    published_final: DataFrame | None = None
    stored_rates: DataFrame | None = None

    @cached_property
    def exchange_rates(self) -> DataFrame:
        return fx.process_fx(self.raw.exchange_rates, self.fx_period, self.cfg, self.fx_order)

    @cached_property
    def latest_rates(self) -> DataFrame:
        rates = self.exchange_rates if self.stored_rates is None else self.stored_rates
        return fx.latest_rates(rates, self.fx_period, self.fx_order)

    @cached_property
    def ledger(self) -> DataFrame:
        return ledger.process_ledger(self.raw.ledger, self.latest_rates, self.period, self.cfg)

    @cached_property
    def cuts(self) -> DataFrame:
        return ledger.process_cuts(self.raw.cuts, self.latest_rates, self.period, self.cfg)

    @cached_property
    def segments(self) -> DataFrame:
        return ledger.process_segments(self.raw.segments, self.latest_rates, self.period, self.cfg)

    @cached_property
    def forecasts(self) -> DataFrame:
        return ledger.process_forecasts(self.raw.forecasts, self.raw.forecast_fx, self.period, self.cfg)

    @cached_property
    def preliminary_results(self) -> DataFrame:
        return publish.preliminary_results(self.ledger, self.period, self.published_preliminary)

    @cached_property
    def final_results(self) -> DataFrame:
        return publish.final_results(
            self.ledger, self.cuts, self.segments, self.forecasts, self.period, self.published_final, cfg=self.cfg
        )

    @cached_property
    def kpi_metrics(self) -> DataFrame:
        return publish.kpi_metrics(self.final_results, self.period, cfg=self.cfg)

    @property
    def datasets(self) -> dict[str, DataFrame]:
        return {
            "exchange_rates": self.exchange_rates,
            "bu_preliminary_close": self.ledger,
            "accounting_cuts": self.cuts,
            "segmented_files": self.segments,
            "forecast_files": self.forecasts,
        }

    @cached_property
    def data_quality_checks(self) -> DataFrame:
        return quality.dq_scorecard(self.datasets)

    @cached_property
    def executive_summary(self) -> DataFrame:
        return metrics.exec_summary(self.final_results, self.period)
