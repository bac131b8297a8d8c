"""A close written step by step: datasets with their checks from one pass, and results from stored balances."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closeworks.config import DEFAULT_CONFIG, CloseConfig
from closeworks.operators import distinct, ledger, publish, quality
from closeworks.plans.close import Close
from closeworks.sources import files, tables

# --- datasets and their checks ----------------------------------------------


def write_processed(close: Close, root: str, at: str) -> DataFrame:
    """Write the processed datasets of the period of ``close`` and return their scorecards.

    Rows and invalid rows are counted by the tasks that write them, so no dataset is processed or scanned again to be
    scored; the scorecards equal ``close.data_quality_checks``. Amounts are converted by the rates just written.
    """
    if close.period is None:
        raise ValueError("datasets are written one period at a time")
    spark, checks = close.raw.ledger.sparkSession, None
    for name in quality.SCORECARDS:
        period = close.fx_period if name == "exchange_rates" else close.period
        df = tables.stamp(close.datasets[name], name, at)
        found = tables.replace_period_counted(df, root, name, period, failed=F.count_if(~F.col("is_validated")))
        counts = [(period, found["rows"], found["failed"])] if found["rows"] else []
        layout = "closure_period string, records_checked long, records_failed long"
        card = quality.scored(spark.createDataFrame(counts, layout), quality.SCORECARDS[name])
        checks = card if checks is None else checks.unionByName(card)
        if name == "exchange_rates":
            close = replace(close, stored_rates=tables.read_table(spark, root, name))
    return checks


# --- balances ---------------------------------------------------------------

BALANCES = "ledger_balances"


def balances_path(root: str) -> str:
    return f"{root.rstrip('/')}/processed/{BALANCES}"


def stored_balances(spark: SparkSession, root: str) -> DataFrame:
    """Balances of all loads: a row per balance and load."""
    layout = ", ".join(f"{c} string" for c in publish.BALANCE) + ", load_id string, _amount decimal(38,0), _lines long"
    return spark.read.schema(layout).parquet(balances_path(root))


def add_load(
    raw_lines: DataFrame, rates: DataFrame, root: str, load_id: str, cfg: CloseConfig = DEFAULT_CONFIG
) -> None:
    """Add the balances of the ledger lines of one load; adding a load again replaces what it gave before.

    Only the lines of the load are read. Their amounts are converted by ``rates`` as they are now: when the rate
    of a period changes, its loads are added again.
    """
    lines = raw_lines.filter(F.col("load_id") == load_id)
    processed = ledger.process_ledger(lines, rates, cfg=cfg, keep=("load_id",))
    files.append_once(publish.account_balances(processed, more=("load_id",)), balances_path(root), f"load-{load_id}")


def preliminary_from_balances(
    spark: SparkSession, root: str, period: str | None = None, published: DataFrame | None = None
) -> DataFrame:
    """Preliminary results as ``publish.preliminary_results`` gives them, without a look at the ledger lines."""
    balances = stored_balances(spark, root)
    if period is not None:
        balances = balances.filter(F.col("closure_period") == period)
    return publish.preliminary_of_balances(balances, published)


def final_from_balances(close: Close, root: str) -> DataFrame:
    """Final results of ``close``, without a look at the ledger lines."""
    spark = close.raw.cuts.sparkSession
    return publish.final_results(
        close.raw.ledger, close.cuts, close.segments, close.forecasts, close.period, close.published_final,
        cfg=close.cfg, balances=stored_balances(spark, root),
    )


# --- segments ---------------------------------------------------------------

SEGMENT_COLUMNS = ("segment_value", "account_code")


def _segment_path(root: str, part: str) -> str:
    return f"{root.rstrip('/')}/processed/segment_{part}"


def _stored(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """A table of this module, or no rows where nothing has been written to it."""
    files.recover(spark, path)
    return spark.read.schema(layout).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], layout)


def dictionary(spark: SparkSession, root: str, column: str) -> DataFrame:
    return _stored(spark, _segment_path(root, f"codes_{column}"), "value string, code long")


def segment_parts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Sums and sets of all periods that were added."""
    keys = ", ".join(f"{k} string" for k in distinct.SEGMENT_KEYS)
    sums = _stored(spark, _segment_path(root, "sums"), f"{keys}, _rows long, _amounts long, _sum decimal(38,0)")
    sets = _stored(spark, _segment_path(root, "sets"), f"{keys}, column_name string, bucket long, bits binary")
    return sums, sets


def add_segments(segments: DataFrame, root: str, period: str) -> None:
    """Add the processed segments of one period to the stored sums and sets; adding it again replaces what it gave before.

    Values that are new get their codes first and keep them, also if the run is lost after that.
    """
    spark, rows = segments.sparkSession, segments.filter((F.col("closure_period") == period) & F.col("is_validated"))
    sets = None
    for column in SEGMENT_COLUMNS:
        known = dictionary(spark, root, column)
        fresh = distinct.new_codes(rows.select(F.col(column).cast("string").alias("value")), known)
        # A tag of its own, so that codes are never replaced: they are what the sets are made of.
        files.append_once(fresh, _segment_path(root, f"codes_{column}"), f"codes-{uuid.uuid4().hex}")
        part = distinct.value_sets(rows, distinct.SEGMENT_KEYS, column, dictionary(spark, root, column))
        sets = part if sets is None else sets.unionByName(part)
    files.append_once(distinct.segment_sums(rows), _segment_path(root, "sums"), f"period-{period}")
    files.append_once(sets, _segment_path(root, "sets"), f"period-{period}")
