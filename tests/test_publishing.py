"""Datasets scored while they are written, and results from stored balances."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import nodes

from closeworks.operators import distinct, metrics, publish
from closeworks.plans import publishing
from closeworks.plans.close import Close, RawTables
from closeworks.plans.registry import Tables
from closeworks.sources import tables
from closeworks.sources.driver_views import CONFIG, PERIOD

AT = "1997-07-10 00:00:00"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The raw tables of the smallest driver tables, landed; the ledger in three loads."""
    root, source = str(tmp_path_factory.mktemp("store")), Tables(spark, "/root/testdata/sf0.001")
    for name in ("exchange_rates_raw", "accounting_cuts_raw", "segmented_files_raw", "forecast_files_raw", "forecast_fx_raw"):
        raw = source.source.raw_table(name)
        if name == "forecast_fx_raw" and "forecast_date" not in raw.columns:
            raw = raw.withColumn("forecast_date", F.to_date(F.concat("forecast_month", F.lit("-01"))))
        tables.append(tables.stamp(raw, name, AT), root, name)
    ledger = source.raw.ledger.withColumn("load_id", F.concat(F.lit("l"), F.pmod(F.xxhash64("account_code", "local_amount"), F.lit(3)).cast("string")))
    tables.append(tables.stamp(ledger, "bu_preliminary_close_raw", AT), root, "bu_preliminary_close_raw")
    return root


def close_of(spark, root, period=PERIOD, **more):
    return Close(RawTables.read(spark, root), PERIOD, period, CONFIG, **more)


def test_scorecards_come_from_the_write(spark, stored, tmp_path):
    root, close = str(tmp_path), close_of(spark, stored)
    found = publishing.write_processed(close, root, AT)
    assert rows(found) == rows(close.data_quality_checks.select(found.columns)) and found.count() == 5
    for name, df in close.datasets.items():
        written = tables.read_table(spark, root, name)
        kept = [c for c in df.columns if c in written.columns and c != "approved_at"]
        assert rows(written.select(*kept)) == rows(tables.stamp(df, name, AT).select(*kept)), name
    # Nothing is scanned to score: the counts are literal rows.
    assert not [n for n in nodes(found) if "Scan" in n.getClass().getSimpleName() and "File" in n.getClass().getSimpleName()]
    # Again, and for a period without rows.
    assert rows(publishing.write_processed(close, root, AT)) == rows(found)
    old = publishing.write_processed(close_of(spark, stored, "1901-01"), root, AT)
    assert rows(old, "table_name") == [("exchange_rates",), ("forecast_files",)]  # rates and forecasts go with any close
    with pytest.raises(ValueError, match="period"):
        publishing.write_processed(close_of(spark, stored, None), root, AT)


def test_a_period_that_becomes_empty_is_cleared(spark, stored, tmp_path):
    root, close = str(tmp_path), close_of(spark, stored)
    ledger = tables.stamp(close.ledger, "bu_preliminary_close", AT)
    invalid = F.count_if(~F.col("is_validated"))
    found = tables.replace_period_counted(ledger, root, "bu_preliminary_close", PERIOD, bad=invalid)
    assert found == {"rows": close.ledger.count(), "bad": close.ledger.filter("NOT is_validated").count()}
    assert tables.replace_period_counted(ledger.limit(0), root, "bu_preliminary_close", PERIOD, bad=invalid) == {"rows": 0, "bad": 0}
    assert tables.read_table(spark, root, "bu_preliminary_close").count() == 0


def test_results_from_balances_equal_those_from_lines(spark, stored, tmp_path):
    """Load after load, the results are those of a full run over the loads so far; only the new load is read."""
    root, loads = str(tmp_path), []
    whole = RawTables.read(spark, stored)
    rates = close_of(spark, stored).latest_rates
    for load in ("l0", "l2", "l1"):
        loads.append(load)
        publishing.add_load(whole.ledger, rates, root, load, CONFIG)
        if load == "l2":
            publishing.add_load(whole.ledger, rates, root, load, CONFIG)  # a run that is done again adds nothing
        so_far = RawTables(lambda name, n=tuple(loads): tables.read_table(spark, stored, name).filter(F.col("load_id").isin(*n)) if name == "bu_preliminary_close_raw" else tables.read_table(spark, stored, name))
        for period in (PERIOD, None):
            full = Close(so_far, PERIOD, period, CONFIG)
            assert rows(publishing.preliminary_from_balances(spark, root, period)) == rows(full.preliminary_results)
    close = close_of(spark, stored)
    assert rows(publishing.final_from_balances(close, root)) == rows(close.final_results)
    final = publishing.final_from_balances(close_of(spark, stored, None), root)
    assert rows(final) == rows(close_of(spark, stored, None).final_results)
    read = [n.relation().location().rootPaths().head().toString() for n in nodes(final) if n.getClass().getSimpleName() == "FileSourceScanExec"]
    assert any("ledger_balances" in p for p in read) and not any("bu_preliminary_close_raw" in p for p in read)
    versions = publish.preliminary_results(close.ledger, PERIOD).limit(3)
    again = publishing.preliminary_from_balances(spark, root, PERIOD, versions)
    assert rows(again) == rows(publish.preliminary_results(close.ledger, PERIOD, versions))
    sizes = publishing.stored_balances(spark, root).agg(F.count("*"), F.sum("_lines")).first()
    assert sizes[0] < sizes[1]


def test_balances_of_nothing(spark, stored, tmp_path):
    rates = close_of(spark, stored).latest_rates
    publishing.add_load(RawTables.read(spark, stored).ledger, rates, str(tmp_path), "no such load", CONFIG)
    assert publishing.preliminary_from_balances(spark, str(tmp_path)).count() == 0


def test_distinct_counts_add_up_over_periods(spark, stored, tmp_path):
    """Period after period the stored parts give the reports over all of them; a period added twice counts once."""
    root, close = str(tmp_path), close_of(spark, stored, None)
    segments = close.segments.withColumn("segment_value", F.when(F.col("segment_value") != "", F.col("segment_value")))
    periods = sorted(r[0] for r in segments.select("closure_period").distinct().collect() if r[0])[:3]
    for i, period in enumerate([*periods, periods[0]]):
        publishing.add_segments(segments, root, period)
        so_far = segments.filter(F.col("closure_period").isin(periods[: i + 1]))
        sums, sets = publishing.segment_parts(spark, root)
        if i in (1, 3):
            assert rows(distinct.segments_by_type(sums, sets)) == rows(metrics.segments_by_type(so_far).select(distinct.segments_by_type(sums, sets).columns))
            assert rows(distinct.segments_by_bu(sums, sets)) == rows(metrics.segments_by_bu(so_far).select(distinct.segments_by_bu(sums, sets).columns))
    codes = publishing.dictionary(spark, root, "account_code").collect()
    assert len({r.value for r in codes}) == len({r.code for r in codes}) == len(codes)
    read = [n for n in nodes(distinct.segments_by_type(sums, sets)) if n.getClass().getSimpleName() == "FileSourceScanExec"]
    assert all("segment_s" in n.relation().location().rootPaths().head().toString() for n in read) and read


def test_codes_stay_and_are_dense(spark):
    values = lambda a, b: spark.range(a, b).selectExpr("concat('v', id) AS value")
    none = spark.createDataFrame([], "value string, code long")
    first = distinct.new_codes(values(0, 40_000).unionByName(values(0, 100)), none).cache()
    more = distinct.new_codes(values(39_000, 70_000), first)
    both = first.unionByName(more)
    found = both.agg(F.count("*"), F.countDistinct("value"), F.countDistinct("code"), F.min("code"), F.max("code")).first()
    assert found[:3] == (70_000, 70_000, 70_000) and found[3] >= 1 and found[4] < 1.4 * 70_000
    rows_ = values(0, 70_000).selectExpr("value", "if(value LIKE '%7', 'a', NULL) AS g")
    sets = distinct.value_sets(rows_, ["g"], "value", both)
    assert rows(distinct.count_values(sets, ["g"], "value", "n")) == rows(rows_.groupBy("g").agg(F.countDistinct("value").alias("n")))
    halves = distinct.value_sets(rows_.withColumn("p", F.hash("value") % 2), ["p", "g"], "value", both)
    assert rows(distinct.count_values(halves, ["g"], "value", "n")) == rows(distinct.count_values(sets, ["g"], "value", "n"))
