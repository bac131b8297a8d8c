import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from closeworks import schemas
from closeworks.config import account_dim, segment_dim
from closeworks.operators import controls
from closeworks.plans.close import Close, RawTables
from closeworks.sources import status, tables

JAN, FEB = "2024-01", "2024-02"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


@pytest.fixture
def results(spark):
    ddl = "closure_period string, bu_code string, final_amount double, is_final boolean"

    def make(*data):
        return tables.stamp(spark.createDataFrame(list(data), ddl), "final_results", "2024-03-01 00:00:00")

    return make


def test_every_table_has_a_layout(spark):
    assert len(schemas.LAYER) == 26
    assert {layer for layer in schemas.LAYER.values()} == {"raw", "processed", "reporting", "audit"}
    for name in schemas.LAYER:
        assert len(schemas.schema(name).fields) >= 6
    assert len(schemas.schema("final_results").fields) == 26
    assert not schemas.is_partitioned("exchange_rates_raw") and schemas.is_partitioned("exchange_rates")


def test_create_list_and_append(spark, root, results):
    created = tables.ensure_tables(spark, root)
    assert set(created) == set(schemas.LAYER)
    assert tables.ensure_tables(spark, root) == []
    tables.append(results((JAN, "NA", 1.0, True)), root, "final_results")
    tables.append(results((JAN, "NA", 2.0, True)), root, "final_results")
    found = {r.table_name: (r.is_created, r.has_rows) for r in tables.table_summary(spark, root).collect()}
    assert found["final_results"] == (True, True) and found["kpi_metrics"] == (True, False)
    assert tables.read_table(spark, root, "final_results").count() == 2
    assert tables.read_table(spark, root, "final_results").columns == schemas.schema("final_results").fieldNames()


def test_replacing_a_period_twice_equals_once(spark, root, results):
    tables.append(results((JAN, "NA", 1.0, True), (FEB, "NA", 5.0, True)), root, "final_results")
    again = results((FEB, "NA", 6.0, True), (FEB, "EMEA", 7.0, True))
    for _ in range(2):
        tables.replace_periods(again, root, "final_results")
        found = rows(tables.read_table(spark, root, "final_results"), "closure_period", "bu_code", "final_amount")
        assert found == [(JAN, "NA", 1.0), (FEB, "EMEA", 7.0), (FEB, "NA", 6.0)]


def test_overwrite_replaces_rows_and_columns(spark, root, results):
    tables.append(results((JAN, "NA", 1.0, True)), root, "final_results")
    tables.overwrite(results((FEB, "NA", 2.0, True)).withColumn("extra", F.lit(1)), root, "final_results")
    stored = spark.read.parquet(tables.table_path(root, "final_results"))
    assert stored.count() == 1 and "extra" in stored.columns


def test_a_period_filter_reads_that_partition_only(spark, root, results):
    tables.append(results((JAN, "NA", 1.0, True), (FEB, "NA", 5.0, True)), root, "final_results")
    df = tables.read_table(spark, root, "final_results").filter(F.col("closure_period") == JAN).select("final_amount")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(closure_period" in plan
    assert "ReadSchema: struct<final_amount:double>" in plan


def test_rewrite_of_a_table_from_itself(spark, root):
    first = tables.audit_rows(
        spark,
        [
            {"approval_id": "1", "closure_period": JAN, "phase": 4, "approval_type": "BU_SIGNOFF", "status": "PENDING", "comments": "c"},
            {"approval_id": "2", "closure_period": FEB, "phase": 4, "approval_type": "BU_SIGNOFF", "status": "PENDING", "comments": "c"},
        ],
        "approvals",
    )
    tables.append(first, root, "approvals")
    stored = tables.read_table(spark, root, "approvals").filter(F.col("closure_period") == JAN)
    tables.rewrite(controls.approve_pending(stored, "2024-02-01 00:00:00", JAN), root, "approvals")
    assert rows(tables.read_table(spark, root, "approvals"), "approval_id", "status") == [("1", "APPROVED"), ("2", "PENDING")]


def test_checkpoint_folder_comes_from_the_session(spark, tmp_path, monkeypatch):
    calls = []

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, path):
            calls.append(path)

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, name, default):
            assert name == "spark.checkpoint.dir"
            return self.value or default

    class Session:
        def __init__(self, value):
            self.conf, self.sparkContext = Conf(value), Context()

    tables.use_checkpoint_dir(Session("hdfs:///shared"))
    assert calls == ["hdfs:///shared"]
    with pytest.raises(RuntimeError):
        tables.use_checkpoint_dir(Session(None))


def test_csv_landing(spark, root, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    head = "currency,rate,rate_date,source\n"
    (folder / "a.csv").write_text(head + "EUR,0.92,2024-01-02,ECB\nGBP,none,2024-01-02,ECB\n")
    (folder / "b.csv").write_text(head + "SGD,1.34,2024-01-03,\n")
    got = tables.ingest_csv(spark, f"{folder}/*.csv", "exchange_rates_raw", "load-1", "2024-01-04 00:00:00")
    assert got.columns == schemas.schema("exchange_rates_raw").fieldNames()
    assert rows(got, "currency", "rate", "rate_date") == [
        ("EUR", 0.92, dt.date(2024, 1, 2)), ("GBP", None, dt.date(2024, 1, 2)), ("SGD", 1.34, dt.date(2024, 1, 3)),
    ]
    assert {r.load_id for r in got.collect()} == {"load-1"}
    assert sorted({r.file_name.rsplit("/", 1)[1] for r in got.collect()}) == ["a.csv", "b.csv"]


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("currency,rate_date,rate,source\nEUR,2024-01-02,0.92,ECB\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.ingest_csv(spark, str(tmp_path / "a.csv"), "exchange_rates_raw").collect()


def test_row_ids(frame):
    df = frame("a string, b int", ("x", 1), ("x", None), (None, 1))
    by_key = df.select(tables.row_id(["a", "b"]).alias("id"))
    assert len({r.id for r in by_key.collect()}) == 3
    assert rows(by_key) == rows(df.select(tables.row_id(["a", "b"]).alias("id")))
    assert len({r.id for r in df.select(tables.row_id().alias("id")).collect()}) == 3


def test_stamp_brings_a_frame_to_its_layout(frame):
    got = tables.stamp(frame("closure_period string, phase bigint", (JAN, 1)), "notifications", "2024-01-01 00:00:00")
    assert got.schema.simpleString() == schemas.schema("notifications").simpleString()
    row = got.collect()[0]
    assert row.notification_id and row.sent_at is not None and row.acknowledged_at is None and row.phase == 1


def test_views_can_be_registered(spark, frame):
    tables.register_views({"my_rates": frame("a int", (1,))})
    assert spark.sql("SELECT a FROM my_rates").collect()[0].a == 1


def test_status_rows(spark, root):
    start = status.initialized(spark, JAN, "2024-02-01 00:00:00")
    done = status.phase_update(spark, JAN, 2, "COMPLETED", "2024-02-02 00:00:00")
    failed = status.phase_update(spark, JAN, 3, "FAILED", "2024-02-02 00:00:00")
    prelim = status.preliminary_published(spark, JAN, 2, "2024-02-02 00:00:00")
    final = status.completed(spark, JAN, "2024-02-03 00:00:00")
    for df in (start, done, failed, prelim, final):
        tables.append(df, root, "closure_status")
    found = {(r.current_phase, r.phase_status): r for r in tables.read_table(spark, root, "closure_status").collect()}
    assert found[1, "INITIALIZED"].expected_completion == dt.datetime(2024, 2, 8)
    assert found[2, "COMPLETED"].expected_completion == dt.datetime(2024, 2, 4)
    assert found[2, "COMPLETED"].actual_completion is not None and found[3, "FAILED"].actual_completion is None
    assert found[2, "PRELIMINARY_PUBLISHED"].notes == "Preliminary results published - Version 2"
    assert found[5, "COMPLETED"].actual_completion is not None


def test_configured_dimensions(spark):
    assert segment_dim(spark).count() == 16
    assert account_dim(spark).filter("account_group = 'cogs'").count() == 3


def test_a_whole_close_from_landed_files(spark, root, tmp_path):
    """CSV in, two closes published, second month compared with the first."""
    folder = tmp_path / "in"
    folder.mkdir()

    def land(name, text):
        (folder / f"{name}.csv").write_text(text)
        tables.append(tables.ingest_csv(spark, str(folder / f"{name}.csv"), name, "l1", "2024-03-01 00:00:00"), root, name)

    land("exchange_rates_raw", "currency,rate,rate_date,source\nEUR,0.5,2024-02-27,ECB\nEUR,0.51,2024-02-28,ECB\n")
    land(
        "bu_preliminary_close_raw",
        "bu_code,account_code,account_description,local_currency,local_amount,period,cost_center\n"
        f"NA,4000,Sales,USD,100,{JAN},c\nNA,4000,Sales,USD,120,{FEB},c\nEMEA,5000,Cost,EUR,-51,{FEB},c\n"
        f"INVALID,9999,,EUR,1,{FEB},c\n",
    )
    land(
        "accounting_cuts_raw",
        "cut_number,bu_code,account_code,adjustment_type,adjustment_amount,currency,description,period\n"
        f"1,NA,4000,Accrual,5,USD,x,{FEB}\n",
    )
    land(
        "segmented_files_raw",
        "bu_code,account_code,segment_type,segment_value,amount,currency,period\n"
        f"NA,4000,Product,Software,120,USD,{FEB}\n",
    )
    land(
        "forecast_files_raw",
        "bu_code,account_code,forecast_period,forecast_amount,currency,forecast_type,version\n"
        f"NA,4000,{FEB},130,USD,Rolling12,v1.0\n",
    )
    land("forecast_fx_raw", f"currency,forecast_date,forecast_rate,source\nEUR,{FEB}-01,0.5,T\n")

    for period in (JAN, FEB):
        close = Close(
            RawTables.read(spark, root),
            period,
            period,
            published_preliminary=tables.read_table(spark, root, "preliminary_results") if period == FEB else None,
            published_final=tables.read_table(spark, root, "final_results") if period == FEB else None,
        )
        at = "2024-03-02 00:00:00"
        tables.replace_periods(tables.stamp(close.ledger, "bu_preliminary_close", at), root, "bu_preliminary_close")
        tables.append(tables.stamp(close.preliminary_results, "preliminary_results", at), root, "preliminary_results")
        tables.replace_periods(tables.stamp(close.final_results, "final_results", at), root, "final_results")
        tables.append(tables.stamp(close.kpi_metrics, "kpi_metrics", at), root, "kpi_metrics")
        tables.append(tables.stamp(close.data_quality_checks, "data_quality_checks", at), root, "data_quality_checks")

    final = {(r.closure_period, r.bu_code): r for r in tables.read_table(spark, root, "final_results").collect()}
    assert set(final) == {(JAN, "NA"), (FEB, "NA"), (FEB, "EMEA")}
    assert final[FEB, "NA"].final_amount == 125.0 and final[FEB, "NA"].yoy_variance == 25.0
    assert final[FEB, "NA"].segment_product == "Software" and final[FEB, "NA"].forecast_variance == -5.0
    assert final[FEB, "EMEA"].final_amount == -100.0
    checks = {(r.closure_period, r.table_name): r for r in tables.read_table(spark, root, "data_quality_checks").collect()}
    assert checks[FEB, "bu_preliminary_close"].check_result == "FAILED"
    assert checks[JAN, "bu_preliminary_close"].check_result == "PASSED"


def test_publishing_nothing_leaves_nothing(spark, tmp_path):
    root, name = str(tmp_path), "kpi_metrics"
    rows = [{"closure_period": p, "kpi_name": k} for p in ("2024-01", "2024-02") for k in ("a", "b")]
    df = tables.stamp(tables.audit_rows(spark, rows, name), name, "2024-02-01 00:00:00")
    for _ in range(2):
        tables.replace_periods(df, root, name)
        assert tables.read_table(spark, root, name).count() == 4
    tables.replace_periods(df, root, name, "2024-01")
    assert tables.read_table(spark, root, name).count() == 4
    for _ in range(2):
        tables.replace_periods(df.limit(0), root, name, "2024-01")
        assert [r.closure_period for r in tables.read_table(spark, root, name).collect()] == ["2024-02"] * 2


def test_files_per_period_are_bounded(spark, tmp_path):
    root, name = str(tmp_path), "kpi_metrics"
    rows = [{"closure_period": f"2024-0{i % 4 + 1}", "kpi_name": str(i)} for i in range(400)]
    df = tables.stamp(tables.audit_rows(spark, rows, name), name, "2024-02-01 00:00:00").repartition(16)
    tables.append(df, root, name)
    files = list(tmp_path.rglob("*.parquet"))
    assert len({f.parent.name for f in files}) == 4 and len(files) <= 8


def test_lines_that_cannot_be_read_are_kept(spark, tmp_path):
    given = [f for f in schemas.schema("exchange_rates_raw").fieldNames() if f not in ("load_id", "loaded_at", "file_name")]
    good = {"currency": "EUR", "rate": "0.9", "rate_date": "2024-01-01", "source": "ECB"}
    line = lambda **c: ",".join((good | c).get(g, "") for g in given)
    bad = [line(rate="x9"), line() + ",surplus"]
    (tmp_path / "a.csv").write_text("\n".join([",".join(given), line(), *bad]) + "\n")
    rejected = tables.rejected_csv(spark, str(tmp_path), "exchange_rates_raw", "l1", "2024-01-02 00:00:00").collect()
    assert sorted(r.rejected_record for r in rejected) == sorted(bad)
    assert tables.ingest_csv(spark, str(tmp_path), "exchange_rates_raw", "l1").count() == 3
