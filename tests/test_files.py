"""Layout and change of stored files, and incremental landing."""

import random
from collections import Counter
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import nodes

from closeworks.functions import ranks
from closeworks.operators import controls
from closeworks.sources import files, landing, status, tables

JAN, FEB = "2024-01", "2024-02"
HEAD = "currency,rate,rate_date,source\n"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


def kpis(spark, *items, period=JAN):
    data = [{"closure_period": period, "metric_name": n, "metric_value": float(v)} for n, v in items]
    return tables.stamp(tables.audit_rows(spark, data, "kpi_metrics"), "kpi_metrics", "2024-02-01 00:00:00")


def names(root, name="kpi_metrics"):
    return {p.relative_to(root).as_posix() for p in Path(root).rglob("*.parquet") if name in p.parts and "_swap-" not in str(p)}


def scanned(df):
    """Rows that the scan of files gave to the plan: those of row groups that statistics did not rule out."""
    df.collect()
    return sum(n.metrics().apply("numOutputRows").value() for n in nodes(df) if n.getClass().getSimpleName() == "FileSourceScanExec")


# --- layout -----------------------------------------------------------------


def rates(spark, n=6400):
    return tables.stamp(
        spark.range(n).selectExpr(
            "concat('C', lpad(cast(id % 40 AS string), 2, '0')) AS currency",
            "date_add(date'2024-01-01', cast(id DIV 40 % 160 AS int)) AS rate_date",
            "cast(id AS double) AS rate",
            f"'{JAN}' AS closure_period",
        ),
        "exchange_rates",
        "2024-02-01 00:00:00",
    )


def test_either_key_reads_a_small_share_of_the_files(spark, root):
    """With 16 files along the curve each key alone meets about a quarter of them; sorted by both keys, the second meets all."""
    df = rates(spark)
    tables.write_clustered(df, root, "exchange_rates", files=16)
    stored = tables.read_table(spark, root, "exchange_rates")
    assert rows(stored.drop("rate_id")) == rows(df.drop("rate_id"))
    assert len(files.list_files(spark, tables.table_path(root, "exchange_rates"))) == 16
    by_currency = scanned(stored.filter("currency = 'C07'").select("rate"))
    by_day = scanned(stored.filter("rate_date = date'2024-03-01'").select("rate"))
    assert by_currency <= 0.45 * 6400 and by_day <= 0.45 * 6400
    linear = df.repartitionByRange(16, "currency", "rate_date").sortWithinPartitions("currency", "rate_date")
    linear.write.parquet(f"{root}/linear")
    assert scanned(spark.read.parquet(f"{root}/linear").filter("rate_date = date'2024-03-01'").select("rate")) == 6400


def test_a_hot_key_and_nulls_are_spread_along_the_curve(spark, root):
    """Half of all rows in one currency, some without: the second key splits them."""
    df = rates(spark, 4000).withColumn("currency", F.expr("CASE WHEN rate % 2 = 0 THEN 'EUR' WHEN rate % 10 = 1 THEN NULL ELSE currency END"))
    tables.write_clustered(df, root, "exchange_rates", files=8)
    stored = tables.read_table(spark, root, "exchange_rates")
    assert stored.count() == 4000
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * min(sizes)
    assert scanned(stored.filter("currency = 'EUR' AND rate_date = date'2024-03-01'").select("rate")) <= 0.5 * 4000


def test_the_curve_takes_bits_in_turn(spark):
    df = spark.range(64).selectExpr("id DIV 8 AS a", "id % 8 AS b")
    found = ranks.with_curve(df, ["a", "b"], "z").collect()
    for x in found:
        bits = sum(((x.a >> i) & 1) << (2 * i + 1) | ((x.b >> i) & 1) << (2 * i) for i in range(3))
        assert x.z >> (2 * ranks.CURVE_BITS - 6) == bits
    empty = df.limit(0)
    assert ranks.with_curve(empty, ["a", "b"], "z").count() == 0


def test_a_period_as_key_leaves_the_other_one(spark, root):
    data = [{"closure_period": p, "phase": i % 5, "table_name": str(i)} for p in (JAN, FEB) for i in range(200)]
    df = tables.stamp(tables.audit_rows(spark, data, "data_quality_checks"), "data_quality_checks", "2024-03-01 00:00:00")
    tables.write_clustered(df, root, "data_quality_checks", files=10)
    stored = tables.read_table(spark, root, "data_quality_checks")
    assert stored.count() == 400
    assert scanned(stored.filter("phase = 3").select("table_name")) <= 0.5 * 400


# --- compaction -------------------------------------------------------------


def test_groups_of_files():
    f = lambda folder, name, size: files.DataFile(folder, name, name, size)
    given = [f("a", "1", 40), f("a", "2", 50), f("a", "3", 90), f("a", "4", 20), f("b", "5", 10), f("b", "6", 10), f("c", "7", 1)]
    found = files.compaction_groups(given, 100)
    assert [[x.name for x in g] for g in found] == [["1", "2"], ["5", "6"]]
    rng = random.Random(1)
    many = [f(folder, str(i), rng.randint(1, 120)) for folder in "xyz" for i in range(200)]
    left = many
    for _ in range(3):
        groups = files.compaction_groups(left, 100)
        gone = {id(x) for g in groups for x in g}
        assert all(sum(x.size for x in g) <= 100 and len({x.folder for x in g}) == 1 for g in groups)
        left = sorted([x for x in left if id(x) not in gone] + [f(g[0].folder, f"n{i}", sum(x.size for x in g)) for i, g in enumerate(groups)], key=lambda x: (x.folder, x.name))
    assert sum(x.size for x in left) == sum(x.size for x in many)
    for folder in "xyz":
        assert len([x for x in left if x.folder == folder]) <= 3 * sum(x.size for x in many if x.folder == folder) / 100 + 2


def test_files_stay_few_over_fifty_appends(spark, root):
    big = kpis(spark, *[(f"big{random.Random(i).random()}", i) for i in range(4000)])
    tables.append(big, root, "kpi_metrics")
    large = names(root)
    size = min(f.size for f in files.list_files(spark, tables.table_path(root, "kpi_metrics")))
    target = int(size / files.FULL_SHARE) - 1
    for i in range(50):
        tables.append(kpis(spark, (f"n{i}", i), period=JAN if i % 2 else FEB), root, "kpi_metrics")
        if i % 10 == 9:
            assert files.compact(spark, root, "kpi_metrics", target) > 0
            found = names(root)
            assert len(found) <= 3 and large <= found  # the full file keeps its name
    stored = tables.read_table(spark, root, "kpi_metrics")
    assert stored.count() == 4050
    assert rows(stored.filter("metric_name LIKE 'n%'"), "closure_period", "metric_name", "metric_value") == sorted(
        ((JAN if i % 2 else FEB, f"n{i}", float(i)) for i in range(50)), key=repr
    )
    assert files.compact(spark, root, "kpi_metrics", target) == 0


def test_compaction_of_one_period_and_of_tables_without(spark, root):
    for i in range(3):
        tables.append(kpis(spark, (f"a{i}", i)), root, "kpi_metrics")
        tables.append(kpis(spark, (f"b{i}", i), period=FEB), root, "kpi_metrics")
        tables.append(tables.stamp(spark.createDataFrame([(f"C{i}", 1.0)], "currency string, rate double"), "exchange_rates_raw"), root, "exchange_rates_raw")
    assert files.compact(spark, root, "kpi_metrics", period=JAN) == 3
    assert Counter(n.split("closure_period=")[1][:7] for n in names(root)) == {JAN: 1, FEB: 3}
    assert files.compact(spark, root, "exchange_rates_raw") >= 3
    assert len(names(root, "exchange_rates_raw")) == 1
    assert rows(tables.read_table(spark, root, "exchange_rates_raw"), "currency") == [("C0",), ("C1",), ("C2",)]
    tables.ensure_tables(spark, root, ["approvals"])
    assert files.compact(spark, root, "approvals") == 0


@pytest.mark.parametrize("at", ["write", "plan", "move", "end"])
def test_an_interrupted_swap_is_finished_or_dropped(spark, root, monkeypatch, at):
    """Wherever the driver is lost, the next call leaves every row there once."""
    for i in range(4):
        tables.append(kpis(spark, (f"a{i}", i)), root, "kpi_metrics")
    expected = rows(tables.read_table(spark, root, "kpi_metrics"), "metric_name")

    class Lost(Exception):
        pass

    def lost(*_):
        raise Lost

    with monkeypatch.context() as m:
        if at == "write":
            m.setattr(files, "_swap", lost)
        elif at == "plan":
            m.setattr(files, "_carry_out", lost)
        elif at == "move":
            whole = files._carry_out

            def half(spark, plan):
                whole(spark, plan[:2])
                raise Lost

            m.setattr(files, "_carry_out", half)
        else:
            whole = files._carry_out

            def then_lost(spark, plan):
                whole(spark, plan)
                raise Lost

            m.setattr(files, "_carry_out", then_lost)
        with pytest.raises(Lost):
            files.compact(spark, root, "kpi_metrics")
    assert files.recover(spark, tables.table_path(root, "kpi_metrics")) == 1
    assert rows(tables.read_table(spark, root, "kpi_metrics"), "metric_name") == expected
    files.compact(spark, root, "kpi_metrics")
    assert rows(tables.read_table(spark, root, "kpi_metrics"), "metric_name") == expected and len(names(root)) == 1
    assert not list(Path(root).rglob("_swap-*"))


# --- updates ----------------------------------------------------------------


def test_only_files_with_a_pending_row_are_rewritten(spark, root):
    def asked(i, period, state, kind="BU_SIGNOFF"):
        row = {"approval_id": i, "closure_period": period, "phase": 4, "approval_type": kind, "status": state, "comments": "c"}
        tables.append(tables.audit_rows(spark, [row], "approvals"), root, "approvals")

    asked("1", JAN, "PENDING")
    asked("2", JAN, "APPROVED")
    asked("3", FEB, "PENDING")
    asked("4", JAN, "PENDING", "OTHER")
    asked("5", None, "PENDING")
    before = names(root, "approvals")
    expected = rows(controls.approve_pending(tables.read_table(spark, root, "approvals"), "2024-02-01 00:00:00", JAN))
    assert status.approve_stored(spark, root, "2024-02-01 00:00:00", JAN) == 1
    after = names(root, "approvals")
    assert rows(tables.read_table(spark, root, "approvals")) == expected
    assert len(before - after) == 1 and len(after) == 5
    assert status.approve_stored(spark, root, "2024-02-01 00:00:00", JAN) == 0
    assert names(root, "approvals") == after
    assert status.approve_stored(spark, root, "2024-02-02 00:00:00") == 2  # the other period, and the row without one
    assert rows(tables.read_table(spark, root, "approvals"), "approval_id", "status") == [
        ("1", "APPROVED"), ("2", "APPROVED"), ("3", "APPROVED"), ("4", "PENDING"), ("5", "APPROVED"),
    ]


def test_an_update_may_empty_a_file(spark, root):
    tables.append(kpis(spark, ("a", 1)), root, "kpi_metrics")
    tables.append(kpis(spark, ("b", 2), ("c", 3)), root, "kpi_metrics")
    gone = F.col("metric_name") == "a"
    assert files.update_where(spark, root, "kpi_metrics", gone, lambda df: df.filter(~gone)) == 1
    assert rows(tables.read_table(spark, root, "kpi_metrics"), "metric_name") == [("b",), ("c",)]
    assert len(names(root)) <= 2


# --- landing ----------------------------------------------------------------


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return folder


def land(spark, inbox, root, tmp_path, **more):
    return landing.land_csv(
        spark, str(inbox), root, "exchange_rates_raw", str(tmp_path / "seen"), loaded_at="2024-01-04 00:00:00", **more
    )


def test_each_file_is_landed_once(spark, inbox, root, tmp_path):
    (inbox / "a.csv").write_text(HEAD + "EUR,0.92,2024-01-02,ECB\nGBP,none,2024-01-02,ECB\n")
    (inbox / "b.csv").write_text(HEAD + "SGD,1.34,2024-01-03,\n")
    assert land(spark, inbox, root, tmp_path) == landing.Landed(1, 3, 1)
    assert land(spark, inbox, root, tmp_path) == landing.Landed(0, 0, 0)
    (inbox / "c.csv").write_text(HEAD + "JPY,150,2024-01-03,ECB\nXXX,1,2024-01-03,ECB,surplus\n")
    (inbox / "d.csv").write_text(HEAD)
    assert land(spark, inbox, root, tmp_path, files_per_batch=1).lines == 2
    stored = tables.read_table(spark, root, "exchange_rates_raw")
    first = stored.filter("load_id = 'landing-000000000'")
    assert rows(first, "currency", "rate") == [("EUR", 0.92), ("GBP", None), ("SGD", 1.34)]
    assert rows(stored, "currency") == [("EUR",), ("GBP",), ("JPY",), ("SGD",), ("XXX",)]
    assert {Path(r.file_name).name for r in stored.collect()} == {"a.csv", "b.csv", "c.csv"}
    refused = landing.read_rejected(spark, root, "exchange_rates_raw")
    assert rows(refused, tables.REJECTED, "fields_read") == [
        ("GBP,none,2024-01-02,ECB", 3), ("XXX,1,2024-01-03,ECB,surplus", 4),
    ]
    lost = stored.join(refused.select("load_id", "file_name"), ["load_id", "file_name"], "left_semi")
    assert rows(lost, "currency") == [("EUR",), ("GBP",), ("JPY",), ("XXX",)]  # loads of rejected lines are those of their files
    # The same rows as a landing of all files at once.
    whole = tables.ingest_csv(spark, f"{inbox}/*.csv", "exchange_rates_raw", "x", "2024-01-04 00:00:00")
    assert rows(stored.drop("load_id", "file_name")) == rows(whole.drop("load_id", "file_name"))


@pytest.mark.parametrize("after", [0, 1])
def test_a_lost_run_repeats_no_file(spark, inbox, root, tmp_path, monkeypatch, after):
    """The run is lost after the raw rows are there but before the batch is done, then run again."""
    (inbox / "a.csv").write_text(HEAD + "EUR,0.92,2024-01-02,ECB\nGBP,none,2024-01-02,ECB\n")
    whole, calls = files.append_once, []

    def lost(*args):
        calls.append(1)
        if len(calls) > after:
            raise RuntimeError("lost")
        whole(*args)

    with monkeypatch.context() as m:
        m.setattr(files, "append_once", lost)
        with pytest.raises(Exception, match="lost"):
            land(spark, inbox, root, tmp_path)
    (inbox / "b.csv").write_text(HEAD + "SGD,1.34,2024-01-03,\n")
    assert land(spark, inbox, root, tmp_path).lines == 3
    assert rows(tables.read_table(spark, root, "exchange_rates_raw"), "currency") == [("EUR",), ("GBP",), ("SGD",)]
    assert landing.read_rejected(spark, root, "exchange_rates_raw").count() == 1


def test_a_file_with_another_header_ends_the_run(spark, inbox, root, tmp_path):
    (inbox / "a.csv").write_text("currency,rate_date,rate,source\nEUR,2024-01-02,0.92,ECB\n")
    with pytest.raises(Exception, match="(?i)header"):
        land(spark, inbox, root, tmp_path)
    assert tables.read_table(spark, root, "exchange_rates_raw").count() == 0
