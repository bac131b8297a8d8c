"""What the plans must look like to hold at scale."""

import pytest

from closeworks.operators import ledger
from closeworks.plans.registry import BUILDERS, Tables

SF = "/root/testdata/sf0.001"


def plan(df, executed=False):
    execution = df._jdf.queryExecution()
    return (execution.executedPlan() if executed else execution.optimizedPlan()).toString()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_no_python_no_cross_join_and_only_bounded_broadcasts(tables, name):
    text = plan(BUILDERS[name](tables))
    for word in ("PythonUDF", "Cartesian", "Cross", "BatchEvalPython", "MapInPandas", "ExistingRDD", "LogicalRDD"):
        assert word not in text
    # A hint for a broadcast stands only where the side is an aggregate or a configured dimension.
    for line in text.splitlines():
        if "Join" in line and "strategy=broadcast" in line:
            assert "LeftOuter" in line and "rightHint=(strategy=broadcast)" in line


def nodes(df):
    """All operators of the executed plan, with those of stages and subqueries. A reused exchange has nothing below it."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        found.append(node)
        for few in (node.subqueries(), () if kind == "ReusedExchangeExec" else node.children()):
            todo += [few.apply(i) for i in range(few.size())] if few else []
        if kind in ("SubqueryExec", "ScalarSubqueryExec"):
            todo.append(node.child())
    return found


def below(node):
    """Operators under one."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        kind = x.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(x.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(x.plan())
        else:
            children = x.children()
            todo += [children.apply(i) for i in range(children.size())]
            out.append(kind)
    return out[1:]


def test_the_history_reads_the_ledger_once(tables):
    """Current and prior periods come from one shuffle of the ledger."""
    df = BUILDERS["prelim_results"](tables)
    df.collect()
    found = nodes(df)
    assert "ReusedExchangeExec" in [n.getClass().getSimpleName() for n in found]
    scans = [n for n in found if n.getClass().getSimpleName() == "FileSourceScanExec"]
    assert len([n for n in scans if "l_extendedprice" in n.requiredSchema().simpleString()]) == 1


@pytest.mark.parametrize("name", ["prelim_results", "segment_pivot", "final_results", "cuts_summary", "fx_latest", "dq_scorecard"])
def test_rows_are_never_sorted_to_be_aggregated(tables, name):
    """A sort-based aggregate may only run above a hash aggregate, on what is already combined."""
    for node in nodes(BUILDERS[name](tables)):
        if node.getClass().getSimpleName() == "SortAggregateExec":
            assert "HashAggregateExec" in below(node), node.toString()[:400]


def test_segment_pivot_combines_rows_before_it_sorts(spark):
    """The optimizer leaves the hash aggregate in; without it every segment row would be sorted for the minimum."""
    rows = [("2024-01", "NA", "4000", t, f"{t} {i % 3}", True) for i in range(200) for t in ("Product", "Customer")]
    rows += [("2024-01", "NA", "4000", None, None, True), ("2024-01", None, None, "Product", "a", True), (None, "NA", "4000", "Product", "0", False)]
    schema = "closure_period string, bu_code string, account_code string, segment_type string, segment_value string, is_validated boolean"
    df = ledger.segment_pivot(spark.createDataFrame(rows, schema))
    got = sorted(map(tuple, df.collect()), key=repr)
    assert got == [
        ("2024-01", "NA", "4000", "Product 0", None, "Customer 0", None),
        ("2024-01", None, None, "a", None, None, None),
    ]
    sorts = [n for n in nodes(df) if n.getClass().getSimpleName() == "SortAggregateExec"]
    assert sorts
    for node in sorts:
        assert "HashAggregateExec" in below(node), node.toString()[:400]


def test_scans_read_only_the_columns_they_need(tables):
    text = plan(BUILDERS["raw_ledger_by_category"](tables), executed=True)
    scan = next(line for line in text.splitlines() if "FileScan parquet [l_orderkey" in line)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in scan


def test_period_reports_filter_before_the_shuffle(tables):
    text = plan(BUILDERS["cycle_status"](tables), executed=True)
    assert "TakeOrderedAndProject" in text


def test_building_a_query_starts_no_job(spark):
    """Plans are built from schemas alone; nothing is counted or measured before a query runs."""
    from closeworks.plans.registry import all_queries

    context = spark.sparkContext
    context.setJobGroup("building", "plans only")
    try:
        for build in all_queries().values():
            build(spark, "/root/testdata/sf0.01")
        assert list(context.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_newest_period_views_read_two_periods(spark):
    """The period filter stands below every window and shuffle, on the scan of the ledger lines."""
    from closeworks.plans.registry import all_queries

    df = all_queries()["v_final_segmented"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    windows = [depth(x) for x in plan if "Window [" in x and "final_amount" in x]
    filters = [depth(x) for x in plan if "Filter" in x and "scalar-subquery" in x and ">=" in x]
    assert windows and filters and max(filters) > max(windows)
