"""What every plan must and must not contain, so that it holds on far larger tables."""

import os
import re

import pytest

import __spark_entry__ as contract
from weektide.plans.workload import QUERIES
from weektide.plans import workload

FOLDER = contract.SMOKE_FOLDER
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not there")

# These write tables or read raw files; their plans are those of other queries plus a scan.
WRITING = {
    "published_table", "published_refresh", "publish_gate", "area_dimension", "version_diff", "build_tables",
    "coverage_stored", "clustered_lookup",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_pair_joins_python_rows_or_global_windows(spark, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan
    # A window without partition keys would bring a whole table into one task.
    assert not re.search(r"Window \[[^\n]*\], \[\](, |$)", plan)
    if not name.startswith("csv_") and name != "names_read":  # these decode bytes
        assert "InPandas" not in plan


def test_scan_reads_two_columns_and_filters_in_the_source(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(contract.queries()["scan_pruned"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(l_shipdate" in plan and "GreaterThan(l_quantity,40.0)" in plan
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp", plan)


def test_rank_limits_rows_before_the_shuffle(spark):
    for name in ("burden_topk", "dedup_first"):
        assert plan_of(contract.queries()[name](spark, FOLDER)).count("WindowGroupLimit") == 2


def test_known_unique_series_need_one_shuffle(spark):
    """The raw table is built by one aggregation; both windows reuse one partitioning by series."""
    plan = plan_of(contract.queries()["cum_to_weekly"](spark, FOLDER))
    assert plan.count("Exchange hashpartitioning") == 2


def test_weekly_reports_are_parsed_without_a_shuffle(spark):
    from weektide.model import REPORT_SCHEMA
    from weektide.operators import grid

    reports = spark.createDataFrame([], REPORT_SCHEMA)
    for parse in (grid.bullet_to_long, grid.sentinel_to_long, grid.quarantine):
        assert "Exchange" not in plan_of(parse(reports))


def test_grid_blocks_never_partition_by_a_whole_sheet(spark):
    from weektide.operators import grid

    rows = [("f", 2, i, ["x", "y"]) for i in range(10)]
    cells = spark.createDataFrame(rows, "file string, sheet int, row_idx int, cells array<string>")

    def shuffles(chunk_rows):
        plan = plan_of(grid.find_blocks(cells, chunk_rows=chunk_rows))
        return re.findall(r"Exchange hashpartitioning\(file#\d+, sheet#\d+, (\w+)", plan)

    # Only the border table, one row per chunk, is brought together by sheet; one plan for every length.
    assert shuffles(4096) == shuffles(4)
    assert len([c for c in shuffles(4) if c != "_chunk"]) == 1


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING - {"pivot_inferred", "pivot_map", "pivot_roundtrip"}))
def test_no_job_runs_while_a_plan_is_built(spark, name):
    """Only the footers of the given files are read. (The columns of a pivot must be known to name them.)"""
    context = spark.sparkContext
    group = f"plan of {name}"
    context.setJobGroup(group, group)
    try:
        QUERIES[name](spark, FOLDER)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert {s.name.split(" at ")[0] for s in stages if s} <= {"parquet"}


def test_checks_and_coverage_scan_the_table_once(spark):
    from weektide.operators import aggregate, quality

    orders = workload.table(spark, FOLDER, "orders").selectExpr(
        "o_orderstatus AS prefecture", "year(o_orderdate) AS year", "1 AS week", "o_orderpriority AS disease",
        "o_totalprice AS count", "'total' AS category", "'x' AS source",
    )
    for df in (quality.violations(orders), aggregate.coverage(orders), aggregate.table_totals(orders)):
        plan = plan_of(df)
        assert plan.count("FileScan") == 1
        assert "SortAggregate" not in plan and "Expand" not in plan.split("FileScan")[0].split("HashAggregate")[-1]


def test_results_do_not_need_broadcasts(spark):
    """With every broadcast switched off the joins shuffle and give the same rows."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    names = ["burden_topk", "merge_three", "attach_dim", "exclude_years"]
    want = {n: sorted(map(str, contract.queries()[n](spark, FOLDER).collect())) for n in names}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in names:
            assert sorted(map(str, contract.queries()[n](spark, FOLDER).collect())) == want[n]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_filters_on_workbook_names_stay_above_the_counts(spark, tmp_path):
    """What a reader looks for in file names is worked out for sheets and grid rows, not for every case."""
    from pyspark.sql import functions as F

    from weektide.operators import grid
    from weektide.plans import report_grids
    from weektide.sources import reports

    kinds = [("1-URGENT", "F"), ("1-URGENT", "O"), ("5-LOW", "P"), (None, None)]
    rows = [("Gifu", 7, season, week, *kind) for season in (1995, 1996, None) for week in (1, 52, None) for kind in kinds] * 3
    path = str(tmp_path / "cases")
    spark.createDataFrame(rows, "area string, nationkey int, season int, week int, cond string, source string").write.parquet(path)
    cases = spark.read.parquet(path).selectExpr("area", "nationkey", "season + 28 AS year", "week", "cond", "source")
    obs = cases.groupBy(*cases.columns).count().withColumnRenamed("count", "cnt")
    book = report_grids.workbook_grid(obs).withColumn("file", F.regexp_replace("file", r"Syu_01_1_(\d+)", "$1_Syu_01_1"))
    long = grid.workbook_to_long(reports.workbook_files(book, "sex"))
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    looked = [line for line in plan.splitlines() if "Filter" in line and re.search("regexp|rlike", line, re.IGNORECASE)]
    assert looked and not [line for line in looked if "season#" in line]
    totals = {tuple(r) for r in long.where("category = 'total' AND count > 0").select("year", "week", "disease", "count").collect()}
    assert totals == {(y, w, d, n) for y in (2023, 2024) for w in (1, 52) for d, n in (("1-URGENT", 6), ("5-LOW", 3))}


def test_build_counts_the_cases_once(spark, tmp_path, monkeypatch):
    """All reports and workbooks come from one table of counts, which goes when the build ends."""
    import datetime as dt

    tables = {
        "orders": ([(k, k % 3, "FOP"[k % 3], dt.datetime(1998, 1, 1 + k)) for k in range(20)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp"),
        "customer": ([(0, 1), (1, 2), (2, None)], "c_custkey long, c_nationkey int"),
        "nation": ([(1, "NATION_1"), (2, "NATION_2")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        df = df.selectExpr("*", "'2-HIGH' AS o_orderpriority") if name == "orders" else df
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    read = []

    def build_tables(spark, files, root, current_year, cols, workbooks):
        read.extend([*files.inputFiles(), *workbooks.inputFiles()])
        assert files.count() and workbooks.count()
        raise InterruptedError

    monkeypatch.setattr(workload.build, "build_tables", build_tables)
    with pytest.raises(InterruptedError):
        QUERIES["build_tables"](spark, str(tmp_path))
    folders = {os.path.dirname(f.removeprefix("file://")) for f in read}
    assert len(folders) == 1 and not any(name in f for f in folders for name in tables)
    assert not os.path.exists(folders.pop())
