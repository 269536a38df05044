"""Weekly files arrive -> the touched years of a table are recomputed and replaced.

The state is a log per year: every micro-batch adds a folder of its good reports to the years that it
touches, as a version of the state, so what was stored is never written over. What a report says now is
decided when the state is read: the latest batch wins, and a batch that runs twice leaves the same state.
A batch opens the folders of its own years only. When a year has gathered ``MAX_FOLDERS`` of them, the batch
writes its rows anew as one folder, without what has been replaced. Reports that cannot be used, or hold
impossible values, go to a quarantine table and do not touch the state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weektide.model import COLS, REPORT_SCHEMA, VALID_YEARS, Cols
from weektide.operators import combine, grid, quality, series, snapshot
from weektide.sources import reports
from weektide.sources.versions import COMMIT, Versions

#: Folders that a year of the state gathers before they become one.
MAX_FOLDERS = 8

PARSERS = {"sentinel": grid.sentinel_to_long, "bullet": grid.bullet_to_long}


def stream_reports(spark: SparkSession, folder: str, kind: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """New CSV files of the landing folder as a stream of reports; with ``kind`` those of one layout only."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path", "content")
    )
    if kind is not None:
        files = files.where(reports.layout_of("path") == kind)
    return files.mapInPandas(reports.split_files(), REPORT_SCHEMA)


def _impossible(cols: Cols, columns: list[str]) -> Column:
    """Values that no report can hold, row by row."""
    bad = F.col(cols.date).isNull() | ~F.col(cols.year).between(*VALID_YEARS)
    for value in (cols.count, cols.rate):
        if value in columns:
            bad |= F.coalesce(F.col(value) < 0, F.lit(False))
    return bad


def apply_batch(
    arrived: DataFrame,
    raw_path: str,
    table_path: str,
    quarantine_path: str,
    batch_id: int = 0,
    kind: str = "sentinel",
    cols: Cols = COLS,
) -> None:
    """Add one batch of reports of one kind to the state and rebuild the years of the table that it touches.

    A report that arrives again replaces the earlier one of the same key. The rebuilt years are checked
    before anything is written; a violation raises and leaves state and table as they are.
    """
    arrived = arrived.where(reports.layout_of("file") == kind).persist()
    try:
        parsed = PARSERS[kind](arrived, cols, anchor="monday", keep=("file",))
        refused = parsed.where(_impossible(cols, parsed.columns)).select("file").distinct()
        refused = refused.withColumn("reason", F.lit("impossible values")).persist()
        new = parsed.join(refused, "file", "left_anti").drop("file").persist()
        try:
            _fold(new, grid.quarantine(arrived).unionByName(refused), raw_path, table_path, quarantine_path, batch_id, kind, cols)
        finally:
            new.unpersist()
            refused.unpersist()
    finally:
        arrived.unpersist()


def current_rows(spark: SparkSession, raw_path: str, cols: Cols = COLS) -> DataFrame | None:
    """The state as it stands: for each key the row of the latest batch."""
    state = Versions(spark, raw_path, cols)
    return _latest(state.read(with_commit=True), cols).drop("batch") if state.exists() else None


def _latest(rows: DataFrame, cols: Cols) -> DataFrame:
    """One row per key: of the latest batch, and of its last run."""
    keys = [cols.area, cols.year, cols.week, cols.condition]
    newest = F.struct((-F.col("batch")).alias("batch"), F.translate(COMMIT, "0123456789abcdef-", "fedcba9876543210-"))
    return combine.dedup_first(rows, newest, keys, cols).drop(COMMIT)


def _fold(
    new: DataFrame,
    bad: DataFrame,
    raw_path: str,
    table_path: str,
    quarantine_path: str,
    batch_id: int,
    kind: str,
    cols: Cols,
) -> None:
    spark = new.sparkSession
    state = Versions(spark, raw_path, cols)
    stored = state.current()
    # The years of one batch of reports: a few numbers.
    years = [r[0] for r in new.select(cols.year).distinct().collect()]
    new = new.withColumn("batch", F.lit(batch_id).cast("long"))
    rows = new.withColumn(COMMIT, F.lit("f"))  # later than all that is stored
    if stored is not None:
        rows = rows.unionByName(state.read(stored, years, with_commit=True), allowMissingColumns=True)
    now = _latest(rows, cols).persist()
    full = [y for y in years if stored is not None and len(stored.commits.get(y, ())) >= MAX_FOLDERS]
    table = series.cumulative_to_weekly(now.drop("batch"), cols, unique=True) if kind == "sentinel" else now.drop("batch")
    table = table.persist()
    try:
        quality.validate(table, cols=cols)
        bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        if years:
            in_full = F.col(cols.year).isin(full)
            state.append(new.where(~in_full).unionByName(now.where(in_full), allowMissingColumns=True) if full else new, replace=full)
            state.vacuum()
            snapshot.refresh_years(table, table_path, cols)
            Versions(spark, table_path, cols).vacuum()
    finally:
        table.unpersist()
        now.unpersist()


def start_refresh(
    spark: SparkSession,
    folder: str,
    raw_path: str,
    table_path: str,
    quarantine_path: str,
    checkpoint: str,
    kind: str = "sentinel",
    cols: Cols = COLS,
    on_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Run :func:`apply_batch` on the reports of one kind that have arrived, then stop."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, raw_path, table_path, quarantine_path, batch_id, kind, cols)
        if on_batch:
            on_batch(batch_id)

    return (
        stream_reports(spark, folder, kind)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
