"""Table builds: historical, weekly confirmed, sentinel, and the combined table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weektide.functions import calendar, text
from weektide.model import ALL_CASE, COLS, SENTINEL, Cols
from weektide.operators import aggregate, combine, filters, grid, quality, reshape, series, snapshot
from weektide.session import remove_folder, shared_folder
from weektide.sources import reports
from weektide.sources.catalog import Catalog
from weektide.sources.versions import Version, Versions


def build_sex(*years: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Historical cases by sex; ``female`` is derived when no year reports it."""
    return reshape.derive_complement(combine.union_relaxed(*years), cols=cols)


def build_place(*years: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Historical cases by place of infection."""
    return combine.union_relaxed(*years)


def build_bullet(reports: DataFrame, existing: DataFrame | None, current_year: int, cols: Cols = COLS) -> DataFrame:
    """Weekly confirmed cases: closed years are kept, the current and missing years rebuilt."""
    fresh = filters.drop_unnamed(reports, cols).withColumn(cols.source, F.lit(ALL_CASE))
    return fresh if existing is None else snapshot.merge_refresh(existing, fresh, current_year, cols)


def build_sentinel(reports: DataFrame, existing: DataFrame | None, current_year: int, cols: Cols = COLS) -> DataFrame:
    """Weekly sentinel cases from year-to-date reports.

    Only raw cumulative rows are differenced; rows of closed years are weekly already. A refresh
    therefore gives the same table however often it runs.
    """
    raw = (
        filters.drop_unnamed(reports, cols)
        .withColumn(cols.source, F.lit(SENTINEL))
        .withColumn(cols.date, calendar.iso_monday(cols.year, cols.week))
    )
    weekly = series.cumulative_to_weekly(raw, cols)
    return weekly if existing is None else snapshot.merge_refresh(existing, weekly, current_year, cols)


def build_unified(
    historical: DataFrame | None,
    confirmed: DataFrame | None,
    sentinel: DataFrame | None,
    cols: Cols = COLS,
    normalize: bool = True,
    monday_dates: bool = False,
) -> DataFrame:
    """One table of totals: historical years the weekly table does not cover, all weekly confirmed
    cases, and sentinel conditions that are never confirmed ones. First wins per key.

    ``normalize`` repairs names of preserved rows; ``monday_dates`` puts all dates on the first day
    of the week (the sources use different days).
    """

    def tidy(df: DataFrame) -> DataFrame:
        out = combine.to_observations(df, cols)
        return text.normalize_names(out, cols.condition) if normalize else out

    parts = []
    primary = tidy(confirmed) if confirmed is not None else None
    if historical is not None:
        old = tidy(historical)
        if primary is not None:
            old = filters.exclude_years(old, primary, cols)
        if cols.category in historical.columns:
            old = filters.in_categories(old, "total", cols)
        parts.append(old)
    if primary is not None:
        parts.append(primary)
    if sentinel is not None:
        extra = tidy(sentinel)
        parts.append(combine.absent_from(extra, primary, cols) if primary is not None else extra)
    if not parts:
        raise ValueError("No tables to combine")
    parts = [combine.default_category(p, cols) for p in parts]
    out = combine.ordered_sources(*parts, cols=cols)
    if monday_dates:
        out = out.withColumn(cols.date, calendar.iso_monday(cols.year, cols.week))
    return out


def publish(df: DataFrame, path: str, cols: Cols = COLS, refresh: bool = False) -> None:
    """Check, then write: the published table is not touched when a check fails.

    The table is computed once, into a staging folder of the shared file system; the checks and the
    sorted write read it from there. A lost executor costs a re-read, not a rebuild.
    """
    quality.require_columns(df, cols=cols)
    spark = df.sparkSession
    staging = shared_folder(spark, "staging")
    try:
        df.write.parquet(staging)
        staged = quality.validate(spark.read.schema(df.schema).parquet(staging), cols=cols)
        if refresh:
            snapshot.refresh_years(staged, path, cols)
        else:
            snapshot.write_table(staged, path, cols)
    finally:
        remove_folder(spark, staging)


def refresh_coverage(table: Versions, parts: Versions, cols: Cols = COLS) -> Version:
    """Bring the stored coverage of a table up to date: only years that have changed since are read.

    ``parts`` holds :func:`aggregate.coverage_parts` per year and notes the version that it was counted from.
    """
    now, done = table.current(), parts.current()
    seen = done.notes.get("of") if done else None
    before = table.at(seen) if seen is not None and seen in table.numbers() else None
    notes = {"of": now.number}
    if before is None:
        return parts.overwrite(aggregate.coverage_parts(table.read(now), cols), notes)
    changed = now.changed_years(before)
    fresh = aggregate.coverage_parts(table.read(now, changed), cols)
    return parts.refresh(fresh, drop=changed, notes=notes) if changed else done


def read_coverage(spark: SparkSession, root: str, cols: Cols = COLS) -> DataFrame:
    """Coverage per condition of the combined table below ``root``, from the counts stored with it."""
    return aggregate.coverage_of(Versions(spark, f"{root}/{COVERAGE_FILE}", cols).read(), cols)


BUILDABLE = ("sex_prefecture", "place_prefecture", "bullet", "sentinel", "unified")
COVERAGE_FILE, NAMES_FOLDER = "coverage.parquet", "names_read"


def read_names(spark: SparkSession, root: str) -> DataFrame:
    """Every spelling that reports carried in any run, what became of it, and where it was first seen.

    Runs append to the log; a run that is repeated adds nothing new.
    """
    log = spark.read.schema("raw string, canonical string, year int, week int, file string")
    return grid.merge_audits(log.parquet(f"{root}/{NAMES_FOLDER}"))


def build_tables(
    spark: SparkSession,
    landing: str | DataFrame,
    root: str,
    current_year: int,
    tables: Iterable[str] = BUILDABLE,
    cols: Cols = COLS,
    workbooks: DataFrame | None = None,
) -> DataFrame:
    """Raw reports -> published tables below ``root``; returns (file, reason) of unusable weekly reports.

    ``landing``: a folder of weekly CSV files, or a table of them (path, content). Each file is decoded once,
    into a table for all that follows. ``workbooks``: a cell-grid table of the yearly workbooks; of these only
    the years are parsed that the historical tables lack. ``tables`` selects what is built.

    Of a weekly table that exists, closed years are kept and only the current year and the years that it lacks
    are written. The combined table is built from what is published; years whose rows stay the same keep
    their files, and its stored coverage counts the others anew. The spellings of conditions that were read are
    added to a log (:func:`read_names`). A table whose check fails is not touched,
    and ends the run.
    """
    wanted = list(tables)
    if unknown := set(wanted) - set(BUILDABLE):
        raise ValueError(f"Unknown tables: {sorted(unknown)}")
    catalog = Catalog(spark, root, cols=cols)

    def stored(name: str) -> DataFrame | None:
        try:
            return catalog.load(name)
        except AnalysisException as problem:
            if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def tidy(df: DataFrame) -> DataFrame:
        return combine.default_category(combine.to_observations(df, cols), cols)

    for name, kind, make in (("sex_prefecture", "sex", build_sex), ("place_prefecture", "place", build_place)):
        if name in wanted and workbooks is not None:
            books, before = reports.workbook_files(workbooks, kind), catalog.versions(name).current()
            if before is not None:
                held = [y for y in before.commits if y is not None]
                books = books.where(~reports.year_from_name("file").isin(held))
            fresh = tidy(make(grid.workbook_to_long(books, cols), cols=cols))
            publish(fresh, catalog.path(name), cols, refresh=before is not None)
    staging = shared_folder(spark, "reports")
    files = reports.landing_files(spark, landing) if isinstance(landing, str) else landing
    try:
        found = reports.stage_reports(files, staging)
        builds = {
            "bullet": lambda df: build_bullet(grid.bullet_to_long(df, cols), None, current_year, cols),
            "sentinel": lambda df: build_sentinel(grid.sentinel_to_long(df, cols), None, current_year, cols),
        }
        for name in [n for n in builds if n in wanted]:
            fresh, before = tidy(builds[name](found.where(F.col("layout") == name).drop("layout"))), stored(name)
            if before is not None:
                fresh = snapshot.open_years(fresh, before, current_year, cols)
            publish(fresh, catalog.path(name), cols, refresh=before is not None)
        refused = shared_folder(spark, "refused")
        grid.quarantine(found).write.parquet(refused)
        grid.names_read(found.drop("layout")).write.mode("append").parquet(f"{root}/{NAMES_FOLDER}")
    finally:
        remove_folder(spark, staging)
    if "unified" in wanted:
        old = [t for t in (stored("sex_prefecture"), stored("place_prefecture")) if t is not None]
        historical = combine.union_relaxed(*old) if old else None
        publish(build_unified(historical, stored("bullet"), stored("sentinel"), cols), catalog.path("unified"), cols)
        refresh_coverage(catalog.versions("unified"), Versions(spark, f"{root}/{COVERAGE_FILE}", cols), cols)
    return spark.read.schema("file string, reason string").parquet(refused)
