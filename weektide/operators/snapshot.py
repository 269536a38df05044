"""Published tables: ordered writes, refresh of open years, profiles, fingerprints, file checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weektide.functions import calendar
from weektide.model import COLS, Cols
from weektide.operators.combine import union_relaxed
from weektide.operators.filters import exclude_years
from weektide.sources.versions import Version, Versions, row_hash

# -- writes -----------------------------------------------------------------------------------


def write_table(df: DataFrame, path: str, cols: Cols = COLS) -> None:
    """The rows become the table at ``path``, sorted and partitioned by year; see :mod:`weektide.sources.versions`.

    Readers see the old table or the new one, never a part: what was published stays readable until the
    new version stands, also when the write breaks off.
    """
    Versions(df.sparkSession, path, cols).overwrite(df)


def refresh_years(df: DataFrame, path: str, cols: Cols = COLS) -> None:
    """Replace the years present in ``df``; folders of other years are not touched or read."""
    Versions(df.sparkSession, path, cols).refresh(df)


def read_table(spark: SparkSession, path: str, cols: Cols = COLS) -> DataFrame:
    """The newest version of a published table."""
    return Versions(spark, path, cols).read()


def open_years(rebuilt: DataFrame, existing: DataFrame, current_year: int, cols: Cols = COLS) -> DataFrame:
    """Rebuilt rows of the current year and of years the existing table does not have."""
    return exclude_years(rebuilt, existing.where(F.col(cols.year) < current_year), cols)


def merge_refresh(existing: DataFrame, rebuilt: DataFrame, current_year: int, cols: Cols = COLS) -> DataFrame:
    """Closed years of the existing table, and the current and missing years of the rebuilt one."""
    closed = existing.where(F.col(cols.year) < current_year)
    return union_relaxed(closed, open_years(rebuilt, existing, current_year, cols))


# -- change detection -------------------------------------------------------------------------


def fingerprint(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """(keys..., rows, digest): independent of row and partition order, one pass without a shuffle of rows."""
    digest = F.coalesce(F.sum(row_hash(df, df.columns)), F.lit(0)).alias("digest")
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), digest)


def change_report(tables: Mapping[str, tuple[DataFrame, DataFrame]], cols: Cols = COLS) -> DataFrame:
    """(table, changed, year, week), one row for each table given as (before, after).

    ``changed``: any row differs; year and week: the latest of the table after. One pass over either side.
    """
    out = None
    for name, (before, after) in tables.items():
        # The same columns in another order are no change; other columns are.
        same = sorted(before.columns) == sorted(after.columns)
        sides = [
            df.select(row_hash(df, df.columns).alias("h"), F.lit(new).alias("new"), *(F.col(c) for c in (cols.year, cols.week)))
            for df, new in ((before, False), (after, True))
        ]
        new = F.col("new")
        delta = F.coalesce(F.sum(F.when(new, F.col("h")).otherwise(-F.col("h"))), F.lit(0)) != 0
        counts = F.count_if(new) != F.count_if(~new)
        row = sides[0].unionByName(sides[1]).agg(
            (delta | counts | F.lit(not same)).alias("changed"), F.max(F.when(new, F.struct(cols.year, cols.week))).alias("last")
        )
        row = row.select(F.lit(name).alias("table"), "changed", F.col(f"last.{cols.year}"), F.col(f"last.{cols.week}"))
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("No tables to compare")
    return out


def has_changed(before: DataFrame, after: DataFrame) -> bool:
    """True when the two tables differ in any row."""
    return fingerprint(before).first() != fingerprint(after).first()


def snapshot_diff(
    before: DataFrame, after: DataFrame, keys: Iterable[str] | None = None, cols: Cols = COLS
) -> DataFrame:
    """Status of every key: added, removed, changed or same.

    Both sides are folded per key in one aggregation instead of a full join, so copies of a key
    shrink before the shuffle.
    """
    keys = list(keys if keys is not None else cols.key)
    values = [c for c in before.columns if c not in keys]
    if set(values) != {c for c in after.columns if c not in keys}:
        raise ValueError("Snapshots have different columns")

    def side(df: DataFrame, is_after: bool) -> DataFrame:
        v = [F.col(f"`{c}`") for c in values]
        nulls = [F.when(c.isNull(), 1).otherwise(0) for c in v]
        row_hash = F.xxhash64(*v, *nulls) if v else F.lit(0).cast("long")
        return df.select(*keys, row_hash.cast("decimal(38,0)").alias("_hash"), F.lit(is_after).alias("_after"))

    both = side(before, False).unionByName(side(after, True))
    is_after = F.col("_after")
    folded = both.groupBy(*keys).agg(
        F.count_if(~is_after).alias("_old"),
        F.count_if(is_after).alias("_new"),
        F.sum(F.when(is_after, F.col("_hash")).otherwise(-F.col("_hash"))).alias("_delta"),
    )
    status = (
        F.when(F.col("_old") == 0, "added")
        .when(F.col("_new") == 0, "removed")
        .when((F.col("_old") != F.col("_new")) | (F.col("_delta") != 0), "changed")
        .otherwise("same")
    )
    return folded.select(*keys, status.alias("status"))


def version_diff(
    table: Versions, before: Version, after: Version, keys: Iterable[str] | None = None
) -> DataFrame:
    """Status of the keys that two versions of a table tell apart: added, removed or changed.

    A walk down a hash tree: years that both read from the same folders are not looked at; of the others
    the stored digests per (year, area) are compared, and rows are read only where these differ. One small
    job reads the digests when the plan is built.
    """
    cols = table.cols
    keys = list(keys if keys is not None else [c for c in cols.key if c in after.schema.names])
    parts = table.changed_parts(before, after).persist()
    years = [r.year for r in parts.select("year").distinct().collect()]
    year, area = F.col(f"rows.`{cols.year}`"), F.col(f"rows.`{cols.area}`") if cols.area in after.schema.names else None

    def side(version: Version) -> DataFrame:
        rows = table.read(version, [y for y in version.commits if y in years]).alias("rows")
        on = year.cast("int").eqNullSafe(F.col("parts.year"))
        if area is not None:
            on &= area.eqNullSafe(F.col("parts.area"))
        return rows.join(parts.alias("parts"), on, "left_semi")

    return snapshot_diff(side(before), side(after), keys, cols).where("status <> 'same'")


# -- profile ----------------------------------------------------------------------------------


def portable_type(data_type: T.DataType) -> tuple[str, str | None]:
    """Engine-neutral type name, and a note when the type had to be approximated."""
    name = data_type.typeName()
    if name == "date":
        return "date", None
    if name in ("timestamp", "timestamp_ntz"):
        return "datetime", None
    if name in ("byte", "short", "integer", "long"):
        return "int64", None
    if name in ("float", "double"):
        return "float64", None
    if name == "boolean":
        return "bool", None
    if name in ("string", "varchar", "char"):
        return "string", None
    return "string", f"Unsupported type '{data_type.simpleString()}' mapped to portable dtype 'string'."


def schema_rows(df: DataFrame) -> DataFrame:
    """(name, dtype, note) per column, sorted by name; the schema alone is read."""
    rows = [(f.name, *portable_type(f.dataType)) for f in sorted(df.schema, key=lambda f: f.name)]
    return df.sparkSession.createDataFrame(rows, "name string, dtype string, note string")


def _date_range(df: DataFrame, cols: Cols) -> tuple[Column, Column]:
    """Date column, else the Mondays of the periods, else the year limits."""
    types = {f.name: f.dataType.typeName() for f in df.schema}
    if types.get(cols.date) in ("date", "timestamp", "timestamp_ntz"):
        return F.min(cols.date).cast("string"), F.max(cols.date).cast("string")
    if cols.year in types and cols.week in types:
        number = calendar.period_number(cols.year, cols.week)

        def monday(n: Column) -> Column:
            return calendar.iso_monday(F.floor(n / 100), n % 100).cast("string")

        return monday(F.min(number)), monday(F.max(number))
    if cols.year in types:
        low, high = F.min(cols.year).cast("int"), F.max(cols.year).cast("int")
        return F.format_string("%04d-01-01", low), F.format_string("%04d-12-31", high)
    none = F.lit(None).cast("string")
    return none, none


def profile(df: DataFrame, cols: Cols = COLS) -> DataFrame:
    """(rows, date_min, date_max) in one aggregation."""
    low, high = _date_range(df, cols)
    return df.agg(F.count("*").alias("rows"), low.alias("date_min"), high.alias("date_max"))


# -- file checks ------------------------------------------------------------------------------


def content_inventory(contents: DataFrame, name: str = "file", content: str = "content") -> DataFrame:
    """(file, size_bytes, sha256) of a table of names and contents, text or binary; a null content has neither."""
    data = F.col(content).cast("binary")
    return contents.select(
        F.col(name).cast("string").alias("file"), F.octet_length(data).cast("long").alias("size_bytes"), F.sha2(data, 256).alias("sha256")
    )


def file_inventory(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(file, size_bytes, sha256) of the files below a folder, on every file system that Spark reads.

    A file has to fit in memory: Spark's source hands it over whole.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.regexp_extract("path", r"[^/]+$", 0).alias("file"), "content")
    )
    return content_inventory(files)


def verify_files(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """(file, status) for every listed or present file: ok, missing, size mismatch, checksum mismatch,
    unlisted."""
    want = manifest.select(
        "file", F.col("size_bytes").alias("_size"), F.col("sha256").alias("_sha"), F.lit(True).alias("_listed")
    )
    both = inventory.withColumn("_here", F.lit(True)).join(want, "file", "full")
    status = (
        F.when(F.col("_listed").isNull(), "unlisted")
        .when(F.col("_here").isNull(), "missing")
        .when(~F.col("size_bytes").eqNullSafe(F.col("_size")), "size mismatch")
        .when(~F.col("sha256").eqNullSafe(F.col("_sha")), "checksum mismatch")
        .otherwise("ok")
    )
    return both.select("file", status.alias("status"))


def manifest_files(manifest: DataFrame) -> DataFrame:
    """Rows (file, size_bytes, sha256) of a manifest document with a ``tables`` array."""
    return manifest.select(F.inline("tables")).select("file", "size_bytes", "sha256")


def missing_contents(inventory: DataFrame, required: DataFrame) -> DataFrame:
    """Required names (file) that are not there."""
    return required.select("file").join(inventory.select("file"), "file", "left_anti")


def missing_tables(inventory: DataFrame, required: Iterable[str]) -> DataFrame:
    """Required file names that are not there."""
    return missing_contents(inventory, inventory.sparkSession.createDataFrame([(f,) for f in required], "file string"))
