"""Data-quality checks. Violations are data; raising is a separate step that runs one job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.model import COLS, VALID_WEEKS, VALID_YEARS, Cols
from weektide.operators.aggregate import key_counts

PREVIEW_ROWS = 5


def require_columns(df: DataFrame, required: Iterable[str] | None = None, cols: Cols = COLS) -> None:
    """Missing columns are an error; only the schema is looked at."""
    missing = [c for c in (required if required is not None else cols.required) if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def _keys(df: DataFrame, keys: Sequence[str] | None, cols: Cols) -> list[str]:
    return list(keys) if keys is not None else [c for c in cols.key if c != cols.category or c in df.columns]


def duplicate_keys(df: DataFrame, keys: Sequence[str] | None = None, cols: Cols = COLS) -> DataFrame:
    """Keys with more than one row; null keys count as equal."""
    return key_counts(df, _keys(df, keys, cols))


def _count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _row_checks(df: DataFrame, years: tuple[int, int], weeks: tuple[int, int], cols: Cols) -> dict[str, Column]:
    have = set(df.columns)
    checks: dict[str, Column] = {}
    if cols.year in have:
        checks["year out of range"] = ~F.col(cols.year).between(*years)
    if cols.week in have:
        checks["week out of range"] = ~F.col(cols.week).between(*weeks)
    for metric in (cols.count, cols.rate):
        if metric in have:
            checks[f"negative {metric}"] = F.col(metric) < 0
    return checks


def valid_rows(
    df: DataFrame,
    years: tuple[int, int] = VALID_YEARS,
    weeks: tuple[int, int] = VALID_WEEKS,
    cols: Cols = COLS,
) -> DataFrame:
    """Rows that break none of the row checks; what a check cannot tell, as for a null value, passes."""
    for broken in _row_checks(df, years, weeks, cols).values():
        df = df.where(~F.coalesce(broken, F.lit(False)))
    return df


def violations(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    years: tuple[int, int] = VALID_YEARS,
    weeks: tuple[int, int] = VALID_WEEKS,
    cols: Cols = COLS,
) -> DataFrame:
    """(check, violations) of all checks from one scan: rows are folded per key, which the duplicate
    check needs anyway, and the row checks travel along as counters."""
    checks = _row_checks(df, years, weeks, cols)
    names = [*checks, "duplicate records"]
    folded = df.groupBy(*_keys(df, keys, cols)).agg(
        F.count("*").alias("_rows"), *[_count_where(c).alias(name) for name, c in checks.items()]
    )
    sums = folded.agg(
        *[F.coalesce(F.sum(f"`{name}`"), F.lit(0)).alias(name) for name in checks],
        F.count_if(F.col("_rows") > 1).alias("duplicate records"),
    )
    rows = [F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("violations")) for n in names]
    return sums.select(F.inline(F.array(*rows)))


#: Words of 64 bits of the filter that finds keys which may be in a batch: two megabytes.
FILTER_WORDS = 1 << 18


def existing_keys(
    batch: DataFrame, published: DataFrame, keys: Sequence[str] | None = None, cols: Cols = COLS
) -> DataFrame:
    """Keys of the batch that the published table has already; null keys count as equal.

    The published table is not shuffled: a blocked Bloom filter of the batch's keys, of a fixed size, goes to
    the tasks that scan its key columns. What it lets through, the keys that are there and a few others, is
    compared exactly.
    """
    keys = _keys(batch, keys, cols)
    names = [F.col(f"`{k}`") for k in keys]
    known = batch.select(*names).distinct()
    # The same key has the same hash only if its columns have the same types.
    published = published.select(*[F.col(f"`{k}`").cast(batch.schema[k].dataType).alias(k) for k in keys])
    h = F.xxhash64(*names, *[F.when(c.isNull(), 1).otherwise(0) for c in names])
    bit = lambda at: F.expr(f"shiftleft(1L, cast(shiftright(_h, {at}) & 63 as int))")
    spread = [(F.col("_h").bitwiseAND(FILTER_WORDS - 1)).alias("_word"), (bit(20).bitwiseOR(bit(30)).bitwiseOR(bit(40))).alias("_bits")]
    words = known.select(h.alias("_h")).select(*spread).groupBy("_word").agg(F.bit_or("_bits").alias("_set"))
    marked = published.select(*names, h.alias("_h")).select(*names, *spread).join(F.broadcast(words), "_word")
    maybe = marked.where(F.col("_set").bitwiseAND(F.col("_bits")) == F.col("_bits")).select(*names)
    same = [F.col(f"batch.`{k}`").eqNullSafe(F.col(f"there.`{k}`")) for k in keys]
    return known.alias("batch").join(maybe.alias("there"), same, "left_semi")


def violations_of_batch(
    batch: DataFrame,
    published: DataFrame,
    keys: Sequence[str] | None = None,
    years: tuple[int, int] = VALID_YEARS,
    weeks: tuple[int, int] = VALID_WEEKS,
    cols: Cols = COLS,
) -> DataFrame:
    """(check, violations) of new rows alone, and the number of their keys that are published already."""
    own = violations(batch, keys, years, weeks, cols)
    there = existing_keys(batch, published, keys, cols).agg(F.count("*").alias("violations"))
    return own.unionByName(there.select(F.lit("existing records").alias("check"), "violations"))


def unknown_areas(df: DataFrame, dimension: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Area names of the table that the dimension does not have."""
    return df.select(cols.area).distinct().join(dimension.select(cols.area), cols.area, "left_anti")


def validate(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    years: tuple[int, int] = VALID_YEARS,
    weeks: tuple[int, int] = VALID_WEEKS,
    cols: Cols = COLS,
) -> DataFrame:
    """Gate before a write: raises ValueError with a short preview, else returns the table."""
    require_columns(df, cols=cols)
    found = {r["check"]: r["violations"] for r in violations(df, keys, years, weeks, cols).collect()}
    bad = {name: n for name, n in found.items() if n}
    if not bad:
        return df
    name, n = next(iter(bad.items()))
    tests = _row_checks(df, years, weeks, cols)
    sample = df.where(tests[name]) if name in tests else duplicate_keys(df, keys, cols)
    preview = "\n".join(str(r.asDict()) for r in sample.limit(PREVIEW_ROWS).collect())
    raise ValueError(f"Found {n} {name}. All violations: {bad}. For example:\n{preview}")


def validate_no_duplicates(df: DataFrame, keys: Sequence[str] | None = None, cols: Cols = COLS) -> None:
    copies = duplicate_keys(df, keys, cols)
    preview = copies.limit(PREVIEW_ROWS).collect()
    if preview:
        shown = "\n".join(str(r.asDict()) for r in preview)
        raise ValueError(f"Found {copies.count()} duplicate records. For example:\n{shown}")


def validate_date_ranges(
    df: DataFrame,
    years: tuple[int, int] = VALID_YEARS,
    weeks: tuple[int, int] = VALID_WEEKS,
    cols: Cols = COLS,
) -> None:
    have = [c for c in (cols.year, cols.week) if c in df.columns]
    if not have:
        return
    row = df.agg(*[f(c).alias(f"{n}_{c}") for c in have for n, f in (("min", F.min), ("max", F.max))]).first()
    for c, (low, high) in ((cols.year, years), (cols.week, weeks)):
        if c in have and row[f"min_{c}"] is not None:
            first, last = row[f"min_{c}"], row[f"max_{c}"]
            if first < low or last > high:
                raise ValueError(f"{c} out of range {low}-{high}: found {first}-{last}")


def validate_non_negative(df: DataFrame, cols: Cols = COLS) -> None:
    for metric in (cols.count, cols.rate):
        if metric in df.columns:
            bad = df.where(F.col(metric) < 0)
            preview = bad.limit(PREVIEW_ROWS).collect()
            if preview:
                shown = "\n".join(str(r.asDict()) for r in preview)
                raise ValueError(f"Found {bad.count()} rows with negative {metric}. For example:\n{shown}")
