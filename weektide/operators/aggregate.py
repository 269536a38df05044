"""Aggregations and the usual questions: burden, peaks, early warning, ratios, coverage, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weektide.functions import calendar
from weektide.model import COLS, Cols
from weektide.operators.reshape import pivot_category


def null_safe_sum(column: Column | str) -> Column:
    """Sum with missing values as 0; a group of nulls gives 0, not null."""
    return F.sum(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(0)))


def sum_by(df: DataFrame, keys: Sequence[str], out: str = "cases", cols: Cols = COLS) -> DataFrame:
    return df.groupBy(*keys).agg(null_safe_sum(cols.count).alias(out))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a column."""
    return df.select(column).distinct().orderBy(column)


def _year_of(period: Column) -> Column:
    return F.floor(period / 100).cast("int")


def _week_of(period: Column) -> Column:
    return (period % 100).cast("int")


def latest_period(df: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Last (year, week) of the table: one row, nulls when the table is empty."""
    last = df.agg(F.max(calendar.period_number(cols.year, cols.week)).alias("_last"))
    return last.select(_year_of(F.col("_last")).alias(cols.year), _week_of(F.col("_last")).alias(cols.week))


def coverage_parts(df: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Per year, condition and source: first and last period, total and number of rows.

    The parts of several tables, or of single years, are put together by :func:`coverage_of`.
    """
    number = calendar.period_number(cols.year, cols.week)
    return df.groupBy(cols.year, cols.condition, cols.source).agg(
        F.min(number).alias("first_number"),
        F.max(number).alias("last_number"),
        null_safe_sum(cols.count).alias("total_cases"),
        F.count("*").alias("rows"),
    )


def coverage_of(parts: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Per condition: first and last period, reporting sources, total and number of rows."""
    per_source = parts.groupBy(cols.condition, cols.source).agg(
        F.min(cols.year).alias("first_year"),
        F.max(cols.year).alias("last_year"),
        F.min("first_number").alias("_first"),
        F.max("last_number").alias("_last"),
        F.sum("total_cases").alias("total_cases"),
        F.sum("rows").alias("rows"),
    )
    folded = per_source.groupBy(cols.condition).agg(
        F.min("first_year").alias("first_year"),
        F.max("last_year").alias("last_year"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.array_join(F.sort_array(F.collect_set(cols.source)), ", ").alias("sources"),
        F.sum("total_cases").alias("total_cases"),
        F.sum("rows").alias("rows"),
    )
    first, last = F.col("_first"), F.col("_last")
    return (
        folded.select(
            cols.condition,
            "first_year",
            F.when(_year_of(first) == F.col("first_year"), _week_of(first)).alias("first_week"),
            "last_year",
            F.when(_year_of(last) == F.col("last_year"), _week_of(last)).alias("last_week"),
            "sources",
            "total_cases",
            "rows",
        )
        .withColumn("first_period", calendar.period_label("first_year", "first_week"))
        .withColumn("last_period", calendar.period_label("last_year", "last_week"))
        .orderBy(cols.condition)
    )


def coverage(df: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Coverage per condition, of a table as it stands.

    The table is folded by a hash aggregation; the source lists are built from its few rows only.
    """
    return coverage_of(coverage_parts(df, cols), cols)


def table_totals(df: DataFrame, cols: Cols = COLS, approximate: bool = False) -> DataFrame:
    """Rows, year range and number of conditions and areas, one row.

    Exact counts fold the table to (condition, area) first: several distinct counts on the rows
    themselves would multiply them.
    """
    if approximate:
        return df.agg(
            F.count("*").alias("rows"),
            F.min(cols.year).alias("min_year"),
            F.max(cols.year).alias("max_year"),
            F.approx_count_distinct(cols.condition).alias("conditions"),
            F.approx_count_distinct(cols.area).alias("areas"),
        )
    folded = df.groupBy(cols.condition, cols.area).agg(
        F.count("*").alias("_rows"), F.min(cols.year).alias("_min"), F.max(cols.year).alias("_max")
    )
    return folded.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.min("_min").alias("min_year"),
        F.max("_max").alias("max_year"),
        F.count_distinct(cols.condition).alias("conditions"),
        F.count_distinct(cols.area).alias("areas"),
    )


def period_bounds(df: DataFrame, cols: Cols = COLS) -> DataFrame:
    """First and last period as year*100+week, and their Mondays."""
    number = calendar.period_number(cols.year, cols.week)
    bounds = df.agg(F.min(number).alias("min_period"), F.max(number).alias("max_period"))

    def monday(c: str) -> Column:
        return calendar.iso_monday(_year_of(F.col(c)), _week_of(F.col(c)))

    return bounds.select(
        "min_period", "max_period", monday("min_period").alias("date_min"), monday("max_period").alias("date_max")
    )


def top_burden(df: DataFrame, k: int = 5, cols: Cols = COLS, out: str = "cases") -> DataFrame:
    """Conditions with the most cases per year, ties share a dense rank.

    The rank limit is applied per task before the shuffle by year.
    """
    w = Window.partitionBy(cols.year).orderBy(F.col(out).desc())
    return (
        sum_by(df, [cols.year, cols.condition], out, cols)
        .withColumn("rank_within_year", F.dense_rank().over(w))
        .where(F.col("rank_within_year") <= k)
        .orderBy(cols.year, "rank_within_year", cols.condition)
    )


def weekly_totals(df: DataFrame, cols: Cols = COLS, out: str = "cases") -> DataFrame:
    return sum_by(df, [cols.year, cols.week], out, cols)


def yearly_peak(df: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Highest weekly total of each year and its week; the earliest week wins a tie."""
    peak = F.max(F.struct(F.col("cases"), (-F.col(cols.week)).alias("_neg")))
    return (
        weekly_totals(df, cols)
        .groupBy(cols.year)
        .agg(peak.alias("_peak"))
        .select(cols.year, F.col("_peak.cases").alias("peak_cases"), (-F.col("_peak._neg")).alias("peak_week"))
        .orderBy(cols.year)
    )


def recent_change(df: DataFrame, days: int = 28, cols: Cols = COLS) -> DataFrame:
    """Per area: cases of the last ``days`` days, of the ``days`` before, and the change.

    The input is summed once per area and date; the last date is a scalar subquery over those sums, which
    reuses their shuffle. An area without recent cases keeps its row.
    """
    dated = df.where(F.col(cols.date).isNotNull()).select(cols.area, cols.date, cols.count)
    dated = dated.groupBy(cols.area, cols.date).agg(F.sum(cols.count).alias(cols.count), F.count("*").alias("_n"))
    dated = dated.where("_n > 0")
    # Both plans need the sums, so that both have the same shuffle.
    known = F.coalesce(F.col(cols.count), F.col("_n")).isNotNull()
    latest = dated.agg(F.max(F.when(known, F.col(cols.date)))).scalar()
    date = F.col(cols.date)
    recent = date >= F.date_sub(latest, days - 1)
    previous = date.between(F.date_sub(latest, 2 * days - 1), F.date_sub(latest, days))
    weeks = days // 7
    now, before = f"recent_{weeks}w", f"previous_{weeks}w"
    zero = F.lit(0).cast(df.schema[cols.count].dataType)
    value = F.coalesce(F.col(cols.count), zero)
    return (
        dated.groupBy(cols.area)
        .agg(
            F.sum(F.when(recent, value).otherwise(zero)).alias(now),
            F.sum(F.when(previous, value).otherwise(zero)).alias(before),
        )
        .withColumn("absolute_change", F.col(now) - F.col(before))
        .orderBy(F.col("absolute_change").desc(), F.col(now).desc(), cols.area)
    )


def category_ratio(
    df: DataFrame,
    numerator: str = "male",
    denominator: str = "female",
    categories: Sequence[str] = ("male", "female", "total"),
    cols: Cols = COLS,
) -> DataFrame:
    """Yearly sums per category and the ratio of two of them; null when the divisor is 0."""
    wide = pivot_category(df, [cols.year], categories, cols)
    ratio = F.try_divide(F.col(f"`{numerator}`").cast("double"), F.col(f"`{denominator}`"))
    return wide.withColumn(f"{numerator}_{denominator}_ratio", ratio).orderBy(cols.year)


def area_ranking(df: DataFrame, cols: Cols = COLS, out: str = "cases") -> DataFrame:
    """Areas by total cases, highest first; ties by name."""
    return sum_by(df, [cols.area], out, cols).orderBy(F.col(out).desc(), cols.area)


def area_week_profile(
    df: DataFrame, cols: Cols = COLS, out: str = "weekly_cases", by: Sequence[str] = ()
) -> DataFrame:
    """Cases per area and week, of all years together or for each value of ``by``."""
    keys = [*by, cols.area, cols.week]
    return sum_by(df, keys, out, cols).orderBy(*keys)


def sum_numeric_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of every numeric column per key, under its own name."""
    numeric = [f.name for f in df.schema if f.name not in keys and f.dataType.typeName() in _NUMERIC]
    return df.groupBy(*keys).agg(*[null_safe_sum(F.col(f"`{c}`")).alias(c) for c in numeric])


_NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")


def newest_period_counts(df: DataFrame, n: int = 5, cols: Cols = COLS) -> DataFrame:
    """Rows per period, the newest ``n`` periods."""
    return (
        df.groupBy(cols.year, cols.week)
        .agg(F.count("*").alias("rows"))
        .orderBy(F.col(cols.year).desc(), F.col(cols.week).desc())
        .limit(n)
    )


def first_rows(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int = 20) -> DataFrame:
    """Projection in order, first ``n`` rows."""
    return df.select(*columns).orderBy(*order).limit(n)


def order_for_output(df: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Chronological order over the sort keys the table has, nulls last."""
    keys = [F.col(c).asc_nulls_last() for c in cols.output_order if c in df.columns]
    return df.orderBy(*keys) if keys else df
