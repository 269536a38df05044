"""Year-to-date reports -> weekly values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weektide.model import COLS, Cols

_COPIES_PER_STEP = 10_000


def weekly_value(cumulative: Column, previous: Column, week: Column) -> Column:
    """Cases of the week itself: the rise of the year's total, which stands at zero before week 1.

    Null where no rise is known: a total is missing, or it falls.
    """
    rise = cumulative - F.when(week == 1, 0).otherwise(previous)
    return F.when(F.coalesce(rise >= 0, F.lit(False)) | (week == 1), rise)


def weekly_rate(weekly: Column, cumulative: Column, rate: Column) -> Column:
    """Weekly cases per reporting site; the total and its rate tell the number of sites.

    No cases are a rate of 0 whatever the sites; otherwise positive totals and rates are needed.
    """
    sites = F.when(F.least(cumulative, rate) > 0, F.try_divide(cumulative, rate))
    return F.coalesce(F.try_divide(weekly, sites), F.when(weekly == 0, 0.0))


def cumulative_to_weekly(df: DataFrame, cols: Cols = COLS, unique: bool = False) -> DataFrame:
    """Difference cumulative counts within (year, area, condition); rates follow the implied sites.

    The step is taken against the previous row of the series, so a missing week gives a value over
    several weeks. A table without the needed columns is returned as it is.

    A series of unique weeks has at most 53 rows, so the window stays small; say ``unique=True``
    when that is known and one shuffle is enough. Otherwise exact copies are first folded into one
    row with a counter (before the shuffle) and unfolded at the end: a copy repeats its
    predecessor, so its step is 0.
    """
    needed = {*cols.series, cols.week, cols.count}
    if not needed <= set(df.columns):
        return df
    names = df.columns
    rows = df if unique else df.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count("*").alias("_copies"))

    first = [c for c in (cols.week, cols.date, cols.count) if c in names]
    rest = [c for c in names if c not in first and c not in cols.series]
    w = Window.partitionBy(*cols.series).orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in first + rest])
    out = rows.withColumn("_prev", F.lag(cols.count).over(w))
    if not unique:
        out = _unfold(out, "_copies").withColumn(
            "_prev", F.when(F.col("_copy") == 1, F.col("_prev")).otherwise(F.col(cols.count))
        )

    return _weekly(out, cols).select(*[F.col(f"`{c}`") for c in names])


def _unfold(df: DataFrame, copies: str) -> DataFrame:
    """Repeat rows by their counter, numbered from 1 in ``_copy``; long runs go in steps."""
    n, size = F.col(copies), F.lit(_COPIES_PER_STEP)
    steps = df.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / size))))
    start = F.col("_step") * size
    return steps.withColumn("_copy", F.explode(F.sequence(start + 1, F.least(n, start + size))))


def last_values(rows: DataFrame, cols: Cols = COLS) -> DataFrame:
    """State of each series: its last week, and the cumulative count that it then stood at."""
    last = F.max(F.struct(F.col(cols.week).alias("week"), F.col(cols.count).alias("count"))).alias("last")
    return rows.where(F.col(cols.week).isNotNull()).groupBy(*cols.series).agg(last).select(
        *cols.series, F.col("last.week").alias("last_week"), F.col("last.count").alias("last_count")
    )


def weekly_on_arrival(
    new: DataFrame, history: DataFrame, state: DataFrame, cols: Cols = COLS
) -> tuple[DataFrame, DataFrame]:
    """(changed weekly rows, new state) when cumulative reports arrive for series that have begun already.

    ``history``: the cumulative rows so far, one per (series, week); ``state``: :func:`last_values` of them;
    ``new``: rows that arrive, one per (series, week), which replace those of the same week. A series that
    only goes on is differenced from its state, without its history. Only series that are restated, by a
    report for a week at or before the last one, are read and differenced anew. The changed rows hold, for
    each (series, week), what :func:`cumulative_to_weekly` of all rows holds; a row that is not among them
    has not changed.
    """
    names = new.columns
    series = list(cols.series)
    first = new.groupBy(*series).agg(F.min(cols.week).alias("_first"))
    told = first.join(state, series, "left").withColumn("_restated", F.coalesce(F.col("_first") <= F.col("last_week"), F.lit(False)))
    marked = new.join(told.drop("_first", "last_week"), series)
    w = Window.partitionBy(*series).orderBy(cols.week)
    goes_on = marked.where(~F.col("_restated")).withColumn(
        "_prev", F.when(F.row_number().over(w) == 1, F.col("last_count")).otherwise(F.lag(cols.count).over(w))
    )
    restated = told.where("_restated").select(*series)
    old = history.select(*names).join(restated, series, "left_semi").join(new.select(*series, cols.week), [*series, cols.week], "left_anti")
    whole = old.unionByName(marked.where("_restated").select(*names)).withColumn("_prev", F.lag(cols.count).over(w))
    changed = _weekly(goes_on.select(*names, "_prev").unionByName(whole.select(*names, "_prev")), cols).select(*names)
    # A later report moves the state on; a restated last week changes its value.
    moved = last_values(whole.unionByName(goes_on.select(*names, "_prev")), cols)
    kept = state.join(moved.select(*series), series, "left_anti")
    return changed, kept.unionByName(moved)


def _weekly(rows: DataFrame, cols: Cols) -> DataFrame:
    """Rows with their previous count in ``_prev`` -> weekly counts and rates."""
    cumulative = F.col(cols.count)
    out = rows.withColumn("_weekly", weekly_value(cumulative, F.col("_prev"), F.col(cols.week)))
    if cols.rate in rows.columns:
        out = out.withColumn(cols.rate, weekly_rate(F.col("_weekly"), cumulative, F.col(cols.rate)))
    return out.withColumn(cols.count, F.col("_weekly"))
