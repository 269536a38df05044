"""Wide <-> long."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weektide.functions import text
from weektide.model import COLS, Cols

SEPARATOR = "||"


def _names(df: DataFrame, column: str, dimension: DataFrame | None) -> list:
    """Values that become columns, from the dimension, or else from the table itself: a job, as the columns of a
    table must be known to name them."""
    source = (df if dimension is None else dimension).select(column)
    rows = source.where(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def _twice(name: Column, kind: T.DataType) -> Column:
    return F.raise_error(F.concat(F.lit("More than one value of "), name, F.lit(" for one key"))).cast(kind)


def pivot_long(
    df: DataFrame,
    value: str = "cases",
    conditions: Sequence[str] | None = None,
    cols: Cols = COLS,
    dimension: DataFrame | None = None,
) -> DataFrame:
    """One column per condition; two values for one cell are an error.

    The names come from ``conditions``; else from ``dimension``, a small table of conditions that is kept
    with the data, such as its stored coverage; else the table is read for them first (one job).
    """
    names = list(conditions) if conditions is not None else _names(df, cols.condition, dimension)
    wide = df.groupBy(*cols.period).pivot(cols.condition, names).agg(F.max(value).alias("v"), F.count(F.lit(1)).alias("n"))
    kind = df.schema[value].dataType

    def single(name: str):
        return F.when(F.col(f"`{name}_n`") > 1, _twice(F.lit(name), kind)).otherwise(F.col(f"`{name}_v`")).alias(name)

    return wide.select(*cols.period, *map(single, names))


def pivot_map(df: DataFrame, value: str = "cases", cols: Cols = COLS) -> DataFrame:
    """(area, year, week, date, cells): the values of a key as a map from condition, sorted by condition.

    The wide table without its columns: nothing needs to be known of the conditions. Two values for one cell
    are an error; rows without condition have no cell.
    """
    named = df.where(F.col(cols.condition).isNotNull())
    cell = named.groupBy(*cols.period, cols.condition).agg(F.max(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    kind = df.schema[value].dataType
    single = F.when(F.col("_n") > 1, _twice(F.col(cols.condition), kind)).otherwise(F.col("_v"))
    entries = F.sort_array(F.collect_list(F.struct(F.col(cols.condition).alias("key"), single.alias("value"))))
    return cell.groupBy(*cols.period).agg(F.map_from_entries(entries).alias("cells"))


def map_columns(df: DataFrame, dimension: DataFrame | Sequence[str], cols: Cols = COLS) -> DataFrame:
    """Cells of :func:`pivot_map` -> one column per condition of the dimension."""
    names = _names(df, cols.condition, dimension) if isinstance(dimension, DataFrame) else list(dimension)
    return df.select(*cols.period, *[F.try_element_at("cells", F.lit(n)).alias(n) for n in names])


def unpivot_wide(
    df: DataFrame,
    value: str = "cases",
    columns: Sequence[str] | None = None,
    ids: Sequence[str] | None = None,
    variable: str | None = None,
    cols: Cols = COLS,
) -> DataFrame:
    """One row per value column. Numbers widen to double when their types differ; else text."""
    ids = list(ids if ids is not None else cols.period)
    columns = [c for c in df.columns if c not in ids] if columns is None else list(columns)
    types = {f.name: f.dataType for f in df.schema if f.name in columns}
    if len(set(types.values())) > 1:
        common = T.DoubleType() if all(isinstance(t, T.NumericType) for t in types.values()) else T.StringType()
        df = df.withColumns({c: F.col(f"`{c}`").cast(common) for c in columns})
    return df.unpivot(ids, [F.col(f"`{c}`") for c in columns], variable or cols.condition, value)


def pivot(
    df: DataFrame,
    value: str = "cases",
    conditions: Sequence[str] | None = None,
    cols: Cols = COLS,
    dimension: DataFrame | None = None,
) -> DataFrame:
    """Long -> wide when the table has a condition and a value column, else wide -> long."""
    if cols.condition in df.columns and value in df.columns:
        return pivot_long(df, value, conditions, cols, dimension)
    missing = [c for c in cols.period if c not in df.columns]
    if missing:
        raise ValueError(
            f"Nothing to pivot: no '{cols.condition}' and '{value}' columns, and key columns are missing: "
            + ", ".join(missing)
        )
    return unpivot_wide(df, value, cols=cols)


def split_headers(df: DataFrame, value: str | None = None, cols: Cols = COLS) -> DataFrame:
    """Wide table with ``condition||category`` columns -> long; numbered duplicates are left out.

    A table without such columns is returned as it is.
    """
    value = value or cols.count
    headers = [c for c in df.columns if SEPARATOR in c and not re.search(r"_[0-9]+$", c)]
    if not headers:
        return df
    ids = [c for c in df.columns if c in cols.period]
    cells = []
    for header in headers:
        name, category = header.split(SEPARATOR)[:2]
        cells.append(
            F.struct(
                F.col(f"`{header}`").alias(value),
                # A literal: folded while planning, not computed per row.
                text.normalize_name(F.lit(name)).alias(cols.condition),
                F.lit(category).alias(cols.category),
            )
        )
    return df.select(*ids, F.inline(F.array(*cells)))


def unpivot_pairs(
    df: DataFrame,
    ids: Sequence[str],
    pairs: Sequence[tuple[str, str, str | None]],
    cols: Cols = COLS,
) -> DataFrame:
    """(name, count column, rate column) triples -> one row each; a pair may lack its rate."""
    def number(name: str | None):
        return (F.col(f"`{name}`") if name else F.lit(None)).cast("double")

    structs = [
        F.struct(
            F.lit(name).alias(cols.condition), number(count).alias(cols.count), number(rate).alias(cols.rate)
        )
        for name, count, rate in pairs
    ]
    return df.select(*ids, F.inline(F.array(*structs)))


def pivot_category(
    df: DataFrame,
    keys: Sequence[str],
    categories: Sequence[str] | None = None,
    cols: Cols = COLS,
    dimension: DataFrame | None = None,
) -> DataFrame:
    """Sum of counts per key, one column per category; a category without rows is null.

    The categories come from ``categories``, else from a small table ``dimension``, else from the table.
    """
    names = list(categories) if categories is not None else _names(df, cols.category, dimension)
    total = F.sum(F.coalesce(F.col(cols.count), F.lit(0)))
    return df.groupBy(*keys).pivot(cols.category, names).agg(total)


def derive_complement(
    df: DataFrame,
    whole: str = "total",
    part: str = "male",
    derived: str = "female",
    cols: Cols = COLS,
) -> DataFrame:
    """Append ``derived = whole - part`` where both are reported.

    Nothing is added when the derived category occurs anywhere in the table, or when one of the
    other two occurs nowhere; that test is a scalar subquery, so the result stays lazy.
    """
    keys = [c for c in (*cols.period, cols.condition, cols.source) if c in df.columns]
    category = F.col(cols.category)

    def total(name: str):
        return F.sum(F.when(category == name, F.coalesce(F.col(cols.count), F.lit(0))))

    sums = (
        df.where(category.isin(whole, part, derived))
        .groupBy(*keys)
        .agg(total(whole).alias("_whole"), total(part).alias("_part"), total(derived).alias("_derived"))
    )
    # From the sums of a key it is known what it reports; this reads the same shuffle as the rows below.
    some = lambda name: F.coalesce(F.bool_or(F.col(name).isNotNull()), F.lit(False))
    wanted = sums.agg((~some("_derived") & some("_whole") & some("_part")).alias("wanted")).scalar()
    both = F.col("_whole").isNotNull() & F.col("_part").isNotNull() & F.col("_derived").isNull()
    extra = sums.where(both & wanted).select(
        *keys,
        F.lit(derived).alias(cols.category),
        (F.col("_whole") - F.col("_part")).cast(df.schema[cols.count].dataType).alias(cols.count),
    )
    return df.unionByName(extra, allowMissingColumns=True)
