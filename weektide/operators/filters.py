"""Row and column selection."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.functions import text
from weektide.model import COLS, SOURCE_GROUPS, Cols

Range = int | tuple[int, int] | None


def by_source_group(
    df: DataFrame,
    group: str = "all",
    cols: Cols = COLS,
    groups: Mapping[str, Sequence[str]] = SOURCE_GROUPS,
) -> DataFrame:
    """Keep the sources of a group; ``all``, an unknown group or a table without sources keeps all."""
    if group == "all" or group not in groups or cols.source not in df.columns:
        return df
    return df.where(F.col(cols.source).isin(*groups[group]))


def _as_list(value: str | Iterable[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _matches(column: Column, patterns: str | Iterable[str], literal: bool) -> Column:
    low = F.lower(column)
    tests = [low.contains(p.lower()) if literal else low.rlike(p.lower()) for p in _as_list(patterns)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def match_conditions(
    df: DataFrame,
    patterns: str | Iterable[str],
    cols: Cols = COLS,
    literal: bool = False,
    dimension: DataFrame | None = None,
) -> DataFrame:
    """Rows whose condition matches any pattern, ignoring case; no pattern, or a null name, gives no row.

    Patterns are regular expressions unless ``literal``. A regular expression cannot be pushed into
    a Parquet scan; with a ``dimension`` of condition names the patterns run on the names only, and the
    rows are kept by a semi-join, which the adaptive plan broadcasts where the names are few.
    """
    if dimension is None:
        return df.where(_matches(F.col(cols.condition), patterns, literal))
    names = dimension.select(cols.condition).where(_matches(F.col(cols.condition), patterns, literal)).distinct()
    return df.join(names, cols.condition, "left_semi")


def in_areas(df: DataFrame, areas: str | Iterable[str], cols: Cols = COLS) -> DataFrame:
    """Exact, case-sensitive area match."""
    return df.where(F.col(cols.area).isin(_as_list(areas)))


def _in_range(column: str, wanted: int | tuple[int, int]) -> Column:
    if isinstance(wanted, tuple):
        return F.col(column).between(*wanted)
    return F.col(column) == wanted


def in_period(df: DataFrame, year: Range = None, week: Range = None, cols: Cols = COLS) -> DataFrame:
    """One year or week, or an inclusive (first, last) range of them."""
    if year is not None:
        df = df.where(_in_range(cols.year, year))
    if week is not None:
        df = df.where(_in_range(cols.week, week))
    return df


def select_observations(
    df: DataFrame,
    condition: str | Iterable[str] | None = None,
    area: str | Iterable[str] | None = None,
    year: Range = None,
    week: Range = None,
    source: str = "all",
    cols: Cols = COLS,
    groups: Mapping[str, Sequence[str]] = SOURCE_GROUPS,
    literal: bool = False,
    dimension: DataFrame | None = None,
) -> DataFrame:
    """All row filters of the query API, as one conjunction."""
    df = by_source_group(df, source, cols, groups)
    if condition is not None:
        df = match_conditions(df, condition, cols, literal, dimension)
    if area is not None:
        df = in_areas(df, area, cols)
    return in_period(df, year, week, cols)


def drop_totals(df: DataFrame, cols: Cols = COLS, style: str = "contains") -> DataFrame:
    """Drop rows that sum all areas, and rows without an area."""
    area = F.col(cols.area)
    return df.where(area.isNotNull() & (text.strip(area) != "") & ~text.is_total_row(area, style))


def drop_unnamed(df: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Drop rows without a condition name."""
    return df.where(F.col(cols.condition) != "")


def in_categories(df: DataFrame, categories: str | Iterable[str], cols: Cols = COLS) -> DataFrame:
    return df.where(F.col(cols.category).isin(_as_list(categories)))


def with_value(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all the columns are set."""
    return df.where(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in columns], F.lit(True)))


def exclude_years(df: DataFrame, other: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Rows of years that ``other`` does not cover; rows without a year are dropped.

    An anti-join with the distinct years, folded before the shuffle; nothing runs while the plan is built.
    """
    years = other.select(F.col(cols.year).alias("_year")).where("_year IS NOT NULL").distinct()
    return df.where(F.col(cols.year).isNotNull()).join(years, F.col(cols.year) == F.col("_year"), "left_anti")


def project(
    df: DataFrame,
    keep: Iterable[str] | None = None,
    rename: Mapping[str, str] | None = None,
    literals: Mapping[str, object] | None = None,
) -> DataFrame:
    """Select columns, rename them and add constant ones."""
    out = df.select(*keep) if keep is not None else df
    if rename:
        out = out.withColumnsRenamed(dict(rename))
    return out.withColumns({name: F.lit(v) for name, v in literals.items()}) if literals else out


def named_columns(df: DataFrame, generated: Sequence[str] = ("_duplicated_", "field_", r"_c\d+$")) -> DataFrame:
    """Drop columns whose header was made up by a CSV reader (unnamed, cumulative ones).

    ``generated``: expressions for the beginning of such a header.
    """
    made_up = re.compile("|".join(f"(?:{g})" for g in generated) or r"(?!)")
    keep = [c for c in df.columns if c.strip() and not made_up.match(c)]
    return df.select(*[F.col(f"`{c}`") for c in keep])
