"""Joins, unions and first-wins de-duplication."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weektide.model import COLS, Cols, area_codes, observation_schema


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


# -- wide-table merge -------------------------------------------------------------------------


# What the headers of a table of each kind speak of, and the words that it shares with another kind.
CATEGORIES_OF_KIND = {"sex": {"male", "female"}, "place": {"japan", "imported", "others", "unknown"}}
SHARED_WORDS = {
    "place": {"Unknown": "Unknown place", "Others": "Other places"},
    "bullet": {"weekly": "total"},
}


def table_kind(columns: Sequence[str], cols: Cols = COLS, value: str = "cases") -> str | None:
    """Kind of a table by the categories that its headers name; None if they name none, or those of two kinds."""
    if cols.condition in columns and value in columns:
        return "long"
    words = {w for c in columns if c not in cols.period for w in re.findall("[a-z]+", c.lower())}
    kinds = [kind for kind, categories in CATEGORIES_OF_KIND.items() if words & categories]
    if not kinds and words & {"weekly", "cumulative"}:
        return "bullet"
    return kinds[0] if len(kinds) == 1 else None


def align_names(df: DataFrame, cols: Cols = COLS, kind: str | None = None) -> DataFrame:
    """Rename value columns whose words mean something else in a table of another kind."""
    words = SHARED_WORDS.get(kind or table_kind(df.columns, cols) or "", {})
    if not words:
        return df
    pattern = re.compile("|".join(rf"\b{w}\b" for w in words))
    return df.toDF(*(c if c in cols.period else pattern.sub(lambda m: words[m[0]], c) for c in df.columns))


def merge(
    *dfs: DataFrame,
    cols: Cols = COLS,
    suffix: str = "_right",
    kinds: Sequence[str | None] = (),
    unique: bool = False,
) -> DataFrame:
    """Full outer merge of the first two tables on (area, year, week, date); further ones are appended.

    ``kinds`` of the tables (sex, place, bullet, long) may be given; else their headers tell.
    A value column that both tables have gets ``suffix`` on the second one. Rows with a null key
    match nothing; they bypass the merge instead of meeting in one shuffle partition.

    With ``unique`` each table has one row per key at most, as wide report tables do: the two are then
    folded per key without a join, and a key that a table has twice is an error. Otherwise equal keys
    give all combinations of their rows.
    """
    if len(dfs) < 2:
        raise ValueError("merge needs at least two tables")
    told = [*kinds, *[None] * len(dfs)]
    left, right, *rest = [align_names(df, cols, kind) for df, kind in zip(dfs, told, strict=False)]
    keys = list(cols.period)
    clash = {c: c + suffix for c in right.columns if c in left.columns and c not in keys}
    right = right.withColumnsRenamed(clash)
    whole_key = reduce(lambda a, b: a & b, [_quoted(k).isNotNull() for k in keys])
    sides = left.where(whole_key), right.where(whole_key)
    out = fold_per_key(*sides, keys=keys) if unique else sides[0].join(sides[1], keys, "full")
    for part in (left.where(~whole_key), right.where(~whole_key), *rest):
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def fold_per_key(*dfs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer merge of tables with one row per key each: a tagged union, folded per key.

    The fold begins before the shuffle, so a task sends one row for each of its keys, however many
    copies a faulty table holds. A key that one table has twice raises an error that names it. The tables
    must not share value columns; null keys are equal.
    """
    keys = list(keys)
    marks = [f"_rows_{n}" for n in range(len(dfs))]
    tagged = [
        df.withColumns({m: F.lit(1 if k == n else 0).cast("long") for k, m in enumerate(marks)}) for n, df in enumerate(dfs)
    ]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    values = [c for c in both.columns if c not in keys and c not in marks]
    if len(values) < sum(len(df.columns) - len(keys) for df in dfs):
        raise ValueError("Tables share value columns")
    folded = both.groupBy(*map(_quoted, keys)).agg(
        *[F.first(_quoted(c), ignorenulls=True).alias(c) for c in values], *[F.sum(m).alias(m) for m in marks]
    )
    key = F.concat_ws(", ", *[_quoted(k).cast("string") for k in keys])
    twice = reduce(lambda a, b: a | b, [F.col(m) > 1 for m in marks])
    problem = F.raise_error(F.concat(F.lit("More than one row for a key: "), key)).cast("boolean")
    return folded.where(F.when(twice, problem).otherwise(True)).select(*map(_quoted, [*keys, *values]))


# -- dimensions -------------------------------------------------------------------------------


def attach_dimension(df: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Left join to a dimension with one row per key; unmatched rows get nulls.

    Spark decides by the size that it measures whether the dimension is broadcast.
    """
    return df.join(dimension, on, "left")


def attach_prefecture_id(
    df: DataFrame,
    *,
    prefecture_col: str = "prefecture",
    id_col: str = "prefecture_id",
    codes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add the ISO code of the area; the fixed map is a literal, so there is no join."""
    pairs = F.create_map(*[F.lit(v) for kv in (codes or area_codes()).items() for v in kv])
    return df.withColumn(id_col, F.try_element_at(pairs, _quoted(prefecture_col)))


def alias_join(df: DataFrame, aliases: DataFrame, column: str) -> DataFrame:
    """Replace names by a lookup table ``(raw, canonical)``; unknown names stay."""
    side = aliases.select(F.col("raw").alias(column), "canonical")
    out = attach_dimension(df, side, column)
    return out.withColumn(column, F.coalesce("canonical", column)).drop("canonical").select(*df.columns)


# -- unions -----------------------------------------------------------------------------------


def to_observations(df: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Align a table to the observation schema: missing columns are null, types are cast."""
    have = set(df.columns)
    return df.select(
        *[
            (_quoted(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in observation_schema(cols)
        ]
    )


def union_relaxed(*dfs: DataFrame) -> DataFrame:
    """Union by name: missing columns are null, numbers widen to their common type.

    A column that is text in one table and a number in another becomes text, since the engine would
    otherwise try to read the text as a number.
    """
    kinds: dict[str, set[str]] = {}
    for df in dfs:
        for f in df.schema:
            kinds.setdefault(f.name, set()).add(f.dataType.typeName())
    as_text = {name for name, k in kinds.items() if "string" in k and k - {"string", "void"}}
    aligned = [df.withColumns({c: _quoted(c).cast("string") for c in df.columns if c in as_text}) for df in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def union_strict(*dfs: DataFrame) -> DataFrame:
    """Union of tables with the same columns; anything else is an error."""
    names = dfs[0].columns
    for df in dfs[1:]:
        if sorted(df.columns) != sorted(names):
            raise ValueError(f"Tables have different columns: {names} and {df.columns}")
    return reduce(DataFrame.unionByName, dfs)


def default_category(df: DataFrame, cols: Cols = COLS, value: str = "total") -> DataFrame:
    """Rows without a category belong to the total."""
    if cols.category not in df.columns:
        return df
    return df.withColumn(cols.category, F.coalesce(cols.category, F.lit(value)))


def absent_from(secondary: DataFrame, primary: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Secondary rows of conditions the primary table never reports; rows without one are dropped.

    An anti-join with the distinct conditions, folded before the shuffle.
    """
    known = primary.select(cols.condition).where(F.col(cols.condition).isNotNull()).distinct()
    named = secondary.where(F.col(cols.condition).isNotNull())
    return named.join(known, cols.condition, "left_anti").select(*secondary.columns)


def prefer_primary(primary: DataFrame, secondary: DataFrame, cols: Cols = COLS) -> DataFrame:
    """All primary rows, plus secondary rows of conditions the primary table never reports."""
    return union_relaxed(primary, absent_from(secondary, primary, cols))


def dedup_first(
    df: DataFrame,
    priority: Column | None = None,
    keys: Sequence[str] | None = None,
    cols: Cols = COLS,
) -> DataFrame:
    """One row per key: the one with the lowest priority; ties by the remaining columns, so the
    choice does not depend on how the data is partitioned.

    ``row_number() = 1`` is limited per task before the shuffle, so a key with many copies sends at
    most one row per task.
    """
    keys = list(keys if keys is not None else cols.key)
    rest = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys]
    order = ([priority.asc_nulls_last()] if priority is not None else []) + rest
    w = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def ordered_sources(*dfs: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Union of sources in order of precedence, first wins per key."""
    tagged = [to_observations(df, cols).withColumn("_order", F.lit(i)) for i, df in enumerate(dfs)]
    return dedup_first(union_strict(*tagged), F.col("_order"), cols=cols).drop("_order")
