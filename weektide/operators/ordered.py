"""Neighbour and carry-forward over ordered rows without one task per group.

A plain window puts a whole group into one task. Here a group is cut into chunks of consecutive
row numbers: the window runs per chunk, so its size is bounded by the chunk and not by the group.
What crosses a chunk border travels as one row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 4096
_CHUNK = "_chunk"


def with_next_row(
    df: DataFrame, group: list[str], order: str, column: str, out: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add the value ``column`` has in row ``order + 1`` of the group; null when there is no such row.

    The first row of a chunk also goes to the chunk before it, so one shuffle answers all rows.
    Adds ``_chunk`` and ``_last_in_chunk`` (the highest row number of the chunk); the result is
    partitioned by group and chunk.
    """
    own = F.floor(F.col(order) / chunk_rows).cast("int")
    is_border = (F.col(order) % chunk_rows == 0) & (F.col(order) > 0)
    chunks = F.when(is_border, F.array(own, own - 1)).otherwise(F.array(own))
    spread = df.select("*", F.explode(chunks).alias(_CHUNK))
    w = Window.partitionBy(*group, _CHUNK).orderBy(order)
    follows = F.lead(order).over(w) == F.col(order) + 1
    return (
        spread.withColumn(out, F.when(follows, F.lead(column).over(w)))
        .withColumn("_last_in_chunk", F.max(order).over(Window.partitionBy(*group, _CHUNK)))
        .where(F.col(_CHUNK) == own)
    )


def carry_forward(df: DataFrame, group: list[str], order: str, column: str, out: str) -> DataFrame:
    """Add the last non-null value of ``column`` up to and including the row.

    Expects the ``_chunk`` column of :func:`with_next_row` and reuses its partitioning. A table
    of one row per chunk carries values from chunk to chunk.
    """
    inside = Window.partitionBy(*group, _CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    here = df.withColumn(out, F.last(column, ignorenulls=True).over(inside))
    before = Window.partitionBy(*group).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    last_in_chunk = F.max_by(column, F.when(F.col(column).isNotNull(), F.col(order)))
    border = (
        df.groupBy(*group, _CHUNK)
        .agg(last_in_chunk.alias("_end"))
        .withColumn("_carried", F.last("_end", ignorenulls=True).over(before))
        .where((F.col(_CHUNK) > 0) & F.col("_carried").isNotNull())
        .select(*group, _CHUNK, "_carried")
    )
    return (
        here.join(border, [*group, _CHUNK], "left")
        .withColumn(out, F.coalesce(out, "_carried"))
        .drop("_carried", _CHUNK)
    )


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    A plain projection is merged into every filter and projection that uses it; the one-element
    ``inline`` keeps costly array work in one place.
    """
    fields = [column.alias(name) for name, column in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))


def cell(cells: Column | str, position: Column | int) -> Column:
    """Cell at a 0-based position; null when the row is shorter."""
    at = F.lit(position) if isinstance(position, int) else position
    return F.try_element_at(cells, (at + 1).cast("int"))
