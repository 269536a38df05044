"""Reports derived from the order tables, to run the parsers at any scale.

Orders stand for cases: area = nation of the customer, period = ISO week of the order date,
condition = priority, category = status. One weekly report, or one workbook sheet, per week; a
weekly report has one data row per nation.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.operators.ordered import with_computed

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SECOND_BLOCK_ROW = 60


def _cells(values: Sequence[str | Column | None]) -> Column:
    if any(isinstance(v, Column) for v in values):
        return F.array(*[(v if isinstance(v, Column) else F.lit(v)).cast("string") for v in values])
    texts = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return F.expr(f"CAST(array({texts}) AS array<string>)")


def _row(index: int, values: Sequence[str | Column | None]) -> Column:
    return F.struct(F.lit(index).alias("row_idx"), _cells(values).alias("cells"))


def _grid(headers: DataFrame, data: DataFrame) -> DataFrame:
    error = F.lit(None).cast("string").alias("error")
    columns = ["file", F.col("sheet").cast("int"), F.col("row_idx").cast("int"), "cells", error]
    return headers.select(*columns).unionByName(data.select(*columns))


def _week_file(head: str, tail: str) -> Column:
    week = F.lpad(F.col("week").cast("string"), 2, "0")
    return F.concat(F.lit(head), F.col("year"), F.lit(tail), week)


def _reports(obs: DataFrame, file: Column, header: Sequence[Column], data: Column) -> DataFrame:
    """One row per week: header rows, then the rows of the nations in the order of their numbers."""
    sums = [F.sum(F.when(F.col("cond") == p, F.col("cnt"))).alias(p) for p in PRIORITIES]
    wide = obs.groupBy("year", "week", "area", "nationkey").agg(*sums)
    rows = F.sort_array(F.collect_list(F.struct(F.col("nationkey"), data.alias("cells"))))
    return (
        wide.groupBy("year", "week")
        .agg(rows.alias("data"))
        .select(
            file.alias("file"),
            F.concat(F.array(*header), F.col("data.cells")).alias("rows"),
            F.lit(None).cast("string").alias("error"),
        )
    )


def as_files(reports: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """Reports (file, rows) -> (path, content), written as CSV."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            contents = []
            for rows in batch["rows"]:
                out = io.StringIO()
                csv.writer(out, lineterminator="\r\n").writerows(rows)
                contents.append(out.getvalue().encode(encoding))
            yield pd.DataFrame({"path": batch["file"], "content": contents})

    return reports.select("file", "rows").mapInPandas(write, "path string, content binary")


def bullet_reports(obs: DataFrame) -> DataFrame:
    """A value and an unnamed cumulative column per priority."""
    header = [
        _cells(["Table 1"]),
        _cells(["weekly report"]),
        _cells([""]),
        _cells(["Prefecture", *[c for p in PRIORITIES for c in (p, "")]]),
        _cells(["", *[c for _ in PRIORITIES for c in ("Current week", "Cum")]]),
        _cells(["Total No.", *["9"] * (2 * len(PRIORITIES))]),
    ]
    data = _cells([F.col("area"), *[c for p in PRIORITIES for c in (F.col(f"`{p}`"), "99")]])
    return _reports(obs, F.concat(_week_file("reports/", "/zensu"), F.lit(".csv")), header, data)


def english_reports(obs: DataFrame) -> DataFrame:
    """(count, rate) pairs; counts carry thousands commas, missing ones are dashes."""
    header = [
        _cells(["No. of cases, cases per sentinel"]),
        _cells([F.format_string("%dth week, %d", "week", "year"), "", "Created on time"]),
        _cells(["", *[c for p in PRIORITIES for c in (p, "")]]),
        _cells(["", *[c for _ in PRIORITIES for c in ("Current week", "per sentinel")]]),
        _cells(["Total No.", *["9"] * (2 * len(PRIORITIES))]),
    ]

    def pair(p: str) -> list[Column]:
        c = F.col(f"`{p}`")
        return [
            F.coalesce(F.format_number(c * 1000, 0), F.lit("-")),
            F.coalesce((c * 2).cast("string"), F.lit("")),
        ]

    data = _cells([F.col("area"), *[c for p in PRIORITIES for c in pair(p)]])
    return _reports(obs, F.concat(_week_file("reports/", "/teitenrui"), F.lit(".csv")), header, data)


def japanese_reports(obs: DataFrame) -> DataFrame:
    """The Japanese layout: bilingual names, dashes for no value."""
    header = [
        _cells(["報告数・定点当り報告数"]),
        _cells(["週報"]),
        _cells(["", *[c for p in PRIORITIES for c in (f"区分（{p}）", "")]]),
        _cells(["", *[c for _ in PRIORITIES for c in ("報告", "定当")]]),
        _cells(["総数", *["9"] * (2 * len(PRIORITIES))]),
    ]
    counts = [F.coalesce(F.col(f"`{p}`").cast("string"), F.lit("-")) for p in PRIORITIES]
    area = F.concat(F.lit("県 ("), F.col("area"), F.lit(")"))
    data = _cells([area, *[c for count in counts for c in (count, count)]])
    return _reports(obs, F.concat(_week_file("reports/", "-"), F.lit("-teiten.csv")), header, data)


def workbook_grid(obs: DataFrame) -> DataFrame:
    """One file per year, one sheet per week, two header blocks per sheet (3 and 2 priorities).

    Categories: total = all statuses, male = F, female = O. File and sheet are computed on what was counted: as
    plain columns they would let a reader's filters on them be worked out for every row before the counting.
    """
    place = {
        "file": F.concat(F.lit("books/Syu_01_1_"), F.col("year"), F.lit(".xlsx")),
        "sheet": F.when(F.col("year") == 1999, F.col("week") - 12).otherwise(F.col("week") + 1),
    }
    blocks = ((0, PRIORITIES[:3]), (SECOND_BLOCK_ROW, PRIORITIES[3:]))

    def header(base: int, names: Sequence[str]) -> list[Column]:
        width = 3 * len(names)
        return [
            # Old workbooks hold null bytes.
            _row(base + 1, [None, *[c for p in names for c in (F.lit(f"区分\0 ({p})"), None, None)]]),
            _row(base + 2, [None, *[F.lit("To\0tal"), "Male", F.lit("Fe\0male")] * len(names)]),
            _row(base + 3, ["Total No.", *["9"] * width]),
        ]

    head = F.inline(F.array(_row(0, ["title"]), *[r for base, names in blocks for r in header(base, names)]))
    sums = []
    for p in PRIORITIES:
        mine = F.col("cond") == p
        sums.append(F.sum(F.when(mine, F.col("cnt"))).alias(f"{p} all"))
        sums += [F.sum(F.when(mine & (F.col("source") == s), F.col("cnt"))).alias(f"{p} {s}") for s in ("F", "O")]
    wide = obs.groupBy("year", "week", "area", "nationkey").agg(*sums)

    def body(base: int, names: Sequence[str]) -> Column:
        cells = [F.col(f"`{p} {part}`").cast("string") for p in names for part in ("all", "F", "O")]
        return F.struct(
            (F.col("nationkey") + base + 4).alias("row_idx"), F.array(F.col("area"), *cells).alias("cells")
        )

    return _grid(
        with_computed(obs.select("year", "week").distinct(), place).select(*place, head),
        with_computed(wide, place).select(*place, F.inline(F.array(*[body(base, names) for base, names in blocks]))),
    )
