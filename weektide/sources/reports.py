"""Raw report files -> rows of cells, and what their names and headers say about layout and period.

The only Python that runs on executors is here: decoding a file and splitting it into cells.
"""

from __future__ import annotations

import csv
import io
import os
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weektide.functions.calendar import weeks_in_year
from weektide.functions.text import strip
from weektide.model import FIRST_WORKBOOK_WEEK, FIRST_WORKBOOK_YEAR, REPORT_SCHEMA

# Fixed patterns of file names and of the header line.
YEAR_IN_NAME = r"((?:19|20)\d{2})"
YEAR_FOLDER = r"^((?:19|20)\d{2})$"
WEEK_IN_NAME = r"(?i)(?:zensu|teiten(?:rui)?)(\d{2})"
WEEK_BETWEEN_DASHES = r"(?:^|[-_])(\d{2})(?:[-_]|$)"
WEEK_HEADER = r"(?i)(\d+)(?:st|nd|rd|th)\s+week,\s*(\d{4})"
SENTINEL_NAME = r"(?i)teiten(?:rui)?"
WORKBOOK_NAMES = {
    "sex": r"(Syu_01_1|01_1)\.(xls|xlsx)$",
    "place": r"(Syu_02_1|02_1)\.(xls|xlsx)$",
    None: r"Syu_0[12]_1\.(xls|xlsx)$",
}
ENCODINGS = ("utf-8", "cp932")

_FILES_PER_BATCH = 64


def _parse(content: bytes, encodings: Iterable[str]) -> tuple[list[list[str]] | None, str | None]:
    """Rows of one file, or the reason there are none."""
    if not content:
        return None, "empty file"
    for encoding in encodings:
        try:
            decoded = content.decode(encoding)
        except UnicodeDecodeError:
            continue
        try:
            rows = list(csv.reader(io.StringIO(decoded, newline="")))
        except csv.Error as problem:
            return None, f"bad csv: {problem}"
        return rows, None
    return None, "undecodable text"


def split_files(encodings: Iterable[str] = ENCODINGS):
    """Batch function for ``mapInPandas``: (path, content) -> (file, rows, error)."""
    encodings = tuple(encodings)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), _FILES_PER_BATCH):
                part = batch.iloc[start : start + _FILES_PER_BATCH]
                parsed = [_parse(content, encodings) for content in part["content"]]
                yield pd.DataFrame(
                    {
                        "file": part["path"].to_numpy(),
                        "rows": [rows for rows, _ in parsed],
                        "error": [error for _, error in parsed],
                    }
                )

    return split


def read_reports(
    spark: SparkSession,
    path: str | list[str],
    weeks: Iterable[int] | None = None,
    encodings: Iterable[str] = ENCODINGS,
) -> DataFrame:
    """CSV reports -> ``(file, rows, error)``, one row per file; files are the unit of parallel work.

    A file that cannot be read gives one row with ``error`` set instead of failing the job; so does a file
    of no bytes. ``weeks`` leaves out the files whose layout takes the week from the name and whose name
    carries another week, before they are read; for all others the parsers filter on the week they resolve.
    """
    return parse_contents(of_weeks(landing_files(spark, path), weeks), encodings)


def of_weeks(files: DataFrame, weeks: Iterable[int] | None) -> DataFrame:
    """Files (path, ...) that may hold one of the weeks. The header of a sentinel report wins over its name."""
    if weeks is None:
        return files
    named = week_from_name("path")
    other = (layout_of("path") == "bullet") & ~named.isin(sorted({int(w) for w in weeks}))
    return files.where(~F.coalesce(other, F.lit(False)))


def parse_contents(files: DataFrame, encodings: Iterable[str] = ENCODINGS) -> DataFrame:
    """Files (path, content) -> ``(file, rows, error)``."""
    return files.select("path", "content").mapInPandas(split_files(encodings), REPORT_SCHEMA)


def stage_reports(files: DataFrame, path: str, encodings: Iterable[str] = ENCODINGS) -> DataFrame:
    """Decode files (path, content) once, into a table below ``path`` with a folder for each layout.

    What is read from it, ``(file, rows, error, layout)``, opens the folder of one layout when it is asked for
    that; ``unknown`` is the layout of files whose name does not tell.
    """
    layout = F.coalesce(layout_of("file"), F.lit("unknown")).alias("layout")
    parse_contents(files, encodings).select("*", layout).write.partitionBy("layout").parquet(path)
    return files.sparkSession.read.schema(f"{REPORT_SCHEMA}, layout string").parquet(path)


def landing_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The CSV files below a folder: (path, content)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    return found.load(path).select("path", "content")


def as_grid(reports: DataFrame) -> DataFrame:
    """Reports -> ``grid(file, sheet, row_idx, cells)``, one row per report row."""
    return reports.where("error IS NULL").select(
        "file", F.lit(0).alias("sheet"), F.posexplode("rows").alias("row_idx", "cells")
    )


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of the pattern; null when there is none."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(1))


def file_name(path: Column | str) -> Column:
    return F.regexp_extract(path, r"[^/]+$", 0)


def file_stem(path: Column | str) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def year_from_name(path: Column | str) -> Column:
    """Year in the file name, else the parent folder when it is named after a year."""
    folder = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return F.coalesce(_found(file_name(path), YEAR_IN_NAME), _found(folder, YEAR_FOLDER)).cast("int")


def week_from_name(path: Column | str) -> Column:
    """Week after the report name, else two digits between dashes or underscores."""
    stem = file_stem(path)
    return F.coalesce(_found(stem, WEEK_IN_NAME), _found(stem, WEEK_BETWEEN_DASHES)).cast("int")


def header_text(cells: Column | str) -> Column:
    """Non-blank cells of the header row, joined."""
    filled = F.filter(F.transform(cells, lambda c: strip(c)), lambda c: c != "")
    return F.array_join(filled, ", ")


def week_from_header(text: Column | str) -> Column:
    """Week of a header such as ``4th week, 2025``."""
    return _found(text, WEEK_HEADER, 1).cast("int")


def year_from_header(text: Column | str) -> Column:
    return _found(text, WEEK_HEADER, 2).cast("int")


def sheet_week(year: Column | str, sheet: Column | str) -> Column:
    """Week of a workbook sheet: the second sheet holds the first week of the year, or of the first workbook.

    Null for sheets that hold no week: the first one, and those beyond the last week of the calendar year.
    """
    y = F.col(year) if isinstance(year, str) else year
    s = F.col(sheet) if isinstance(sheet, str) else sheet
    week = s - 2 + F.when(y == FIRST_WORKBOOK_YEAR, FIRST_WORKBOOK_WEEK).otherwise(1)
    return F.when((s >= 2) & (week <= weeks_in_year(y)), week)


def layout_of(path: Column | str) -> Column:
    """Layout of one file by its name; null when the name does not tell."""
    name, stem = file_name(path), file_stem(path)
    return (
        F.when(name.endswith(".csv") & stem.rlike(SENTINEL_NAME), "sentinel")
        .when(name.endswith(".csv"), "bullet")
        .when(name.contains("Syu_01") | name.contains("sex"), "sex")
        .when(name.contains("Syu_02") | name.contains("place"), "place")
    )


def detect_layout(path: str) -> str:
    """Layout of one file name, decided before any job; an unknown name is an error."""
    stem, suffix = os.path.splitext(os.path.basename(path.rstrip("/")))
    name = stem + suffix
    if suffix == ".csv":
        return "sentinel" if re.search(SENTINEL_NAME, stem) else "bullet"
    if "Syu_01" in name or "sex" in name:
        return "sex"
    if "Syu_02" in name or "place" in name:
        return "place"
    raise ValueError(f"File names do not tell the report layout, give 'type': {path}")


def workbook_files(grid: DataFrame, kind: str | None = None) -> DataFrame:
    """Grid rows of the workbooks of one kind (``sex``, ``place`` or both)."""
    return grid.where(file_name("file").rlike(WORKBOOK_NAMES[kind]))
