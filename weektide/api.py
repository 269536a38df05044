"""Query API over a catalog of tables. DataFrames are lazy; only the lists and the latest week collect."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from weektide.model import COLS, Cols, area_codes
from weektide.operators import aggregate, filters, grid
from weektide.sources import reports
from weektide.sources.catalog import Catalog


def load(catalog: Catalog, name: str) -> DataFrame:
    """Table by name or alias."""
    return catalog.load(name)


def get_data(
    catalog: Catalog,
    disease: str | Iterable[str] | None = None,
    prefecture: str | Iterable[str] | None = None,
    year: int | tuple[int, int] | None = None,
    week: int | tuple[int, int] | None = None,
    source: str = "all",
    literal: bool = False,
) -> DataFrame:
    """Observations with optional filters; see :func:`weektide.operators.filters.select_observations`."""
    return filters.select_observations(
        catalog.observations(), disease, prefecture, year, week, source, catalog.cols, literal=literal
    )


def _listed(df: DataFrame) -> list:
    """All values, fetched partition by partition; for very many the table form is the better one."""
    return [r[0] for r in df.toLocalIterator()]


def diseases(catalog: Catalog, source: str = "all") -> DataFrame:
    """Sorted condition names, as a table."""
    return aggregate.distinct_values(get_data(catalog, source=source), catalog.cols.condition)


def prefectures(catalog: Catalog) -> DataFrame:
    """Sorted area names, as a table."""
    return aggregate.distinct_values(get_data(catalog), catalog.cols.area)


def list_diseases(catalog: Catalog, source: str = "all") -> list[str]:
    return _listed(diseases(catalog, source))


def list_prefectures(catalog: Catalog) -> list[str]:
    return _listed(prefectures(catalog))


def get_latest_week(catalog: Catalog) -> tuple[int, int] | None:
    """Last (year, week), or None for an empty table or one without periods."""
    df, cols = get_data(catalog), catalog.cols
    if cols.year not in df.columns or cols.week not in df.columns:
        return None
    row = aggregate.latest_period(df, cols).first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def prefecture_map() -> dict[str, str]:
    """Area name -> ISO 3166-2 code."""
    return area_codes()


def read(
    spark: SparkSession,
    source: str | DataFrame,
    type: str | None = None,
    weeks: Iterable[int] | None = None,
    year: int | None = None,
    cols: Cols = COLS,
) -> DataFrame:
    """Raw reports -> long table.

    ``source`` is a path of weekly CSV files, a table of their rows (``file, rows, error``), or a
    cell-grid table (``file, sheet, row_idx, cells``) for the yearly workbooks. The
    layout of each CSV file is taken from its own name, so that a folder may hold both. With ``type``, only
    the files of that layout in a folder are read, and a single file is read as told. What is left out,
    and why, is told by :func:`weektide.operators.grid.quarantine`.
    """
    weeks = None if weeks is None else sorted({int(w) for w in weeks})
    if isinstance(source, DataFrame):
        if type is None:
            raise ValueError("A table needs 'type'")
        cells = source
    else:
        single = source.lower().endswith((".csv", ".xls", ".xlsx"))
        if single and type is None:
            type = reports.detect_layout(source)
        if type in ("sex", "place"):
            raise ValueError("Workbooks are read from a cell-grid table")
        files = reports.of_weeks(reports.landing_files(spark, source), weeks)
        if type is None:
            return grid.files_to_long(files, cols, year=year, weeks=weeks)
        cells = reports.parse_contents(files if single else files.where(reports.layout_of("path") == type))
    if type == "bullet":
        return grid.bullet_to_long(cells, cols, year=year, weeks=weeks)
    if type == "sentinel":
        return grid.sentinel_to_long(cells, cols, year=year, weeks=weeks)
    if type in ("sex", "place"):
        return grid.workbook_to_long(cells, cols)
    raise ValueError(f"Unknown dataset type: {type}")

