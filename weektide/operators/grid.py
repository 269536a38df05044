"""Report layouts -> long observations.

A weekly CSV is one row (file, rows): its header is resolved inside arrays and its data rows are
exploded afterwards, so parsing needs one pass and no shuffle. A yearly workbook is a table of grid
rows (file, sheet, row_idx, cells): header blocks are found by chunked windows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.functions import calendar, numbers, text
from weektide.model import COLS, CONFIRMED, SENTINEL, Cols
from weektide.operators import combine
from weektide.operators.ordered import CHUNK_ROWS, carry_forward, cell, with_computed, with_next_row
from weektide.sources import reports

Aliases = Mapping[str, str] | None

SHEET = ["file", "sheet"]

# Fixed positions of the report layouts (0-based rows) and smallest usable sizes.
BULLET_HEADER_ROW, BULLET_FIRST_ROW = 3, 5
JA_NAME_ROW, JA_KIND_ROW, JA_FIRST_ROW = 2, 3, 4
MIN_ROWS_WORKBOOK, MIN_ROWS_EN, MIN_ROWS_JA = 5, 6, 5
METRIC_MARK = "current week"
CATEGORY_MARKS = ("male", "female", "japan", "others", "unknown")


def _readable(grid: DataFrame) -> DataFrame:
    return grid.where(F.col("error").isNull()) if "error" in grid.columns else grid


def _tail(cells: Column | str) -> Column:
    """Cells after the area column."""
    c = F.col(cells) if isinstance(cells, str) else cells
    return F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0)))


# -- workbook blocks ----------------------------------------------------------------------------


def _is_category_row(cleaned: str) -> Column:
    """A total and a category stand in the row of cleaned cells."""
    has_total = F.exists(cleaned, lambda c: F.lower(c).contains("total"))
    has_mark = F.exists(cleaned, lambda c: F.lower(c).rlike("|".join(CATEGORY_MARKS)))
    return F.coalesce(has_total, F.lit(False)) & F.coalesce(has_mark, F.lit(False))


def _has_names(cells: Column | str) -> Column:
    return F.exists(_tail(cells), lambda c: text.clean_cell(c).isNotNull())


def fill_header(names: Column, categories: Column, aliases: Aliases = None) -> Column:
    """Merged two-row header -> one struct(name, category) per column.

    ``categories`` are cleaned cells, ``names`` raw ones. The last name is carried to the right; a repeated (name, category) keeps its first column only,
    the others become null. Names are normalised last.
    """
    empty = F.array().cast("array<struct<name:string,category:string>>")
    pairs = F.zip_with(names, categories, lambda n, c: F.struct(n.alias("name"), c.alias("category")))

    def step(done: Column, pair: Column) -> Column:
        carried = F.try_element_at(done, F.lit(-1))["name"]
        return F.array_append(
            done,
            F.struct(
                F.coalesce(text.clean_cell(pair["name"]), carried, F.lit("Unknown")).alias("name"),
                text.classify_category(pair["category"]).alias("category"),
            ),
        )

    def first_only(filled: Column) -> Column:
        def named(h: Column, i: Column) -> Column:
            head = F.struct(text.normalize_name(h["name"], aliases).alias("name"), h["category"].alias("category"))
            return F.when(F.array_position(filled, h) == i + 1, head)

        return F.transform(filled, named)

    # The filled header is an array that is used for each of its columns: evaluated once.
    return F.transform(F.array(F.aggregate(pairs, empty, step)), first_only)[0]


def find_blocks(
    grid: DataFrame,
    aliases: Aliases = None,
    min_rows: int = MIN_ROWS_WORKBOOK,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Data rows of every header block, each with its header; sheets under ``min_rows`` are skipped.

    A header row has a name after the area column and is followed by a category row. Rows before
    the first header, the category rows and the headers themselves are left out.
    Result: file, sheet, block (row number of the header), row_idx, cells, header.

    Rows are shuffled by sheet and chunk: no operation here groups a whole sheet; one row per chunk carries
    a header over the borders. The cells of a row are cleaned once, before anything is looked for in them.
    """
    cleaned = with_computed(_readable(grid), {"_clean": F.transform(_tail("cells"), lambda c: text.clean_cell(c))})
    marked = cleaned.withColumn("_cat", F.when(_is_category_row("_clean"), F.col("_clean"))).drop("_clean")
    g = with_next_row(marked, SHEET, "row_idx", "_cat", "_next", chunk_rows).drop("_cat")
    head = F.when(
        F.col("_next").isNotNull() & _has_names("cells"),
        F.struct(
            F.col("row_idx").alias("row"), fill_header(_tail("cells"), F.col("_next"), aliases).alias("header")
        ),
    )
    rows = carry_forward(g.withColumn("_head", head).drop("_next"), SHEET, "row_idx", "_head", "_block")
    # Only the first rows can belong to a short sheet, and their chunk tells how long it is.
    long_enough = (F.col("row_idx") >= min_rows - 1) | (F.col("_last_in_chunk") >= min_rows - 1)
    return rows.where((F.col("row_idx") >= F.col("_block.row") + 2) & long_enough).select(
        *SHEET, F.col("_block.row").alias("block"), "row_idx", "cells", F.col("_block.header").alias("header")
    )


def block_cells(blocks: DataFrame, cols: Cols = COLS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per data cell of the blocks: area, condition, category, raw text. Totals are dropped."""
    zipped = F.zip_with(
        "header",
        _tail("cells"),
        lambda h, v: F.struct(
            h["name"].alias(cols.condition), h["category"].alias(cols.category), v.alias("raw")
        ),
    )
    return (
        with_computed(blocks, {cols.area: text.clean_cell(cell("cells", 0))})
        .where(F.col(cols.area).isNotNull() & ~text.is_total_row(cols.area, "contains"))
        .select(*SHEET, "block", *keep, cols.area, F.inline(zipped))
        .where(F.col(cols.category).isNotNull())
    )


def workbook_to_long(
    grid: DataFrame,
    cols: Cols = COLS,
    aliases: Aliases = None,
    anchor: str = "sunday",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Yearly workbook (one sheet per week) -> long confirmed cases."""
    year = reports.year_from_name("file")
    week = reports.sheet_week(cols.year, "sheet")
    weeks = _readable(grid).where(reports.sheet_week(year, "sheet").isNotNull())
    blocks = find_blocks(weeks.select(*SHEET, "row_idx", "cells"), aliases, chunk_rows=chunk_rows)
    dated = with_computed(blocks, {cols.year: year})
    dated = with_computed(
        dated, {cols.week: week, cols.date: calendar.week_date(cols.year, week, anchor)}
    )
    return block_cells(dated, cols, (cols.year, cols.week, cols.date)).select(
        cols.area,
        cols.year,
        cols.week,
        cols.date,
        numbers.parse_count("raw").alias(cols.count),
        cols.condition,
        cols.category,
        F.lit(CONFIRMED).alias(cols.source),
    )


# -- weekly CSV -------------------------------------------------------------------------------


def _report_row(index: int) -> Column:
    return F.try_element_at("rows", F.lit(index + 1))


def _data_rows(first: Column) -> Column:
    """Rows from a 0-based position on."""
    return F.slice("rows", (first + 1).cast("int"), F.greatest(F.size("rows") - first, F.lit(0)).cast("int"))


def bullet_headers(reports_df: DataFrame, aliases: Aliases = None, year: int | None = None) -> DataFrame:
    """Add period, value columns and ``reason`` (why the report is unusable) to weekly CSV reports.

    Columns without a header are the cumulative ones and are left out.
    """
    positions = F.transform(
        _tail(_report_row(BULLET_HEADER_ROW)),
        lambda c, i: F.struct((i + 1).alias("pos"), text.clean_header(c).alias("label")),
    )
    named = F.filter(positions, lambda h: h["label"].isNotNull())
    heads = F.transform(
        named,
        lambda h: F.struct(
            h["pos"].alias("pos"), text.normalize_name(h["label"], aliases).alias("label"), h["label"].alias("raw")
        ),
    )
    file_year = F.lit(year).cast("int") if year is not None else reports.year_from_name("file")
    no_heads = F.array().cast("array<struct<pos:int,label:string,raw:string>>")
    return (
        with_computed(
            reports_df,
            {
                "year": file_year,
                "week": reports.week_from_name("file"),
                "heads": F.coalesce(heads, no_heads),
            },
        )
        .withColumn("first_row", F.lit(BULLET_FIRST_ROW))
        .withColumn(
            "reason",
            F.when(F.col("error").isNotNull(), F.col("error"))
            .when(F.size("rows") <= BULLET_FIRST_ROW, "too few rows")
            .when(F.col("year").isNull() | F.col("week").isNull(), "unknown period")
            .when(F.size("heads") == 0, "no condition columns"),
        )
    )


def bullet_to_long(
    reports_df: DataFrame,
    cols: Cols = COLS,
    aliases: Aliases = None,
    year: int | None = None,
    anchor: str = "monday",
    weeks: list[int] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Weekly CSV of one value column per condition -> long confirmed cases, without total rows.

    ``keep``: columns of the reports, such as ``file``, that go with every row.
    """
    usable = bullet_headers(reports_df, aliases, year).where(F.col("reason").isNull())
    if weeks is not None:
        usable = usable.where(F.col("week").isin([int(w) for w in weeks]))
    rows = with_computed(usable, {"date": calendar.week_date("year", "week", anchor)}).select(
        *keep, "year", "week", "date", "heads", F.explode(_data_rows(F.col("first_row"))).alias("cells")
    )
    values = F.transform(
        "heads", lambda h: F.struct(h["label"].alias("label"), cell("cells", h["pos"]).alias("raw"))
    )
    return (
        rows.withColumn("_area", text.strip(cell("cells", 0)))
        .where((F.col("_area") != "") & ~text.is_total_row("_area", "prefix"))
        .select(*keep, "_area", "year", "week", "date", F.inline(values))
        .select(
            *keep,
            F.col("_area").alias(cols.area),
            F.col("label").alias(cols.condition),
            numbers.parse_count("raw").alias(cols.count),
            F.col("year").alias(cols.year),
            F.col("week").alias(cols.week),
            F.col("date").alias(cols.date),
            F.lit(CONFIRMED).alias(cols.source),
        )
    )


def _english_heads(names: Column | str, aliases: Aliases) -> Column:
    """Names stand on odd positions; the rate is the next column when there is one."""
    n = F.size(names)
    odd = F.when(n >= 2, F.sequence(F.lit(1), n - 1, F.lit(2)))
    heads = F.transform(
        odd,
        lambda i: F.struct(
            i.alias("count_pos"),
            F.when(i + 1 < n, i + 1).alias("rate_pos"),
            text.normalize_name(text.strip_or_null(cell(names, i)), aliases).alias("label"),
            text.strip_or_null(cell(names, i)).alias("raw"),
        ),
    )
    return F.filter(heads, lambda h: h["label"].isNotNull())


def _japanese_heads(names: Column | str, kinds: Column | str, aliases: Aliases) -> Column:
    """A name starts a pair; the next unnamed column with a kind is its rate."""
    n = F.size(names)
    heads = F.transform(
        F.when(n >= 2, F.sequence(F.lit(1), n - 1)),
        lambda i: F.struct(
            i.alias("count_pos"),
            F.when(
                text.clean_cell(cell(names, i + 1)).isNull() & (text.strip(cell(kinds, i + 1)) != ""), i + 1
            ).alias("rate_pos"),
            text.normalize_name(text.clean_cell(cell(names, i)), aliases).alias("label"),
            text.clean_cell(cell(names, i)).alias("raw"),
        ),
    )
    return F.filter(heads, lambda h: h["label"].isNotNull())


def sentinel_headers(reports_df: DataFrame, aliases: Aliases = None, year: int | None = None) -> DataFrame:
    """Add layout, period, value columns and ``reason`` (why the report is unusable).

    A file with a metric row is English, any other Japanese. The header line wins over the file
    name for the period of English files.
    """
    is_metric = F.transform("rows", lambda row: F.lower(F.array_join(row, "\n")).contains(METRIC_MARK))
    english = F.col("metric") > 0
    given = F.lit(year).cast("int")
    name_year, name_week = reports.year_from_name("file"), reports.week_from_name("file")
    en_year = F.coalesce(given, reports.year_from_header("_headline"), name_year)
    en_week = F.coalesce(reports.week_from_header("_headline"), name_week)
    above = F.try_element_at("rows", F.when(F.col("metric") > 1, (F.col("metric") - 1).cast("int")))
    heads = F.when(english, _english_heads("_names", aliases)).otherwise(
        _japanese_heads("_names", "_kinds", aliases)
    )
    no_heads = F.array().cast("array<struct<count_pos:int,rate_pos:int,label:string,raw:string>>")
    smallest = F.when(english, MIN_ROWS_EN).otherwise(MIN_ROWS_JA)
    found = with_computed(reports_df, {"metric": F.array_position(is_metric, F.lit(True))})
    parts = with_computed(
        found,
        {
            "layout": F.when(english, "english").otherwise("japanese"),
            "first_row": F.when(english, F.col("metric")).otherwise(F.lit(JA_FIRST_ROW)),
            "_headline": reports.header_text(_report_row(1)),
            "_names": F.when(english, above).otherwise(_report_row(JA_NAME_ROW)),
            "_kinds": _report_row(JA_KIND_ROW),
        },
    )
    return (
        with_computed(
            parts,
            {
                "year": F.when(english, en_year).otherwise(F.coalesce(given, name_year)),
                "week": F.when(english, en_week).otherwise(name_week),
                "heads": F.coalesce(heads, no_heads),
            },
        )
        .withColumn(
            "reason",
            F.when(F.col("error").isNotNull(), F.col("error"))
            .when(F.size("rows") < smallest, "too few rows")
            .when(F.col("year").isNull() | F.col("week").isNull(), "unknown period")
            .when(F.size("heads") == 0, "no condition columns"),
        )
        .drop("metric", "_headline", "_names", "_kinds")
    )


def sentinel_to_long(
    reports_df: DataFrame,
    cols: Cols = COLS,
    aliases: Aliases = None,
    year: int | None = None,
    weeks: list[int] | None = None,
    layout: str | None = None,
    anchor: str = "sunday",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Weekly CSV of (count, rate) column pairs -> long sentinel reports, English or Japanese per file."""
    usable = sentinel_headers(reports_df, aliases, year).where(F.col("reason").isNull())
    if layout is not None:
        usable = usable.where(F.col("layout") == layout)
    if weeks is not None:
        usable = usable.where(F.col("week").isin([int(w) for w in weeks]))
    rows = with_computed(usable, {"date": calendar.week_date("year", "week", anchor)}).select(
        *keep, "layout", "year", "week", "date", "heads", F.explode(_data_rows(F.col("first_row"))).alias("cells")
    )
    english = F.col("layout") == "english"
    area = F.when(english, text.strip(cell("cells", 0))).otherwise(text.clean_cell(cell("cells", 0)))
    is_total = F.when(english, text.is_total_row("_area", "prefix")).otherwise(
        text.is_total_row("_area", "japanese")
    )
    pairs = F.transform(
        "heads",
        lambda h: F.struct(
            h["label"].alias("label"),
            cell("cells", h["count_pos"]).alias("count_raw"),
            cell("cells", h["rate_pos"]).alias("rate_raw"),
        ),
    )
    ja_count = F.coalesce(numbers.parse_dashed("count_raw").try_cast("bigint").cast("double"), F.lit(0.0))
    return (
        rows.withColumn("_area", area)
        .where((F.col("_area") != "") & ~is_total)
        .select(*keep, "_area", "layout", "year", "week", "date", F.inline(pairs))
        .select(
            *keep,
            F.col("_area").alias(cols.area),
            F.col("label").alias(cols.condition),
            F.col("year").alias(cols.year),
            F.col("week").alias(cols.week),
            F.col("date").alias(cols.date),
            F.when(english, numbers.parse_number("count_raw")).otherwise(ja_count).alias(cols.count),
            F.when(english, numbers.parse_number("rate_raw"))
            .otherwise(numbers.parse_dashed("rate_raw"))
            .alias(cols.rate),
            F.lit(SENTINEL).alias(cols.source),
        )
    )


def quarantine(reports_df: DataFrame) -> DataFrame:
    """(file, reason) of reports that give no observation; nothing is skipped silently.

    The reports are read once: each row goes the way of its own layout.
    """
    told = reports_df.select("file", "rows", "error", F.coalesce(reports.layout_of("file"), F.lit("")).alias("_layout"))
    told = sentinel_headers(told).select("file", "rows", "error", "_layout", F.col("reason").alias("_sentinel"))
    marked = bullet_headers(told).select(
        "file",
        F.when(F.col("_layout") == "sentinel", F.col("_sentinel"))
        .when(F.col("_layout") == "bullet", F.col("reason"))
        .otherwise(F.coalesce("error", F.lit("unknown layout")))
        .alias("reason"),
    )
    return marked.where(F.col("reason").isNotNull())


def reports_to_long(
    reports_df: DataFrame,
    cols: Cols = COLS,
    aliases: Aliases = None,
    year: int | None = None,
    weeks: list[int] | None = None,
) -> DataFrame:
    """Weekly CSV of both layouts, each file parsed by the layout of its own name; other files give nothing."""
    layout = reports.layout_of("file")
    return combine.union_relaxed(
        bullet_to_long(reports_df.where(layout == "bullet"), cols, aliases, year, weeks=weeks),
        sentinel_to_long(reports_df.where(layout == "sentinel"), cols, aliases, year, weeks),
    )


def names_read(reports_df: DataFrame, aliases: Aliases = None, year: int | None = None) -> DataFrame:
    """(raw, canonical, year, week, file): each spelling of a condition that usable weekly reports carry, as it was
    first seen, by period and file.

    The first reading of a spelling wins, and only the minimum of each task travels. Audits of several reads are
    put together by :func:`merge_audits`.
    """
    columns = ["file", "year", "week", F.inline("heads")]
    layout = reports.layout_of("file")
    bullet = bullet_headers(reports_df.where(layout == "bullet"), aliases, year)
    sentinel = sentinel_headers(reports_df.where(layout == "sentinel"), aliases, year)
    seen = [
        heads.where("reason IS NULL").select(*columns).select("raw", F.col("label").alias("canonical"), "year", "week", "file")
        for heads in (bullet, sentinel)
    ]
    return merge_audits(*seen)


def merge_audits(*audits: DataFrame) -> DataFrame:
    """One row per spelling: the one that was seen first."""
    first = F.min(F.struct("year", "week", "file", "canonical"))
    folded = combine.union_strict(*audits).groupBy("raw").agg(first.alias("first"))
    return folded.select("raw", *(f"first.{c}" for c in ("canonical", "year", "week", "file")))


def files_to_long(
    files: DataFrame,
    cols: Cols = COLS,
    aliases: Aliases = None,
    year: int | None = None,
    weeks: list[int] | None = None,
) -> DataFrame:
    """Like :func:`reports_to_long`, from files (path, content): a layout's files are told by their names before
    they are decoded, so that each is decoded once."""
    layout = reports.layout_of("path")
    return combine.union_relaxed(
        bullet_to_long(reports.parse_contents(files.where(layout == "bullet")), cols, aliases, year, weeks=weeks),
        sentinel_to_long(reports.parse_contents(files.where(layout == "sentinel")), cols, aliases, year, weeks),
    )


def quarantine_sheets(grid: DataFrame, min_rows: int = MIN_ROWS_WORKBOOK) -> DataFrame:
    """(file, sheet, reason) of workbook sheets that give no observation."""
    cleaned = with_computed(_readable(grid), {"_clean": F.transform(_tail("cells"), lambda c: text.clean_cell(c))})
    sheets = cleaned.groupBy(*SHEET).agg(
        F.max("row_idx").alias("last"), F.max(_is_category_row("_clean")).alias("has_header")
    )
    year = reports.year_from_name("file")
    reason = (
        F.when(year.isNull(), "unknown period")
        .when(reports.sheet_week(year, "sheet").isNull(), "no week")
        .when(F.col("last") < min_rows - 1, "too few rows")
        .when(~F.col("has_header"), "no header")
    )
    out = sheets.select(*SHEET, reason.alias("reason")).where("reason IS NOT NULL")
    if "error" in grid.columns:
        out = out.unionByName(grid.where("error IS NOT NULL").select(*SHEET, F.col("error").alias("reason")).distinct())
    return out
