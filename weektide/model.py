"""Data model: column names, table schemas and the fixed values of the weekly report format.

Every operator takes a :class:`Cols`, so the same code runs on any table of the shape
*(area, year, week, condition, category) -> count [, rate]*, whatever its columns are called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Cols:
    """Names of the observation columns; the defaults are those of the published tables."""

    area: str = "prefecture"
    year: str = "year"
    week: str = "week"
    date: str = "date"
    count: str = "count"
    category: str = "category"
    condition: str = "disease"
    source: str = "source"
    rate: str = "per_sentinel"

    @property
    def key(self) -> tuple[str, ...]:
        """Columns that identify one observation."""
        return (self.area, self.year, self.week, self.condition, self.category)

    @property
    def series(self) -> tuple[str, ...]:
        """Columns that identify one yearly series of weekly reports."""
        return (self.year, self.area, self.condition)

    @property
    def period(self) -> tuple[str, ...]:
        """Index columns of the wide tables."""
        return (self.area, self.year, self.week, self.date)

    @property
    def required(self) -> tuple[str, ...]:
        """Minimum column set of a valid table."""
        return (self.area, self.year, self.week, self.condition, self.count)

    @property
    def output_order(self) -> tuple[str, ...]:
        """Sort keys of a published table."""
        return (self.date, self.year, self.week, self.area, self.category, self.condition, self.source)


COLS = Cols()


def observation_schema(cols: Cols = COLS) -> T.StructType:
    """Schema every source is aligned to before tables are combined."""
    return T.StructType(
        [
            T.StructField(cols.area, T.StringType()),
            T.StructField(cols.year, T.IntegerType()),
            T.StructField(cols.week, T.IntegerType()),
            T.StructField(cols.date, T.DateType()),
            T.StructField(cols.count, T.DoubleType()),
            T.StructField(cols.category, T.StringType()),
            T.StructField(cols.condition, T.StringType()),
            T.StructField(cols.source, T.StringType()),
            T.StructField(cols.rate, T.DoubleType()),
        ]
    )


# One row per report file: its rows as text cells, or the reason it could not be read.
REPORT_SCHEMA = "file string, rows array<array<string>>, error string"

# ---------------------------------------------------------------------------------------------
# Fixed values of the report format. Results depend on these literals.
# ---------------------------------------------------------------------------------------------

CONFIRMED = "Confirmed cases"
ALL_CASE = "All-case reporting"
SENTINEL = "Sentinel surveillance"

SOURCE_GROUPS = {
    "confirmed": (CONFIRMED, ALL_CASE),
    "sentinel": (SENTINEL,),
}

VALID_YEARS = (1999, 2030)
VALID_WEEKS = (1, 53)

DATASET_FILES = {
    "sex_prefecture": "sex_prefecture.parquet",
    "place_prefecture": "place_prefecture.parquet",
    "bullet": "bullet.parquet",
    "sentinel": "sentinel.parquet",
    "unified": "unified.parquet",
    "prefecture_en": "prefecture_en.parquet",
}

DATASET_ALIASES = {"sex": "sex_prefecture", "place": "place_prefecture"}

# ISO 3166-2 numbers the areas 01-47 in this order.
AREA_CODE_PREFIX = "JP"
AREAS = (
    "Hokkaido", "Aomori", "Iwate", "Miyagi", "Akita", "Yamagata", "Fukushima",
    "Ibaraki", "Tochigi", "Gunma", "Saitama", "Chiba", "Tokyo", "Kanagawa",
    "Niigata", "Toyama", "Ishikawa", "Fukui", "Yamanashi", "Nagano",
    "Gifu", "Shizuoka", "Aichi", "Mie",
    "Shiga", "Kyoto", "Osaka", "Hyogo", "Nara", "Wakayama",
    "Tottori", "Shimane", "Okayama", "Hiroshima", "Yamaguchi",
    "Tokushima", "Kagawa", "Ehime", "Kochi",
    "Fukuoka", "Saga", "Nagasaki", "Kumamoto", "Oita", "Miyazaki", "Kagoshima", "Okinawa",
)

# Spellings found in the reports -> the name used in the tables.
CONDITION_ALIASES = {
    "Acquired immunodeficiency syndrome (AIDS)": "AIDS",
    "HIV/AIDS": "AIDS",
    "Carbapenem-resistant enterobacteriaceae infection": "Carbapenem-resistant Enterobacterales infection",
    "Enterohemorrhagic E. coli infection": "Enterohemorrhagic Escherichia coli infection",
    "Epidemic louse-borne typhus": "Epidemic typhus",
    "Herpes B virus infection": "B virus disease",
    "Scrub typhus (Tsutsugamushi disease)": "Scrub typhus",
    "Scrub typhus(Tsutsugamushi disease)": "Scrub typhus",
    "Tsutsugamushi disease": "Scrub typhus",
    "Severe invasive streptococcal infections (TSLS)": "Severe invasive streptococcal infections",
    "Severe invasive streptococcal infections(TSLS)": "Severe invasive streptococcal infections",
    "VRE infection": "Vancomycin-resistant Enterococcus infection",
    "West Nile fever (including West Nile encephalitis)": "West Nile fever",
    "West Nile fever(including West Nile encephalitis)": "West Nile fever",
}

# The first yearly workbook and the week it begins with.
FIRST_WORKBOOK_YEAR = 1999
FIRST_WORKBOOK_WEEK = 14


def area_codes() -> dict[str, str]:
    """Area name -> ISO 3166-2 code."""
    return {name: f"{AREA_CODE_PREFIX}-{i:02d}" for i, name in enumerate(AREAS, start=1)}
