"""Number cells: parsing and printing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal numbers only: a cast alone would also take '5d', 'nan' and 'Infinity'.
_NUMBER = r"[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _to_double(text: Column, blanks: str = "") -> Column:
    return F.when(text.rlike(f"^{blanks}{_NUMBER}{blanks}$"), text.try_cast("double"))


def parse_number(x: Column | str) -> Column:
    """Number cell -> double: thousands commas dropped; blank, dash or bad text -> null."""
    # Wide and fixed blanks become spaces, which the cast trims; commas go.
    text = F.replace(_col(x), F.lit(","), F.lit(""))
    return _to_double(F.regexp_replace(text, "[\u3000\xa0]", " "), r"\s*")


def parse_count_strict(x: Column | str) -> Column:
    """Number cell -> long, truncated; anything else, also ``1,234``, counts as 0."""
    return F.coalesce(_to_double(_col(x)).try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_count(x: Column | str) -> Column:
    """Number cell -> long with commas understood; blank, dash or bad text counts as 0."""
    return F.coalesce(parse_number(x).try_cast("bigint"), F.lit(0).cast("bigint"))


def drop_first_dash(x: Column | str) -> Column:
    """Remove the first ``-`` only."""
    return F.regexp_replace(_col(x), r"(?s)^([^-]*)-", "$1")


def parse_dashed(x: Column | str) -> Column:
    """Number cell of the Japanese layout -> double; a dash stands for no value."""
    return _to_double(drop_first_dash(x))


def format_count(x: Column | str) -> Column:
    """Whole numbers with thousands commas, others with two decimals, null as ``0``."""
    v = _col(x).cast("double")
    return F.when(v.isNull(), "0").when(v == F.floor(v), F.format_number(v, 0)).otherwise(F.format_number(v, 2))
