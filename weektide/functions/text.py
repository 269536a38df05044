"""Text cleaning of report cells and condition names, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.model import CONDITION_ALIASES

# Characters trimmed from both ends: ASCII and Unicode blanks.
_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)

# The full-width characters that occur in the reports, and their plain forms.
_WIDE, _PLAIN = "ＩｎＡＥＯ　", "InAEO "

# Fixed patterns of the report format.
JAPANESE_SCRIPT = r"[\u3040-\u309f\u30a0-\u30ff\u4e00-\u9fff]"
BRACKETED = r"[（(](\x00*[^)）\x00][^)）]*)[)）]"
UNUSUAL = r"[^\x01-\u2fff]"
BROKEN_BRACKETS = r"^[^(]*\)\s*\((.+)$"
TOTAL_ROW_JA = "総数|合計"

#: Names that a dictionary repair sends to the tasks.
DICTIONARY_NAMES = 10_000


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Trim every kind of blank, not only the space character."""
    return F.btrim(_col(x), F.lit(_BLANKS))


def collapse_blanks(x: Column | str) -> Column:
    """Runs of blanks -> one space, trimmed."""
    return strip(F.regexp_replace(_col(x), r"(?U)\s+", " "))


def strip_or_null(x: Column | str) -> Column:
    """Trimmed text; null when nothing is left."""
    return F.nullif(strip(x), F.lit(""))


def has_japanese(x: Column | str) -> Column:
    """Text contains hiragana, katakana or CJK characters."""
    return _col(x).rlike(JAPANESE_SCRIPT)


def fold_fullwidth(x: Column | str, all_ascii: bool = False) -> Column:
    """Full-width characters -> plain ones: the six of the reports, or the whole ASCII block."""
    if all_ascii:
        wide = "".join(chr(0xFF01 + i) for i in range(94)) + "\u3000"
        plain = "".join(chr(0x21 + i) for i in range(94)) + " "
        return F.translate(_col(x), wide, plain)
    return F.translate(_col(x), _WIDE, _PLAIN)


def clean_cell(x: Column | str, bilingual_only: bool = False) -> Column:
    """Cell text: control characters out, last bracketed text (the English name) kept, folded, trimmed.

    ``bilingual_only`` looks for brackets only in cells with Japanese script, so that a plain
    English ``Name (detail)`` stays whole. Empty text becomes null.
    """
    c = _col(x)
    has_brackets = c.rlike(r"[)）]")
    inner = F.try_element_at(F.regexp_extract_all(c, F.lit(BRACKETED), F.lit(1)), F.lit(-1))
    if bilingual_only:
        has_brackets &= has_japanese(c)
    # Most cells have neither brackets nor unusual characters: what is slow is done for the others only.
    kept = F.when(has_brackets, F.coalesce(inner, c)).otherwise(c)
    folded = F.when(c.rlike(UNUSUAL), F.translate(kept, _WIDE + "\x00", _PLAIN)).otherwise(kept)
    return strip_or_null(F.translate(folded, "\r\n\t", "   "))


def clean_header(x: Column | str) -> Column:
    """Column header of a weekly CSV: first line, generated names and full-wrapping brackets dropped."""
    c = F.regexp_replace(_col(x), r"(?d)^.*[\r\n]+", "")
    c = F.regexp_replace(c, r"^\.\.\.[0-9]+$", "")
    c = collapse_blanks(F.translate(c, "Ｉ（）", "I()"))
    # Brackets around the whole text, and no other ones.
    return strip_or_null(F.regexp_replace(c, r"^\(([^(]*)\)$", "$1"))


def normalize_name(x: Column | str, aliases: Mapping[str, str] | None = None) -> Column:
    """Condition name: blanks collapsed, broken brackets repaired, known spellings replaced."""
    known = CONDITION_ALIASES if aliases is None else aliases
    whole = strip(F.regexp_replace(collapse_blanks(x), BROKEN_BRACKETS, "$1"))
    # As many closing brackets at the end as there are too few of them.
    brackets = F.regexp_replace(whole, r"[^()]+", "")
    missing = F.length(F.replace(brackets, F.lit(")"), F.lit(""))) * 2 - F.length(brackets)
    closed = F.when(whole.contains("("), F.concat(whole, F.repeat(F.lit(")"), F.greatest(missing, F.lit(0))))).otherwise(whole)
    return alias_lookup(closed, known)


def alias_lookup(x: Column | str, aliases: Mapping[str, str]) -> Column:
    """Replace known values by a literal map: no join, no shuffle."""
    c = _col(x)
    if not aliases:
        return c
    literals = ", ".join(f"{_quoted(raw)}, {_quoted(name)}" for raw, name in aliases.items())
    pairs = F.expr(f"map({literals})")
    return F.coalesce(F.try_element_at(pairs, c), c)


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def normalize_names(
    df: DataFrame, column: str, aliases: Mapping[str, str] | None = None, known: int = DICTIONARY_NAMES
) -> DataFrame:
    """Normalise one name column through a dictionary of its names; a table without it is returned as it is.

    The ``known`` most frequent names are repaired once each and looked up by all rows; that dictionary has a
    bound, so it is sent to the tasks. Rows of rarer names are repaired where they are. The result is that of
    :func:`normalize_name` on every row.
    """
    if column not in df.columns:
        return df
    name = F.col(f"`{column}`")
    often = df.where(name.isNotNull()).groupBy(name.alias("_raw")).agg(F.count("*").alias("_n"))
    often = often.orderBy(F.col("_n").desc(), "_raw").limit(known)
    dictionary = often.select("_raw", normalize_name("_raw", aliases).alias("_name"))
    repaired = F.when(F.col("_raw").isNotNull(), F.col("_name")).otherwise(normalize_name(name, aliases))
    joined = df.join(F.broadcast(dictionary), name == F.col("_raw"), "left")
    return joined.withColumn(column, repaired).select(*[f"`{c}`" for c in df.columns])


def name_audit(df: DataFrame, column: str, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Raw -> normalised name, one row per spelling; the text work runs on the distinct names only."""
    raw = df.select(F.col(f"`{column}`").alias("raw")).where("raw IS NOT NULL").distinct()
    return raw.select("raw", normalize_name("raw", aliases).alias("normalized"))


def classify_category(x: Column | str) -> Column:
    """Category of a sub-header. ``female`` is looked for before ``male``, which it contains.

    Japanese-script or missing text is a note under the total column; other text stays as it is.
    """
    c = _col(x)
    low = F.lower(c)
    return (
        F.when(c.isNull() | (c == "") | has_japanese(c), "total")
        .when(low.contains("total"), "total")
        .when(low.contains("female"), "female")
        .when(low.contains("male"), "male")
        .when(low.contains("japan"), "japan")
        .when(low.contains("others"), "others")
        .when(low.contains("unknown"), "unknown")
        .otherwise(c)
    )


def is_total_row(area: Column | str, style: str = "contains") -> Column:
    """The row sums all areas. Styles: ``contains`` (workbook), ``prefix`` (CSV), ``japanese``."""
    c = F.lower(_col(area))
    if style == "contains":
        return c.contains("total")
    if style == "prefix":
        return c.startswith("total")
    if style == "japanese":
        return _col(area).rlike(TOTAL_ROW_JA)
    raise ValueError(f"Unknown total-row style: {style}")


def data_version(label: Column | str) -> Column:
    """Release label -> version: one leading ``v`` removed."""
    return F.regexp_replace(_col(label), "^v", "")
