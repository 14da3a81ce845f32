"""Height text to inches, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expr import as_col, is_numeric, number

# Month abbreviations and the number each stands for.
MONTH_NUMBER = {
    "Jan": 1, "Feb": 2, "Mar": 3, "Apr": 4, "May": 5, "Jun": 6,
    "Jul": 7, "Aug": 8, "Sep": 9, "Oct": 10, "Nov": 11, "Dec": 12,
}

MODES = ("month_is_feet", "feet_first")


# Inches and month, month and inches, bare feet (4-8), bare inches (50-110).
# Only the first three characters of the month count.
MONTH_IS_FEET = (r"^\s*(?:(\d{1,2})[-/](\D{3})\D*|(\D{3})\D*[-/](\d{1,2})"
                 r"|0*([4-8])|0*([5-9]\d|10\d|110))\s*$")
FEET_FIRST = r"^\s*\+?(\d{1,6})\s*-([^-]*)$"
PLAIN = r"^\s*(\d)-(0?\d|1[01])\s*$"


def _month(text: Column, lower: bool) -> Column:
    pairs = [F.lit(x) for name, n in MONTH_NUMBER.items()
             for x in (name.lower() if lower else name, n)]
    return F.try_element_at(F.create_map(*pairs), text)


def _whole(text: Column) -> Column:
    """A group that did not match is empty text and becomes NULL here."""
    return text.try_cast("int")


def _month_is_feet(text: Column) -> Column:
    def group(*indexes: int) -> Column:
        return F.concat(*[F.regexp_extract(text, MONTH_IS_FEET, i) for i in indexes])
    feet = _month(F.lower(group(2, 3)), lower=True)
    return F.coalesce(feet * 12 + _whole(group(1, 4)), _whole(group(5)) * 12, _whole(group(6)))


def _feet_first(text: Column) -> Column:
    feet = _whole(F.regexp_extract(text, FEET_FIRST, 1))
    month = _month(F.regexp_extract(text, FEET_FIRST, 2), lower=False)
    return feet * 12 + F.coalesce(month, F.lit(0))


def _undamaged(text: Column) -> Column:
    return (_whole(F.regexp_extract(text, PLAIN, 1)) * 12
            + _whole(F.regexp_extract(text, PLAIN, 2)))


def height_inches(c: str | Column, mode: str = "month_is_feet", plain: bool = False) -> Column:
    """Inches from text damaged by a spreadsheet.

    ``month_is_feet`` reads ``2-Jun`` and ``Jun-02`` as 6 feet 2; ``feet_first``
    reads the number before the dash as feet and the month as inches.
    ``plain=True`` also accepts an undamaged ``6-10``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    text = as_col(c)
    parsed = _feet_first(text) if mode == "feet_first" else _month_is_feet(text)
    if plain:
        parsed = F.coalesce(_undamaged(text), parsed)
    return parsed.cast("double")


def add_height(df: DataFrame, source: str = "ht", mode: str = "month_is_feet",
               plain: bool = False) -> DataFrame:
    """Append ``height_inches`` and its copy ``height_numeric``; no-op without the source."""
    if source not in df.columns:
        return df
    if is_numeric(df.schema[source].dataType):
        parsed = number(source)
    else:
        parsed = height_inches(source, mode, plain)
    return df.withColumns({"height_inches": parsed, "height_numeric": parsed})


def height_report(df: DataFrame, parsed: str = "height_inches") -> DataFrame:
    """One row: rows, rows without a parsed height, and their share."""
    missing = F.count_if(F.col(parsed).isNull())
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        missing.alias("missing"),
        F.try_divide(missing, F.count(F.lit(1))).alias("missing_share"),
    )
