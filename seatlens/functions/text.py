"""Text rules: locations, lines of business, null tokens, report formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that mean "missing" in a CSV or a worksheet.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# How lines of business are merged; missing counts as Corporate.
LOB_DEFAULT = "Corporate"
LOB_RENAMES = {
    "Pending": "Corporate",
    "Development & Construction": "Development and Construction",
}

# Any Unicode white space, and the ASCII separators that Java leaves out of it.
_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def normalize_location(c: Column) -> Column:
    """Make every blank run one space, trim, then drop trailing ``. , ; :``.

    The order matters: a blank uncovered by the last step stays. Null stays
    null, and a name of nothing but punctuation becomes the empty string.
    """
    single_spaced = F.regexp_replace(c, _BLANKS, " ")
    return F.rtrim(F.trim(single_spaced), F.lit(".,;:"))


def location_or_null(c: Column) -> Column:
    """A normalised location; an empty one is no location."""
    return F.nullif(normalize_location(c), F.lit(""))


def standardize_lob(c: Column) -> Column:
    renamed = c
    for old, new in LOB_RENAMES.items():
        renamed = F.when(c == old, new).otherwise(renamed)
    return F.coalesce(renamed, F.lit(LOB_DEFAULT))


def same_text(c: Column, text: str) -> Column:
    """Equal but for case and surrounding blanks."""
    return F.lower(F.trim(c)) == text.strip().lower()


def folded(c: Column) -> Column:
    """A column name without the differences that headers drift in: case and outer blanks."""
    return F.lower(F.trim(c))


def first_known(values: Column) -> Column:
    """The first of an array of cell texts that does not mean "missing"."""
    return F.get(F.filter(values, lambda v: v.isNotNull() & ~v.isin(NULL_TOKENS)), F.lit(0))


def blank_null_tokens(c: Column) -> Column:
    return F.when(~c.isin(NULL_TOKENS), c)


def percent_text(part: Column, whole: Column) -> Column:
    """``12.5%``, or ``n/a`` when there is nothing to take a share of."""
    share = F.format_string("%.1f%%", part.cast("double") * 100.0 / whole)
    return F.when(whole > 0, share).otherwise("n/a")


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def mean_text(c: Column) -> Column:
    """Three decimals; a mean over nothing prints as ``nan``."""
    return F.when(c.isNotNull(), F.format_string("%.3f", c)).otherwise("nan")
