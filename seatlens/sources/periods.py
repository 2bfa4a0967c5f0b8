"""The month a raw file stands for, from its name, content or folder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a file name states its month.
_NAMED = r"(20\d{2})[-_](0[1-9]|1[0-2])"

# Month words as they occur in file names, January first. Every
# long form contains its short form.
_MONTH_WORDS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def stem_of(path: Column) -> Column:
    """The file name without folder and last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"(?<=.)\.[^.]*$", "")


def year_folder_of(path: Column) -> Column:
    """The parent folder's name if it is a number."""
    return F.nullif(F.regexp_extract(path, r"/(\d+)/[^/]+$", 1), F.lit(""))


def period_from_name(stem: Column) -> Column:
    """``2025-01`` from a name like ``2025_01_deskcount``."""
    year = F.nullif(F.regexp_extract(stem, _NAMED, 1), F.lit(""))
    return F.concat(year, F.lit("-"), F.regexp_extract(stem, _NAMED, 2))


def month_from_word(stem: Column) -> Column:
    """The earliest month of the year whose short name occurs in the text."""
    lowered = F.lower(stem)
    found = [F.when(lowered.contains(w), F.lit(f"{n:02d}")) for n, w in enumerate(_MONTH_WORDS, 1)]
    return F.coalesce(*found)


def file_period(path: Column, newest_date: Column) -> Column:
    """``yyyy-MM``: the name decides, then the newest date in the content, then
    a month word below a year folder. Null if none of them tells."""
    stem = stem_of(path)
    return F.coalesce(
        period_from_name(stem),
        F.date_format(newest_date, "yyyy-MM"),
        F.concat(year_folder_of(path), F.lit("-"), month_from_word(stem)),
    )
