"""Typed values from text, independent of the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numeric date layouts understood besides ISO, month first. With each,
# marks that its texts have and that they lack: a text is tried in the layouts of its shape only.
_DATE_LAYOUTS = [
    ("M/d/yyyy", "/", ":"),
    ("M/d/yyyy H:mm", "/:", "M"),
    ("M/d/yyyy H:mm:ss", "/:", "M"),
    ("M/d/yyyy h:mm a", "/:M", ""),
    ("M/d/yyyy h:mm:ss a", "/:M", ""),
    ("M/d/yy", "/", ":"),
    ("M-d-yyyy", "-", "/:"),
    ("yyyy/M/d", "/", ":"),
    ("yyyyMMdd", "", "/:"),
]
# A day, a month's name or its first three letters, and a year, in
# either order; a time may follow.
_MONTHS = "january february march april may june july august september october november december".split()
_MONTH = "(" + "|".join(m if len(m) == 3 else f"{m[:3]}(?:{m[3:]})?" for m in _MONTHS) + r")\.?"
_SHORT = "".join(m[:3] for m in _MONTHS)
_DAY_FIRST = rf"^(\d{{1,2}})[-\s/]{_MONTH}[-\s/,]+(\d{{4}}|\d{{2}})(?:[\sT].*)?$"
_MONTH_FIRST = rf"^{_MONTH}[-\s](\d{{1,2}})(?:,\s*|[-\s])(\d{{4}})(?:[\sT].*)?$"
_NUMBER = r"\A\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"


def _named_month(text: Column) -> Column:
    """The day of a date that spells its month, or null."""
    lowered = F.lower(text)

    def made(pattern: str, day: int, month: int, year: int) -> Column:
        part = lambda group: F.regexp_extract(lowered, pattern, group)
        number = F.floor((F.instr(F.lit(_SHORT), F.left(part(month), F.lit(3))) + 2) / 3)
        whole = F.when(F.length(part(year)) == 2, F.concat(F.lit("20"), part(year))).otherwise(part(year))
        written = F.concat_ws("-", whole, number.cast("string"), part(day))
        return F.when(lowered.rlike(pattern), F.try_to_timestamp(written, F.lit("yyyy-M-d")).cast("date"))

    return F.coalesce(made(_DAY_FIRST, 1, 2, 3), made(_MONTH_FIRST, 2, 1, 3))


def date_or_null(c: Column) -> Column:
    """The day of a date or date-time text, month before day; anything else is null."""
    text = F.trim(c)
    upper = F.upper(text)

    def attempt(layout: str, has: str, lacks: str) -> Column:
        shape = F.lit(True)
        for mark in has:
            shape = shape & F.contains(upper, F.lit(mark))
        for mark in lacks:
            shape = shape & ~F.contains(upper, F.lit(mark))
        if layout == "yyyyMMdd":
            shape = shape & text.rlike(r"^[+-]?\d{8,}$")
        return F.when(shape, F.try_to_timestamp(upper, F.lit(layout)).cast("date"))

    attempts = [attempt(*layout) for layout in _DATE_LAYOUTS]
    named = F.when(text.rlike("[A-Za-z]{3}"), _named_month(text))
    return F.coalesce(text.try_cast("date"), *attempts, named)


def date_or_error(c: Column) -> Column:
    """The day of a date text; null stays null, unreadable text fails the job."""
    parsed = date_or_null(c)
    message = F.concat(F.lit("not a date: "), c)
    return F.when(c.isNotNull() & parsed.isNull(), F.raise_error(message).cast("date")).otherwise(parsed)


def as_date(c: Column, data_type: T.DataType) -> Column:
    """A day from a column of the given type."""
    return date_or_error(c) if isinstance(data_type, T.StringType) else c.cast("date")


def number_or_null(c: Column) -> Column:
    """A plain decimal or exponent number; ``1,000``, ``x`` and ``nan`` are null."""
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def positive_or_null(c: Column) -> Column:
    return F.when(c > 0, c)


def whole_or_error(c: Column) -> Column:
    """An integer; a fraction fails the job instead of being cut off."""
    message = F.concat(F.lit("not a whole number: "), c.cast("string"))
    return F.when(c != F.floor(c), F.raise_error(message).cast("int")).otherwise(c.cast("int"))
