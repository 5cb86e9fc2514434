"""Dates, numbers and bands out of text."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import col, collapse, full, strip

# fixed values: policy directives and the Spark pattern letters that read the same texts
DIRECTIVES = {"%Y": "yyyy", "%m": "M", "%d": "d", "%B": "MMMM", "%b": "MMM"}
SHAPES = {"%Y": r"\d{4}", "%m": r"\d{1,2}", "%d": r"\d{1,2}", "%B": r"\p{L}+", "%b": r"\p{L}+"}

#: A number as plain text; Spark alone also takes a trailing d or f.
NUMBER = r"(?i)[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?"
CANONICAL = r"-?\d+(\.\d+)?"
SUFFIXED = r"\d+(\.\d+)?[kK]"


def pattern(fmt: str) -> str:
    """Spark's pattern of a strptime format."""
    for directive, letters in DIRECTIVES.items():
        fmt = fmt.replace(directive, letters)
    return fmt


def shape_of(fmt: str) -> str:
    """Pattern of the texts that a strptime format can fit."""
    parts = re.split("(%[A-Za-z])", fmt)
    return "".join(SHAPES.get(x, re.escape(x) if not x.startswith("%") else ".*") for x in parts)


def parse_date(c: Column | str, fmt: str) -> Column:
    """Date of a text in one format, else null; there is no year zero.

    Only texts of the format's shape are parsed: each that does not fit costs an exception.
    """
    text = collapse(c) if "%B" in fmt or "%b" in fmt else strip(c)
    day = F.when(full(text, shape_of(fmt)), F.to_date(F.try_to_timestamp(text, F.lit(pattern(fmt)))))
    return F.when(day >= F.lit("0001-01-01").cast("date"), day)


def parse_dates(c: Column | str, formats: list[str]) -> Column:
    """By the first format that fits."""
    return F.coalesce(*[parse_date(c, f) for f in formats])


def iso_date(c: Column | str) -> Column:
    """Date of a text that is canonical already: YYYY-MM-DD, nothing around it."""
    return F.when(full(c, r"\d{4}-\d{2}-\d{2}"), parse_date(c, "%Y-%m-%d"))


def format_date(d: Column | str) -> Column:
    return F.date_format(col(d), "yyyy-MM-dd")


def years(day: Column | str, today: dt.date) -> Column:
    """Age in years of 365.25 days."""
    return F.datediff(F.lit(today), col(day)) / F.lit(365.25).cast("double")


def parse_number(c: Column | str) -> Column:
    text = strip(c)
    return F.when(full(text, NUMBER), text.try_cast("double"))


def plain_number(c: Column | str) -> Column:
    """A number once thousands separators and dollar signs are taken off."""
    return parse_number(F.translate(col(c), ",$", ""))


def thousands(c: Column | str) -> Column:
    """75k as 75000.0, else null."""
    text = strip(c)
    return F.when(full(text, SUFFIXED), F.left(text, F.length(text) - 1).try_cast("double") * 1000)


def is_canonical(c: Column | str) -> Column:
    return full(strip(c), CANONICAL)


def profiled_number(c: Column | str) -> Column:
    """How the profiler reads a number: 75k, or with separators and dollar signs, but not both."""
    return F.coalesce(thousands(c), plain_number(c))


def band(x: Column | str, width: int) -> Column:
    """Label lo-hi of the band of ``width`` that holds a number."""
    if width <= 0:
        raise ValueError(f"a band's width must be positive, not {width}")
    lo = (F.floor(col(x).cast("double") / width) * width).cast("long")
    return F.concat(lo.cast("string"), F.lit("-"), (lo + (width - 1)).cast("string"))


def usable(number: Column) -> Column:
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))


def banded(c: Column | str, width: int) -> Column:
    """Band of a number in text; a band or "unknown" stays, anything else is "unknown"."""
    text, number = strip(c), parse_number(c)
    return F.when(full(text, r"\d+-\d+") | (text == "unknown"), text).when(usable(number), band(number, width)).otherwise(F.lit("unknown"))


def postal_code(c: Column | str) -> Column:
    """The first five-digit code of a text, else "?"."""
    return F.coalesce(F.nullif(F.regexp_extract(col(c), r"\b(\d{5})(?:-\d{4})?\b", 1), F.lit("")), F.lit("?"))


def percentage(part: Column | str, whole: Column | str) -> Column:
    """Of nothing: zero."""
    return F.coalesce(F.try_divide(F.lit(100.0) * col(part), col(whole)), F.lit(0.0))
