"""Calendar arithmetic on control dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"^\s*(\d+)-(\d+)-(\d+)"


def lenient_date(text: Column) -> Column:
    """yyyy-MM-dd text to DATE; a month or day past the end rolls over (2021-02-30 is 2021-03-02)."""
    part = [F.regexp_extract(text, _DATE, i).try_cast("int") for i in (1, 2, 3)]
    first = F.when(part[0].between(1, 9999), F.make_date(part[0], F.lit(1), F.lit(1)))
    return F.date_add(F.add_months(first, part[1] - 1), part[2] - 1)


def add_days(date: Column, days: int | Column) -> Column:
    return F.date_add(date, days)


def add_days_text(text: Column, days: int | Column) -> Column:
    return F.date_format(F.date_add(lenient_date(text), days), "yyyy-MM-dd")


def day_parts(date: Column) -> tuple[Column, Column, Column]:
    """Path parts of a day: four-digit year, two-digit month and day."""
    return tuple(F.date_format(date, p) for p in ("yyyy", "MM", "dd"))
