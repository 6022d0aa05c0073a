"""Dates in mixed notation, as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def iso_date(x: Column) -> Column:
    """``yyyy-MM-dd`` of the last day named; text in no known notation as it is."""
    y = F.trim(x)
    last = F.trim(F.element_at(F.split(y, " - "), -1))
    read = [F.date_format(F.try_to_timestamp(last, F.lit(f)), "yyyy-MM-dd") for f in config.DATE_FORMATS]
    return F.when(x.isNull() | (x == ""), x).when(y.rlike(r"^\d{4}-\d{2}-\d{2}$"), y).otherwise(F.coalesce(*read, last))


def range_head(x: Column, year: Column) -> Column:
    """The first day of a range such as ``Mar 3 - 5``, with the year where it is missing."""
    head = F.trim(F.element_at(F.split(x, r"\s*[–&-]\s*"), 1))
    full = F.when(head.rlike(r"\d{4}"), head).otherwise(F.concat_ws(", ", head, year.cast("string")))
    return F.coalesce(*[F.try_to_timestamp(full, F.lit(f)).cast("date") for f in ("MMM d, yyyy", "MMMM d, yyyy", "d MMM, yyyy", "d MMMM, yyyy")])


def manifest_date(iso: Column, dates: Column, year: Column) -> Column:
    """A meet's day: the ISO date, else dd.MM.yyyy, else the head of the range, else the
    second of January of the year."""
    return F.coalesce(
        F.try_to_date(F.trim(iso), "yyyy-MM-dd"), F.try_to_date(F.regexp_extract(dates, r"(\d{1,2}\.\d{1,2}\.\d{4})", 1), "d.M.yyyy"),
        range_head(dates, year), F.make_date(year.try_cast("int"), F.lit(1), F.lit(2)),
    )
