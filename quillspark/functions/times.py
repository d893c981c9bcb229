"""Strict timestamps and partial dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A moment needs T, seconds and an offset of at most 14:00.
STRICT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-](?:(?:0\d|1[0-3]):[0-5]\d|14:00))$"


def strict_timestamp(value: Column) -> Column:
    """A timestamp with its offset, else null: a text without offset is not a moment."""
    return F.when(value.rlike(STRICT), value.try_cast("timestamp"))


def partial_date(value: Column) -> Column:
    """struct(earliest, precision) of Y, Y-M or Y-M-D; null if it is none of these or no date."""
    precision = F.when(value.rlike(r"^\d{4}$"), "year").when(value.rlike(r"^\d{4}-\d{2}$"), "month").when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), "day")
    full = F.when(precision == "year", F.concat(value, F.lit("-01-01"))).when(precision == "month", F.concat(value, F.lit("-01"))).when(precision == "day", value)
    earliest = full.try_cast("date")
    return F.when(earliest.isNotNull(), F.struct(earliest.alias("earliest"), precision.alias("precision")))


def date_reasons(published: Column, retrieved: Column, cutoff: Column) -> Column:
    """Codes of a source's times as text: a bad publication date, a bad retrieval time, a date after the earliest limit (M1-M3)."""
    from quillspark.operators.contracts import reasons

    date, moment, limit = partial_date(published), strict_timestamp(retrieved), cutoff.try_cast("date")
    given = F.coalesce(published, F.lit("")) != ""
    return reasons(
        {
            "publication_invalid": given & date.isNull(),
            "timestamp_requires_exact_iso_timezone": moment.isNull(),
            "publication_after_capture_or_cutoff": F.coalesce(~not_after(date["earliest"], moment, limit), F.lit(False)),
        }
    )


def not_after(published: Column, *limits: Column) -> Column:
    """Whether a date is not after the least of the limits that are known; null if the date is unknown."""
    return published <= F.least(*[x.cast("date") for x in limits])
