"""Date handling; the session time zone is UTC (see ``session.use_job_settings``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_trending_date(col: Column) -> Column:
    """``YY.DD.MM`` (day before month, 20YY) or an ISO date; anything else, or an impossible day, is null.

    The short form is rearranged to ISO, because a cast from ISO text needs no format parser per row.
    """
    year, day, month = col.substr(1, 2), col.substr(4, 2), col.substr(7, 2)
    iso = F.concat(F.lit("20"), year, F.lit("-"), month, F.lit("-"), day)
    return F.try_to_date(F.when(col.rlike(r"^\d{2}\.\d{2}\.\d{2}\z"), iso).otherwise(col))


def utc_timestamp(col: Column) -> Column:
    return F.try_to_timestamp(col.cast("string"))


def utc_date(col: Column) -> Column:
    return F.to_date(utc_timestamp(col))


def month_of(col: Column) -> Column:
    """Partition value of a date; a null date goes to the null partition."""
    return F.date_format(col, "yyyy-MM")
