"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_parts(date: Column) -> dict[str, Column]:
    """Year, month, quarter and day attributes of a date, in hierarchy order."""
    quarter = F.quarter(date)
    return {
        "year": F.year(date),
        "quarter_no": quarter,
        "quarter": F.concat(F.lit("Qtr "), quarter.cast("string")),
        "month_no": F.month(date),
        "month": F.date_format(date, "MMMM"),
        "day": F.dayofmonth(date),
    }


def month_tag(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_start(ts: Column) -> Column:
    """First instant of the month, without a time zone."""
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def batch_id(ts: Column) -> Column:
    """Partition-safe text of a batch timestamp; sorts as the timestamp does. A missing timestamp is an error."""
    text = F.concat(F.lit("b"), F.date_format(ts, "yyyyMMdd'T'HHmmssSSSSSS"))
    return F.coalesce(text, F.raise_error(F.lit("a row has no batch timestamp")).cast("string"))
