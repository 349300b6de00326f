"""Calendar dimension, date joins and the date-hierarchy drill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions.dates import date_parts

HIERARCHY = ("year", "quarter", "month", "day")
MAX_DAYS = 366 * 1000


def calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per day from 1 January of the first to 31 December of the last year."""
    days = F.sequence(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), F.make_date(F.lit(last_year), F.lit(12), F.lit(31)))
    dates = spark.range(1).select(F.explode(days).alias("date"))
    return dates.select("date", *[c.alias(n) for n, c in date_parts(F.col("date")).items()])


def calendar_for(df: DataFrame, *date_cols: str) -> DataFrame:
    """The calendar that covers every given date column of ``df``."""
    years = [F.year(c) for c in date_cols]
    low, high = df.agg(
        F.min(F.least(*years) if len(years) > 1 else years[0]),
        F.max(F.greatest(*years) if len(years) > 1 else years[0]),
    ).first()
    if low is None:
        return calendar(df.sparkSession, 1970, 1970).limit(0)
    return calendar(df.sparkSession, low, high)


def join_calendar(fact: DataFrame, ts_col: str, cal: DataFrame) -> DataFrame:
    """Left join on the date part of a timestamp.

    A calendar has at most 366 rows per year, so its size is bounded by the range
    of years; it is broadcast while that is under a millennium.
    """
    bounded = cal.limit(MAX_DAYS + 1).count() <= MAX_DAYS
    side = F.broadcast(cal) if bounded else cal
    return fact.join(side, F.to_date(ts_col) == side["date"], "left")


def date_drill(dated: DataFrame, measures: Sequence[Column], levels: Sequence[str] = HIERARCHY) -> DataFrame:
    """Totals for every level of the date hierarchy; ``level`` is the drill depth."""
    bits = F.bit_count(F.grouping_id(*levels)).cast("int")
    return dated.rollup(*levels).agg(*measures, (F.lit(len(levels)) - bits).alias("level"))
