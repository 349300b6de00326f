"""High-watermark filters.

The watermark is resolved to a literal on the driver before planning, so the
comparison reaches the scan as a partition filter or a pushed Parquet filter. It
travels as text in the session's zone, which compares alike with timestamps with
and without a zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def watermark_of(target: DataFrame | None, ts_col: str, default: str = EPOCH) -> str | None:
    """Largest timestamp in the target: None without a target, the default when empty."""
    if target is None:
        return None
    return target.agg(F.max(ts_col).cast("string")).first()[0] or default


def newer_than(ts_col: str | Column, watermark: str | None) -> Column:
    """Strictly newer than the watermark; without one every row passes."""
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return F.lit(True) if watermark is None else c > F.lit(watermark)


def incremental_filter(
    df: DataFrame,
    ts_col: str,
    target: DataFrame | None = None,
    target_ts: str | None = None,
    default: str = EPOCH,
) -> DataFrame:
    """Rows newer than anything in the target. No target means a first, full run."""
    watermark = watermark_of(target, target_ts or ts_col, default)
    return df if watermark is None else df.filter(newer_than(ts_col, watermark))
