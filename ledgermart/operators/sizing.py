"""Size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast of a metadata table (ledger, labels, changed keys) of proven size.

    The frame is evaluated once, and no further than one row past the bound. Within
    the bounds the fetched rows are what is broadcast, so a ledger derived from a
    large table is not derived a second time. Beyond them the frame is returned as
    it is, and the planner joins by shuffling.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
