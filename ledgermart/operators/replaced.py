"""Tables whose batches are simply replaced: Spark's own partitioned Parquet write with dynamic overwrite.

A write replaces the partitions of the batches that it holds and leaves all others. It
can be repeated with the same outcome, so a run that dies is run again; what is
still to do follows from the partitions that are there, not from the newest of them,
as a write that dies half done may have replaced any of its partitions. For tables that
many writers or readers meet at the same time, ``Mart`` has commits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions.dates import batch_id
from ledgermart.operators import paths
from ledgermart.operators.store import PART, batch_time


class ReplacedTable:
    """A Parquet folder partitioned by batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def batches(self) -> list[str]:
        """Batches in order, from the folder names."""
        head = f"{PART}="
        return [c.removeprefix(head) for c in paths.children(self.spark, self.path) if c.startswith(head)]

    def exists(self) -> bool:
        return bool(self.batches())

    def table(self) -> DataFrame:
        """All rows; columns that came later are NULL in older batches."""
        if not self.exists():
            raise LookupError(f"no table in {self.path}")
        return self.spark.read.option("mergeSchema", "true").parquet(self.path).drop(PART)

    def replace(self, df: DataFrame, ts_col: str = "audit_ts") -> None:
        """Replaces the rows of every batch that occurs in ``df``; other batches stay."""
        rows = df.withColumn(PART, batch_id(F.col(ts_col)))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path)

    def append_new(self, df: DataFrame, ts_col: str = "audit_ts") -> None:
        """Adds the batches that aren't there yet; running it again adds nothing."""
        there = self.batches()
        part = batch_id(F.col(ts_col))
        self.replace(df.filter(~part.isin(there)) if there else df, ts_col)

    def since(self, wanted: Sequence[str]) -> tuple[bool, str | None]:
        """Whether any of the ``wanted`` batches is missing, and the timestamp of the last one before the first that is."""
        there = set(self.batches())
        ordered = sorted(wanted)
        first = next((i for i, b in enumerate(ordered) if b not in there), None)
        if first is None:
            return False, None
        return True, batch_time(ordered[first - 1]) if first else None

    def drop(self, gone: Sequence[str]) -> None:
        for part in gone:
            paths.delete(self.spark, f"{self.path}/{PART}={part}")
