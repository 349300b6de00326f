"""File streams: new files are picked up once and go through the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgermart.operators.ledger import FAILED, LoadGateError
from ledgermart.operators.loader import load_files
from ledgermart.operators.store import Delivery, Mart

# The columns of Spark's binary file source.
_BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_table(stream: DataFrame, mart: Mart, name: str, checkpoint: str) -> StreamingQuery:
    """Appends everything available to a mart table, one part per query and micro-batch.

    A replayed micro-batch replaces its own part, so each row that the checkpoint hands
    out lands once. A new checkpoint is another query: it hands out all files again,
    and its parts stand beside the old ones.
    """

    def add(batch: DataFrame, epoch: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        mart.append_part(name, batch, f"epoch-{query}-{epoch:010d}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_feed(
    stream: DataFrame, mart: Mart, name: str, checkpoint: str, ts_col: str = "audit_ts",
    report: Callable[[Delivery], None] = lambda delivery: None,
) -> StreamingQuery:
    """Appends everything available by batch time; rows that come after their batch was done are kept apart.

    A micro-batch is a delivery of ``Mart.append_feed``, and ``report`` is given its counts. A
    replayed micro-batch adds nothing.
    """

    def add(batch: DataFrame, epoch: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        report(mart.append_feed(name, batch, ts_col, f"{query}-{epoch}"))

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_load(
    spark: SparkSession,
    landing: str,
    mart: Mart,
    schemas: Mapping[str, T.StructType],
    run_id: str,
    checkpoint: str,
    pattern: str = "*.csv*",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Loads newly landed CSV files under the ledger.

    The stream carries file names only; the files are read by the loader. The
    source's checkpoint knows the files it has handed out, and the ledger those
    that were loaded, so a replay loads nothing twice. A micro-batch with an
    unreadable file fails once its other files are loaded: it isn't done for the
    checkpoint, and the next start tries that file again.
    """
    source = (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
    )
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", str(files_per_batch))
    names = source.load(landing).select(F.col("_metadata.file_path").alias("filepath"))

    def add(batch: DataFrame, epoch: int) -> None:
        results = load_files(mart, batch, schemas, f"{run_id}-{epoch}")
        failed = [r["filepath"] for r in results.filter(F.col("status") == FAILED).collect()]  # at most one a file
        if failed:
            raise LoadGateError(f"files not loaded: {failed}")

    return names.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
