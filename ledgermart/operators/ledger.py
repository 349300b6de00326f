"""The load ledger: which file was loaded when, with what result."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermart.operators.sizing import broadcast_if_small
from ledgermart.operators.store import Mart
from ledgermart.sources.csv import BAD_COLUMN, BAD_VALUE, BLOCK, FILE, SEQ, fields_before, record_places

LEDGER = "raw_copy_audit"
FIRST_AUDIT_ID = 1000
LOADED, PARTIALLY_LOADED, LOAD_FAILED, FAILED = "LOADED", "PARTIALLY_LOADED", "LOAD_FAILED", "FAILED"
SUCCESS_STATES = ("SUCCESS", LOADED)

# The ledger's columns.
LEDGER_COLUMNS = (
    "audit_id string, filepath string, target_table string, status string, "
    "rows_parsed bigint, rows_loaded bigint, error_limit bigint, errors_seen bigint, "
    "first_error string, first_error_line bigint, first_error_character bigint, "
    "first_error_column_name string, audit_ts timestamp, dag_run_id string"
)


class LoadGateError(RuntimeError):
    """A run loaded nothing, or not everything cleanly."""


def read_ledger(mart: Mart) -> DataFrame:
    """All ledger rows, none before the first load."""
    if mart.exists(LEDGER):
        return mart.table(LEDGER)
    return mart.spark.createDataFrame([], LEDGER_COLUMNS)


def append_ledger(mart: Mart, rows: DataFrame, label: str, reloaded: bool = False) -> None:
    """Adds ledger rows under a label of their own. This is a load's commit point.

    Rows of reloaded files take the place of the files' earlier rows, in the same
    commit; what was loaded under the earlier audit ids is then no longer visible.
    """
    names = [c.split()[0] for c in LEDGER_COLUMNS.split(", ")]
    rows = rows.select(*names)
    if reloaded:
        kept = read_ledger(mart).join(rows.select("filepath"), "filepath", "left_anti")
        mart.write_full(LEDGER, kept.select(*names).unionByName(rows).coalesce(1))
    else:
        mart.append_part(LEDGER, rows.coalesce(1), label)


def unprocessed(files: DataFrame, ledger: DataFrame, reload: Sequence[str] = (), path_col: str = "filepath") -> DataFrame:
    """Files without a ledger row. Any row counts, whatever its status; ``reload`` lists exceptions."""
    done = ledger.select(F.col("filepath").alias(path_col))
    if reload:
        done = done.filter(~F.col(path_col).isin(list(reload)))
    return files.join(broadcast_if_small(done), path_col, "left_anti")


def allocate_ids(files: DataFrame, ledger: DataFrame, run_ts: str, order_by: Sequence[str] = ("filepath",)) -> DataFrame:
    """Gives each file the next audit id, and a batch timestamp of its own.

    The timestamps are microseconds apart in file order, so that every file is a
    batch, and begin at ``run_ts`` or, where the ledger is already past it, right after
    the ledger's newest: a batch before a watermark would never be read. The input
    is a list of files, small enough for one ordered window.
    """
    last = ledger.agg(
        F.coalesce(F.max(F.col("audit_id").cast("bigint")), F.lit(FIRST_AUDIT_ID - 1)).alias("_last"),
        F.max("audit_ts").alias("_newest"),
    )
    rank = F.row_number().over(Window.orderBy(*order_by))
    start = F.greatest(F.unix_micros(F.lit(run_ts).cast("timestamp")), F.unix_micros(F.col("_newest").cast("timestamp")) + 1)
    return (
        files.withColumn("_rank", rank)
        .crossJoin(F.broadcast(last))
        .withColumn("audit_id", (F.col("_last") + F.col("_rank")).cast("string"))
        .withColumn("audit_ts", F.timestamp_micros(start + F.col("_rank") - 1))
        .drop("_rank", "_last", "_newest")
    )


def stamp(rows: DataFrame, ids: DataFrame, path_col: str = FILE) -> DataFrame:
    """Every row gets its file's audit id while it is read; no later update."""
    small = broadcast_if_small(ids.select(F.col("filepath").alias(path_col), "audit_id"))
    return rows.join(small, path_col, "inner")


def load_stats(tagged: DataFrame) -> DataFrame:
    """Rows parsed, loaded and rejected per file, with the first error and the number of its record.

    Rows are counted per file block, in one hash aggregation over numbers. The first
    error's record (from 0) is the number of rows of the blocks before it, and of those
    before it in its block. As a line, that is exact where a record is a line;
    ``located_errors`` gives lines and characters for all files.
    """
    bad = F.col(BAD_COLUMN).isNotNull()
    blocks = tagged.groupBy(FILE, BLOCK).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("n_bad"), F.min(F.when(bad, F.col(SEQ))).alias("_first_bad")
    )
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumns(
        {
            "_before": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
            "_bad_before": F.coalesce(F.sum("n_bad").over(earlier), F.lit(0)),
        }
    )
    leads = F.when((F.col("n_bad") > 0) & (F.col("_bad_before") == 0), F.lit(True))
    per_file = placed.groupBy(FILE).agg(
        F.sum("n").alias("rows_parsed"),
        F.sum("n_bad").alias("errors_seen"),
        F.max(F.when(leads, F.col("_before"))).alias("_before"),
        F.max(F.when(leads, F.col(BLOCK))).alias(BLOCK),
        F.max(F.when(leads, F.col("_first_bad"))).alias(SEQ),
    )
    per_file = broadcast_if_small(per_file)  # a row for each file
    firsts = per_file.filter("errors_seen > 0").select(FILE, BLOCK, F.col(SEQ).alias("_first_bad"))
    if firsts.isEmpty():
        none = {c: F.lit(None).cast("string") for c in (BAD_COLUMN, BAD_VALUE)}
        found = per_file.withColumns({**none, "first_error_record": F.lit(None).cast("bigint")})
    else:
        # the rows up to a file's first error are found by its place, and not moved
        rows = tagged.select(FILE, BLOCK, SEQ, BAD_COLUMN, BAD_VALUE).join(broadcast_if_small(firsts), [FILE, BLOCK])
        at = F.col(SEQ) == F.col("_first_bad")
        errors = rows.filter(F.col(SEQ) <= F.col("_first_bad")).groupBy(FILE).agg(
            F.count_if(~at).alias("_above"), *[F.max(F.when(at, F.col(c))).alias(c) for c in (BAD_COLUMN, BAD_VALUE)]
        )
        found = per_file.join(errors, FILE, "left").withColumn("first_error_record", F.col("_before") + F.col("_above"))
    loaded = F.col("rows_parsed") - F.col("errors_seen")
    return found.select(
        FILE,
        load_status(F.col("rows_parsed"), F.col("errors_seen")).alias("status"),
        "rows_parsed",
        loaded.alias("rows_loaded"),
        F.col("rows_parsed").alias("error_limit"),
        "errors_seen",
        F.when(
            F.col(BAD_COLUMN).isNotNull(),
            F.format_string("%s: cannot read '%s'", F.col(BAD_COLUMN), F.col(BAD_VALUE)),
        ).alias("first_error"),
        (F.col("first_error_record") + 2).alias("first_error_line"),
        F.lit(None).cast("bigint").alias("first_error_character"),
        F.col(BAD_COLUMN).alias("first_error_column_name"),
        "first_error_record",
    )


def located_errors(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``stats`` with the line, and the character in it, at which the first error's field begins, both from 1.

    Files with an error are read once more, as text. ``columns`` are those of the file, in
    its order. The statistics, a row for each file, are evaluated once.
    """
    spark = stats.sparkSession
    known = spark.createDataFrame(stats.toArrow(), stats.schema)
    wrong = known.filter("errors_seen > 0").select(FILE, "first_error_record", "first_error_column_name")
    files = [unquote(r[FILE]) for r in wrong.select(FILE).collect()]
    if not files:
        return known
    index = F.array_position(F.lit(list(columns)), F.col("first_error_column_name")) - 1
    records = record_places(spark, files).join(F.broadcast(wrong), FILE).filter("record = first_error_record")  # a row for each file
    pieces = F.split(fields_before(F.col("value"), index), "\n")
    places = records.select(
        FILE,
        (F.col("line") + F.size(pieces) - 1).cast("bigint").alias("_line"),
        (F.char_length(F.element_at(pieces, -1)) + 1).cast("bigint").alias("_character"),
    )
    found = known.join(places, FILE, "left")
    return found.withColumns(
        {"first_error_line": F.coalesce("_line", "first_error_line"), "first_error_character": F.col("_character")}
    ).drop("_line", "_character")


def load_status(parsed, errors):
    return (
        F.when(errors == 0, F.lit(LOADED))
        .when(errors < parsed, F.lit(PARTIALLY_LOADED))
        .otherwise(F.lit(LOAD_FAILED))
    )


def record_load(plan: DataFrame, stats: DataFrame, run_id: str) -> DataFrame:
    """Ledger rows of a load: one per planned file, also for a file without rows."""
    seen = plan.join(stats.withColumnRenamed(FILE, "filepath"), "filepath", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("rows_parsed", "rows_loaded", "error_limit", "errors_seen")}
    return seen.withColumns(
        {**zero, "status": F.coalesce("status", F.lit(LOADED)), "dag_run_id": F.lit(run_id)}
    )


def join_audit(raw: DataFrame, ledger: DataFrame, target_table: str | None = None, after: str | None = None) -> DataFrame:
    """Raw rows with their batch timestamp; rows without a ledger row drop out.

    The ledger is filtered first, so only the audit ids of new batches reach the
    join, and a raw table partitioned by ``audit_id`` is pruned to them.
    """
    if target_table is not None:
        ledger = ledger.filter(F.col("target_table") == target_table)
    if after is not None:
        ledger = ledger.filter(F.col("audit_ts") > F.lit(after))
    return raw.join(broadcast_if_small(ledger.select("audit_id", "audit_ts")), "audit_id", "inner")


def orphan_rows(raw: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose load never reached the ledger."""
    return raw.join(broadcast_if_small(ledger.select("audit_id")), "audit_id", "left_anti")


def status_counts(ledger: DataFrame, run_id: str | None = None) -> DataFrame:
    rows = ledger if run_id is None else ledger.filter(F.col("dag_run_id") == run_id)
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))


def not_loaded(results: DataFrame) -> DataFrame:
    """Files of a result that did not load cleanly."""
    return results.filter(~F.coalesce(F.col("status").isin(*SUCCESS_STATES), F.lit(False)))


def gate_loads(results: DataFrame) -> None:
    """Raises unless there is at least one file and all of them loaded cleanly."""
    by_status = {r["status"]: r["n_files"] for r in status_counts(results).collect()}
    if not by_status:
        raise LoadGateError("no file was loaded")
    failed = {s: n for s, n in by_status.items() if s not in SUCCESS_STATES}
    if failed:
        raise LoadGateError(f"files not loaded cleanly: {failed}")


def lineage(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows with the file and the run they came from."""
    origin = ledger.select("audit_id", "filepath", "target_table", "dag_run_id")
    return rows.join(broadcast_if_small(origin), "audit_id", "inner")


