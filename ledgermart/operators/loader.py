"""Landed CSV files to audited raw tables."""

from __future__ import annotations

import logging
import threading
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.operators import ledger as lg
from ledgermart.operators.parallel import run_together
from ledgermart.operators.store import Mart
from ledgermart.sources import csv
from ledgermart.sources.files import readable_path, route_paths

log = logging.getLogger(__name__)

REJECTED = "-rejected"
_LEDGER_WRITER = threading.Lock()
RESULT = "filepath string, target_table string, status string"


def accepted(part: str) -> bool:
    return not part.endswith(REJECTED)


def raw_table(
    mart: Mart,
    name: str,
    schema: T.StructType,
    audit_ids: Sequence[str] | None = None,
    position: bool = False,
) -> DataFrame:
    """Loaded rows of a raw table: file columns, ``audit_id`` and ``load_ts``.

    Given audit ids, only their partitions are listed and read. ``position`` adds
    the place of the row in its file.
    """
    ids = None if audit_ids is None else set(audit_ids)
    rows = mart.table(name, parts=lambda p: accepted(p) and (ids is None or p in ids))
    place = [csv.BLOCK, csv.SEQ] if position else []
    return rows.select(*schema.fieldNames(), "audit_id", "load_ts", *place)


def rejected_rows(mart: Mart, name: str) -> DataFrame:
    """Rows that did not parse, with file position, bad column and bad value."""
    return mart.table(name, parts=lambda p: not accepted(p))


def _load_table(mart: Mart, table: str, plan: DataFrame, paths: Sequence[str], schema: T.StructType,
                run_ts: str, multiline: bool | None) -> DataFrame:
    """Reads and writes the table's new files in one job; statistics come from what was written."""
    rows = csv.typed(csv.read_batch_csv(mart.spark, paths, schema, multiline), schema)
    stamped = lg.stamp(rows, plan).withColumn("load_ts", F.lit(run_ts).cast("timestamp"))
    bad = F.col(csv.BAD_COLUMN).isNotNull()
    part = F.when(bad, F.concat("audit_id", F.lit(REJECTED))).otherwise(F.col("audit_id"))
    state = mart.append_part(table, stamped, part)
    stats = lg.load_stats(mart.table(table, parts=lambda p: state.live.get(p) == state.folder))
    return lg.located_errors(stats, schema.fieldNames())


def load_files(
    mart: Mart,
    files: DataFrame,
    schemas: Mapping[str, T.StructType],
    run_id: str,
    run_ts: str | None = None,
    reload: Sequence[str] = (),
    multiline: bool | None = None,
) -> DataFrame:
    """Loads the files the ledger does not know yet; returns one status per file.

    All new files of a raw table are read by one Spark job, and the tables load side
    by side. A table's rows become visible only when their ledger rows are appended,
    which is the last step; a load that dies before it leaves nothing a reader can
    see. If a table's job fails, its files are tried once more one by one, so that one
    unreadable file does not hold back the others; it is reported as FAILED and gets
    no ledger row. Files in ``reload`` are loaded although the ledger knows them.
    """
    spark = mart.spark
    run_ts = run_ts or spark.sql("select cast(current_timestamp() as string)").first()[0]
    known = lg.read_ledger(mart)
    routed = route_paths(files)
    for row in routed.filter(F.col("target_table").isNull()).select("filepath").collect():
        log.warning("no raw table for %s", row["filepath"])
    todo = lg.unprocessed(routed.filter(F.col("target_table").isNotNull()), known, reload)
    wanted = lg.allocate_ids(todo, known, run_ts, ("month_tag", "filepath"))
    fields = ["filepath", "target_table", "audit_id", "audit_ts"]
    # file names only: the driver needs them as reader paths
    planned = wanted.select(*fields).withColumn("audit_ts", F.col("audit_ts").cast("string")).collect()

    def load_one(table: str) -> list[tuple[str, str, str]]:
        batch = [p for p in planned if p["target_table"] == table]
        failed = []
        try:
            _commit_files(mart, table, batch, schemas[table], run_id, run_ts, multiline, bool(reload))
        except Exception as error:
            log.warning("loading %s failed, trying its files one by one: %s", table, _first_line(error))
            for one in batch:
                try:
                    _commit_files(mart, table, [one], schemas[table], run_id, run_ts, multiline, bool(reload))
                except Exception as again:
                    log.error("loading %s failed: %s", one["filepath"], _first_line(again))
                    failed.append((one["filepath"], table, lg.FAILED))
        return failed

    tables = sorted({p["target_table"] for p in planned})
    # what an earlier load left without a ledger row goes first, as its audit id may come again
    run_together(spark, [partial(purge_unaudited, mart, t) for t in tables if mart.exists(t)])
    results = [f for found in run_together(spark, [partial(load_one, t) for t in tables]) for f in found]
    failed = spark.createDataFrame(results, RESULT)
    done = spark.createDataFrame([(p["filepath"],) for p in planned], "filepath string")
    loaded = lg.read_ledger(mart).filter(F.col("dag_run_id") == run_id).join(done, "filepath", "left_semi")
    return loaded.select("filepath", "target_table", "status").unionByName(failed)


def _first_line(error: Exception) -> str:
    return str(error).partition("\n")[0]


def _commit_files(mart, table, batch, schema, run_id, run_ts, multiline, reloaded) -> None:
    rows = [(p["filepath"], p["target_table"], p["audit_id"], p["audit_ts"]) for p in batch]
    plan = mart.spark.createDataFrame(rows, "filepath string, target_table string, audit_id string, audit_ts string")
    plan = plan.withColumn("audit_ts", F.col("audit_ts").cast("timestamp"))
    paths = [readable_path(p["filepath"]) for p in batch]
    stats = _load_table(mart, table, plan, paths, schema, run_ts, multiline)
    label = f"{batch[0]['audit_id']}-{batch[-1]['audit_id']}-{table}"
    entries = lg.record_load(plan, stats, run_id)
    # one row per file: computed side by side, so that only the append itself waits its turn
    ready = mart.spark.createDataFrame(entries.toArrow(), entries.schema)
    with _LEDGER_WRITER:
        lg.append_ledger(mart, ready, label, reloaded)


def purge_unaudited(mart: Mart, table: str) -> list[str]:
    """Drops raw partitions that no ledger row of the table vouches for."""
    ids = lg.read_ledger(mart).filter(F.col("target_table") == table).select("audit_id")
    parts = mart.batches(table)
    have = mart.spark.createDataFrame([(p, p.removesuffix(REJECTED)) for p in parts], "part string, audit_id string")
    gone = sorted(r["part"] for r in have.join(ids, "audit_id", "left_anti").collect())
    mart.drop_parts(table, gone)
    return gone
