"""Type-2 history: change detection, one step, and the one-shot history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermart.functions.text import KEY_SEPARATOR
from ledgermart.operators.keys import latest_per_key

VALID_FROM, VALID_TO, SCD_ID = "valid_from", "valid_to", "scd_id"
_HAD_OPEN = "_had_open"


def _instant(text: str) -> Column:
    """A driver scalar as a timestamp, read in the session's zone."""
    return F.lit(text).cast("timestamp")


def version_id(key: str, valid_from: Column) -> Column:
    """Id of one version; microseconds keep it independent of the session's zone."""
    stamp = F.date_format(valid_from, "yyyyMMddHHmmssSSSSSS")
    return F.md5(F.concat_ws(KEY_SEPARATOR, F.col(key).cast("string"), stamp))


def _as_open(rows: DataFrame, key: str, run_ts: Column) -> DataFrame:
    return rows.withColumns(
        {VALID_FROM: run_ts, VALID_TO: F.lit(None).cast("timestamp"), SCD_ID: version_id(key, run_ts)}
    )


def changed_rows(open_rows: DataFrame, delta: DataFrame, key: str, check_cols: Sequence[str]) -> DataFrame:
    """Delta rows that start a version; ``_had_open`` says one must be closed first.

    Only the key and the compared columns of the dimension take part in the join.
    """
    narrow = open_rows.select(key, *[F.col(c).alias(f"_old_{c}") for c in check_cols], F.lit(True).alias(_HAD_OPEN))
    joined = delta.join(narrow, key, "left")
    same = F.col(_HAD_OPEN).isNotNull()
    for c in check_cols:
        same &= F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    return joined.filter(~same).select(
        *delta.columns, F.coalesce(_HAD_OPEN, F.lit(False)).alias(_HAD_OPEN)
    )


def open_versions(changed: DataFrame, key: str, run_ts: str) -> DataFrame:
    """The versions that start with this run."""
    return _as_open(changed.drop(_HAD_OPEN), key, _instant(run_ts))


def keys_to_close(changed: DataFrame, key: str) -> DataFrame:
    return changed.filter(_HAD_OPEN).select(key)


def scd2_first(delta: DataFrame, key: str, run_ts: str) -> DataFrame:
    """First run: every delta row opens a version."""
    return _as_open(delta, key, _instant(run_ts))


def scd2_apply(dim: DataFrame, delta: DataFrame, key: str, check_cols: Sequence[str], run_ts: str) -> DataFrame:
    """The dimension after one batch, in one pass over both inputs.

    New key: opens a version. Changed key: closes the open version and opens one.
    Unchanged key, or a key absent from the delta: left alone. Closed versions are
    passed through without taking part in the join. The delta has one row per key.
    """
    columns = dim.columns
    fresh = _as_open(delta, key, _instant(run_ts)).select(*columns)
    old = dim.filter(F.col(VALID_TO).isNull()).select(F.col(key).alias("_k_old"), F.struct(*columns).alias("_old"))
    new = fresh.select(F.col(key).alias("_k_new"), F.struct(*columns).alias("_new"))
    pair = old.join(new, F.col("_k_old") == F.col("_k_new"), "full_outer")

    same = F.lit(True)
    for c in check_cols:
        same &= F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    closed = F.col("_old").withField(VALID_TO, _instant(run_ts))
    versions = (
        F.when(F.col("_k_old").isNull(), F.array("_new"))
        .when(F.col("_k_new").isNull() | same, F.array("_old"))
        .otherwise(F.array(closed, F.col("_new")))
    )
    touched = pair.select(F.inline(versions)).select(*columns)
    return dim.filter(F.col(VALID_TO).isNotNull()).unionByName(touched)


def scd2_history(
    changes: DataFrame,
    key: str,
    check_cols: Sequence[str],
    batch_col: str,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """All versions at once from a full change log.

    The log is first reduced to the last state per key and batch, which is all a
    batch-wise fold can see. A key then holds at most one row per batch, so the
    history window stays bounded by the number of batches however hot the key is.
    """
    states = latest_per_key(changes, [key, batch_col], list(order_by), list(check_cols)) if order_by else changes
    order = Window.partitionBy(key).orderBy(batch_col)
    previous = F.lag(F.struct(*check_cols)).over(order)
    starts = states.withColumn("_start", ~previous.eqNullSafe(F.struct(*check_cols))).filter("_start").drop("_start")
    return starts.withColumns({VALID_FROM: F.col(batch_col), VALID_TO: F.lead(batch_col).over(order)}).withColumn(
        SCD_ID, version_id(key, F.col(VALID_FROM))
    )


def dim_current(dim: DataFrame) -> DataFrame:
    """Open versions with the current flag."""
    return dim.filter(F.col(VALID_TO).isNull()).withColumn("is_current", F.col(VALID_TO).isNull())
