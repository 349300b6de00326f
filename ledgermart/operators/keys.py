"""Keyed selection: the latest row per key, set differences, the entity delta."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermart.functions.text import hash_key, identity_key
from ledgermart.operators.incremental import newer_than

_RANK, _PLACE, _HASH = "_rank", "_place", "_hash"


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str],
    tie_breakers: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per key: the highest ``order_by``, ties settled by ``tie_breakers``.

    Spark applies the rank limit before the shuffle as well as after it, so a key
    that holds a large share of the rows sends one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    window = Window.partitionBy(*keys).orderBy(
        *[F.desc(c) for c in order],
        *[c if isinstance(c, Column) else F.asc_nulls_last(c) for c in tie_breakers],
    )
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_whole_rows(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """As ``latest_per_key`` by ``order_by``, all descending with NULLs last, for readers of wide rows.

    The newest place of every key is found among narrow rows, and the whole rows are
    moved once, unsorted, to meet them; ``latest_per_key`` would sort them before that,
    which spills as soon as an input split outgrows a task's memory. Rows are dealt by
    key and place, so the older rows of a hot key go to all tasks. A place is a struct:
    its NULLs equal each other. Rows of one place are brought down to one at the end.
    ``df`` is read twice and has to give the same rows both times.
    """
    names = [key, *order_by]
    newest = latest_per_key(df.select(*names), key, order_by[0], [F.desc_nulls_last(c) for c in order_by[1:]])
    rows = df.select(F.struct(*names).alias(_PLACE), *[c for c in df.columns if c not in names])
    kept = rows.join(newest.select(F.struct(*names).alias(_PLACE)).hint("shuffle_hash"), _PLACE, "left_semi")
    # a hash before the place: rows already lie together by place, and numbers sort faster than structs
    one = latest_per_key(kept.withColumn(_HASH, F.xxhash64(_PLACE)), [_HASH, _PLACE], _HASH)
    return one.select(*[F.col(_PLACE)[c].alias(c) if c in names else F.col(c) for c in df.columns])


def conform(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Exactly ``columns`` (name -> type), missing ones as typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns.items()]
    )


def union_conformed(frames: Sequence[DataFrame], columns: Mapping[str, str]) -> DataFrame:
    """Union of all rows of frames brought to one shape."""
    return reduce(DataFrame.unionByName, [conform(f, columns) for f in frames])


def missing_keys(wanted: DataFrame, present: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``wanted`` whose key does not occur in ``present``."""
    keys = [key] if isinstance(key, str) else list(key)
    return wanted.join(present.select(*keys), keys, "left_anti")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their number of rows.

    The child is aggregated before the join, so a hot value travels once per task.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    parents = parent.select(F.col(parent_column).alias("value")).distinct()
    return values.agg(F.count(F.lit(1)).alias("n_rows")).join(parents, "value", "left_anti")


def entity_delta(
    sources: Sequence[DataFrame],
    columns: Mapping[str, str],
    *,
    id_col: str,
    identity_cols: Sequence[str],
    identity_raw_cols: Sequence[str],
    state_cols: Sequence[str],
    ts_col: str,
    key_name: str,
    state_name: str,
    watermark: str | None = None,
) -> DataFrame:
    """Latest state per entity over several sources, newer than the watermark."""
    fresh = [s.filter(newer_than(ts_col, watermark)) for s in sources]
    keyed = union_conformed(fresh, columns).withColumns(
        {
            key_name: identity_key(id_col, identity_cols, identity_raw_cols),
            state_name: hash_key(state_cols),
        }
    )
    others = [c for c in columns if c != ts_col]
    return latest_per_key(keyed, key_name, ts_col, [state_name, *others])
