"""The queries behind the dashboard's visuals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.functions.numbers import ratio
from ledgermart.operators.sizing import broadcast_if_small


def average_card(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row of averages: output name -> column."""
    return df.agg(*[F.avg(c).alias(name) for name, c in columns.items()])


def headline_card(cards: Sequence[DataFrame]) -> DataFrame:
    """Several one-row results side by side. Each part must be an ungrouped aggregate."""
    return reduce(lambda left, right: left.crossJoin(F.broadcast(right)), cards)


def latest_batch(kpi: DataFrame, batch_col: str) -> DataFrame:
    """Rows of the newest batch."""
    newest = F.broadcast(kpi.agg(F.max(batch_col).alias(batch_col)))
    return kpi.join(newest, batch_col, "left_semi")


def count_by(df: DataFrame, groups: Sequence[str], counted: str, name: str = "n") -> DataFrame:
    """Non-NULL count per group, largest first."""
    return df.groupBy(*groups).agg(F.count(counted).alias(name)).orderBy(F.desc(name), *groups)


def share_of_total(df: DataFrame, group: str, counted: str) -> DataFrame:
    """Count per group and its share of the grand total."""
    counts = df.groupBy(group).agg(F.count(counted).alias("n"))
    whole = counts.agg(F.sum("n").alias("_whole"))
    shared = counts.crossJoin(F.broadcast(whole))
    return shared.select(group, "n", ratio(F.col("n"), F.col("_whole")).alias("share")).orderBy(F.desc("n"), group)


def ratio_to_total(df: DataFrame, group: str, value: str) -> DataFrame:
    """Group average divided by the average over everything, from one scan."""
    parts = df.groupBy(group).agg(F.sum(F.col(value).cast("double")).alias("_s"), F.count(value).alias("_n"))
    whole = parts.agg(ratio(F.sum("_s"), F.sum("_n")).alias("_whole"))
    mean = ratio(F.col("_s"), F.col("_n"))
    joined = parts.crossJoin(F.broadcast(whole))
    return joined.select(group, mean.alias("avg_value"), ratio(mean, F.col("_whole")).alias("ratio_to_total"))


def month_labels(fact: DataFrame, batch_key: str, labels: DataFrame, label: str) -> DataFrame:
    """Batch -> month label lookup; an unknown batch gets NULL."""
    return fact.join(broadcast_if_small(labels.select(batch_key, label)), batch_key, "left")


def default_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The sum of every given numeric column."""
    return df.agg(*[F.sum(c).alias(f"sum_{c}") for c in columns])


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Column chart as a table: one row per ``row``, one count per value of ``column``."""
    cells: list[Column] = [F.count_if(F.col(column) == F.lit(v)).alias(f"{column}_{v}") for v in values]
    return df.groupBy(row).agg(*cells).orderBy(row)
