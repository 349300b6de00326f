"""Per-batch and whole-history KPIs from one set of mergeable partials.

A metric is declared over SQL expressions of the fact's columns and reduced to
additive sums plus, where it counts distinct values, the set of distinct values.
Both merge: the fact is scanned once, and batch, split and whole-history figures
are rolled up from the partials. A mart that stores the partials by batch never
rescans old facts to refresh the global figures.

The set of distinct values has three forms. As values it is exact and as large as
they are. As bitmaps over numbered values (``operators.bitmaps``) it is exact, and a merge
is a bitwise or. As a sketch it is an estimate whose size doesn't depend on the values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.functions.numbers import ratio, rounded, share_percent
from ledgermart.operators.incremental import newer_than

MEASURE, VALUE = "measure", "value"
#: Columns of partials that hold bitmaps in place of values.
BLOCK, BITS = "block", "bits"
TOTAL_LABEL = "ALL"
ONE = "1L"
#: A sketch has 2^LG_K registers: about as many bytes, whatever it has seen.
LG_K = 14


@dataclass(frozen=True)
class Metric:
    """``sums``, ``distinct`` and ``sketched`` are SQL texts; ``finish`` combines their totals, in this order."""

    name: str
    total: str | None
    finish: Callable[..., Column] = field(repr=False)
    sums: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()
    digits: int | None = 2
    total_digits: int | None = 2
    sketched: tuple[str, ...] = ()


def mean(name: str, total: str | None, expr: str, digits: int | None = 2, total_digits: int | None = 2) -> Metric:
    """Average of the non-NULL values."""
    parts = (f"cast({expr} as double)", f"cast(({expr}) is not null as bigint)")
    return Metric(name, total, ratio, parts, (), digits, total_digits)


def percent(name: str, total: str | None, predicate: str) -> Metric:
    """Share of all rows that satisfy the predicate; an unknown predicate does not."""
    hits = f"cast(coalesce({predicate}, false) as bigint)"
    return Metric(name, total, share_percent, (hits, ONE))


def ratio_of_sums(name: str, total: str | None, numerator: str, denominator: str) -> Metric:
    return Metric(name, total, ratio, (f"cast({numerator} as double)", f"cast({denominator} as double)"))


def weighted_mean(name: str, total: str | None, value: str, weight: str) -> Metric:
    return ratio_of_sums(name, total, f"({value}) * ({weight})", weight)


def row_count(name: str, total: str | None) -> Metric:
    return Metric(name, total, lambda n: n, (ONE,), (), None, None)


def distinct_count(name: str, total: str | None, expr: str) -> Metric:
    return Metric(name, total, lambda n: n, (), (expr,), None, None)


def distinct_per_key(name: str, total: str | None, item: str, key: str) -> Metric:
    """Distinct items divided by distinct keys."""
    return Metric(name, total, ratio, (), (item, key))


def rows_per_key(name: str, total: str | None, key: str) -> Metric:
    """True mean number of rows per distinct key."""
    return Metric(name, total, ratio, (ONE,), (key,))


def sketched_count(name: str, total: str | None, expr: str) -> Metric:
    """Estimated number of distinct values; ``standard_error`` says how good it is."""
    return Metric(name, total, lambda n: n, digits=None, total_digits=None, sketched=(expr,))


def sketched_per_key(name: str, total: str | None, item: str, key: str) -> Metric:
    """Estimated distinct items divided by estimated distinct keys."""
    return Metric(name, total, ratio, sketched=(item, key))


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a merged sketch's estimate."""
    return 1.04 / 2 ** (lg_k / 2)


class _Parts:
    """Column names of the partials a set of metrics needs."""

    def __init__(self, metrics: Sequence[Metric]):
        sums = dict.fromkeys(text for m in metrics for text in m.sums)
        distinct = dict.fromkeys(text for m in metrics for text in m.distinct)
        sketched = dict.fromkeys(text for m in metrics for text in m.sketched)
        if distinct and sketched:
            raise ValueError("a set of metrics counts distinct values exactly or by sketches, not both")
        self.sums = {text: f"s{i}" for i, text in enumerate(sums)}
        self.distinct = {text: f"d{i}" for i, text in enumerate(distinct)}
        self.sketched = {text: f"h{i}" for i, text in enumerate(sketched)}

    def merge_sums(self) -> list[Column]:
        return [F.sum(name).alias(name) for name in self.sums.values()]

    def merge_sketches(self) -> list[Column]:
        return [F.hll_union_agg(name).alias(name) for name in self.sketched.values()]

    def finish(self, metric: Metric, digits: int | None) -> Column:
        names = [self.sums[t] for t in metric.sums] + [self.distinct[t] for t in metric.distinct]
        estimates = [F.hll_sketch_estimate(self.sketched[t]) for t in metric.sketched]
        return rounded(metric.finish(*[F.col(n) for n in names], *estimates), digits)


def kpi_partials(
    fact: DataFrame, batch_col: str, metrics: Sequence[Metric], split: str | None = None, lg_k: int = LG_K
) -> DataFrame:
    """Additive partials per batch (and split) — and per distinct value, if any is counted exactly."""
    parts = _Parts(metrics)
    keys = [batch_col] + ([split] if split else [])
    # a row's own count is a literal; adding it last keeps the plans of all roll-ups
    # alike, so that they share one scan and one shuffle
    carried = {text: name for text, name in parts.sums.items() if text != ONE}
    base = fact.select(
        *keys,
        *[F.expr(text).alias(name) for text, name in carried.items()],
        *[F.expr(text).cast("string").alias(name) for text, name in (parts.distinct | parts.sketched).items()],
    )
    names = list(parts.distinct.values())
    if not names:
        counted = base.withColumns({n: F.lit(1) for t, n in parts.sums.items() if t == ONE})
        sketches = [F.hll_sketch_agg(name, lg_k).alias(name) for name in parts.sketched.values()]
        return counted.groupBy(*keys).agg(*parts.merge_sums(), *sketches)
    if len(names) == 1:
        long = base.withColumn(MEASURE, F.lit(names[0])).withColumnRenamed(names[0], VALUE)
    else:
        pairs = [F.struct(F.lit(n).alias(MEASURE), F.col(n).alias(VALUE)) for n in names]
        long = base.select(*keys, *carried.values(), F.inline(F.array(*pairs)))
    # every row appears once per measure; its sums count under the first only
    first = F.col(MEASURE) == F.lit(names[0])
    sums = [
        F.sum(F.when(first, F.lit(1) if text == ONE else F.col(name))).alias(name) for text, name in parts.sums.items()
    ]
    return long.groupBy(*keys, MEASURE, VALUE).agg(*(sums or [F.count(F.lit(1)).alias("n_rows")]))


def merged_sums(partials: DataFrame, keys: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """The sums of partials with values, once for each key."""
    sums = _Parts(metrics).merge_sums()
    return partials.groupBy(*keys).agg(*sums) if sums else partials.select(*keys).distinct()


def _roll_up(partials: DataFrame, parts: _Parts, keys: Sequence[str]) -> DataFrame:
    """Partials merged to a coarser key."""
    if BITS in partials.columns:
        merged = F.bitmap_or_agg(BITS).alias(BITS)
        return partials.groupBy(*keys, MEASURE, BLOCK).agg(*parts.merge_sums(), merged)
    if parts.distinct:
        sums = parts.merge_sums() or [F.sum("n_rows").alias("n_rows")]
        return partials.groupBy(*keys, MEASURE, VALUE).agg(*sums)
    return partials.groupBy(*keys).agg(*parts.merge_sums(), *parts.merge_sketches())


def _totals(partials: DataFrame, parts: _Parts, keys: Sequence[str]) -> DataFrame:
    """One row per key: the sums, and the number of distinct values per measure."""
    if not parts.distinct:
        return partials
    if BITS in partials.columns:
        ones = [
            F.coalesce(F.sum(F.when(F.col(MEASURE) == F.lit(name), F.bitmap_count(BITS))), F.lit(0)).alias(name)
            for name in parts.distinct.values()
        ]
        return partials.groupBy(*keys).agg(*parts.merge_sums(), *ones)
    counts = [
        F.count(F.when(F.col(MEASURE) == F.lit(name), F.col(VALUE))).alias(name)
        for name in parts.distinct.values()
    ]
    return partials.groupBy(*keys).agg(*parts.merge_sums(), *counts)


def kpi_from_partials(
    partials: DataFrame,
    batch_col: str,
    metrics: Sequence[Metric],
    split: str | None = None,
    since: str | None = None,
) -> DataFrame:
    """KPI rows of the batches after ``since`` beside the whole-history figures."""
    parts = _Parts(metrics)
    fresh = newer_than(batch_col, since)
    measures = [parts.finish(m, m.digits).alias(m.name) for m in metrics]

    by_batch = _roll_up(partials, parts, [batch_col]) if split else partials
    rows = _totals(by_batch.filter(fresh), parts, [batch_col])
    if split:
        total = rows.select(batch_col, F.lit(TOTAL_LABEL).alias(split), *measures)
        parted = _totals(partials.filter(fresh), parts, [batch_col, split])
        report = total.unionByName(parted.select(batch_col, F.col(split).cast("string").alias(split), *measures))
    else:
        report = rows.select(batch_col, *measures)

    twins = [parts.finish(m, m.total_digits).alias(m.total) for m in metrics if m.total]
    if twins:
        whole = _totals(_roll_up(by_batch, parts, []), parts, []).select(*twins)
        report = report.crossJoin(F.broadcast(whole))  # an ungrouped aggregate is one row
    return report.orderBy(batch_col, *([split] if split else []))


def kpi_report(
    fact: DataFrame,
    batch_col: str,
    metrics: Sequence[Metric],
    split: str | None = None,
    since: str | None = None,
) -> DataFrame:
    """Partials and report in one plan, for a fact without stored partials."""
    return kpi_from_partials(kpi_partials(fact, batch_col, metrics, split), batch_col, metrics, split, since)


def kpi_totals(fact: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """The whole-history figures alone, as one row."""
    parts = _Parts(metrics)
    marked = fact.withColumn("_all", F.lit(1))
    partials = _roll_up(kpi_partials(marked, "_all", metrics), parts, [])
    return _totals(partials, parts, []).select(
        *[parts.finish(m, m.total_digits).alias(m.total) for m in metrics if m.total]
    )
