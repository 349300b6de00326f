"""Exact distinct counts that merge without their values.

A dictionary in the mart gives every value of a measure a number, once. A batch's distinct
values are then bitmaps over these numbers, one for each block of 32,768, and the
distinct values of many batches are the bitwise or of their bitmaps: a run looks at the
values of its new batches, the dictionary and bitmaps, never at old batches' values.

Numbers are dealt by hash bucket, each with a range of its own in which they are dense,
so that numbering is side by side and bitmaps stay full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermart.operators.keys import missing_keys
from ledgermart.operators.kpi import BITS, BLOCK, MEASURE, VALUE, Metric, kpi_partials, merged_sums
from ledgermart.operators.store import Mart
from ledgermart.session import new_work_dir

NUMBER, BUCKET = "number", "bucket"
#: Hash buckets of a dictionary, and the bits of a bucket's range of numbers.
BUCKETS = 64
RANGE_BITS = 40
#: The measure of the rows that carry sums.
SUMS = "sums"


def number_values(mart: Mart, dictionary: str, values: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(measure, value, number) of all values known after ``values`` (measure, value); new ones are added.

    Numbers never change, and running it again with the same values adds nothing. NULL is no value.
    """
    fresh = values.select(MEASURE, VALUE).filter(F.col(VALUE).isNotNull()).distinct()
    place = F.pmod(F.xxhash64(MEASURE, VALUE), F.lit(buckets)).cast("int")
    first = F.col(BUCKET) * F.lit(1 << RANGE_BITS)
    state = mart.state(dictionary)
    if state:
        known = mart.table(dictionary)
        highest = known.groupBy(BUCKET).agg((F.max(NUMBER) + 1).alias("_next"))  # at most a row for each bucket
        fresh = missing_keys(fresh, known, [MEASURE, VALUE]).withColumn(BUCKET, place)
        fresh = fresh.join(F.broadcast(highest), BUCKET, "left").withColumn("_next", F.coalesce("_next", first))
    else:
        fresh = fresh.withColumn(BUCKET, place).withColumn("_next", first)
    turn = F.row_number().over(Window.partitionBy(BUCKET).orderBy(MEASURE, VALUE)) - 1
    numbered = fresh.withColumn(NUMBER, (F.col("_next") + turn).cast("bigint"))
    mart.append_part(dictionary, numbered.select(MEASURE, VALUE, BUCKET, NUMBER), f"run-{state.version + 1 if state else 1:08d}")
    return mart.table(dictionary).select(MEASURE, VALUE, NUMBER)


def bitmap_partials(values: DataFrame, numbers: DataFrame, keys: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """Partials with bitmaps for partials with values: (keys, measure, block, sums, bits).

    ``values`` are ``kpi_partials`` of metrics that count distinct values, ``numbers`` has
    a number for each of them. Sums stand once for each key, in a row without bits.
    """
    sums = merged_sums(values, keys, metrics).withColumns({MEASURE: F.lit(SUMS), BLOCK: F.lit(0).cast("bigint"), BITS: F.lit(None).cast("binary")})
    known = values.filter(F.col(VALUE).isNotNull()).select(*keys, MEASURE, VALUE).join(numbers, [MEASURE, VALUE])
    blocks = known.groupBy(*keys, MEASURE, F.bitmap_bucket_number(NUMBER).alias(BLOCK))
    bits = blocks.agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITS))
    return sums.unionByName(bits, allowMissingColumns=True)


def append_bitmaps(
    mart: Mart, name: str, fact: DataFrame, batch_col: str, metrics: Sequence[Metric], split: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Adds the partials of the fact's batches newer than those stored under ``name``; all stored partials.

    The fact is scanned once. The values of the new batches are written out before they
    are numbered, so that a repeated task can't see other numbers. The dictionary is ``name``_values.
    """
    keys = [batch_col] + ([split] if split else [])
    after = mart.watermark(name)
    fresh = fact if after is None else fact.filter(F.col(batch_col) > F.lit(after))
    found = kpi_partials(fresh, batch_col, metrics, split)
    work = new_work_dir(mart.spark, f"values-{name}")
    found.write.parquet(work)
    values = mart.spark.read.schema(found.schema).parquet(work)
    numbers = number_values(mart, f"{name}_values", values, buckets)
    return mart.append_new(name, bitmap_partials(values, numbers, keys, metrics), batch_col, regroup=True)
