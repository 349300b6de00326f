"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermart.session import new_work_dir

#: Ordered buckets are sized for so many rows, and the list of their bounds is at most so long.
BUCKET_ROWS = 1024
MAX_BUCKETS = 65_536


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: evaluated once, and safe when executors are lost."""
    path = new_work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8(text: str | None) -> bytes:
    """Null is the empty text. Lone surrogates can't be in Spark strings."""
    return b"" if text is None else text.encode("utf-8")


def runs(batches: Iterable[pa.RecordBatch], keys: list[str], at_most: int | None = None) -> Iterator[tuple[pa.Table, bool]]:
    """Consecutive rows with equal non-null long ``keys``, from batches sorted by them.

    Gives (table, False) for each run of two rows or more. A run that reaches
    ``at_most`` rows isn't gathered: it comes in parts, as (table, True).
    """
    held: list[pa.RecordBatch] = []
    held_key: tuple | None = None
    parted = False

    def flush(over: bool) -> Iterator[tuple[pa.Table, bool]]:
        if held and (over or parted or sum(b.num_rows for b in held) > 1):
            yield pa.Table.from_batches(held), over or parted
        held.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = np.concatenate(([0], np.flatnonzero(change) + 1, [batch.num_rows]))
        alone = (cuts[1:] - cuts[:-1]) == 1
        alone[[0, -1]] = False
        for x, y in zip(cuts[:-1][~alone].tolist(), cuts[1:][~alone].tolist()):
            key = tuple(c[x] for c in columns)
            if key != held_key:
                yield from flush(False)
                held_key, parted = key, False
            held.append(batch.slice(x, y - x))
            if at_most and sum(b.num_rows for b in held) >= at_most:
                yield from flush(True)
                parted = True
    yield from flush(False)


def order_bounds(df: DataFrame, key: str, rows: int, bucket_rows: int = BUCKET_ROWS) -> list[int]:
    """Ascending values of a long column that cut its order into buckets of about ``bucket_rows`` rows.

    They only spread the work: results don't depend on them. At most MAX_BUCKETS - 1
    values reach the driver, whatever the input.
    """
    n = max(1, min(MAX_BUCKETS, rows // bucket_rows))
    if n == 1:
        return []
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 4 * n).alias("cuts")).first()["cuts"]
    return sorted(set(cuts or []))


def order_bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds the key reaches; 0 for null. Found in two steps, so that long lists cost little a row."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.lit([b[0] for b in blocks])
    block = F.size(F.filter(heads, lambda x: x <= key))
    inner = F.element_at(F.lit(blocks), block)
    found = (block - 1) * step + F.size(F.filter(inner, lambda x: x <= key))
    return F.when(block > 0, found).otherwise(0).cast("int")


def global_rank(df: DataFrame, order: list[str], bounds: list[int], name: str) -> DataFrame:
    """Rows numbered from 0 in an order whose first column is a long one cut by ``bounds``.

    Buckets are numbered side by side and moved by the sizes of those before them.
    ``df`` must give the same rows each time it is read.
    """
    b = free_name(df, "bucket")
    cut = df.withColumn(b, order_bucket(F.col(order[0]), bounds))
    sizes = cut.groupBy(b).agg(F.count(F.lit(1)).alias("in_bucket"))
    before = Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_BUCKETS rows
    offsets = sizes.select(b, F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("rows_before"))
    own = F.row_number().over(Window.partitionBy(b).orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    return (
        cut.withColumn(name, own - 1)
        .join(F.broadcast(offsets), b)
        .withColumn(name, F.col(name).cast("long") + F.col("rows_before"))
        .drop(b, "rows_before")
    )


def components(spark: SparkSession, links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of links between long ids: (node, root), for linked nodes only.

    In each round every node joins the neighbour that comes first in the round's
    random order, and links between joined nodes are renamed; on average a constant
    part of the nodes goes away, also on chains and stars. Each round's tables are
    written to the shared folder; nothing is gathered on the driver. The root is some
    node of the component, the same for all of its nodes.
    """
    left = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = written(left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    roots = written(edges.select(F.col("u").alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        draw = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), c.alias("id"))
        near = edges.groupBy("u").agg(F.min(draw(F.col("v"))).alias("m"))
        own = draw(F.col("u"))
        into = written(near.select("u", F.least(F.col("m"), own)["id"].alias("to")), "join")
        at_u = into.select("u", F.col("to").alias("tu"))
        at_v = into.select(F.col("u").alias("v"), F.col("to").alias("tv"))
        edges = written(
            edges.join(at_u, "u").join(at_v, "v").filter("tu <> tv").select(F.col("tu").alias("u"), F.col("tv").alias("v")).distinct(),
            "links",
        )
        moved = into.select(F.col("u").alias("root"), "to")
        roots = written(roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
    return roots
