"""The query registry and the helpers queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.operators.store import Mart
from ledgermart.session import new_work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under a name, with its SQL counterpart where there is one."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def new_mart(spark: SparkSession, label: str) -> Mart:
    """A mart of its own for one run of a query."""
    return Mart(spark, new_work_dir(spark, label))


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the test tables have them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema
        ]
    )
