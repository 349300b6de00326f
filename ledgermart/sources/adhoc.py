"""Ad-hoc reads of landed objects and API payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class UnsupportedFile(ValueError):
    """The extension names no supported format."""


def _format_of(path: str) -> str:
    name = path.rstrip("/").removesuffix(".gz")
    for extension in ("csv", "json"):
        if name.endswith(f".{extension}"):
            return extension
    raise UnsupportedFile(f"only .csv and .json are supported: {path}")


def read_any(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header or JSON lines, chosen by extension. Pass a schema for large data:
    without one Spark reads the files an extra time to infer it."""
    reader = spark.read.schema(schema) if schema else spark.read
    if _format_of(path) == "csv":
        header = reader.option("header", "true").option("escape", '"')
        return header.csv(path) if schema else header.option("inferSchema", "true").csv(path)
    return reader.json(path)


def read_api_dump(
    spark: SparkSession,
    path: str,
    row_schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Landed API pages: JSON documents with a ``rows`` array, or CSV with header."""
    if _format_of(path) == "csv":
        return read_any(spark, path, row_schema)
    reader = spark.read.option("multiLine", str(multiline).lower())
    if row_schema is not None:
        reader = reader.schema(T.StructType([T.StructField("rows", T.ArrayType(row_schema))]))
    return reader.json(path).select(F.explode("rows").alias("row")).select("row.*")
