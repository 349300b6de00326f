"""Landed files: listing, routing by path, batch selection, completeness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Path fragment -> raw table.
ROUTES = (
    ("certificates", "display", "raw_display_certificates"),
    ("certificates", "domestic", "raw_domestic_certificates"),
    ("certificates", "non_domestic", "raw_non_domestic_certificates"),
    ("recommendations", "display", "raw_display_recommendations"),
    ("recommendations", "domestic", "raw_domestic_recommendations"),
    ("recommendations", "non_domestic", "raw_non_domestic_recommendations"),
)
ROUTE_PATTERN = r"/(?:kind=)?(certificates|recommendations)/(?:domain=)?(display|domestic|non_domestic)/"
MONTH_PATTERN = r"[_=](\d{4}-(?:0[1-9]|1[0-2]))(?:\.csv|/)"


class IncompleteBatch(RuntimeError):
    """Not all expected files of a batch are there."""


def list_files(spark: SparkSession, root: str, pattern: str = "*.csv*") -> DataFrame:
    """Files below a folder. Contents are not read: the column is never selected."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return listing.select(
        F.col("_metadata.file_path").alias("filepath"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )


def readable_path(file_path: str) -> str:
    """A listed file URI as a path for a reader."""
    return unquote(file_path)


def routes_table(spark: SparkSession, routes: Sequence[tuple[str, str, str]] = ROUTES) -> DataFrame:
    return spark.createDataFrame(list(routes), "kind string, domain string, target_table string")


def month_tag_of(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, MONTH_PATTERN, 1), F.lit(""))


def route_paths(
    files: DataFrame,
    path_col: str = "filepath",
    routes: Sequence[tuple[str, str, str]] = ROUTES,
) -> DataFrame:
    """Adds kind, domain, target table and month tag; unmatched files get NULLs."""
    path = F.col(path_col)
    tagged = files.withColumns(
        {
            "kind": F.nullif(F.regexp_extract(path, ROUTE_PATTERN, 1), F.lit("")),
            "domain": F.nullif(F.regexp_extract(path, ROUTE_PATTERN, 2), F.lit("")),
            "month_tag": month_tag_of(path),
        }
    )
    table = F.broadcast(routes_table(files.sparkSession, routes))  # a handful of literals
    return tagged.join(table, ["kind", "domain"], "left")


def previous_month_tag(today: datetime | None = None, lag_months: int = 1) -> Column:
    """``yyyy-MM`` of an earlier month, by default the one before the current."""
    day = F.current_date() if today is None else F.lit(today).cast("date")
    return F.date_format(F.add_months(F.trunc(day, "MM"), -lag_months), "yyyy-MM")


def select_batch(
    files: DataFrame,
    month_tag: str | None = None,
    paths: DataFrame | None = None,
    path_col: str = "filepath",
    lag_months: int = 1,
) -> DataFrame:
    """Files to work on: an explicit path list, else one month, else the last month."""
    if paths is not None:
        wanted = paths.select(F.trim(F.col(path_col)).alias(path_col)).distinct()
        return files.join(wanted, path_col, "left_semi")
    if month_tag is not None:
        datetime.strptime(month_tag, "%Y-%m")  # rejects a malformed tag
        return files.filter(F.col(path_col).contains(month_tag))
    return files.filter(F.col(path_col).contains(previous_month_tag(lag_months=lag_months)))


def missing_files(files: DataFrame, expected: DataFrame, key: Sequence[str]) -> DataFrame:
    """Expected keys without a file."""
    return expected.join(files.select(*key).distinct(), list(key), "left_anti")


def assert_complete(files: DataFrame, expected: DataFrame, key: Sequence[str]) -> None:
    """Raises unless every expected key has a file. ``expected`` is one batch's list."""
    missing = [tuple(r) for r in missing_files(files, expected, key).orderBy(*key).collect()]
    if missing:
        raise IncompleteBatch(f"missing files: {missing}")
