"""Declarative data checks as gates between layers.

All row and value-set checks of a table are one pass over it; key checks aggregate
by the key first, so hot keys are combined before they travel.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.operators.keys import orphan_keys
from ledgermart.operators.parallel import run_together
from ledgermart.session import new_work_dir

NOT_NULL, UNIQUE, RELATIONSHIPS = "not_null", "unique", "relationships"
ACCEPTED, IN_SET, BETWEEN = "accepted_values", "distinct_values_in_set", "values_between"
RESULT = ("test", "table_name", "column_name", "failures")


class CheckFailure(RuntimeError):
    """At least one check found failing rows."""


@dataclass(frozen=True)
class Check:
    test: str
    table: str
    column: str
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    strictly: bool = False
    parent: str = ""
    parent_column: str = ""
    nulls: str = "pass"


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(NOT_NULL, table, c) for c in columns]


def unique(table: str, column: str) -> Check:
    """``column`` may name several, separated by commas."""
    return Check(UNIQUE, table, column)


def relationship(table: str, column: str, parent: str, parent_column: str | None = None) -> Check:
    return Check(RELATIONSHIPS, table, column, parent=parent, parent_column=parent_column or column)


def accepted_values(table: str, column: str, values: Sequence[str]) -> Check:
    return Check(ACCEPTED, table, column, values=tuple(values))


def in_set(table: str, column: str, values: Sequence[str], nulls: str = "pass") -> Check:
    """The distinct values lie in the set; ``nulls`` says if NULL does ("pass" or "fail")."""
    return Check(IN_SET, table, column, values=tuple(values), nulls=nulls)


def between(table: str, column: str, low: float, high: float, strictly: bool = False) -> Check:
    """Inclusive unless ``strictly``; NULL passes."""
    return Check(BETWEEN, table, column, low=low, high=high, strictly=strictly)


def _row_fails(check: Check) -> Column:
    c = F.col(check.column)
    if check.test == NOT_NULL:
        return c.isNull()
    if check.strictly:
        return ~((c > check.low) & (c < check.high))
    return ~c.between(check.low, check.high)


def _value_fails(check: Check) -> Column:
    c = F.col(check.column)
    outside = ~c.isin(*check.values)
    if check.nulls == "fail":
        return F.coalesce(outside, F.lit(True))
    return F.coalesce(outside, F.lit(False))


def _keys(check: Check) -> list[str]:
    return [k.strip() for k in check.column.split(",")]


def failing_rows(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Evidence of one check: rows, or the offending values with their row count."""
    df = tables[check.table]
    if check.test in (NOT_NULL, BETWEEN):
        return df.filter(_row_fails(check))
    if check.test in (ACCEPTED, IN_SET):
        bad = df.filter(_value_fails(check))
        return bad.groupBy(F.col(check.column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    if check.test == UNIQUE:
        keys = _keys(check)
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        counted = df.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
        return counted.filter(F.col("n_rows") > 1)
    if check.test == RELATIONSHIPS:
        return orphan_keys(df, check.column, tables[check.parent], check.parent_column)
    raise ValueError(f"unknown check {check.test}")


def _as_rows(one_row: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Columns f0, f1, … of a one-row frame as result rows."""
    cells = [
        F.struct(
            F.lit(c.test).alias("test"),
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.col(f"f{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return one_row.select(F.inline(F.array(*cells)))


def _table_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row and value-set checks of a table in one pass.

    Row checks alone are one aggregation. Otherwise a failing cell becomes (check, offending value); a row check keeps no value.
    These are counted per check and value where they are found, so clean rows never
    leave the scan's stage and frequent failures travel as one row per task. A row
    check's failures are rows, a set check's are distinct values.
    """
    if all(c.test in (NOT_NULL, BETWEEN) for c in checks):
        counts = [F.count_if(_row_fails(c)).alias(f"f{i}") for i, c in enumerate(checks)]
        return _as_rows(df.agg(*counts), checks)
    cells, failures = [], []
    for i, c in enumerate(checks):
        by_value = c.test in (ACCEPTED, IN_SET)
        fails = _value_fails(c) if by_value else _row_fails(c)
        value = F.col(c.column).cast("string") if by_value else F.lit(None).cast("string")
        cells.append(F.when(fails, F.struct(F.lit(i).alias("check"), value.alias("value"))))
        mine = F.when(F.col("check") == i, F.lit(1) if by_value else F.col("n"))
        failures.append(F.coalesce(F.sum(mine), F.lit(0)).cast("bigint").alias(f"f{i}"))
    found = df.select(F.inline(F.array_compact(F.array(*cells))))
    return _as_rows(found.groupBy("check", "value").agg(F.count(F.lit(1)).alias("n")).agg(*failures), checks)


def _key_check(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    found = failing_rows(check, tables)
    failures = F.count(F.lit(1)) if check.test == UNIQUE else F.coalesce(F.sum("n_rows"), F.lit(0))
    return _as_rows(found.agg(failures.cast("bigint").alias("f0")), [check])


def checked_copies(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> dict[str, DataFrame]:
    """The columns the checks look at, written once per table to the shared folder.

    For tables that are costly views: several checks then read a narrow copy
    instead of each computing the view.
    """
    used: dict[str, dict[str, None]] = {t: {} for t in tables}
    for c in checks:
        used.get(c.table, {}).update(dict.fromkeys(_keys(c)))
        if c.parent in used:
            used[c.parent][c.parent_column] = None

    def copy(name: str) -> DataFrame:
        narrow = tables[name].select(*used[name])
        folder = new_work_dir(narrow.sparkSession, f"checked-{name}")
        narrow.write.parquet(folder)
        return narrow.sparkSession.read.schema(narrow.schema).parquet(folder)

    wanted = [t for t in tables if used[t]]
    copies = run_together(tables[wanted[0]].sparkSession, [partial(copy, t) for t in wanted])
    return dict(zip(wanted, copies))


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: test, table, column and number of failures."""
    checks = list(checks)
    results = []
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table]
        of_rows = [c for c in mine if c.test not in (UNIQUE, RELATIONSHIPS)]
        if of_rows:
            results.append(_table_checks(tables[table], of_rows))
        results += [_key_check(c, tables) for c in mine if c.test in (UNIQUE, RELATIONSHIPS)]
    return reduce(DataFrame.unionByName, results)


def gate(results: DataFrame) -> None:
    """Raises if any check failed; the result has one row per declared check."""
    failed = [tuple(r) for r in results.filter(F.col("failures") > 0).orderBy(*RESULT).collect()]
    if failed:
        raise CheckFailure(f"failed checks: {failed}")
