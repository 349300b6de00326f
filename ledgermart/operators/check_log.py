"""Declared checks over tables that grow by batches, each run looking at the new rows only.

What a run has to know of older rows is kept in the mart: hashes of the keys that must
be unique or be found, with their numbers of rows, and what fails at present. A run adds its
keys, looks up in the older ones only those that it brings, and counts anew what fails. The result is
that of the same checks over whole tables.

In a keyed table the newest row of a key takes the place of the older ones, as a reader of
the table sees it: what failed in a replaced row no longer does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.operators import quality as q
from ledgermart.operators.sizing import BROADCAST_ROWS, broadcast_if_small
from ledgermart.operators.store import Mart
from ledgermart.session import new_work_dir

_KEYS = "source string, r1 bigint, r2 bigint, n bigint"
_LIVE = "check int, table_name string, value string, r1 bigint, r2 bigint, n bigint"
_RUNS = "check int, change bigint, table_name string, high string"
_ROW, _PARENT = ["r1", "r2"], ["p1", "p2"]


def _hashes(columns: Sequence[str | Column]) -> list[Column]:
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return [F.xxhash64(F.lit(i), *texts).alias(f"r{i}") for i in (1, 2)]


def _source(table: str, columns: Sequence[str]) -> str:
    return f"{table}|{', '.join(columns)}"


class CheckLog:
    """The checks of one layer and what is known of the rows they have seen.

    ``keyed`` names the key column of tables in which newer rows replace older ones. Of these, a
    unique check or a parent may only be over the key. Another list of checks is
    another log, which begins with all rows.
    """

    def __init__(self, mart: Mart, name: str, checks: Sequence[q.Check], keyed: Mapping[str, str] | None = None):
        self.mart, self.checks, self.keyed = mart, list(checks), dict(keyed or {})
        signed = hashlib.md5(repr((self.checks, sorted(self.keyed.items()))).encode()).hexdigest()[:8]
        self.keys, self.live, self.runs = (f"{name}_{signed}_{what}" for what in ("keys", "live", "runs"))
        for c in self.checks:
            for table, column in ((c.table, c.column),) * (c.test == q.UNIQUE) + ((c.parent, c.parent_column),) * (c.test == q.RELATIONSHIPS):
                if table in self.keyed and column != self.keyed[table]:
                    raise ValueError(f"{table} is keyed by {self.keyed[table]}: {column} can't be checked by batch")

    def _stored(self, table: str, schema: str, wanted=lambda p: True) -> DataFrame:
        if not self.mart.exists(table):
            return self.mart.spark.createDataFrame([], schema)
        return self.mart.table(table, parts=wanted)

    def _turn(self) -> int:
        return len(self.mart.batches(self.runs))

    def highs(self) -> dict[str, str]:
        """How far each table has been checked, as the runs were told."""
        told = self._stored(self.runs, _RUNS).filter("table_name is not null")
        return {r["table_name"]: r["high"] for r in told.groupBy("table_name").agg(F.max("high").alias("high")).collect()}

    def reset(self) -> None:
        """Forgets everything: the next run is handed all rows."""
        for table in (self.runs, self.keys, self.live):
            if self.mart.exists(table):
                self.mart.drop_parts(table, self.mart.batches(table))

    def run(self, fresh: Mapping[str, DataFrame], highs: Mapping[str, str] | None = None) -> DataFrame:
        """One result row for each check over all rows seen so far, ``fresh`` (the new rows by table) included.

        A run counts once its last part is written; one that died before is repeated with
        the same rows. ``highs`` are kept with it.
        """
        extra = [q.Check(q.NOT_NULL, t, k) for t, k in self.keyed.items()]  # so that the copies have the keys
        copies = q.checked_copies({t: d for t, d in fresh.items() if d is not None}, [*self.checks, *extra]) if fresh else {}
        turn = self._turn() + 1
        part, before = f"run-{turn:08d}", lambda p: p < f"run-{turn:08d}"
        spark = self.mart.spark

        keys = self._new_keys(copies)
        self.mart.append_part(self.keys, keys if keys is not None else spark.createDataFrame([], _KEYS), part)
        new_keys, old_keys = (self._stored(self.keys, _KEYS, w) for w in (lambda p: p == part, before))
        live = self._now_failing(copies, new_keys, turn)
        self.mart.append_part(self.live, live, part)
        changes = self._new_duplicates(new_keys, old_keys)
        # a row for the run itself, so that one that finds nothing counts too
        seen = spark.createDataFrame([(None, None, None, None), *[(None, None, t, h) for t, h in (highs or {}).items()]], _RUNS)
        self.mart.append_part(self.runs, changes.unionByName(seen), part)
        return self.results()

    def results(self) -> DataFrame:
        """What the runs so far have found: one row for each check."""
        last = f"run-{self._turn():08d}"
        live = self._stored(self.live, _LIVE, lambda p: p == last).groupBy("check", "value").agg(F.sum("n").alias("n"))
        by_value = F.col("check").isin([i for i, c in enumerate(self.checks) if c.test in (q.ACCEPTED, q.IN_SET)])
        failing = live.groupBy("check").agg(F.sum(F.when(by_value, 1).otherwise(F.col("n"))).alias("failures"))
        twice = self._stored(self.runs, _RUNS).filter("check is not null").groupBy("check").agg(F.sum("change").alias("failures"))
        declared = self.mart.spark.createDataFrame(
            [(i, c.test, c.table, c.column) for i, c in enumerate(self.checks)], "check int, test string, table_name string, column_name string"
        )
        found = declared.join(failing.unionByName(twice), "check", "left")
        return found.orderBy("check").select("test", "table_name", "column_name", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))

    def _new_keys(self, fresh: Mapping[str, DataFrame]) -> DataFrame | None:
        """The keys of the new rows that are to be unique or found, or replace older rows."""
        wanted = {(c.table, tuple(q._keys(c))) for c in self.checks if c.test == q.UNIQUE}
        wanted |= {(c.parent, (c.parent_column,)) for c in self.checks if c.test == q.RELATIONSHIPS}
        wanted |= {(t, (k,)) for t, k in self.keyed.items()}
        frames = []
        for table, columns in sorted(wanted):
            if table in fresh:
                known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
                rows = fresh[table].filter(known).select(F.lit(_source(table, columns)).alias("source"), *_hashes(columns))
                frames.append(rows.groupBy("source", *_ROW).agg(F.count(F.lit(1)).alias("n")))
        return reduce(DataFrame.unionByName, frames) if frames else None

    def _new_duplicates(self, new: DataFrame, old: DataFrame) -> DataFrame:
        """For each unique check the number of keys that have become duplicates."""
        on = ["source", *_ROW]
        unique = [(i, _source(c.table, q._keys(c)), c.table in self.keyed) for i, c in enumerate(self.checks) if c.test == q.UNIQUE]
        named = F.broadcast(self.mart.spark.createDataFrame(unique, "check int, source string, replaces boolean"))
        mine = new.join(named, "source")
        # the older keys are only scanned, while the new ones are few enough to broadcast; those of keyed tables don't count
        adding = F.col("source").isin([s for _, s, replaces in unique if not replaces])
        known = old.filter(adding).join(broadcast_if_small(new.filter(adding).select(*on)), on).groupBy(*on).agg(F.sum("n").alias("had"))
        had = F.when(F.col("replaces"), 0).otherwise(F.coalesce("had", F.lit(0)))
        twice = mine.join(known, on, "left").filter((had <= 1) & (had + F.col("n") > 1))
        none = F.lit(None).cast("string")
        return twice.groupBy("check").agg(F.count(F.lit(1)).alias("change")).select("check", "change", none.alias("table_name"), none.alias("high"))

    def _now_failing(self, fresh: Mapping[str, DataFrame], new_keys: DataFrame, turn: int) -> DataFrame:
        """Failing cells and children without a parent: those of before that still fail, and the new ones.

        The values that lack a parent are found first, as hashes, and written. Only rows that
        have one of these, usually few, are then brought together by value.
        """
        live = self._stored(self.live, _LIVE, lambda p: p == f"run-{turn - 1:08d}")
        replaced = [F.when(F.col("source") == _source(t, [k]), F.lit(t)) for t, k in self.keyed.items() if t in fresh]
        if replaced and turn > 1:
            gone = new_keys.select(F.coalesce(*replaced, F.lit(None)).alias("table_name"), *_ROW).filter("table_name is not null")
            live = self._written(live.join(broadcast_if_small(gone), ["table_name", *_ROW], "left_anti").select(*_LIVE_NAMES), "live")
        orphans = self._orphans(live, fresh)
        lost = self._few_and_many(orphans)
        children = F.col("check").isin([i for i, c in enumerate(self.checks) if c.test == q.RELATIONSHIPS])
        frames = [live.filter(~children), *self._with_orphans(live.filter(children), orphans, lost)]
        for table in fresh:
            frames += self._failing_cells(table, fresh[table], orphans, lost)
        return reduce(DataFrame.unionByName, [f.select(*_LIVE_NAMES) for f in frames])

    def _failing_cells(self, table: str, rows: DataFrame, orphans: DataFrame, lost: tuple[list[str], list[str]]) -> list[DataFrame]:
        """Cells of the new rows that fail, or have a value without a parent; of keyed tables with their row's key."""
        cells, children = [], []
        for i, c in enumerate(self.checks):
            if c.table != table or c.test == q.UNIQUE:
                continue
            if c.test == q.RELATIONSHIPS:
                fails, value = F.col(c.column).isNotNull(), F.col(c.column).cast("string")
            elif c.test in (q.ACCEPTED, q.IN_SET):
                fails, value = q._value_fails(c), F.col(c.column).cast("string")
            else:
                fails, value = q._row_fails(c), F.lit(None).cast("string")
            cell = F.when(fails, F.struct(F.lit(i).alias("check"), value.alias("value")))
            if c.test != q.RELATIONSHIPS:
                cells.append(cell)
            elif any(_source(c.parent, [c.parent_column]) in some for some in lost):
                children.append(cell)
        none = F.lit(None).cast("bigint")
        row = _hashes([self.keyed[table]]) if table in self.keyed else [none.alias("r1"), none.alias("r2")]

        def exploded(some: list[Column]) -> DataFrame:
            return rows.select(*row, F.inline(F.array_compact(F.array(*some)))).withColumn("table_name", F.lit(table))

        frames = [_counted(exploded(cells).withColumn("n", F.lit(1)))] if cells else []
        return frames + (self._with_orphans(exploded(children).withColumn("n", F.lit(1)), orphans, lost, count=True) if children else [])

    def _relationships(self) -> DataFrame:
        named = [(i, _source(c.parent, [c.parent_column])) for i, c in enumerate(self.checks) if c.test == q.RELATIONSHIPS]
        return F.broadcast(self.mart.spark.createDataFrame(named, "check int, source string"))

    def _orphans(self, live: DataFrame, fresh: Mapping[str, DataFrame]) -> DataFrame:
        """The hashes, each once, of values without a parent in the new rows and in what failed before."""
        values = [live.join(self._relationships(), "check").select("source", *_parent_hashes(F.col("value")))]
        for table, rows in fresh.items():
            wanted = {(c.column, _source(c.parent, [c.parent_column])) for c in self.checks if c.test == q.RELATIONSHIPS and c.table == table}
            cells = [F.when(F.col(k).isNotNull(), F.struct(F.lit(s).alias("source"), *_parent_hashes(F.col(k)))) for k, s in sorted(wanted)]
            if cells:
                values.append(rows.select(F.inline(F.array_compact(F.array(*cells)))))
        wanted = self._written(reduce(DataFrame.unionByName, values).distinct(), "wanted")
        parents = self._stored(self.keys, _KEYS).select("source", *[F.col(r).alias(p) for r, p in zip(_ROW, _PARENT)])
        found = parents.join(broadcast_if_small(wanted), ["source", *_PARENT], "left_semi")
        return self._written(wanted.join(found, ["source", *_PARENT], "left_anti"), "orphans")

    def _few_and_many(self, orphans: DataFrame) -> tuple[list[str], list[str]]:
        """The parents that lack values: those whose orphans can be broadcast together, and the others."""
        few, many, total = [], [], 0
        for r in sorted(orphans.groupBy("source").count().collect(), key=lambda r: r["count"]):  # a row for each parent at most
            total += r["count"]
            (few if total <= BROADCAST_ROWS else many).append(r["source"])
        return few, many

    def _with_orphans(self, cells: DataFrame, orphans: DataFrame, lost: tuple[list[str], list[str]], count: bool = False) -> list[DataFrame]:
        """The cells whose value has no parent. With ``count`` they are counted by value, before they travel to many orphans."""
        few, many = (orphans.filter(F.col("source").isin(some)) if some else None for some in lost)
        sourced, frames = cells.join(self._relationships(), "check"), []
        for some, names in ((few, lost[0]), (many, lost[1])):
            if some is None:
                continue
            mine = sourced.filter(F.col("source").isin(names))
            late = count and some is many
            hashed = (_counted(mine, "source") if late else mine).withColumns(dict(zip(_PARENT, _parent_hashes(F.col("value")))))
            kept = hashed.join(F.broadcast(some) if some is few else some, ["source", *_PARENT], "left_semi")
            frames.append(_counted(kept) if count and not late else kept)
        return frames

    def _written(self, df: DataFrame, label: str) -> DataFrame:
        """A copy in the shared folder, for what is read more than once."""
        folder = new_work_dir(df.sparkSession, f"checks-{label}")
        df.write.parquet(folder)
        return df.sparkSession.read.schema(df.schema).parquet(folder)


def _parent_hashes(value: Column) -> list[Column]:
    return [h.alias(p) for h, p in zip(_hashes([value]), _PARENT)]


def _counted(cells: DataFrame, *more: str) -> DataFrame:
    return cells.groupBy(*_LIVE_NAMES[:-1], *more).agg(F.sum("n").alias("n"))


_LIVE_NAMES = [f.split()[0] for f in _LIVE.split(", ")]
