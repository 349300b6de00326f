"""Mart tables as Parquet folders with a commit file per write.

Layout: ``<root>/<table>/mart_version=<n>-<attempt>/mart_part=<p>/*.parquet``. A part is a batch,
a hash bucket, or the open or closed half of a history. Every write makes a version
folder of its own and then one small commit file that names the live version of each part, so

* nothing that a reader can see is ever overwritten or half replaced;
* a job that dies, or a writer that comes too late, leaves a folder that no commit names;
* a watermark or a list of batches comes from the commit, not from a scan;
* the committed schema is the read schema: added columns read as NULL in older
  files, dropped columns are not read, and types of older files are widened. A write whose
  types don't fit the stored ones is refused before anything is written.

One writer per table at a time: of two that start from the same commit the second one
fails at its own, which can only be created once, and the table stays as the first left it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.functions.dates import batch_id
from ledgermart.operators import paths, scd2
from ledgermart.operators import schema as types
from ledgermart.operators.incremental import EPOCH
from ledgermart.operators.keys import latest_per_key
from ledgermart.operators.sizing import broadcast_if_small
from ledgermart.session import new_work_dir

VERSION, PART = "mart_version", "mart_part"
WHOLE, OPEN, CLOSED = "whole", "open", "closed"
#: Parts of rows that came after their batch was done; readers don't see them.
LATE = "late-"
#: Hash buckets of an upserted table or a history at its first load.
MIN_BUCKETS = 16
ROWS_PER_BUCKET = 1_000_000
#: More buckets than this only where each has ROWS_PER_BUCKET rows: a bucket is a folder, a file and a task of its own.
MOST_BUCKETS = 512
_FROM_DELTA = "_from_delta"


@dataclass
class TableState:
    """What the newest commit of a table says."""

    version: int = 0
    schema: str = ""
    live: dict[str, str] = field(default_factory=dict)  # by part: the version folder it lies in
    buckets: int | None = None
    high: str | None = None
    folder: str = ""  # the version folder that this commit added
    schemas: list[str] = field(default_factory=list)  # all schemas that live folders were written with
    written: dict[str, int] = field(default_factory=dict)  # by version folder: which of them

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def written_with(self, version: str) -> T.StructType:
        at = self.written.get(version)
        return self.struct() if at is None else T.StructType.fromJson(json.loads(self.schemas[at]))

    def fitted(self, new: T.StructType, versions: Iterable[str]) -> T.StructType:
        """The columns of ``new`` in types that hold what the version folders have; also of columns gone meanwhile."""
        for text in {self.written_with(v).json() for v in versions}:
            new = types.widened(T.StructType.fromJson(json.loads(text)), new)
        return new


@dataclass(frozen=True)
class Delivery:
    """What became of the rows of one ``append_feed``."""

    version: int
    watermark: str | None
    n_written: int
    n_late: int


_BATCH_PART = re.compile(r"b\d{8}T\d{12}")


def is_batch(part: str) -> bool:
    """Whether a part is named after a batch timestamp; a stream's parts aren't."""
    return _BATCH_PART.fullmatch(part) is not None


def _newer(part: str, after: str | None) -> bool:
    """Whether a part is a batch after the watermark; without one every part is."""
    return after is None or is_batch(part) and batch_time(part) > _padded(after)


def batch_time(part: str) -> str:
    """The timestamp text inside a batch id."""
    d, t = part[1:].split("T")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]} {t[:2]}:{t[2:4]}:{t[4:6]}.{t[6:]}"


def sync_schema(target: DataFrame, delta: DataFrame) -> DataFrame:
    """Target rows in the delta's columns: new ones as NULL, removed ones dropped."""
    have = set(target.columns)
    return target.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in delta.schema
        ]
    )


def bucket_of(key: str | Sequence[str], buckets: int) -> Column:
    """Bucket number by the hash Spark's own shuffle uses.

    A shuffle on the same key into a multiple of ``buckets`` partitions therefore
    leaves every task with rows of one bucket only.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _buckets_for(rows: int, rows_per_bucket: int) -> int:
    """As many as ``rows_per_bucket`` asks for; beyond MOST_BUCKETS they get larger before there are more."""
    most = max(MOST_BUCKETS, -(-rows // ROWS_PER_BUCKET))
    return max(MIN_BUCKETS, min(most, -(-rows // rows_per_bucket)))


def _too_few(buckets: int, rows: int, rows_per_bucket: int) -> bool:
    """Whether buckets have grown to twice ``rows_per_bucket``, and there may be twice as many."""
    return rows >= 2 * rows_per_bucket * buckets and _buckets_for(rows, rows_per_bucket) >= 2 * buckets


def _open_part(key: str, buckets: int) -> Column:
    return F.concat(F.lit(f"{OPEN}-"), bucket_of(key, buckets).cast("string"))


def _is_open(part: str) -> bool:
    return part.startswith(OPEN)


class Mart:
    """Tables of one mart below a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- commits ---------------------------------------------------------------

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _commits(self, name: str) -> str:
        return f"{self.root}/_commits/{name}"

    def state(self, name: str) -> TableState | None:
        done = [c for c in paths.children(self.spark, self._commits(name)) if c.endswith(".json")]
        if not done:
            return None
        return TableState(**json.loads(paths.read_text(self.spark, f"{self._commits(name)}/{done[-1]}")))

    def exists(self, name: str) -> bool:
        return self.state(name) is not None

    def _commit(self, name: str, state: TableState) -> None:
        text = json.dumps(state.__dict__)
        paths.write_text(self.spark, f"{self._commits(name)}/{state.version:010d}.json", text)

    def _write(
        self,
        name: str,
        df: DataFrame,
        part: Column,
        keep: Callable[[str], bool] = lambda p: True,
        buckets: int | None = None,
        high: str | None = None,
        cluster: Sequence[str] = (),
    ) -> TableState:
        """Writes one version and commits it. ``keep`` says which older parts stay live.

        ``cluster`` orders the rows of a part: tasks take ranges, files are sorted, and so
        a filter on these columns skips files and row groups by their bounds.
        """
        old = self.state(name) or TableState()
        kept = {p: v for p, v in old.live.items() if keep(p)}
        df = types.cast_to(df, old.fitted(df.schema, set(kept.values())))
        version = f"{old.version + 1}-{uuid.uuid4().hex[:12]}"
        folder = f"{self._folder(name)}/{VERSION}={version}"
        rows = df.withColumn(PART, F.coalesce(part, F.lit("")))  # never null, so that the writer keeps an order by it
        if cluster:
            rows = rows.repartitionByRange(PART, *cluster).sortWithinPartitions(PART, *cluster)
        rows.write.partitionBy(PART).parquet(folder)
        written = [c.split("=", 1)[1] for c in paths.children(self.spark, folder) if c.startswith(f"{PART}=")]
        live = kept | {p: version for p in written}
        schemas = list(old.schemas) if kept else []
        used = {v: old.written.get(v) for v in set(kept.values())}
        for v, at in [*used.items(), (version, None)]:
            text = df.schema.json() if v == version else old.schema
            if at is None:  # folders of before there was this list were written with the schema of their table
                if text not in schemas:
                    schemas.append(text)
                used[v] = schemas.index(text)
        state = TableState(old.version + 1, df.schema.json(), live, buckets, high, version, schemas, used)
        self._commit(name, state)
        return state

    # -- reads -----------------------------------------------------------------

    def _read(self, name: str, state: TableState, wanted: Callable[[str], bool]) -> DataFrame:
        live = {p: v for p, v in state.live.items() if wanted(p)}
        committed = state.struct()
        if not live:
            return self.spark.createDataFrame([], committed)
        alike: dict[str, list[str]] = {}  # version folders that one reader schema fits
        for v in sorted(set(live.values())):
            own = state.written_with(v)
            alike.setdefault(state.schema if types.same_types(own, committed) else own.json(), []).append(v)
        frames = []
        for text, versions in alike.items():
            schema = T.StructType.fromJson(json.loads(text))
            rows = self._read_versions(name, schema, versions, [(p, v) for p, v in live.items() if v in set(versions)])
            frames.append(rows if text == state.schema else types.cast_to(rows, T.StructType([*committed, T.StructField(PART, T.StringType())])))
        return reduce(DataFrame.unionByName, frames)

    def _read_versions(self, name: str, schema: T.StructType, versions: Sequence[str], live: Sequence[tuple[str, str]]) -> DataFrame:
        schema = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType()), T.StructField(PART, T.StringType())])
        folder = self._folder(name)
        df = (
            self.spark.read.schema(schema)
            .option("basePath", folder)
            .parquet(*[f"{folder}/{VERSION}={v}" for v in versions])
        )
        # both columns are partition columns: this prunes folders and reads no data
        pairs = [f"{v}/{p}" for p, v in live]
        df = df.filter(F.concat(F.col(VERSION), F.lit("/"), F.col(PART)).isin(pairs))
        return df.drop(VERSION)

    def table(self, name: str, after: str | None = None, parts: Callable[[str], bool] | None = None) -> DataFrame:
        """Committed rows; ``after`` keeps only the batches newer than a watermark."""
        return self.parted(name, after, parts).drop(PART)

    def parted(self, name: str, after: str | None = None, parts: Callable[[str], bool] | None = None) -> DataFrame:
        """As ``table``, with the part each row lies in."""
        state = self.state(name)
        if state is None:
            raise LookupError(f"no table {name} in {self.root}")

        def wanted(p: str) -> bool:
            return not p.startswith(LATE) and _newer(p, after) and (parts is None or parts(p))

        return self._read(name, state, wanted)

    def late(self, name: str) -> DataFrame:
        """Rows that ``append_feed`` found late, with the version that brought them and their batch as a part."""
        state = self.state(name)
        if state is None:
            raise LookupError(f"no table {name} in {self.root}")
        rows = self._read(name, state, lambda p: p.startswith(LATE))
        if PART not in rows.columns:
            rows = rows.withColumn(PART, F.lit(None).cast("string"))
        cut = F.split(PART, "-", 3)
        return rows.withColumns({"late_version": cut[1].cast("int"), PART: cut[2]})

    def batches(self, name: str, after: str | None = None) -> list[str]:
        """Live parts of a table in order; ``after`` keeps the batches newer than a watermark."""
        state = self.state(name)
        parts = sorted(state.live) if state else []
        return [p for p in parts if not p.startswith(LATE) and _newer(p, after)]

    def watermark(self, name: str) -> str | None:
        """Newest batch of a table: None before the first run, the epoch where it has no batches."""
        state = self.state(name)
        if state is None:
            return None
        return max((batch_time(p) for p in state.live if is_batch(p)), default=EPOCH)

    def high(self, name: str) -> str | None:
        """How far a history has processed its sources: None before the first run."""
        state = self.state(name)
        return state.high if state else None

    def view(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)

    def export(self, name: str) -> DataFrame:
        """The import scan of a dashboard: the committed table as it is."""
        return self.table(name)

    # -- writes ----------------------------------------------------------------

    def write_full(self, name: str, df: DataFrame) -> DataFrame:
        """Replaces the whole table."""
        self._write(name, df, F.lit(WHOLE), keep=lambda p: False)
        return self.table(name)

    def append_part(self, name: str, df: DataFrame, part: str | Column) -> TableState:
        """Adds parts, replacing any of the same name."""
        return self._write(name, df, F.lit(part) if isinstance(part, str) else part)

    def append_new(
        self, name: str, df: DataFrame, ts_col: str = "audit_ts", regroup: bool = False, cluster: Sequence[str] = ()
    ) -> DataFrame:
        """Appends the batches newer than the table's watermark; older rows are ignored.

        Running it again with the same input writes nothing new. Repeated keys
        inside a batch are kept. ``regroup`` is for input whose tasks each hold many
        batches: rows are first brought together by batch, so that a batch is a few
        files of a proper size. A batch that holds much of the data is split over
        several tasks. ``cluster`` also orders the rows of a batch, as ``_write`` has it.
        """
        watermark = self.watermark(name)
        # a row without a batch time isn't older: it reaches batch_id, which refuses it
        fresh = df if watermark is None else df.filter((F.col(ts_col) > F.lit(watermark)) | F.col(ts_col).isNull())
        if regroup and not cluster:
            fresh = fresh.hint("rebalance", ts_col)
        self._write(name, fresh, batch_id(F.col(ts_col)), cluster=cluster)
        return self.table(name)

    def append_feed(self, name: str, df: DataFrame, ts_col: str = "audit_ts", token: str | None = None) -> Delivery:
        """Appends a delivery that holds each row once; rows at or below the watermark are kept apart, not dropped.

        They go, in the same write, to parts that ``table`` leaves out and ``late`` shows, and
        both kinds are counted as they are written. It reads the whole delivery, unlike
        ``append_new``, which is for input that repeats what was appended before. A delivery whose
        ``token`` is that of the last one is a repetition, and adds nothing.
        """
        state = self.state(name)
        watermark, version = self.watermark(name), state.version + 1 if state else 1
        if token is not None and state and state.high == token:
            return Delivery(state.version, watermark, 0, 0)
        late = F.lit(False) if watermark is None else F.coalesce(F.col(ts_col) <= F.lit(watermark), F.lit(False))
        seen = Observation()
        counted = df.observe(seen, F.count_if(~late).alias("n_written"), F.count_if(late).alias("n_late"))
        batch = batch_id(F.col(ts_col))
        self._write(name, counted, F.when(late, F.concat(F.lit(f"{LATE}{version}-"), batch)).otherwise(batch), high=token)
        return Delivery(version, watermark, **seen.get)

    def upsert(
        self,
        name: str,
        delta: DataFrame,
        key: str | Sequence[str],
        order_by: Sequence[str],
        tie_breakers: Sequence[str] = (),
        buckets: int | None = None,
        files_per_bucket: int = 1,
        rows_per_bucket: int = ROWS_PER_BUCKET,
    ) -> DataFrame:
        """A delta row replaces the stored row of its key; untouched buckets stay as they are.

        The delta is reduced to one row per key first, so a hot key cannot pile up;
        delta and stored rows then meet in one shuffle that is also the write layout.
        The number of buckets at first follows from the rows of the delta, unless it is
        given. A table whose buckets have grown to twice ``rows_per_bucket`` gets more of them
        (above MOST_BUCKETS only for ROWS_PER_BUCKET rows each), and one whose keys get a wider type, and with it other hashes, is dealt anew.
        """
        keys = [key] if isinstance(key, str) else list(key)
        state = self.state(name)
        newest = latest_per_key(delta, keys, order_by, tie_breakers)
        if state is None:
            buckets = buckets or _buckets_for(delta.count(), rows_per_bucket)
            bucket = bucket_of(keys, buckets).cast("string")
            self._write(name, newest.repartition(buckets * files_per_bucket, *keys), bucket, buckets=buckets)
            return self.table(name)
        committed = state.fitted(delta.schema, set(state.live.values()))
        delta, newest = types.cast_to(delta, committed), types.cast_to(newest, committed)
        had, buckets = state.struct(), state.buckets
        anew = any(had[k].dataType != committed[k].dataType for k in keys)
        rows = self.table(name).count()  # from the files' footers
        if _too_few(buckets, rows, rows_per_bucket):
            buckets, anew = _buckets_for(rows, rows_per_bucket), True
        bucket = bucket_of(keys, buckets).cast("string")
        touched = {r[0] for r in delta.select(bucket).distinct().collect()}  # at most ``buckets`` numbers
        if not touched:
            return self.table(name)
        if anew:
            touched = set(state.live)
        stored = sync_schema(self.table(name, parts=touched.__contains__), delta)
        both = stored.withColumn(_FROM_DELTA, F.lit(0)).unionByName(newest.withColumn(_FROM_DELTA, F.lit(1)))
        spread = buckets * files_per_bucket
        merged = latest_per_key(both.repartition(spread, *keys), keys, _FROM_DELTA).drop(_FROM_DELTA)
        self._write(name, merged, bucket, keep=lambda p: not anew and p not in touched, buckets=buckets)
        return self.table(name)

    def write_snapshot(self, name: str, delta: DataFrame, key: str, check_cols: Sequence[str], run_ts: str,
                       high: str | None = None, buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
        """One step of a type-2 history; ``high`` is kept with it as the processed watermark.

        Open versions lie in hash buckets of the key. Change detection joins the delta with the
        key and compared columns of all of them. The changed rows are written out, so
        their number is known; only the buckets that they touch are rewritten, while the changed
        keys are few enough to broadcast without a shuffle. Closed versions are only ever
        added to. Buckets that have grown to twice ``rows_per_bucket`` are dealt anew.
        """
        state = self.state(name)
        if state is None:
            buckets = buckets or _buckets_for(delta.count(), rows_per_bucket)
            first = scd2.scd2_first(delta, key, run_ts).repartition(buckets, key)
            self._write(name, first, _open_part(key, buckets), high=high, buckets=buckets)
            return self.table(name)
        opened = self.table(name, parts=_is_open)
        work = new_work_dir(self.spark, f"changes-{name}")
        found = scd2.changed_rows(opened, delta, key, check_cols)
        found.write.parquet(work)
        changed = self.spark.read.schema(found.schema).parquet(work)
        rows, buckets = opened.count(), state.buckets  # the count is from the files' footers
        anew = buckets is None or _too_few(buckets, rows, rows_per_bucket)
        if anew:
            buckets = _buckets_for(rows, rows_per_bucket)
            touched = {p for p in state.live if _is_open(p)}
        else:
            touched = {r[0] for r in changed.select(_open_part(key, buckets)).distinct().collect()}  # at most ``buckets``
        closing = scd2.keys_to_close(changed, key).withColumn("_closing", F.lit(True))
        fresh = sync_schema(scd2.open_versions(changed, key, run_ts), opened).repartition(buckets, key)
        before = self.table(name, parts=touched.__contains__)
        kept = before.join(broadcast_if_small(closing), key, "left").withColumn(
            scd2.VALID_TO, F.when(F.col("_closing"), F.lit(run_ts).cast("timestamp"))
        )
        kept = kept.drop("_closing").select(*opened.columns)
        after = (kept.repartition(buckets, key) if anew else kept).unionByName(fresh)
        closed = F.lit(f"{CLOSED}-{state.version + 1}")
        part = F.when(F.col(scd2.VALID_TO).isNull(), _open_part(key, buckets)).otherwise(closed)
        self._write(name, after, part, keep=lambda p: p not in touched, high=high, buckets=buckets)
        return self.table(name)

    def current(self, name: str) -> DataFrame:
        """Open versions of a history: reads the open part only."""
        return scd2.dim_current(self.table(name, parts=_is_open))

    def drop_parts(self, name: str, gone: Sequence[str]) -> None:
        """Takes parts out of the table, then deletes their files."""
        state = self.state(name)
        dead = {p: v for p, v in state.live.items() if p in set(gone)}
        if not dead:
            return
        live = {p: v for p, v in state.live.items() if p not in dead}
        left = {v: at for v, at in state.written.items() if v in set(live.values())}
        self._commit(name, replace(state, version=state.version + 1, live=live, written=left, folder=""))
        for p, v in dead.items():
            paths.delete(self.spark, f"{self._folder(name)}/{VERSION}={v}/{PART}={p}")


def _padded(ts: str) -> str:
    """A timestamp text with all six fraction digits, so texts compare as instants."""
    whole, _, fraction = ts.partition(".")
    if len(whole) == 10:
        whole += " 00:00:00"
    return f"{whole}.{fraction:0<6}"
