import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from ledgermart.operators import paths
from ledgermart.operators.replaced import ReplacedTable
from ledgermart.operators.schema import SchemaConflict, wider
from ledgermart.operators.store import sync_schema


def batches(spark, *spec):
    df = spark.createDataFrame(list(spec), "k string, v int, t string")
    return df.withColumn("audit_ts", F.col("t").cast("timestamp")).drop("t")


JAN, FEB, MAR = "2025-01-01", "2025-02-01 10:00:00.5", "2025-03-01"


def test_append_new_is_idempotent_and_strict(spark, mart):
    assert mart.watermark("f") is None
    mart.append_new("f", batches(spark, ("a", 1, JAN), ("a", 1, JAN)))
    assert mart.watermark("f") == "2025-01-01 00:00:00.000000"
    both = batches(spark, ("late", 9, JAN), ("b", 2, FEB))
    for _ in range(2):
        got = mart.append_new("f", both)
        assert [r[:2] for r in rows(got)] == [("a", 1), ("a", 1), ("b", 2)]
    assert mart.watermark("f") == "2025-02-01 10:00:00.500000"
    assert mart.table("f", after=JAN).count() == 1
    assert mart.table("f", after=FEB).count() == 0


def test_first_run_without_rows(spark, mart):
    got = mart.append_new("f", batches(spark).filter("false"))
    assert got.count() == 0 and mart.watermark("f") == "1970-01-01 00:00:00"
    assert mart.append_new("f", batches(spark, ("a", 1, JAN))).count() == 1


def test_replaced_table(spark, tmp_path):
    table = ReplacedTable(spark, str(tmp_path / "k"))
    with pytest.raises(LookupError):
        table.table()
    first = batches(spark, ("a", 1, JAN), ("b", 2, FEB))
    for _ in range(2):  # a run that is repeated
        table.append_new(first)
        assert [r[:2] for r in rows(table.table())] == [("a", 1), ("b", 2)]
    for _ in range(2):
        table.replace(batches(spark, ("c", 3, JAN)))
        assert [r[:2] for r in rows(table.table())] == [("b", 2), ("c", 3)]
    table.append_new(batches(spark, ("x", 9, JAN), ("d", 4, MAR)).withColumn("extra", F.lit(1)))
    assert [r[:2] for r in rows(table.table().select("k", "v"))] == [("b", 2), ("c", 3), ("d", 4)]
    assert table.table().filter("extra = 1").count() == 1
    table.replace(first.filter("false"))
    assert table.table().count() == 3


def test_replaced_table_finds_gaps_that_a_dead_run_left(spark, tmp_path):
    table = ReplacedTable(spark, str(tmp_path / "k"))
    assert table.since([]) == (False, None) and table.since(["b20250101T000000000000"]) == (True, None)
    whole = batches(spark, ("a", 1, JAN), ("b", 2, FEB), ("c", 3, MAR))
    table.replace(whole.filter("k <> 'b'"))  # the newest batch is there, an older one isn't
    wanted = ["b20250101T000000000000", "b20250201T100000500000", "b20250301T000000000000"]
    assert table.since(wanted) == (True, "2025-01-01 00:00:00.000000")
    table.append_new(whole)
    assert table.batches() == wanted and table.since(wanted) == (False, None) and table.table().count() == 3
    table.drop(wanted[:1])
    assert table.batches() == wanted[1:]


def test_uncommitted_write_is_invisible_and_overwritten(spark, mart):
    mart.append_new("f", batches(spark, ("a", 1, JAN)))
    stray = batches(spark, ("x", 0, FEB)).withColumn("mart_part", F.lit("b20250201T100000500000"))
    stray.write.partitionBy("mart_part").parquet(f"{mart.root}/f/mart_version=2")
    assert mart.table("f").count() == 1
    got = mart.append_new("f", batches(spark, ("b", 2, FEB)))
    assert [r[:2] for r in rows(got)] == [("a", 1), ("b", 2)]


def test_second_writer_fails_at_commit(spark, mart):
    state = mart.append_part("f", batches(spark, ("a", 1, JAN)), "p")
    with pytest.raises(RuntimeError, match="another writer"):
        mart._commit("f", state)


def test_upsert_replaces_only_touched_buckets(spark, mart):
    first = batches(spark, *[(f"k{i}", i, JAN) for i in range(50)])
    mart.upsert("u", first, "k", ["audit_ts"], ["v"], buckets=8)
    before = mart.state("u").live
    delta = batches(spark, ("k1", 100, FEB), ("k1", 101, MAR), ("new", 7, FEB))
    for _ in range(2):
        got = {r["k"]: r["v"] for r in mart.upsert("u", delta, "k", ["audit_ts"], ["v"]).collect()}
        assert len(got) == 51 and got["k1"] == 101 and got["new"] == 7 and got["k2"] == 2
    after = mart.state("u").live
    assert sum(after[p] == before.get(p) for p in after) >= 6
    assert mart.upsert("u", delta.filter("false"), "k", ["audit_ts"]).count() == 51


def test_schema_follows_the_newest_write(spark, mart):
    mart.append_new("s", batches(spark, ("a", 1, JAN)))
    wider = batches(spark, ("b", 2, FEB)).drop("v").withColumn("extra", F.lit("e"))
    got = mart.append_new("s", wider)
    assert got.columns == ["k", "audit_ts", "extra"]
    assert [(r["k"], r["extra"]) for r in got.orderBy("k").collect()] == [("a", None), ("b", "e")]
    synced = sync_schema(batches(spark, ("a", 1, JAN)), wider)
    assert synced.columns == wider.columns and synced.first()["extra"] is None


def test_full_table_and_view(spark, mart):
    mart.write_full("d", spark.range(3).toDF("n"))
    got = mart.write_full("d", mart.table("d").filter("n > 0"))
    assert rows(got) == [(1,), (2,)]
    mart.view("d_view", mart.export("d"))
    assert spark.table("d_view").count() == 2
    with pytest.raises(LookupError):
        mart.table("nothing")


def test_dropped_parts_are_gone(spark, mart):
    mart.append_part("r", spark.range(2).toDF("n"), "1000")
    mart.append_part("r", spark.range(3).toDF("n"), "1001")
    mart.drop_parts("r", ["1000"])
    assert mart.batches("r") == ["1001"] and mart.table("r").count() == 3
    assert not paths.exists(spark, f"{mart.root}/r/mart_version=1/mart_part=1000")


def test_batch_filter_prunes_folders(spark, mart):
    mart.append_new("f", batches(spark, ("a", 1, JAN), ("b", 2, FEB), ("c", 3, MAR)))
    plan = mart.table("f", after=JAN)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert "PushedFilters: []" in plan  # the filter is on folders alone


def test_stale_writer_fails_and_the_table_stays(spark, mart, monkeypatch):
    mart.append_new("f", batches(spark, ("a", 1, JAN)))
    stale = mart.state("f")
    mart.append_new("f", batches(spark, ("b", 2, FEB), ("c", 3, FEB)))
    with monkeypatch.context() as old:
        old.setattr(mart, "state", lambda name: stale)  # has read the table before the other writer committed
        with pytest.raises(RuntimeError, match="another writer"):
            mart.append_part("f", batches(spark, ("x", 9, FEB)), "b20250201T100000500000")
        with pytest.raises(RuntimeError, match="another writer"):
            mart.write_full("f", batches(spark))
    assert [r[:2] for r in rows(mart.table("f"))] == [("a", 1), ("b", 2), ("c", 3)]
    assert not [c for c in paths.children(spark, f"{mart.root}/_commits/f") if c.endswith(".part")]
    mart.append_new("f", batches(spark, ("d", 4, MAR)))
    assert mart.table("f").count() == 4


def test_rows_without_batch_time_are_refused(spark, mart):
    with pytest.raises(Exception, match="no batch timestamp"):
        mart.append_new("f", batches(spark, ("a", 1, JAN), ("b", 2, None)))
    assert not mart.exists("f")
    mart.append_new("f", batches(spark, ("a", 1, JAN)))
    with pytest.raises(Exception, match="no batch timestamp"):
        mart.append_new("f", batches(spark, ("b", 2, None)))
    with pytest.raises(Exception, match="no batch timestamp"):
        mart.append_feed("f", batches(spark, ("b", 2, None)))
    assert mart.table("f").count() == 1


def test_parts_that_are_no_batches_have_no_time(spark, mart):
    mart.append_part("s", batches(spark, ("a", 1, JAN)), "epoch-x-0")
    assert mart.watermark("s") == "1970-01-01 00:00:00"
    assert mart.batches("s") == ["epoch-x-0"] and mart.batches("s", after=JAN) == []
    assert mart.table("s").count() == 1


def test_wider_types():
    t = T._parse_datatype_string
    cases = [
        ("int", "int", "int"), ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("bigint", "string", "string"), ("bigint", "double", "string"),
        ("int", "double", "double"), ("float", "double", "double"), ("float", "int", "double"), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", "string"),
        ("decimal(5,2)", "decimal(4,3)", "decimal(6,3)"), ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(38,0)", "decimal(10,10)", "string"),
        ("boolean", "int", "string"), ("array<int>", "int", None), ("array<int>", "array<bigint>", None), ("binary", "string", None),
    ]
    for a, b, both in cases:
        expected = None if both is None else t(both)
        assert wider(t(a), t(b)) == expected and wider(t(b), t(a)) == expected, (a, b)


def test_types_widen_and_what_is_stored_follows(spark, mart):
    mart.append_new("w", batches(spark, ("a", 1, JAN)))
    mart.append_new("w", batches(spark, ("b", 2, FEB)).withColumn("v", F.lit(1 << 40)))
    assert [r[:2] for r in rows(mart.table("w"))] == [("a", 1), ("b", 1 << 40)]
    mart.append_new("w", batches(spark, ("c", 3, MAR)).withColumn("v", F.lit("text")))
    assert [r[:2] for r in rows(mart.table("w"))] == [("a", "1"), ("b", str(1 << 40)), ("c", "text")]
    # the stored type stays, where a write has a narrower one
    mart.append_new("w", batches(spark, ("d", 4, "2025-04-01")))
    assert [r[:2] for r in rows(mart.table("w", after=FEB))] == [("c", "text"), ("d", "4")]
    assert mart.table("w", after=MAR).filter("v = '4'").count() == 1
    # a column that goes and comes back with another type
    mart.append_new("w", batches(spark, ("e", 5, "2025-05-01")).drop("v"))
    mart.append_new("w", batches(spark, ("f", 6, "2025-06-01")).withColumn("v", F.lit(0.5)))
    got = {r["k"]: r["v"] for r in mart.table("w").collect()}
    assert got == {"a": "1", "b": str(1 << 40), "c": "text", "d": "4", "e": None, "f": "0.5"}


def test_types_that_do_not_fit_are_refused_before_the_commit(spark, mart):
    mart.append_new("w", batches(spark, ("a", 1, JAN)).withColumn("x", F.array(F.lit(1))))
    before = mart.state("w")
    with pytest.raises(SchemaConflict, match="column x"):
        mart.append_new("w", batches(spark, ("b", 2, FEB)).withColumn("x", F.lit(1)))
    assert mart.state("w") == before and mart.table("w").count() == 1
    assert len(paths.children(spark, f"{mart.root}/w")) == 1  # nothing was written
    mart.write_full("w", batches(spark, ("b", 2, FEB)).withColumn("x", F.lit(1)))  # nothing old stays
    assert mart.table("w").first()["x"] == 1


def test_commits_without_schemas_are_read_with_the_schema_of_their_table(spark, mart):
    mart.append_new("w", batches(spark, ("a", 1, JAN)))
    old = mart.state("w")
    old.schemas, old.written, old.version = [], {}, old.version + 1
    mart._commit("w", old)
    mart.append_new("w", batches(spark, ("b", 2, FEB)).withColumn("v", F.lit("x")))
    assert [r[:2] for r in rows(mart.table("w"))] == [("a", "1"), ("b", "x")]


def test_buckets_grow_with_the_table(spark, mart):
    numbers = lambda n, v: spark.range(n).selectExpr("cast(id as int) as id", f"{v} as v")
    mart.upsert("u", numbers(50, 0), "id", ["v"], buckets=2, rows_per_bucket=100)
    mart.upsert("u", numbers(5000, 1), "id", ["v"], rows_per_bucket=100)
    assert mart.state("u").buckets == 2  # grown, but as yet unknown
    got = mart.upsert("u", numbers(10, 2), "id", ["v"], rows_per_bucket=100)
    assert mart.state("u").buckets == 50 and len(mart.state("u").live) == 50
    assert got.count() == 5000 and got.filter("v = 2").count() == 10
    # a wider key has other hashes: all is dealt anew, and no key comes twice
    wide = spark.range(20).selectExpr("id", "3 as v")
    got = mart.upsert("u", wide, "id", ["v"], rows_per_bucket=100)
    assert got.count() == 5000 and got.filter("v = 3").count() == 20 and dict(got.dtypes)["id"] == "bigint"
    before = mart.state("u").live
    mart.upsert("u", wide.limit(1).withColumn("v", F.lit(4)), "id", ["v"], rows_per_bucket=100)
    assert sum(mart.state("u").live[p] != before[p] for p in before) == 1


def test_history_rewrites_touched_buckets_only(spark, mart):
    state = lambda n, v: spark.range(n).selectExpr("id", f"'{v}' as s")
    mart.write_snapshot("h", state(400, "x"), "id", ["s"], "2025-01-01 00:00:00", buckets=8)
    before = mart.state("h").live
    assert len(before) == 8
    delta = spark.createDataFrame([(3, "y"), (4, "x"), (1000, "z")], "id long, s string")
    mart.write_snapshot("h", delta, "id", ["s"], "2025-02-01 00:00:00")
    after = mart.state("h").live
    assert 6 <= sum(after[p] == before[p] for p in before) < 8  # untouched buckets keep their files
    assert mart.table("h").count() == 402 and mart.current("h").count() == 401
    assert [r["valid_to"] is None for r in mart.table("h").filter("id = 3").orderBy("valid_from").collect()] == [False, True]
    mart.write_snapshot("h", delta, "id", ["s"], "2025-03-01 00:00:00", high="2025-03-01")
    assert mart.state("h").live == after and mart.high("h") == "2025-03-01"  # nothing changed
    # buckets that are too full are dealt anew
    mart.write_snapshot("h", delta.limit(0), "id", ["s"], "2025-04-01 00:00:00", rows_per_bucket=10)
    assert mart.state("h").buckets == 41 and mart.current("h").count() == 401 and mart.table("h").count() == 402


def test_clustered_rows_are_skipped_by_row_group(spark, mart):
    key = F.pmod(F.hash("id"), F.lit(10_000))
    data = spark.range(200_000).select(key.alias("key"), F.expr("timestamp'2025-01-01' + make_interval(0, cast(id % 2 as int))").alias("audit_ts"), "id")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    spark._jsc.hadoopConfiguration().set("parquet.block.size", str(64 << 10))
    try:
        for name, cluster in (("plain", ()), ("sorted", ("key",))):
            mart.append_new(name, data, regroup=True, cluster=cluster)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")

    def groups(name):
        """Row groups, and those whose bounds let in key = 77."""
        found = []
        for f in mart.table(name).inputFiles():
            meta = pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata
            at = meta.schema.names.index("key")
            found += [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        return len(found), sum(s.min <= 77 <= s.max for s in found)

    def rows_read(name):
        """Rows that the scan hands on, after row groups and pages are skipped."""
        chosen = mart.table(name).filter("key = 77")
        found = chosen.collect()
        scan = chosen._jdf.queryExecution().executedPlan().collectLeaves().head()
        return len(found), scan.metrics().apply("numOutputRows").value()

    (all_plain, in_plain), (all_sorted, in_sorted) = groups("plain"), groups("sorted")
    assert all_plain > 10 and in_plain == all_plain
    assert all_sorted > 10 and in_sorted <= 4  # one or two for each of two batches
    (n, from_plain), (same, from_sorted) = rows_read("plain"), rows_read("sorted")
    assert n == same > 0 and from_plain == 200_000 and from_sorted < 20_000


def test_late_rows_are_kept_apart_and_counted(spark, mart):
    first = mart.append_feed("f", batches(spark, ("a", 1, JAN), ("b", 2, FEB)))
    assert (first.version, first.watermark, first.n_written, first.n_late) == (1, None, 2, 0)
    second = mart.append_feed("f", batches(spark, ("late", 3, JAN), ("same", 4, FEB), ("c", 5, MAR)))
    assert (second.watermark, second.n_written, second.n_late) == ("2025-02-01 10:00:00.500000", 1, 2)
    assert [r[:2] for r in rows(mart.table("f"))] == [("a", 1), ("b", 2), ("c", 5)]
    late = mart.late("f").orderBy("k").collect()
    assert [(r["k"], r["v"], r["late_version"], r["mart_part"]) for r in late] == [
        ("late", 3, 2, "b20250101T000000000000"), ("same", 4, 2, "b20250201T100000500000")]
    assert mart.watermark("f") == "2025-03-01 00:00:00.000000"
    assert mart.batches("f") == ["b20250101T000000000000", "b20250201T100000500000", "b20250301T000000000000"]
    none = mart.append_feed("f", batches(spark).filter("false"))
    assert (none.n_written, none.n_late) == (0, 0) and mart.late("f").count() == 2
    mart.append_new("g", batches(spark, ("a", 1, JAN)))
    assert mart.late("g").count() == 0
