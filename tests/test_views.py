"""Calendar, dashboard queries and streams."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landed import first_month, second_month
from ledgermart.operators import bi, ledger as lg
from ledgermart.operators.calendar import calendar, calendar_for, date_drill, join_calendar
from ledgermart.operators.keys import latest_per_key
from ledgermart.plans.pipeline import CertificateMart
from ledgermart.plans.schemas import FILE_COLUMNS, file_schema
from ledgermart.streaming.files import stream_feed, stream_load, stream_table


def test_calendar(spark):
    cal = calendar(spark, 2024, 2025)
    assert cal.count() == 731
    got = cal.filter("date = date'2024-11-30'").first()
    assert tuple(got)[1:] == (2024, 4, "Qtr 4", 11, "November", 30)
    df = spark.createDataFrame([(dt.date(2023, 5, 1), dt.date(2025, 1, 1))], "a date, b date")
    assert calendar_for(df, "a", "b").count() == 365 + 366 + 365
    assert calendar_for(df.filter("false"), "a").count() == 0


def test_join_on_the_date_part_and_drill(spark):
    data = [("2025-01-01 23:59:59", 1), ("2025-01-01 00:00:00", 2), ("2025-04-02 08:00:00", 3), (None, 4)]
    fact = spark.createDataFrame(data, "t string, n int").withColumn("t", F.col("t").cast("timestamp"))
    dated = join_calendar(fact, "t", calendar(spark, 2025, 2025))
    assert dated.count() == 4 and dated.filter("day = 1").count() == 2
    drill = date_drill(dated.filter("date is not null"), [F.sum("n").alias("n")])
    assert {(r["level"], r["quarter"], r["day"]): r["n"] for r in drill.collect()} == {
        (0, None, None): 6, (1, None, None): 6, (2, "Qtr 1", None): 3, (2, "Qtr 2", None): 3,
        (3, "Qtr 1", None): 3, (3, "Qtr 2", None): 3, (4, "Qtr 1", 1): 3, (4, "Qtr 2", 2): 3,
    }


def test_dashboard_queries(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0), (None, None)], "g string, v double")
    assert rows(bi.share_of_total(df, "g", "v"), "ordered") == [("a", 2, 2 / 3), ("b", 1, 1 / 3), (None, 0, 0.0)]
    assert rows(bi.ratio_to_total(df, "g", "v")) == sorted(
        [("a", 2.0, 0.5), ("b", 8.0, 2.0), (None, None, None)], key=repr)
    assert rows(bi.count_by(df, ["g"], "v"), "ordered")[0] == ("a", 2)
    assert rows(bi.average_card(df, {"m": "v"})) == [(4.0,)]
    assert rows(bi.headline_card([df.agg(F.max("v").alias("x")), df.agg(F.count("v").alias("y"))])) == [(8.0, 3)]
    assert rows(bi.latest_batch(df.filter("g is not null"), "g")) == [("b", 8.0)]
    assert rows(bi.pivot_counts(df, "v", "g", ["a", "b"]).filter("v = 8")) == [(8.0, 0, 1)]


def test_streamed_table_takes_each_file_once(spark, mart, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    spark.range(10).repartition(3).write.parquet(source)
    for extra in (0, 5, 0):
        if extra:
            spark.range(100, 100 + extra).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(source)
        stream_table(stream, mart, "t", state).awaitTermination()
    ids = [r["id"] for r in mart.table("t").collect()]
    assert sorted(ids) == [*range(10), *range(100, 105)]
    assert len(mart.batches("t")) > 1


def test_streamed_load_goes_through_the_ledger(spark, mart, tmp_path):
    landing, state = tmp_path / "landing", str(tmp_path / "state")
    schemas = {t: file_schema(t) for t in FILE_COLUMNS}
    for land in (first_month, second_month):
        land(landing)
        stream_load(spark, str(landing / "raw"), mart, schemas, "s", state).awaitTermination()
    built = CertificateMart(mart)
    assert lg.read_ledger(mart).count() == 12
    assert built.raw("raw_domestic_certificates").count() == 5


def test_new_checkpoint_stands_beside_the_old_rows(spark, mart, tmp_path):
    source = str(tmp_path / "in")
    for state, ids in (("one", range(5)), ("two", range(5, 8))):
        spark.createDataFrame([(i,) for i in ids], "id bigint").coalesce(1).write.mode("overwrite").parquet(source)
        stream = spark.readStream.schema("id bigint").parquet(source)
        stream_table(stream, mart, "t", str(tmp_path / state)).awaitTermination()
    assert sorted(r["id"] for r in mart.table("t").collect()) == list(range(8))
    assert mart.watermark("t") == "1970-01-01 00:00:00"


def test_streamed_feed_keeps_late_rows_apart(spark, mart, tmp_path):
    schema = "k string, audit_ts timestamp"
    days = [[("a", "2025-01-01"), ("b", "2025-01-02")], [("late", "2025-01-01"), ("c", "2025-01-03")], [("d", "2025-01-04")]]
    told = []
    for i, day in enumerate(days):
        rows_ = spark.createDataFrame(day, "k string, t string").selectExpr("k", "cast(t as timestamp) as audit_ts")
        rows_.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        stream_feed(stream, mart, "feed", str(tmp_path / "state"), report=told.append).awaitTermination()
    assert [(d.n_written, d.n_late) for d in told] == [(2, 0), (1, 1), (1, 0)]
    assert sorted(r["k"] for r in mart.table("feed").collect()) == ["a", "b", "c", "d"]
    assert [r["k"] for r in mart.late("feed").collect()] == ["late"]
    last = mart.state("feed")
    again = mart.append_feed("feed", mart.table("feed"), token=last.high)  # the same micro-batch once more
    assert (again.n_written, again.n_late) == (0, 0) and mart.state("feed") == last


def test_streamed_load_tries_a_failed_file_again(spark, mart, tmp_path):
    landing, state = tmp_path / "landing", str(tmp_path / "state")
    schemas = {t: file_schema(t) for t in FILE_COLUMNS}
    first_month(landing)
    good = landing / "raw" / "certificates" / "domestic" / "domestic_certificates_2025-01.csv"
    broken = good.with_name("domestic_certificates_2025-02.csv.gz")
    broken.write_bytes(b"\x1f\x8b not a gzip file")
    with pytest.raises(Exception, match="files not loaded"):
        stream_load(spark, str(landing / "raw"), mart, schemas, "s", state).awaitTermination()
    assert lg.read_ledger(mart).count() == 6
    broken.write_bytes(gzip.compress(good.read_bytes()))
    stream_load(spark, str(landing / "raw"), mart, schemas, "s", state).awaitTermination()
    assert lg.read_ledger(mart).count() == 7
    assert CertificateMart(mart).raw("raw_domestic_certificates").count() == 6


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as t")
    plan = latest_per_key(df, "k", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_no_python_in_any_plan(spark):
    from ledgermart.plans.queries import QUERIES

    for name in ("kpi_recom_split", "dq_report", "property_delta", "scd2_history"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan, name


def test_kpi_scans_its_fact_once(spark):
    from ledgermart.plans.queries import QUERIES

    for name in ("kpi_rating", "kpi_recom_split", "kpi_cost_bands"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan, name
