"""Queries and stored tables where keys and rows are more than in the small test tables."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from ledgermart.operators import check_log, quality, store
from ledgermart.operators.keys import latest_per_key, latest_whole_rows
from ledgermart.plans.queries import QUERIES
from test_check_log import CHECKS, SCHEMA, made

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


def orders(spark, folder, *made):
    """``made``: key, customer, total and year."""
    some = [(k, c, "F", t, datetime(y, 3, 5), "1-URGENT") for k, c, t, y in made]
    spark.createDataFrame(some, ORDERS).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_keys_too_long_for_a_delivery_s_short_types(spark, tmp_path):
    small = orders(spark, tmp_path / "small", (1, 7, 1.5, 1996), (2, 8, 2.5, 1998), (3, 9, 3.5, 2000), (None, None, None, 1998))
    large = orders(spark, tmp_path / "large", (1 << 40, 1 << 33, 1.5, 1996), (2, 70_000, 5e9 + 0.5, 1998), (3, 1 << 34, 3.5, 2000))
    got = {f: QUERIES["schema_widening"](spark, f).select("o_orderkey", "o_custkey", "o_totalprice") for f in (small, large)}
    assert rows(got[small]) == rows(spark.createDataFrame([("1", 7, 1.0), ("2", 8, 2.0), ("3", 9, 3.5), (None, None, None)], got[small].schema))
    assert rows(got[large]) == sorted([(str(1 << 40), 1 << 33, 1.0), ("2", 70_000, 5e9), ("3", 1 << 34, 3.5)], key=repr)
    assert [f.dataType.simpleString() for f in got[large].schema] == ["string", "bigint", "double"]
    long_key = orders(spark, tmp_path / "long", (100 << 40, 7, 1.0, 1996), (1, 8, 1.0, 1996))
    assert rows(QUERIES["upsert_growing"](spark, long_key)) == sorted([(100 << 40, 7, "new"), (1, 8, "F")], key=repr)


def test_small_buckets_do_not_become_folders_without_number(spark, mart, monkeypatch):
    assert store._buckets_for(54_000_000, 300) == store.MOST_BUCKETS and store._buckets_for(9_000, 300) == 30
    assert store._buckets_for(10**10, 300) == store._buckets_for(10**10, store.ROWS_PER_BUCKET) == 10_000
    monkeypatch.setattr(store, "MOST_BUCKETS", 20)
    numbers = lambda n, v: spark.range(n).selectExpr("id", f"{v} as v")
    for step, n in enumerate((10, 3000, 100)):
        got = mart.upsert("u", numbers(n, step), "id", ["v"], buckets=2, rows_per_bucket=30)
    assert mart.state("u").buckets == len(mart.state("u").live) == 20  # of 100
    assert got.count() == 3000 and got.filter("v = 2").count() == 100
    before = mart.state("u").live
    got = mart.upsert("u", numbers(1, 3), "id", ["v"], rows_per_bucket=30)  # they are not dealt anew by every write
    assert sum(mart.state("u").live[p] != before[p] for p in before) == 1 and got.filter("v = 3").count() == 1


def test_values_without_a_parent_are_found_once(spark, mart, monkeypatch):
    """What is asked for its size is stored, not computed again; orphans too many to broadcast are joined."""
    plans, asked = [], check_log.broadcast_if_small
    monkeypatch.setattr(check_log, "broadcast_if_small", lambda d: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or asked(d))
    monkeypatch.setattr(check_log, "BROADCAST_ROWS", 1)
    data = {t: spark.createDataFrame(d, SCHEMA[t]) for t, d in made(7, runs=2).items()}
    data["parent"] = data["parent"].filter("p > 'u'")
    log = check_log.CheckLog(mart, "c", CHECKS)
    for turn in range(2):
        got = log.run({t: d.filter(F.col("at") == turn) for t, d in data.items()})
    assert rows(got) == rows(quality.run_checks(data, CHECKS))
    assert got.filter("test = 'relationships' and failures > 1").count() == 1
    assert plans and not any("Aggregate" in p or "Generate" in p for p in plans)


def test_whole_rows_of_the_newest_places(spark):
    made = [(f"v{t}", "hot", t % 97, t % 5, t) for t in range(400)]  # one key with most rows
    made += [("n1", None, 1, None, None), ("n2", None, 2, None, None), ("n3", None, 2, 0, None)]  # NULL is a key
    made += [("m1", "m", None, None, None), ("m2", "n", None, 9, 9), ("m3", "n", 1, None, None)]  # NULLs are last
    made += [("c", "copies", 3, 3, None)] * 4 + [("d", "copies", 2, 9, 9)]
    df = spark.createDataFrame(made, "v string, k string, t int, d int, s int").repartition(7, "s")
    got, place = latest_whole_rows(df, "k", ["t", "d", "s"]), lambda r: [(x is not None, x) for x in r[2:]]
    newest = {k: max((r for r in made if r[1] == k), key=place) for k in {r[1] for r in made}}
    assert got.columns == df.columns and rows(got) == sorted(newest.values(), key=repr)
    assert rows(got) == rows(latest_per_key(df, "k", "t", [F.desc_nulls_last("d"), F.desc_nulls_last("s")]))


def test_whole_certificates_are_not_sorted_before_they_are_moved(spark):
    for name, measure in (("stg_non_domestic_certificates", "primary_energy_value"), ("fact_dom_energy", "mains_gas_flag")):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        moved = plan.split("Exchange hashpartitioning")[1:]
        assert any(measure in m for m in moved) and any("WindowGroupLimit" in m for m in moved), name
        assert not any(measure in m and "WindowGroupLimit" in m for m in moved), name
