import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgermart.operators import bitmaps, kpi

SPEC = [
    kpi.mean("avg_v", "all_avg_v", "v"),
    kpi.percent("pct_a", "all_pct_a", "band in ('A', 'B')"),
    kpi.ratio_of_sums("per_area", "all_per_area", "x + y", "area"),
    kpi.row_count("n", "all_n"),
]
COUNTS = [
    kpi.distinct_per_key("per_key", "all_per_key", "item", "k"),
    kpi.distinct_count("keys", "all_keys", "k"),
    kpi.row_count("n", "all_n"),
]


def fact(spark):
    data = [
        (1, 1.0, "A", 1.0, 2.0, 10.0),
        (1, None, "a", None, 5.0, 20.0),  # NULL + 5 is NULL, its area still counts
        (1, 4.0, None, 1.0, 1.0, 0.0),
        (2, 7.0, "B", 3.0, 3.0, 0.0),  # no area at all: guarded ratio
        (2, 8.0, "C", 3.0, 3.0, None),
    ]
    return spark.createDataFrame(data, "b int, v double, band string, x double, y double, area double")


def test_additive_report(spark):
    got = rows(kpi.kpi_report(fact(spark), "b", SPEC), "ordered")
    globals_ = (5.0, 40.0, 0.57, 5)
    assert got == [(1, 2.5, 33.33, 0.17, 3, *globals_), (2, 7.5, 50.0, None, 2, *globals_)]


def test_since_limits_batches_but_not_globals(spark):
    df = fact(spark).selectExpr("timestamp_seconds(b) as b", "v", "band", "x", "y", "area")
    report = kpi.kpi_report(df, "b", SPEC, since="1970-01-01 00:00:01")
    got = report.collect()
    assert len(got) == 1 and got[0]["all_n"] == 5 and got[0]["n"] == 2


def counts(spark):
    data = [
        (1, "s", "k1", 1), (1, "s", "k1", 2), (1, "l", "k1", 1), (1, None, "k2", 3),
        (2, "s", "k1", 1), (2, "s", "k3", None),
    ]
    return spark.createDataFrame(data, "b int, split string, k string, item int")


def test_split_report_keeps_null_apart_from_total(spark):
    got = rows(kpi.kpi_report(counts(spark), "b", COUNTS, "split"))
    whole = (1.0, 3, 6)
    assert got == sorted(
        [
            (1, "ALL", 1.5, 2, 4, *whole),
            (1, "s", 2.0, 1, 2, *whole),
            (1, "l", 1.0, 1, 1, *whole),
            (1, None, 1.0, 1, 1, *whole),
            (2, "ALL", 0.5, 2, 2, *whole),
            (2, "s", 0.5, 2, 2, *whole),
        ],
        key=repr,
    )


def test_partials_of_parts_merge_to_the_whole(spark):
    for metrics, df, split in ((SPEC, fact(spark), None), (COUNTS, counts(spark), "split")):
        first = kpi.kpi_partials(df.filter("b = 1"), "b", metrics, split)
        rest = kpi.kpi_partials(df.filter("b = 2"), "b", metrics, split)
        merged = kpi.kpi_from_partials(first.unionByName(rest), "b", metrics, split)
        assert rows(merged) == rows(kpi.kpi_report(df, "b", metrics, split))


def test_totals_and_empty_input(spark):
    assert rows(kpi.kpi_totals(fact(spark), SPEC)) == [(5.0, 40.0, 0.57, 5)]
    assert kpi.kpi_report(fact(spark).filter("false"), "b", SPEC).count() == 0


def test_one_distinct_beside_sums(spark):
    spec = [kpi.distinct_count("bands", "all_bands", "band"), kpi.mean("avg_v", "all_avg_v", "v")]
    assert rows(kpi.kpi_report(fact(spark), "b", spec)) == [(1, 2, 2.5, 4, 5.0), (2, 2, 7.5, 4, 5.0)]


def test_true_mean_per_key(spark):
    spec = [kpi.rows_per_key("per_key", "all_per_key", "k")]
    assert rows(kpi.kpi_report(counts(spark), "b", spec)) == [(1, 2.0, 2.0), (2, 1.0, 2.0)]


def days(spark, until=4):
    """Four batches whose values overlap, with NULLs; the third has no value at all."""
    data = [(1, "s", "k1", 1), (1, "s", "k2", 2), (1, "l", "k1", None), (1, None, "k3", 1), (2, "s", "k2", 9), (2, "s", "k4", 9),
            (3, "l", None, None), (4, "s", "k1", 1), (4, "l", "k5", 7), (4, "l", "k5", 7)]
    df = spark.createDataFrame(data, "b int, split string, k string, item int")
    return df.filter(F.col("b") <= until).withColumn("b", F.expr("timestamp'2025-01-01' + make_interval(0, 0, 0, b)"))


@pytest.mark.parametrize("split", [None, "split"])
def test_bitmaps_count_as_values_do(spark, mart, split):
    for until in (1, 2, 2, 4):  # the second run is repeated
        stored = bitmaps.append_bitmaps(mart, "p", days(spark, until), "b", COUNTS, split, buckets=3)
    numbers = mart.table("p_values")
    assert numbers.count() == numbers.select("number").distinct().count() == numbers.select("measure", "value").distinct().count() == 9
    for since in (None, "2025-01-03 00:00:00"):
        got = kpi.kpi_from_partials(stored, "b", COUNTS, split, since)
        assert rows(got) == rows(kpi.kpi_report(days(spark), "b", COUNTS, split, since))


def test_bitmaps_without_sums(spark, mart):
    only = [kpi.distinct_count("keys", "all_keys", "k")]
    stored = bitmaps.append_bitmaps(mart, "p", days(spark), "b", only)
    assert rows(kpi.kpi_from_partials(stored, "b", only)) == rows(kpi.kpi_report(days(spark), "b", only))


def test_numbers_stay_and_are_dense_in_their_range(spark, mart):
    some = spark.range(500).selectExpr("'m' as measure", "cast(id as string) as value")
    first = {r["value"]: r["number"] for r in bitmaps.number_values(mart, "d", some, buckets=4).collect()}
    more = spark.range(400, 900).selectExpr("'m' as measure", "cast(id as string) as value").unionByName(some.limit(1).withColumn("value", F.lit(None).cast("string")))
    after = {r["value"]: r["number"] for r in bitmaps.number_values(mart, "d", more, buckets=4).collect()}
    assert len(after) == len(set(after.values())) == 900 and all(after[v] == n for v, n in first.items())
    for bucket in range(4):
        own = sorted(n - (bucket << 40) for n in after.values() if n >> 40 == bucket)
        assert own == list(range(len(own)))


def test_a_run_looks_at_its_own_batches_only(spark, mart):
    bitmaps.append_bitmaps(mart, "p", days(spark, 2), "b", COUNTS)
    seen = []
    spy = kpi.kpi_partials
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(bitmaps, "kpi_partials", lambda fact, *more: seen.append(fact.count()) or spy(fact, *more))
        stored = bitmaps.append_bitmaps(mart, "p", days(spark), "b", COUNTS)
    assert seen == [4]
    plan = kpi.kpi_from_partials(stored, "b", COUNTS)._jdf.queryExecution().optimizedPlan().toString()
    assert "p_values" not in plan and "bitmap_or_agg" in plan.lower().replace("bitmaporagg", "bitmap_or_agg")


def test_sketches_merge_and_lie_within_their_error(spark, mart):
    sketched = [kpi.sketched_count("keys", "all_keys", "k"), kpi.sketched_per_key("per_key", None, "v", "k"), kpi.row_count("n", "all_n")]
    exact = [kpi.distinct_count("keys", "all_keys", "k"), kpi.row_count("n", "all_n")]
    fact = spark.range(120_000).selectExpr(
        "timestamp'2025-01-01' + make_interval(0, 0, 0, cast(id % 3 as int)) as b", "id % 50000 as k", "cast(id % 7 as string) as v", "if(id % 2 = 0, 'x', null) as split")
    for until in ("2025-01-01", "2025-01-03"):
        fresh = fact.filter(F.col("b") <= F.lit(until)).filter(F.col("b") > F.lit(mart.watermark("p") or "1900-01-01"))
        mart.append_new("p", kpi.kpi_partials(fresh, "b", sketched, "split", lg_k=12), "b")
    got = kpi.kpi_from_partials(mart.table("p"), "b", sketched, "split").collect()
    want = kpi.kpi_report(fact, "b", exact, "split").collect()
    assert len(got) == len(want) == 9
    for g, w in zip(got, want):
        assert (g["b"], g["split"], g["n"], g["all_n"]) == (w["b"], w["split"], w["n"], w["all_n"])
        assert abs(g["keys"] - w["keys"]) <= 3 * kpi.standard_error(12) * w["keys"]
        assert abs(g["all_keys"] - 50_000) <= 3 * kpi.standard_error(12) * 50_000
    assert len(mart.table("p").first()["h0"]) < 3 << 12  # however many values it has seen
    with pytest.raises(ValueError, match="not both"):
        kpi.kpi_partials(fact, "b", [*sketched, *exact])


def test_sketches_of_nothing_count_zero(spark):
    sketched = [kpi.sketched_count("keys", "all_keys", "k"), kpi.row_count("n", None)]
    assert rows(kpi.kpi_report(days(spark).filter("b = timestamp'2025-01-04'"), "b", sketched))[0][1:] == (0, 1, 0)
