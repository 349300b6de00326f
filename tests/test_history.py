from pyspark.sql import functions as F

from conftest import rows
from ledgermart.operators import scd2

DAYS = ["2025-01-01 00:00:00", "2025-02-01 00:00:00", "2025-03-01 00:00:00", "2025-04-01 00:00:00"]
LOG = [
    ("same", "x", 0), ("same", "x", 1), ("same", "x", 2),
    ("swap", "a", 0), ("swap", "b", 1), ("swap", "a", 2),  # there and back: three versions
    ("late", "n", 2),
    ("gone", "g", 0),
    ("null", None, 0), ("null", "v", 1), ("null", None, 3),
]


def log(spark):
    data = [(k, s, DAYS[i]) for k, s, i in LOG]
    return spark.createDataFrame(data, "k string, state string, t string").withColumn(
        "audit_ts", F.col("t").cast("timestamp")
    ).drop("t")


def versions(df):
    return rows(df.selectExpr("k", "state", "cast(valid_from as string)", "cast(valid_to as string)", "scd_id"))


def batch(spark, day):
    return log(spark).filter(F.col("audit_ts") == F.lit(day))


def test_fold_equals_history(spark):
    dim = scd2.scd2_first(batch(spark, DAYS[0]), "k", DAYS[0])
    for day in DAYS[1:]:
        dim = scd2.scd2_apply(dim, batch(spark, day), "k", ["state"], day)
    got = versions(dim)
    assert got == versions(scd2.scd2_history(log(spark), "k", ["state"], "audit_ts"))
    assert [v[1:3] for v in got if v[0] == "swap"] == [("a", DAYS[0]), ("a", DAYS[2]), ("b", DAYS[1])]
    assert sum(v[0] == "same" for v in got) == 1 and sum(v[0] == "null" for v in got) == 3


def test_stored_snapshot_equals_history_and_reruns(spark, mart):
    for day in DAYS:
        for _ in range(2):
            mart.write_snapshot("dim", batch(spark, day), "k", ["state"], day)
    dim = mart.table("dim")
    assert versions(dim) == versions(scd2.scd2_history(log(spark), "k", ["state"], "audit_ts"))
    current = mart.current("dim")
    assert current.count() == current.select("k").distinct().count() == 5
    assert current.filter("is_current").count() == 5
    assert len({r[4] for r in versions(dim)}) == dim.count()


def test_intervals_are_contiguous(spark):
    history = scd2.scd2_history(log(spark), "k", ["state"], "audit_ts")
    gaps = history.alias("a").join(history.alias("b"), F.expr("a.k = b.k and a.valid_to = b.valid_from"), "inner")
    assert gaps.count() == history.filter("valid_to is not null").count()


def test_history_sees_the_last_state_of_a_batch(spark):
    data = [("k", "a", 1, 1), ("k", "b", 1, 2), ("k", "b", 2, 1), ("k", "c", 3, 1)]
    df = spark.createDataFrame(data, "k string, state string, b int, seq int")
    df = df.withColumn("b", F.timestamp_seconds("b"))
    got = scd2.scd2_history(df, "k", ["state"], "b", ["seq"])
    assert sorted(r["state"] for r in got.collect()) == ["b", "c"]
