"""Checks by batch beside the same checks over whole tables."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landed import FEB, JAN, first_month, second_month
from ledgermart.operators import quality as q
from ledgermart.operators.check_log import CheckLog
from ledgermart.operators.keys import latest_per_key
from ledgermart.operators.store import Mart
from ledgermart.plans.pipeline import CertificateMart

SCHEMA = {"child": "k string, p string, v int, b string, at int", "parent": "p string, x int, at int"}
CHECKS = [
    *q.not_null("child", "k", "v"), q.unique("child", "k"), q.unique("child", "k, b"), q.relationship("child", "p", "parent"),
    q.accepted_values("child", "b", ["x"]), q.in_set("child", "b", ["x", "y"], nulls="fail"), q.between("child", "v", 1, 5),
    q.unique("parent", "p"), *q.not_null("parent", "x"),
]


def made(seed, runs=4, n=25):
    rng = random.Random(seed)
    some = lambda *values: rng.choice([*values, None])
    child = [(some(*"abcdefghijklmnop"), some(*"rstuvw"), some(0, 1, 3, 9), some("x", "y", "z", "Z"), r) for r in range(runs) for _ in range(n)]
    parent = [(some(*"rstuvwxyz"), some(1, 2), r) for r in range(runs) for _ in range(2)]
    return {"child": child, "parent": parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_add_up_to_the_whole(spark, mart, seed):
    data = {t: spark.createDataFrame(d, SCHEMA[t]) for t, d in made(seed).items()}
    log = CheckLog(mart, "c", CHECKS)
    for turn in range(4):
        got = log.run({t: d.filter(F.col("at") == turn) for t, d in data.items()}, {"child": str(turn)})
        so_far = {t: d.filter(F.col("at") <= turn) for t, d in data.items()}
        assert rows(got) == rows(q.run_checks(so_far, CHECKS)), turn
    assert got.columns == list(q.RESULT) and got.filter("failures > 0").count() > 6
    assert log.highs() == {"child": "3"}
    again = CheckLog(mart, "c", CHECKS)
    assert rows(again.run({})) == rows(got)
    log.reset()
    assert log.highs() == {} and log.results().filter("failures > 0").count() == 0
    assert rows(log.run(data)) == rows(got)


@pytest.mark.parametrize("seed", [3, 4])
def test_newer_rows_take_the_place_of_older_ones(spark, mart, seed):
    data = {t: spark.createDataFrame(d, SCHEMA[t]) for t, d in made(seed).items()}
    data["child"] = data["child"].filter("k is not null")
    checks = [c for c in CHECKS if c.column != "k, b"]
    newest = lambda d: latest_per_key(d, "k", "at", ["p", "v", "b"])
    log = CheckLog(mart, "c", checks, {"child": "k"})
    for turn in range(4):
        fresh = {t: d.filter(F.col("at") == turn) for t, d in data.items()}
        got = log.run({"child": newest(fresh["child"]), "parent": fresh["parent"]})
        so_far = {t: d.filter(F.col("at") <= turn) for t, d in data.items()}
        assert rows(got) == rows(q.run_checks({**so_far, "child": newest(so_far["child"])}, checks)), turn


def test_a_dead_run_is_repeated(spark, mart, monkeypatch):
    data = {t: spark.createDataFrame(d, SCHEMA[t]) for t, d in made(5).items()}
    log = CheckLog(mart, "c", CHECKS)
    log.run({t: d.filter("at < 2") for t, d in data.items()})
    rest = {t: d.filter("at >= 2") for t, d in data.items()}
    with monkeypatch.context() as dying:
        dying.setattr(log, "_new_duplicates", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            log.run(rest)
    assert rows(log.run(rest)) == rows(q.run_checks(data, CHECKS))


def test_what_cannot_be_checked_by_batch_is_refused(spark, mart):
    with pytest.raises(ValueError, match="keyed by k"):
        CheckLog(mart, "c", [q.unique("child", "b")], {"child": "k"})
    with pytest.raises(ValueError, match="keyed by k"):
        CheckLog(mart, "c", [q.relationship("other", "p", "child", "p")], {"child": "k"})


def test_a_mart_checked_by_batch(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    built = CertificateMart(Mart(spark, str(tmp_path / "mart")), reissues=True, checks_by_batch=True)
    plain = CertificateMart(built.mart, reissues=True)
    first_month(landing)
    built.run(str(landing), "run-1", "2025-02-03 08:00:00", JAN)
    second_month(landing)
    seen = {}
    spy = CheckLog.run
    monkeypatch.setattr(CheckLog, "run", lambda log, fresh, *more: seen.update({t: d.count() for t, d in fresh.items()}) or spy(log, fresh, *more))
    built.run(str(landing), "run-2", "2025-03-03 08:00:00", FEB)
    assert seen["raw_domestic_certificates"] == seen["stg_domestic_certificates"] == 2  # of five, four by key
    assert seen["raw_copy_audit"] == 6
    assert rows(built.raw_log.results()) == rows(plain.check_raw())
    assert rows(built.staging_log.results()) == rows(plain.check_staging())
