import pytest

from conftest import rows
from ledgermart.operators import quality as q


@pytest.fixture(scope="module")
def tables(spark):
    cert = [
        ("a", "A", 1.0, "1"), ("b", "a", 20000.0, "1"), ("b", None, 0.99, "2"), (None, "G", 20000.01, None),
        ("c", "Z", None, "9"),
    ]
    rec = [("a",), ("a",), ("x",), ("x",), (None,)]
    return {
        "cert": spark.createDataFrame(cert, "k string, band string, area double, audit_id string"),
        "rec": spark.createDataFrame(rec, "k string"),
        "audit": spark.createDataFrame([("1",), ("2",)], "audit_id string"),
    }


def failures(tables, *checks):
    return [r["failures"] for c in checks for r in q.run_checks(tables, [c]).collect()]


def test_row_checks(tables):
    assert failures(tables, *q.not_null("cert", "k", "band")) == [1, 1]
    assert failures(tables, q.between("cert", "area", 1, 20000)) == [2]  # bounds included, NULL passes
    assert failures(tables, q.between("cert", "area", 1, 20000, strictly=True)) == [4]


def test_value_checks_count_distinct_values(tables):
    bands = ("A", "B", "C", "D", "E", "F", "G")
    assert failures(tables, q.accepted_values("cert", "band", bands)) == [2]  # "a" and "Z"
    assert failures(tables, q.in_set("cert", "band", bands, nulls="fail")) == [3]
    assert rows(q.failing_rows(q.in_set("cert", "band", bands), tables)) == [("Z", 1), ("a", 1)]


def test_key_checks(tables):
    assert failures(tables, q.unique("cert", "k"), q.unique("cert", "k, band")) == [1, 0]
    assert failures(tables, q.relationship("rec", "k", "cert")) == [2]  # rows, not values
    assert failures(tables, q.relationship("cert", "audit_id", "audit")) == [1]


def test_one_result_per_check_and_gate(tables):
    checks = [
        *q.not_null("cert", "k", "audit_id"), q.unique("cert", "k"), q.relationship("rec", "k", "cert"),
        q.accepted_values("cert", "band", ["A"]), q.between("cert", "area", 0, 10),
    ]
    result = q.run_checks(tables, checks)
    assert result.count() == len(checks) and result.columns == list(q.RESULT)
    copies = q.checked_copies(tables, checks)
    assert rows(q.run_checks(copies, checks)) == rows(result)
    with pytest.raises(q.CheckFailure, match="not_null"):
        q.gate(result)
    q.gate(q.run_checks(tables, q.not_null("audit", "audit_id")))
