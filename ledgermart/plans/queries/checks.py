"""Data checks over the order, line, event and label tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermart.operators import quality
from ledgermart.plans.queries.registry import query, read

CHECKS = [
    *quality.not_null("lineitem", "l_orderkey", "l_shipdate"),
    *quality.not_null("flagged", "flag"),
    quality.unique("orders", "o_orderkey"),
    quality.unique("lineitem", "l_orderkey, l_linenumber"),
    quality.relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
    quality.relationship("orders", "o_custkey", "vip", "c_custkey"),
    quality.accepted_values("orders", "o_orderstatus", ["F", "O"]),
    quality.in_set("lineitem", "l_returnflag", ["A", "N", "R"]),
    quality.in_set("flagged", "flag", ["click", "view"], nulls="fail"),
    quality.in_set("flagged", "flag", ["click", "view"]),
    quality.between("lineitem", "l_quantity", 1, 45),
    quality.between("lineitem", "l_quantity", 1, 50, strictly=True),
]
_FLAG = "case when event_id % 9 = 0 then null else event_type end"


def _tables(spark, sf_dir):
    tables = {t: read(spark, sf_dir, t) for t in ("lineitem", "orders")}
    tables["vip"] = read(spark, sf_dir, "customer").filter("c_acctbal > 0")
    tables["flagged"] = read(spark, sf_dir, "events").select("event_id", F.expr(_FLAG).alias("flag"))
    return tables


def _evidence(test: str, table: str, column: str):
    return next(c for c in CHECKS if (c.test, c.table, c.column) == (test, table, column))


@query("dq_not_null", f"select event_id, cast(null as varchar) as flag from events where {_FLAG} is null")
def dq_not_null(spark, sf_dir):
    return quality.failing_rows(_evidence(quality.NOT_NULL, "flagged", "flag"), _tables(spark, sf_dir))


@query(
    "dq_unique",
    "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1",
)
def dq_unique(spark, sf_dir):
    check = _evidence(quality.UNIQUE, "lineitem", "l_orderkey, l_linenumber")
    return quality.failing_rows(check, _tables(spark, sf_dir))


@query(
    "dq_relationships",
    """
    select o_custkey as value, count(*) as n_rows from orders
    where o_custkey not in (select c_custkey from customer where c_acctbal > 0) group by 1
    """,
)
def dq_relationships(spark, sf_dir):
    return quality.failing_rows(_evidence(quality.RELATIONSHIPS, "orders", "o_custkey"), _tables(spark, sf_dir))


@query(
    "dq_accepted",
    "select o_orderstatus as value, count(*) as n_rows from orders where o_orderstatus not in ('F', 'O') group by 1",
)
def dq_accepted(spark, sf_dir):
    return quality.failing_rows(_evidence(quality.ACCEPTED, "orders", "o_orderstatus"), _tables(spark, sf_dir))


@query(
    "dq_in_set",
    f"""
    select {_FLAG} as value, count(*) as n_rows from events
    where coalesce({_FLAG}, '?') not in ('click', 'view') group by 1
    """,
)
def dq_in_set(spark, sf_dir):
    return quality.failing_rows(_evidence(quality.IN_SET, "flagged", "flag"), _tables(spark, sf_dir))


@query("dq_between", "select l_orderkey, l_linenumber, l_quantity from lineitem where not l_quantity between 1 and 45")
def dq_between(spark, sf_dir):
    found = quality.failing_rows(_evidence(quality.BETWEEN, "lineitem", "l_quantity"), _tables(spark, sf_dir))
    return found.select("l_orderkey", "l_linenumber", "l_quantity")


def _result(test: str, table: str, column: str, count: str) -> str:
    return f"select '{test}' as test, '{table}' as table_name, '{column}' as column_name, ({count}) as failures"


@query(
    "dq_report",
    " union all ".join(
        [
            _result("not_null", "lineitem", "l_orderkey", "select count(*) from lineitem where l_orderkey is null"),
            _result("not_null", "lineitem", "l_shipdate", "select count(*) from lineitem where l_shipdate is null"),
            _result("not_null", "flagged", "flag", f"select count(*) from events where {_FLAG} is null"),
            _result("unique", "orders", "o_orderkey",
                    "select count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)"),
            _result("unique", "lineitem", "l_orderkey, l_linenumber",
                    "select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)"),
            _result("relationships", "lineitem", "l_orderkey",
                    "select count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)"),
            _result("relationships", "orders", "o_custkey",
                    "select count(*) from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)"),
            _result("accepted_values", "orders", "o_orderstatus",
                    "select count(distinct o_orderstatus) from orders where o_orderstatus not in ('F', 'O')"),
            _result("distinct_values_in_set", "lineitem", "l_returnflag",
                    "select count(distinct l_returnflag) from lineitem where l_returnflag not in ('A', 'N', 'R')"),
            _result("distinct_values_in_set", "flagged", "flag",
                    f"select count(distinct coalesce({_FLAG}, '?')) from events where coalesce({_FLAG}, '?') not in ('click', 'view')"),
            _result("distinct_values_in_set", "flagged", "flag",
                    f"select count(distinct {_FLAG}) from events where {_FLAG} not in ('click', 'view')"),
            _result("values_between", "lineitem", "l_quantity",
                    "select count(*) from lineitem where not l_quantity between 1 and 45"),
            _result("values_between", "lineitem", "l_quantity",
                    "select count(*) from lineitem where not (l_quantity > 1 and l_quantity < 50)"),
        ]
    ),
)
def dq_report(spark, sf_dir):
    return quality.run_checks(_tables(spark, sf_dir), CHECKS)
