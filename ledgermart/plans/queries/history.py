"""Type-2 history over the order log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.functions.dates import month_start
from ledgermart.operators import scd2
from ledgermart.operators.keys import latest_per_key
from ledgermart.plans.queries.registry import naive, new_mart, query, read

def _history_sql(batch: str) -> str:
    """Versions of a customer's priority: last state per batch, changes, next start."""
    return f"""
    with s as (select o_custkey, o_orderpriority, {batch} as batch,
               row_number() over (partition by o_custkey, {batch}
                                  order by o_orderdate desc, o_orderkey desc, o_orderpriority) as rn from orders),
    l as (select *, lag(o_orderpriority) over (partition by o_custkey order by batch) as previous from s where rn = 1),
    c as (select o_custkey, o_orderpriority, batch from l where previous is distinct from o_orderpriority),
    h as (select *, batch as valid_from, lead(batch) over (partition by o_custkey order by batch) as valid_to from c)
    select o_custkey, o_orderpriority, valid_from, valid_to,
           md5(concat_ws('|', cast(o_custkey as varchar), strftime(valid_from, '%Y%m%d%H%M%S%f'))) as scd_id
    from h
    """


_YEAR = "make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0)"
_COLUMNS = ["o_custkey", "o_orderpriority", scd2.VALID_FROM, scd2.VALID_TO, scd2.SCD_ID]


def _log(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")


def _yearly(spark, sf_dir) -> DataFrame:
    """Last state per customer and year."""
    log = _log(spark, sf_dir).withColumn("year", F.year("o_orderdate"))
    return latest_per_key(log, ["o_custkey", "year"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"])


@query("scd2_history", _history_sql("date_trunc('month', o_orderdate)"))
def scd2_history(spark, sf_dir):
    log = _log(spark, sf_dir).withColumn("batch", month_start(F.col("o_orderdate")))
    order = ["o_orderdate", "o_orderkey"]
    return scd2.scd2_history(log, "o_custkey", ["o_orderpriority"], "batch", order).select(*_COLUMNS)


def _fold(spark, sf_dir) -> DataFrame:
    states = _yearly(spark, sf_dir).select("o_custkey", "o_orderpriority", "year")
    dim = None
    # one step a year: the plan has as many steps as the log has years
    for year in [r["year"] for r in states.select("year").distinct().orderBy("year").collect()]:
        delta, run_ts = states.filter(F.col("year") == year).drop("year"), f"{year}-01-01 00:00:00"
        if dim is None:
            dim = scd2.scd2_first(delta, "o_custkey", run_ts)
        else:
            dim = scd2.scd2_apply(dim, delta, "o_custkey", ["o_orderpriority"], run_ts)
    return dim


@query("scd2_apply_fold", _history_sql(_YEAR))
def scd2_apply_fold(spark, sf_dir):
    """One history step per year, in one plan."""
    return naive(_fold(spark, sf_dir).select(*_COLUMNS))


def _snapshots(spark, sf_dir):
    mart = new_mart(spark, "snapshot")
    states = _yearly(spark, sf_dir).select("o_custkey", "o_orderpriority", "year")
    year = F.col("year")
    runs = ((1995, year <= 1997), (1998, year.between(1998, 1999)), (2000, year >= 2000))  # together all years
    for run, chosen in runs:
        delta = latest_per_key(states.filter(chosen), "o_custkey", "year").drop("year")
        mart.write_snapshot("dim", delta, "o_custkey", ["o_orderpriority"], f"{run}-01-01 00:00:00")
    return mart


_THREE_RUNS = (
    "make_timestamp(case when year(o_orderdate) <= 1997 then 1995 when year(o_orderdate) <= 1999 then 1998 "
    "else 2000 end, 1, 1, 0, 0, 0)"
)


@query("scd2_snapshot_table", _history_sql(_THREE_RUNS))
def scd2_snapshot_table(spark, sf_dir):
    """Three runs against a stored dimension, which is read and rewritten each time."""
    return naive(_snapshots(spark, sf_dir).table("dim").select(*_COLUMNS))


@query("dim_current", f"select *, true as is_current from ({_history_sql(_THREE_RUNS)}) where valid_to is null")
def dim_current(spark, sf_dir):
    return naive(_snapshots(spark, sf_dir).current("dim").select(*_COLUMNS, "is_current"))
