"""KPI queries over the line and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions.dates import month_start
from ledgermart.operators import kpi
from ledgermart.operators.bitmaps import append_bitmaps
from ledgermart.operators.replaced import ReplacedTable
from ledgermart.plans.queries.registry import naive, new_mart, query, read
from ledgermart.session import new_work_dir

RATING = [
    kpi.mean("monthly_avg_quantity", "global_avg_quantity", "l_quantity", digits=None),
    kpi.percent("pct_high_band", "global_pct_high_band", "l_returnflag in ('A', 'N')"),
    kpi.percent("pct_finished", "global_pct_finished", "lower(l_linestatus) = 'f'"),
    kpi.ratio_of_sums("monthly_price_per_unit", "global_price_per_unit", "l_extendedprice + l_tax", "l_quantity"),
]
RATING_SQL = """
    {avg} as {p}_quantity,
    round(100.0 * sum(case when l_returnflag in ('A', 'N') then 1 else 0 end) / count(*), 2) as {q}high_band,
    round(100.0 * sum(case when lower(l_linestatus) = 'f' then 1 else 0 end) / count(*), 2) as {q}finished,
    round(sum(l_extendedprice + l_tax) / nullif(sum(l_quantity), 0), 2) as {r}_price_per_unit
"""
MONTHLY = RATING_SQL.format(avg="avg(l_quantity)", p="monthly_avg", q="pct_", r="monthly")
GLOBAL = RATING_SQL.format(avg="round(avg(l_quantity), 2)", p="global_avg", q="global_pct_", r="global")


def line_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").withColumn("batch", month_start(F.col("l_shipdate")))


def order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").withColumn("batch", month_start(F.col("o_orderdate")))


@query(
    "kpi_rating",
    f"""
    with m as (select date_trunc('month', l_shipdate) as batch, {MONTHLY} from lineitem group by 1),
         g as (select {GLOBAL} from lineitem)
    select m.*, g.* from m cross join g
    """,
)
def kpi_rating(spark, sf_dir):
    return kpi.kpi_report(line_fact(spark, sf_dir), "batch", RATING)


WEIGHTED = [
    kpi.weighted_mean("weighted_discount", "global_weighted_discount", "l_discount", "l_extendedprice"),
    kpi.mean("avg_gap", "global_avg_gap", "l_extendedprice - p_retailprice"),
    kpi.mean("avg_row_total", "global_avg_row_total", "l_extendedprice + l_tax + l_discount"),
    kpi.distinct_count("brands", "global_brands", "p_brand"),
]
WEIGHTED_SQL = """
    round(sum(l_discount * l_extendedprice) / nullif(sum(l_extendedprice), 0), 2) as {p}weighted_discount,
    round(avg(l_extendedprice - p_retailprice), 2) as {p}avg_gap,
    round(avg(l_extendedprice + l_tax + l_discount), 2) as {p}avg_row_total,
    count(distinct p_brand) as {p}brands
"""


@query(
    "kpi_weighted",
    f"""
    with f as (select *, date_trunc('month', l_shipdate) as batch from lineitem join part on l_partkey = p_partkey),
         m as (select batch, {WEIGHTED_SQL.format(p="")} from f group by batch),
         g as (select {WEIGHTED_SQL.format(p="global_")} from f)
    select m.*, g.* from m cross join g
    """,
)
def kpi_weighted(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_brand")
    fact = line_fact(spark, sf_dir).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return kpi.kpi_report(fact, "batch", WEIGHTED)


SPLIT = [
    kpi.distinct_per_key("items_per_customer", "global_items_per_customer", "o_orderstatus", "o_custkey"),
    kpi.distinct_count("customers", "global_customers", "o_custkey"),
    kpi.row_count("orders_n", "global_orders_n"),
]
SPLIT_SQL = """
    round(cast(count(distinct o_orderstatus) as double) / count(distinct o_custkey), 2) as {p}items_per_customer,
    count(distinct o_custkey) as {p}customers, count(*) as {p}orders_n
"""


@query(
    "kpi_recom_split",
    f"""
    with f as (select *, date_trunc('month', o_orderdate) as batch from orders),
         m as (select batch, 'ALL' as o_orderpriority, {SPLIT_SQL.format(p="")} from f group by batch
               union all
               select batch, o_orderpriority, {SPLIT_SQL.format(p="")} from f group by batch, o_orderpriority),
         g as (select {SPLIT_SQL.format(p="global_")} from f)
    select m.*, g.* from m cross join g
    """,
)
def kpi_recom_split(spark, sf_dir):
    return kpi.kpi_report(order_fact(spark, sf_dir), "batch", SPLIT, split="o_orderpriority")


COST = [
    *[
        kpi.percent(f"pct_{level}", f"global_pct_{level}", f"contains(lower(o_orderpriority), '{level}')")
        for level in ("low", "medium", "high")
    ],
    kpi.distinct_count("customers", "global_customers", "o_custkey"),
    kpi.row_count("orders_n", "global_orders_n"),
    kpi.rows_per_key("orders_per_customer", "global_orders_per_customer", "o_custkey"),
]
COST_SQL = (
    ", ".join(
        f"round(100.0 * sum(case when lower(o_orderpriority) like '%{level}%' then 1 else 0 end) / count(*), 2) "
        f"as {{p}}pct_{level}"
        for level in ("low", "medium", "high")
    )
    + ", count(distinct o_custkey) as {p}customers, count(*) as {p}orders_n"
    + ", round(cast(count(*) as double) / count(distinct o_custkey), 2) as {p}orders_per_customer"
)


@query(
    "kpi_cost_bands",
    f"""
    with f as (select *, date_trunc('month', o_orderdate) as batch from orders),
         m as (select batch, {COST_SQL.format(p="")} from f group by batch),
         g as (select {COST_SQL.format(p="global_")} from f)
    select m.*, g.* from m cross join g
    """,
)
def kpi_cost_bands(spark, sf_dir):
    return kpi.kpi_report(order_fact(spark, sf_dir), "batch", COST)


@query(
    "kpi_since_watermark",
    f"""
    with m as (select date_trunc('month', l_shipdate) as batch, {MONTHLY} from lineitem
               where date_trunc('month', l_shipdate) > timestamp '1999-12-01' group by 1),
         g as (select {GLOBAL} from lineitem)
    select m.*, g.* from m cross join g
    """,
)
def kpi_since_watermark(spark, sf_dir):
    return kpi.kpi_report(line_fact(spark, sf_dir), "batch", RATING, since="1999-12-01")


@query("kpi_totals", f"select {GLOBAL} from lineitem")
def kpi_totals(spark, sf_dir):
    return kpi.kpi_totals(line_fact(spark, sf_dir), RATING)


@query(
    "kpi_stored_partials",
    f"""
    with f as (select *, date_trunc('month', o_orderdate) as batch from orders),
         m as (select batch, 'ALL' as o_orderpriority, {SPLIT_SQL.format(p="")} from f group by batch
               union all
               select batch, o_orderpriority, {SPLIT_SQL.format(p="")} from f group by batch, o_orderpriority),
         g as (select {SPLIT_SQL.format(p="global_")} from f)
    select m.*, g.* from m cross join g
    """,
)
def kpi_stored_partials(spark, sf_dir):
    """Partials stored in two runs; the report never looks at the fact again."""
    mart, fact = new_mart(spark, "partials"), order_fact(spark, sf_dir)
    for part in (fact.filter(F.col("batch") < F.lit("1999-01-01")), fact):
        fresh = part.filter(F.col("batch") > F.lit(mart.watermark("partials") or "1900-01-01"))
        partials = kpi.kpi_partials(fresh, "batch", SPLIT, "o_orderpriority")
        mart.append_new("partials", partials, "batch", regroup=True)
    return kpi.kpi_from_partials(mart.table("partials"), "batch", SPLIT, "o_orderpriority")


@query(
    "kpi_stored_bitmaps",
    f"""
    with f as (select *, date_trunc('month', o_orderdate) as batch from orders),
         m as (select batch, 'ALL' as o_orderpriority, {SPLIT_SQL.format(p="")} from f group by batch
               union all
               select batch, o_orderpriority, {SPLIT_SQL.format(p="")} from f group by batch, o_orderpriority),
         g as (select {SPLIT_SQL.format(p="global_")} from f)
    select m.*, g.* from m cross join g
    """,
)
def kpi_stored_bitmaps(spark, sf_dir):
    """Exact distinct counts from bitmaps stored in three runs; a run numbers the values of its own batches only."""
    mart, fact = new_mart(spark, "bitmaps"), order_fact(spark, sf_dir)
    for until in ("1997-01-01", "1999-01-01", None):
        known = fact if until is None else fact.filter(F.col("batch") < F.lit(until))
        stored = append_bitmaps(mart, "partials", known, "batch", SPLIT, "o_orderpriority")
    return kpi.kpi_from_partials(stored, "batch", SPLIT, "o_orderpriority")


SKETCHED = [
    kpi.sketched_count("customers", "global_customers", "o_custkey"),
    kpi.sketched_count("totals", "global_totals", "o_totalprice"),
    kpi.row_count("orders_n", "global_orders_n"),
]
#: What they estimate.
EXACT = [kpi.distinct_count("customers", "global_customers", "o_custkey"), kpi.distinct_count("totals", "global_totals", "o_totalprice")]
#: Standard errors that an estimate may be off.
ERRORS = 3


@query(
    "kpi_sketched_distincts",
    """
    with f as (select *, date_trunc('month', o_orderdate) as batch from orders),
         g as (select count(distinct o_custkey) as global_customers, count(distinct o_totalprice) as global_totals from f),
         m as (select batch, 'ALL' as o_orderpriority, count(distinct o_custkey) as customers,
                      count(distinct o_totalprice) as totals, count(*) as orders_n from f group by batch
               union all
               select batch, o_orderpriority, count(distinct o_custkey), count(distinct o_totalprice), count(*)
               from f group by batch, o_orderpriority)
    select m.*, g.*, true as customers_within, true as totals_within, true as global_within from m cross join g
    """,
)
def kpi_sketched_distincts(spark, sf_dir):
    """Estimates from sketches stored in two runs beside exact counts: within three standard errors or not."""
    mart, fact = new_mart(spark, "sketches"), order_fact(spark, sf_dir)
    for part in (fact.filter(F.col("batch") < F.lit("1999-01-01")), fact):
        fresh = part.filter(F.col("batch") > F.lit(mart.watermark("partials") or "1900-01-01"))
        mart.append_new("partials", kpi.kpi_partials(fresh, "batch", SKETCHED, "o_orderpriority"), "batch", regroup=True)
    estimates = kpi.kpi_from_partials(mart.table("partials"), "batch", SKETCHED, "o_orderpriority")
    exact = kpi.kpi_report(fact, "batch", EXACT, split="o_orderpriority")
    names = [m.name for m in EXACT] + [m.total for m in EXACT]
    own = estimates.select("batch", "o_orderpriority", "orders_n", *[F.col(n).alias(f"about_{n}") for n in names])
    both = exact.join(own, ["batch", "o_orderpriority"])
    near = {n: F.abs(F.col(f"about_{n}") - F.col(n)) <= F.greatest(F.lit(0.5), ERRORS * kpi.standard_error() * F.col(n)) for n in names}
    return both.select(
        "batch", "o_orderpriority", "orders_n", *names, near["customers"].alias("customers_within"), near["totals"].alias("totals_within"),
        (near["global_customers"] & near["global_totals"]).alias("global_within"),
    )


@query(
    "replace_kpi_rows",
    f"""
    select date_trunc('month', l_shipdate) as batch, {MONTHLY} from lineitem
    where date_trunc('month', l_shipdate) <> timestamp '1997-03-01' group by 1
    union all
    select date_trunc('month', l_shipdate) as batch, {MONTHLY} from lineitem
    where date_trunc('month', l_shipdate) = timestamp '1997-03-01' and l_quantity > 10 group by 1
    """,
)
def replace_kpi_rows(spark, sf_dir):
    """One month's KPI rows are written again; the others stay. Repeating either write changes nothing."""
    fact = line_fact(spark, sf_dir)
    table = ReplacedTable(spark, new_work_dir(spark, "kpi"))
    monthly = [kpi.Metric(m.name, None, m.finish, m.sums, m.distinct, m.digits) for m in RATING]
    report = kpi.kpi_report(fact, "batch", monthly)
    table.append_new(report.filter(F.col("batch") < F.lit("1998-01-01")), "batch")
    for _ in range(2):
        table.append_new(report, "batch")
    again = kpi.kpi_report(fact.filter((F.col("batch") == F.lit("1997-03-01")) & (F.col("l_quantity") > 10)), "batch", monthly)
    for _ in range(2):
        table.replace(again, "batch")
    return naive(table.table())
