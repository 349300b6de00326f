"""Dashboard and calendar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermart.functions.dates import month_start
from ledgermart.operators import bi, kpi
from ledgermart.operators.calendar import HIERARCHY, calendar_for, date_drill, join_calendar
from ledgermart.plans.queries.kpis import COST, GLOBAL, MONTHLY, RATING, line_fact, order_fact
from ledgermart.plans.queries.registry import query, read


@query(
    "bi_average_card",
    """
    select avg(l_quantity) as avg_quantity, avg(l_linenumber) as avg_line, avg(l_suppkey) as avg_supplier
    from lineitem
    """,
)
def bi_average_card(spark, sf_dir):
    columns = {"avg_quantity": "l_quantity", "avg_line": "l_linenumber", "avg_supplier": "l_suppkey"}
    return bi.average_card(read(spark, sf_dir, "lineitem"), columns)


@query(
    "bi_headline_card",
    f"""
    with m as (select date_trunc('month', l_shipdate) as batch, {MONTHLY} from lineitem group by 1),
         r as (select m.*, g.* from m cross join (select {GLOBAL} from lineitem) g),
         o as (select date_trunc('month', o_orderdate) as batch, count(distinct o_custkey) as c from orders group by 1)
    select * from (select round(avg(global_pct_high_band), 2) as avg_global_pct_high_band,
                          round(avg(global_avg_quantity), 2) as avg_global_quantity from r),
                  (select cast(count(*) * (select count(distinct o_custkey) from orders) as bigint)
                          as total_customers_as_shown from o),
                  (select count(distinct o_custkey) as total_customers_latest from orders)
    """,
)
def bi_headline_card(spark, sf_dir):
    """As shown, the card sums a global repeated on every row; the latest batch's value stands beside it."""
    rating = kpi.kpi_report(line_fact(spark, sf_dir), "batch", RATING)
    orders = kpi.kpi_report(order_fact(spark, sf_dir), "batch", COST)
    newest = bi.latest_batch(orders, "batch")
    return bi.headline_card(
        [
            rating.agg(
                F.round(F.avg("global_pct_high_band"), 2).alias("avg_global_pct_high_band"),
                F.round(F.avg("global_avg_quantity"), 2).alias("avg_global_quantity"),
            ),
            orders.agg(F.sum("global_customers").alias("total_customers_as_shown")),
            newest.agg(F.max("global_customers").alias("total_customers_latest")),
        ]
    )


@query(
    "bi_month_band",
    """
    select strftime(l_shipdate, '%b') as month, l_returnflag, count(l_returnflag) as n from lineitem group by 1, 2
    """,
)
def bi_month_band(spark, sf_dir):
    labelled = read(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "MMM").alias("month"), "l_returnflag")
    return bi.count_by(labelled, ["month", "l_returnflag"], "l_returnflag")


@query(
    "bi_month_band_pivot",
    """
    select date_trunc('month', l_shipdate) as batch,
           count(*) filter (where l_returnflag = 'A') as "l_returnflag_A",
           count(*) filter (where l_returnflag = 'N') as "l_returnflag_N",
           count(*) filter (where l_returnflag = 'R') as "l_returnflag_R"
    from lineitem group by 1
    """,
)
def bi_month_band_pivot(spark, sf_dir):
    return bi.pivot_counts(line_fact(spark, sf_dir), "batch", "l_returnflag", ["A", "N", "R"])


@query(
    "bi_band_split",
    """
    select l_returnflag, count(l_returnflag) as n,
           cast(count(l_returnflag) as double) / (select count(l_returnflag) from lineitem) as share
    from lineitem group by 1
    """,
)
def bi_band_split(spark, sf_dir):
    return bi.share_of_total(read(spark, sf_dir, "lineitem"), "l_returnflag", "l_returnflag")


@query(
    "bi_ratio_total",
    """
    select l_returnflag, avg(l_quantity) as avg_value,
           avg(l_quantity) / (select avg(l_quantity) from lineitem) as ratio_to_total
    from lineitem group by 1
    """,
)
def bi_ratio_total(spark, sf_dir):
    return bi.ratio_to_total(read(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity")


@query(
    "bi_default_summary",
    """
    select sum(l_quantity) as sum_l_quantity, cast(sum(l_linenumber) as bigint) as sum_l_linenumber,
           cast(sum(l_suppkey) as bigint) as sum_l_suppkey
    from lineitem
    """,
)
def bi_default_summary(spark, sf_dir):
    return bi.default_summary(read(spark, sf_dir, "lineitem"), ["l_quantity", "l_linenumber", "l_suppkey"])


@query(
    "bi_month_label",
    """
    select o_orderkey, case when year(o_orderdate) = 1998 then strftime(o_orderdate, '%b') end as label from orders
    """,
)
def bi_month_label(spark, sf_dir):
    """Batch -> label lookup; batches without a label keep their rows."""
    fact = order_fact(spark, sf_dir)
    months = fact.select("batch").distinct().filter(F.year("batch") == 1998)
    labels = months.withColumn("label", F.date_format("batch", "MMM"))
    return bi.month_labels(fact, "batch", labels, "label").select("o_orderkey", "label")


_PARTS = """
    cast(year({d}) as int) as year, cast(quarter({d}) as int) as quarter_no,
    concat('Qtr ', cast(quarter({d}) as varchar)) as quarter, cast(month({d}) as int) as month_no,
    strftime({d}, '%B') as month, cast(day({d}) as int) as day
"""


@query(
    "calendar_dim",
    f"""
    with r as (select min(year(o_orderdate)) as y0, max(year(o_orderdate)) as y1 from orders),
         d as (select cast(unnest(generate_series(make_date(y0, 1, 1)::timestamp, make_date(y1, 12, 31)::timestamp,
                                                  interval 1 day)) as date) as date from r)
    select date, {_PARTS.format(d="date")} from d
    """,
)
def calendar_dim(spark, sf_dir):
    return calendar_for(read(spark, sf_dir, "orders"), "o_orderdate").orderBy("date")


@query(
    "calendar_join",
    f"select o_orderkey, cast(o_orderdate as date) as date, {_PARTS.format(d='o_orderdate')} from orders",
)
def calendar_join(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    joined = join_calendar(orders, "o_orderdate", calendar_for(orders, "o_orderdate"))
    return joined.select("o_orderkey", "date", "year", "quarter_no", "quarter", "month_no", "month", "day")


@query(
    "calendar_rollup",
    f"""
    with c as (select o_totalprice, {_PARTS.format(d="o_orderdate")} from orders)
    select year, quarter, month, day, count(*) as orders_n,
           cast(4 - (grouping(year) + grouping(quarter) + grouping(month) + grouping(day)) as int) as level
    from c group by rollup (year, quarter, month, day)
    """,
)
def calendar_rollup(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    dated = join_calendar(orders, "o_orderdate", calendar_for(orders, "o_orderdate"))
    drill = date_drill(dated, [F.count(F.lit(1)).alias("orders_n")])
    return drill.select(*HIERARCHY, "orders_n", "level")


@query(
    "sort_months",
    """
    select strftime(o_orderdate, '%B') as month, cast(month(o_orderdate) as int) as month_no, count(*) as n
    from orders group by 1, 2
    """,
)
def sort_months(spark, sf_dir):
    months = read(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "MMMM").alias("month"), F.month("o_orderdate").alias("month_no")
    )
    return months.groupBy("month", "month_no").agg(F.count(F.lit(1)).alias("n")).orderBy("month_no")


@query(
    "batch_timestamp_text",
    "select o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d %H:%M:%S') as batch_text from orders",
)
def batch_timestamp_text(spark, sf_dir):
    text = month_start(F.col("o_orderdate")).cast("string").alias("batch_text")
    return read(spark, sf_dir, "orders").select("o_orderkey", text)
