"""Keys, staging, upserts and stored tables over the order and party tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.functions.dates import month_start, month_tag
from ledgermart.functions.text import hash_key, identity_key
from ledgermart.operators import ledger as lg
from ledgermart.operators.incremental import incremental_filter
from ledgermart.operators.keys import entity_delta, latest_per_key, missing_keys, union_conformed
from ledgermart.operators.store import sync_schema
from ledgermart.plans.queries.kpis import line_fact, order_fact
from ledgermart.plans.queries.registry import naive, new_mart, query, read

# one property shape for three kinds of party; the batch is derived from the key
PARTY_COLUMNS = {
    "id": "bigint", "name": "string", "segment": "string", "size": "string",
    "nation": "bigint", "ref": "string", "batch": "timestamp_ntz",
}
_BATCH = "make_timestamp(2024, cast(1 + {key} % 12 as int), 1, 0, 0, 0)"


def parties(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Customers, suppliers and parts; every seventh has no id, names lose their number."""

    def shaped(table: str, key: str, name: str, **more: str) -> DataFrame:
        return read(spark, sf_dir, table).selectExpr(
            f"case when {key} % 7 = 0 then null else {key} end as id",
            f"{name} as name",
            f"cast({key} % 50 as string) as ref",
            f"cast({_BATCH.format(key=key)} as timestamp_ntz) as batch",
            *[f"{e} as {n}" for n, e in more.items()],
        )

    return [
        shaped("customer", "c_custkey", "c_mktsegment", segment="c_mktsegment", nation="cast(c_nationkey as bigint)"),
        shaped("supplier", "s_suppkey", "concat(' Supplier ', cast(s_nationkey as string))", nation="cast(s_nationkey as bigint)"),
        shaped("part", "p_partkey", "p_type", segment="p_brand", size="cast(p_size as string)"),
    ]


def _parties_sql() -> str:
    def shaped(table, key, name, segment, size, nation):
        return (
            f"select case when {key} % 7 = 0 then null else {key} end as id, {name} as name, {segment} as segment, "
            f"{size} as size, {nation} as nation, cast({key} % 50 as string) as ref, "
            f"{_BATCH.format(key=key)} as batch from {table}"
        )

    none = "cast(null as varchar)"
    return " union all ".join(
        [
            shaped("customer", "c_custkey", "c_mktsegment", "c_mktsegment", none, "cast(c_nationkey as bigint)"),
            shaped("supplier", "s_suppkey", "concat(' Supplier ', cast(s_nationkey as varchar))", none, none, "cast(s_nationkey as bigint)"),
            shaped("part", "p_partkey", "p_type", "p_brand", "cast(p_size as varchar)", "cast(null as bigint)"),
        ]
    )


def _norm(c: str) -> str:
    return f"replace(lower(coalesce(trim({c}), 'NA')), ' ', '')"


_KEY_SQL = (
    "coalesce(nullif(cast(id as varchar), ''), "
    f"md5(concat_ws('|', {_norm('name')}, {_norm('segment')}, coalesce(ref, 'NA'))))"
)
_STATE_SQL = f"md5(concat_ws('|', {_norm('name')}, {_norm('segment')}, {_norm('size')}))"


@query(
    "identity_key",
    f"""
    with c as (select c_custkey, case when c_custkey % 7 = 0 then null else c_custkey end as id, c_name as name,
                      case when c_custkey % 14 = 0 then null else concat('  ', c_mktsegment, ' ') end as segment,
                      cast(c_nationkey as varchar) as ref from customer)
    select c_custkey, {_KEY_SQL} as entity_key from c
    """,
)
def identity_keys(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "case when c_custkey % 7 = 0 then null else c_custkey end as id",
        "c_name as name",
        "case when c_custkey % 14 = 0 then null else concat('  ', c_mktsegment, ' ') end as segment",
        "cast(c_nationkey as string) as ref",
    )
    return customers.select("c_custkey", identity_key("id", ["name", "segment"], ["ref"]).alias("entity_key"))


@query(
    "business_key",
    f"""
    select c_custkey, md5(concat_ws('|', {_norm('c_mktsegment')}, {_norm('n_name')})) as state_key
    from customer join nation on c_nationkey = n_nationkey
    """,
)
def business_key(spark, sf_dir):
    nations = read(spark, sf_dir, "nation")
    joined = read(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", hash_key(["c_mktsegment", "n_name"]).alias("state_key"))


@query("conform_union", _parties_sql())
def conform_union(spark, sf_dir):
    return union_conformed(parties(spark, sf_dir), PARTY_COLUMNS)


@query(
    "property_delta",
    f"""
    with p as ({_parties_sql()}), k as (select *, {_KEY_SQL} as entity_key, {_STATE_SQL} as state_key from p
               where batch > timestamp '2024-03-01'),
    r as (select *, row_number() over (partition by entity_key order by batch desc, state_key nulls last,
          id nulls last, name nulls last, segment nulls last, size nulls last, nation nulls last, ref nulls last) as rn
          from k)
    select * exclude (rn) from r where rn = 1
    """,
)
def property_delta(spark, sf_dir):
    return entity_delta(
        parties(spark, sf_dir),
        PARTY_COLUMNS,
        id_col="id",
        identity_cols=["name", "segment"],
        identity_raw_cols=["ref"],
        state_cols=["name", "segment", "size"],
        ts_col="batch",
        key_name="entity_key",
        state_name="state_key",
        watermark="2024-03-01",
    )


def month_ledger(spark, sf_dir) -> DataFrame:
    """One ledger row per order month."""
    months = read(spark, sf_dir, "orders").select(month_start(F.col("o_orderdate")).alias("audit_ts")).distinct()
    return months.select(
        F.date_format("audit_ts", "yyyyMM").alias("audit_id"),
        F.concat(F.lit("raw/orders/"), month_tag(F.col("audit_ts")), F.lit(".csv")).alias("filepath"),
        F.lit("orders").alias("target_table"),
        F.lit("run").alias("dag_run_id"),
        "audit_ts",
    )


def raw_orders(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").withColumn("audit_id", F.date_format("o_orderdate", "yyyyMM"))


@query(
    "stage_join_audit",
    """
    select o.*, strftime(o_orderdate, '%Y%m') as audit_id, date_trunc('month', o_orderdate) as audit_ts
    from orders o where date_trunc('month', o_orderdate) > timestamp '1999-12-01'
    """,
)
def stage_join_audit(spark, sf_dir):
    ledger = month_ledger(spark, sf_dir)
    return lg.join_audit(raw_orders(spark, sf_dir), ledger, "orders", after="1999-12-01")


@query(
    "lineage",
    """
    select concat('raw/orders/', strftime(o_orderdate, '%Y-%m'), '.csv') as filepath, 'orders' as target_table,
           'run' as dag_run_id, count(*) as n_rows
    from orders group by 1
    """,
)
def lineage(spark, sf_dir):
    traced = lg.lineage(raw_orders(spark, sf_dir), month_ledger(spark, sf_dir))
    return traced.groupBy("filepath", "target_table", "dag_run_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "unprocessed_files",
    """
    select distinct concat('raw/orders/', strftime(o_orderdate, '%Y-%m'), '.csv') as filepath from orders
    where o_orderdate >= timestamp '2000-01-01'
    """,
)
def unprocessed_files(spark, sf_dir):
    ledger = month_ledger(spark, sf_dir)
    done = ledger.filter(F.col("audit_ts") < F.lit("2000-01-01"))
    return lg.unprocessed(ledger.select("filepath"), done)


@query(
    "audit_ids",
    """
    with f as (select distinct concat('raw/orders/', strftime(o_orderdate, '%Y-%m'), '.csv') as filepath from orders)
    select filepath, cast(1041 + row_number() over (order by filepath) as varchar) as audit_id,
           timestamp '2025-03-01' + to_microseconds(row_number() over (order by filepath)) as audit_ts
    from f
    """,
)
def audit_ids(spark, sf_dir):
    """The ledger is already past the run's own timestamp."""
    known = spark.range(1).select(F.lit("1041").alias("audit_id"), F.lit("2025-03-01").cast("timestamp").alias("audit_ts"))
    files = month_ledger(spark, sf_dir).select("filepath")
    return naive(lg.allocate_ids(files, known, "2025-01-01 00:00:00"))


@query(
    "orphan_purge",
    """
    select year(o_orderdate) as y, count(*) as kept, 0 as orphans from orders
    where month(o_orderdate) not in (2, 7) group by 1
    union all
    select year(o_orderdate) as y, 0 as kept, count(*) as orphans from orders
    where month(o_orderdate) in (2, 7) group by 1
    """,
)
def orphan_purge(spark, sf_dir):
    """Rows of two months never reached the ledger: invisible, and found as orphans."""
    raw = raw_orders(spark, sf_dir)
    ledger = month_ledger(spark, sf_dir).filter(~F.month("audit_ts").isin(2, 7))
    year, n, none = F.year("o_orderdate").cast("bigint").alias("y"), F.count(F.lit(1)), F.lit(0).cast("bigint")
    kept = lg.join_audit(raw, ledger).groupBy(year).agg(n.alias("kept"), F.max(none).alias("orphans"))
    lost = lg.orphan_rows(raw, ledger).groupBy(year).agg(F.max(none).alias("kept"), n.alias("orphans"))
    return kept.unionByName(lost)


@query(
    "incremental_filter",
    """
    select o_orderkey, o_orderdate from orders
    where o_orderdate > (select max(o_orderdate) from orders where o_orderdate < timestamp '2000-06-01')
    """,
)
def incremental(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    target = orders.filter(F.col("o_orderdate") < F.lit("2000-06-01"))
    return incremental_filter(orders, "o_orderdate", target)


@query(
    "incremental_append",
    "select l_orderkey, l_linenumber, l_quantity, date_trunc('month', l_shipdate) as batch from lineitem",
)
def incremental_append(spark, sf_dir):
    """Months before 1999, then everything, then everything again: equals one full load."""
    mart = new_mart(spark, "append")
    fact = line_fact(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "batch")
    mart.append_new("fact", fact.filter(F.col("batch") < F.lit("1999-01-01")), "batch", regroup=True)
    mart.append_new("fact", fact, "batch", regroup=True)
    return mart.append_new("fact", fact, "batch", regroup=True)


def _customer_state(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"
    )


_LATEST_SQL = """
    select * exclude (rn) from (
        select o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_totalprice,
               row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) as rn from orders)
    where rn = 1
"""


@query("latest_per_key", _LATEST_SQL)
def latest(spark, sf_dir):
    return latest_per_key(_customer_state(spark, sf_dir), "o_custkey", "o_orderdate", ["o_orderkey"])


@query("upsert_latest", _LATEST_SQL)
def upsert_latest(spark, sf_dir):
    """Two upserts by key into hash buckets; the second replaces the first's rows."""
    mart, state = new_mart(spark, "upsert"), _customer_state(spark, sf_dir)
    cut = F.col("o_orderdate") < F.lit("1998-06-01")
    mart.upsert("state", state.filter(cut), "o_custkey", ["o_orderdate"], ["o_orderkey"])
    return mart.upsert("state", state.filter(~cut), "o_custkey", ["o_orderdate"], ["o_orderkey"])


@query(
    "schema_sync",
    """
    select o_orderkey, date_trunc('month', o_orderdate) as batch,
           case when o_orderdate >= timestamp '1998-01-01' then o_orderstatus end as o_orderstatus
    from orders
    """,
)
def schema_sync(spark, sf_dir):
    """The second batch brings a column and drops another; the table follows it."""
    mart, fact = new_mart(spark, "sync"), order_fact(spark, sf_dir)
    cut = F.col("batch") < F.lit("1998-01-01")
    mart.append_new("t", fact.filter(cut).select("o_orderkey", "batch", "o_totalprice"), "batch", regroup=True)
    return mart.append_new("t", fact.filter(~cut).select("o_orderkey", "batch", "o_orderstatus"), "batch", regroup=True)


def _in_types(rows: DataFrame, wanted: dict[str, tuple[str, ...]]) -> DataFrame:
    """Columns ``name``: (expression, types): in the first of the types that holds all its values, or else the last; without types as they are.

    Their values are looked at once, in one aggregation, so that a larger table's keys do not overflow.
    """
    asked = [(n, e, t) for n, (e, *kinds) in wanted.items() for t in kinds[:-1]]
    outside = [F.expr(f"coalesce(bool_or({e} is not null and try_cast({e} as {t}) is null), false)") for _, e, t in asked]
    too_small = {(n, t) for (n, _, t), over in zip(asked, rows.agg(*outside).first() if asked else ()) if over}
    kind = {n: next((t for t in kinds if (n, t) not in too_small), None) for n, (_, *kinds) in wanted.items()}
    return rows.select(*[F.expr(f"cast({e} as {kind[n]})" if kind[n] else e).alias(n) for n, (e, *_) in wanted.items()])


@query(
    "schema_widening",
    """
    select date_trunc('month', o_orderdate) as batch, cast(o_orderkey as varchar) as o_orderkey,
           cast(o_custkey as bigint) as o_custkey,
           case when o_orderdate >= timestamp '1999-01-01' then cast(o_totalprice as double) else cast(floor(o_totalprice) as double) end as o_totalprice
    from orders
    """,
)
def schema_widening(spark, sf_dir):
    """Keys go from int to bigint to text, totals from whole numbers to fractions; what is stored follows.

    The short types of the first two deliveries are those that hold their rows.
    """
    mart, fact = new_mart(spark, "widening"), order_fact(spark, sf_dir)
    total = ("floor(o_totalprice)", "int", "double")
    runs = (
        ("batch < '1997-01-01'", ("o_orderkey", "int", "bigint"), ("o_custkey", "int", "bigint"), total),
        ("batch >= '1997-01-01' and batch < '1999-01-01'", ("o_orderkey",), ("o_custkey", "smallint", "int", "bigint"), total),
        ("batch >= '1999-01-01'", ("o_orderkey", "string"), ("o_custkey",), ("o_totalprice",)),
    )
    for when, key, customer, paid in runs:
        columns = {"batch": ("batch",), "o_orderkey": key, "o_custkey": customer, "o_totalprice": paid}
        mart.append_new("t", _in_types(fact.filter(when), columns), "batch", regroup=True)
    return mart.table("t")


@query(
    "upsert_growing",
    """
    select o_orderkey, o_custkey, case when o_orderkey % 50 = 0 then 'new' else o_orderstatus end as o_orderstatus from orders
    """,
)
def upsert_growing(spark, sf_dir):
    """A table that begins with few rows and grows a hundredfold: its buckets grow with it, and a key's type widens."""
    mart, orders = new_mart(spark, "growing"), read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    whole = {"o_orderkey": ("o_orderkey", "int", "bigint"), "o_custkey": ("o_custkey",), "o_orderstatus": ("o_orderstatus",)}
    first = _in_types(orders.filter("o_orderkey % 100 = 0"), whole)
    changed = orders.filter("o_orderkey % 50 = 0").withColumn("o_orderstatus", F.lit("new"))
    for step, rows in enumerate((first, orders, changed)):
        mart.upsert("t", rows.withColumn("step", F.lit(step)), "o_orderkey", ["step"], rows_per_bucket=300)
    return mart.table("t").drop("step")


@query(
    "clustered_fact",
    """
    select l_partkey, date_trunc('month', l_shipdate) as batch, count(*) as n, sum(l_quantity) as quantity
    from lineitem where l_partkey between 100 and 140 group by 1, 2
    """,
)
def clustered_fact(spark, sf_dir):
    """Lines stored in the order of their part within a month: a filter by part skips most files and row groups."""
    mart, fact = new_mart(spark, "clustered"), line_fact(spark, sf_dir)
    stored = mart.append_new("fact", fact.select("l_partkey", "l_quantity", "batch"), "batch", cluster=["l_partkey"])
    chosen = stored.filter(F.col("l_partkey").between(100, 140))
    return chosen.groupBy("l_partkey", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


_DELIVERY = "year(o_orderdate) + case when o_orderkey % 10 = 3 then 1 else 0 end"


@query(
    "late_rows",
    f"""
    with d as (select date_trunc('month', o_orderdate) as batch, {_DELIVERY} as delivery from orders),
         w as (select delivery, max(batch) as newest from d group by delivery),
         m as (select d.*, coalesce(batch <= (select max(newest) from w where w.delivery < d.delivery), false) as late from d)
    select batch, count(*) filter (not late) as n_written, count(*) filter (late) as n_late,
           sum(case when late then delivery - year(batch) else 0 end)::bigint as deliveries_late
    from m group by batch
    """,
)
def late_rows(spark, sf_dir):
    """Orders delivered a year at a time, some a delivery too late: these are kept apart and counted, not lost."""
    mart, fact = new_mart(spark, "late"), order_fact(spark, sf_dir).withColumn("delivery", F.expr(_DELIVERY))
    # one delivery a year; what the write itself has counted is what is there
    for year in [r["delivery"] for r in fact.select("delivery").distinct().orderBy("delivery").collect()]:
        found = mart.append_feed("fact", fact.filter(F.col("delivery") == year).select("o_orderkey", "delivery", "batch"), "batch")
        assert found.n_late == mart.late("fact").filter(F.col("late_version") == found.version).count()
    none, one = F.lit(0).cast("bigint"), F.count(F.lit(1))
    written = mart.table("fact").groupBy("batch").agg(one.alias("n_written"), F.max(none).alias("n_late"), F.max(none).alias("deliveries_late"))
    late = mart.late("fact").groupBy("batch").agg(
        F.max(none).alias("n_written"), one.alias("n_late"), F.sum(F.col("delivery") - F.year("batch")).alias("deliveries_late")
    )
    both = written.unionByName(late).groupBy("batch")
    return both.agg(*[F.sum(c).alias(c) for c in ("n_written", "n_late", "deliveries_late")])


@query(
    "schema_conform",
    """
    select o_orderkey, cast(null as varchar) as note, o_custkey from orders
    union all select l_orderkey, l_returnflag, l_partkey from lineitem
    """,
)
def schema_conform(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as o_orderkey", "l_returnflag as note", "l_partkey as o_custkey"
    )
    return sync_schema(read(spark, sf_dir, "orders"), lines).unionByName(lines)


@query(
    "full_refresh",
    "select o_orderpriority, count(*) as n from orders where o_orderstatus = 'F' group by 1",
)
def full_refresh(spark, sf_dir):
    """A table rebuilt from scratch, read back through a view."""
    mart, orders = new_mart(spark, "full"), read(spark, sf_dir, "orders")
    mart.write_full("t", orders.select("o_orderpriority"))
    mart.view("full_refresh_view", mart.write_full("t", orders.filter("o_orderstatus = 'F'").select("o_orderpriority")))
    return spark.sql("select o_orderpriority, count(*) as n from full_refresh_view group by o_orderpriority")


@query(
    "fact_projection",
    f"""
    select l_orderkey, l_linenumber, l_quantity, l_extendedprice, o_orderdate,
           coalesce(nullif(cast(case when o_custkey % 3 = 0 then null else o_custkey end as varchar), ''),
           md5(concat_ws('|', {_norm('o_orderpriority')}, {_norm('o_orderstatus')}, coalesce(cast(o_custkey as varchar), 'NA'))))
           as entity_key
    from lineitem join orders on l_orderkey = o_orderkey
    """,
)
def fact_projection(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        identity_key(
            F.expr("case when o_custkey % 3 = 0 then null else o_custkey end"),
            ["o_orderpriority", "o_orderstatus"],
            [F.col("o_custkey").cast("string")],
        ).alias("entity_key"),
    )
    lines = read(spark, sf_dir, "lineitem")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "o_orderdate", "entity_key")


@query(
    "set_difference",
    """
    select c_custkey, c_name from customer
    where c_custkey not in (select o_custkey from orders where o_orderdate >= timestamp '2000-06-01')
    """,
)
def set_difference(spark, sf_dir):
    recent = read(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit("2000-06-01"))
    orders = recent.select(F.col("o_custkey").alias("c_custkey")).distinct()
    return missing_keys(read(spark, sf_dir, "customer").select("c_custkey", "c_name"), orders, "c_custkey")
