"""Queries over files that Spark first writes from the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.functions.dates import month_start
from ledgermart.operators import ledger as lg
from ledgermart.operators.loader import load_files, purge_unaudited, raw_table
from ledgermart.operators.replaced import ReplacedTable
from ledgermart.plans.queries.registry import new_mart, query, read
from ledgermart.session import new_work_dir
from ledgermart.sources import adhoc, csv
from ledgermart.sources.files import list_files, missing_files, readable_path, route_paths, select_batch
from ledgermart.streaming.files import stream_load, stream_table

_PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size bigint, p_retailprice double"
_BAD = "p_partkey % 13 = 0"
_MISSING = "p_partkey % 11 = 0"


def _write_text(df: DataFrame, folder: str, *by: str) -> None:
    """CSV as it would be landed: header, quotes where needed, blanks kept."""
    writer = df.write.option("header", "true").option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    (writer.partitionBy(*by) if by else writer).csv(folder)


def _dirty_parts(spark, sf_dir) -> DataFrame:
    """Parts as text: some sizes missing, some unreadable, some written as ``12.0``."""
    return read(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as p_partkey",
        "case when p_partkey % 5 = 0 then concat(' ', p_name, ', \"new\"') else p_name end as p_name",
        "case when p_partkey % 17 = 0 then 'null' else p_brand end as p_brand",
        "p_type",
        f"case when {_BAD} then 'n.a.' when {_MISSING} then 'NULL' "
        "when p_partkey % 7 = 0 then concat(cast(p_size as string), '.0') else cast(p_size as string) end as p_size",
        "cast(p_retailprice as string) as p_retailprice",
    )


@query(
    "csv_tolerant_load",
    f"""
    select p_partkey, case when p_partkey % 5 = 0 then concat(p_name, ', "new"') else p_name end as p_name,
           case when p_partkey % 17 = 0 then null else p_brand end as p_brand, p_type,
           case when {_MISSING} then null else cast(p_size as bigint) end as p_size, p_retailprice
    from part where not ({_BAD})
    """,
)
def csv_tolerant_load(spark, sf_dir):
    folder, schema = new_work_dir(spark, "csv"), T.StructType.fromDDL(_PART_SCHEMA)
    _write_text(_dirty_parts(spark, sf_dir), folder)
    good, _ = csv.split_good_bad(csv.read_batch_csv(spark, [folder], schema, multiline=False), schema)
    return good.drop(*csv.POSITION)


@query(
    "csv_rejects",
    f"select p_partkey, 'p_size' as bad_column, 'n.a.' as bad_value from part where {_BAD}",
)
def csv_rejects(spark, sf_dir):
    folder, schema = new_work_dir(spark, "csv"), T.StructType.fromDDL(_PART_SCHEMA)
    _write_text(_dirty_parts(spark, sf_dir), folder)
    _, bad = csv.split_good_bad(csv.read_batch_csv(spark, [folder], schema, multiline=False), schema)
    return bad.select(
        "p_partkey", F.col(csv.BAD_COLUMN).alias("bad_column"), F.col(csv.BAD_VALUE).alias("bad_value")
    )


@query(
    "null_tokens",
    """
    select o_orderkey, case when o_orderkey % 4 < 3 then null when o_orderkey % 3 = 0 then 'N/A'
           else o_orderpriority end as priority
    from orders
    """,
)
def null_tokens(spark, sf_dir):
    marked = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case o_orderkey % 4 when 0 then ' NULL ' when 1 then '' when 2 then 'Null' else "
        "case when o_orderkey % 3 = 0 then 'N/A' else concat(o_orderpriority, '  ') end end as priority",
    )
    return csv.null_tokens(marked, ["priority"])


@query(
    "load_stats",
    f"""
    with s as (select cast(p_size % 4 as int) as shelf, count(*) as parsed,
                      sum(case when {_BAD} then 1 else 0 end) as bad from part group by 1)
    select shelf, cast(parsed as bigint) as rows_parsed, cast(parsed - bad as bigint) as rows_loaded,
           cast(bad as bigint) as errors_seen,
           case when bad = 0 then 'LOADED' when bad < parsed then 'PARTIALLY_LOADED' else 'LOAD_FAILED' end as status,
           case when bad > 0 then 'p_size' end as first_error_column_name
    from s
    """,
)
def load_stats(spark, sf_dir):
    """Per-file statistics, summed per folder so that the number of files does not matter."""
    folder, schema = new_work_dir(spark, "csv"), T.StructType.fromDDL(_PART_SCHEMA)
    shelves = read(spark, sf_dir, "part").selectExpr("cast(p_partkey as string) as p_partkey", "p_size % 4 as shelf")
    _write_text(_dirty_parts(spark, sf_dir).join(shelves, "p_partkey"), folder, "shelf")
    files = [readable_path(r["filepath"]) for r in list_files(spark, folder).select("filepath").collect()]
    tagged = csv.typed(csv.read_batch_csv(spark, files, schema, multiline=False), schema)
    shelf = F.regexp_extract(csv.FILE, r"/shelf=(\d+)/", 1).cast("int").alias("shelf")
    summed = lg.load_stats(tagged).groupBy(shelf).agg(
        F.sum("rows_parsed").alias("rows_parsed"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("errors_seen").alias("errors_seen"),
        F.max("first_error_column_name").alias("first_error_column_name"),
    )
    return summed.withColumn("status", lg.load_status(F.col("rows_parsed"), F.col("errors_seen")))


_ROUTED = """
    with o as (select *, case when o_orderkey % 2 = 0 then 'certificates' else 'recommendations' end as kind,
                      case o_orderkey % 3 when 0 then 'display' when 1 then 'domestic' else 'non_domestic' end as domain
               from orders)
"""


def _routed_orders(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "*",
        "case when o_orderkey % 2 = 0 then 'certificates' else 'recommendations' end as kind",
        "case o_orderkey % 3 when 0 then 'display' when 1 then 'domestic' else 'non_domestic' end as domain",
    )


def _paths(spark, sf_dir) -> DataFrame:
    """File names the orders would come in, beside one that routes nowhere."""
    tag = F.date_format("o_orderdate", "yyyy-MM")
    name = F.concat_ws("/", F.lit("s3://bucket/raw"), "kind", "domain", F.concat_ws("_", "domain", "kind", tag))
    found = _routed_orders(spark, sf_dir).select(F.concat(name, F.lit(".csv")).alias("filepath")).distinct()
    return found.unionByName(spark.range(1).select(F.lit("s3://bucket/raw/other/x_1995-01.csv").alias("filepath")))


_PATHS = (
    _ROUTED
    + """, p as (select distinct kind, domain, strftime(o_orderdate, '%Y-%m') as month_tag,
        concat('s3://bucket/raw/', kind, '/', domain, '/', domain, '_', kind, '_',
               strftime(o_orderdate, '%Y-%m'), '.csv') as filepath from o)
"""
)


@query(
    "route_paths",
    _PATHS
    + """
    select filepath, kind, domain, month_tag, concat('raw_', domain, '_', kind) as target_table from p
    union all select 's3://bucket/raw/other/x_1995-01.csv', null, null, '1995-01', null
    """,
)
def routed(spark, sf_dir):
    return route_paths(_paths(spark, sf_dir))


@query("select_batch", _PATHS + "select filepath from p where month_tag = '1997-05'")
def selected(spark, sf_dir):
    return select_batch(_paths(spark, sf_dir), "1997-05")


@query(
    "batch_complete",
    """
    select m.tag as month_tag, p.o_orderpriority
    from (select distinct strftime(o_orderdate, '%Y-%m') as tag from orders) m
    cross join (select distinct o_orderpriority from orders) p
    where not exists (select 1 from orders o where strftime(o.o_orderdate, '%Y-%m') = m.tag
                      and o.o_orderpriority = p.o_orderpriority and o.o_totalprice > 400000)
    """,
)
def batch_complete(spark, sf_dir):
    """Months in which no large order of some priority came in."""
    orders = read(spark, sf_dir, "orders").withColumn("month_tag", F.date_format("o_orderdate", "yyyy-MM"))
    key = ["month_tag", "o_orderpriority"]
    months = orders.select("month_tag").distinct()
    # the expected list is one row: what occurs anywhere is expected in every month
    priorities = orders.agg(F.collect_set("o_orderpriority").alias("all"))
    expected = months.crossJoin(F.broadcast(priorities)).select("month_tag", F.explode("all").alias("o_orderpriority"))
    return missing_files(orders.filter("o_totalprice > 400000"), expected, key)


@query(
    "ledger_load",
    _ROUTED
    + """
    select concat('raw_', domain, '_', kind) as target_table, strftime(o_orderdate, '%Y') as year,
           'LOADED' as status, count(*) as rows_loaded, cast(sum(o_custkey) as bigint) as keys
    from o group by 1, 2
    """,
)
def ledger_load(spark, sf_dir):
    """Landed files of six kinds loaded under the ledger, then summed through it."""
    mart, (landing, schemas) = new_mart(spark, "load"), _landed_orders(spark, sf_dir)
    lg.gate_loads(load_files(mart, list_files(spark, landing), schemas, "run", multiline=False))
    return _loaded_by_year(mart, schemas)


def _landed_orders(spark, sf_dir):
    """A landing folder with order files of six kinds by year, and the schema of each raw table."""
    landing = new_work_dir(spark, "landing") + "/raw"
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    tag = F.date_format("o_orderdate", "yyyy-01").alias("month")
    _write_text(_routed_orders(spark, sf_dir).select(*columns, "kind", "domain", tag), landing, "kind", "domain", "month")
    schema = T.StructType.fromDDL(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    )
    tables = [f"raw_{d}_{k}" for d in ("display", "domestic", "non_domestic") for k in ("certificates", "recommendations")]
    return landing, dict.fromkeys(tables, schema)


def _loaded_by_year(mart, schemas) -> DataFrame:
    """Rows and key sums by raw table and year of the file, of batches that the ledger vouches for."""
    ledger = lg.read_ledger(mart)
    known = [r["audit_id"] for r in ledger.select("audit_id").collect()]  # one a file
    loaded = [raw_table(mart, t, schema, known) for t, schema in schemas.items() if mart.exists(t)]
    rows = reduce(DataFrame.unionByName, loaded)
    traced = lg.lineage(rows.select("audit_id", "o_custkey"), ledger.drop("status"))
    year = F.regexp_extract("filepath", r"month=(\d{4})-", 1).alias("year")
    return traced.groupBy("target_table", year, F.lit("LOADED").alias("status")).agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.sum("o_custkey").alias("keys")
    )


_LOADED_SQL = _ROUTED + """
    select concat('raw_', domain, '_', kind) as target_table, strftime(o_orderdate, '%Y') as year,
           'LOADED' as status, count(*) as rows_loaded, cast(sum(o_custkey) as bigint) as keys
    from o group by 1, 2
"""


@query("ledger_reload", _LOADED_SQL)
def ledger_reload(spark, sf_dir):
    """All files loaded, those of one year loaded again: nothing counts twice."""
    mart, (landing, schemas) = new_mart(spark, "reload"), _landed_orders(spark, sf_dir)
    files = list_files(spark, landing)
    lg.gate_loads(load_files(mart, files, schemas, "first"))
    again = [r["filepath"] for r in files.filter(F.col("filepath").contains("month=1996-")).collect()]
    lg.gate_loads(load_files(mart, files, schemas, "again", reload=again))
    return _loaded_by_year(mart, schemas)


@query("stream_load", _LOADED_SQL)
def streamed_load(spark, sf_dir):
    """The same files handed to the loader by a file stream, some at a time."""
    mart, (landing, schemas) = new_mart(spark, "stream-load"), _landed_orders(spark, sf_dir)
    stream_load(spark, landing, mart, schemas, "s", new_work_dir(spark, "stream-state"), files_per_batch=40).awaitTermination()
    return _loaded_by_year(mart, schemas)


@query(
    "load_purge",
    _ROUTED + "select concat('raw_', domain, '_', kind) as target_table, count(*) as n from o where year(o_orderdate) <> 1997 group by 1",
)
def load_purge(spark, sf_dir):
    """Batches that lose their ledger row are purged; what is left is counted without the ledger."""
    mart, (landing, schemas) = new_mart(spark, "purge"), _landed_orders(spark, sf_dir)
    lg.gate_loads(load_files(mart, list_files(spark, landing), schemas, "run", multiline=False))
    kept = lg.read_ledger(mart).filter(~F.col("filepath").contains("month=1997-"))
    mart.write_full(lg.LEDGER, kept)
    for table in schemas:
        purge_unaudited(mart, table)
    counts = [mart.table(t).groupBy(F.lit(t).alias("target_table")).agg(F.count(F.lit(1)).alias("n")) for t in schemas]
    return reduce(DataFrame.unionByName, counts)


@query(
    "load_gate",
    """
    select o_orderpriority as run, case when bool_and(o_orderstatus = 'O') then 'passed' else 'failed' end as gate,
           count(*) filter (o_orderstatus <> 'O') as not_loaded
    from orders group by 1
    """,
)
def load_gate(spark, sf_dir):
    """The success gate over results of one run for each priority: orders as files, their status as the load's."""
    results = read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("run"), F.when(F.col("o_orderstatus") == "O", lg.LOADED).otherwise(lg.LOAD_FAILED).alias("status")
    )
    bad = lg.not_loaded(results).groupBy("run").agg(F.count(F.lit(1)).alias("not_loaded"))
    found = results.select("run").distinct().join(bad, "run", "left").withColumn("not_loaded", F.coalesce("not_loaded", F.lit(0).cast("bigint")))
    return found.select("run", F.when(F.col("not_loaded") == 0, "passed").otherwise("failed").alias("gate"), "not_loaded")


@query("csv_line_breaks", "select p_partkey, replace(p_name, ' ', chr(10)) as p_name, cast(p_size as bigint) as p_size from part")
def csv_line_breaks(spark, sf_dir):
    """Parts with line breaks in their quoted names, in files whose lines end in three ways."""
    folder = new_work_dir(spark, "csv-breaks")
    line = F.concat(F.col("p_partkey").cast("string"), F.lit(',"'), F.replace("p_name", F.lit(" "), F.lit("\n")), F.lit('",'), F.col("p_size").cast("string"))
    ends = F.element_at(F.array(F.lit("\r\n"), F.lit("\r"), F.lit("\n")), (F.col("p_partkey") % 3 + 1).cast("int"))
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.concat(line, ends).alias("line"), F.floor(F.col("p_partkey") / 500).alias("file"))
    # a file is written as one text of at most 500 lines, so that its header comes first
    whole = parts.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("key", "line"))).alias("lines"))
    body = F.array_join(F.transform("lines", lambda x: x["line"]), "")
    whole.select("file", F.concat(F.lit("p_partkey,p_name,p_size\r\n"), body).alias("value")).write.partitionBy("file").text(folder)
    files = [readable_path(r["filepath"]) for r in list_files(spark, folder, "*.txt").collect()]
    schema = T.StructType.fromDDL("p_partkey bigint, p_name string, p_size bigint")
    good, _ = csv.split_good_bad(csv.read_batch_csv(spark, files, schema), schema)
    return good.drop(*csv.POSITION)


_PLACES = """
    with p as (
        select cast(floor(p_partkey / 500) as bigint) as file, p_partkey, p_partkey % 13 = 0 as bad,
               case when p_partkey % 3 = 0 then replace(p_name, ' ', chr(10)) else p_name end as name
        from part
    ), l as (
        select *, string_split(name, chr(10)) as pieces, sum(len(string_split(name, chr(10)))) over (partition by file order by p_partkey) as lines
        from p
    )
    select file, count(*) as rows_parsed, count(*) filter (bad) as errors_seen,
           cast(1 + min_by(lines, p_partkey) filter (bad) as bigint) as first_error_line,
           min_by(length(pieces[-1]) + 3 + case when len(pieces) = 1 then length(p_partkey::varchar) + 2 else 0 end, p_partkey)
               filter (bad) as first_error_character
    from l group by file
"""


@query("load_error_places", _PLACES)
def load_error_places(spark, sf_dir):
    """Line and character of each file's first error, in files whose records hold quoted line breaks."""
    folder = new_work_dir(spark, "csv-places")
    broken = "case when p_partkey % 3 = 0 then replace(p_name, ' ', '\\n') else p_name end"
    line = f"""concat(cast(p_partkey as string), ',"', {broken}, '",', case when {_BAD} then 'n.a.' else cast(p_size as string) end)"""
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.expr(line).alias("line"), F.floor(F.col("p_partkey") / 500).alias("file"))
    # a file is written as one text of at most 500 records, so that its header comes first
    whole = parts.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("key", "line"))).alias("lines"))
    body = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    whole.select("file", F.concat(F.lit("p_partkey,p_name,p_size\n"), body).alias("value")).write.partitionBy("file").text(folder)
    schema = T.StructType.fromDDL("p_partkey bigint, p_name string, p_size bigint")
    files = [readable_path(r["filepath"]) for r in list_files(spark, folder, "*.txt").collect()]
    stats = lg.load_stats(csv.typed(csv.read_batch_csv(spark, files, schema), schema))
    file = F.regexp_extract(csv.FILE, r"/file=(\d+)/", 1).cast("bigint").alias("file")
    found = lg.located_errors(stats, schema.fieldNames())
    return found.select(file, "rows_parsed", "errors_seen", "first_error_line", "first_error_character")


@query("table_export", "select o_orderkey, o_custkey, o_totalprice, date_trunc('month', o_orderdate) as batch from orders")
def table_export(spark, sf_dir):
    """The import scan of a dashboard: a plain partitioned Parquet folder, exported in two runs and read whole."""
    table = ReplacedTable(spark, new_work_dir(spark, "export"))
    orders = read(spark, sf_dir, "orders").withColumn("batch", month_start(F.col("o_orderdate")))
    exported = orders.select("o_orderkey", "o_custkey", "o_totalprice", "batch")
    table.append_new(exported.filter(F.col("batch") < F.lit("1999-01-01")), "batch")
    table.append_new(exported, "batch")
    return table.table()


@query("adhoc_csv_json", "select c_custkey, c_name, c_acctbal, c_mktsegment from customer")
def adhoc_csv_json(spark, sf_dir):
    """Half of the customers through CSV, half through JSON, read by extension."""
    schema = "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string"
    folder = new_work_dir(spark, "adhoc")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    _write_text(customers.filter("c_custkey % 2 = 0"), f"{folder}/even.csv")
    customers.filter("c_custkey % 2 = 1").write.json(f"{folder}/odd.json")
    frames = [adhoc.read_any(spark, f"{folder}/{n}", schema) for n in ("even.csv", "odd.json")]
    return frames[0].unionByName(frames[1])


@query(
    "api_dump",
    """
    select o_orderkey, o_custkey, o_orderstatus as note from orders
    union all select o_orderkey, o_custkey, o_orderpriority as note from orders
    """,
)
def api_dump(spark, sf_dir):
    """Payload pages with a small ``rows`` array each, written and read back."""
    folder = new_work_dir(spark, "api") + "/pages.json"
    entry = [F.struct("o_orderkey", "o_custkey", F.col(c).alias("note")) for c in ("o_orderstatus", "o_orderpriority")]
    pages = read(spark, sf_dir, "orders").select(F.array(*entry).alias("rows"))
    pages.write.json(folder)
    return adhoc.read_api_dump(spark, folder, T.StructType.fromDDL("o_orderkey bigint, o_custkey bigint, note string"))


@query(
    "stream_available_now",
    """
    select cast(ts as date) as day, event_type, count(*) as n, count(distinct event_id) as ids from events group by 1, 2
    """,
)
def stream_available_now(spark, sf_dir):
    """Everything available streamed into a mart table, then aggregated."""
    mart, checkpoint = new_mart(spark, "stream"), new_work_dir(spark, "stream-state")
    schema = read(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stream_table(stream, mart, "events", checkpoint).awaitTermination()
    rows = mart.table("events")
    return rows.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids")
    )
