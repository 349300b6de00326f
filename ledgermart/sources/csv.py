"""Positional, row-tolerant CSV reading.

The file is read as text columns bound by position, normalised, then cast with
``try_cast``. A value that is present but does not parse makes its row bad; short
and long rows are accepted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.functions.text import NULL_TOKENS
from ledgermart.session import new_work_dir

FILE, BLOCK, SEQ = "_file", "_block", "_seq"
POSITION = (FILE, BLOCK, SEQ)
BAD_COLUMN, BAD_VALUE = "_bad_column", "_bad_value"
ERROR = (BAD_COLUMN, BAD_VALUE)

# One field: quoted with doubled quotes inside, or not begun by a quote; possessive, so linear.
_FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|)'
#: Lines after which no quote is open, if none was before, and if one was.
COMPLETE_LINE = f"^{_FIELD}(?:,{_FIELD})*+$"
CLOSING_LINE = rf'^(?:[^"]++|"")*+"[^,]*+(?:,{_FIELD})*+$'

NUMBER = r"^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$"
ISO_DATE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
ISO_TIMESTAMP = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[T ].+)?$"

# The date and time layouts accepted besides ISO.
DATE_FORMATS = ("dd-MMM-yyyy", "MM/dd/yyyy")
TIMESTAMP_FORMATS = ("MM/dd/yyyy HH:mm:ss",)


def read_batch_csv(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    multiline: bool | None = True,
) -> DataFrame:
    """All-text rows of the files in ``schema`` order, with their position.

    Lines end with LF, CR LF or a lone CR, also mixed, and files are read in splits,
    whatever their size. Unless ``multiline`` is False, lines that a quoted line break
    has cut apart are put together again, joined by LF; files without such lines, by
    their content, need no more than the scan that tells. A quote that is never closed
    takes the rest of its file. Compressed files are recognised by extension.
    """
    if multiline is False:
        return with_position(_all_text(spark, paths, schema))
    whole = line_complete_files(spark, paths)
    rest = [p for p in paths if p not in set(whole)]
    frames = [with_position(_all_text(spark, whole, schema))] if whole else []
    frames += [_joined_lines(spark, rest, schema)] if rest else []
    return reduce(DataFrame.unionByName, frames)


def _all_text(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    return spark.read.schema(text).option("header", "true").option("escape", '"').csv(list(paths))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return with_position(spark.read.text(list(paths)))


def line_complete_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files without a record over several lines: no line of theirs leaves a quote open."""
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias(FILE))
    partial = F.col("value").contains('"') & ~F.col("value").rlike(COMPLETE_LINE)
    names = {unquote(r[FILE]) for r in lines.filter(partial).select(FILE).distinct().collect()}
    return [p for p in paths if not any(_same_file(p, n) for n in names)]


def _same_file(path: str, found: str) -> bool:
    """Whether a file is the given path or lies below it; the scheme may be left out."""
    path, found = (x.split(":", 1)[-1].lstrip("/") for x in (path, found))
    return found == path or found.startswith(path.rstrip("/") + "/")


def _state_before(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Adds ``_swaps`` and ``_state`` before each row; the state is NULL where it depends on the state before the first.

    A row sets the state to ``_sets`` (0 outside quotes, 1 inside), or turns it over
    (``_turns`` 1), or leaves it.
    """
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    swaps = rows.withColumn("_swaps", F.coalesce(F.sum("_turns").over(earlier), F.lit(0)))
    setter = F.when(F.col("_sets").isNotNull(), F.struct(F.col("_sets").alias("to"), F.col("_swaps").alias("at")))
    last = swaps.withColumn("_last", F.last(setter, ignorenulls=True).over(earlier))
    return last.withColumn("_state", (F.col("_last.to") + F.col("_swaps") - F.col("_last.at")) % 2).drop("_last")


def _joined_lines(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of files in which some line leaves a quote open."""
    data = _records(_line_starts(spark, paths))
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i, _ in enumerate(schema)])
    parsed = data.withColumn("_row", F.from_csv("value", text.simpleString()[7:-1].replace(":", " "), {"escape": '"'}))
    values = [F.col(f"_row.c{i}").alias(f.name) for i, f in enumerate(schema)]
    return parsed.select(*values, FILE, F.col(f"_at.{BLOCK}").alias(BLOCK), F.col(f"_at.{SEQ}").alias(SEQ))


def _line_starts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with ``_at``, the place of the line that their record begins with.

    What a line does to the open quote depends on the line alone, so the state before
    each line is a running composition: within each split, then over the splits of a
    file. A record begins at a line that finds no quote open.
    """
    work = new_work_dir(spark, "csv-lines")
    _lines(spark, paths).write.parquet(work)
    out, inside = F.col("value").rlike(COMPLETE_LINE), ~F.col("value").rlike(CLOSING_LINE)
    lines = spark.read.parquet(work).withColumns(
        {"_sets": F.when(out & ~inside, 0).when(~out & inside, 1), "_turns": F.when(~out & ~inside, 1).otherwise(0)}
    )
    block = [FILE, BLOCK]
    lines = _state_before(lines, block, SEQ)
    setter = F.when(F.col("_sets").isNotNull(), F.struct(SEQ, F.col("_sets").alias("to"), F.col("_swaps").alias("at")))
    blocks = lines.groupBy(*block).agg(F.max(setter).alias("_last"), F.sum("_turns").alias("_all"))
    turns = F.when(F.col("_last").isNull(), F.col("_all") % 2).otherwise(0)
    blocks = blocks.withColumns({"_sets": (F.col("_last.to") + F.col("_all") - F.col("_last.at")) % 2, "_turns": turns})
    begun = _state_before(blocks, [FILE], BLOCK)
    begun = begun.select(*block, F.coalesce("_state", F.col("_swaps") % 2).alias("_begun"))
    lines = lines.join(begun, block).withColumn("_open", F.coalesce("_state", (F.col("_begun") + F.col("_swaps")) % 2))
    starts = F.when(F.col("_open") == 0, F.struct(BLOCK, SEQ))
    so_far = Window.partitionBy(*block).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_record", F.last(starts, ignorenulls=True).over(so_far))
    last_starts = lines.groupBy(*block).agg(F.max(starts).alias("_record"))
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = last_starts.select(*block, F.last("_record", ignorenulls=True).over(earlier).alias("_carried"))
    return lines.join(carried, block).select(*block, SEQ, "value", F.coalesce("_record", "_carried").alias("_at"))


def _records(lines: DataFrame) -> DataFrame:
    """(file, _at, value) of records that aren't blank, without each file's first, the header."""
    parts = F.array_sort(F.collect_list(F.struct(BLOCK, SEQ, "value")))
    records = lines.groupBy(FILE, "_at").agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("value"))
    full = records.filter("trim(value) <> ''")
    headers = full.groupBy(FILE).agg(F.min("_at").alias("_header"))
    return full.join(headers, FILE).filter("_at <> _header").drop("_header")


def record_places(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, record, line, value): the data records of files as text, numbered from 0, with their first line's number from 1.

    Records and lines are counted by split, and moved by the counts of the splits before them.
    """
    whole = line_complete_files(spark, paths)
    rest = [p for p in paths if p not in set(whole)]
    frames = [_lines(spark, whole).withColumn("_at", F.struct(BLOCK, SEQ))] if whole else []
    frames += [_line_starts(spark, rest)] if rest else []
    lines = reduce(DataFrame.unionByName, frames)
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)

    def before(n: str) -> Column:
        return F.coalesce(F.sum(n).over(earlier), F.lit(0))

    blocks = lines.groupBy(FILE, BLOCK).agg(F.min(SEQ).alias("_first"), F.count(F.lit(1)).alias("_n"))
    blocks = blocks.select(FILE, BLOCK, (before("_n") - F.col("_first") + 1).alias("_moved"))
    records = _records(lines).select(FILE, F.col(f"_at.{BLOCK}").alias(BLOCK), F.col(f"_at.{SEQ}").alias(SEQ), "value")
    counts = records.groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("_n")).select(FILE, BLOCK, before("_n").alias("_before"))
    own = F.row_number().over(Window.partitionBy(FILE, BLOCK).orderBy(SEQ)) - 1
    numbered = records.withColumn("_own", own).join(counts, [FILE, BLOCK]).join(blocks, [FILE, BLOCK])
    return numbered.select(
        FILE, (F.col("_before") + F.col("_own")).alias("record"), (F.col(SEQ) + F.col("_moved")).alias("line"), "value"
    )


def fields_before(value: Column, index: Column) -> Column:
    """The part of a record's text before its field number ``index`` (from 0)."""
    skipped = F.concat(F.lit(f"(?s)^((?:{_FIELD},){{"), index.cast("string"), F.lit("})"))
    return F.call_function("regexp_extract", value, skipped, F.lit(1))


def with_position(raw: DataFrame) -> DataFrame:
    """Adds the file, the block within it, and the reading order within the block."""
    return raw.select(
        *raw.columns,
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(SEQ),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_tokens(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Trims the given columns and turns the null tokens into NULL."""
    chosen, listed = set(cols), ", ".join(_literal(t) for t in tokens)
    return df.selectExpr(
        *[
            f"case when trim({q}) not in ({listed}) then trim({q}) end as {q}" if c in chosen else q
            for c, q in ((c, _quoted(c)) for c in df.columns)
        ]
    )


def parse_sql(text: str, data_type: T.DataType) -> str:
    """SQL for the typed value of a text column, NULL where it does not parse."""
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.LongType):
        # "12.0" is a whole number; halves round away from zero
        return f"try_cast(round(try_cast({_only(text, NUMBER)} as decimal(38,10)), 0) as bigint)"
    if isinstance(data_type, T.DateType):
        other = ", ".join(f"try_to_date({text}, {_literal(f)})" for f in DATE_FORMATS)
        return f"coalesce(try_cast({_only(text, ISO_DATE)} as date), {other})"
    if isinstance(data_type, T.TimestampType):
        other = ", ".join(f"try_to_timestamp({text}, {_literal(f)})" for f in TIMESTAMP_FORMATS)
        return f"coalesce(try_cast({_only(text, ISO_TIMESTAMP)} as timestamp), {other})"
    if isinstance(data_type, T.NumericType):
        return f"try_cast({_only(text, NUMBER)} as {data_type.simpleString()})"
    return f"try_cast({text} as {data_type.simpleString()})"


def _only(text: str, pattern: str) -> str:
    """SQL for a text that fits a pattern, else NULL: casts alone take "12D" for a number and a bare year for a date."""
    return f"case when {text} rlike {_literal(pattern)} then {text} end"


def typed(df: DataFrame, schema: T.StructType, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Typed columns plus the first column that failed to parse and its text.

    Written as SQL text: files have up to a hundred columns, and one text per
    column is far cheaper to build than a tree of Column calls.
    """
    names = schema.fieldNames()
    others = [_quoted(c) for c in df.columns if c not in set(names)]
    clean = null_tokens(df, names, tokens)
    checked = [(_quoted(f.name), _quoted(f"_t_{f.name}"), f) for f in schema if not isinstance(f.dataType, T.StringType)]
    parsed = clean.selectExpr("*", *[f"{parse_sql(q, f.dataType)} as {t}" for q, t, f in checked])
    failed = [
        f"case when {q} is not null and {t} is null then named_struct('column', {_literal(f.name)}, 'value', {q}) end"
        for q, t, f in checked
    ]
    none = "cast(null as struct<column: string, value: string>)"
    located = parsed.selectExpr("*", f"coalesce({', '.join([*failed, none])}) as _bad")
    result = {f.name: f"{t} as {q}" for q, t, f in checked}
    return located.selectExpr(
        *[result.get(c, _quoted(c)) for c in names],
        *others,
        f"_bad.column as {BAD_COLUMN}",
        f"_bad.value as {BAD_VALUE}",
    )


def split_good_bad(df: DataFrame, schema: T.StructType, tokens: Sequence[str] = NULL_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Rows that parse, and rejected rows with their first error."""
    rows = typed(df, schema, tokens)
    good = rows.filter(F.col(BAD_COLUMN).isNull()).drop(*ERROR)
    return good, rows.filter(F.col(BAD_COLUMN).isNotNull())
