import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from ledgermart.operators.ledger import load_stats, located_errors
from ledgermart.sources import adhoc, csv, files

SCHEMA = (
    T.StructType().add("id", "string").add("n", "long").add("x", "double")
    .add("d", "date").add("t", "timestamp").add("note", "string")
)
HEADER = "ID,some other name,X,D,T,NOTE\n"


def write(tmp_path, name, body):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body)
    return str(path)


def test_tolerant_read(spark, tmp_path):
    path = write(
        tmp_path, "a.csv",
        HEADER
        + '1,12.0,1.5,2025-01-31,2025-01-31 10:00:00,"quoted, comma"\n'
        + '2, 13 ,NULL,null,, padded \n'
        + '3,bad,1,2025-01-01,2025-01-01,"line\nbreak"\n'
        + '4,5\n'  # short
        + '5,6,7,31-Jan-2025,01/31/2025 09:30:00,"say ""hi""",surplus\n'  # long
        + '6,7,8,2025-02-30,,N/A\n'
        + '7,2.5,-1e2,,,Null\n',
    )
    good, bad = csv.split_good_bad(csv.read_batch_csv(spark, [path], SCHEMA), SCHEMA)
    got = {r["id"]: r for r in good.collect()}
    assert sorted(got) == ["1", "2", "4", "5", "7"]
    assert got["1"]["n"] == 12 and got["1"]["note"] == "quoted, comma"
    assert got["1"]["d"] == dt.date(2025, 1, 31)
    assert got["2"]["n"] == 13 and got["2"]["x"] is None and got["2"]["d"] is None and got["2"]["note"] == "padded"
    assert got["4"]["x"] is None and got["4"]["note"] is None
    assert got["5"]["d"] == dt.date(2025, 1, 31) and got["5"]["note"] == 'say "hi"'
    assert got["5"]["t"] == dt.datetime(2025, 1, 31, 9, 30)
    assert got["7"]["n"] == 3 and got["7"]["x"] == -100.0 and got["7"]["note"] is None
    rejects = {r["id"]: (r[csv.BAD_COLUMN], r[csv.BAD_VALUE]) for r in bad.collect()}
    assert rejects == {"3": ("n", "bad"), "6": ("d", "2025-02-30")}
    assert bad.filter("id = '3'").first()["note"] == "line\nbreak"


def test_compressed_and_several_files(spark, tmp_path):
    one = write(tmp_path, "one.csv", HEADER + "1,1,,,,a\n")
    two = str(tmp_path / "two.csv.gz")
    with gzip.open(two, "wt") as out:
        out.write(HEADER + "2,2,,,,b\n")
    got = csv.read_batch_csv(spark, [one, two], SCHEMA, multiline=False)
    assert sorted(r["id"] for r in got.collect()) == ["1", "2"]
    assert got.select(csv.FILE).distinct().count() == 2


def test_routes_and_batches(spark):
    paths = [
        "s3://b/raw/certificates/display/display_certificates_2025-08.csv",
        "s3://b/raw/certificates/non_domestic/non_domestic_certificates_2025-08.csv",
        "s3://b/raw/recommendations/domestic/domestic_recommendations_2025-07.csv",
        "s3://b/raw/other/domestic/x_2025-13.csv",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "filepath string")
    got = files.route_paths(df).select("target_table", "month_tag")
    assert rows(got) == sorted(
        [
            ("raw_display_certificates", "2025-08"),
            ("raw_non_domestic_certificates", "2025-08"),
            ("raw_domestic_recommendations", "2025-07"),
            (None, None),
        ],
        key=repr,
    )
    assert files.select_batch(df, "2025-08").count() == 2
    listed = spark.createDataFrame([(f" {paths[2]} ",)], "filepath string")
    assert rows(files.select_batch(df, "2025-08", listed)) == [(paths[2],)]
    with pytest.raises(ValueError):
        files.select_batch(df, "2025-8x")


def test_previous_month(spark):
    cases = {dt.datetime(2025, 1, 15): "2024-12", dt.datetime(2025, 3, 31): "2025-02"}
    for today, tag in cases.items():
        assert spark.range(1).select(files.previous_month_tag(today)).first()[0] == tag


def test_completeness(spark):
    expected = spark.createDataFrame([("display",), ("domestic",), ("non_domestic",)], "domain string")
    have = expected.filter("domain <> 'domestic'")
    with pytest.raises(files.IncompleteBatch, match="domestic"):
        files.assert_complete(have, expected, ["domain"])
    files.assert_complete(expected, expected, ["domain"])


def test_adhoc_reads(spark, tmp_path):
    c = write(tmp_path, "x.csv", "a,b\n1,hello\n")
    j = write(tmp_path, "x.json", '{"a": 1, "b": "hello"}\n')
    assert rows(adhoc.read_any(spark, c)) == [(1, "hello")]
    assert rows(adhoc.read_any(spark, j, "a bigint, b string")) == [(1, "hello")]
    with pytest.raises(adhoc.UnsupportedFile):
        adhoc.read_any(spark, "x.xml")
    page = write(tmp_path, "page.json", '{\n "total": 2,\n "rows": [{"k": "1"}, {"k": "2"}]\n}')
    assert rows(adhoc.read_api_dump(spark, page, multiline=True)) == [("1",), ("2",)]
    typed = T.StructType.fromDDL("k string, missing string")
    assert adhoc.read_api_dump(spark, page, typed, multiline=True).columns == ["k", "missing"]
    assert rows(adhoc.read_api_dump(spark, c, "a string, b string")) == [("1", "hello")]


def test_listing_does_not_read_contents(spark, tmp_path):
    write(tmp_path, "raw/a/one.csv", "abc")
    write(tmp_path, "raw/b/two.csv", "abcdef")
    got = files.list_files(spark, str(tmp_path / "raw"))
    assert sorted(r["file_size"] for r in got.collect()) == [3, 6]
    assert "content" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.filter(F.col("filepath").startswith("file:")).count() == 2


def test_files_are_split_where_every_line_is_complete(spark, tmp_path):
    plain = write(tmp_path, "plain.csv", HEADER + '1,1,,,,"a ""b"", c"\n2,2,,,,\n')
    broken = write(tmp_path, "broken.csv", HEADER + '3,3,,,,"line\nbreak"\n4,4,,,,x\n')
    stray = write(tmp_path, "stray.csv", HEADER + '5,5,,,,5" pipe\n6,6,,,,x\n')
    # the quote of the first field is text; that of the second one opens it
    even = write(tmp_path, "even.csv", HEADER + '7,7,,,5" a,"open\n6" rest"\n')
    paths = [f"file:{p}" for p in (plain, broken, stray, even)]
    assert csv.line_complete_files(spark, paths) == [paths[0], paths[2]]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        auto = csv.read_batch_csv(spark, paths[:3], SCHEMA, multiline=None)
        whole = csv.read_batch_csv(spark, paths[:3], SCHEMA, multiline=True)
        names = SCHEMA.fieldNames()
        assert rows(auto.select(*names)) == rows(whole.select(*names))
        assert auto.filter(F.col(csv.FILE).endswith("plain.csv")).select(csv.BLOCK).distinct().count() > 1
        assert auto.filter(F.col(csv.FILE).endswith("broken.csv")).select("note").first()[0] == "line\nbreak"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_first_error_line_across_splits(spark, tmp_path):
    body = "".join(f"{i},{'bad' if i in (37, 80) else i},,,,note {i}\n" for i in range(100))
    path = write(tmp_path, "long.csv", HEADER + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = csv.read_batch_csv(spark, [f"file:{path}"], SCHEMA, multiline=None)
        assert read.select(csv.BLOCK).distinct().count() > 5
        stats = load_stats(csv.typed(read, SCHEMA)).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert (stats["rows_parsed"], stats["errors_seen"], stats["first_error_line"]) == (100, 2, 39)
    assert stats["first_error_column_name"] == "n" and stats["status"] == "PARTIALLY_LOADED"


def plain_place(text):
    """Line and character of the first value that isn't a whole number in column two, by walking the text."""
    line, at, field, quoted, start, value, seen = 1, 0, 0, False, None, "", False
    begun = False
    i = 0
    place = (1, 1)
    record_line = 1
    while i <= len(text):
        c = text[i] if i < len(text) else "\n"
        end = "\r\n" if text[i : i + 2] == "\r\n" else c
        if c in "\r\n" and not quoted:
            if field == 1 and seen and value and not value.isdigit():
                return place
            begun_row = begun
            seen = seen or begun_row
            line, at, field, value, begun, i = line + 1, 0, 0, "", False, i + len(end)
            place = (line, 1)
            continue
        if c in "\r\n":
            line, at, i, value = line + 1, 0, i + len(end), value + "\n"
            continue
        begun, at = True, at + 1
        if c == '"' and (quoted or not value):
            quoted = not quoted
        elif c == "," and not quoted:
            if field == 1 and seen and value and not value.isdigit():
                return place
            field, value, place = field + 1, "", (line, at + 1)
            i += 1
            continue
        value += c if c != '"' else ""
        i += 1
    return None


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("breaks", [True, False])
def test_first_error_place_at_every_split_size(spark, tmp_path, end, breaks):
    """Blank lines, quoted line breaks before, in and after the bad record, and the field behind text of several bytes."""
    id_ = '"é\n2\n日"' if breaks else '"é,""2"""'
    lines = ["id,n,x,d,t,note", "1,1,,,,a", "", '2,2,,,,"b\nc"' if breaks else "2,2,,,,b", "3,3", "   ", f'{id_},bad,,,,"z\nz"' if breaks else f"{id_},bad", "4,worse"]
    texts = {"some": end.join(lines), "none": end.join(lines[:5]), "first": end.join([lines[0], "x,  oh no ,"]), "long": end.join([*lines[:4] * 8, *lines[6:]])}
    texts["long"] = texts["long"].replace("id,n,x,d,t,note", "9,9,,,,h").replace("9,9,,,,h", "id,n,x,d,t,note", 1)
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    found = []
    for split in ("40", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            read = csv.read_batch_csv(spark, [f"file:{tmp_path}/{n}.csv" for n in texts], SCHEMA, multiline=None)
            stats = located_errors(load_stats(csv.typed(read, SCHEMA)), SCHEMA.fieldNames()).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        found.append({r[csv.FILE].rsplit("/", 1)[1][:-4]: (r["first_error_line"], r["first_error_character"]) for r in stats})
    expected = {n: plain_place(t) or (None, None) for n, t in texts.items()}
    assert expected["none"] == (None, None) and expected["first"] == (2, 3) and (expected["some"] == (10, 4)) == breaks
    assert found[0] == found[1] == expected


def as_records(text):
    """Rows of a file, read by Python's reader, which takes all line ends alike."""
    import csv as plain
    import io

    return [r + [None] * (6 - len(r)) for r in plain.reader(io.StringIO(text, newline="")) if r][1:]


def test_one_result_at_every_split_size(spark, tmp_path):
    """Quoted line breaks, CR LF, lone CR and mixed ends, in splits of a few bytes and in one."""
    import random

    rng = random.Random(3)
    bodies = {}
    for name, ends in (("lf", ["\n"]), ("crlf", ["\r\n"]), ("cr", ["\r"]), ("mixed", ["\n", "\r\n", "\r"])):
        fields = ["plain", '5" pipe', '"a ""quoted"" word"', '"two\nlines"', '"three\n\n, lines"', "", '"x,""\ny"']
        lines = [",".join([str(i), "1", "", "", "", rng.choice(fields)]) for i in range(25)]
        bodies[name] = HEADER.strip() + rng.choice(ends) + "".join(line + rng.choice(ends) for line in lines)
        (tmp_path / f"{name}.csv").write_bytes(bodies[name].encode())
    want = sorted(((r[0], r[5] or None) for text in bodies.values() for r in as_records(text)), key=repr)
    found = []
    for split in ("40", "150", "1000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            read = csv.read_batch_csv(spark, [f"file:{tmp_path}/{n}.csv" for n in bodies], SCHEMA, multiline=None)
            found.append(sorted(((r["id"], r["note"] or None) for r in read.select("id", "note").collect()), key=repr))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] == found[2] == want


def test_open_quote_takes_the_rest_of_its_file(spark, tmp_path):
    path = write(tmp_path, "open.csv", HEADER + '1,1,,,,"never closed\n2,2,,,,b\n')
    got = csv.read_batch_csv(spark, [path], SCHEMA).collect()
    assert [r["id"] for r in got] == ["1"]


def test_letters_and_bare_years_are_bad_values(spark, tmp_path):
    body = "1,,12D,,,\n2,,5f,,,\n3,,,2025,,\n4,,,2025-01,,\n5,,,,2025,\n6,7,1.5e3,2025-1-2,2025-01-02T03:04:05,\n7,0x1F,,,,\n8,,NaN,,,\n"
    path = write(tmp_path, "values.csv", HEADER + body)
    good, bad = csv.split_good_bad(csv.read_batch_csv(spark, [path], SCHEMA), SCHEMA)
    assert [r["id"] for r in good.collect()] == ["6"]
    assert sorted((r["id"], r[csv.BAD_COLUMN]) for r in bad.collect()) == [
        ("1", "x"), ("2", "x"), ("3", "d"), ("4", "d"), ("5", "t"), ("7", "n"), ("8", "x")
    ]
