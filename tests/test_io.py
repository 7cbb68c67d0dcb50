import csv
import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from catalogflow import schemas
from catalogflow.operators import dedupe
from catalogflow.operators.ordered import running_index
from catalogflow.sources import readers, workbook, writers
from catalogflow.streaming import ingest


def test_catalog_csv_round_trip(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(["URL", "Title", "IssueKey", "ingest_seq", "extra"])
        out.writerow(["u1", 'A "quoted" title', "202604.0", "1", "z"])
        out.writerow(["u2", "two\nlines, comma", "", "x", "z"])
    df = readers.read_catalog_csv(spark, str(path))
    assert df.schema.fieldNames() == schemas.CATALOG.fieldNames()
    assert rows(df, "Title", "URL", "IssueKey", "ingest_seq") == [
        ('A "quoted" title', "u1", "202604.0", 1), ("two\nlines, comma", "u2", None, None)
    ]
    writers.overwrite_csv(df, str(tmp_path / "out"), ["Title", "URL"], quote_all=True)
    again = readers.read_catalog_csv(spark, str(tmp_path / "out"))
    assert rows(again, "Title", "URL") == rows(df, "Title", "URL")
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert text.startswith('"Title","URL"')


def test_read_many_optional(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("Title,Access Status\nA,OA\n")
    (tmp_path / "b.csv").write_text("Title\nB\n")
    (tmp_path / "c.csv").write_text("Title,Access Status\nC,SUB\n")
    (tmp_path / "d.csv").write_text("Access Status,DOI,Title\nOA,10.1/d,D\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv", "gone.csv", "c.csv", "d.csv")]
    df = readers.read_many_optional(spark, paths, ["Title", "Access Status"], schemas.RAW_METADATA)
    assert rows(df, "Title", "`Access Status`", "DOI") == [("A", "OA", None), ("C", "SUB", None), ("D", "OA", "10.1/d")]
    assert readers.read_many_optional(spark, paths[2:3], ["Title"], schemas.RAW_METADATA).count() == 0


def test_headers_of_many_files_in_one_job(spark, tmp_path, rows):
    layouts = ["Title,DOI", "DOI,Title", "Title", "\ufeffTitle,DOI", '"Title","a ""b"", c",DOI', '"two\nlines",Title,DOI', ""]
    for i in range(300):
        header = layouts[i % len(layouts)]
        cells = {"Title": f"T{i}", "DOI": f"10.1/{i}"}
        (tmp_path / f"f{i}.csv").write_text(header + "\n" + ",".join(
            cells.get(c.strip('"\ufeff'), "x") for c in ([*(header.split(",")[:1]), "x", "DOI"] if "a " in header else header.split(","))) + "\n")
    (tmp_path / "notes.txt").write_text("Title,DOI\n")
    paths = [str(tmp_path / f"f{i}.csv") for i in range(310)] + [str(tmp_path / "nowhere" / "f1.csv")]
    seen = []
    real = readers.read_catalog_csv
    readers.read_catalog_csv = lambda s, p, k: (seen.append(p), real(s, p, k))[1]
    try:
        df = readers.read_many_optional(spark, paths, ["Title", "DOI"], schemas.RAW_METADATA)
    finally:
        readers.read_catalog_csv = real
    assert len(seen) == 4  # one read per layout
    want = sorted((f"T{i}", f"10.1/{i}") for i in range(300) if i % 7 in (0, 1, 3, 4, 5))
    assert sorted((r.Title, r.DOI) for r in df.collect()) == want


def test_lines_are_numbered_across_splits(spark, tmp_path, rows):
    files = {"a.log": [f"line {i} " + "x" * (i % 90) for i in range(2000)], "b.log": ["one", "", "three\r", ""], "c.log": ["only"]}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + ("\n" if name != "c.log" else ""))
    (tmp_path / "empty.log").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = readers.read_numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        got = rows(df.withColumn("file", F.regexp_extract("file", "[^/]+$", 0)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [(name, i, line) for name, lines in files.items() for i, line in enumerate(lines)]
    assert got == sorted(want, key=repr)


def test_listing_and_state(spark, tmp_path, rows):
    listing = ["2026-03-21 00:21:45      17998 26-04_April_metadata.xlsx", "2026-03-21 00:21:45  5 notes.txt", "PRE  x/", ""]
    df = spark.createDataFrame([(x,) for x in listing], "value string")
    assert rows(readers.parse_listing(df)) == [("26-04_April_metadata.xlsx", 17998, dt.datetime(2026, 3, 21, 0, 21, 45))]
    (tmp_path / "state.log").write_text("# head\n\na.xlsx 10 # Processed at t\nb.xlsx # old\nsingle\na.xlsx 20 # later\nc.xlsx 3\nc.xlsx # old\n")
    assert rows(readers.read_state_log(spark, str(tmp_path / "state.log"))) == [("a.xlsx", 20), ("b.xlsx", None), ("c.xlsx", None)]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "m.xlsx").write_bytes(b"123")
    (tmp_path / "d" / "n.txt").write_bytes(b"1")
    assert rows(readers.list_objects(spark, str(tmp_path / "d")), "filename", "size_bytes") == [("m.xlsx", 3)]


def test_keys_and_pages(spark, tmp_path, rows):
    (tmp_path / "seen.log").write_text("202601\n202601\n202601202602\n")
    assert rows(readers.read_seen_keys(spark, str(tmp_path / "seen.log"))) == [("202601",), ("202601202602",)]
    paths = spark.createDataFrame([("x/html/202604.html",), ("202512.html",), ("x/2026041.html",), ("x/ab.html",)], "path string")
    assert rows(readers.scan_issue_keys(paths)) == [("202512", 2025, 12), ("202604", 2026, 4)]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "1.html").write_text("<p>\na</p>")
    assert rows(readers.read_pages(spark, str(tmp_path / "p"), "html"), "html") == [("<p>\na</p>",)]


def make_workbook(path, header, body):
    def cell(ref, value):
        if isinstance(value, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'
        return f'<c r="{ref}"><v>{value}</v></c>' if value is not None else ""

    table = [header, *body]
    sheet = "".join(
        f'<row r="{i}">' + "".join(cell(f"{chr(65 + j)}{i}", v) for j, v in enumerate(r)) + "</row>" for i, r in enumerate(table, 1)
    )
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        book.writestr(workbook.SHEET, f'<worksheet xmlns="{workbook.NS[1:-1]}"><sheetData>{sheet}</sheetData></worksheet>')
    path.write_bytes(buffer.getvalue())


def test_workbooks(spark, tmp_path):
    make_workbook(tmp_path / "m.xlsx", ["Title", "Date MMDDYY", "Volume", "Authors"], [["Deep", 46113, 92, None], ["Soon", "2026-03-05", 92, "Ann"]])
    (tmp_path / "bad.xlsx").write_bytes(b"not a workbook")
    make_workbook(tmp_path / "other.xlsx", ["Name"], [["x"]])
    got = workbook.read_workbooks(spark, str(tmp_path)).orderBy("row_no").collect()
    assert [(r.file, r.Title, r["Date MMDDYY"], r.Volume, r.Authors) for r in got] == [
        ("m.xlsx", "Deep", dt.date(2026, 4, 1), "92", None), ("m.xlsx", "Soon", dt.date(2026, 3, 5), "92", "Ann")
    ]


def test_partition_overwrite_keeps_other_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string").write.partitionBy("k").parquet(path)
    changed = spark.read.parquet(path).filter("k = 'b'").withColumn("v", F.col("v") + 10).select("v", "k")
    writers.overwrite_partitions(spark, changed, path, "k")
    assert rows(spark.read.parquet(path), "v", "k") == [(1, "a"), (12, "b")]
    current = spark.read.parquet(path)
    saved = writers.write_snapshot(current, str(tmp_path / "snap"), "20260101")
    assert spark.read.parquet(saved).count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_snapshot(current, str(tmp_path / "snap"), "20260101")


def test_documents_are_ordered_and_complete(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k"), "id", F.col("id").cast("string").alias("f"))
    writers.write_documents(df.repartition(5), "k", "id", "f", str(tmp_path / "docs"), files=4)
    files = sorted((tmp_path / "docs" / "k=hot").glob("part-*"))
    assert len(files) > 1  # the hot group is spread over tasks
    assert [int(x) for f in files for x in f.read_text().split()] == list(range(900))


def batches(spark, folder, data, schema):
    for i, rows_ in enumerate(data):
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(f"{folder}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


SCHEMA = "Title string, URL string, IssueKey string, ingest_seq bigint"


def test_stream_upsert_equals_batch_upserts(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    stream = batches(spark, source, [[("A", "u", "202601", 1), ("B", "u", "202602", 2)], [("C", "u", "202602", 3)]], SCHEMA)
    log = ingest.stream_upsert(stream, str(tmp_path / "cat"), str(tmp_path / "cp"))
    assert rows(ingest.upserted(spark, log, SCHEMA), "Title") == [("A",), ("C",)]
    spark.createDataFrame([("A", "u", "202603", 4)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    log = ingest.stream_upsert(stream, str(tmp_path / "cat"), str(tmp_path / "cp"))
    assert rows(ingest.upserted(spark, log, SCHEMA), "Title", "IssueKey") == [("A", "202603"), ("C", "202602")]


def test_stream_sees_a_reupload_under_the_same_name(spark, tmp_path, rows):
    schema = "filename string, size_bytes bigint, ts timestamp"
    day = dt.datetime(2026, 3, 1)
    stream = batches(spark, str(tmp_path / "m"), [[("a.xlsx", 10, day), ("b.xlsx", 5, day)], [("a.xlsx", 12, day + dt.timedelta(1))]], schema)
    base = ingest.stream_reuploads(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(ingest.processed_sizes(spark, base)) == [("a.xlsx", 12), ("b.xlsx", 5)]
    changes = spark.read.parquet(str(tmp_path / "out" / "changes"))
    assert rows(changes, "filename", "change") == [("a.xlsx", "changed"), ("a.xlsx", "new"), ("b.xlsx", "new")]


def test_a_failed_file_stays_due(spark, tmp_path, rows):
    day = dt.datetime(2026, 3, 1)
    data = [[("a.xlsx", 10, day), ("b.xlsx", 5, day)], [("a.xlsx", 12, day + dt.timedelta(1))], [("c.xlsx", 1, day)], [("c.xlsx", 1, day)]]
    stream = batches(spark, str(tmp_path / "m"), data, ingest.MANIFEST)

    def process(changes, batch_id):
        return changes.filter("filename <> 'b.xlsx'" if batch_id == 0 else "false" if batch_id == 1 else "true")

    base = ingest.stream_reuploads(stream, str(tmp_path / "out"), str(tmp_path / "cp"), process)
    got = rows(ingest.detected_changes(spark, base), "gen", "filename", "change", "old_size", "done")
    assert got == [
        (0, "a.xlsx", "new", None, True), (0, "b.xlsx", "new", None, False), (1, "a.xlsx", "changed", 10, False),
        (1, "b.xlsx", "new", None, False), (2, "a.xlsx", "changed", 10, True), (2, "b.xlsx", "new", None, True), (2, "c.xlsx", "new", None, True),
    ]
    assert rows(ingest.processed_sizes(spark, base)) == [("a.xlsx", 12), ("b.xlsx", 5), ("c.xlsx", 1)]


def test_folding_changes_nothing(spark, tmp_path, rows):
    data = [[("A", "u", "202601", 1), ("B", "u", "202602", 2)], [("C", "u", "202602", 3), ("A", "u", "202603", 4)], [("D", "v", "202603", 5)]]
    results = []
    for when in ((), (0,), (0, 1), (0, 1, 2)):
        base = str(tmp_path / f"c{len(when)}")
        for i in range(3):
            spark.createDataFrame(data[i], SCHEMA).write.parquet(f"{base}/in/{i}")
            ingest.stream_upsert(spark.readStream.schema(SCHEMA).parquet(f"{base}/in/*"), base, f"{base}/cp")
            if i in when:
                assert ingest.fold(spark, base, SCHEMA) == f"{i:010d}" == ingest.folded_upto(spark, base)
        results.append(rows(ingest.upserted(spark, base, SCHEMA)))
    assert results == [[("C", "u", "202602", 3), ("D", "v", "202603", 5)]] * 4
    # a fold without its mark does not exist; covered generations are not read
    spark.createDataFrame([("Z", "z", "202699", 9, "x")], SCHEMA + ", gen string").write.parquet(f"{base}/folded/upto=0000000009")
    assert rows(ingest.upserted(spark, base, SCHEMA)) == results[0]
    plan = ingest.logged(spark, base, SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(gen" in plan and "> 0000000002" in plan


def test_state_is_bounded_by_the_delay(spark, tmp_path, rows):
    schema = "url string, day timestamp"
    first = dt.datetime(2026, 1, 1)
    data = [[(f"u{i % 3}" if k else f"d{d}n{i}", first + dt.timedelta(d)) for i in range(20) for k in (0, 1)] for d in range(12)]
    stream = batches(spark, str(tmp_path / "in"), data, schema)
    seen = []
    run = ingest._run

    def watched(writer, checkpoint):
        query = run(writer, checkpoint)
        seen.extend(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators)

    ingest._run = watched
    try:
        out = ingest.stream_distinct(stream, ["url"], str(tmp_path / "o"), str(tmp_path / "cp"), "day", "2 days")
    finally:
        ingest._run = run
    got = [r.url for r in spark.read.parquet(out).collect()]
    assert len([u for u in got if u.startswith("d")]) == 240 and 3 <= len([u for u in got if u.startswith("u")]) < 36
    assert len(seen) >= 12 and max(seen) <= 110  # 240 keys came


def test_only_touched_buckets_are_read(spark, tmp_path, rows):
    path = str(tmp_path / "seen")
    ingest.write_seen(spark.range(500).select(F.concat(F.lit("k"), "id").alias("key")), path, 0)
    bucket = spark.range(1).select(ingest.seen_bucket(F.lit("k7"))).first()[0]
    one = ingest.seen_keys(spark, path, "string", 5, [bucket])
    assert ("k7",) in rows(one, "key") and one.count() < 30
    assert "PartitionFilters: [isnotnull(gen" in one._jdf.queryExecution().executedPlan().toString()
    assert ingest.seen_keys(spark, path, "string", 0).count() == 0


def test_one_kind_of_generation(spark, tmp_path, rows):
    """Batches of a stream and of files lie in one log."""
    spark.createDataFrame([("A", "u", "202601", 1)], SCHEMA).write.parquet(str(tmp_path / "in"))
    ingest.stream_upsert(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), str(tmp_path / "c"), str(tmp_path / "cp"))
    files = spark.createDataFrame([("B", "u", "202601", 2, "20260301000000 b.xlsx")], SCHEMA + ", gen string")
    both = ingest.logged(spark, str(tmp_path / "c"), SCHEMA).unionByName(files)
    assert rows(dedupe.catalog_from_batches(both), "Title") == [("B",)]


def test_stream_dedupe_and_skip_seen(spark, tmp_path, rows):
    schema = "url string, n int"
    stream = batches(spark, str(tmp_path / "in"), [[("a", 1), ("b", 1)], [("a", 2), ("c", 2)]], schema)
    out = ingest.stream_distinct(stream.select("url"), ["url"], str(tmp_path / "o1"), str(tmp_path / "c1"))
    assert rows(spark.read.parquet(out), "url") == [("a",), ("b",), ("c",)]
    fresh = ingest.stream_skip_seen(stream, "url", str(tmp_path / "seen"), str(tmp_path / "o2"), str(tmp_path / "c2"))
    got = rows(spark.read.schema(schema).parquet(f"{fresh}/*"), "url")
    assert got == [("a",), ("b",), ("c",)]


def test_markers(spark, tmp_path, rows):
    df = spark.createDataFrame([("a.xlsx", 3)], "filename string, size_bytes bigint")
    writers.append_marker(df, str(tmp_path / "m"), "2026-03-01 00:00:00")
    writers.append_marker(df, str(tmp_path / "m"), "2026-03-02 00:00:00")
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2
    writers.append_keys(spark.createDataFrame([("k",)], "key string"), str(tmp_path / "k"))
    writers.append_rows(df, str(tmp_path / "r"))
    assert rows(spark.read.parquet(str(tmp_path / "k"))) == [("k",)]


def test_positions_do_not_depend_on_partitioning(spark, rows):
    df = spark.range(200).select("id", F.lit("g").alias("k"))
    one = rows(running_index(df.repartition(9), ["k"], "id", "n", span=16), "id", "n")
    assert one == [(i, i + 1) for i in range(200)] or sorted(one) == [(i, i + 1) for i in range(200)]
