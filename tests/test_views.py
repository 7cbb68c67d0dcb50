import datetime as dt

from pyspark.sql import functions as F

from catalogflow import schemas
from catalogflow.operators import dedupe, rendering
from catalogflow.plans import daily, views
from catalogflow.sources import writers


def pages(spark, **html):
    return spark.createDataFrame(list(html.items()), "url string, html string")


def block(title, link, authors="Ann"):
    em = f"<em>{authors}</em>" if authors else ""
    return f'<div class="data"><strong>{title}</strong><a href="{link}">x</a><br>pp. 1-2<br>{em}</div>'


def article(abstract, author="Ann"):
    return f'<p><strong>Authors:</strong> <a>{author}</a><a>1</a></p><div id="Abst">{abstract}</div>'


def test_scraped_articles(spark, rows):
    head = '<p class="heading">Articles</p>'
    toc = pages(
        spark,
        i1=head + block("Deep Maps", "a1") + block("Deep Maps", "a1") + block("GIS Tips", "a2") + block("No authors", "a1", None),
        i2=head + block("Deep Maps", "a3") + block("Without page", "zz") + block("Hollow", "a4") + block("Good", "a3"),
        i3=head + block("Seen before", "a3"),
    )
    details = pages(spark, a1=article("First text"), a2=article("Tips"), a3=article("Other text"), a4=article("There is No Abstract"))
    seen = spark.createDataFrame([("i3",)], "key string")
    got = rows(views.scraped_articles(toc, details, seen), "Title", "Pages", "URL", "Abstract")
    assert got == [("Deep Maps", "pp. 1-2", "a1", "First text"), ("Good", "pp. 1-2", "a3", "Other text")]


def test_in_press_articles(spark):
    def item(title, link, date):
        return f'<li><p><a title="{title}" href="{link}">t</a><br>Appeared or available online: {date}</p></li>'

    listing = pages(spark, p=(
        '<ul id="fasttrackItems">' + item("Old and new urban maps", "/l1", "March 5, 2026") + item("Already issued title", "/l2", "May 1, 2026")
        + item("Already issued titel", "/l3", "May 1, 2026") + item("Fresh work", "/l4", "April 5, 2026") + item("Undated", "/l5", "soon") + "</ul>"
    ))
    details = pages(spark, **{"/l1": article("One", "Bob"), "/l4": article("No Abstract")})
    catalog = spark.createDataFrame([("Already issued title",), ("Another",)], "Title string")
    got = [(r.Title, r.Authors, r.Pages, r.Access, r.Abstract) for r in views.in_press_articles(listing, details, catalog).collect()]
    assert got == [("Old and new urban maps", "Bob", "March 5, 2026", "Unknown", "One"), ("Undated", None, "soon", "Unknown", None)]


def test_most_downloaded(spark, rows):
    data = [("2024-11", f"T{i}", f"d{i}", 100 - i) for i in range(10)]
    data += [("2024-10", "T3", "d3", 500), ("2024-11", "T0", "d0", 100), ("2024-12", "none", None, 90)]
    usage = spark.createDataFrame(data, "Month string, `Item Title` string, DOI string, `Total Downloads` string")
    details = spark.createDataFrame(
        [(f"d{i}", None if i == 1 else "Ann", "No Abstract" if i == 2 else "text") for i in range(9)], "DOI string, Authors string, Abstract string"
    )
    top = views.most_downloaded_view(usage, details, n=4).collect()
    assert [(r.DOI, r["Total Downloads"]) for r in top] == [("d3", 500), ("d0", 100), ("d4", 96), ("d5", 95)]


def test_recent_pools_to_documents(spark, tmp_path):
    data = [(f"A{i}", f"https://doi.org/10.1/{i}", f"2026{1 + i % 6:02d}", "Open Access content" if i % 3 else None, i) for i in range(30)]
    catalog = spark.createDataFrame(data, "Title string, URL string, IssueKey string, Access string, ingest_seq bigint")
    catalog = catalog.withColumns({c: F.lit("x") for c in ("Authors", "Pages", "Abstract")} | {"PubDate": F.lit(None).cast("string")})
    view = views.recent_view(catalog, dt.datetime(2026, 8, 15))
    assert {r.IssueKey for r in view.collect()} == {"202603", "202604", "202605", "202606"}
    pool = F.when(F.col("Access").eqNullSafe("Open Access content"), "open").otherwise("member")
    shown = view.withColumns({"pool": pool, "is_open": pool == "open", "age": -F.unix_date("IssueDate"), "info": F.concat("PubDate", F.lit(", "), "Pages")})
    html = rendering.article_fragment("Title", "URL", "Authors", "Abstract", "info", "is_open")
    writers.write_documents(shown.withColumn("html", html), "pool", ["age", "ingest_seq"], "html", str(tmp_path / "d"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "d" / "pool=open").glob("part-*")))
    assert text.count("<article") == 15 and text.index("June 2026") < text.index("March 2026")


def test_files_are_ingested_oldest_first(spark, rows):
    stamp = dt.datetime
    listing = spark.createDataFrame(
        [("b.xlsx", 9, stamp(2026, 4, 1)), ("a.xlsx", 9, stamp(2026, 4, 2)), ("done.xlsx", 5, stamp(2026, 3, 1))], schemas.MANIFEST
    )
    state = spark.createDataFrame([("done.xlsx", 5), ("a.xlsx", 4)], schemas.STATE)
    changes = views.changed_files(listing, state)
    assert [r.filename for r in changes.collect()] == ["b.xlsx", "a.xlsx"]

    def raw(file, seq, title, doi, month):
        return (title, "A", "Research Article", dt.date(2026, month, 1), str(month), "92", "1", "OA", doi, "x", None, seq, file)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.RAW_METADATA.fields) + ", ingest_seq bigint, file string"
    data = [
        raw("b.xlsx", 1, "One", "1", 4), raw("b.xlsx", 2, "Two", "2", 4), raw("b.xlsx", 3, "May", "3", 5),
        raw("a.xlsx", 1, "One revised", "1", 4), raw("a.xlsx", 2, "Two", "2", 4), raw("done.xlsx", 1, "No", "9", 6),
    ]
    log = spark.createDataFrame([("Old", "u", "202604", 1, "0"), ("Kept", "u", "202601", 2, "0")],
                                "Title string, URL string, IssueKey string, ingest_seq bigint, gen string")
    after = dedupe.catalog_from_batches(views.ingest_files(log, spark.createDataFrame(data, schema), changes))
    assert rows(after, "Title", "IssueKey") == [("Kept", "202601"), ("May", "202605"), ("One revised", "202604"), ("Two", "202604")]
    # the result can stand for its log
    assert rows(dedupe.catalog_from_batches(after), "Title") == rows(after, "Title")


def test_daily_runs(spark, rows, tmp_path):
    base, stamp = str(tmp_path / "base"), dt.datetime(2026, 4, 1)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.RAW_METADATA.fields) + ", ingest_seq bigint, file string"

    def row(file, seq, title, doi, month, image=None, kind="Research Article"):
        link = f"https://files.example/d/{image}/view" if image else None
        return (title, "A", kind, dt.date(2026, month, 1), str(month), "92", "1", "OA", doi, "x", link, seq, file)

    def run(name, sizes, data, images):
        listing = spark.createDataFrame([(f, n, stamp) for f, n in sizes.items()], schemas.MANIFEST)
        assets = spark.createDataFrame([(f"img/2026/{i}",) for i in images], "path string")
        choices = spark.createDataFrame([(" ONE ",)], "title string")
        return daily.daily_run(spark, base, name, listing, spark.createDataFrame(data, schema), assets, choices, "https://h")

    def result(out):
        counts = {r.IssueKey: (r.added, r.removed, r.current_keys) for r in out["changes"].collect()}
        waiting = out["in_press_changes"].collect()
        return rows(out["catalog"], "Title"), counts, [(r.added, r.removed, r.current_keys) for r in waiting], {
            r.IssueKey: r.html for r in out["pages"].collect()}

    a = [row("a", 1, "One", "1", 4, "p1"), row("a", 2, "Two", "2", 4), row("a", 3, "Soon", "3", 4, None, "In-Press")]
    b = [row("b", 1, "May", "5", 5), row("b", 2, None, "6", 5)]
    for _ in range(2):  # a run that is repeated after a crash replaces itself
        first = result(run("r1", {"a": 1, "b": 2, "c": 3}, a + b, ["04/p1.png"]))
    assert first[:3] == ([("One",), ("Two",)], {"202604": (2, 0, 2)}, [(1, 0, 1)])
    assert "Editor" in first[3]["202604"] and '<img src="img/2026/04/p1.png">' in first[3]["202604"] and len(first[3]) == 1
    got = {r.filename: r.reason for r in daily.outcomes(spark, base).collect()}
    assert got == {"a": None, "b": "rows without title or issue", "c": "no rows"}
    assert rows(daily.state(spark, base)) == [("a", 1)]
    # b is mended, a came again without an article and with a missing image
    a = [row("a", 1, "One", "1", 4, "p9"), row("a", 4, "Later", "4", 4, None, "In-Press")]
    second = result(run("r2", {"a": 7, "b": 2, "c": 3}, a + [row("b", 1, "May", "5", 5)], ["04/p1.png"]))
    assert second[:2] == ([("May",), ("One",), ("Two",)], {"202605": (1, 0, 1)})
    assert rows(daily.state(spark, base)) == [("a", 1), ("b", 2)]
    third = result(run("r3", {"a": 7, "b": 2, "c": 3}, a, ["04/p9.png"]))
    assert third[:3] == ([("May",), ("One",)], {"202604": (0, 1, 1)}, [(1, 0, 1)])
    reasons = {(r.run, r.filename): (r.change, r.reason) for r in daily.outcomes(spark, base).collect()}
    assert reasons["r2", "a"] == ("changed", "1 images missing") and reasons["r3", "a"] == ("changed", None)
    assert ("r3", "b") not in reasons
    seen = spark.read.parquet(f"{base}/seen/run=r3")
    assert rows(seen, "key") == [("202604",), ("202605",)]


def test_declared_schemas_are_complete():
    assert len(schemas.USAGE) == 27 and schemas.USAGE["Total Downloads"].dataType.simpleString() == "bigint"
    assert schemas.CATALOG.fieldNames()[-1] == "ingest_seq" and len(schemas.RAW_METADATA) == 11
