import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from catalogflow import schemas
from catalogflow.functions import dates as D
from catalogflow.operators import audit, dedupe, filters, generators, incremental, joins, ordered, ranking, rendering
from catalogflow.plans import views


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_classify(column):
    given = ["Research Article", "In-Press", "InPress", "in press research", "Book Review", None]
    assert column(given, filters.classify) == ["research", "in_press", "in_press", "in_press", "other", "other"]
    assert column(given, lambda c: filters.classify(c, "not_research")) == [
        "research", "in_press", "in_press", "research", "in_press", "in_press"
    ]


def test_missing_and_abstract_filters(spark, rows):
    df = frame(spark, [(1, "a"), (2, None), (3, "N/A"), (4, "No Abstract"), (5, "has no abstract here")], "i int, x string")
    assert rows(filters.drop_missing(df, ["x"]), "i") == [(1,), (4,), (5,)]
    assert rows(filters.drop_no_abstract(df, "x"), "i") == [(1,), (2,), (3,), (5,)]
    assert rows(filters.drop_no_abstract(df, "x", "contains"), "i") == [(1,), (2,), (3,)]
    titles = frame(spark, [("Mapping Matters today",), ("GIS TIPS",), ("Maps",), (None,)], "t string")
    assert titles.transform(filters.drop_column_titles, "t").count() == 2


def test_windows_of_time(spark, rows):
    as_of = dt.datetime(2026, 8, 31, 12)
    df = frame(spark, [(1, dt.date(2026, 3, 1)), (2, dt.date(2026, 2, 1)), (3, None), (4, dt.date(2026, 2, 28))], "i int, d date")
    # the cutoff is February 28, noon: the day itself starts before it
    assert rows(filters.recent(df, "d", as_of), "i") == [(1,)]
    assert rows(filters.recent_days(df, "d", as_of, None), "i") == [(1,), (2,), (4,)]
    full = df.select("i", filters.is_full_access("d", dt.datetime(2027, 3, 1)).alias("f"))
    assert rows(full) == [(1, True), (2, True), (3, None), (4, True)]


def test_access(spark, rows):
    df = frame(spark, [(1, "Open Access content"), (2, " oa "), (3, "Subscribed content"), (4, None)], "i int, a string")
    assert rows(df.select("i", filters.says_open("a"))) == [(1, True), (2, True), (3, False), (4, False)]
    open_rows, member_rows = filters.split_access(df, "a")
    assert rows(open_rows, "i") == [(1,)] and rows(member_rows, "i") == [(2,), (3,), (4,)]
    meta = frame(spark, [("My  Title", "OA"), ("my title", "SUB"), ("Other", "SUB"), (None, "OA")], "Title string, `Access Status` string")
    cat = frame(spark, [(1, "my title", None), (2, "Other", None), (3, None, "OA")], "i int, Title string, Access string")
    out = joins.apply_overrides(cat, joins.access_overrides(meta), "Title", "Access")
    assert rows(out, "i", "is_open") == [(1, True), (2, False), (3, True)]


def test_attach_metric_prefers_doi(spark, rows):
    cat = frame(spark, [(1, "d1", "t1"), (2, None, "t2"), (3, "dx", "t1"), (4, None, None), (5, None, None)], "i int, doi string, title string")
    metric = frame(spark, [("d1", "t1", 5), ("d2", "t2", 7), (None, "t2", 9)], schemas.CITATIONS)
    assert rows(joins.attach_metric(cat, metric, "doi", "title"), "i", "citations") == [(1, 5), (2, 9), (3, 0), (4, 0), (5, 0)]
    pending = joins.attach_metric(cat, metric, "doi", "title", default=None)
    assert rows(filters.pending(pending, "citations", ["i"], 2), "i") == [(3,), (4,)]


def test_key_joins(spark, rows):
    df = frame(spark, [(1, "a"), (2, "b"), (3, None)], "i int, k string")
    seen = frame(spark, [("a",), ("a",), (None,)], "key string")
    assert rows(joins.skip_seen(df, seen, "k"), "i") == [(2,), (3,)]
    assert rows(filters.open_issues(df, "k", seen), "i") == [(2,)]
    new = frame(spark, [("a", "N", 1), ("a", "M", 2)], "k string, v string, t int")
    base = frame(spark, [(1, "a", "old"), (2, "b", "old")], "i int, k string, v string")
    assert rows(joins.update_by_key(base, new, "k", ["v"], ["t"]), "i", "v") == [(1, "M"), (2, "old")]
    members = frame(spark, [(" The  Best",)], "title string")
    titled = frame(spark, [(1, "the best"), (2, None)], "i int, t string")
    assert rows(joins.mark_members(titled, members, "t"), "i", "is_choice") == [(1, True), (2, False)]
    detail = frame(spark, [("x", 1), ("x", None), ("y", 2)], "k string, d int")
    assert rows(joins.complete_keys(detail, "k", ["d"])) == [("y",)]


def test_detect_changes(spark):
    listing = frame(spark, [("a", 10, 3), ("b", 2048, 2), ("c", 5, 1), ("d", 5, 4), ("e", 7, 5)], "filename string, size_bytes bigint, t int")
    listing = listing.withColumn("ts", F.timestamp_seconds("t"))
    state = frame(spark, [("b", 1024), ("c", None), ("d", 0), ("e", 7)], schemas.STATE)
    got = [(r.filename, r.change, r.detail) for r in incremental.detect_changes(listing, state).collect()]
    assert got == [("b", "changed", "1.0KB → 2.0KB"), ("a", "new", None)]


CATALOG = "Title string, URL string, IssueKey string, ingest_seq bigint"


def test_dedupe_first_happens_before_the_null_filter(spark, rows):
    df = frame(spark, [("t", None, 1), ("t", "good", 2), ("u", "x", 3), (None, "n", 4), (None, "m", 5)], "t string, a string, s bigint")
    first = dedupe.dedupe_first(df, ["t"], ["s"])
    assert rows(first, "s") == [(1,), (3,), (4,)]
    assert rows(filters.drop_missing(first, ["t", "a"]), "t") == [("u",)]
    assert rows(dedupe.dedupe_last(df, ["t"], ["s"]), "s") == [(2,), (3,), (5,)]
    best = frame(spark, [("d", 5, 1), ("d", 9, 2), ("d", 9, 3), ("e", None, 4)], "k string, m int, s int")
    assert rows(dedupe.dedupe_best(best, ["k"], "m", [F.col("s")]), "s") == [(2,), (4,)]


def test_replace_issue(spark, rows):
    old = frame(spark, [("A", "u1", "202603", 1), ("B", "u2", "202604.0", 2), ("C", "u3", "2026.004", 3), ("D", "u4", "202605", 4)], CATALOG)
    batch = frame(spark, [("B", "u2", "202604", 1), ("A", "u1", "202604", 2), ("E", "u5", "202605", 3)], CATALOG)
    out = dedupe.replace_issue(old, batch, keys="all")
    assert rows(out, "Title", "IssueKey") == [("A", "202604"), ("B", "202604"), ("E", "202605")]
    first = dedupe.replace_issue(old, batch, keys="first")
    assert rows(first, "Title") == [("A",), ("B",), ("D",), ("E",)]
    report = dedupe.replace_report(old, batch, first, keys="first").first()
    assert tuple(report) == (2, 3, 4)
    assert rows(dedupe.append_dedupe(old, batch), "Title") == [("A",), ("B",), ("C",), ("D",), ("E",)]


def test_logged_batches_equal_repeated_upserts(spark, rows):
    import random

    rng = random.Random(2)
    batches, seq = [], 0
    for gen in range(5):
        batch = []
        for _ in range(rng.randint(1, 6)):
            seq += 1
            batch.append((rng.choice("ABCD"), rng.choice(["u", "v", None]), rng.choice(["202601", "202602.0", "2026.002", "202603", None]), seq))
        batches.append(batch)
    catalog = frame(spark, [], CATALOG)
    for batch in batches:
        catalog = frame(spark, dedupe.replace_issue(catalog, frame(spark, batch, CATALOG)).collect(), CATALOG)
    log = frame(spark, [(*r, g) for g, b in enumerate(batches) for r in b], CATALOG + ", gen bigint")
    assert rows(dedupe.catalog_from_batches(log).drop("gen")) == rows(catalog)


def test_diff_is_null_safe(spark, rows):
    new = frame(spark, [("a", None), ("b", "u"), ("b", "u")], "Title string, URL string")
    old = frame(spark, [("a", None), ("c", "u")], "Title string, URL string")
    assert rows(dedupe.diff_keys(new, old), "Title", "change") == [("b", "added"), ("c", "removed")]
    assert tuple(dedupe.diff_counts(new, old).first()) == (1, 1, 2)


def test_invalidate_seen(spark, rows):
    seen = frame(spark, [("202601",), ("202601202602",), ("202603",), ("x",)], "key string")
    keys = frame(spark, [("202602",), ("202603",)], "issue_key string")
    assert rows(dedupe.invalidate_seen(seen, keys)) == [("202601",), ("202601202602",), ("x",)]
    assert rows(dedupe.invalidate_seen(seen, keys, "contains")) == [("202601",), ("x",)]
    with pytest.raises(Exception, match="6 characters"):
        dedupe.invalidate_seen(seen, frame(spark, [("12",)], "issue_key string"), "contains").collect()


def test_two_step_top(spark):
    data = [(i, 100 - i, None if i < 4 else "A", "No Abstract" if i == 5 else "x") for i in range(8)]
    df = frame(spark, data, "i int, m int, au string, ab string")
    args = (df, "m", "au", "ab", [F.col("i")])
    assert [r.i for r in ranking.two_step_top(*args, pool=6, n=3).collect()] == [4]
    assert [r.i for r in ranking.two_step_top(*args, pool=6, n=3, filter_first=True).collect()] == [4, 6, 7]


def test_ordered_columns_match_windows(spark, rows):
    from pyspark.sql import Window

    df = spark.range(500).select((F.col("id") * 7).alias("s"), F.when(F.col("id") % 5 > 0, "big").alias("g"),
                                 F.when(F.xxhash64("id") % 9 == 0, F.col("id")).alias("v"))
    w = Window.partitionBy("g").orderBy("s")
    want = df.withColumn("n", F.row_number().over(w)).withColumn("f", F.last("v", ignorenulls=True).over(w))
    got = ordered.running_index(df, ["g"], "s", "n", span=100)
    got = ordered.fill_down(got, ["g"], "s", {"f": "v"}, span=100)
    got = ordered.running_sum(got, ["g"], "s", "n", "t", span=100)
    want = want.withColumn("t", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    assert rows(got, "s", "g", "v", "n", "f", "t") == rows(want, "s", "g", "v", "n", "f", "t")


def sequential_draws(seed, n):
    """The generator as a stateful loop, for comparison."""
    out, state = [], seed
    for _ in range(n):
        state = (state + 0x6D2B79F5) % 2**32
        t = ((state ^ (state >> 15)) * (state | 1)) % 2**32
        t ^= (t + ((t ^ (t >> 7)) * (t | 61)) % 2**32) % 2**32
        out.append((t ^ (t >> 14)) / 2**32)
    return out


def test_daily_pick_matches_the_sequential_generator(spark):
    seed = 2026 * 1000 + 64
    draws = spark.range(1, 2001).select(generators.seeded_draw("id", seed)).collect()
    assert [r[0] for r in draws] == sequential_draws(seed, 2000)
    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(1).alias("pool"))
    got = {(r.pool, r.pick): r.id for r in generators.daily_pick(df, "pool", "id", 3, seed, span=50).collect()}
    for pool in (0, 1):
        members = [i for i in range(300) if (i % 3 == 0) == (pool == 0)]
        order = sorted(zip(sequential_draws(seed + pool, len(members)), members))
        assert [got[pool, k] for k in (1, 2, 3)] == [i for _, i in order[:3]]


def test_random_pick_is_stable_and_seeded(spark, rows):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("pool"))
    one, two = rows(generators.random_pick(df, ["pool"], "id", 3, 1)), rows(generators.random_pick(df, ["pool"], "id", 3, 1))
    assert one == two and len(one) == 6
    assert one != rows(generators.random_pick(df, ["pool"], "id", 3, 2))


def test_calendars(spark):
    anchor = frame(spark, [(dt.date(2026, 3, 20),)], "as_of date")
    got = [(r.year, r.issue, r.volume, r.url) for r in generators.issue_calendar(anchor, 4, "b").collect()]
    assert got[0] == (2026, 3, 92, "b/2026/00000092/00000003") and got[3][:2] == (2025, 12) and len(got) == 4
    since = generators.issue_calendar_since(anchor, "2018-01-01", "b").collect()
    assert len(since) == 99 and since[0].year == 2018
    latest = frame(spark, [(2026, 3)], "year int, issue int")
    index = generators.issue_index(latest, 2024)
    flagged = ranking.access_flag(index, "year", "issue", "month", latest, dt.datetime(2026, 3, 10))
    flags = {(r.year, r.issue): (r.label, r.access_flag) for r in flagged.collect()}
    assert flags[2026, 3] == ("No. 3, Mar 2026", "NEW") and flags[2026, 2][1] == ""
    assert flags[2025, 3][1] == "Full access" and flags[2025, 4][1] == "" and len(flags) == 27
    pages = {r.year: r.html for r in rendering.index_by_year(flagged).collect()}
    assert pages[2026].index("No. 3") < pages[2026].index("No. 1") and "Volume 92" in pages[2026]


def test_fragments(spark):
    df = frame(spark, [("T & <x>", None, "A", None, "i", True, None)], "t string, u string, a string, b string, i string, o boolean, g string")
    html = df.select(rendering.article_fragment("t", "u", "a", "b", "i", "o", image="g", escape=True)).first()[0]
    assert "T &amp; &lt;x&gt;" in html and 'href="#"' in html and "Open Access" in html and "<img" not in html
    plain = df.select(rendering.in_press_fragment("t", "u", "a", "b", "i", "o")).first()[0]
    assert "Abstract" not in plain and "T & <x>" in plain and "Avaliable online: i" in plain


def test_assemble_keeps_order_across_parts(spark):
    df = spark.range(95).select("id", F.lit("g").alias("k"), F.format_string("<%d>", "id").alias("f")).repartition(7)
    whole = rendering.assemble(df, ["k"], "id", "f").first().html
    parts = rendering.assemble(df, ["k"], "id", "f", most=20).orderBy("part").collect()
    assert len(parts) == 19 and "".join(p.html for p in parts) == whole == "".join(f"<{i}>" for i in range(95))


def test_parts_are_cut_by_bytes(spark):
    data = [("g", i, "é" * (i % 7) + "x") for i in range(300)] + [("h", 5, "only"), ("h", 9, None)]
    df = frame(spark, data, "k string, id long, f string").repartition(5)
    for most in (1, 10, 64, 10_000):
        parts = rendering.assemble(df, ["k"], "id", "f", most=most).orderBy("k", "part").collect()
        assert "".join(p.html for p in parts) == "".join(f for _, _, f in data if f)
        assert all(len(p.html.encode()) < most + 13 for p in parts)
        assert (len(parts) == 2) == (most == 10_000)
    pages = rendering.issue_pages(df, "k", "id", "f", F.concat(F.lit("<head>"), "k"), "<foot>", most=50).orderBy("k", "part").collect()
    assert "".join(p.html for p in pages if p.k == "g") == "<head>g" + "".join(f for k, _, f in data if k == "g") + "<foot>"
    assert [p.html for p in pages if p.k == "h"] == ["<head>honly<foot>"]


def test_fragments_of_parts_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def fragment(i):
        made.add(1)
        return f"<{i}>" if i % 5 else None

    df = spark.range(0, 60, 1, 3).select("id", F.lit("g").alias("k"), F.udf(fragment)("id").alias("f"))
    parts = rendering.assemble(df, ["k"], "id", "f", most=9).orderBy("part").collect()
    assert "".join(p.html for p in parts) == "".join(f"<{i}>" for i in range(60) if i % 5) and all(p.html for p in parts)
    assert made.value == 60


def test_texts_are_no_shuffle_keys(spark, rows):
    data = [("A  title", None, 1), ("a title", "", 2), ("A  title", None, 3), (None, "u", 4), (None, "u", 5), ("1", "2:x", 6), ("12", ":x", 7)]
    df = frame(spark, data, "Title string, URL string, n int")
    first = dedupe.dedupe_first(df, ["Title", "URL"], ["n"])
    assert rows(first, "n") == [(1,), (2,), (4,), (6,), (7,)]
    flagged = joins.mark_members(df, frame(spark, [(" A TITLE",), ("a title",), (None,)], "title string"), "Title")
    assert rows(flagged, "n", "is_choice") == [(1, True), (2, True), (3, True), (4, False), (5, False), (6, False), (7, False)]
    sides = dedupe.diff_keys(df, df.filter("n > 3").unionByName(frame(spark, [("gone", None, 9)], df.schema)))
    assert rows(sides, "Title", "change") == [("A  title", "added"), ("a title", "added"), ("gone", "removed")]
    for frame_ in (first, flagged, sides):
        plan = frame_._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"Exchange hashpartitioning\((.*?)\), ", plan)
        texts = [k for k in keys if re.search(r"(?<!octet_length\()\b(_t|Title|URL)#", re.sub(r"octet_length\(.*\)", "", k))]
        assert keys and not texts, keys


def test_formats(spark):
    heads = {"a.png": "89504E470D0A1A0A", "b.JPG": "FFD8FFE0", "c.gif": "474946383961", "d.webp": "52494646AABBCCDD57454250",
             "e.tif": "49492A00", "f.png": "FFD8FF00", "g.png": "", "h.png": "4D4D002A", "i": "474946383761"}
    df = frame(spark, [(p, bytearray.fromhex(h)) for p, h in heads.items()], "path string, content binary")
    got = {r.path: r.reason for r in audit.sniff_format(df).collect()}
    assert [p for p, r in got.items() if r is None] == ["a.png", "b.JPG", "c.gif", "d.webp", "i"]
    assert got["e.tif"] == "unsupported browser image format: TIFF"
    assert got["f.png"] == "extension .png but actual format is JPEG" and got["g.png"] == "cannot decode image"
    assert got["h.png"] == "extension .png but actual format is TIFF"


def test_image_audit(spark, rows):
    html = '<img src="img/a.png"><img src="img/b.png"><img src="https://x.example/y.png"><img src="https://own.example/f.png">'
    pages = frame(spark, [("202601", html)], "key string, html string")
    files = frame(spark, [("html/img/a.png", bytearray.fromhex("89504E470D0A1A0A")), ("f.png", bytearray.fromhex("FFD8FF"))],
                  "path string, content binary")
    refs = audit.page_references(pages, "key", "html", "html", ["https://own.example/"])
    bad = audit.image_failures(refs, audit.sniff_format(files))
    assert rows(bad, "path", "reason") == [
        ("f.png", "extension .png but actual format is JPEG"), ("html/img/b.png", "missing file for img/b.png")
    ]
    assert rows(audit.image_summary(refs, bad, "key")) == [("202601", 3, 2)]
    with pytest.raises(Exception, match="image check failed"):
        audit.raise_on_failures(bad).collect()


def test_catalog_checks(spark, rows):
    df = frame(spark, [("T", "A 1", "pp. 1", "u", None), ("T", "A", "12", "u", dt.date(2026, 1, 1)), (None, None, None, None, None)],
               "Title string, Authors string, Pages string, URL string, IssueDate date")
    assert dict(rows(audit.catalog_checks(df))) == {
        "authors_without_digits": 1, "pages_prefix": 2, "known_date": 2, "has_title": 1, "no_duplicates": 1
    }


RAW = [
    ("Deep Maps", "Ann 1; Bob 2", "Research Article", dt.date(2026, 4, 1), "4.0", "92.0", "1-9", "OA", "https://doi.org/10.1/a", "x", "https://f.example/d/G1/view", 1),
    ("Soon", "Cid", "In-Press", dt.date(2026, 3, 5), "4", "92", None, "SUB", "10.1/b", None, None, 2),
    ("Review", "Dan", "Book Review", dt.date(2026, 4, 1), "4", "92", "3", None, None, None, None, 3),
]


def raw_frame(spark):
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.RAW_METADATA.fields) + ", ingest_seq bigint"
    return frame(spark, RAW, schema)


def test_catalog_rows(spark):
    got = {r.Title: r for r in views.catalog_rows(raw_frame(spark)).collect()}
    first = got["Deep Maps"]
    assert (first.Authors, first.Pages, first.Access, first.URL) == ("Ann; Bob", "pp. 1-9", "Open Access content", "https://doi.org/10.1/a")
    assert (first.PubDate, first.Volume, first.Issue, first.IssueKey) == ("April 2026", "92", "04", "202604")
    assert (first.GA_Path, first["class"]) == ("img/2026/04/G1.png", "research")
    assert got["Soon"].Pages == "March 5, 2026" and got["Review"].URL == "" and got["Review"]["class"] == "other"


def test_views(spark, rows):
    catalog = frame(spark, [], schemas.CATALOG)
    out = views.ingest_batch(catalog, raw_frame(spark))
    assert rows(out["catalog"], "Title") == [("Deep Maps",)] and rows(out["in_press"], "Title") == [("Soon",)]
    assert rows(out["changes"]) == [("202604", 1, 0, 1)]
    as_of = dt.datetime(2026, 8, 15)
    assert rows(views.recent_view(out["catalog"], as_of), "Title", "PubDate") == [("Deep Maps", "April 2026")]
    cites = frame(spark, [("10.1/a", "zz", 12)], schemas.CITATIONS)
    assert rows(views.most_cited_view(out["catalog"], cites, as_of), "Title", "citations") == [("Deep Maps", 12)]


def test_require_and_add_columns(spark):
    df = frame(spark, [("t",)], "Title string")
    with pytest.raises(ValueError, match="DOI"):
        filters.require_columns(df, ["DOI"])
    full = filters.add_missing_columns(df, schemas.CATALOG)
    assert set(full.columns) == set(schemas.CATALOG.fieldNames()) and full.schema["ingest_seq"].dataType.simpleString() == "bigint"


def test_moment_literal_keeps_the_column_type(spark):
    df = spark.sql("select timestamp_ntz'2026-01-01 00:00:00' as t")
    moment = D.moment_like(df, "t", dt.datetime(2026, 1, 1))
    assert df.select(moment.alias("m")).schema["m"].dataType.simpleString() == "timestamp_ntz"


def test_blank_issue_keys_replace_nothing(spark, rows):
    names = "Title string, URL string, IssueKey string, ingest_seq int"
    old = spark.createDataFrame([("T0", "a", None, 1), ("T1", "b", "202401", 1), ("T5", "f", "", 1)], names)
    batch = spark.createDataFrame([("T2", "c", None, 2), ("T3", "d", "202401", 3), ("T4", "e", " ", 4)], names)
    for keys in ("all", "first"):
        titles = {r.Title for r in dedupe.replace_issue(old, batch, keys=keys).collect()}
        assert titles == {"T0", "T2", "T3", "T4", "T5"} | ({"T1"} if keys == "first" else set())
    log = old.selectExpr("*", "1 as gen").unionByName(batch.selectExpr("*", "2 as gen"))
    assert rows(dedupe.catalog_from_batches(log), "Title") == [("T0",), ("T2",), ("T3",), ("T4",), ("T5",)]
