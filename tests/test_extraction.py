import gc

from catalogflow.operators import extraction as X

TOC = """<div><p class="heading">In-Press Articles</p><div class="data"><strong>Skip</strong></div>
<p class="heading">Original <b>Articles</b></p>
<div class="data big"><strong> Deep <i>Maps</i></strong><a href="/a1">x</a><br>text<br> pp. 1-9 <br><em>Ann; Bob</em>
<span class="access-icon"><img src="i" title="Open Access content"></span></div>
<p>note</p><div class="other"><strong>No</strong></div>
<div class="data"><span class="access-icon"><img src="i"></span></div>
<p class="heading">Columns</p><div class="data"><strong>GIS Tips</strong></div>
<p class="heading">Reviews</p><div class="data"><strong>Book</strong></div></div>"""


def pages(spark, *html):
    return spark.createDataFrame([(f"u{i}", h) for i, h in enumerate(html)], "url string, html string")


def test_toc(spark, rows):
    got = rows(X.extract_toc(pages(spark, TOC, "", None), "https://b.example"), "Title", "Authors", "Pages", "Access", "URL")
    assert got == sorted([
        ("DeepMaps", "Ann; Bob", "pp. 1-9", "Open Access content", "https://b.example/a1"),
        ("N/A",) * 5,
        ("GIS Tips", "N/A", "N/A", "N/A", "N/A"),
    ], key=repr)
    narrow = X.extract_toc(pages(spark, TOC), words=("Articles",))
    assert narrow.count() == 2


def test_article(spark, rows):
    html = """<p><strong>Authors: </strong><a title="Search for articles by this author">Ann Lee</a><sup><a>1</a></sup>;
    <a title="Search for articles by this author">Bob</a><a>2</a></p><div id="Abst"> A first\nline. <b>Bold</b> </div>"""
    got = rows(X.extract_article(pages(spark, html, "<p>none</p>")), "page_url", "Authors", "Abstract")
    assert got == [("u0", "Ann Lee; Bob", "A first line.Bold"), ("u1", "N/A", "N/A")]
    titled = rows(X.extract_article(pages(spark, html), "titled"), "Authors")
    assert titled == [("Ann Lee, Bob",)]


def test_fast_track(spark, rows):
    html = """<ul id="fasttrackItems"><li><p><a title=" A &#8211; B " href="/x ">t</a><br>v<br>Appeared or available online:
    March 5, 2026</p><img title="Open Access content"></li><li><p><a title="C" href="/y">t</a></p></li></ul>"""
    got = rows(X.extract_fast_track(pages(spark, html, html), "https://b.example"))
    assert got == [("A – B", "March 5, 2026", "https://b.example/x", "Open Access content"), ("C", "", "https://b.example/y", "Unknown")]


def test_journals(spark, rows):
    html = """<li class="journalTitle"><a href="/j1">J\nOne</a></li><li class="publishername"> Pub A </li>
    <li class="journalTitle">No link</li><li class="journalTitle"><a>J3</a></li>"""
    assert rows(X.extract_journals(pages(spark, html)), "pos", "Journal Title", "Publisher Name", "Link to Journal") == [
        (0, "J One", "Pub A", "/j1"), (1, "N/A", "N/A", "N/A"), (2, "J3", "N/A", "N/A")
    ]


def test_journal_details(spark, rows):
    html = '<a class="issnDevicestyle">1111-2222</a><a class="issnDevicestyle">3333-4444</a> (Online)<a title="Volume 1, Number 2 ">x</a>'
    got = rows(X.extract_journal_details(pages(spark, html, "<p>x</p>", "")), "page_url", "Print ISSN", "Online ISSN", "Latest Issue")
    assert got == [("u0", "11112222", "33334444", "Volume 1, Number 2"), ("u1", "N/A", "N/A", "N/A"), ("u2",) + ("Error",) * 3]
    compat = rows(X.extract_journal_details(pages(spark, html), compat=True), "Print ISSN", "Online ISSN")
    assert compat == [("11112222", "11112222")]


def test_details(spark, rows):
    html = '<h1>T</h1><div class="contributions">Ann</div><p class="aff">U1</p><p class="aff x">U2</p><div id="Abst">Abs</div>'
    got = rows(X.extract_details(pages(spark, html, "<p></p>")), "Title", "Authors", "Affiliations", "Abstract")
    assert got == [("N/A",) * 4, ("T", "Ann", "U1 | U2", "Abs")]


def test_section_is_stitched_across_pages(spark, rows):
    text = [
        (1, 1, "Front. Matter\nIn-Press Articles\nDeep maps of\nforests. Ann Lee\nand Bob, and Cid\n12\nSecond title. Dan."),
        (1, 2, "Wrapped over\na page. Eve.\nTHE FOOTER. Line.\nNo stop here"),
        (2, 1, "nothing. here."),
    ]
    df = spark.createDataFrame(text, "doc int, page int, text string")
    want = sorted([
        (1, "Deep maps of forests", "Ann Lee and Bob, and Cid"), (1, "Second title", "Dan."), (1, "Wrapped over a page", "Eve."),
    ])
    by_page = X.extract_section_pages(df, "doc", "page", "text", "In-Press Articles", footer="THE FOOTER")
    assert rows(by_page, "doc", "Title", "Authors") == want
    docs = spark.createDataFrame([(1, [t for d, _, t in text if d == 1]), (2, ["nothing. here."])], "doc int, pages array<string>")
    in_row = X.extract_section(docs, "doc", "pages", "In-Press Articles", footer="THE FOOTER")
    assert rows(in_row, "doc", "Title", "Authors") == want


def test_section_simple(spark, rows):
    page = "x. y\nIn-Press Articles\nA title. Ann.  B\nno split\nSecond.\tBob\nPage 12\nLate. Entry"
    df = spark.createDataFrame([(1, page), (2, "no. heading")], "doc int, t string")
    assert rows(X.extract_section_simple(df, "doc", "t", "In-Press Articles"), "Title", "Authors") == [
        ("A title", "Ann.  B"), ("Second", "Bob")
    ]


def test_references(spark, rows):
    text = "noise\nLee, A., Deep maps of forests. 2001. Journal of Tests, B. 12(3):45–67.\nSmith, Maps. 1999. Atlas 7:1-2."
    df = spark.createDataFrame([(1, text)], "doc int, t string")
    assert rows(X.extract_references(df, "doc", "t"), "Authors", "Title", "Publication Info") == [
        ("Lee, A., Deep maps of forests", "Journal of Tests, B., 2001", " Volume/Issue: 12(3), Pages: 45–67")
    ]


def test_pages_of_any_number_of_lines(spark, rows):
    long_page = "Heading\n" + "x\n" * 1_000_002 + "Ann, and Bob. First\n"
    data = [("d", 1, long_page), ("d", 2, "Cy, and Di. Second\nEd, and Flo. Third\n")]
    df = spark.createDataFrame(data, "doc string, page int, text string")
    got = X.extract_section_pages(df, "doc", "page", "text", "Heading").select("pos").collect()
    whole = spark.createDataFrame([("d", [t for _, _, t in data])], "doc string, pages array<string>")
    want = X.extract_section(whole, "doc", "pages", "Heading")
    assert rows(want.select("pos")) == sorted((r.pos,) for r in got) and len(got) == 3


def test_unclosed_and_deep_markup(spark, rows):
    deep = "<div>" * 100_000 + TOC + "</span>" * 1000
    unclosed = "<ul>" + "<li>item" * 3_000 + TOC
    got = rows(X.extract_toc(pages(spark, deep, unclosed), "https://b.example"), "page_url", "Title")
    assert got == sorted((u, t) for u in ("u0", "u1") for t in ("DeepMaps", "N/A", "GIS Tips"))


def test_a_parsed_page_leaves_no_cycles():
    gc.collect()
    gc.disable()
    try:
        page = X._parse("<ul>" + "<li><a href='x'>t</a>" * 200 + "</ul>")
        assert len(list(page.all("li"))) == 200
        page.release()
        del page
        assert not [o for o in gc.get_objects() if isinstance(o, X._Node)]
    finally:
        gc.enable()
