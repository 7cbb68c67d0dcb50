import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from catalogflow.functions import dates as D
from catalogflow.functions import payloads as P
from catalogflow.functions import text as S


def test_normalize_doi(column):
    given = ["10.1/a", " https://doi.org/10.1/a/ ", "http://dx.doi.org/10.1/a", "DOI: 10.1/a//", "doi.org/10.1/a", None, ""]
    assert column(given, S.normalize_doi) == ["10.1/a"] * 5 + ["", ""]
    assert column(["10.1/a", None], S.doi_url) == ["https://doi.org/10.1/a", ""]
    assert column(["https://doi.org/doi:1"], lambda c: S.doi_url(c, normalize=False)) == [
        "https://doi.org/https://doi.org/doi:1"
    ]


def test_extract_doi_takes_the_last_part(column):
    given = ["https://doi.org/10.1/a ", "x doi.org/https://doi.org/10.2/b", "https://other.example/1", None]
    assert column(given, S.extract_doi) == ["10.1/a", "10.2/b", None, None]


def test_author_cleaning(column):
    given = ["A 1; B 2, 3; C 4", "A;;B", "Ann Lee 12", "X1,Y", None, "A; B 3"]
    assert column(given, S.clean_authors) == ["A; B; C", "A;B", "Ann Lee", "X;Y", None, "A; B"]
    assert column(["Ann; 1; ; Bob 2;", "R2D2; 3"], S.clean_author_links) == ["Ann; Bob", "R2D2"]


def test_title_variants(column):
    assert column(["  A \n B\t C ", None], S.normalize_title) == ["a b c", None]
    assert column(['" ""Deep""  Maps "', None, '""', "x"], S.clean_title) == ["deep maps", "", "", "x"]
    assert column(['" ""Deep"" "', None, '""', "x"], S.has_clean_title) == [True, False, False, True]
    assert column(["Éco-système: l’Étude №5", "ﬁne_arts", None], S.normalize_string) == [
        "ecosysteme letude no5", "fine_arts", None
    ]
    assert column([' say "hi" '], S.strip_quotes) == ["say hi"]
    assert column(["a\nb\r\nc "], S.flatten_text) == ["a b c"]
    assert column([" x y　"], S.squeeze) == ["x y"]


def test_labels(column, spark):
    assert column(["OA", "SUB", None], S.access_label) == [S.OPEN_LABEL, S.MEMBER_LABEL, S.MEMBER_LABEL]
    assert column([1024, 256, 17998], S.size_kb, "bigint") == ["1.0KB", "0.2KB", "17.6KB"]
    assert column(["abcdef"], lambda c: S.shorten(c, 3)) == ["abc..."]
    df = spark.createDataFrame([(["a", "b"],), (["a", "b", "c", "d", "e"],)], "n array<string>")
    assert [r[0] for r in df.select(S.summarise_list("n")).collect()] == ["a, b", "a, b, c and 2 more"]
    df = spark.createDataFrame([(True, dt.date(2026, 3, 5), "1-2"), (False, None, "1-2")], "p boolean, d date, g string")
    assert [r[0] for r in df.select(S.page_label("p", "d", "g")).collect()] == ["March 5, 2026", "pp. 1-2"]


def test_assets(column):
    links = ["https://x.example/d/AbC/view", "https://x.example/none", None]
    assert column(links, S.asset_status) == ["ok", "bad", "none"]
    assert column(links, S.asset_file_id) == ["AbC", None, None]
    sources = ["img/a.png", "../b.png", "./x/../c.png", "https://own.example/main/d.png", "https://z.example/e", "data:x", None,
               "/abs/../../f.png", "../../../g.png", ".."]
    assert column(sources, lambda c: S.resolve_asset_path(c, "pages/html", ["https://own.example/main/"])) == [
        "pages/html/img/a.png", "pages/b.png", "pages/html/c.png", "d.png", None, None, None, "/f.png", "../g.png", "pages"
    ]
    assert column(["a//b/./c/", "", "../x"], S.fold_path) == ["a/b/c", ".", "../x"]
    assert column(["http://x.example/a;jsessionid=1.2?p=1"], S.strip_session) == ["http://x.example/a?p=1"]
    assert column(["/a", None], lambda c: S.absolute_url("https://b.example", c)) == ["https://b.example/a", "N/A"]
    assert column(["https://h.example/content/2024/1/art1", "https://doi.org/x"],
                  lambda c: S.issue_url(c, F.lit("202604"), "/content/", "https://b.example")) == [
        "https://h.example/content/2024/1", "https://b.example/2026/00000092/00000004"
    ]


def test_image_sources_and_blocks(column):
    html = "<IMG class=x src='a.png'><img alt=\"q\" src=\"b.png\"><article>1</article>\n<ARTICLE a>2\n</article>"
    assert column([html], S.image_sources) == [["a.png", "b.png"]]
    assert column([html], S.html_blocks) == [["<article>1</article>", "<ARTICLE a>2\n</article>"]]


def test_numbers(column):
    assert column(["92.0", "92", " 7 ", "S1", None, "92d", "nan"], D.normalize_volume) == [
        "92", "92", "7", "S1", None, "92d", "nan"
    ]
    assert column(["4", "4.0", "12", "123", "S1", None, " 7"], D.normalize_issue) == ["04", "04", "12", "123", "S1", "", "07"]
    assert column(["2026.0", "2026", "x.0", None], D.normalize_year) == ["2026", "2026", "x", ""]
    assert column(["04", "12", "", "00", "S1"], D.issue_display) == ["4", "12", "0", "0", "S1"]


def test_issue_keys(column, spark):
    given = ["202604", "202604.0", "2026.006", "2026.4", "202613", "abc", "", None, "2.02604e5", " 202604 ", "+202604."]
    assert column(given, D.canonical_issue_key) == [
        "202604", "202604", "202606", "202604", "202613", "abc", "", "", "202604", "202604", "202604"
    ]
    url = "https://h.example/xy/2024/00000090/00000009/art00007"
    df = spark.createDataFrame(
        [("202604.0", None), ("bad", url), (None, url), (None, "https://doi.org/1"), ("2026.006", url)], "k string, u string"
    )
    assert [r[0] for r in df.select(D.page_issue_key("k", "u")).collect()] == ["202604", "202409", "202409", None, "202606"]
    assert [r[0] for r in df.select(D.page_issue_key("k", "u", "strip")).collect()][:2] == ["202604", "bad"]


def test_issue_dates(spark, column):
    url = "https://h.example/content/xy/2024/00000090/00000009/art00007"
    data = [("202604", None), ("202613", url), ("2026.006", None), (None, url), (None, url.rsplit("/", 1)[0]), ("abc", "x")]
    df = spark.createDataFrame(data, "k string, u string")
    day = dt.date
    assert [r[0] for r in df.select(D.issue_date("k", "u", host="h.example")).collect()] == [
        day(2026, 4, 1), day(2024, 9, 1), day(2026, 6, 1), day(2024, 9, 1), None, None
    ]
    assert df.select(D.issue_date("k", "u", host="other.example").alias("d")).filter("d is not null").count() == 2
    with pytest.raises(Exception, match="impossible issue key"):
        df.select(D.issue_date("k", "u", strict=True)).collect()
    assert column([url, url.replace("000009/", "000013/"), "x", None], D.date_from_url) == [
        "September 2024", "Unknown 2024", "Unknown Date", "Unknown Date"
    ]
    assert column(["March 5, 2026", "Mar 5, 2026", "2026-03-05", "soon", None], D.parse_online_date) == [
        day(2026, 3, 5), day(2026, 3, 5), day(2026, 3, 5), None, None
    ]


def test_moments():
    assert D.shift_months(dt.datetime(2026, 8, 31, 9), -6) == dt.datetime(2026, 2, 28, 9)
    assert D.shift_months(dt.datetime(2026, 3, 15), -12) == dt.datetime(2025, 3, 15)
    assert D.shift_days(dt.datetime(2026, 3, 1), -730) == dt.datetime(2024, 3, 1)


def test_payloads(column, spark):
    entry = ['{"search-results":{"entry":[{"citedby-count":"7"}]}}', '{"search-results":{"entry":[]}}', "broken", None]
    assert column(entry, P.entry_count) == [7, 0, 0, 0]
    inline = ['{"scholar_results":[{"inline_links":{"cited_by":{"total":"Cited by 12"}}}]}', '{"scholar_results":[]}', "{"]
    assert column(inline, P.inline_count) == [12, None, None]
    text = ["Sure:\n[{\"Title\": \"A\",\n\"Authors\": \"B\"}]\nbye", "none", "[broken"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "i int, t string")
    assert [tuple(r) for r in P.explode_articles(df, "t").collect()] == [(0, "A", "B")]
    with pytest.raises(Exception, match="no valid JSON"):
        P.explode_articles(df, "t", "failfast").collect()


def test_every_letter_folds_as_by_its_decomposition(spark, column):
    # five letters between marks, so that each kind of letter is met beside others; surrogates are no letters
    codes = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) != "Cn"]
    texts = ["x".join(codes[i:i + 5]) for i in range(0, len(codes), 5)]
    by_python = lambda c: F.lower(S.squeeze(F.regexp_replace(S.decompose(F.col(c)), r"(?U)[^\p{L}\p{N}_\s]", "")))
    assert column(texts, S.normalize_string) == column(texts, by_python)


def test_plain_texts_do_not_pass_through_python(spark, monkeypatch):
    # a decomposition that marks what it sees
    monkeypatch.setattr(S, "decompose", lambda c: F.concat(c, F.lit("seen")))
    df = spark.createDataFrame([("Plain, text",), ("é",), (None,)], "c string")
    assert [r[0] for r in df.select(S.normalize_string("c")).collect()] == ["plain text", "éseen", None]
