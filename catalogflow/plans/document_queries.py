"""Queries for matching, extraction, rendering, audits, run logs and streams."""

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as S
from ..operators import audit, extraction, generators, matching, ranking, rendering, runlog
from ..session import scratch_path
from ..sources.readers import number_lines, parse_listing, parse_state, scan_issue_keys
from ..streaming import ingest
from . import views
from .registry import ORDERS_AS_OF, query, table

HEADING = "<h1>(.*?)</h1>"
LINK = '<li><a href="([^"]*)">([^<]*)</a></li>'


def _heading(pages):
    return pages.select("page_id", "url", "html", F.regexp_extract("html", HEADING, 1).alias("heading"))


# --- fuzzy matching ---------------------------------------------------------


@query()
def exclude_issued_fuzzy(spark, folder):
    """Page headings that no line of any document equals or resembles (no SQL for the similarity: brute force in tests)."""
    items = _heading(table(spark, folder, "pages")).select("page_id", "heading")
    lines = table(spark, folder, "documents").select(F.explode(F.split("text", "\n")).alias("Title"))
    return matching.exclude_issued(items, lines, "heading")


@query(r"""
with first_line as (select doc_id, lower(trim(regexp_replace(replace(substr(string_split(coalesce(text, ''), chr(10))[1], 1, 120), '"', ''),
  '\s+', ' ', 'g'))) as title from documents),
t as (select * from first_line where length(title) between 20 and 120
  and len(list_distinct(string_split(title, ' '))) = len(string_split(title, ' '))),
issued as (select distinct title from t),
items as (select doc_id, title, case doc_id % 4 when 0 then '"' || replace(title, ' ', '  ') || '"'
  when 1 then substr(title, 1, (doc_id % length(title))::int) || substr(title, (doc_id % length(title))::int + 2)
  when 2 then regexp_replace(title, '(..).', '\1', 'g') else reverse(title) end as heading from t),
keyed as (select doc_id, trim(replace(heading, '"', '')) as heading,
  lower(trim(regexp_replace(replace(heading, '"', ''), '\s+', ' ', 'g'))) as k from items),
cut as (select trim(regexp_replace(substr(title, 1, i::int) || substr(title, i::int + 2), '\s+', ' ', 'g')) as k
  from issued, unnest(range(length(title))) as u(i))
select doc_id, heading from keyed where k <> '' and k not in (select title from issued) and k not in (select k from cut)
""")
def exclude_issued_edits(spark, folder):
    """First lines written again, with one letter lost, with every third letter lost, or backwards: the last two are new.

    Only lines without a repeated word: there one lost letter is one edit for the matcher too.
    """
    first = F.substring(F.element_at(F.split(F.coalesce("text", F.lit("")), "\n"), 1), 1, 120)
    titles = table(spark, folder, "documents").select("doc_id", S.clean_title(first).alias("title"))
    words = F.split("title", " ")
    titles = titles.filter(F.length("title").between(20, 120) & (F.size(F.array_distinct(words)) == F.size(words)))
    at = (F.col("doc_id") % F.length("title")).cast("int")
    less = F.concat(F.substr("title", F.lit(1), at), F.substr("title", at + 2))
    kind = F.col("doc_id") % 4
    heading = F.when(kind == 0, F.concat(F.lit('"'), F.replace("title", F.lit(" "), F.lit("  ")), F.lit('"'))).when(kind == 1, less).when(
        kind == 2, F.regexp_replace("title", "(..).", "$1")).otherwise(F.reverse("title"))
    return matching.exclude_issued(titles.select("doc_id", heading.alias("heading")), titles, "heading", "title")


@query(r"""
with item as (select page_id, lang, list_aggregate(list_sort(list_filter(regexp_split_to_array(heading, '\s+'), lambda w: w <> '')),
    'string_agg', ' ') as a from (select page_id, regexp_extract(html, '<html lang="(..)"', 1) as lang,
    regexp_extract(html, '<h1>(.*?)</h1>', 1) as heading from pages)),
keyed as (select page_id, lang, coalesce(a, '') as a from item),
cand as (select lang, coalesce(b, '') as b, min(name) as name from (select lang, text as name,
  list_aggregate(list_sort(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')), 'string_agg', ' ') as b
  from documents where text is not null and length(text) <= 2000) group by all),
letter as (select a, substr(a, i::int + 1, 1) as ch, sum(1::hugeint << i::int)::hugeint as bits
  from (select distinct a from keyed), unnest(range(length(a))) as u(i) group by all),
mask as (select a, map(list(ch), list(bits)) as m from letter group by a),
pair as (select k.lang, k.a, c.b, c.name, mask.m, ((1::hugeint << length(k.a)) - 1)::hugeint as ones
  from (select distinct lang, a from keyed) k join mask on mask.a = k.a join cand c on c.lang = k.lang
  where 30 * length(c.b) <= 170 * length(k.a) and 30 * length(k.a) <= 170 * length(c.b)),
row_of as (select *, list_reduce(list_prepend(ones, list_transform(string_split(b, ''), lambda c: coalesce(m[c], 0::hugeint))),
  lambda v, k: ((v + (v & k)) | (v - (v & k))) & ones) as v from pair),
scored as (select lang, a, name, 200.0 * (length(a) - bit_count(v)) / (length(a) + length(b)) as score from row_of),
best as (select lang, a, first(name order by score desc, name) as name, max(score) as score from scored where score >= 30 group by lang, a)
select k.page_id, k.lang, md5(b.name) as match, round(b.score, 6) as score
from keyed k left join best b on b.lang = k.lang and b.a = k.a
""")
def best_match_in_group(spark, folder):
    """Best document text of the page's own language for each page heading."""
    pages = _heading(table(spark, folder, "pages")).withColumn("lang", F.regexp_extract("html", '<html lang="(..)"', 1))
    docs = table(spark, folder, "documents").select("lang", "text")
    best = matching.best_match(pages.select("page_id", "lang", "heading"), docs, "lang", "heading", "text")
    return best.select("page_id", "lang", F.md5("match").alias("match"), F.round("score", 6).alias("score"))


# --- extraction ------------------------------------------------------------

UNESCAPE = "replace(replace({0}, '&quot;', '\"'), '&amp;', '&')"


@query(f"""
select url as page_url, trim({UNESCAPE.format("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}) as "Title", 'A. Writer' as "Authors",
  'pp. ' || page_id as "Pages", 'Open Access content' as "Access", 'https://base.example/p' || page_id as "URL"
from pages
""")
def toc_extract(spark, folder):
    rows = extraction.extract_toc(_toc_pages(spark, folder), "https://base.example")
    return rows.drop("pos")


def _toc_pages(spark, folder):
    """Each page with one article block in the journal's layout in front of it."""
    block = F.concat(
        F.lit('<p class="heading">Original Articles</p><div class="data"><strong>'), "heading",
        F.lit('</strong><a href="/p'), F.col("page_id"), F.lit('">link</a><br>note<br> pp. '), F.col("page_id"),
        F.lit('<br><em>A. Writer</em><span class="access-icon"><img title="Open Access content"></span></div>'
              '<p class="heading">In-Press Articles</p><div class="data"><strong>Other</strong></div>'),
    )
    return _heading(table(spark, folder, "pages")).select("url", F.concat(block, "html").alias("html"))


@query(f"""
select url as page_url, regexp_extract(html, '<html lang="(..)"', 1) || '; Ann Other' as "Authors",
  md5(replace(trim({UNESCAPE.format("regexp_replace(regexp_extract(html, '(?s)<article>.*</article>', 0), '\\s*<[^>]*>\\s*', '', 'g')")}),
    chr(10), ' ')) as abstract
from pages
""")
def article_extract(spark, folder):
    rows = extraction.extract_article(_article_pages(spark, folder).select("url", "html"))
    return rows.select("page_url", "Authors", F.md5("Abstract").alias("abstract"))


def _article_pages(spark, folder):
    """Each page's article as the abstract of an article page."""
    body = F.concat(
        F.lit('<p><strong>Authors:</strong> <a>'), F.regexp_extract("html", '<html lang="(..)"', 1),
        F.lit('</a><sup><a>1</a></sup>; <a>Ann Other</a><a> 2 </a></p><div id="Abst">'),
        F.regexp_extract("html", "(?s)<article>.*</article>", 0), F.lit("</div>"),
    )
    return table(spark, folder, "pages").select("page_id", "url", body.alias("html"))


@query(f"""
with p as (select page_id, url, trim({UNESCAPE.format("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}) as title,
  replace(trim({UNESCAPE.format("regexp_replace(regexp_extract(html, '(?s)<article>.*</article>', 0), '\\s*<[^>]*>\\s*', '', 'g')")}),
    chr(10), ' ') as abstract from pages),
k as (select * from p where url not in (select url from pages where page_id in (select user_id from events where value > 400))
  and abstract not ilike '%no abstract%'),
r as (select *, row_number() over (partition by title order by url) as rn from k)
select title as "Title", 'pp. ' || page_id as "Pages", 'https://base.example/p' || page_id as "URL", md5(abstract) as abstract
from r where rn = 1
""")
def scraped_catalog(spark, folder):
    """Issue and article pages to cleaned catalog rows, pages seen before left out."""
    seen_ids = table(spark, folder, "events").filter("value > 400").select(F.col("user_id").alias("page_id")).distinct()
    seen = table(spark, folder, "pages").join(seen_ids, "page_id").select(F.col("url").alias("key"))
    link = F.concat(F.lit("https://base.example/p"), F.col("page_id"))
    articles = _article_pages(spark, folder).select(link.alias("url"), "html")
    rows = views.scraped_articles(_toc_pages(spark, folder), articles, seen, "https://base.example")
    return rows.select("Title", "Pages", "URL", F.md5("Abstract").alias("abstract"))


@query(f"""
select url as page_url, trim({UNESCAPE.format("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}) as "Title",
  trim({UNESCAPE.format("regexp_extract(html, '<title>(.*?)</title>', 1)")}) as "Authors",
  array_to_string(list_transform(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1),
    lambda x: trim({UNESCAPE.format("x")})), ' | ') as "Affiliations", 'N/A' as "Abstract"
from pages
""")
def detail_extract(spark, folder):
    rows = extraction.extract_details(
        table(spark, folder, "pages"), title=("h1",), authors=("title",), affiliation=("li",), abstract=("div", None, "Abst")
    )
    return rows.drop("pos")


@query(f"""
select distinct {UNESCAPE.format("l[2]")} as "Title", 'March 5, 2026' as "Date",
  'https://base.example' || {UNESCAPE.format("l[1]")} as "Link", 'Unknown' as "Access Status"
from (select unnest(list_zip(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1),
  regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2))) as l from pages)
""")
def fast_track_extract(spark, folder):
    item = '<li><p><a href="$1" title="$2">$2</a><br>x<br>Appeared or available online: March 5, 2026</p></li>'
    html = F.concat(F.lit('<ul id="fasttrackItems">'), F.regexp_replace("html", LINK, item), F.lit("</ul>"))
    pages = table(spark, folder, "pages").select("url", html.alias("html"))
    return extraction.extract_fast_track(pages, "https://base.example")


@query(f"""
select url as page_url, {UNESCAPE.format("l[2]")} as "Journal Title", 'House of ' || {UNESCAPE.format("l[2]")} as "Publisher Name",
  {UNESCAPE.format("l[1]")} as "Link to Journal"
from (select url, unnest(list_zip(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1),
  regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2))) as l from pages)
""")
def journal_extract(spark, folder):
    item = '<li class="journalTitle"><a href="$1">$2</a></li><li class="publishername">House of\n$2</li>'
    pages = table(spark, folder, "pages").select("url", F.regexp_replace("html", LINK, item).alias("html"))
    return extraction.extract_journals(pages).drop("pos")


@query("""
select url as page_url, lpad(cast(page_id as varchar), 8, '0') as "Print ISSN",
  case when page_id % 2 = 0 then lpad(cast(page_id as varchar), 4, '0') || '9999 (Online)' else 'N/A' end as "Online ISSN",
  'Volume 3, Number ' || page_id as "Latest Issue" from pages
""")
def journal_detail_extract(spark, folder):
    number = F.lpad(F.col("page_id").cast("string"), 8, "0")
    online = F.concat(
        F.lit('<a class="issnDevicestyle">'), F.lpad(F.col("page_id").cast("string"), 4, "0"),
        F.lit("-9999 (Online)</a>"),
    )
    html = F.concat(
        F.when(F.col("page_id") % 2 == 0, online).otherwise(F.lit("")),
        F.lit('<a class="issnDevicestyle">'), F.substring(number, 1, 4), F.lit("-"), F.substring(number, 5, 4),
        F.lit('</a><a title="Volume 3, Number '), F.col("page_id"), F.lit('">latest</a>'), "html",
    )
    pages = table(spark, folder, "pages").select("url", html.alias("html"))
    return extraction.extract_journal_details(pages).drop("pos")


@query("""
select page_id, cast(pos - 1 as int) as pos, md5(block) as block from (
  select page_id, unnest(b) as block, unnest(range(1, len(b) + 1)) as pos from (
    select page_id, regexp_extract_all(html, '(?is)<article\\b.*?</article>') as b from pages))
""")
def article_blocks(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", F.posexplode(S.html_blocks("html")).alias("pos", "block"))
    return pages.select("page_id", "pos", F.md5("block").alias("block"))


SECTION_SQL = """
with l as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[A-Za-z]')) as lines
  from documents),
j as (select doc_id, string_split(array_to_string(list_transform(lines, lambda x: trim(x) ||
    case when regexp_matches(x, '\\.$') or contains(x, ', and ') then chr(1) else '' end), ' '), chr(1)) as parts from l),
e as (select doc_id, trim(unnest(parts)) as entry, unnest(range(0, len(parts))) as pos from j),
c as (select doc_id, pos, entry, position('. ' in entry) as cut from e)
select doc_id, cast(pos as int) as pos, md5(trim(entry[1:cut - 1])) as title, md5(trim(entry[cut + 2:])) as authors
from c where cut > 1 and trim(entry[1:cut - 1]) <> '' and trim(entry[cut + 2:]) <> ''
"""


@query(SECTION_SQL)
def section_entries_paged(spark, folder):
    """One row per page: a front page, then a page with the whole text."""
    docs = table(spark, folder, "documents")
    text = F.concat(F.lit("Cover page.\nIn-Press Articles\n"), "text")
    pages = docs.select("doc_id", F.posexplode_outer(F.array(F.lit("Front matter."), text)).alias("page", "text"))
    rows = extraction.extract_section_pages(pages, "doc_id", "page", "text", "In-Press Articles", "RUNNING FOOTER")
    return rows.select("doc_id", F.col("pos").cast("int").alias("pos"), F.md5("Title").alias("title"), F.md5("Authors").alias("authors"))


@query(SECTION_SQL)
def section_entries(spark, folder):
    text = F.concat(F.lit("Cover page.\nIn-Press Articles\n"), "text")
    docs = table(spark, folder, "documents").select("doc_id", F.array(F.lit("Front matter."), text).alias("pages"))
    rows = extraction.extract_section(docs, "doc_id", "pages", "In-Press Articles", footer="RUNNING FOOTER")
    return rows.select("doc_id", "pos", F.md5("Title").alias("title"), F.md5("Authors").alias("authors"))


@query("""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(0, len(string_split(text, chr(10))))) as pos
  from documents)
select doc_id, cast(pos as int) as pos, md5(trim(regexp_extract(line, '(?s)^(.*?)\\.\\s+(.*)$', 1))) as title,
  md5(trim(regexp_extract(line, '(?s)^(.*?)\\.\\s+(.*)$', 2))) as authors
from l where regexp_matches(line, '(?s)^(.*?)\\.\\s+(.*)$')
""")
def section_lines(spark, folder):
    page = F.concat(F.lit("In-Press Articles\n"), "text", F.lit("\nPage 3\nNot. An entry"))
    docs = table(spark, folder, "documents").select("doc_id", page.alias("page"))
    rows = extraction.extract_section_simple(docs, "doc_id", "page", "In-Press Articles")
    return rows.select("doc_id", "pos", F.md5("Title").alias("title"), F.md5("Authors").alias("authors"))


REFERENCE_SQL = (
    "(?m)^(.*?),\\s*(.+?)\\.\\s*(\\d{4})\\.\\s+([A-Za-z0-9\\s&(),.\\-:/]+?)\\s+(\\d+\\(?[a-zA-Z0-9]*\\)?):([0-9–]+)\\."
)


@query(f"""
with t as (select doc_id, text || chr(10) || 'Lee, ' || source || ' studies in ' || lang || '. ' || (1990 + doc_id % 30)
    || '. Journal of Tests ' || (doc_id % 90) || '(2):1–' || doc_id || '.' || chr(10) as text from documents),
m as (select doc_id, unnest(regexp_extract_all(text, '{REFERENCE_SQL}')) as hit from t),
g as (select doc_id, regexp_extract(hit, '{REFERENCE_SQL}', ['a', 'b', 'c', 'd', 'e', 'f']) as g from m)
select doc_id, trim(g.a) || ', ' || trim(g.b) as "Authors", trim(g.d) || ', ' || g.c as "Title",
  ' Volume/Issue: ' || g.e || ', Pages: ' || g.f as "Publication Info" from g
""")
def reference_extract(spark, folder):
    # the reference list follows the whole text of the document
    entry = F.concat(
        F.lit("\nLee, "), "source", F.lit(" studies in "), "lang", F.lit(". "), 1990 + F.col("doc_id") % 30,
        F.lit(". Journal of Tests "), F.col("doc_id") % 90, F.lit("(2):1–"), F.col("doc_id"), F.lit(".\n"),
    )
    docs = table(spark, folder, "documents").select("doc_id", F.concat("text", entry).alias("text"))
    return extraction.extract_references(docs, "doc_id", "text").drop("pos")


# --- rendering -------------------------------------------------------------

FRAGMENT = """
'<article class="' || case when {first} then 'entry first' else 'entry' end || '"><div class="kind">Research Articles ' ||
case when lang = 'en' then '<span class="open">Open Access</span>' else '' end || '</div>' ||
'<h3><a href="' || coalesce(url, '#') || '">' || title || '</a></h3><div class="info">' || info || '</div>' ||
'<div class="authors">Authors: ' || source || '</div><div class="abstract">Abstract:<details><summary>Read more...</summary>'
|| text || '</details></div></article>'
"""


def _articles(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", "source", "lang", "text",
        F.concat(F.lit("Document "), F.col("doc_id")).alias("title"),
        F.when(F.col("lang") != "fr", F.concat(F.lit("https://doi.org/10.3/"), F.col("doc_id"))).alias("url"),
        F.concat(F.lit("May 2020, pp. "), F.col("n_chars")).alias("info"),
        (F.col("lang") == "en").alias("is_open"),
    )


ARTICLES = """
select *, 'Document ' || doc_id as title, case when lang <> 'fr' then 'https://doi.org/10.3/' || doc_id end as url,
  'May 2020, pp. ' || n_chars as info, row_number() over (partition by source order by doc_id) as pos from documents
"""


@query(f"""
with a as ({ARTICLES})
select doc_id, md5({FRAGMENT.format(first="pos = 1")}) as article,
  md5('<article class="entry"><h3>' || title || '</h3><div class="authors">Authors: ' || source || '</div></article>') as minimal,
  md5('<article class="entry"><div class="kind">Research Articles '
    || case when lang = 'en' then '<span class="open">Open Access</span>' else '' end || '</div>'
    || '<h3><a href="' || coalesce(url, '#') || '">' || title || '</a></h3>'
    || '<div class="info">Avaliable online: ' || info || '</div>'
    || case when source = 'src1' then '' else '<div class="authors">Authors: ' || source || '</div>' end
    || case when lang = 'de' then '' else '<div class="abstract">Abstract:<details><summary>Read more...</summary>' || text
       || '</details></div>' end || '</article>') as in_press
from a
""")
def fragment_render(spark, folder):
    rows = ranking.group_position(_articles(spark, folder), ["source"], "doc_id", span=100_000)
    authors = F.when(F.col("source") == "src1", F.lit("N/A")).otherwise(F.col("source"))
    abstract = F.when(F.col("lang") != "de", F.col("text"))
    return rows.select(
        "doc_id",
        F.md5(rendering.article_fragment("title", "url", "source", "text", "info", "is_open", "is_first")).alias("article"),
        F.md5(rendering.minimal_fragment("title", "source")).alias("minimal"),
        F.md5(rendering.in_press_fragment("title", "url", authors, abstract, "info", "is_open")).alias("in_press"),
    )


@query(f"""
with a as ({ARTICLES}), f as (select doc_id, source, {FRAGMENT.format(first="false")} as fragment from a),
p as (select *, coalesce(sum(strlen(fragment)) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0)
  // 200000 as part from f)
select source, cast(part as bigint) as part, md5(string_agg(fragment, '' order by doc_id)) as html, sum(strlen(fragment))::bigint as bytes
from p group by 1, 2
""")
def issue_documents(spark, folder):
    rows = _articles(spark, folder)
    fragment = rendering.article_fragment("title", "url", "source", "text", "info", "is_open")
    parts = rendering.assemble(rows.withColumn("fragment", fragment), ["source"], "doc_id", "fragment", most=200_000)
    return parts.select("source", "part", F.md5("html").alias("html"), F.octet_length("html").cast("long").alias("bytes"))



@query("""
select p_partkey, '<article class="entry"><div class="kind">Research Articles '
  || case when p_brand = 'Brand#13' then '<span class="open">Open Access</span>' else '' end
  || '</div><h3><a href="https://doi.org/10.2/' || p_partkey || '">' || replace(p_name, '&', '&amp;')
  || '</a></h3><div class="info">Year: ' || (1990 + p_size) || ', Volume: ' || (56 + p_size) || ', Issue: </div>'
  || '<div class="authors">Authors: ' || p_brand || '</div><div class="abstract">Abstract:<details><summary>Read more...'
  || '</summary>' || p_type || '</details></div></article>' as html
from part
""")
def usage_fragments(spark, folder):
    part = table(spark, folder, "part").withColumns({
        "url": F.concat(F.lit("https://doi.org/10.2/"), F.col("p_partkey")),
        "year": 1990 + F.col("p_size"), "is_open": F.col("p_brand") == "Brand#13", "issue": F.lit(None).cast("int"),
    }).withColumn("volume", D.volume_of_year("year"))
    html = rendering.usage_fragment(
        "p_name", "url", "p_brand", "p_type", "year", "volume", "issue", "is_open", escape=True
    )
    return part.select("p_partkey", html.alias("html"))


@query("""
with months as (select unnest(generate_series(timestamp '2003-01-01' - interval 10 year,
    (select date_trunc('month', max(o_orderdate)) from orders), interval 1 month)) as m),
f as (select year(m) as year, month(m) as issue, '<li><a href="issues/' || strftime(m, '%Y%m') || '.html">No. ' || month(m)
    || ', ' || strftime(m, '%b %Y') || '</a>' || case when m = (select max(m) from months) then ' <strong>NEW</strong>'
    when m <= timestamp '2000-08-15 12:00:00' then ' <strong>Full access</strong>' else '' end || '</li>' as item from months)
select cast(year as int) as year, cast(year - 1934 as int) as volume, '<ul><li>Volume ' || (year - 1934) || '</li>'
  || string_agg(item, '' order by issue desc) || '</ul>' as html from f group by year
""")
def issue_index_pages(spark, folder):
    orders = table(spark, folder, "orders")
    latest = ranking.latest_issue(orders, F.year("o_orderdate"), F.month("o_orderdate"))
    index = generators.issue_index(latest, 1993, "issues/")
    flagged = ranking.access_flag(index, "year", "issue", "month", latest, ORDERS_AS_OF)
    return rendering.index_by_year(flagged)


@query("""
with big as (select distinct l_orderkey as n from lineitem where l_quantity >= 50),
a as (select o_orderkey as seq, strftime(o_orderdate, '%Y%m') as k, '<article class="entry"><div class="kind">Research Articles '
    || case when o_orderpriority = '1-URGENT' or o_orderstatus = 'P' then '<span class="open">Open Access</span>' else '' end || '</div>'
    || case when big.n is not null then '<span class="choice">Editor’s Choice</span>' else '' end
    || '<h3><a href="' || case when o_custkey % 7 = 0 then '#' else 'https://doi.org/10.5/' || o_orderkey end || '">Order  No. ' || o_orderkey
    || '</a></h3><div class="info">Pages: ' || o_custkey || '</div><div class="authors">Authors: Customer ' || o_custkey
    || '</div><div class="abstract">Abstract:<details><summary>Read more...</summary>' || o_orderpriority || '</details></div>'
    || case when p_partkey is not null then '<img src="img/' || o_orderkey || '.png">' else '' end || '</article>' as f
  from orders left join big on big.n = o_orderkey left join part on p_partkey = o_orderkey)
select k as "IssueKey", cast(0 as bigint) as part, md5('<header><h1>Issue ' || k[5:6]
  || ' - Year ' || k[1:4] || '</h1><p><a href="https://base.example/' || k[1:4] || '/000000' || (cast(k[1:4] as int) - 1934)
  || '/000000' || k[5:6] || '">View Full Issue</a></p></header>' || string_agg(f, '' order by seq) || '<footer></footer>') as html
from a group by k
""")
def issue_page_render(spark, folder):
    """One document per month of orders, with access badges, choice badges and the images that exist."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ingest_seq"), F.date_format("o_orderdate", "yyyyMM.0").alias("IssueKey"),
        F.concat(F.lit("Order  No. "), "o_orderkey").alias("Title"), F.concat(F.lit("Customer "), "o_custkey").alias("Authors"),
        F.col("o_custkey").cast("string").alias("Pages"), F.when(F.col("o_orderpriority") == "1-URGENT", " OA").otherwise("SUB").alias("Access"),
        F.when(F.col("o_custkey") % 7 != 0, F.concat(F.lit("https://doi.org/10.5/"), "o_orderkey")).alias("URL"),
        F.col("o_orderpriority").alias("Abstract"), F.concat(F.lit("img/"), "o_orderkey", F.lit(".png")).alias("GA_Path"), "o_orderstatus")
    status = F.when(F.col("o_orderstatus") == "P", " oa ").otherwise("SUB")
    metadata = orders.select(F.upper("Title").alias("Title"), status.alias("Access Status"))
    choices = table(spark, folder, "lineitem").filter("l_quantity >= 50").select(F.concat(F.lit(" order no. "), "l_orderkey").alias("title"))
    assets = table(spark, folder, "part").select(F.concat(F.lit("img/"), "p_partkey", F.lit(".png")).alias("path"))
    # an issue has one part up to 100 MB
    pages = views.issue_documents(orders, metadata, choices, assets, "https://base.example", most=100_000_000)
    return pages.withColumn("html", F.md5("html"))


# --- audits ----------------------------------------------------------------


@query("""
with v as (select text as title, source || ' ' || lang as authors, case when lang = 'es' then 'Mar 3' else 'pp. ' || n_chars end
    as pages, case when source = 'src9' then null else 1 end as d, lang as url from documents)
select unnest(['authors_without_digits', 'pages_prefix', 'known_date', 'has_title', 'no_duplicates']) as rule,
  unnest([count(*) filter (regexp_matches(authors, '\\d')), count(*) filter (not starts_with(pages, 'pp. ')),
    count(*) filter (d is null), count(*) filter (title is null or title = 'N/A'),
    count(*) - count(distinct (title, url))]) as violations from v
""")
def catalog_audit(spark, folder):
    docs = table(spark, folder, "documents").select(
        F.col("text").alias("Title"), F.concat("source", F.lit(" "), "lang").alias("Authors"),
        F.when(F.col("lang") == "es", F.lit("Mar 3")).otherwise(F.concat(F.lit("pp. "), F.col("n_chars"))).alias("Pages"),
        F.col("lang").alias("URL"), F.when(F.col("source") != "src9", F.lit(1)).alias("IssueDate"),
    )
    return audit.catalog_checks(docs)


@query("""
select strftime(o_orderdate, '%Y%m') as issue_key, count(*) filter (o_orderpriority = '5-LOW') as no_doi,
  count(*) filter (o_orderstatus = 'P') as no_access, count(*) filter (o_totalprice < 50000) as no_image
from orders group by 1
""")
def missing_warnings(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("issue_key"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.col("o_orderpriority")).alias("doi"),
        F.when(F.col("o_orderstatus") == "P", F.lit("N/A")).otherwise(F.col("o_orderstatus")).alias("access"),
        F.when(F.col("o_totalprice") >= 50000, F.lit("img.png")).alias("image"),
    )
    return audit.missing_warnings(orders, "issue_key", "doi", "access", "image")


def _files(spark, folder):
    """One stored file per document: a signature by language, then its text."""
    heads = {"en": "89504E470D0A1A0A", "de": "FFD8FFE0", "fr": "49492A0008000000"}
    head = F.lit("")
    for lang, signature in heads.items():
        head = F.when(F.col("lang") == lang, F.lit(signature)).otherwise(head)
    suffix = F.when(F.col("source").isin("src1", "src2"), F.lit(".jpg")).otherwise(F.lit(".png"))
    return table(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit("img/"), F.col("doc_id"), suffix).alias("path"),
        F.concat(F.unhex(head), F.encode("text", "UTF-8")).alias("content"),
    )


SNIFF = """
select doc_id, 'img/' || doc_id || suffix as path, format, case when format is null then 'cannot decode image'
    when format = 'TIFF' or (format = 'PNG') <> (suffix = '.png') then 'extension ' || suffix || ' but actual format is ' || format
  end as reason
from (select doc_id, case when source in ('src1', 'src2') then '.jpg' else '.png' end as suffix,
  case lang when 'en' then 'PNG' when 'de' then 'JPEG' when 'fr' then 'TIFF' end as format from documents)
"""


@query(SNIFF)
def format_sniff(spark, folder):
    return audit.sniff_format(_files(spark, folder)).select("doc_id", "path", "format", "reason")


@query(f"""
with s as ({SNIFF}),
r as (select page_id, 'img/' || page_id || '.png' as path, '../img/' || page_id || '.png' as src from pages),
f as (select page_id, r.path, case when s.path is null then 'missing file for ' || src else reason end as reason
  from r left join s on s.path = r.path)
select page_id, path, reason, checked, failures from f
join (select page_id, count(*) as checked, count(*) filter (reason is not null) as failures from f group by 1) using (page_id)
where reason is not null
""")
def image_audit(spark, folder):
    picture = F.concat(
        F.lit('<img class="g" src="../img/'), F.col("page_id"), F.lit('.png"><img src="https://other.example/x.png">')
    )
    pages = table(spark, folder, "pages").select("page_id", F.concat("html", picture).alias("html"))
    references = audit.page_references(pages, "page_id", "html", "pages")
    failures = audit.image_failures(references, audit.sniff_format(_files(spark, folder)))
    summary = audit.image_summary(references, failures, "page_id")
    return failures.join(summary, "page_id").select("page_id", "path", "reason", "checked", "failures")


@query("""
with r as (select page_id, url, unnest(regexp_extract_all(html, '<a[^>]+href=["'']([^"'']+)["'']', 1)) as src from pages)
select page_id, src, '/' || ltrim(src, '/') as path from r
where src not in (select src from r where starts_with(url, 'https'))
""")
def missing_assets(spark, folder):
    from ..operators.joins import missing_assets as find

    pages = table(spark, folder, "pages")
    refs = audit.page_references(pages, "page_id", "html", "", tag="a", attribute="href")
    stored = audit.page_references(pages.filter(F.startswith("url", F.lit("https"))), "page_id", "html", "", tag="a",
                                   attribute="href")
    return find(refs, stored)


# --- run logs --------------------------------------------------------------

LOG_LINES = """
log as (select cast(user_id as varchar) as file, event_id as line_no, cast(json_extract_string(props, '$.k') as int) % 6 as k,
    value, event_type, case event_type when 'view' then case when value > 300 then '== 全自动更新 ==' else '  ' end
    when 'click' then '📊 S3 文件列表:' when 'signup' then '   - page_' || (event_id // 3) || '.html'
    when 'purchase' then '📋 生成的文件:' else case k when 0 then '✅ 成功处理: ' || event_id || ' 个文件'
      when 1 then '已处理的文件:' when 2 then '📌 done' when 3 then '   ✅ 已生成: made_' || (event_id // 9) || '.html (new)'
      when 4 then case event_id % 3 when 0 then '📤 Pushing to GitHub...' when 1 then '  📊 In-Press 统计: +' || event_id || ' / -0'
        else '✅ Git commit 完成' end
      else case event_id % 3 when 0 then 'fatal: no' when 1 then '📊 Issue 202604: +' || event_id else 'ℹ️  没有变化需要提交' end
      end end as line from events),
run as (select l.* from log l join (select file, max(case when contains(line, '全自动更新') then line_no end) as s from log
  group by 1) m using (file) where s is null or line_no >= s)
"""


def _log(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int") % 6
    n = F.col("event_id")
    kind = F.col("event_type")
    error = (
        F.when(k == 0, F.concat(F.lit("✅ 成功处理: "), n, F.lit(" 个文件"))).when(k == 1, F.lit("已处理的文件:"))
        .when(k == 2, F.lit("📌 done"))
        .when(k == 3, F.concat(F.lit("   ✅ 已生成: made_"), F.floor(n / 9), F.lit(".html (new)")))
        .when(k == 4, F.when(n % 3 == 0, F.lit("📤 Pushing to GitHub...")).when(
            n % 3 == 1, F.concat(F.lit("  📊 In-Press 统计: +"), n, F.lit(" / -0"))).otherwise(F.lit("✅ Git commit 完成")))
        .when(n % 3 == 0, F.lit("fatal: no")).when(n % 3 == 1, F.concat(F.lit("📊 Issue 202604: +"), n))
        .otherwise(F.lit("ℹ️  没有变化需要提交"))
    )
    line = (
        F.when(kind == "view", F.when(F.col("value") > 300, F.lit("== 全自动更新 ==")).otherwise(F.lit("  ")))
        .when(kind == "click", F.lit("📊 S3 文件列表:"))
        .when(kind == "signup", F.concat(F.lit("   - page_"), F.floor(n / 3), F.lit(".html")))
        .when(kind == "purchase", F.lit("📋 生成的文件:")).otherwise(error)
    )
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("file"), n.alias("line_no"), line.alias("line")
    )


@query(f"""
with {LOG_LINES},
e as (select *, starts_with(trim(line), '-') as is_item, case when event_type = 'click' then line_no
    when trim(line) = '' or contains(line, '📌') then -1 end as ev from run),
f as (select *, last_value(ev ignore nulls) over (partition by file order by line_no rows between unbounded preceding
    and current row) as head from e),
i as (select *, max(head) over (partition by file) as last_head from f where is_item and head >= 0)
select file, line_no, trim(line)[3:] as item from i where head = last_head
""")
def log_listed_files(spark, folder):
    return runlog.listed_files(_log(spark, folder), span=1000)


@query(f"""
with {LOG_LINES},
s as (select file, bool_or(contains(line, '成功处理:')) as ok, min_by(regexp_extract(line, '成功处理: (\\d+) 个文件', 1), line_no)
    filter (contains(line, '成功处理:')) as n, bool_or(contains(line, 'Pushing')) as pushed,
    bool_or(contains(line, 'fatal:')) as fatal, bool_or(contains(line, 'Git commit')) as done,
    bool_or(contains(line, '没有变化需要提交')) as same from run group by 1)
select file, case when ok then 'processed' else 'check' end as status, cast(n as int) as processed,
  case when done then 'committed' when same then 'no_change' end as commit,
  case when pushed then case when fatal then 'failed' else 'check' end end as push from s
""")
def log_run_status(spark, folder):
    return runlog.scan(_log(spark, folder), span=1000).facts


@query(f"""
with {LOG_LINES},
e as (select *, starts_with(trim(line), '-') as is_item, case when event_type = 'purchase' then line_no
    when trim(line) = '' or starts_with(trim(line), '✅') then -1 end as ev from run),
f as (select *, last_value(ev ignore nulls) over (partition by file order by line_no rows between unbounded preceding
    and current row) as head from e),
n as (select file, line_no, trim(trim(line)[3:]) as name from f where is_item and head >= 0
  union all select file, line_no, string_split(trim(string_split(line, '已生成:')[2]), ' ')[1] from f
    where contains(line, '已生成:'))
select file, name, min(line_no) as line_no from n where ends_with(name, '.html') group by 1, 2
""")
def log_updated_html(spark, folder):
    return runlog.updated_html(_log(spark, folder), span=1000)


@query(f"""
with {LOG_LINES},
e as (select *, trim(line) as t, starts_with(trim(line), '-') as is_item from run),
v as (select *, case when event_type = 'click' then line_no when t = '' or contains(line, '📌') then -1 end as e1,
    case when line = '已处理的文件:' then line_no when t = '' then -1 end as e3,
    case when event_type = 'purchase' then line_no when t = '' or starts_with(t, '✅') then -1 end as e4 from e),
f as (select *, last_value(e1 ignore nulls) over w as h1, last_value(e3 ignore nulls) over w as h3,
    last_value(e4 ignore nulls) over w as h4 from v window w as (partition by file order by line_no
    rows between unbounded preceding and current row)),
l as (select file, line_no, t[3:] as item, h1, max(h1) over (partition by file) as last from f where is_item and h1 >= 0),
s as (select file, bool_or(contains(line, '成功处理:')) as ok, min_by(regexp_extract(line, '成功处理: (\\d+) 个文件', 1), line_no)
    filter (contains(line, '成功处理:')) as n, bool_or(contains(line, 'Pushing')) as pushed,
    bool_or(contains(line, 'fatal:')) as fatal, bool_or(contains(line, 'Git commit')) as done,
    bool_or(contains(line, '没有变化需要提交')) as same from run group by 1),
h as (select file, line_no, trim(t[3:]) as name from f where is_item and h4 >= 0
  union all select file, line_no, string_split(trim(string_split(line, '已生成:')[2]), ' ')[1] from f where contains(line, '已生成:'))
select file, 1 as part, line_no, item from l where h1 = last
union all select file, 2, 0, case when ok then 'processed ' || n else 'check' end from s
union all select file, 3, line_no, t[3:] from f where is_item and h3 >= 0 and file in (select file from s where ok)
union all select file, 4, min(line_no), name from h where ends_with(name, '.html') group by file, name
union all select file, 5, line_no, t from f where starts_with(t, '📊 In-Press 统计:') or starts_with(t, '📊 Issue ')
union all select file, 6, 0, concat_ws(', ', case when done then 'commit committed' when same then 'commit no_change' end,
  case when pushed then case when fatal then 'push failed' else 'push check' end end) from s where pushed or done or same
""")
def log_summary(spark, folder):
    return runlog.summary_lines(_log(spark, folder), span=1000)


@query("""
with b as (select 'batch_' || user_id || '.xlsx' as filename, cast(floor(value) as bigint) as size_bytes, event_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, event_type from events),
s as (select filename, max_by(case when event_type = 'error' then -1 else size_bytes end, event_id) as stored from b
  where event_type in ('view', 'error') group by 1)
select filename, size_bytes, ts, nullif(stored, -1) as stored from b left join s using (filename) where event_type = 'click'
""")
def listing_and_state(spark, folder):
    """Text listings and state logs of an object store, written from the events."""
    events = table(spark, folder, "events").withColumn("name", F.concat(F.lit("batch_"), F.col("user_id"), F.lit(".xlsx")))
    kind, size = F.col("event_type"), F.floor("value")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    listed = (
        F.when(kind == "click", F.concat_ws("   ", stamp, size, "name"))
        .when(kind == "signup", F.concat_ws(" ", stamp, size, F.lit("notes.txt"))).otherwise(F.lit("PRE folder/"))
    )
    logged = (
        F.when(kind == "view", F.concat_ws(" ", "name", size, F.lit("# Processed at"), stamp))
        .when(kind == "error", F.concat_ws(" ", "name", F.lit("# Processed at"), stamp))
        .when(kind == "click", F.lit("# comment")).otherwise(F.lit(" "))
    )
    listing = parse_listing(events.select(listed.alias("value")))
    state = parse_state(events.select(F.col("event_id").alias("line_no"), logged.alias("line")))
    joined = listing.join(state.withColumnRenamed("size_bytes", "stored"), "filename", "left")
    return joined.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query("""
select distinct strftime(o_orderdate, '%Y%m') as issue_key, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as issue
from orders where o_orderstatus <> 'P'
""")
def issue_keys_of_paths(spark, folder):
    name = F.concat(F.lit("out/html/"), F.date_format("o_orderdate", "yyyyMM"),
                    F.when(F.col("o_orderstatus") == "P", F.lit("x.html")).otherwise(F.lit(".html")))
    return scan_issue_keys(table(spark, folder, "orders").select(name.alias("path")))


@query("""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line,
    unnest(range(0, len(string_split(text, chr(10))))) as line_no from documents)
select doc_id, line_no, md5(line) as line from l
""")
def document_lines(spark, folder):
    lines = number_lines(table(spark, folder, "documents"), "doc_id", "text")
    return lines.select("doc_id", "line_no", F.md5("line").alias("line"))


# --- streaming runs to completion ------------------------------------------


def _stream(spark, folder, name):
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def _arrivals(parts, base, run):
    """Run a stream after each part has arrived, as daily runs do: the stream reads the files of all parts so far once."""
    for i, part in enumerate(parts):
        part.write.parquet(f"{base}/in/{i}")
        run(part.sparkSession.readStream.schema(parts[0].schema).parquet(f"{base}/in/*"), i)


# the older orders, the newer ones (which share an issue), and the issues of 1995 once more
UPSERT_PARTS = ("o_orderdate < '1998-01-15'", "o_orderdate >= '1998-01-15'", "year(o_orderdate) = 1995 and o_orderstatus = 'F'")


@query(f"""
with o as (select 'Order of ' || o_orderpriority as t, o_custkey as u, strftime(o_orderdate, '%Y%m') as k, o_orderkey as seq, * from orders),
b0 as (select t, u, k, seq from o where {UPSERT_PARTS[0]}),
b1 as (select t, u, k, seq from o where {UPSERT_PARTS[1]}),
b2 as (select 'Revised o' || substr(t, 2), u, k, seq from o where {UPSERT_PARTS[2]}),
c0 as (select * from b0 qualify row_number() over (partition by t, u order by seq desc) = 1),
m1 as (select *, 0 as g from c0 where k not in (select k from b1) union all select *, 1 from b1),
c1 as (select t, u, k, seq from m1 qualify row_number() over (partition by t, u order by g desc, seq desc) = 1),
m2 as (select *, 0 as g from c1 where k not in (select k from b2) union all select *, 1 from b2),
c2 as (select t, u, k, seq from m2 qualify row_number() over (partition by t, u order by g desc, seq desc) = 1)
select t as "Title", u as "URL", k as "IssueKey", seq as ingest_seq from c2
""")
def stream_upsert(spark, folder):
    """Three batches, the log folded after the second, and some issues replaced by the third."""
    base = scratch_path(spark, "stream-upsert")
    orders = table(spark, folder, "orders")
    rows = [orders.filter(p).select(
        F.concat(F.lit("Revised order of " if i == 2 else "Order of "), "o_orderpriority").alias("Title"),
        F.col("o_custkey").alias("URL"), F.date_format("o_orderdate", "yyyyMM").alias("IssueKey"), F.col("o_orderkey").alias("ingest_seq"))
        for i, p in enumerate(UPSERT_PARTS)]

    def run(stream, i):
        ingest.stream_upsert(stream, f"{base}/catalog", f"{base}/checkpoint")
        if i == 1:
            ingest.fold(spark, f"{base}/catalog", rows[0].schema)

    _arrivals(rows, base, run)
    return ingest.upserted(spark, f"{base}/catalog", rows[0].schema)


@query("""
select user_id, event_type, event_id from events where user_id not in (select o_custkey from orders where o_orderstatus = 'F')
""")
def stream_skip_seen(spark, folder):
    base = scratch_path(spark, "stream-seen")
    # keys handled before the stream starts: generation -1 of the seen table
    known = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key"))
    ingest.write_seen(known, f"{base}/seen", -1)
    rows = _stream(spark, folder, "events").select("user_id", "event_type", "event_id")
    out = ingest.stream_skip_seen(rows, "user_id", f"{base}/seen", f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{out}/*")


@query("select user_id, event_type from events group by 1, 2")
def stream_dedupe(spark, folder):
    base = scratch_path(spark, "stream-dedupe")
    rows = _stream(spark, folder, "events").select("user_id", "event_type")
    return spark.read.parquet(ingest.stream_distinct(rows, ["user_id", "event_type"], f"{base}/out", f"{base}/checkpoint"))


@query("""
with m as (select 'batch_' || user_id || '.xlsx' as f, cast(floor(value) as bigint) as s, ts, user_id,
  case when ts < timestamp '2024-01-11' then 0 when ts < timestamp '2024-01-21' then 1 else 2 end as g from events where value is not null),
listed as (select n.g, f, max_by(s, (ts, s)) as s, max(ts) as ts from m, (select unnest([0, 1, 2]) as g) n where m.g <= n.g group by n.g, f),
l0 as (select * from listed where g = 0),
c0 as (select 0 as gen, f, s, null::bigint as old, 'new' as change, true as done from l0),
s0 as (select f, s from c0 where done),
c1 as (select 1 as gen, l.f, l.s, s0.s as old, case when s0.f is null then 'new' else 'changed' end as change,
  l.s % 2 = 0 as done from listed l left join s0 on s0.f = l.f where l.g = 1 and (s0.f is null or (s0.s <> 0 and s0.s <> l.s))),
s1 as (select s0.f, coalesce(c.s, s0.s) as s from s0 left join c1 c on c.f = s0.f and c.done
  union all select f, s from c1 where done and f not in (select f from s0)),
c2 as (select 2 as gen, l.f, l.s, s1.s as old, case when s1.f is null then 'new' else 'changed' end as change, true as done
  from listed l left join s1 on s1.f = l.f where l.g = 2 and (s1.f is null or (s1.s <> 0 and s1.s <> l.s)))
select gen, f as filename, s as size_bytes, old as old_size, change, done from (from c0 union all from c1 union all from c2)
""")
def stream_reupload(spark, folder):
    """Changes of three runs; in the second one, files of an odd size fail and stay due."""
    base = scratch_path(spark, "stream-reupload")
    rows = table(spark, folder, "events").filter("value is not null").select(
        F.concat(F.lit("batch_"), "user_id", F.lit(".xlsx")).alias("filename"), F.floor("value").alias("size_bytes"),
        F.col("ts").cast("timestamp").alias("ts"))
    days = ("ts < '2024-01-11'", "ts >= '2024-01-11' and ts < '2024-01-21'", "ts >= '2024-01-21'")

    def process(changes, batch_id):
        return changes.filter("size_bytes % 2 = 0") if batch_id == 1 else changes

    _arrivals([rows.filter(d) for d in days], base,
              lambda stream, i: ingest.stream_reuploads(stream, f"{base}/files", f"{base}/checkpoint", process))
    return ingest.detected_changes(spark, f"{base}/files").select("gen", "filename", "size_bytes", "old_size", "change", "done")



