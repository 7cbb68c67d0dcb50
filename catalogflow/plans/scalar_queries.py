"""Queries for the scalar operators: text, numbers, dates, payloads."""

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import payloads as P
from ..functions import text as S
from .registry import query, table


@query("""
with v as (
  select page_id, case page_id % 5
      when 0 then 'https://doi.org/' || regexp_replace(url, '^https?://', '') || '//'
      when 1 then ' DOI: ' || url
      when 2 then 'http://dx.doi.org/' || regexp_replace(url, '^https?://', '')
      when 3 then null
      else regexp_replace(url, '^https?://', '') || ';jsessionid=ab' || page_id || '.x?format=1' end as raw
  from pages),
n as (select page_id, raw, coalesce(regexp_replace(trim(regexp_replace(trim(raw),
      '^(?:https?://(?:dx\\.)?doi\\.org/|doi\\.org/|doi:)\\s*', '', 'i')), '/+$', ''), '') as doi from v)
select page_id, doi, case when doi = '' then '' else 'https://doi.org/' || doi end as doi_url,
  case when contains(raw, 'doi.org') then trim(regexp_extract(raw, '^.*doi\\.org/(.*)$', 1)) end as extracted,
  regexp_replace(raw, ';jsessionid=[^/?#]*', '', 'g') as bare_url,
  replace(replace(raw, '"', ''), '''', '') as lookup
from n
""")
def norm_identifier(spark, folder):
    rest = F.regexp_replace("url", "^https?://", "")
    kind = F.col("page_id") % 5
    raw = (
        F.when(kind == 0, F.concat(F.lit("https://doi.org/"), rest, F.lit("//")))
        .when(kind == 1, F.concat(F.lit(" DOI: "), "url"))
        .when(kind == 2, F.concat(F.lit("http://dx.doi.org/"), rest))
        .when(kind == 4, F.concat(rest, F.lit(";jsessionid=ab"), F.col("page_id"), F.lit(".x?format=1")))
    )
    return table(spark, folder, "pages").withColumn("raw", raw).select(
        "page_id",
        S.normalize_doi("raw").alias("doi"),
        S.doi_url("raw").alias("doi_url"),
        S.extract_doi("raw").alias("extracted"),
        S.strip_session("raw").alias("bare_url"),
        S.clean_query_title("raw").alias("lookup"),
    )


@query("""
with v as (select doc_id, source || ' 12; ' || lang || ' 3, ' || text || '; ; ' || doc_id as raw from documents),
c as (select doc_id, raw, trim(regexp_replace(regexp_replace(regexp_replace(raw, '\\s*\\d+\\s*[;,]', ';', 'g'),
        '\\s*\\d+\\s*$', '', 'g'), ';;+', ';', 'g')) as cleaned from v),
l as (select doc_id, list_filter(list_transform(string_split(regexp_replace(raw, '\\b\\d+\\b', '', 'g'), ';'),
        lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') as names from v)
select doc_id, md5(regexp_replace(cleaned, '^\\s+|\\s+$', '', 'g')) as authors,
  md5(array_to_string(names, '; ')) as linked, md5(array_to_string(names, ' | ')) as joined,
  cast(len(names) as int) as n_names
from c join l using (doc_id)
""")
def norm_contributors(spark, folder):
    raw = F.concat("source", F.lit(" 12; "), "lang", F.lit(" 3, "), "text", F.lit("; ; "), F.col("doc_id"))
    names = S.author_names(F.regexp_replace("raw", r"(?U)\b\d+\b", ""))
    return table(spark, folder, "documents").withColumn("raw", raw).select(
        "doc_id",
        F.md5(S.clean_authors("raw")).alias("authors"),
        F.md5(S.clean_author_links("raw")).alias("linked"),
        F.md5(S.join_names(names, " | ")).alias("joined"),
        F.size(names).alias("n_names"),
    )


@query("""
with v as (select doc_id, '"' || text || ' ""' || source || '"" "' as title from documents)
select doc_id,
  md5(lower(trim(regexp_replace(title, '\\s+', ' ', 'g')))) as normal,
  md5(lower(trim(regexp_replace(replace(title, '"', ''), '\\s+', ' ', 'g')))) as match_key,
  md5(regexp_replace(replace(title, '"', ''), '^\\s+|\\s+$', '', 'g')) as display,
  md5(regexp_replace(translate(title, chr(10) || chr(13), ' '), '^\\s+|\\s+$', '', 'g')) as flat
from v
""")
def norm_title_variants(spark, folder):
    title = F.concat(F.lit('"'), "text", F.lit(' ""'), "source", F.lit('"" "'))
    return table(spark, folder, "documents").withColumn("title", title).select(
        "doc_id",
        F.md5(S.normalize_title("title")).alias("normal"),
        F.md5(S.clean_title("title")).alias("match_key"),
        F.md5(S.strip_quotes("title")).alias("display"),
        F.md5(S.flatten_text("title")).alias("flat"),
    )


@query("""
select doc_id, md5(lower(trim(regexp_replace(regexp_replace(strip_accents(text), '[^\\p{L}\\p{N}_\\s]', '', 'g'),
  '\\s+', ' ', 'g')))) as folded
from documents
""")
def fold_title_unicode(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.md5(S.normalize_string("text")).alias("folded"))


@query("""
with v as (select *, o_orderstatus = 'P' as in_press, cast(floor(o_totalprice * 10) as bigint) as size_bytes,
  ['a' || o_custkey, 'b' || o_orderstatus, 'c' || o_orderpriority, 'd' || o_orderkey] as names from orders)
select o_orderkey,
  case when in_press then strftime(o_orderdate, '%B ') || day(o_orderdate) || strftime(o_orderdate, ', %Y')
       else 'pp. ' || o_custkey || '-' || o_orderkey end as page_label,
  case when o_orderstatus = 'O' then 'Open Access content' else 'Subscribed content' end as access,
  o_orderpriority[1:4] || '...' as short_name,
  printf('%.1f', size_bytes / 1024.0) || 'KB' as size_label,
  array_to_string(names[1:3], ', ') || ' and 1 more' as summary,
  strftime(o_orderdate, '%B %Y') as pub_date, strftime(o_orderdate, '%b') as month_abbr,
  strftime(o_orderdate, '%B') as month_word
from v
""")
def labels_pages_access(spark, folder):
    orders = table(spark, folder, "orders").withColumns({
        "in_press": F.col("o_orderstatus") == "P",
        "pages": F.concat(F.col("o_custkey"), F.lit("-"), F.col("o_orderkey")),
        "status": F.when(F.col("o_orderstatus") == "O", "OA").when(F.col("o_orderstatus") == "F", "SUB"),
        "size_bytes": F.floor(F.col("o_totalprice") * 10),
        "names": F.array(*[
            F.concat(F.lit(p), F.col(c)) for p, c in
            (("a", "o_custkey"), ("b", "o_orderstatus"), ("c", "o_orderpriority"), ("d", "o_orderkey"))
        ]),
    })
    return orders.select(
        "o_orderkey",
        S.page_label("in_press", "o_orderdate", "pages").alias("page_label"),
        S.access_label("status").alias("access"),
        S.shorten("o_orderpriority", 4).alias("short_name"),
        S.size_kb("size_bytes").alias("size_label"),
        S.summarise_list("names").alias("summary"),
        D.pub_date("o_orderdate").alias("pub_date"),
        D.month_abbreviation("o_orderdate").alias("month_abbr"),
        D.month_word(D.pub_date("o_orderdate")).alias("month_word"),
    )


@query("""
with refs as (select page_id, url, unnest(regexp_extract_all(html, '<a[^>]+href=["'']([^"'']+)["'']', 1)) as href
  from pages),
u as (select page_id, url, href, row_number() over (partition by page_id order by href) as k from refs)
select page_id, href, count(*) as n,
  'html' || href as parent_path, 'img' || href as own_path, 'https://base.example' || href as absolute,
  case when contains(url, '/en/') then regexp_replace(url, '/[^/]*$', '')
       else 'https://base.example/' || (2000 + page_id % 24) || '/000000' || (66 + page_id % 24) || '/000000'
            || lpad(cast(1 + page_id % 12 as varchar), 2, '0') end as issue_url,
  case when page_id % 3 = 0 then 'img/2020/04/' || page_id || 'x.png' end as asset_path,
  case page_id % 3 when 0 then 'ok' when 1 then 'bad' else 'none' end as asset_status
from u group by all
""")
def asset_paths(spark, folder):
    pages = table(spark, folder, "pages")
    refs = pages.select("page_id", "url", F.explode(S.image_sources("html", "a", "href")).alias("href"))
    share = (
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://share.example/d/"), F.col("page_id"), F.lit("x/view")))
        .when(F.col("page_id") % 3 == 1, F.lit("https://share.example/none"))
    )
    known = "https://files.example/main/"
    key = F.format_string("%d%02d", 2000 + F.col("page_id") % 24, 1 + F.col("page_id") % 12)
    rows = refs.withColumns({
        "up": F.concat(F.lit("./x/../.."), "href"),
        "stored": F.concat(F.lit(known + "img"), "href"),
        "share": share, "key": key, "year": F.lit("2020"), "issue": F.lit("04"),
    })
    return rows.select(
        "page_id", "href",
        S.resolve_asset_path("up", "html/pages").alias("parent_path"),
        S.resolve_asset_path("stored", "html", [known]).alias("own_path"),
        S.absolute_url("https://base.example", "href").alias("absolute"),
        S.issue_url("url", "key", "/en/", "https://base.example").alias("issue_url"),
        S.asset_path("share", "year", "issue").alias("asset_path"),
        S.asset_status("share").alias("asset_status"),
    ).groupBy("page_id", "href", "parent_path", "own_path", "absolute", "issue_url", "asset_path", "asset_status").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
select o_orderkey,
  case o_orderkey % 4 when 0 then cast(o_custkey as varchar) when 1 then cast(o_custkey as varchar)
    when 2 then 'vol ' || o_custkey else cast(o_custkey as varchar) end as volume,
  case o_orderkey % 4 when 0 then lpad(cast(o_orderkey % 13 as varchar), 2, '0')
    when 1 then lpad(cast(o_orderkey % 13 as varchar), 2, '0') when 2 then 'S' || (o_orderkey % 13) else '' end as issue,
  case o_orderkey % 4 when 2 then 'y' || year(o_orderdate) when 3 then ''
    else cast(year(o_orderdate) as varchar) end as year_text,
  cast(year(o_orderdate) - 1934 as int) as volume_of_year,
  case o_orderkey % 4 when 0 then cast(o_orderkey % 13 as varchar) when 1 then cast(o_orderkey % 13 as varchar)
    when 2 then 'S' || (o_orderkey % 13) else '0' end as issue_display,
  cast(year(o_orderdate) * 1000 + dayofyear(o_orderdate) as int) as day_seed
from orders
""")
def volume_issue_numbers(spark, folder):
    kind, number = F.col("o_orderkey") % 4, F.col("o_orderkey") % 13
    year = F.year("o_orderdate")
    rows = table(spark, folder, "orders").withColumns({
        "v": F.when(kind == 0, F.concat("o_custkey", F.lit(".0"))).when(kind == 1, F.concat(F.lit(" "), "o_custkey"))
        .when(kind == 2, F.concat(F.lit(" vol "), "o_custkey")).otherwise(F.col("o_custkey").cast("string")),
        "i": F.when(kind == 0, F.concat(number, F.lit(".0"))).when(kind == 1, number.cast("string"))
        .when(kind == 2, F.concat(F.lit("S"), number)),
        "y": F.when(kind == 0, F.concat(year, F.lit(".0"))).when(kind == 1, year.cast("string"))
        .when(kind == 2, F.concat(F.lit("y"), year)),
    })
    issue = D.normalize_issue("i")
    return rows.select(
        "o_orderkey",
        D.normalize_volume("v").alias("volume"),
        issue.alias("issue"),
        D.normalize_year("y").alias("year_text"),
        D.volume_of_year(year).alias("volume_of_year"),
        D.issue_display(issue).alias("issue_display"),
        D.day_seed("o_orderdate").alias("day_seed"),
    )


@query("""
with v as (select o_orderkey, strftime(o_orderdate, '%Y') as y, month(o_orderdate) as m from orders)
select o_orderkey, y || lpad(cast(m as varchar), 2, '0') as issue_key,
  case o_orderkey % 7 when 5 then 'abc ' || m when 6 then '' else y || lpad(cast(m as varchar), 2, '0') end as repaired
from v
""")
def issue_key_repair(spark, folder):
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    key = D.issue_key("y", "m")
    kind = F.col("o_orderkey") % 7
    drifted = (
        F.when(kind == 0, key)
        .when(kind == 1, F.concat(key, F.lit(".0")))
        .when(kind == 2, F.concat(key, F.lit(".000")))
        .when(kind == 3, F.format_string("%d.%03d", year, month))
        .when(kind == 4, F.concat(F.lit("+"), key, F.lit(".")))
        .when(kind == 5, F.concat(F.lit(" abc "), month))
    )
    rows = table(spark, folder, "orders").withColumns({
        "y": D.year_of_date("o_orderdate"), "m": D.normalize_issue(month)
    })
    return rows.select("o_orderkey", key.alias("issue_key"), D.canonical_issue_key(drifted).alias("repaired"))


@query("""
with v as (select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, o_orderkey % 6 as k from orders)
select o_orderkey,
  case when k in (0, 1, 2) then y || lpad(cast(m as varchar), 2, '0')
       when k = 3 then y || '13' end as page_key,
  case when k in (0, 1, 2) then strftime(make_date(y, m, 1), '%Y-%m-%d') end as issue_date,
  case when k in (0, 4) then 'Unknown Date' when k = 3 then 'Unknown ' || y
       when k = 5 then 'Unknown Date' else strftime(make_date(y, m, 1), '%B %Y') end as url_date,
  case when k = 0 then strftime(make_date(y, m, 1), '%B %Y') when k = 4 then 'Spring' when k = 3 then 'Unknown ' || y
       when k = 5 then 'Unknown Date' else strftime(make_date(y, m, 1), '%B %Y') end as shown
from v
""")
def issue_date_resolve(spark, folder):
    year, month, kind = F.year("o_orderdate"), F.month("o_orderdate"), F.col("o_orderkey") % 6
    key = F.format_string("%d%02d", year, month)
    path = "https://host.example/content/xy/%d/%08d/%08d/art00001"
    rows = table(spark, folder, "orders").withColumns({
        # 0: key; 1: drifted key and link; 2: link; 3: link of issue 13; 4, 5: neither
        "key": F.when(kind == 0, key).when(kind == 1, F.concat(key, F.lit(".0"))),
        "link": F.when(kind.isin(1, 2), F.format_string(path, year, year - 1934, month))
        .when(kind == 3, F.format_string(path, year, year - 1934, F.lit(13))).otherwise(F.lit("https://doi.org/10.1/x")),
        "published": F.when(kind == 4, F.lit("Spring")).when(kind == 5, F.lit("N/A")),
    })
    day = D.issue_date("key", "link", host="host.example")
    return rows.select(
        "o_orderkey",
        D.page_issue_key("key", "link").alias("page_key"),
        F.date_format(day, "yyyy-MM-dd").alias("issue_date"),
        D.date_from_url("link").alias("url_date"),
        D.display_date("published", "link", day).alias("shown"),
    )


@query("""
select event_id, case event_type when 'view' then cast(json_extract_string(props, '$.k') as int)
    else 0 end as entry_count,
  case when event_type = 'signup' then cast(json_extract_string(props, '$.k') as int) end as inline_count,
  case when event_type = 'purchase' then 1 else 0 end as n_articles,
  case when event_type = 'purchase' then 'T' || json_extract_string(props, '$.k') end as first_title
from events
""")
def json_payload_counts(spark, folder):
    events = table(spark, folder, "events")
    k = F.get_json_object("props", "$.k")
    payload = (
        F.when(F.col("event_type") == "view", F.format_string('{"search-results":{"entry":[{"citedby-count":"%s"}]}}', k))
        .when(F.col("event_type") == "click", F.lit('{"search-results":{"entry":[]}}'))
        .when(
            F.col("event_type") == "signup",
            F.format_string('{"scholar_results":[{"inline_links":{"cited_by":{"total":"Cited by %s"}}}]}', k),
        )
        .when(F.col("event_type") == "purchase", F.format_string('Here:\n[{"Title": "T%s",\n "Authors": "A"}]\nDone', k))
        .otherwise(F.concat(F.lit("not json "), "props"))
    )
    rows = P.parse_payloads(events.withColumn("payload", payload), "payload", "entry", "entry_count")
    rows = P.parse_payloads(rows, "payload", "inline", "inline_count")
    found = P.json_articles("payload")
    is_list = F.col("event_type") == "purchase"
    return rows.select(
        "event_id", "entry_count", "inline_count",
        F.when(is_list, F.coalesce(F.size(found), F.lit(0))).otherwise(F.lit(0)).alias("n_articles"),
        F.when(is_list, F.get(found, F.lit(0))["Title"]).alias("first_title"),
    )
