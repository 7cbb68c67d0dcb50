"""The catalog's entry points as lazy plans over tables."""

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as S
from ..operators import dedupe, extraction, filters, incremental, joins, matching, ranking, rendering


def catalog_rows(raw, rule="pattern"):
    """Raw metadata rows to catalog rows, with their class."""
    day = F.col("Date MMDDYY")
    in_press = filters.classify("Article Category", rule) == "in_press"
    year, issue = D.year_of_date(day), D.normalize_issue("Issue Number")
    return raw.select(
        "Title",
        S.clean_authors("Authors").alias("Authors"),
        S.page_label(in_press, day, F.col("Page Numbers")).alias("Pages"),
        S.access_label("Access Status").alias("Access"),
        S.doi_url("DOI").alias("URL"),
        "Abstract",
        D.pub_date(day).alias("PubDate"),
        year.alias("Year"),
        D.normalize_volume("Volume").alias("Volume"),
        issue.alias("Issue"),
        D.issue_key(year, issue).alias("IssueKey"),
        F.col("Graphical Abstract").alias("GA_Link"),
        F.col("Article Category").alias("Category"),
        S.asset_path("Graphical Abstract", year, issue).alias("GA_Path"),
        filters.classify("Article Category", rule).alias("class"),
        *[c for c in ("ingest_seq", "file") if c in raw.columns],
    )


def changed_files(listing, state):
    """Work list of a daily run, oldest file first."""
    return incremental.detect_changes(listing, state)


def ingest_files(log, raw, changes):
    """Catalog log after all changed files, the oldest file first.

    ``raw`` holds the metadata rows of the files with their ``file`` name,
    ``changes`` the work list of ``changed_files``. Each file is one batch, its
    order is its time and name, and ``dedupe.catalog_from_batches`` of the
    result equals upserting the files one by one.
    """
    moment = F.concat_ws(" ", F.date_format("ts", "yyyyMMddHHmmss"), "filename")
    order = changes.select(F.col("filename").alias("_file"), moment.alias("gen"))
    rows = catalog_rows(raw).filter("class = 'research'").drop("class")
    batches = rows.join(order, F.col("file") == F.col("_file")).drop("file", "_file")
    return dedupe.union_all(log, batches)


def ingest_batch(catalog, raw, keys="all", in_press=None):
    """New catalog, in-press view and change counts of one metadata batch.

    ``changes`` counts research rows per issue; with the previous in-press view,
    ``in_press_changes`` is one row with what came, went and stands.
    """
    rows = catalog_rows(raw)
    research = rows.filter("class = 'research'").drop("class")
    out = {
        "catalog": dedupe.replace_issue(catalog, research, keys=keys),
        "in_press": rows.filter("class = 'in_press'").drop("class"),
        "changes": dedupe.diff_counts(
            research.withColumn("IssueKey", D.canonical_issue_key("IssueKey")),
            catalog.withColumn("IssueKey", D.canonical_issue_key("IssueKey")).join(
                research.select(D.canonical_issue_key("IssueKey").alias("_k")).distinct(),
                F.col("IssueKey") == F.col("_k"), "left_semi",
            ),
            group=("IssueKey",),
        ),
    }
    if in_press is not None:
        out["in_press_changes"] = dedupe.diff_counts(out["in_press"], in_press)
    return out


def issue_documents(catalog, metadata, choices, assets=None, base="", seq="ingest_seq", most=rendering.PART_BYTES, footer="<footer></footer>"):
    """The full page of each issue: one document per issue key, in parts cut by bytes.

    Articles by ``seq``, each with its access badge (own text, or declared open by any row of
    ``metadata``), the editors' choice badge (title among ``choices``) and
    its image (``GA_Path``; with ``assets``, a table of paths, only if it exists).
    """
    rows = joins.apply_overrides(catalog, joins.access_overrides(metadata), "Title", "Access")
    rows = joins.mark_members(rows, choices, "Title")
    if assets is not None:
        there = assets.select(F.col("path").alias("_path")).distinct()
        rows = rows.join(there, F.col("GA_Path") == F.col("_path"), "left").withColumn("GA_Path", F.col("_path")).drop("_path")
    info = F.concat(F.lit("Pages: "), F.coalesce("Pages", F.lit("")))
    page = rendering.article_fragment("Title", "URL", "Authors", "Abstract", info, "is_open", is_choice="is_choice", image="GA_Path")
    rows = rows.withColumns({"IssueKey": D.canonical_issue_key("IssueKey"), "fragment": page}).filter("IssueKey <> ''")
    header = rendering.issue_header("IssueKey", S.issue_url(F.lit("https://doi.org/x"), "IssueKey", "/content/", base))
    return rendering.issue_pages(rows, "IssueKey", seq, "fragment", header, footer, most)


def dated(catalog, host=None, strict=False, out="IssueDate"):
    return catalog.withColumn(out, D.issue_date("IssueKey", "URL", host=host, strict=strict))


def recent_view(catalog, as_of, months=6, host=None):
    """Recent articles, newest first, publication text filled in."""
    rows = filters.recent(dated(catalog, host, strict=True), "IssueDate", as_of, months)
    return ranking.by_date(ranking.fill_pub_date(rows, "PubDate", "IssueDate"), "IssueDate", "ingest_seq")


def most_cited_view(catalog, citations, as_of, days=730, n=None, host=None):
    """Articles of the last days with their citation counts, most cited first."""
    rows = filters.recent_days(dated(catalog, host), "IssueDate", as_of, days)
    rows = joins.attach_metric(rows.withColumn("DOI", S.extract_doi("URL")), citations, "DOI", "Title")
    if n is None:
        return rows.orderBy(F.desc("citations"), "ingest_seq")
    return ranking.top_articles(rows, "citations", "Abstract", n, "ingest_seq")


def most_downloaded_view(usage, details, metric="Total Downloads", n=6):
    """Usage report to the top articles: rank, fill details, clean, cut."""
    ranked = ranking.usage_ranking(usage, "DOI", metric, [F.col("Month"), F.col("`Item Title`")], 20)
    blank = ranked.withColumns({c: F.lit(None).cast("string") for c in ("Authors", "Abstract")})
    filled = joins.update_by_key(blank, details, "DOI", ["Authors", "Abstract"], ["Authors", "Abstract"])
    return ranking.two_step_top(filled, metric, "Authors", "Abstract", [F.col("DOI")], 20, n)


COLUMNS = ("Title", "Authors", "Pages", "Access", "URL", "Abstract")


def scraped_articles(toc_pages, article_pages, seen=None, base=""):
    """Issue pages and article pages to cleaned catalog rows.

    Skips issue pages seen before, takes each abstract from the page of the
    article's link, drops column titles and rows without authors or abstract,
    and keeps the first row of each title (by page link and position).
    """
    fresh = toc_pages if seen is None else joins.skip_seen(toc_pages, seen, "url")
    rows = extraction.extract_toc(fresh, base)
    details = extraction.extract_article(article_pages).select(F.col("page_url").alias("_url"), "Abstract")
    rows = rows.join(details, F.col("URL") == F.col("_url"), "left").drop("_url")
    rows = filters.drop_column_titles(rows, "Title")
    rows = filters.drop_no_abstract(filters.drop_missing(rows, ["Abstract", "Authors"]), "Abstract", "contains")
    return dedupe.dedupe_first(rows, ["Title"], ["page_url", "pos"]).select(*COLUMNS)


def in_press_articles(listing_pages, article_pages, catalog, base=""):
    """Fast-track items that are not yet issued, with authors and abstract."""
    items = extraction.extract_fast_track(listing_pages, base)
    kept = matching.exclude_issued(items, catalog, "Title")
    details = extraction.extract_article(article_pages).select(F.col("page_url").alias("_url"), "Authors", "Abstract")
    rows = kept.join(details, F.col("Link") == F.col("_url"), "left")
    rows = rows.select(
        "Title", "Authors", F.col("Date").alias("Pages"), F.col("Access Status").alias("Access"),
        F.col("Link").alias("URL"), "Abstract",
    )
    # newest first; dates that cannot be read go last
    dated_rows = filters.drop_no_abstract(rows, "Abstract").withColumn("_day", D.parse_online_date("Pages"))
    return ranking.by_date(dated_rows, "_day", "Title", "URL").drop("_day")
