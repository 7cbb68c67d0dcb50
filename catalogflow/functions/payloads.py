"""JSON payloads and JSON inside free text."""

from pyspark.sql import functions as F

from .nulls import col

# fixed values: payload shapes
ENTRY_COUNTS = "`search-results` struct<entry: array<struct<`citedby-count`: string>>>"
INLINE_COUNTS = "scholar_results array<struct<inline_links: struct<cited_by: struct<total: string>>>>"
CITED_TOTAL = r"^Cited by\s*(\d+)\s*$"
JSON_ARRAY = r"(?s)\[.*\]"
ARTICLE_LIST = "array<struct<Title: string, Authors: string>>"


def entry_count(payload):
    """Count of the first entry, 0 when there is none or it is malformed."""
    parsed = F.from_json(col(payload), ENTRY_COUNTS)
    first = F.get(parsed["search-results"]["entry"], F.lit(0))["citedby-count"]
    return F.coalesce(first.try_cast("int"), F.lit(0))


def inline_count(payload):
    """Count in the ``Cited by n`` text of the first result, else null."""
    parsed = F.from_json(col(payload), INLINE_COUNTS)
    total = F.get(parsed["scholar_results"], F.lit(0))["inline_links"]["cited_by"]["total"]
    return F.regexp_extract(total, CITED_TOTAL, 1).try_cast("int")


def json_articles(text, mode="permissive"):
    """Array of (Title, Authors) from the outermost ``[...]`` of a text."""
    found = F.regexp_extract(col(text), JSON_ARRAY, 0)
    parsed = F.when(found != "", F.from_json(found, ARTICLE_LIST))
    if mode == "failfast":
        return F.coalesce(parsed, F.raise_error(F.lit("no valid JSON array in text")).cast(ARTICLE_LIST))
    return parsed


def parse_payloads(df, column, kind="entry", out="citations"):
    """Add the citation count held in a JSON payload column."""
    rule = {"entry": entry_count, "inline": inline_count}[kind]
    return df.withColumn(out, rule(column))


def explode_articles(df, column, mode="permissive"):
    rows = df.withColumn("_a", F.explode_outer(json_articles(column, mode))).filter("_a is not null")
    return rows.select(*[c for c in df.columns if c != column], "_a.Title", "_a.Authors")
