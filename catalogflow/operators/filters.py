"""Predicates, classification and row filters."""

from pyspark.sql import functions as F

from ..functions.dates import moment_like, shift_days, shift_months
from ..functions.nulls import NO_ABSTRACT, col, differs, is_missing, matches
from ..functions.text import OPEN_LABEL, strip

# fixed values: patterns of the exchanged data
IN_PRESS = r"(?iU)in[\s-]?press"
RESEARCH = r"(?i)research"
COLUMN_TITLES = r"(?i)mapping matters|gis tips"
ARTICLE_HEADINGS = ("Article", "Original", "Columns")
NOT_ARTICLES = "In-Press Articles"


def classify(category, rule="pattern"):
    """``in_press`` / ``research`` / ``other`` of a category text.

    ``pattern``: in-press by its spelling, then research; the rest is ``other``.
    ``not_research``: whatever does not name research counts as in-press.
    """
    research = matches(category, RESEARCH)
    if rule == "not_research":
        return F.when(research, F.lit("research")).otherwise(F.lit("in_press"))
    return (
        F.when(matches(category, IN_PRESS), F.lit("in_press"))
        .when(research, F.lit("research"))
        .otherwise(F.lit("other"))
    )


def classify_category(df, category, out="class", rule="pattern"):
    return df.withColumn(out, classify(category, rule))


def drop_missing(df, columns):
    for c in columns:
        df = df.filter(~is_missing(c))
    return df


def drop_no_abstract(df, abstract, mode="exact"):
    """Null abstracts stay, in both modes."""
    if mode == "exact":
        return df.filter(differs(abstract, NO_ABSTRACT))
    return df.filter(~matches(abstract, r"(?i)no abstract"))


def drop_column_titles(df, title, pattern=COLUMN_TITLES):
    return df.filter(~matches(title, pattern))


def recent(df, date, as_of, months=6):
    return df.filter(col(date) >= moment_like(df, date, shift_months(as_of, -months)))


def recent_days(df, date, as_of, days=730):
    if days is None:
        return df.filter(col(date).isNotNull())
    return df.filter(col(date) >= moment_like(df, date, shift_days(as_of, -days)))


def is_full_access(date, as_of, months=12):
    return col(date) <= F.lit(shift_months(as_of, -months))


def says_open(access):
    text = F.lower(strip(access))
    return F.coalesce(F.contains(text, F.lit("open access")) | (text == "oa"), F.lit(False))


def is_open_access(access, override=None):
    """Open by its own access text, else by the override flag column."""
    if override is None:
        return says_open(access)
    return says_open(access) | F.coalesce(col(override), F.lit(False))


def split_access(df, access, label=OPEN_LABEL):
    """Two tables: exact open label, and everything else (null included)."""
    is_open = col(access).eqNullSafe(F.lit(label))
    return df.filter(is_open), df.filter(~is_open)


def pending(df, metric, order, n=3):
    return df.filter(col(metric).isNull()).orderBy(*order).limit(n)


def retention(df, ts, as_of, days=7):
    return df.filter(col(ts) >= moment_like(df, ts, shift_days(as_of, -days)))


def require_columns(df, columns):
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def add_missing_columns(df, schema):
    """Add absent columns of a declared schema as typed nulls."""
    new = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(new) if new else df


def section_is_article(heading, words=ARTICLE_HEADINGS, excluded=NOT_ARTICLES):
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(col(heading), F.lit(word))
    return F.coalesce(hit & (col(heading) != excluded), F.lit(False))


def open_issues(df, issue_key, done, done_key="key"):
    """Rows whose issue key is not blank and not yet done."""
    keyed = df.filter(F.coalesce(col(issue_key), F.lit("")) != "")
    return keyed.join(
        done.select(F.col(done_key).alias("_done")).distinct(), F.col(issue_key) == F.col("_done"), "left_anti"
    )
