"""Aggregates, sorts, top-k views and positions."""

from pyspark.sql import functions as F

from ..functions.dates import pub_date
from ..functions.nulls import col
from .dedupe import dedupe_best
from .filters import drop_missing, drop_no_abstract, is_full_access
from .ordered import running_index


def count_by(df, column, out="n"):
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(out))


def per_month(df, date, n=6):
    """Articles per month, newest first."""
    months = df.groupBy(F.date_format(col(date), "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return months.orderBy(F.col("month").desc()).limit(n)


def issue_members(df, issue_key, seq, first=()):
    """Members per issue, with the given columns of its first row."""
    picks = [F.min_by(c, seq).alias(f"first_{c}") for c in first]
    return df.groupBy(issue_key).agg(F.count(F.lit(1)).alias("members"), *picks)


def issue_count(df, issue_key):
    return df.select(issue_key).distinct().agg(F.count(F.lit(1)).alias("issues"))


def metric_summary(df, metric, date, doi):
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(metric), F.lit(0)).cast("bigint").alias("total"),
        F.count_if(col(metric) > 0).alias("with_metric"),
        F.date_format(F.min(date), "yyyy-MM").alias("first_month"),
        F.date_format(F.max(date), "yyyy-MM").alias("last_month"),
        F.count(doi).alias("with_doi"),
    )


def latest_issue(df, year, issue):
    """One row with the largest (year, issue)."""
    top = F.max(F.struct(col(year).alias("year"), col(issue).alias("issue")))
    return df.agg(top.alias("latest")).select("latest.year", "latest.issue")


def access_counts(df, access, group=()):
    return df.groupBy(*group).agg(
        F.count_if(col(access).eqNullSafe("OA")).alias("open_rows"),
        F.count_if(~col(access).eqNullSafe("OA")).alias("member_rows"),
    )


def run_outcomes(df, ok, group=()):
    """Success and failure counts; the names stay in the table itself."""
    return df.groupBy(*group).agg(
        F.count_if(col(ok)).alias("succeeded"),
        F.count_if(~F.coalesce(col(ok), F.lit(False))).alias("failed"),
    )


def by_date(df, date, *ties):
    return df.orderBy(F.col(date).desc_nulls_last(), *ties)


def by_metric(df, metric, *ties):
    filled = df.withColumn(metric, F.coalesce(F.col(metric), F.lit(0)).cast("int"))
    return filled.orderBy(F.col(metric).desc(), *ties)


def top_by(df, metric, n, *ties):
    """Sort and limit in one step (Spark keeps n rows per task)."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *ties).limit(n)


def top_articles(df, metric, abstract, n, *ties):
    return top_by(drop_no_abstract(df, abstract), metric, n, *ties)


def usage_ranking(df, key, metric, ties, n=20):
    """Best row per key, then the n best keys."""
    best = dedupe_best(df.withColumn(metric, F.col(metric).cast("int")), [key], metric, ties)
    return top_by(best, metric, n, *ties)


def two_step_top(df, metric, authors, abstract, ties, pool=20, n=6, filter_first=False):
    """Top ``n`` after cleaning a pool of the ``pool`` best rows.

    Cleaning after the first cut can leave fewer than ``n`` rows although more
    good ones exist; ``filter_first`` cleans before any cut.
    """
    if filter_first:
        return top_by(_clean(df, authors, abstract), metric, n, *ties)
    cut = top_by(df, metric, pool, *ties)
    return top_by(_clean(cut, authors, abstract), metric, n, *ties)


def _clean(df, authors, abstract):
    return drop_no_abstract(drop_missing(df, [authors]), abstract)


def group_position(df, group, seq, out="pos", span=None):
    """Position inside the group, and a flag for its first row."""
    numbered = running_index(df, group, seq, out, **({"span": span} if span else {}))
    return numbered.withColumn("is_first", F.col(out) == 1)


def access_flag(df, year, issue, issue_day, latest, as_of):
    """``NEW`` for the latest issue, ``Full access`` for old ones, else blank.

    ``latest`` is the one-row table of ``latest_issue``; it is read as a scalar.
    """
    newest = latest.select(F.col("year") * 100 + F.col("issue")).scalar()
    flag = (
        F.when(col(year) * 100 + col(issue) == newest, F.lit("NEW"))
        .when(is_full_access(issue_day, as_of), F.lit("Full access"))
        .otherwise(F.lit(""))
    )
    return df.withColumn("access_flag", flag)


def fill_pub_date(df, published, issue_day):
    """Fill missing publication texts from the issue day."""
    return df.withColumn(published, F.coalesce(F.col(published), pub_date(issue_day)))
