"""Key joins. The looked-up side always has one row per key, so no join fans
out; Spark chooses broadcast or shuffle by measured size, and splits hot keys
of the large side (adaptive skew join)."""

from pyspark.sql import functions as F

from ..functions.nulls import col
from ..functions.text import normalize_title
from .dedupe import distinct_texts
from .filters import is_open_access


def _no_match_key(df):
    """A spread-out key for rows without one, so that they do not meet."""
    return F.concat(F.lit("none:"), F.xxhash64(*df.columns).cast("string"))


def attach_metric(df, metric, doi, title, metric_doi="doi", metric_title="title", value="citations",
                  out=None, default=0):
    """Left join of a metric by DOI, or by title for rows without a DOI.

    Both rules share one key column, so the large table is shuffled once.
    ``default=None`` keeps unmatched rows null (not fetched yet).
    """
    out = out or value
    wanted = (
        F.when(col(doi).isNotNull() & (col(doi) != ""), F.concat(F.lit("doi:"), col(doi)))
        .when(col(title).isNotNull(), F.concat(F.lit("title:"), col(title)))
        .otherwise(_no_match_key(df))
    )
    offered = F.array(
        F.concat(F.lit("doi:"), col(metric_doi)), F.concat(F.lit("title:"), col(metric_title))
    )
    lookup = (
        metric.select(F.explode(offered).alias("_key"), F.col(value).alias("_value"))
        .filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.max("_value").alias("_value"))
    )
    joined = df.withColumn("_key", wanted).join(lookup, "_key", "left")
    result = F.col("_value") if default is None else F.coalesce(F.col("_value"), F.lit(default))
    return joined.withColumn(out, result).drop("_key", "_value")


def access_overrides(metadata, title="Title", status="Access Status"):
    """Titles that any source row declares open."""
    is_open = metadata.filter(F.lower(F.trim(col(status))) == "oa")
    return distinct_texts(is_open, normalize_title(title), "title_norm").filter(F.col("title_norm").isNotNull())


def apply_overrides(df, overrides, title, access, out="is_open"):
    """Open-access flag from the access text or the override titles."""
    joined = _flagged(df, overrides.select(F.col("title_norm").alias("_t")), title)
    return joined.withColumn(out, is_open_access(access, "_hit")).drop("_hit")


def _flagged(df, texts, title):
    """Adds ``_hit``, true where the normalised title is in ``texts`` (distinct, column ``_t``).

    Rows are dealt and sorted by a digest of 16 bytes; texts are compared only where digests meet.
    """
    flags = texts.select("_t", F.unhex(F.md5("_t")).alias("_digest"), F.lit(True).alias("_hit"))
    keyed = df.withColumn("_key", F.unhex(F.md5(normalize_title(title))))
    # equal lengths and one a prefix of the other: not an equality that would become a shuffle key
    mine = normalize_title(title)
    same = (F.col("_key") == F.col("_digest")) & (F.octet_length(mine) == F.octet_length("_t")) & F.startswith(mine, F.col("_t"))
    return keyed.join(flags, same, "left").drop("_key", "_digest", "_t")


def mark_members(df, members, title, members_title="title", out="is_choice"):
    """Flag the rows whose normalised title is in a member table."""
    joined = _flagged(df, distinct_texts(members, normalize_title(members_title), "_t"), title)
    return joined.withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_hit")


def skip_seen(df, seen, key, seen_key="key"):
    """Rows whose key was not handled before; a null key was never seen."""
    keys = seen.select(F.col(seen_key).alias("_seen")).distinct()
    return df.join(keys, F.col(key) == F.col("_seen"), "left_anti")


def complete_keys(df, key, details):
    """Keys all of whose rows have every detail filled."""
    filled = F.lit(True)
    for c in details:
        filled = filled & col(c).isNotNull()
    return df.groupBy(F.col(key).alias("key")).agg(F.min(filled.cast("int")).alias("_all")).filter(
        "_all = 1"
    ).select("key")


def update_by_key(df, updates, key, columns, order):
    """Write new values into the rows of their key, keep the others.

    Several updates of one key: the one highest in ``order`` wins.
    """
    picked = F.max_by(F.struct(*columns), F.struct(*order))
    latest = updates.groupBy(F.col(key).alias("_key")).agg(picked.alias("_new"))
    joined = df.join(latest, F.col(key) == F.col("_key"), "left")
    fresh = {c: F.coalesce(F.col(f"_new.{c}"), F.col(c)) for c in columns}
    return joined.withColumns(fresh).drop("_key", "_new")


def missing_assets(references, inventory, path="path", inventory_path="path"):
    """References to files that the inventory does not hold."""
    present = inventory.select(F.col(inventory_path).alias("_p")).distinct()
    return references.filter(col(path).isNotNull()).join(present, F.col(path) == F.col("_p"), "left_anti")
