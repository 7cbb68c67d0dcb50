"""Deduplication, set operations and the catalog upsert."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.dates import canonical_issue_key
from ..functions.nulls import col


def exact_distinct(df):
    return df.distinct()


def digest(df, keys):
    """A key of at most 32 bytes for key columns of any size: SHA-256 of their values, null told from empty.

    Null if none of the keys is a text. Texts are dealt, sorted and compared
    by digest, so that no text is a shuffle key.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    if not any(kinds.get(k, "string") == "string" for k in keys):
        return None
    parts = []
    for k in keys:
        text = F.col(k).cast("string")
        # the length in front keeps neighbouring values apart
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def distinct_texts(df, text, name):
    """The distinct values of a text column; copies meet by digest and are combined in the map tasks."""
    rows = df.select(text.alias(name))
    return rows.groupBy(F.unhex(F.sha2(F.col(name), 256)).alias("_digest")).agg(F.first(name).alias(name)).drop("_digest")


def _keep_one(df, keys, order):
    # the rank limit is applied inside each map task before the shuffle
    # (WindowGroupLimit), so copies of a hot key do not travel
    by, names = digest(df, keys), list(keys)
    if by is not None:
        df, names = df.withColumn("_digest", by), ["_digest"]
    w = Window.partitionBy(*names).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_digest")


def dedupe_first(df, keys, seq):
    return _keep_one(df, keys, [F.col(s).asc() for s in seq])


def dedupe_last(df, keys, seq):
    return _keep_one(df, keys, [F.col(s).desc() for s in seq])


def dedupe_best(df, keys, metric, ties):
    """Highest metric per key; exact copies count once, ties by ``ties``."""
    return _keep_one(df, keys, [F.col(metric).desc_nulls_last(), *ties])


def first_seen(df, value, pos):
    """Distinct values in the order of their first appearance."""
    return df.groupBy(value).agg(F.min(pos).alias("first_pos")).orderBy("first_pos", value)


def union_all(*frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def _tagged_sides(new, old, keys):
    sides = new.select(*keys, F.lit(1).alias("_new"), F.lit(0).alias("_old")).unionAll(
        old.select(*keys, F.lit(0).alias("_new"), F.lit(1).alias("_old"))
    )
    by = digest(sides, keys)
    if by is None:
        return sides.groupBy(*keys).agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"))
    found = sides.groupBy(by.alias("_digest")).agg(
        *[F.first(k).alias(k) for k in keys], F.max("_new").alias("_new"), F.max("_old").alias("_old"))
    return found.drop("_digest")


def diff_keys(new, old, keys=("Title", "URL")):
    """Key-level changes as rows ``(keys, change)``; null keys match nulls."""
    change = F.when(F.col("_old") == 0, F.lit("added")).when(F.col("_new") == 0, F.lit("removed"))
    both = _tagged_sides(new, old, list(keys)).withColumn("change", change)
    return both.filter(F.col("change").isNotNull()).select(*keys, "change")


def diff_counts(new, old, keys=("Title", "URL"), group=()):
    """Added and removed keys and current rows, per group where one is given."""
    group = list(group)
    sides = _tagged_sides(new, old, [*group, *[k for k in keys if k not in group]])
    changes = sides.groupBy(*group).agg(
        F.count_if((F.col("_new") == 1) & (F.col("_old") == 0)).alias("added"),
        F.count_if((F.col("_new") == 0) & (F.col("_old") == 1)).alias("removed"),
        F.count_if(F.col("_new") == 1).alias("current_keys"),
    )
    return changes


def except_issues(df, keys, issue_key="IssueKey"):
    """Rows whose canonical issue key is not in the key table; a blank key stands for no issue and takes no row out."""
    gone = keys.select(F.col("issue_key").alias("_gone")).filter("_gone <> ''").distinct()
    return df.join(gone, canonical_issue_key(issue_key) == F.col("_gone"), "left_anti")


def batch_keys(batch, issue_key="IssueKey", keys="all", seq="ingest_seq"):
    """Issue keys a batch replaces: all of them, or only its first row's."""
    if keys == "first":
        return batch.agg(F.min_by(issue_key, seq).alias("_k")).select(canonical_issue_key("_k").alias("issue_key"))
    return batch.select(canonical_issue_key(issue_key).alias("issue_key")).distinct()


def replace_issue(catalog, batch, issue_key="IssueKey", unique=("Title", "URL"), seq="ingest_seq", keys="all"):
    """New catalog: the batch's issues are replaced, later copies win."""
    kept = except_issues(catalog, batch_keys(batch, issue_key, keys, seq), issue_key)
    merged = union_all(kept.withColumn("_gen", F.lit(0)), batch.withColumn("_gen", F.lit(1)))
    return dedupe_last(merged, list(unique), ["_gen", seq]).drop("_gen")


def catalog_from_batches(log, issue_key="IssueKey", unique=("Title", "URL"), seq="ingest_seq", gen="gen"):
    """Catalog that results from upserting logged batches one after another.

    Equal to repeated ``replace_issue``, without rewriting the catalog for each
    batch: a row stands if it is the last of its unique key in the whole log
    and no later batch holds its issue (rows without an issue key belong to no
    issue and stand on their own). ``gen`` is any column that orders the
    batches. The result keeps it, so it can replace the log it came from.
    """
    keyed = log.withColumn("_key", canonical_issue_key(issue_key))
    newest = keyed.filter("_key <> ''").groupBy(F.col("_key").alias("_k")).agg(F.max(gen).alias("_newest"))
    last = dedupe_last(keyed, list(unique), [gen, seq])
    joined = last.join(newest, F.col("_key") == F.col("_k"), "left")
    return joined.filter(F.col("_k").isNull() | (F.col(gen) == F.col("_newest"))).drop("_key", "_k", "_newest")


def replace_report(catalog, batch, result, issue_key="IssueKey", seq="ingest_seq", keys="all"):
    """One row: rows kept from the catalog, batch rows, rows of the result."""
    kept = except_issues(catalog, batch_keys(batch, issue_key, keys, seq), issue_key)
    parts = union_all(
        kept.select(F.lit("kept").alias("part")),
        batch.select(F.lit("new").alias("part")),
        result.select(F.lit("total").alias("part")),
    )
    return parts.agg(*[F.count_if(F.col("part") == p).alias(f"{p}_rows") for p in ("kept", "new", "total")])


def append_dedupe(catalog, batch, unique=("Title", "URL"), seq="ingest_seq"):
    merged = union_all(catalog.withColumn("_gen", F.lit(0)), batch.withColumn("_gen", F.lit(1)))
    return dedupe_last(merged, list(unique), ["_gen", seq]).drop("_gen")


def invalidate_seen(seen, keys, mode="exact", seen_key="key", issue_key="issue_key", key_length=6):
    """Seen lines without those of the given keys.

    ``contains`` also drops lines that hold a key anywhere inside. Every window
    of ``key_length`` characters of a line is looked up, so this is a key join;
    all keys must have that length.
    """
    gone = keys.select(col(issue_key).alias("_gone")).filter("_gone is not null").distinct()
    if mode == "exact":
        return seen.join(gone, F.col(seen_key) == F.col("_gone"), "left_anti")
    lines = seen.select(col(seen_key).alias("_line")).filter(F.length("_line") >= key_length).distinct()
    pieces = lines.select("_line", F.explode(F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.length("_line") - key_length + 1),
                    lambda i: F.substr(F.col("_line"), i, F.lit(key_length)))
    )).alias("_piece"))
    checked = gone.withColumn("_gone", F.when(F.length("_gone") == key_length, F.col("_gone")).otherwise(
        F.raise_error(F.lit(f"every key must have {key_length} characters")).cast("string")))
    hit = pieces.join(checked, F.col("_piece") == F.col("_gone"), "left_semi").select("_line").distinct()
    return seen.join(hit, F.col(seen_key) == F.col("_line"), "left_anti")
