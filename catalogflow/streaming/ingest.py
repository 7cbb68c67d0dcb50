"""Continuous ingestion with Structured Streaming and ``availableNow`` runs."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import catalog_from_batches
from ..operators.incremental import detect_changes, last_state
from ..operators.joins import skip_seen
from ..session import materialize


def _run(writer, checkpoint):
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _table(spark, path, schema):
    """Rows of a Parquet table that may not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


def _batch_path(base, batch_id):
    # one folder per batch: a repeated attempt replaces its own rows only
    return f"{base.rstrip('/')}/gen={batch_id:010d}"


# --- upserts ----------------------------------------------------------------
#
# A log folder holds ``log/gen=...`` (rows of each batch), ``folded/upto=...``
# (the catalog after a generation) and ``marks`` (which of these are complete).
# ``gen`` is text and orders the batches by its letters, as in ``plans.views``.


def stream_upsert(batches, base, checkpoint):
    """Log each arriving batch; ``upserted`` gives the catalog at any time.

    A batch writes its own rows only, however large the catalog is.
    """

    def log(batch, batch_id):
        batch.write.mode("overwrite").parquet(_batch_path(f"{base}/log", batch_id))

    _run(batches.writeStream.foreachBatch(log), checkpoint)
    return base


def logged(spark, base, schema):
    """The rows from which the catalog follows: the newest complete fold and all later generations.

    Generations that a fold covers are not read any more.
    """
    kinds, upto = _with(schema, "gen"), folded_upto(spark, base)
    log = _table(spark, f"{base}/log", kinds)
    if upto is None:
        return log
    fold = spark.read.schema(kinds).parquet(f"{base}/folded/upto={upto}")
    return fold.unionByName(log.filter(F.col("gen") > upto))


def folded_upto(spark, base):
    """The last generation of the newest complete fold (null: none)."""
    marks = _table(spark, f"{base}/marks", "upto string")
    return marks.agg(F.max("upto")).first()[0]


def fold(spark, base, schema, issue_key="IssueKey", unique=("Title", "URL"), seq="ingest_seq"):
    """Fold all generations so far into one base and return the last of them.

    Rows keep their generation, so later batches replace them as before. The
    mark is written last: until then readers use the older fold, and a fold that
    was lost half-way is not seen. Streams may go on meanwhile, since newer
    generations are not touched.
    """
    rows = logged(spark, base, schema)
    last = _table(spark, f"{base}/log", _with(schema, "gen")).agg(F.max("gen")).first()[0]
    if last is None or last == folded_upto(spark, base):
        return last
    rows = catalog_from_batches(rows.filter(F.col("gen") <= last), issue_key, unique, seq)
    rows.write.mode("overwrite").parquet(f"{base}/folded/upto={last}")
    spark.createDataFrame([(last,)], "upto string").coalesce(1).write.mode("append").parquet(f"{base}/marks")
    return last


def upserted(spark, base, schema, issue_key="IssueKey", unique=("Title", "URL"), seq="ingest_seq"):
    """The catalog after all logged batches."""
    return catalog_from_batches(logged(spark, base, schema), issue_key, unique, seq).drop("gen")


def _with(schema, *names):
    """The schema with text columns added."""
    if isinstance(schema, str):
        return ", ".join([schema, *[f"{n} string" for n in names]])
    return T.StructType([*schema.fields, *[T.StructField(n, T.StringType(), True) for n in names]])


# --- uploads ----------------------------------------------------------------

MANIFEST = "filename string, size_bytes bigint, ts timestamp"


def stream_reuploads(manifest, base, checkpoint, process=None):
    """Detect and process new and re-uploaded files from a stream of manifest rows.

    Needed because the file source takes a path it has seen as done. The latest
    manifest row of each file is compared with the state, the size at which a file was
    last processed. ``process(changes, batch_id)`` returns the file names
    that succeeded (null: all); only these change the state, so a file that failed is due
    again in the next batch, also if that does not list it.

    Writes ``listed``, ``changes`` (with ``done``) and ``state``, one folder per batch; a
    repeated attempt of a batch sees earlier batches only.
    """
    spark = manifest.sparkSession

    def compare(batch, batch_id):
        _latest(batch).write.mode("overwrite").parquet(_batch_path(f"{base}/listed", batch_id))
        changes = detect_changes(listed_files(spark, base, batch_id + 1), processed_sizes(spark, base, batch_id))
        changes = materialize(changes, "changes")
        names = process(changes, batch_id) if process else changes.select("filename")
        good = names.select(F.col("filename").alias("_good")).distinct()
        marked = changes.join(good, F.col("filename") == F.col("_good"), "left")
        marked = materialize(marked.withColumn("done", F.col("_good").isNotNull()).drop("_good"), "marked")
        marked.write.mode("overwrite").parquet(_batch_path(f"{base}/changes", batch_id))
        # the state comes last: it exists only if all before it was written
        done = marked.filter("done").select("filename", "size_bytes")
        done.write.mode("overwrite").parquet(_batch_path(f"{base}/state", batch_id))

    _run(manifest.writeStream.foreachBatch(compare), checkpoint)
    return base


def _latest(rows):
    return rows.groupBy("filename").agg(F.max(F.struct("ts", "size_bytes")).alias("_m")).select(
        "filename", F.col("_m.size_bytes").alias("size_bytes"), F.col("_m.ts").alias("ts"))


def _before(rows, batch_id):
    return rows if batch_id is None else rows.filter(F.col("gen") < batch_id)


def listed_files(spark, base, before=None):
    """The latest manifest row of each file, of all batches or those before one."""
    return _latest(_before(_table(spark, f"{base}/listed", f"{MANIFEST}, gen bigint"), before))


def processed_sizes(spark, base, before=None):
    """The size at which each file was last processed, after all batches or those before one."""
    state = _table(spark, f"{base}/state", "filename string, size_bytes bigint, gen bigint")
    return last_state(_before(state, before), order="gen")


def detected_changes(spark, base):
    """All changes so far: gen, filename, size_bytes, ts, old_size, change, detail, done."""
    kinds = "filename string, size_bytes bigint, ts timestamp, old_size bigint, change string, detail string, done boolean, gen bigint"
    return _table(spark, f"{base}/changes", kinds)


# --- keys seen before -------------------------------------------------------


def stream_distinct(rows, keys, path, checkpoint, time=None, delay=None):
    """Forward each key once, across runs.

    Without ``time`` this is exact and the state grows with the keys. With an
    event-time column and a delay ("10 days"), repetitions within the delay are dropped and the
    state holds only the keys of that span.
    """
    keys = list(keys)
    if time:
        rows = rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
    else:
        rows = rows.dropDuplicates(keys)
    _run(rows.writeStream.format("parquet").option("path", path), checkpoint)
    return path


BUCKETS = 64


def seen_bucket(key, buckets=BUCKETS):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_seen(keys, path, gen):
    """Add a generation to a seen table, dealt into bucket folders. keys: one column ``key``."""
    dealt = keys.select("key").distinct().withColumn("bucket", seen_bucket("key"))
    dealt.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path.rstrip('/')}/gen={gen}")


def seen_keys(spark, path, kind, before=None, buckets=None):
    """Keys of a seen table, of the generations before one, and of some buckets only (folders that are not read)."""
    seen = _before(_table(spark, path, f"key {kind}, gen bigint, bucket int"), before)
    return seen if buckets is None else seen.filter(F.col("bucket").isin(buckets))


def stream_skip_seen(rows, key, seen_path, path, checkpoint):
    """Forward rows whose key no earlier batch has handled.

    The seen table lies on disk in buckets by key; a batch opens only the
    buckets that its own keys fall into, and no state is held between batches.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()

    def forward(batch, batch_id):
        # at most BUCKETS numbers; a repeated attempt of a batch sees earlier batches only
        touched = [r[0] for r in batch.select(seen_bucket(key).alias("b")).distinct().collect()]
        target = _batch_path(path, batch_id)
        skip_seen(batch, seen_keys(spark, seen_path, kind, batch_id, touched), key).write.mode("overwrite").parquet(target)
        written = spark.read.schema(batch.schema).parquet(target).select(F.col(key).alias("key"))
        write_seen(written, seen_path, batch_id)

    _run(rows.writeStream.foreachBatch(forward), checkpoint)
    return path
