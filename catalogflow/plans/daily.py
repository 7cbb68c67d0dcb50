"""The daily run as one flow: detect, check, log, report, render, and only then mark.

A folder holds what the runs leave behind, each in a folder of its own run:
``log`` (rows of the files that passed, by file), ``in_press``, ``seen`` (issue pages
that are up to date), ``pages``, ``outcomes`` and, written last, ``state`` (the
size at which a file was processed). A run that is repeated replaces its own folders only.
"""

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import dedupe, incremental
from ..session import materialize
from . import views

OUTCOME = "filename string, size_bytes bigint, ts timestamp, old_size bigint, change string, detail string, reason string, run string"


def _read(spark, path, schema, before=None):
    """Rows of all runs (before one), or none yet."""
    try:
        rows = spark.read.schema(schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], schema)
    return rows if before is None else rows.filter(F.col("run") < before)


def _last(spark, base, name, schema, before, condition="true"):
    """Rows that the newest earlier run with such outcomes left, also if these are none."""
    found = _read(spark, f"{base}/outcomes", OUTCOME, before).filter(condition)
    last = found.agg(F.max("run")).first()[0]
    return _read(spark, f"{base}/{name}", f"{schema}, run string").filter(F.col("run") == F.lit(last)).drop("run")


def _write(df, base, name, run):
    df.write.mode("overwrite").parquet(f"{base}/{name}/run={run}")


def state(spark, base, before=None):
    """The size at which each file was last processed with success."""
    rows = _read(spark, f"{base}/state", "filename string, size_bytes bigint, run string", before)
    return incremental.last_state(rows, order="run")


def outcomes(spark, base):
    """What each run found due: ``reason`` is null for files that passed."""
    return _read(spark, f"{base}/outcomes", OUTCOME)


def catalog_log(spark, base, schema, before=None):
    """The rows of all files that passed, ordered by ``gen``."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return _read(spark, f"{base}/log", f"{kinds}, gen string, run string", before).drop("run")


def check_files(rows, due, assets):
    """(filename, reason) of due files that may not be ingested.

    A file fails without rows, with a research row that has no title or issue, or
    with an image that does not exist. Rows are combined in the map tasks.
    """
    known = assets.select(F.col("path").alias("_path")).distinct()
    looked = rows.join(known, F.col("GA_Path") == F.col("_path"), "left")
    research = F.col("class") == "research"
    blank = (F.coalesce("Title", F.lit("")) == "") | (F.coalesce(D.canonical_issue_key("IssueKey"), F.lit("")) == "")
    facts = looked.groupBy(F.col("file").alias("_file")).agg(
        F.count_if(research & blank).alias("no_key"), F.count_if(F.col("GA_Path").isNotNull() & F.col("_path").isNull()).alias("no_image"))
    joined = due.select("filename").join(facts, F.col("filename") == F.col("_file"), "left")
    reason = F.when(F.col("_file").isNull(), "no rows").when(F.col("no_key") > 0, "rows without title or issue").when(
        F.col("no_image") > 0, F.concat(F.col("no_image").cast("string"), F.lit(" images missing")))
    return joined.select(F.col("filename").alias("_name"), reason.alias("reason"))


def daily_run(spark, base, run, listing, raw, assets, choices, host=""):
    """Process what is new or changed in ``listing`` and report.

    ``raw`` holds the metadata rows with their ``file``, ``run`` orders the runs (a date).
    Files that fail a check are not logged, their state stays, and the next run
    finds them due again; all others go on. Returns the catalog, the
    counts per issue and for the in-press view, and the pages of the changed issues.
    """
    due = materialize(views.changed_files(listing, state(spark, base, run)), "due")
    rows = views.catalog_rows(raw.join(due.select(F.col("filename").alias("_due")), F.col("file") == F.col("_due"), "left_semi"))
    rows = materialize(rows, "rows")
    marked = due.join(check_files(rows, due, assets), F.col("filename") == F.col("_name")).drop("_name")
    marked = materialize(marked, "marked")
    good = marked.filter("reason is null")
    passed = rows.join(good.select(F.col("filename").alias("_good")), F.col("file") == F.col("_good"), "left_semi")

    fields = rows.drop("class", "file").schema
    log = catalog_log(spark, base, fields, run)
    before = dedupe.catalog_from_batches(log).drop("gen")
    moment = good.select(F.col("filename").alias("_file"), F.concat_ws(" ", F.lit(run), F.date_format("ts", "yyyyMMddHHmmss"), "filename").alias("gen"))
    logged = passed.filter("class = 'research'").join(moment, F.col("file") == F.col("_file")).drop("class", "file", "_file")
    _write(logged, base, "log", run)
    after = materialize(dedupe.catalog_from_batches(catalog_log(spark, base, fields)).drop("gen"), "catalog")

    issues = materialize(passed.filter("class = 'research'").select(D.canonical_issue_key("IssueKey").alias("issue_key")).distinct(), "issues")

    def of_issues(catalog):
        keyed = catalog.withColumn("IssueKey", D.canonical_issue_key("IssueKey"))
        return keyed.join(issues, F.col("IssueKey") == F.col("issue_key"), "left_semi")

    counts = materialize(dedupe.diff_counts(of_issues(after), of_issues(before), group=("IssueKey",)), "counts")
    waiting = _last(spark, base, "in_press", "Title string, URL string", run, "reason is null")
    in_press = passed.filter("class = 'in_press'").select("Title", "URL")
    in_press_counts = materialize(dedupe.diff_counts(in_press, waiting), "in-press")

    # pages of changed issues are forgotten, made again, and known again
    seen = _last(spark, base, "seen", "key string", run)
    _write(views.issue_documents(of_issues(after), raw, choices, assets, host), base, "pages", run)
    made = spark.read.parquet(f"{base}/pages/run={run}").select(F.col("IssueKey").alias("key")).distinct()
    _write(dedupe.invalidate_seen(seen, issues).unionByName(made).distinct(), base, "seen", run)
    if not good.isEmpty():  # without a new file the view stands
        _write(in_press, base, "in_press", run)
    _write(marked, base, "outcomes", run)
    # the state comes last: what was lost half-way is due again
    _write(good.select("filename", "size_bytes"), base, "state", run)
    return {"catalog": after, "changes": counts, "in_press_changes": in_press_counts, "pages": spark.read.parquet(f"{base}/pages/run={run}")}
