"""Readers with declared schemas; none of them infers types."""

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import strip
from ..operators.dedupe import union_all
from ..operators.filters import add_missing_columns
from ..operators.incremental import last_state
from ..session import materialize

# fixed values: formats of listings and state lines
STAMP = "yyyy-MM-dd HH:mm:ss"
ISSUE_FILE = r"(?:^|/)(\d{6})\.html$"


def read_catalog_csv(spark, path, schema=schemas.CATALOG, null_value=None):
    """Header CSV with doubled quotes and line breaks inside quoted fields.

    ``path`` is a file, a folder or a list of files with one header. Columns
    are matched by name, so the files may lack some or order them freely.
    """
    header = _header(spark, path)
    wanted = {f.name: f.dataType for f in schema.fields}
    reader = (
        spark.read.option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
        .option("enforceSchema", False)  # every file must have the same header
    )
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    raw = reader.schema(_string_schema(header)).csv(path)
    present = [F.col(f"`{n}`").try_cast(wanted[n]).alias(n) for n in header if n in wanted]
    return add_missing_columns(raw.select(*present), schema).select(*[f"`{n}`" for n in wanted])


def _string_schema(names):
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _header(spark, path):
    """Column names of one CSV file whose header spans lines."""
    sample = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return sample.columns


def _first_lines(spark, paths):
    """(file name, folder, first line) of the files that exist: one job, whatever the number of files."""
    folders = {}
    for path in paths:
        folder, _, name = path.rpartition("/")
        folders.setdefault(folder, set()).add(name)
    parts = []
    for folder, names in folders.items():
        try:
            lines = spark.read.option("lineSep", "\n").text(folder or ".")
        except AnalysisException:  # no such folder: its files are left out, as documented
            continue
        meta = lines.select(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("block"),
                            F.monotonically_increasing_id().alias("row"), "value")
        parts.append(meta.filter(F.col("name").isin(sorted(names)) & (F.col("block") == 0)).withColumn("folder", F.lit(folder)))
    if not parts:
        return []
    first = union_all(*parts).groupBy("folder", "name").agg(F.min_by("value", "row").alias("line"))
    return first.collect()  # one row per file name that the caller gave


def read_many_optional(spark, paths, required, schema):
    """Union of the files that exist and hold the required columns.

    One distributed job reads the first line of all files; files with the same
    header are read together, so the plan grows with the number of layouts, not of
    files. An empty file has no columns and is left out.
    """
    layouts = {}
    for found in _first_lines(spark, paths):
        path = f"{found['folder']}/{found['name']}" if found["folder"] else found["name"]
        line = (found["line"] or "").removeprefix("\ufeff").rstrip("\r")
        # a quoted name with a line break: only then the file is opened on its own
        header = tuple(_header(spark, path)) if line.count('"') % 2 else tuple(next(csv.reader([line]), ()))
        if all(c in header for c in required):
            layouts.setdefault(header, []).append(path)
    parts = [read_catalog_csv(spark, sorted(group), schema) for group in layouts.values()]
    return union_all(*parts) if parts else spark.createDataFrame([], schema)


def list_objects(spark, folder, suffix=".xlsx"):
    """File manifest; the file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(
        name.alias("filename"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("ts")
    ).filter(F.endswith(F.col("filename"), F.lit(suffix)))


def parse_listing(lines, column="value", suffix=".xlsx"):
    """Manifest from listing lines ``date time size name``."""
    parts = F.split(strip(column), r"\s+")
    rows = lines.select(parts.alias("_p")).filter(F.size("_p") >= 4)
    stamp = F.concat_ws(" ", F.get("_p", F.lit(0)), F.get("_p", F.lit(1)))
    return rows.select(
        F.get("_p", F.lit(3)).alias("filename"),
        F.get("_p", F.lit(2)).try_cast("bigint").alias("size_bytes"),
        F.try_to_timestamp(stamp, F.lit(STAMP)).alias("ts"),
    ).filter(F.endswith(F.col("filename"), F.lit(suffix)))


def parse_state(lines, line="line", order="line_no"):
    """State per file from log lines; comments, blanks and single fields skipped."""
    text = strip(line)
    parts = F.split(text, r"\s+")
    rows = lines.filter((text != "") & ~F.startswith(text, F.lit("#"))).select(order, parts.alias("_p"))
    entries = rows.filter(F.size("_p") >= 2).select(
        order, F.get("_p", F.lit(0)).alias("filename"), F.get("_p", F.lit(1)).try_cast("bigint").alias("size_bytes")
    )
    return last_state(entries, order=order)


def read_numbered_lines(spark, path):
    """``(file, line_no, line)`` of text files, numbered from 0.

    A large file is read in many splits. Lines are numbered inside a split as they
    are read, and a sum over the earlier splits of the file (one row each) gives the
    number of the first. A line break at the end of a file opens no further line.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"), F.col("value").alias("line"))
    # written once: the row numbers of a second reading could differ
    lines = materialize(lines, "lines")
    earlier = Window.partitionBy("_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy(F.col("file").alias("_file"), F.col("_block").alias("_at")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    blocks = blocks.select("_file", "_at", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = lines.join(blocks, (F.col("file") == F.col("_file")) & (F.col("_block") == F.col("_at")))
    return joined.select("file", (F.col("_before") + F.col("_row") - F.col("_first")).alias("line_no"), "line")


def number_lines(df, doc, text, line="line"):
    lines = F.split(F.col(text), "\n")
    return df.select(doc, F.posexplode_outer(lines).alias("line_no", line)).withColumn(
        "line_no", F.col("line_no").cast("bigint")
    )


def read_state_log(spark, path):
    return parse_state(read_numbered_lines(spark, path))


def read_seen_keys(spark, path):
    return spark.read.text(path).select(F.col("value").alias("key")).distinct()


def scan_issue_keys(paths, column="path"):
    """Issue keys of page file names, with year and issue number."""
    key = F.regexp_extract(F.col(column), ISSUE_FILE, 1)
    rows = paths.select(key.alias("issue_key")).filter("issue_key <> ''").distinct()
    return rows.select(
        "issue_key",
        F.substring("issue_key", 1, 4).cast("int").alias("year"),
        F.substring("issue_key", 5, 2).cast("int").alias("issue"),
    )


def read_pages(spark, path, fmt="parquet"):
    """Raw ``(url, html)`` rows from a table or from a folder of HTML files."""
    if fmt == "parquet":
        return spark.read.parquet(path).select("url", "html")
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
