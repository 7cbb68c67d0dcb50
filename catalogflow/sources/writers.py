"""Sinks. A path is never read and overwritten by one job."""

from pyspark.sql import functions as F

from ..session import scratch_path


def overwrite_csv(df, path, columns=None, quote_all=False):
    chosen = df.select(*columns) if columns else df
    (
        chosen.write.mode("overwrite").option("header", True).option("quoteAll", quote_all)
        .option("escape", '"').option("emptyValue", "").csv(path)
    )


def append_rows(df, path):
    """Append to a Parquet table; the header policy belongs to CSV exports."""
    df.write.mode("append").parquet(path)


def write_snapshot(df, base, stamp):
    """Write a dated version beside the others and return its path."""
    path = f"{base.rstrip('/')}/snapshot={stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def append_marker(df, path, stamp):
    """Record processed files (name, size, time) after their sink succeeded."""
    rows = df.select("filename", "size_bytes", F.lit(stamp).cast("timestamp").alias("processed_at"))
    rows.write.mode("append").parquet(path)


def append_keys(df, path):
    df.select(F.col("key").cast("string").alias("key")).write.mode("append").parquet(path)


def overwrite_partitions(spark, df, path, partition):
    """Replace only the partitions present in ``df``.

    The rows are staged first, because ``df`` may be computed from ``path``.
    """
    staged = scratch_path(spark, "stage")
    df.write.parquet(staged)
    (
        spark.read.schema(df.schema).parquet(staged)
        .repartition(partition)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition).parquet(path)
    )


def write_documents(df, group, pos, fragment, path, files=None):
    """One folder per group holding its fragments in order of ``pos`` columns.

    Rows are range-partitioned by group and position, so a large group spans
    several files; files in name order, lines in file order, are the document.
    """
    order = [group, *([pos] if isinstance(pos, str) else pos)]
    placed = df.repartitionByRange(*order) if files is None else df.repartitionByRange(files, *order)
    ordered = placed.sortWithinPartitions(*order)
    ordered.select(group, fragment).write.mode("overwrite").partitionBy(group).text(path)
