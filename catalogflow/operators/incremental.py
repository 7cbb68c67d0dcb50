"""Change detection against the processing state."""

from pyspark.sql import functions as F

from ..functions.nulls import col
from ..functions.text import size_change


def last_state(entries, filename="filename", size="size_bytes", order="line_no"):
    """Last entry per file wins, also when it holds no size."""
    picked = F.max_by(F.struct(F.col(size).alias("size_bytes")), order)
    return entries.groupBy(F.col(filename).alias("filename")).agg(picked.alias("_s")).select(
        "filename", F.col("_s.size_bytes").alias("size_bytes")
    )


def detect_changes(listing, state):
    """New files and files of another size, oldest first.

    A stored size of null or 0 counts as processed.
    """
    known = state.select(F.col("filename").alias("_f"), F.col("size_bytes").alias("old_size"), F.lit(True).alias("_hit"))
    joined = listing.join(known, F.col("filename") == F.col("_f"), "left")
    stored = F.col("old_size").isNotNull() & (F.col("old_size") != 0)
    change = F.when(F.col("_hit").isNull(), F.lit("new")).when(
        stored & (F.col("old_size") != F.col("size_bytes")), F.lit("changed")
    )
    detail = F.when(F.col("change") == "changed", size_change("old_size", "size_bytes"))
    rows = joined.withColumn("change", change).filter(col("change").isNotNull()).withColumn("detail", detail)
    return rows.drop("_f", "_hit").orderBy("ts", "filename")
