"""Session set-up and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app="catalogflow", cores="*", shuffle_partitions=None, memory="8g"):
    """A local session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # HTML pages are large rows: keep Arrow batches small
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_path(spark, label):
    """A fresh folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. Only a local session
    that names none (tests) gets a temporary folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="catalogflow-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(df, *columns):
    """Hash-partition for CPU-bound Python work on few bytes.

    An explicit number of partitions is not coalesced by the adaptive planner.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *columns)


def materialize(df, label):
    """Write a table that several later steps read, and read it back.

    Cuts the lineage and survives lost executors; the planner knows its size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df, key, label, dealt=False):
    """Write a table bucketed by a key and read it back; what works by the key does not shuffle it again.

    ``dealt``: the rows are hash-partitioned by the key already. The catalog forgets
    the table's name at once, the files stay in the shared folder.
    """
    spark, name = df.sparkSession, f"catalogflow_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df if dealt else df.repartition(parts, key)
    rows.write.format("parquet").bucketBy(parts, key).sortBy(key).option("path", scratch_path(spark, label)).saveAsTable(name)
    stored = spark.table(name)
    # the relation is resolved: files and buckets are known without the name
    spark.sql(f"DROP TABLE {name}")
    return stored
