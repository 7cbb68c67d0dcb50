"""Connected components of a link table, in rounds of joins."""

from pyspark.sql import functions as F

from catalogflow.session import materialize


def components(links, label="components"):
    """Smallest id reachable from each linked id: (_id, component).

    links: (a, b), any direction. Each round sends to every id the smallest
    label among its neighbours and then follows that label's own label, so
    chains shorten by jumps. Neighbours' labels are combined in the map tasks.
    Rounds are written to the shared scratch folder; the end is a count.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.filter("a <> b").distinct(), f"{label}-edges")
    now = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_id"), F.least("a", "m").alias("component"))
    now = materialize(now, label)
    while True:
        near = edges.join(now.select(F.col("_id").alias("b"), "component"), "b").groupBy(F.col("a").alias("_id")).agg(
            F.min("component").alias("_near"))
        step = now.join(near, "_id").withColumn("_least", F.least("component", "_near"))
        jump = now.select(F.col("_id").alias("_least"), F.col("component").alias("_jump"))
        step = step.join(jump, "_least", "left").select(
            "_id", F.least("_least", F.coalesce("_jump", "_least")).alias("component"),
            (F.least("_least", F.coalesce("_jump", "_least")) != F.col("component")).alias("_moved"))
        step = materialize(step, label)
        moved = not step.filter("_moved").isEmpty()
        now = step.drop("_moved")
        if not moved:
            return now
