"""Order-dependent columns that stay parallel inside one hot group.

A plain window over a group puts the whole group into one task. These helpers
cut each group into spans of the integer position, run the window inside a
span, and add what the earlier spans contribute (a table with one row per
span). With a unique position no task sees more than ``span`` rows of a group.

The group is held in one struct column: it is never null, so the window and
the join with the span table share one hash partitioning of the rows.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import bucketed

SPAN = 100_000
_G, _B = "_grp", "_span"
_KEYS = [_G, _B]


def _with_span(df, group, pos, span):
    return df.withColumns({_G: F.struct(*group), _B: F.floor(F.col(pos) / F.lit(span))})


def _carried(spans, summary, value, fn, local, out, combine):
    """Join what all earlier spans of the group contribute to each row."""
    earlier = Window.partitionBy(_G).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*_KEYS, fn(F.col(value)).over(earlier).alias("_before"))
    joined = spans.withColumn("_local", local).join(carry, _KEYS, "left")
    return joined.withColumn(out, combine(F.col("_local"), F.col("_before"))).drop(*_KEYS, "_local", "_before")


def _plus(local, before):
    return local + F.coalesce(before, F.lit(0))


def running_index(df, group, pos, out="pos", tie=(), span=SPAN):
    """Gapless 1-based row number by ``pos`` inside each group."""
    spans = _with_span(df, group, pos, span)
    counts = spans.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("_n"))
    local = F.row_number().over(Window.partitionBy(*_KEYS).orderBy(pos, *tie))
    return _carried(spans, counts, "_n", F.sum, local, out, _plus)


def running_sum(df, group, pos, value, out, span=SPAN):
    """Sum of ``value`` over all rows of the group before this one."""
    spans = _with_span(df, group, pos, span)
    sums = spans.groupBy(*_KEYS).agg(F.sum(value).alias("_n"))
    before = Window.partitionBy(*_KEYS).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(value).over(before), F.lit(0))
    return _carried(spans, sums, "_n", F.sum, local, out, _plus)


def stored_spans(df, group, pos, columns, span=SPAN):
    """Write each group's rows in spans of ``pos``, with columns computed inside the span.

    ``columns(window)`` gives them over a window (a span's rows by ``pos``). The
    input is planned and shuffled once; the table is bucketed by ``_cell`` (the hash of
    group and ``_span``), so summaries of spans, and joins with them, do not shuffle it again.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = df.withColumn(_B, F.floor(F.col(pos) / F.lit(span)))
    spans = spans.withColumn("_cell", F.xxhash64(*group, _B)).repartition(parts, "_cell")
    window = Window.partitionBy("_cell", *group, _B).orderBy(pos)
    return bucketed(spans.withColumns(columns(window)), "_cell", "spans", dealt=True)


def span_summaries(stored, group, *facts):
    """One row per span with its facts; combined where the span lies."""
    return stored.groupBy("_cell", *group, _B).agg(*facts)


def earlier_spans(group):
    """The spans of the group before this one, for windows over ``span_summaries``."""
    return Window.partitionBy(*group).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)


def with_spans(stored, group, summaries):
    """Rows with the columns of their span's summary."""
    renamed = summaries.select("_cell", F.struct(*group, _B).alias("_id"), *[c for c in summaries.columns if c not in ("_cell", *group, _B)])
    joined = stored.join(renamed.withColumnRenamed("_cell", "_c"), (F.col("_cell") == F.col("_c")) & (F.struct(*group, _B) == F.col("_id")))
    return joined.drop("_c", "_id", "_cell", _B)


def last_so_far(value, window):
    return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))


def fill_down(df, group, pos, values, span=SPAN):
    """Last non-null value at or before each row of the group.

    ``values`` maps output columns to the columns that are filled down; all of
    them share one pass over the rows.
    """
    names = list(values)
    stored = stored_spans(df, group, pos, lambda w: {f"_local{i}": last_so_far(values[n], w) for i, n in enumerate(names)}, span)
    last = [F.max_by(values[n], F.when(F.col(values[n]).isNotNull(), F.col(pos))).alias(f"_v{i}") for i, n in enumerate(names)]
    before = earlier_spans(group)
    carry = span_summaries(stored, group, *last).select("_cell", *group, _B, *[
        F.last(f"_v{i}", ignorenulls=True).over(before).alias(f"_before{i}") for i in range(len(names))])
    joined = with_spans(stored, group, carry)
    filled = {n: F.coalesce(F.col(f"_local{i}"), F.col(f"_before{i}")) for i, n in enumerate(names)}
    return joined.withColumns(filled).drop(*[f"{h}{i}" for i in range(len(names)) for h in ("_local", "_before")])
