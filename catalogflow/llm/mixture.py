"""Mixing sources to target weights by capped water-filling.

Each source has a weight; together the sources give ``share`` times all words.
A source stops at ``cap`` times its own words and what it can't give goes to
the others by weight, until none is above. The result is the fixed point
``min(cap * size, level * weight)``; only the scalar ``level`` is found on the
driver, by a few sums over the table of sources.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalogflow.llm.common import packed
from catalogflow.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


def _sized(docs, id_col, text_col, source_col):
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def _ranked(sums):
    """0-based rank of the sources by code point, null last, without one task for all.

    Rows are range-partitioned; a partition's offset is a sum over one row per
    partition.
    """
    keys = [F.col("source").isNull(), F.col("source")]
    ranged = materialize(sums.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    ranks = ranged.withColumn("_inside", inside).join(offsets, "_part")
    return ranks.select("source", "source_size", (F.col("_before") + F.col("_inside") - 1).alias("rank"))


def targets(sums, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Target words of each source: (source, source_size, target).

    sums: (source, source_size), one row per source. Weights go round in the
    order of the sources' names by code point, null last. The level rises with
    each round and a source once at its cap stays there, so the rounds end.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(
        _ranked(sums).withColumns({"weight": weight, "most": F.lit(float(cap)) * F.col("source_size")}), "ranked")
    whole, free = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted, level = float(share) * (whole or 0), None
    fixed = 0.0
    while free:
        new = (wanted - fixed) / free
        if new == level:
            break
        level = new
        full = F.col("most") <= F.lit(level) * F.col("weight")
        fixed, free = ranked.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)), F.sum(F.when(~full, F.col("weight")))
        ).first()
    target = F.least("most", F.lit(level or 0.0) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def seeded(column, seed, bits=32):
    """A fixed number in [0, 1) for each value, the same on every engine that has MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, bits // 4), 16, 10).cast("double") / F.lit(float(2**bits))


def mix(docs, weights=(5, 2, 1), share=1.5, cap=2.0, seed=0, id_col="doc_id", text_col="text", source_col="source"):
    """How many words of each document the mix takes.

    Returns one row per input row: doc_id, source, size (words), source_size,
    target (of its source) and taken. A source that gives ``r`` times its words
    takes each document ``floor(r)`` times whole and a fractional repetition of
    the rest, rounded by a seeded draw, so a source's total differs from its
    target by roundings only. A null text has no words; null sources form one
    source, ranked last; repeated rows count each; an empty table gives none.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    want = targets(sums, weights, share, cap)
    key = F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    joined = sized.withColumn("_k", key).join(want.withColumn("_k", key).drop("source"), "_k")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    part = F.floor((rate - whole) * F.col("size") + seeded(F.col("doc_id"), seed))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + part).cast("long").alias("taken")
    )


def repetitions(docs, mixed, seed=0, id_col="doc_id", text_col="text", source_col="source"):
    """The mixed corpus: one row per repetition, with the columns of ``docs``.

    Whole repetitions carry the text as it is; the fractional one carries a
    seeded run of its words, joined by one space. The columns size,
    source_size, target, taken and repetition are set here; rows that share an
    id are told apart by their size and source.
    """
    names = ["size", "source_size", "target", "taken"]
    plan = mixed.select("doc_id", "source", F.struct(*names).alias("mix")).distinct()
    rows = packed(docs.drop(*names, "repetition"))
    text, own = F.col(f"row.`{text_col}`"), F.col(f"row.`{id_col}`")
    words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))
    same = own.eqNullSafe(F.col("doc_id")) & F.col(f"row.`{source_col}`").eqNullSafe(F.col("source")) & (words == F.col("mix.size"))
    joined = rows.join(plan, same).select("row", "mix")
    size, taken = F.col("mix.size"), F.col("mix.taken")
    rest = taken - F.floor(taken / F.greatest(size, F.lit(1))) * size
    times = F.when(size > 0, F.ceil(taken / F.greatest(size, F.lit(1)))).otherwise(F.lit(0)).cast("int")
    each = F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))
    out = joined.withColumn("repetition", F.explode(each))
    partial = (F.col("repetition") == times) & (rest > 0)
    start = F.floor(seeded(own, f"{seed}/start") * (size - rest + 1)) + 1
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    piece = F.array_join(F.slice(found, start.cast("int"), rest.cast("int")), " ")
    final = F.col("row").withField(f"`{text_col}`", F.when(partial, piece).otherwise(text))
    return out.select(final.alias("row"), "mix", "repetition").select("row.*", "mix.*", "repetition")


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS m FROM s),
w AS (SELECT *, CASE m WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight, 2.0::DOUBLE * source_size AS most FROM r),
p AS (SELECT *, most / weight AS ratio,
  coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
  coalesce(sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM w),
l AS (SELECT arg_min((1.5::DOUBLE * (SELECT sum(source_size) FROM w) - fixed) / ((SELECT sum(weight) FROM w) - used), fixed + used) AS level
  FROM p WHERE (1.5::DOUBLE * (SELECT sum(source_size) FROM w) - fixed) / ((SELECT sum(weight) FROM w) - used) <= ratio),
t AS (SELECT source, source_size, least(most, (SELECT level FROM l) * weight) AS target FROM w),
j AS (SELECT d.doc_id, d.size, t.source_size, t.target,
  CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
  ('0x' || substr(md5('0:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (floor(rate) * size + floor((rate - floor(rate)) * size + u))::BIGINT AS taken FROM j
"""
