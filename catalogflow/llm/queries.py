"""The contract's queries: thin, over whole tables, digests derived from real outputs."""

from pyspark.sql import functions as F

from catalogflow.llm import (
    archive, burst_trie, bwt_dedup, cover_dedup, cuckoo_dedup, decontaminate, line_dedup, mixture, multi_index, odd_sketch, oracles, secrets,
    spelling, toxicity,
)
from catalogflow.llm.registry import query, table


@query("op1_cover_passages")
def op1(spark, folder):
    out = cover_dedup.dedup_passages(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_water_filling", mixture.MIX_SQL)
def op3(spark, folder):
    return mixture.mix(table(spark, folder, "documents")).drop("source")


@query("op7_content_archive", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND head <> page_id THEN head END AS refers_to FROM f
""")
def op7(spark, folder):
    path = archive.write_archive(table(spark, folder, "pages"))
    return archive.resolved(archive.parse_records(archive.read_archive(spark, path)))


@query("op4_secret_owners")
def op4(spark, folder):
    out = secrets.scan_secrets(table(spark, folder, "documents"))
    kinds = [secrets.spans_of("spans", kind=k).alias(f"n_{k}") for k in secrets.BASE]
    verdicts = [secrets.spans_of("spans", verdict=v).alias(f"n_{v}") for v in ("live", "copied", "weak")]
    base = F.sha2(secrets.span_text(F.col("spans"), len(secrets.BASE)), 256)
    return out.select("doc_id", *kinds, base.alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"), *verdicts)


@query("op5_subword_toxicity")
def op5(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op9_odd_sketch")
def op9(spark, folder):
    return odd_sketch.near_duplicates(table(spark, folder, "documents"))


@query("op10_templates")
def op10(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_tag")


@query("op6_segment_lines")
def op6(spark, folder):
    out = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_links", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_bwt_intervals")
def op8(spark, folder):
    out = bwt_dedup.dedup_bytes(table(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_multi_index")
def op2(spark, folder):
    return multi_index.search(table(spark, folder, "embeddings"), "vec_id % 20 = 0")


@query("op11_cuckoo_index", oracles.CUCKOO)
def op11(spark, folder):
    out = cuckoo_dedup.deduplicate(table(spark, folder, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op12_burst_trie", oracles.TRIE)
def op12(spark, folder):
    return burst_trie.conversation_trie(table(spark, folder, "conversations"))


@query("op13_partenum_spelling", oracles.SPELLING)
def op13(spark, folder):
    return spelling.variants(table(spark, folder, "documents"))
