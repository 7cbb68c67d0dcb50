"""The stages on small tables, each against the brute-force version of its operator's test."""

import corpus_pipeline
from tests.llm import test_decontaminate, test_lines, test_near_duplicates

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    docs = documents.filter("doc_id < 80")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]

    lines = stages["line_dedup"](spark, docs, FOLDER)
    assert lines.columns == docs.columns
    want = {i: (t, n) for i, _, n, _, t in test_lines.brute(pairs)}
    got = {r.doc_id: r for r in lines.collect()}
    assert {i: r.text for i, r in got.items()} == {i: t for i, (t, _) in want.items()}
    assert all(r.n_chars == len(r.text) for i, r in got.items() if want[i][1])

    near = stages["near_duplicates"](spark, docs, FOLDER)
    assert near.columns == docs.columns
    assert sorted(r.doc_id for r in near.collect()) == sorted(r[0] for r in test_near_duplicates.brute(pairs, 80) if r[3])

    clean = stages["decontamination"](spark, docs, FOLDER)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, t in sorted(pairs) if not test_decontaminate.brute(t, items)]


def test_toxic_documents_go(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, folder)
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    before = dict(docs.join(labels, "doc_id").groupBy("toxic").count().collect())
    after = dict(kept.join(labels, "doc_id").groupBy("toxic").count().collect())
    assert after[0] > 0.98 * before[0] and after.get(1, 0) < 0.2 * before[1]


def test_run(spark, documents):
    out = corpus_pipeline.run(spark, FOLDER)
    rows = out.collect()
    assert set(documents.columns) <= set(out.columns)
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in documents.select("doc_id").collect()}


def test_null_ids_and_texts(spark, docs_of):
    pairs = [(None, "one fine line that is long enough"), (1, None), (2, ""), (2, ""), (3, "one fine line that is long enough")]
    docs = docs_of(pairs)
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, FOLDER)
        ids = [r.doc_id for r in out.collect()]
        assert 3 in ids or name == "mixing", name
        assert stage(spark, docs.limit(0), FOLDER).collect() == []


def test_rows_of_one_id_and_clashing_columns(spark):
    """Rows with one id are judged by their own texts; columns named like helpers pass."""
    from pyspark.sql import functions as F

    stages = dict(corpus_pipeline.STAGES)
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    toxic = docs.join(labels.filter("toxic = 1"), "doc_id").orderBy("doc_id").first().text
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first().text
    line = "one plain line that two documents hold, long enough"
    rows_ = [(7, toxic), (7, "a plain text about a river"), (8, f"see: {item} (copied)"), (8, "a plain text about a hill"),
             (None, toxic), (None, "a plain text about a lake"), (1, line), (9, f"{line}\nand another line of its own here")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows_], "doc_id long, text string, lang string, source string, n_chars long")
    helpers = ["kept_text", "_cut", "_tag", "_kept", "cut", "tag", "kept", "row", "mix", "_mix_size", "_mix_id", "text_tag", "contaminated", "a.b"]
    df = df.withColumns({h: F.concat(F.lit(f"{h}:"), "text") for h in helpers})

    clean = stages["toxicity"](spark, df, folder)
    assert clean.columns == df.columns
    kept = sorted((r.doc_id or 0, r.text) for r in clean.collect())
    assert kept == sorted((i or 0, t) for i, t in rows_ if t != toxic)
    pure = stages["decontamination"](spark, df, folder)
    assert sorted((r.doc_id or 0, r.text) for r in pure.collect()) == sorted((i or 0, t) for i, t in rows_ if item not in t)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, folder)
        assert set(df.columns) <= set(out.columns), name
        got = out.collect()
        assert got and all(r["a.b"].startswith("a.b:") and r["row"].startswith("row:") for r in got), name
        if name == "line_dedup":
            assert {r.doc_id: r.text for r in got if r.doc_id in (1, 9)} == {1: line, 9: "and another line of its own here"}
        assert stage(spark, df.limit(0), folder).collect() == []


def test_toxicity_of_null_and_empty_texts(spark):
    stage = dict(corpus_pipeline.STAGES)["toxicity"]
    df = spark.createDataFrame([(None, None), (1, None), (1, ""), (2, "x")], "doc_id long, text string")
    assert len(stage(spark, df, "/root/testdata/sf0.1").collect()) == 4
