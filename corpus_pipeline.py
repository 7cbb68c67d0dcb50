"""The corpus pipeline: five stages over documents, each applied to what the one before kept.

1. toxicity: documents that the classifier rejects go;
2. line dedup: each line near an earlier one goes, the documents stay;
3. near duplicates: one document of each group stays;
4. decontamination: documents that hold a benchmark item go;
5. mixing: sources come to their target weights, one row per repetition.

A stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
docs (the last one adds its own). Null texts and ids follow the operators. Rows
of one id are judged by their own texts, except that near duplicates take
them for one document. Columns of any name pass through: rows travel as one struct.
"""

from pyspark.sql import functions as F

from catalogflow.llm import decontaminate, line_dedup, mixture, odd_sketch, toxicity
from catalogflow.llm.common import packed, text_tag
from catalogflow.llm.registry import table
from catalogflow.session import materialize

ID, TEXT = "row.doc_id", "row.text"


def without_toxic(spark, docs, sf_dir):
    """Fit on the labelled documents of the corpus, drop rows that score 0.7 or more in the pass that reads them."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def without_repeated_lines(spark, docs, sf_dir):
    """Texts without lines that come again; n_chars follows the text."""
    return line_dedup.without_repeated_lines(docs)


def without_near_duplicates(spark, docs, sf_dir):
    """One document of each class at a similarity of 0.8 or more."""
    kept = odd_sketch.near_duplicates(docs, least=80).filter("kept").select("doc_id").distinct()
    return packed(docs).join(kept, F.col(ID).eqNullSafe(F.col("doc_id")), "left_semi").select("row.*")


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).filter("contaminated")
    gone = found.select("doc_id", "text_tag").distinct()
    same = F.col(ID).eqNullSafe(F.col("doc_id")) & (text_tag(F.col(TEXT)) == F.col("text_tag"))
    return packed(docs).join(gone, same, "left_anti").select("row.*")


def mixed(spark, docs, sf_dir):
    """One row per repetition that the mix takes, with its words and the targets."""
    return mixture.repetitions(docs, mixture.mix(docs))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]
# the classifier and the sketches have no SQL
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
