import zlib

import numpy as np
import pytest

from catalogflow.llm import toxicity

BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.fit(docs, labels)


def test_held_out(fitted):
    docs, labels, model = fitted
    out = toxicity.score(docs, model).join(labels, "doc_id").collect()
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    bad, good = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    assert len(bad) > 50
    assert np.mean([r.predicted for r in bad]) > 0.75
    assert np.mean([r.predicted for r in good]) < 0.02


def test_misspellings_share_grams(fitted):
    model = fitted[2]
    texts = [b"you are a disgustting morron", b"what a pathetik clownn", b"the river is wide today"]
    margin = toxicity.margins(texts, model)
    assert margin[0] > margin[2] and margin[1] > margin[2]


def test_sample_is_bounded_and_never_held_out(fitted):
    docs, labels, _ = fitted
    ids = [r[0] for r in toxicity.training_rows(docs, labels, most=40).select("_id").collect()]
    assert len(ids) == 80 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)


def test_words_are_scored_by_their_own_grams():
    """The vectorised sums equal a loop over each word's n-grams."""
    rng = np.random.default_rng(0)
    weights = rng.normal(size=2**toxicity.BUCKET_BITS).astype(np.float32)
    words = ["a", "bé", "loser", "extraordinary", "x1"]
    got, _ = toxicity.word_sums(b" " + " ".join(words).encode() + b" ", weights)
    for w, score in zip(words, got):
        own, _ = toxicity.word_sums(f" {w} ".encode(), weights)
        assert score == pytest.approx(own[0], abs=1e-5)


def test_edges(spark, docs_of):
    texts = [(1, None), (2, ""), (3, " \n"), (None, "fine words here"), (5, "!!! ???"), (6, "stupid " * 50_000), (1, "again")]
    labels = spark.createDataFrame([(3, None), (None, 1), (6, 1), (6, 0), (1, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(texts), labels, hold_out=False)
    got = toxicity.score(docs_of(texts), model).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.fit(docs_of(texts), labels.limit(0))
    assert len({r.score for r in toxicity.score(docs_of(texts), none).collect()}) == 1
    assert toxicity.score(docs_of(texts).limit(0), none).collect() == []
