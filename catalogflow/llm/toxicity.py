"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly.

A word is the mean of the vectors of its character n-grams (with its borders),
a passage the mean of its words, and a linear softmax over the passage decides;
a document is as toxic as its worst passage. A passage has a fixed number of
places; a word that comes again in it counts once, so that repetition does not
add up. Vectors and softmax are trained
together in numpy. Misspellings share n-grams with the words that were seen.
For scoring, each n-gram's vector is folded with the softmax into one number.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from catalogflow.llm.common import packed, slices

# a passage of one word is the best on held-out rows; larger ones read context
BUCKET_BITS, DIM, SIZES, PASSAGE = 16, 8, (3, 4, 5, 6), 1
GRAM_BLOCK = 250_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SPACE = 32
# ASCII letters and digits stay, other ASCII counts as white space
TABLE = bytes(c if c > 127 or chr(c).isalnum() else SPACE for c in range(256))


def normal(text):
    """Lower-case words with one space before and after each, as bytes."""
    return b" " + b" ".join(text.decode("utf-8", "replace").lower().encode().translate(TABLE).split()) + b" "


def grams(buffer):
    """n-grams of a buffer of words: for each size, the bucket at each place and whether it is an n-gram.

    An n-gram lies in one word, its left and right border included.
    """
    raw = np.frombuffer(buffer, np.uint8)
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint64)
    place = np.arange(n)
    space = np.flatnonzero(raw == SPACE)
    # the next space strictly after each place
    stop = np.append(space, n)[np.searchsorted(space, place, side="right")]
    key, shift = np.zeros(n, np.uint64), np.uint64(64 - BUCKET_BITS)
    for k in range(max(SIZES)):
        key = key | (padded[k : k + n] << np.uint64(8 * k))
        if k + 1 in SIZES:
            spread = (key ^ np.uint64((k + 1) << 56)) * MULTIPLIER
            yield (spread >> shift).astype(np.int32), stop - place >= k


def word_sums(buffer, weights):
    """For each word: the mean weight of its n-grams, and a hash of 32 bits."""
    total, count = np.zeros(len(buffer), np.float32), np.zeros(len(buffer), np.int32)
    mark = np.zeros(len(buffer), np.uint32)
    for bucket, ok in grams(buffer):
        total += np.where(ok, weights[bucket], np.float32(0))
        count += ok
        mark += np.where(ok, bucket.astype(np.uint32) * np.uint32(0x9E3779B1) ^ np.uint32(0x85EBCA6B), np.uint32(0))
    border = np.flatnonzero(np.frombuffer(buffer, np.uint8) == SPACE)
    if len(border) < 2:
        return np.empty(0, np.float32), np.empty(0, np.uint32)
    cut = border[:-1]
    return np.add.reduceat(total, cut) / np.maximum(np.add.reduceat(count, cut), 1), np.add.reduceat(mark, cut)


def first_of(passage, word):
    """Which words of the passages come there for the first time (or the only one)."""
    key = passage.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)
    keep = np.zeros(len(key), bool)
    keep[np.unique(key, return_index=True)[1]] = True
    return keep


def margins(texts, model):
    """The largest passage margin of each text; the prior for texts without words."""
    weights, bias = model["weights"], model["bias"]
    out = np.full(len(texts), np.float32(model["prior"]))
    parts, sizes = [], []
    for t in texts:
        b = normal(t)
        parts.append(b[:-1])
        sizes.append(b.count(b" ") - 1 if len(b) > 2 else 0)
    full = [i for i, n in enumerate(sizes) if n]
    if not full:
        return out
    scores, marks = word_sums(b"".join(parts[i] for i in full) + b" ", weights)
    counts = np.array([sizes[i] for i in full])
    first = np.r_[0, np.cumsum(counts)[:-1]]
    inside = np.arange(len(scores)) - np.repeat(first, counts)
    starts = inside % PASSAGE == 0
    cut = np.flatnonzero(starts)
    once = np.where(first_of(np.cumsum(starts), marks), scores, 0)
    mean = np.add.reduceat(once, cut) / PASSAGE
    out[full] = np.maximum.reduceat(mean, np.searchsorted(cut, first)) + bias
    return out


def word_grams(buffer, part=GRAM_BLOCK):
    """(word, bucket) of every n-gram of a buffer of words, sorted by word; a part of the buffer at a time."""
    words, buckets, at, done = [], [], 0, 0
    while at < len(buffer) - 1:
        end = len(buffer) if at + part >= len(buffer) else buffer.rindex(b" ", at + 1, at + part) + 1
        if end - at < 2:
            end = buffer.index(b" ", at + part) + 1
        piece = buffer[at:end]
        border = (np.cumsum(np.frombuffer(piece, np.uint8) == SPACE) - 1).astype(np.int32)
        found = [(border[ok], bucket[ok]) for bucket, ok in grams(piece)]
        word = np.concatenate([f[0] for f in found])
        order = np.argsort(word, kind="stable")
        words.append(word[order] + np.int32(done))
        buckets.append(np.concatenate([f[1] for f in found])[order])
        done += int(border[-1])
        at = end - 1
    return np.concatenate(words), np.concatenate(buckets)


def train(samples, rounds=120, rate=0.01, seed=0):
    """Fit on an iterable of (text, label); returns the folded model.

    Each round takes every sample's worst passage (in the first rounds a mean
    over all passages) and moves the vectors of its n-grams and the softmax by
    one Adam step. Memory grows with the distinct words and the number of words
    of the sample.
    """
    vocabulary, tokens, fresh, labels = {}, [], [], []
    for text, label in samples:
        words = normal(text or b"").split()
        if not words:
            continue
        tokens.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int32, len(words)))
        fresh.append(first_of(np.arange(len(words)) // PASSAGE, tokens[-1]))
        labels.append(float(label))
    y = np.array(labels)
    rate_of = float(y.mean()) if len(y) else 0.0
    prior = float(np.log((rate_of + 1e-3) / (1 - rate_of + 1e-3)))
    model = {"weights": np.zeros(2**BUCKET_BITS, np.float32), "bias": prior, "prior": prior}
    if not len(y) or rate_of in (0.0, 1.0):
        return model
    # n-grams of each distinct word, as (word, bucket) pairs sorted by word
    buffer, n_words = b" " + b" ".join(vocabulary) + b" ", len(vocabulary)
    vocabulary.clear()
    word, bucket = word_grams(buffer)
    start = np.searchsorted(word, np.arange(n_words + 1))
    size = np.diff(start)
    del word, buffer
    # words whose n-grams fill a block, so that no step holds a value for each n-gram of all words
    blocks = np.unique(np.r_[np.searchsorted(start, np.arange(0, len(bucket), GRAM_BLOCK)), n_words])
    lengths = np.array([len(t) for t in tokens])
    token, once = np.concatenate(tokens), np.concatenate(fresh) / np.float32(PASSAGE)
    tokens.clear(), fresh.clear()
    passages = -(-lengths // PASSAGE)
    of_doc = np.r_[0, np.cumsum(passages)[:-1]]
    first = np.r_[0, np.cumsum(lengths)[:-1]]
    inside = np.arange(passages.sum()) - np.repeat(of_doc, passages)
    cut = (np.repeat(first, passages) + inside * PASSAGE).astype(np.int32)
    passage_size = np.diff(np.append(cut, np.int32(len(token))))
    del inside
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (2**BUCKET_BITS, DIM)).astype(np.float32)
    softmax = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32)
    bias = np.array([0.0, prior], np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, softmax, bias)]
    for step in range(1, rounds + 1):
        direction = softmax[:, 1] - softmax[:, 0]
        folded = vectors @ direction
        by_word = np.concatenate([np.add.reduceat(folded[bucket[start[a] : start[b]]], start[a:b] - start[a])
                                  for a, b in zip(blocks, blocks[1:])]) / size
        by_passage = np.add.reduceat(by_word[token] * once, cut) + bias[1] - bias[0]
        if step <= rounds // 8:
            share = np.repeat(1 / passages, passages)
            margin = np.add.reduceat(by_passage, of_doc) / passages
        else:
            margin = np.maximum.reduceat(by_passage, of_doc)
            hit = np.flatnonzero(by_passage == np.repeat(margin, passages))
            doc = np.searchsorted(of_doc, hit, side="right") - 1
            share = np.zeros(len(cut))
            share[hit[np.unique(doc, return_index=True)[1]]] = 1
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / len(y)
        at_passage = np.repeat(error, passages) * share
        at_word = np.bincount(token, np.repeat(at_passage, passage_size) * once, n_words) / size
        at_gram = np.zeros(2**BUCKET_BITS)
        for a, b in zip(blocks, blocks[1:]):
            live = a + np.flatnonzero(at_word[a:b])
            spots = np.repeat(start[live] - np.r_[0, np.cumsum(size[live])[:-1]], size[live]) + np.arange(size[live].sum()) if len(live) else live
            at_gram += np.bincount(bucket[spots], np.repeat(at_word[live], size[live]), 2**BUCKET_BITS)
        at_gram = at_gram.astype(np.float32)
        sum_vector = at_gram @ vectors
        total = at_passage.sum()
        slopes = [np.outer(at_gram, direction), np.stack([-sum_vector, sum_vector], 1), np.array([-total, total])]
        for values, (m, v), slope in zip((vectors, softmax, bias), state, slopes):
            slope = slope.astype(np.float32)
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            values -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    direction = softmax[:, 1] - softmax[:, 0]
    return {"weights": vectors @ direction, "bias": float(bias[1] - bias[0]), "prior": prior}


def training_rows(docs, labels, most=1500, id_col="doc_id", text_col="text", label_col="toxic", hold_out=True):
    """A bounded sample of labelled documents: up to ``most`` of each label.

    Rows whose crc32 of the id modulo 3 is 1 are held out. A document with
    several labels takes the largest; rows without id or label are left out.
    """
    marks = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
    marks = marks.dropna().groupBy("_id").agg(F.max("_y").alias("_y"))
    if hold_out:
        marks = marks.filter(F.crc32(F.col("_id").cast("string").cast("binary")) % 3 != 1)
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = [marks.filter(f"_y {c} 1").orderBy(*order).limit(most) for c in ("=", "<>")]
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    return chosen[0].unionByName(chosen[1]).join(texts, "_id").select("_id", "_text", (F.col("_y") == 1).cast("int").alias("_y"))


def fit(docs, labels, most=1500, **columns):
    """Train on ``training_rows``; the rows come to the driver one partition at a time, in a fixed order."""
    rows = training_rows(docs, labels, most, **columns).orderBy("_id", F.xxhash64("_text"))
    return train((r["_text"], r["_y"]) for r in rows.toLocalIterator())


def _scored(model):
    def run(batches):
        for batch in slices(batches, "_text", 2_000_000):
            z = margins(batch.column("_text").to_pylist(), model).astype(np.float64)
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(score)], names=["_id", "score"])

    return run


def score(docs, model, threshold=0.7, id_col="doc_id", text_col="text"):
    """Score every whole text: doc_id, score (0 to 1) and predicted (1 from ``threshold`` on).

    Null and empty texts get the share of toxic labels in the sample. Repeated
    rows and null ids are scored like any other row; without labels of both
    kinds all scores are that share.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    out = rows.mapInArrow(_scored(model), "_id long, score double")
    return out.select(F.col("_id").alias("doc_id"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs, model, threshold=0.7, text_col="text"):
    """The rows whose text scores below ``threshold``, with all columns, in the pass that reads them.

    Each row is judged by its own text, whatever its id; nothing is shuffled.
    """

    def texts_of(batch):
        return batch.column("row").field(text_col)

    def run(batches):
        for batch in slices(batches, texts_of, 2_000_000):
            z = margins([(t or "").encode() for t in texts_of(batch).to_pylist()], model).astype(np.float64)
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))) < threshold))

    rows = packed(docs)
    return rows.mapInArrow(run, rows.schema).select("row.*")
