"""Near-duplicate documents by MinHash bands and odd sketches.

A document is its set of word shingles. MinHash samples in bands bring possible
pairs together; the samples folded into a parity bitmap (an odd sketch) let the
population count of an XOR estimate how alike two documents are. A second bitmap
folds the whole set: its XOR can have no more bits than the sets differ in, so it
tells close pairs apart and loses none. What passes is confirmed on the full sets.
Inside a bucket all are first compared with one
member; after the components of those links are known, only members outside
the bucket's largest component meet the others, so a group of near copies costs
its size, not its square, and no link between different components is lost.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from catalogflow.llm.common import LAST_ID, Rolling, mixed, slices, word_hashes
from catalogflow.llm.components import components
from catalogflow.session import materialize

BANDS, ROWS, SKETCH_BITS = 36, 7, 1024
SKETCH = ["n_shingles", "odd", "whole", "level"]
BASE = 0xBF58476D1CE4E5B9
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))


def shingles(text, k=5, roll=None):
    """Sorted distinct 64-bit hashes of the k-word shingles of a UTF-8 text."""
    words = text.translate(bytes.maketrans(UPPER, LOWER)).split()
    if not words:
        return np.empty(0, np.uint64)
    roll = roll or Rolling(BASE)
    return np.unique(roll.windows(word_hashes(words), min(k, len(words))) ^ np.uint64(min(k, len(words))))


class Sampler:
    """MinHash samples and the odd sketch of a set."""

    def __init__(self, bands=BANDS, rows=ROWS, bits=SKETCH_BITS, seed=11):
        n = bands * rows
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 2**32, n, dtype=np.uint32)
        self.bands, self.rows, self.bits = bands, rows, bits
        self.slot = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def __call__(self, items):
        low = np.full(len(self.a), np.iinfo(np.uint32).max, np.uint32)
        short = (mixed(items) >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(items), 512):
            part = short[at : at + 512, None] * self.a + self.b
            np.minimum(low, part.min(0), out=low)
        marks = mixed(low.astype(np.uint64) ^ self.slot)
        keys = np.zeros(self.bands, np.uint64)
        for r in range(self.rows):
            keys = mixed(keys * np.uint64(31) + marks.reshape(self.bands, self.rows)[:, r])
        # the whole set, or of a large one the share whose hashes end in ``level`` zeros
        level = max(0, int(len(items) - 1).bit_length() - self.bits.bit_length() + 1)
        hashes = mixed(items)
        hashes = hashes[(hashes & np.uint64(2**level - 1)) == 0] >> np.uint64(32)
        return keys, self._parity(marks), self._parity(hashes), level

    def _parity(self, values):
        flips = np.bincount((values % np.uint64(self.bits)).astype(np.int64), minlength=self.bits) & 1
        return np.packbits(flips.astype(np.uint8)).view(np.int64)


def likeness(popcount, samples=BANDS * ROWS, bits=SKETCH_BITS):
    """Estimated Jaccard similarity from the population count of the XOR of two sketches."""
    ones = np.minimum(np.asarray(popcount, float) / bits, 0.4999)
    differing = np.log1p(-2 * ones) / np.log1p(-2 / bits)
    return 1 - differing / (2 * samples)


def _signed(k, bands, rows, bits):
    def run(batches):
        sampler, roll = Sampler(bands, rows, bits), Rolling(BASE)
        for batch in slices(batches, "_text"):
            n, same, keys, odd, whole, level = [], [], [], [], [], []
            for text in batch.column("_text").to_pylist():
                items = shingles(text, k, roll)
                n.append(len(items))
                if len(items):
                    key, sketch, full, zeros = sampler(items)
                    same.append(np.bitwise_xor.reduce(mixed(items)).tobytes() + np.sum(items * items, dtype=np.uint64).tobytes())
                    keys.append(key.view(np.int64).tolist())
                    odd.append(sketch.tolist()), whole.append(full.tolist()), level.append(zeros)
                else:
                    same.append(None), keys.append([]), odd.append(None), whole.append(None), level.append(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n, pa.int64()), pa.array(same, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64())),
                 pa.array(whole, pa.list_(pa.int64())), pa.array(level, pa.int32())],
                names=["_id", "n_shingles", "same", "keys", "odd", "whole", "level"])

    return run


def _possible(x, y, least, samples, bits):
    """Whether two members (structs of ``SKETCH``) can be ``least`` percent alike.

    Their sizes must allow it, and so must their sketches of samples, with five
    deviations of slack, and their bitmaps of whole sets: exactly where these hold
    all shingles (level 0), with six deviations where they hold a share.
    """
    floor = least / 100 - 5 * np.sqrt(least / 100 * (1 - least / 100) / samples) - 0.03
    most = int(np.flatnonzero(likeness(np.arange(bits // 2), samples, bits) >= floor).max())

    def ones(name):
        a, b = x[name], y[name]
        return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, bits // 64)), F.bit_count(a[0].bitwiseXOR(b[0])))

    small, large = F.least(x["n_shingles"], y["n_shingles"]), F.greatest(x["n_shingles"], y["n_shingles"])
    # sets so much alike differ in at most this many shingles
    differ = (small + large) * F.lit((100 - least) / (100 + least))
    share = differ / F.pow(F.lit(2.0), x["level"])
    slack = F.when(x["level"] > 0, 6 * F.sqrt(share) + 6).otherwise(F.lit(1e-6))
    return (F.lit(100) * small >= F.lit(least) * large) & (ones("odd") <= most) & (
        (x["level"] != y["level"]) | (ones("whole") <= share + slack))


def _confirmed(least, k):
    def run(batches):
        roll = Rolling(BASE)
        for batch in slices(batches, "text_b"):
            keep, last = [], (None, None)
            for a, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "text_b"))):
                if last[0] != a:
                    last = (a, shingles(x, k, roll))
                one, two = last[1], shingles(y, k, roll)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= least * (len(one) + len(two) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _links(pairs, texts, least, k):
    """Confirmed links among candidate pairs (a, b)."""
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return both.mapInArrow(_confirmed(least, k), "a long, b long")


def near_duplicates(docs, least=85, k=5, bands=BANDS, rows=ROWS, bits=SKETCH_BITS, id_col="doc_id", text_col="text"):
    """Classes of near-duplicate documents.

    Two documents are linked if ``100 * intersection >= least * union`` of their
    distinct k-word shingles (A-Z lower-cased; a shorter text is one shingle).
    Returns one row per input row: doc_id, n_shingles, component_id (smallest id
    reachable) and kept (doc_id = component_id). Null and blank texts have no
    shingles and are linked with nothing. Rows that share an id are one node of
    the link graph and each confirms by its own text; a null id counts as the
    largest and its component is null unless a smaller id is linked. With the
    standard bands a link of similarity 0.85 has a chance of 1e-6 to share no
    band. Documents with equal sets meet as one class before any pair is made.
    """
    rows_in = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
                          F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    signed = rows_in.mapInArrow(_signed(k, bands, rows, bits),
                                "_id long, n_shingles long, same binary, keys array<long>, odd array<long>, whole array<long>, level int")
    signed = materialize(signed, "signed")
    full = signed.filter("n_shingles > 0")
    # one member stands for all documents of one and the same set
    first = full.groupBy("same", "n_shingles").agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("n"))
    equal = full.select("_id", "same", "n_shingles").join(first.filter("n > 1"), ["same", "n_shingles"])
    copies = materialize(equal.select(F.col("first").alias("a"), F.col("_id").alias("b")).distinct(), "copies")
    alone = full.join(copies.filter("a <> b").select(F.col("b").alias("_id")).distinct(), "_id", "left_anti")
    # buckets of at least two members; the key of a band is of that band only, sketches stay behind
    bucket = alone.select("_id", F.explode("keys").alias("key"))
    lead = bucket.groupBy("key").agg(F.min("_id").alias("lead"), F.max("_id").alias("last"))
    bucket = materialize(bucket.join(lead.filter("lead < last").drop("last"), "key"), "buckets")
    members = materialize(bucket.select("_id").distinct(), "members")
    # both sides grow with the corpus: never a broadcast
    texts = materialize(rows_in.join(members.hint("merge"), "_id").distinct(), "texts")
    sketches = materialize(alone.join(members.hint("merge"), "_id").select("_id", F.struct(*SKETCH).alias("m")), "sketches")
    settings = (least, bands * rows, bits)
    near = bucket.filter("_id <> lead").select("lead", "_id").distinct()
    near = near.join(sketches, "_id").join(sketches.select(F.col("_id").alias("lead"), F.col("m").alias("head")), "lead")
    stars = near.filter(_possible(F.col("head"), F.col("m"), *settings)).select(F.col("lead").alias("a"), F.col("_id").alias("b"))
    star_links = materialize(_links(stars.distinct(), texts, least, k), "stars")
    label = components(star_links, "round")
    # members outside the largest component of their bucket meet all others
    parts = materialize(bucket.join(label, "_id", "left").select(
        "key", "lead", "_id", F.coalesce("component", "_id").alias("component")), "parts")
    sizes = parts.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    # the lead has met them all
    split = parts.filter("_id <> lead").join(largest.select("key", F.col("top.component").alias("top")), "key").drop("lead")
    split = split.join(sketches, "_id")
    outside = split.filter("component <> top").select(
        "key", F.col("_id").alias("x_id"), F.col("m").alias("x"), F.col("component").alias("c"))
    meet = outside.join(split, "key").filter("c <> component and (component = top or x_id < _id)").filter(
        _possible(F.col("x"), F.col("m"), *settings))
    rest = meet.select(F.least("x_id", "_id").alias("a"), F.greatest("x_id", "_id").alias("b")).distinct()
    more = materialize(_links(rest, texts, least, k), "rest")
    final = components(star_links.unionByName(more).unionByName(copies), "final")
    out = signed.select("_id", "n_shingles").join(final, "_id", "left")
    doc, comp = F.col("_id"), F.coalesce("component", "_id")
    shown = lambda c: F.when(c != LAST_ID, c)
    return out.select(shown(doc).alias("doc_id"), "n_shingles", shown(comp).alias("component_id"), (doc == comp).alias("kept"))
