"""Exact dedup on a cuckoo-filter index that takes insertions and deletions.

The index has shards by digest. A shard holds one cuckoo filter (buckets of
four fingerprints, one fingerprint per live digest) and its stored keys: a row
for each live document with the full digest. A probe reads filters only; what
hits is verified against the stored digests, so a false hit changes nothing. A
filter that overflows is built again, larger, from the stored keys.
"""

import hashlib
import random
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import slices
from catalogflow.session import materialize

BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
SLOTS, KICKS, LOAD = 4, 300, 0.84
SHARD = 32_768  # digests of a shard when the index is built
FILTER = "shard int, buckets int, live long, slots binary"
KEYS = ["shard", "digest", "doc_id", "size", "copy"]
HOT = 1000  # a group of more than a 1000th of all rows is hot: there are fewer than 1000


class Index(NamedTuple):
    """shards, stored keys (one row per live document), filters (one row per shard), rows stored."""

    shards: int
    keys: DataFrame
    filters: DataFrame
    rows: int


# --- one filter, inside a task ---------------------------------------------


class Filter:
    """Cuckoo filter of 16-bit fingerprints (fewer with ``bits``, for tests)."""

    def __init__(self, buckets, slots=None, bits=16):
        self.buckets, self.bits = buckets, bits
        self.slots = np.zeros(buckets * SLOTS, np.uint16) if slots is None else np.frombuffer(slots, np.uint16).copy()
        self.kick = random.Random(buckets)

    def places(self, digests):
        """Fingerprints (never 0) and both buckets of 32-byte digests."""
        words = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 4)
        marks = (words[:, 1] % np.uint64((1 << self.bits) - 1) + np.uint64(1)).astype(np.int64)
        one = (words[:, 2] & np.uint64(self.buckets - 1)).astype(np.int64)
        return marks, one, self.other(one, marks)

    def other(self, bucket, mark):
        return bucket ^ ((mark * 0x5BD1E995) & (self.buckets - 1))

    def holds(self, digests):
        if not len(digests):
            return np.empty(0, bool)
        marks, one, two = self.places(digests)
        table = self.slots.reshape(-1, SLOTS)
        return ((table[one] == marks[:, None]) | (table[two] == marks[:, None])).any(axis=1)

    def _put(self, mark, bucket):
        at = bucket * SLOTS
        for i in range(at, at + SLOTS):
            if self.slots[i] == 0:
                self.slots[i] = mark
                return True
        return False

    def insert(self, digests):
        """False on overflow; the filter is then incomplete."""
        if not len(digests):
            return True
        marks, one, two = (x.tolist() for x in self.places(digests))
        for mark, a, b in zip(marks, one, two):
            if self._put(mark, a) or self._put(mark, b):
                continue
            for _ in range(KICKS):
                i = a * SLOTS + self.kick.randrange(SLOTS)
                mark, self.slots[i] = int(self.slots[i]), mark
                a = self.other(a, mark)
                if self._put(mark, a):
                    break
            else:
                return False
        return True

    def delete(self, digests):
        """Take out one fingerprint for each digest; all of them must be live."""
        if not len(digests):
            return
        for mark, a, b in zip(*(x.tolist() for x in self.places(digests))):
            for bucket in (a, b):
                here = np.flatnonzero(self.slots[bucket * SLOTS : bucket * SLOTS + SLOTS] == mark)
                if len(here):
                    self.slots[bucket * SLOTS + here[0]] = 0
                    break


def built(digests, least=1, bits=16):
    """The smallest filter that takes all digests, of at least ``least`` buckets."""
    buckets = max(least, 1 << max(0, int(np.ceil(np.log2(max(len(digests), 1) / (SLOTS * LOAD))))))
    while True:
        out = Filter(buckets, bits=bits)
        if out.insert(digests):
            return out
        buckets *= 2


def _row(shard, buckets, live, slots):
    return pa.table({"shard": pa.array([shard], pa.int32()), "buckets": pa.array([buckets], pa.int32()),
                     "live": pa.array([live], pa.int64()), "slots": pa.array([slots], pa.binary())})


def _build(bits):
    def run(key, digests):
        found = digests["digest"].to_pylist()
        least = max([1, *[x for x in digests["least"].to_pylist() if x]])
        made = built(found, least, bits)
        return _row(key[0].as_py(), made.buckets, len(found), made.slots.tobytes())

    return run


def _add(bits):
    """New digests into a shard's filter; no slots on overflow, and then the least number of buckets."""

    def run(key, new, held):
        digests = new["digest"].to_pylist()
        old = held.to_pylist()[0] if held.num_rows else {"buckets": 1, "live": 0, "slots": None}
        if not digests:
            return _row(key[0].as_py(), old["buckets"], old["live"], old["slots"])
        now = Filter(old["buckets"], old["slots"], bits)
        full = old["live"] + len(digests) > now.buckets * SLOTS
        if full or not now.insert(digests):
            return _row(key[0].as_py(), 2 * old["buckets"], old["live"], None)
        return _row(key[0].as_py(), now.buckets, old["live"] + len(digests), now.slots.tobytes())

    return run


def _drop(bits):
    def run(key, gone, held):
        digests = gone["digest"].to_pylist()
        old = held.to_pylist()[0]
        now = Filter(old["buckets"], old["slots"], bits)
        now.delete(digests)
        return _row(key[0].as_py(), old["buckets"], old["live"] - len(digests), now.slots.tobytes())

    return run


def _hits(bits):
    def run(key, asked, held):
        digests = asked["digest"].to_pylist()
        if not digests or not held.num_rows:
            return asked.slice(0, 0)
        old = held.to_pylist()[0]
        return asked.filter(pa.array(Filter(old["buckets"], old["slots"], bits).holds(digests)))

    return run


# --- rows -------------------------------------------------------------------


def _digests(batches):
    for batch in slices(batches, "_text"):
        texts = batch.column("_text").to_pylist()
        plain = [t.translate(None, BLANK) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("size"), batch.column("copy"),
             pa.array([hashlib.sha256(p).digest() for p in plain], pa.binary())],
            names=["doc_id", "size", "copy", "digest"])


def signed(docs, id_col="doc_id", text_col="text"):
    """doc_id, code points of the text, a tag of the row, SHA-256 of the text without blanks; no text is shuffled."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(text).cast("long").alias("size"),
                       F.monotonically_increasing_id().alias("copy"), text.cast("binary").alias("_text"))
    return rows.mapInArrow(_digests, "doc_id long, size long, copy long, digest binary")


def _shard(shards):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _distinct(rows):
    """One row per digest, combined in the map tasks."""
    return rows.groupBy("shard", "digest").agg(F.count(F.lit(1)).alias("n"))


def _written(keys, rows, shard, bits):
    shards = 1 << max(0, int(np.ceil(np.log2(max(rows, 1) / shard))))
    keys = materialize(keys.withColumn("shard", _shard(shards)).select(*KEYS), "cuckoo-keys")
    digests = _distinct(keys).withColumn("least", F.lit(1))
    filters = digests.groupBy("shard").applyInArrow(_build(bits), FILTER)
    return Index(shards, keys, materialize(filters, "cuckoo-filters"), rows)


def build(docs, id_col="doc_id", text_col="text", shard=SHARD, bits=16):
    """An index of all documents."""
    rows = materialize(signed(docs, id_col, text_col), "cuckoo-rows")
    return _written(rows, rows.count(), shard, bits)


def probe(index, digests, bits=16):
    """Digests (shard, digest, n) whose fingerprint a filter holds: all live ones and few others."""
    return digests.groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInArrow(
        _hits(bits), "shard int, digest binary, n long")


def stored(index):
    """What each live digest stands for: keep_id, keep_copy and group_size.

    The document with the most code points stays, then the smallest id (null
    counts as the largest), then the row that came first.
    """
    order = F.struct((-F.col("size")).alias("size"), F.col("doc_id").isNull().alias("none"), "doc_id", "copy")
    groups = index.keys.groupBy("digest").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return groups.select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.copy").alias("keep_copy"), "group_size")


def lookup(index, rows, bits=16):
    """One row per distinct digest of ``rows`` (columns of ``signed``) that is live, with what it stands for.

    A hit of the filter is verified against the stored digests; digests that
    miss never reach them.
    """
    hits = probe(index, _distinct(rows.withColumn("shard", _shard(index.shards))), bits)
    return hits.select("digest").join(stored(index), "digest")


def insert(index, docs, id_col="doc_id", text_col="text", shard=SHARD, bits=16):
    """The index with more documents.

    Live digests get another stored key only. New ones, and false hits, go into
    the filters; shards that overflow are built again from their stored keys.
    With four times the digests that the shards were made for, all are dealt anew.
    """
    rows = materialize(signed(docs, id_col, text_col), "cuckoo-rows")
    total = index.rows + rows.count()
    # rows of one batch share a partition number with those of another one
    ahead = (index.keys.agg(F.max("copy")).first()[0] or 0) + 1
    rows = rows.withColumn("copy", F.col("copy") + ahead).withColumn("shard", _shard(index.shards)).select(*KEYS)
    keys = materialize(index.keys.unionByName(rows), "cuckoo-keys")
    if total > 4 * index.shards * shard:
        return _written(keys, total, shard, bits)
    arrived = _distinct(rows)
    hits = probe(index, arrived, bits).select("digest")
    known = hits.join(index.keys.select("digest").distinct(), "digest", "left_semi")
    new = arrived.join(known, "digest", "left_anti").select("shard", "digest")
    tried = materialize(new.groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInArrow(_add(bits), FILTER),
                        "cuckoo-tried")
    full = tried.filter("slots is null").select("shard", F.col("buckets").alias("least"))
    again = _distinct(keys).join(full, "shard").groupBy("shard").applyInArrow(_build(bits), FILTER)
    filters = materialize(tried.filter("slots is not null").unionByName(again), "cuckoo-filters")
    return Index(index.shards, keys, filters, total)


def delete(index, docs, id_col="doc_id", text_col="text", bits=16):
    """The index without the documents that have the id and text of a row of ``docs``.

    A digest leaves its filter with its last stored key; what the index does
    not hold is ignored, so no fingerprint of another digest can go.
    """
    gone = signed(docs, id_col, text_col).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    keys = materialize(index.keys.join(gone, same, "left_anti"), "cuckoo-keys")
    dead = index.keys.join(gone, same, "left_semi").select("shard", "digest").distinct()
    dead = dead.join(keys.select("digest").distinct(), "digest", "left_anti")
    kept = index.filters.join(dead.select("shard").distinct(), "shard", "left_anti")
    changed = index.filters.join(dead.select("shard").distinct(), "shard", "left_semi")
    less = dead.select("shard", "digest").groupBy("shard").cogroup(changed.groupBy("shard")).applyInArrow(_drop(bits), FILTER)
    return Index(index.shards, keys, materialize(kept.unionByName(less), "cuckoo-filters"), keys.count())


def resolve(index, rows, bits=16):
    """Each of ``rows`` (columns of ``signed``) whose digest is live, with keep_id, keep_copy and group_size.

    Groups of more than a 1000th of the stored rows, of which there are fewer
    than 1000, meet their rows in the map tasks; all other groups are small
    and joined by digest.
    """
    found = materialize(lookup(index, rows, bits), "cuckoo-found")
    is_hot = F.col("group_size") * HOT > F.lit(max(index.rows, HOT))
    facts = ["keep_id", "keep_copy", "group_size"]
    hot = found.filter(is_hot).select(F.col("digest").alias("_digest"), *facts)
    met = rows.join(F.broadcast(hot), F.col("digest") == F.col("_digest"), "left")
    done = met.filter("_digest is not null").drop("_digest")
    rest = met.filter("_digest is null").drop("_digest", *facts)
    return done.unionByName(rest.join(found.filter(~is_hot), "digest").select(*done.columns))


def deduplicate(docs, id_col="doc_id", text_col="text", shard=SHARD, bits=16):
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    Texts are equal if they are so without blanks (space, tab to carriage
    return). A null text is empty; empty texts are equal. A null id counts as
    the largest. Of repeated rows (equal id and text) one is kept. An empty
    table gives no rows. Texts of any length are read whole. Other columns are
    left out, so none of them can clash.
    """
    index = build(docs, id_col, text_col, shard, bits)
    out = resolve(index, index.keys, bits)
    return out.select("doc_id", "keep_id", "group_size", (F.col("copy") == F.col("keep_copy")).alias("kept"), "digest")
