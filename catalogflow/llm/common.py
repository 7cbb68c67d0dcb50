"""Row identity, Arrow batches and hashing shared by the operators of this folder."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

LAST_ID = 2**63 - 1
BATCH_BYTES = 16_000_000
ROW = ["_id", "_row"]


def text_tag(text):
    """A number of 24 bits that tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(0xFFFFFF))


def packed(docs):
    """All columns of a table in one struct ``row``, so that no helper column can clash with them."""
    return docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("row"))


def keyed(docs, id_col="doc_id", text_col="text"):
    """The id, a tag that tells rows of one id apart, and the text in UTF-8.

    A null id counts as larger than all others, a null text as empty. Other
    columns are left out, so none of them can clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
        text_tag(text).alias("_row"),
        text.cast("binary").alias("_text"),
    )


def plain_id(name="doc_id"):
    """The caller's id out of ``_id``."""
    return F.when(F.col("_id") != LAST_ID, F.col("_id")).alias(name)


def slices(batches, column, limit=BATCH_BYTES):
    """Arrow batches cut so that one holds few bytes of ``column`` (or one row); a function gives the values of another place, or sizes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = column(batch) if callable(column) else batch.column(column)
        size = values if isinstance(values, np.ndarray) else np.array([len(x) if x is not None else 0 for x in values.to_pylist()], np.int64)
        cut = np.cumsum(size) // limit
        starts = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(size)]):
            yield batch.slice(a, b - a)


def word_hashes(words, seed=0):
    """64-bit hashes of a list of byte strings."""
    if seed:
        return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x):
    """A bijective finalizer: spreads all bits of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of all windows of a sequence of 64-bit hashes, modulo 2^64."""

    def __init__(self, base):
        self.base, self.up, self.down = base | 1, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n):
        if len(self.up) <= n:
            size = max(2 * n, 4096)
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 2**64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def windows(self, h, w):
        n = len(h)
        if n < w:
            return np.empty(0, np.uint64)
        self._grow(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(h * self.up[:n], dtype=np.uint64, out=total[1:])
        return mixed((total[w:] - total[:-w]) * self.down[: n - w + 1])


def ints(values):
    """Positions as packed bytes."""
    return np.asarray(values, np.int32).tobytes()


def unpacked(parts):
    """Positions out of a list of packed bytes (or null), sorted and distinct."""
    return np.unique(np.frombuffer(b"".join(parts or ()), np.int32))


def starts_of(sorted_keys):
    """Where each run of equal values starts; keys: arrays of one length."""
    change = np.zeros(len(sorted_keys[0]), bool)
    if len(change):
        change[0] = True
        for k in sorted_keys:
            change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def packed_runs(values, starts):
    """One packed byte string per run."""
    raw, ends = np.ascontiguousarray(values, np.int32).tobytes(), np.r_[starts[1:], len(values)]
    return [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]


def covered(positions, width, n):
    """Which of n items are covered by windows of ``width`` that start at ``positions``."""
    edge = np.zeros(n + 1, np.int32)
    p = positions[positions <= n - width]
    np.add.at(edge, p, 1)
    np.add.at(edge, p + width, -1)
    return np.cumsum(edge[:n]) > 0


def near(positions, before, last):
    """All starts from ``p - before`` to ``p`` of any of the positions, within 0..last."""
    if last < 0 or not len(positions):
        return np.empty(0, np.int64)
    edge = np.zeros(last + 2, np.int32)
    lo, hi = np.maximum(positions - before, 0), np.minimum(positions, last)
    ok = lo <= hi
    np.add.at(edge, lo[ok], 1)
    np.add.at(edge, hi[ok] + 1, -1)
    return np.flatnonzero(np.cumsum(edge[: last + 1]) > 0)


def arrow(schema, *columns):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def exact_copies(rows):
    """Rows whose whole text also has a smaller id: (_id, _row, first).

    Only digests are shuffled; a group of any size is combined in the map tasks,
    and the join with one row per digest is split by the adaptive planner.
    """
    signed = rows.select(*ROW, F.sha2("_text", 256).alias("_digest"))
    first = signed.groupBy("_digest").agg(F.min("_id").alias("first"), F.max("_id").alias("_last"))
    first = first.filter("first < _last").drop("_last")
    return signed.join(first, "_digest").filter("_id > first").select(*ROW, "first").distinct()
