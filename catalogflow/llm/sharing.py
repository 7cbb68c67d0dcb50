"""Keys that several documents hold, found with one shuffle and no hot task.

A task first combines the keys of each Arrow batch. What the batch decides by
itself travels under a key of its own; under the shared key goes one row per
batch and document of the smallest id. So a key held by a third of all rows
has about as many rows as there are batches, whatever the size of the group.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalogflow.llm.common import ROW, arrow, mixed, packed_runs, starts_of

SCHEMA = "k1 long, k2 long, _id long, _row long, pos binary, docs int, known boolean"
ARROW = pa.schema(
    [("k1", pa.int64()), ("k2", pa.int64()), ("_id", pa.int64()), ("_row", pa.int64()), ("pos", pa.binary()),
     ("docs", pa.int32()), ("known", pa.bool_())]
)


def _rows(k1, k2, ids, tags, pos, docs, known):
    """One row per run of equal (k1, k2, id, row); the input is sorted by them."""
    s = starts_of([k1, k2, ids, tags])
    packed = packed_runs(pos, s)
    o = np.lexsort((pos[s], tags[s], ids[s]))  # rows of one document side by side compress better
    s = s[o]
    return arrow(ARROW, k1[s].view(np.int64), k2[s].view(np.int64), ids[s], tags[s], [packed[i] for i in o.tolist()],
                 docs[s].astype(np.int32), np.full(len(s), known))


def combined(k1, k2, ids, tags, pos, strict):
    """Rows for the shuffle out of one batch's occurrences of keys.

    strict: an occurrence counts if a smaller id holds the key (else: if any
    other id does).
    """
    if not len(k1):
        return
    order = np.lexsort((pos, tags, ids, k2, k1))
    k1, k2, ids, tags, pos = (x[order] for x in (k1, k2, ids, tags, pos))
    s = starts_of([k1, k2])
    size = np.diff(np.r_[s, len(k1)])
    new = np.zeros(len(k1), np.int64)
    new[starts_of([k1, k2, ids])] = 1
    docs = np.repeat(np.add.reduceat(new, s), size)
    first = ids == np.repeat(ids[s], size)
    here = ~first if strict else docs > 1
    if here.any():
        a, b, p = ids[here], tags[here], pos[here]
        o = np.lexsort((p, b, a))
        a, b, p = a[o], b[o], p[o]
        own = mixed(a.view(np.uint64) * np.uint64(31) + b.view(np.uint64))
        yield _rows(own, ~own, a, b, p, np.zeros(len(a), np.int64), True)
    if strict:
        send = first
        yield _rows(k1[send], k2[send], ids[send], tags[send], pos[send], docs[send], False)
    else:
        send = first & (docs == 1)
        yield _rows(k1[send], k2[send], ids[send], tags[send], pos[send], docs[send], False)
        lead = s[docs[s] > 1]  # their positions are known; this only tells the other batches
        if len(lead):
            yield arrow(ARROW, k1[lead].view(np.int64), k2[lead].view(np.int64), ids[lead], tags[lead],
                        [b""] * len(lead), docs[lead].astype(np.int32), np.zeros(len(lead), bool))


def positions(sent, strict, heat=None):
    """One row per document: the packed positions whose keys are shared.

    sent: rows of ``combined``. With ``heat``, positions whose key is held by
    more documents than that come in a column of their own, ``hot``.
    """
    key = Window.partitionBy("k1", "k2")
    sent = sent.withColumns({"_lo": F.min("_id").over(key), "_hi": F.max("_id").over(key),
                             "_docs": F.sum("docs").over(key)})
    if strict:
        kept = sent.filter("known or _id > _lo")
    else:
        kept = sent.filter("known or _lo < _hi or _docs > 1").filter("length(pos) > 0")
    out = [F.collect_list("pos").alias("_pos")]
    if heat:
        out = [F.collect_list(F.when(F.col("_docs") <= heat, F.col("pos"))).alias("_pos"),
               F.collect_list(F.when(F.col("_docs") > heat, F.col("pos"))).alias("_hot")]
    return kept.groupBy(*ROW).agg(*out)
