"""Passage dedup over words by difference-cover anchors.

Positions whose remainder modulo a period lies in a difference cover carry an
anchor: the hash of the words that follow. For any two places of one passage
some shift of less than a period brings both onto the cover, so a passage of
``window`` words holds an anchor at one and the same offset in every copy.
Anchors that two documents share are then extended to all windows around them,
and the windows are compared by 128-bit hashes.
"""

import numpy as np
from pyspark.sql import functions as F

from catalogflow.llm.common import (
    ROW, Rolling, covered, exact_copies, keyed, near, plain_id, slices, unpacked, word_hashes,
)
from catalogflow.llm.sharing import SCHEMA, combined, positions

# fixed values: perfect difference sets by their period
COVERS = {1: (0,), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def cover_of(window):
    """Period and cover whose anchors keep at least a third of the window."""
    period = max(p for p in COVERS if 3 * p <= 2 * window or p == 1)
    return period, COVERS[period]


def _anchors(window):
    period, cover = cover_of(window)
    width = window - period + 1

    def run(batches):
        roll, on = Rolling(BASE_A), np.isin(np.arange(period), cover)
        for batch in slices(batches, "_text"):
            found = []
            ids, tags = batch.column("_id").to_numpy(), batch.column("_row").to_numpy()
            for i, text in enumerate(batch.column("_text").to_pylist()):
                words = text.split()
                if len(words) < window:
                    continue
                a = roll.windows(word_hashes(words), width)
                p = np.flatnonzero(np.resize(on, len(a)))
                found.append((a[p], np.full(len(p), i), p))
            if found:
                key, doc, pos = (np.concatenate(x) for x in zip(*found))
                yield from combined(key, np.zeros(len(key), np.uint64), ids[doc], tags[doc], pos, strict=False)

    return run


def _windows(window):
    reach = cover_of(window)[0] - 1

    def run(batches):
        one, two = Rolling(BASE_A), Rolling(BASE_B)
        for batch in slices(batches, "_text"):
            found = []
            ids, tags = batch.column("_id").to_numpy(), batch.column("_row").to_numpy()
            rows = zip(batch.column("_text").to_pylist(), batch.column("_pos").to_pylist())
            for i, (text, pos) in enumerate(rows):
                words = text.split()
                p = near(unpacked(pos), reach, len(words) - window)
                if len(p):
                    h = word_hashes(words)
                    a, b = one.windows(h, window), two.windows(h ^ np.uint64(BASE_B), window)
                    found.append((a[p], b[p], np.full(len(p), i), p))
            if found:
                a, b, doc, pos = (np.concatenate(x) for x in zip(*found))
                yield from combined(a, b, ids[doc], tags[doc], pos, strict=True)

    return run


def _kept(window):
    import pyarrow as pa

    def run(batches):
        for batch in slices(batches, "_text"):
            words_n, removed_n, kept = [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("_text", "_pos", "first")))
            for text, pos, first in rows:
                words, n = text.split(), 0
                if first is not None and len(words) >= window:
                    left, n = [], len(words)
                elif pos:
                    gone = covered(unpacked(pos), window, len(words))
                    n, left = int(gone.sum()), [words[i] for i in np.flatnonzero(~gone)]
                else:
                    left = words
                words_n.append(len(words))
                removed_n.append(n)
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(words_n, pa.int64()), pa.array(removed_n, pa.int64()),
                 pa.array(kept, pa.binary())], names=["_id", "n_words", "n_removed", "kept"])

    return run


def dedup_passages(docs, window=50, id_col="doc_id", text_col="text"):
    """Remove each word covered by a window of words that a smaller id also holds.

    Returns one row per input row: the id, n_words, n_removed and kept_text
    (kept words joined by one space). Words are runs of characters other than
    ASCII white space. Windows are judged on the input. A null or empty text has
    no words; texts shorter than the window stay whole; rows that share an id do
    not remove each other's words (equal rows get equal results); a null id counts
    as the largest. An empty table gives an empty result.
    """
    rows = keyed(docs, id_col, text_col)
    copies = exact_copies(rows)
    shared = positions(rows.mapInArrow(_anchors(window), SCHEMA), strict=False)
    around = rows.join(shared, ROW).join(copies, ROW, "left_anti")
    gone = positions(around.mapInArrow(_windows(window), SCHEMA), strict=True)
    whole = rows.join(gone, ROW, "left").join(copies, ROW, "left")
    kept = whole.mapInArrow(_kept(window), "_id long, n_words long, n_removed long, kept binary")
    return kept.select(plain_id(id_col), "n_words", "n_removed", F.col("kept").cast("string").alias("kept_text"))
