"""Approximate nearest neighbours by an inverted multi-index.

Each half of a vector is quantised by its own centroids; a pair of centroids is
a cell. The nearest are those of the largest inner product, so the distance of a half is
the negative of the product that its centroid promises: with the centroid, and with two
deviations of what lies around it (long vectors lie far from their centroids). A query
visits cells by the sum of both with a heap, until they hold enough
entries, and the entries are ranked by their exact inner product. Cells are dealt out in blocks of bounded size, a large cell in several,
and queries in chunks, so that a task gets one block of either.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalogflow.llm.common import mixed
from catalogflow.session import materialize, spread

# visit: without clusters in the data, 0.9 of the true neighbours lie in about half of the entries
CENTROIDS, SAMPLE, VISIT, BLOCK, SEED = 64, 20_000, 0.55, 4096, 0
DEVIATIONS = 2.0


def valid(vectors, id_col="vec_id", vector_col="embedding"):
    """(vec_id, v, dims): rows with an id and a vector that is not null, empty or zero, all components finite."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & v.isNotNull()).filter(fine).withColumn("dims", F.size("v"))


def kmeans(points, k, rounds=15, seed=SEED):
    """Lloyd's centroids of a sample, at most k."""
    if not points.shape[1]:  # the first half of vectors of one component
        return np.zeros((1, 0))
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    centres = points[rng.permutation(len(points))[:k]]
    for _ in range(rounds):
        near = (centres**2).sum(1) - 2 * points @ centres.T
        label = near.argmin(1)
        count = np.bincount(label, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, label, points)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def fit(rows, centroids=CENTROIDS, sample=SAMPLE):
    """(centroids, deviations) of both halves, from at most ``sample`` vectors (those of the smallest hashes)."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    points = np.array([r[0] for r in picked])
    half = points.shape[1] // 2
    return [_spread_out(part, kmeans(part, centroids)) for part in (points[:, :half], points[:, half:])]


def _spread_out(points, centres):
    """Centroids and, for each, the deviation of a component of what lies around it."""
    label = _codes(points, centres)
    squares = ((points - centres[label]) ** 2).sum(1)
    count = np.bincount(label, minlength=len(centres))
    mean = np.bincount(label, squares, len(centres)) / np.maximum(count, 1) / max(points.shape[1], 1)
    return centres, np.sqrt(mean)


def promised(queries, centres, deviations):
    """The distance of each half query to each centroid: the negative of the product to be expected there at best."""
    length = np.sqrt((queries**2).sum(1, keepdims=True))
    return -(queries @ centres.T) - DEVIATIONS * length * deviations


def _codes(points, centres):
    return ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)


def _matrix(batch, column="v"):
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def _assigned(one, two):
    half = one.shape[1]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch)
                cell = _codes(m[:, :half], one) * len(two) + _codes(m[:, half:], two)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(cell, pa.int32())],
                                                 names=["vec_id", "v", "cell"])

    return run


def _dealt(blocks, cells):
    """Entries with their block; those of a large cell go round its blocks by a hash of the id."""
    first, parts = np.zeros(cells, np.int64), np.ones(cells, np.int64)
    for cell, own in blocks.items():
        first[cell], parts[cell] = own[0], len(own)

    def run(batches):
        for batch in batches:
            cell, ids = batch.column("cell").to_numpy(), batch.column("vec_id").to_numpy()
            turn = (mixed(ids.view(np.uint64)) % parts[cell].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((first[cell] + turn).astype(np.int32))],
                                             names=["vec_id", "v", "cell", "block"])

    return run


def visited(first, second, sizes, enough):
    """Cells in the order of summed distance, until they hold ``enough`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, out, held = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if sizes[cell]:
            out.append(cell)
            held += sizes[cell]
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))
    return out


def _probing(one, two, sizes, blocks, enough):
    """Each query's cells, gathered by the block that holds them."""
    half = one[0].shape[1]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch)
            first, second = promised(m[:, :half], *one), promised(m[:, half:], *two)
            at, block, cells = [], [], []
            for i in range(len(m)):
                mine = {}
                for cell in visited(first[i], second[i], sizes, enough):
                    for b in blocks[cell]:
                        mine.setdefault(b, []).append(cell)
                at += [i] * len(mine)
                block += list(mine)
                cells += list(mine.values())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at, pa.int64())), batch.column("v").take(pa.array(at, pa.int64())),
                 pa.array(block, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], names=["query_id", "q", "block", "cells"])

    return run


def _ranked(k):
    def run(entries, queries):
        import pandas as pd

        if not len(entries) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, q = np.array(entries["v"].tolist()), np.array(queries["q"].tolist())
        ids, cell = entries["vec_id"].to_numpy(), entries["cell"].to_numpy()
        rough, out = q @ x.T, []
        for i, (own, cells) in enumerate(zip(queries["query_id"], queries["cells"])):
            can = np.flatnonzero(np.isin(cell, cells) & (ids != own))
            if len(can) > k:  # rounding apart, the k best and what ties with them
                least = np.partition(rough[i, can], -k)[-k]
                can = can[rough[i, can] >= least - 1e-9 * max(1.0, abs(least))]
            score = (x[can] * q[i]).sum(1)
            best = np.lexsort((ids[can], -score))[:k]
            out += zip([own] * len(best), ids[can][best].tolist(), score[best].tolist())
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def search(vectors, queries=None, k=20, centroids=CENTROIDS, visit=VISIT, sample=SAMPLE, block=BLOCK, id_col="vec_id",
           vector_col="embedding"):
    """The ``k`` nearest found of every query by inner product: query_id, rank, vec_id, score.

    queries: a condition on ``vec_id`` (default: all rows). A query's own id is
    no candidate. A query visits cells until they hold the share ``visit`` of
    all entries (or 4 k, if that is more). Vectors that are null, empty, zero or
    hold null or non-finite components, rows without id and vectors of another
    length than the most frequent take no part; repeated rows are candidates
    each. Ties go to the smaller vec_id. No valid vector: no rows.
    """
    rows = valid(vectors, id_col, vector_col)
    lengths = rows.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    out = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], out)
    rows = rows.filter(F.col("dims") == lengths["dims"]).drop("dims")
    halves = fit(rows, centroids, sample)
    one, two = halves[0][0], halves[1][0]
    entries = materialize(rows.mapInArrow(_assigned(one, two), "vec_id long, v array<double>, cell int"), "cells")
    # at most centroids squared rows, whatever the size of the corpus
    sizes = np.zeros(len(one) * len(two), np.int64)
    for cell, n in entries.groupBy("cell").count().collect():
        sizes[cell] = n
    # whole cells share a block; a large cell takes several blocks of its own
    blocks, now, held = {}, -1, block
    for cell in np.flatnonzero(sizes).tolist():
        n = int(sizes[cell])
        if n > block:
            parts = -(-n // block)
            blocks[cell] = list(range(now + 1, now + 1 + parts))
            now, held = now + parts, block
        else:
            if held + n > block:
                now, held = now + 1, 0
            blocks[cell] = [now]
            held += n
    asked = entries.filter(queries) if queries else entries
    enough = max(4 * k, int(visit * sizes.sum()))
    n_queries = asked.count()
    chunks = -(-n_queries // block)
    dealt = entries.mapInArrow(_dealt(blocks, len(sizes)), "vec_id long, v array<double>, cell int, block int")
    dealt = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(max(chunks, 1) - 1))))
    # few bytes, much work: the queries are dealt to all tasks
    probes = spread(asked.select("vec_id", "v").distinct(), "vec_id").mapInArrow(
        _probing(*halves, sizes, blocks, enough), "query_id long, q array<double>, block int, cells array<int>")
    probes = probes.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(max(chunks, 1))).cast("int"))
    found = dealt.groupBy("block", "chunk").cogroup(probes.groupBy("block", "chunk")).applyInPandas(
        _ranked(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def recall(found, vectors, k=20, id_col="vec_id", vector_col="embedding"):
    """Share of the true ``k`` nearest that were found, by brute force in numpy (for tests)."""
    rows = valid(vectors, id_col, vector_col).collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["v"] for r in rows])
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = total = 0
    for own, mine in got.items():
        score = x @ x[np.flatnonzero(ids == own)[0]]
        score[ids == own] = -np.inf
        true = ids[np.lexsort((ids, -score))[: min(k, int((ids != own).sum()))]]
        hit, total = hit + len(mine & set(true.tolist())), total + len(true)
    return hit / max(total, 1)
