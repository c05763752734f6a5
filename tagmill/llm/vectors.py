"""Embedding near-duplicates with an inverted multi-index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm import graph
from tagmill.llm.common import fraction_below, staged

THRESHOLD, TARGET_RECALL = 0.9, 0.995
# Vectors in the training sample, bounds and filling of the codebooks, rows of a block.
SAMPLE, LEAST_CODES, MOST_CODES, PER_CELL, BLOCK = 4000, 8, 256, 200, 1024
# Fewest cells to visit, vectors the calibration asks for, and those of them that a band of cosines needs to count by itself.
LEAST_VISITS, QUERIES, LEAST_QUERIES = 8, 1000, 50
# Bands of cosines between the threshold and 1 for which the target must hold.
BANDS = 4


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def distances(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((points ** 2).sum(1)[:, None] - 2 * points @ codes.T + (codes ** 2).sum(1)[None], 0)


def codebook(points: np.ndarray, size: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k-means with spread starting points."""
    random = np.random.default_rng(seed)
    codes = [points[random.integers(len(points))]]
    nearest = ((points - codes[0]) ** 2).sum(1)
    while len(codes) < min(size, len(points)) and nearest.sum() > 0:
        codes.append(points[random.choice(len(points), p=nearest / nearest.sum())])
        nearest = np.minimum(nearest, ((points - codes[-1]) ** 2).sum(1))
    codes = np.array(codes)
    for _ in range(rounds):
        owner = distances(points, codes).argmin(1)
        for i in np.unique(owner):
            codes[i] = points[owner == i].mean(0)
    return codes


def visits(points: np.ndarray, first: np.ndarray, second: np.ndarray, many: int) -> np.ndarray:
    """The ``many`` nearest cells of the product grid for each point, nearest first (multi-sequence order).

    A cell is the number of its first code times the size of the second codebook
    plus the number of its second code. A cell of the i-th and the j-th nearest code
    has i * j cells that are at least as near, itself among them, so only those with
    i * j <= ``many`` are candidates.
    """
    half = points.shape[1] // 2
    left, right = distances(points[:, :half], first), distances(points[:, half:], second)
    a, b = np.argsort(left, axis=1, kind="stable")[:, :many], np.argsort(right, axis=1, kind="stable")[:, :many]
    i, j = np.nonzero(np.outer(np.arange(1, a.shape[1] + 1), np.arange(1, b.shape[1] + 1)) <= many)
    total = np.take_along_axis(left, a, 1)[:, i] + np.take_along_axis(right, b, 1)[:, j]
    order = np.argsort(total, axis=1, kind="stable")[:, :many]
    return (np.take_along_axis(a, i[order], 1) * len(second) + np.take_along_axis(b, j[order], 1)).astype(np.int64)


def place(order: np.ndarray, homes: np.ndarray) -> np.ndarray:
    """1-based place of each home in its row of visited cells, one more than their number if it is not among them."""
    there = order == homes[:, None]
    return np.where(there.any(1), there.argmax(1), order.shape[1]) + 1


def planted(points: np.ndarray, threshold: float, seed: int = 11) -> np.ndarray:
    """For each unit vector another one whose cosine to it is just ``threshold``, in a random direction."""
    other = np.random.default_rng(seed).normal(size=points.shape)
    other = unit(other - (other * points).sum(1)[:, None] * points)
    return threshold * points + np.sqrt(max(0.0, 1 - threshold ** 2)) * other


class Index:
    """Two codebooks from a bounded sample and the number of cells to visit.

    The number starts at what finds ``target`` of one planted neighbour at the
    threshold per sampled vector, so it needs no links within the sample and does
    not depend on the sizes of groups. ``calibrate`` raises it for the real links.
    """

    def __init__(self, sample: np.ndarray, rows: int, threshold: float, target: float):
        size = int(np.clip(np.sqrt(rows / PER_CELL), LEAST_CODES, MOST_CODES))
        self.dimension = sample.shape[1] if sample.ndim == 2 and len(sample) else 0
        self.first = self.second = np.zeros((1, 0))
        self.many = self.cells = 1
        if self.dimension < 2:
            return
        half = self.dimension // 2
        self.first, self.second = codebook(sample[:, :half], size), codebook(sample[:, half:], size)
        self.cells = len(self.first) * len(self.second)
        some = sample[:QUERIES]
        other, limit = planted(some, threshold), LEAST_VISITS
        while True:
            order, back = (visits(x, self.first, self.second, limit) for x in (some, other))
            found = np.sort(np.minimum(place(order, back[:, 0]), place(back, order[:, 0])))
            needed = int(found[int(np.ceil(target * len(found))) - 1])
            if needed <= order.shape[1]:
                break
            limit *= 2
        self.many = min(max(needed, LEAST_VISITS), self.cells)

    def plain(self) -> tuple:
        return self.dimension, self.first, self.second, self.many


def _assigned(shared, kind: pa.DataType):
    """``rep, n, v, home, visited``; vectors of another length than the index get a cell of their own length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dimension, first, second, many = shared.value
        for batch in batches:
            vectors = batch.column(2)
            sizes = np.diff(vectors.offsets.to_numpy())
            fit = np.flatnonzero(sizes == dimension) if dimension >= 2 else np.zeros(0, int)
            lists: list = [[-int(s)] for s in sizes]
            if len(fit):
                points = np.stack([np.asarray(vectors[int(i)].values, np.float64) for i in fit])
                points = points / np.linalg.norm(points, axis=1, keepdims=True)
                for i, cells in zip(fit, visits(points, first, second, many).tolist(), strict=True):
                    lists[i] = cells
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c[0] for c in lists], pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                                             names=["rep", "n", "v", "home", "visited"])

    return run


def _asked(shared, limit: int, threshold: float):
    """``query, band, place, n``: links of the queries with the rows of a batch by cosine and by the visits that find them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, order, first, second = shared.value
        for batch in batches:
            vectors = batch.column(1)
            fit = np.flatnonzero(np.diff(vectors.offsets.to_numpy()) == queries.shape[1])
            counted = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
            if len(fit):
                points = unit(np.stack([np.asarray(vectors[int(i)].values, np.float64) for i in fit]))
                cosine = points @ queries.T
                row, query = np.nonzero((cosine >= threshold) & (batch.column(0).to_numpy()[fit][:, None] != ids[None, :]))
                if len(row):
                    linked, at = np.unique(row, return_inverse=True)
                    back = visits(points[linked], first, second, limit)
                    band = np.clip((cosine[row, query] - threshold) / max(1 - threshold, 1e-9) * BANDS, 0, BANDS - 1).astype(np.int64)
                    places = np.concatenate([np.minimum(place(order[query[k:k + 65536]], back[at[k:k + 65536], 0]),
                                                        place(back[at[k:k + 65536]], order[query[k:k + 65536], 0]))
                                             for k in range(0, len(row), 65536)])
                    counted = np.unique(np.stack([query, band, places], 1), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in counted[0].T], pa.array(counted[1], pa.int64())],
                                             names=["query", "band", "place", "n"])

    return run


def visits_needed(counts: np.ndarray, limit: int, target: float) -> int:
    """Visits that find ``target`` of the links, each query with weight one, together and in each band; more than ``limit``: not known.

    ``counts`` has rows of query, band, place and number of links.
    """
    needed = 1
    for band in (None, *range(BANDS)):
        rows = counts if band is None else counts[counts[:, 1] == band]
        queries, at = np.unique(rows[:, 0], return_inverse=True)
        if len(queries) < LEAST_QUERIES:
            continue
        weight = rows[:, 3] / np.bincount(at, rows[:, 3])[at] / len(queries)
        found = np.cumsum(np.bincount(rows[:, 2], weight, minlength=limit + 2))
        needed = max(needed, int(np.argmax(found >= target - 1e-9)))
    return needed


def calibrate(index: Index, classes: DataFrame, queries: list, threshold: float, target: float) -> None:
    """Raise the number of visits until the real links of the queries (id, vector), sought among all classes, meet the target."""
    queries = [q for q in queries if len(q[1]) == index.dimension]
    if index.dimension < 2 or not queries:
        return
    ids, points = np.array([q[0] for q in queries], np.int64), unit(np.array([q[1] for q in queries], np.float64))
    limit = min(2 * index.many, index.cells)
    while True:
        shared = classes.sparkSession.sparkContext.broadcast((ids, points, visits(points, index.first, index.second, limit), index.first, index.second))
        found = (classes.select("rep", "v").mapInArrow(_asked(shared, limit, threshold), "query bigint, band bigint, place bigint, n bigint")
                 .groupBy("query", "band", "place").agg(F.sum("n").alias("n")))
        counts = np.array([tuple(r) for r in found.collect()], np.int64).reshape(-1, 4)
        needed = visits_needed(counts, limit, target)
        if needed <= limit:
            index.many = max(index.many, needed)
            return
        limit = min(2 * limit, index.cells)


def compare_block(ids: np.ndarray, weights: np.ndarray, points: np.ndarray, homes: np.ndarray, visited: list, query: np.ndarray,
                  cell: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between the query rows and the index rows of a cell: ids, counted links, and smallest id joined to.

    A pair seen from both of its homes is counted once for either end.
    """
    q, x = np.flatnonzero(query), np.flatnonzero(~query)
    linked = points[q] @ points[x].T >= threshold
    linked &= ids[q][:, None] != ids[x][None, :]
    counts = np.zeros(len(ids), np.int64)
    counts[q] += linked @ weights[x]
    for home in np.unique(homes[q]):
        own = homes[q] == home
        if home != cell and linked[own].any():
            blind = np.array([home not in visited[i] for i in x])
            counts[x] += (weights[q][own] @ linked[own]) * blind
    rows, columns = linked.any(1), linked.any(0)
    q, x, linked = q[rows], x[columns], linked[np.ix_(rows, columns)]
    high = np.iinfo(np.int64).max
    mine, theirs = ids[q].copy(), ids[x].copy()
    while len(q):
        low = np.where(linked, theirs[None, :], high).min(1)
        mine_next = np.minimum(mine, low)
        theirs_next = np.minimum(theirs, np.where(linked, mine_next[:, None], high).min(0))
        if (mine_next == mine).all() and (theirs_next == theirs).all():
            break
        mine, theirs = mine_next, theirs_next
    places = np.concatenate([q, x])
    return ids[places], counts[places], np.concatenate([mine, theirs])


def _compared(threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        vectors = table.column("v").combine_chunks()
        points = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), -1)
        points = points / np.linalg.norm(points, axis=1, keepdims=True)
        found = compare_block(table.column("rep").to_numpy(), table.column("n").to_numpy(), points, table.column("home").to_numpy(),
                              [set(c or ()) for c in table.column("visited").to_pylist()], table.column("query").to_numpy().astype(bool),
                              key[0].as_py(), threshold)
        return pa.table([pa.array(c) for c in found], names=["rep", "links", "low"])

    return run


def link(vectors: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL, sample: int = SAMPLE,
         block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors(vec_id, embedding)``.

    Equal vectors form one class and are compared once. Codebooks of the two
    halves of unit vectors, fitted on a bounded sample, span a grid of cells; each
    class is listed in its own cell and asks the nearest cells, as many as find
    ``target`` of planted neighbours at the threshold, and of the links that held-out
    classes have with all classes, each of them weighing the same and in each band of
    cosines. All rows are listed and all ask.
    Inside a cell, classes are compared exactly, in blocks of about ``block``
    queries and ``block`` listed classes, so a crowded cell is spread over tasks;
    pairs never leave a block, only counts and one edge per class do.

    Null, empty and zero vectors and those with null or non-finite components are
    linked with nothing, vectors of different length neither. Repeated rows count
    as vectors of their own. Rows without ``vec_id`` have no component.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)["embedding"]
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.coalesce(F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    key = F.when(good, F.sha1(F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string")))))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), key.alias("key"), "embedding")
    keys = rows.select("vec_id", "key")
    classes = staged(rows.filter("key IS NOT NULL AND vec_id IS NOT NULL").groupBy("key")
                     .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.min_by("embedding", "vec_id").alias("v")), "vectors")
    total = classes.count()
    share = min(1.0, sample / max(1, total))
    some = [r[0] for r in classes.filter(fraction_below("rep", "vectors", share)).orderBy("rep").select("v").collect()]
    usual = max({len(v) for v in some}, key=[len(v) for v in some].count, default=0)
    points = np.array([v for v in some if len(v) == usual], np.float64).reshape(-1, max(1, usual))
    index = Index(unit(points), total, threshold, target)
    held_out = classes if share >= 0.5 else classes.filter(~fraction_below("rep", "vectors", share))
    asking = fraction_below("rep", "queries", min(1.0, QUERIES / max(1, total) / (1 if share >= 0.5 else 1 - share)))
    calibrate(index, classes, [tuple(r) for r in held_out.filter(asking).select("rep", "v").collect()], threshold, target)
    shared = spark.sparkContext.broadcast(index.plain())
    placed = staged(classes.select("rep", "n", "v").mapInArrow(
        _assigned(shared, None), f"rep bigint, n bigint, v {kind}, home bigint, visited array<bigint>"), "cells")

    # Crowded cells are cut on both sides; every part of one side meets every part of the other.
    asked = placed.select(F.explode("visited").alias("cell")).groupBy("cell").agg(F.count("*").alias("asks"))
    listed = placed.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("rows"))
    # One row per cell of the grid, at most MOST_CODES squared (and one per length of odd vectors).
    parts = F.broadcast(asked.join(listed, "cell").select("cell", F.ceil(F.col("asks") / block).cast("int").alias("p"),
                                                          F.ceil(F.col("rows") / block).cast("int").alias("q")))

    def part(count: str):
        return F.pmod(F.xxhash64("rep"), F.col(count)).cast("int")

    def all_of(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    queries = (placed.withColumn("cell", F.explode("visited")).join(parts, "cell")
               .select("cell", part("p").alias("i"), all_of("q").alias("j"), "rep", "n", "v", "home",
                       F.lit(None).cast("array<bigint>").alias("visited"), F.lit(True).alias("query")))
    entries = (placed.withColumn("cell", F.col("home")).join(parts, "cell")
               .select("cell", all_of("p").alias("i"), part("q").alias("j"), "rep", "n", "v", "home", "visited", F.lit(False).alias("query")))
    found = staged(queries.unionByName(entries).groupBy("cell", "i", "j")
                   .applyInArrow(_compared(threshold), "rep bigint, links bigint, low bigint"), "links")
    joined = graph.components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    result = (classes.select("key", "rep", "n").join(links, "rep", "left")
              .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
              .select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = keys.join(result, "key", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
