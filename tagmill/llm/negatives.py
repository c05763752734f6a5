"""Hard negatives by exact search in multiway trees of split points with distance ranges.

Split points drawn from a bounded sample deal all rows to their nearest one (the borders are
hyperplanes). For each pair of split points Spark takes the least and greatest distance
from the one to the rows of the other; an anchor that looks for scores in a window looks
for distances in an annulus, and leaves out every subtree whose range does not meet it.
Inside the subtrees rows lie in bounded blocks, each a tree of the same kind whose leaves
are compared exactly. Distances follow from the integer vectors: |q - x|^2 = |q|^2 + |x|^2
- 2 score, so with the norms of a subtree a window of scores is a window of distances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import staged

POSITIVES, NEGATIVES, LOWEST, HIGHEST, SCALE = 5, 10, 30, 90, 256
# Components are held to this bound, so every score of up to 512 components fits 64 bits.
MOST_CODE = 1 << 26
# Rows in the sample that split points come from, split points of the first level and of those below, rows of a leaf.
SAMPLE, SPLITS, BRANCHES, LEAF = 4000, 32, 8, 256
# Components in a block of rows and in one of anchors, and candidates collected before they are cut to the best.
ROW_VALUES, ANCHOR_VALUES, PENDING = 1 << 21, 1 << 19, 200_000
# Rounding of distances, as a share of the vectors' lengths; ranges are widened by it.
SLACK = 1e-6
LOW, HIGH = -(1 << 62), 1 << 62

DEALT = "row bigint, vec_id bigint, label int, code array<bigint>, cell int"
RANGES = "cell int, split int, n bigint, least double, most double, small double, large double"
VISITS = "row bigint, vec_id bigint, label int, code array<bigint>, asks array<struct<ask:bigint,low:bigint,high:bigint>>, cell int"
HITS = "ask bigint, row bigint, vec_id bigint, score bigint"


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column; missing components of shorter rows are 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    values, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), sizes.max(initial=0)), np.int64)
    out[np.arange(out.shape[1])[None] < sizes[:, None]] = values
    return out


def aligned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (a, b))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exact: through doubles where these hold every sum, else in integers."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2.0 ** 52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def squares(a: np.ndarray) -> np.ndarray:
    return (a.astype(np.float64) ** 2).sum(1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(squares(a)[:, None] + squares(b)[None] - 2 * (a.astype(np.float64) @ b.T.astype(np.float64)), 0))


def spread_points(points: np.ndarray, many: int) -> np.ndarray:
    """Rows far from one another: each next one is the farthest from those before; copies count once."""
    chosen = [int(distances(points, np.round(points.mean(0))[None]).argmax())]
    nearest = distances(points, points[chosen])[:, 0]
    while len(chosen) < many and nearest.max() > SLACK * (1 + np.sqrt(squares(points).max())):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def ranges_of(away: np.ndarray, cell: np.ndarray, square: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By subtree j: least and greatest distance to each split point i, of squared norms, and the number of rows."""
    many = away.shape[1]
    ranges, norms = np.zeros((many, many, 2)), np.zeros((many, 2))
    ranges[..., 0], norms[:, 0], ranges[..., 1], norms[:, 1] = np.inf, np.inf, -np.inf, -np.inf
    for j in np.unique(cell):
        mine = cell == j
        ranges[:, j, 0], ranges[:, j, 1] = away[mine].min(0), away[mine].max(0)
        norms[j] = square[mine].min(), square[mine].max()
    return ranges, norms, np.bincount(cell, minlength=many)


def meets(away: np.ndarray, square: np.ndarray, low: np.ndarray, high: np.ndarray, ranges: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Which subtrees (columns) can hold a row that scores from ``low`` to ``high`` with an anchor (rows).

    ``away``: distances of the anchors to the split points, ``square``: their squared norms. A row x at distance r of
    the anchor has a distance to split point i between |away - r| and away + r.
    """
    alive = np.zeros((len(away), len(norms)), bool)
    for j, (small, large) in enumerate(norms):
        if small > large:
            continue
        slack = SLACK * (1 + np.sqrt(square + large))
        near = np.sqrt(np.maximum(square + small - 2.0 * high, 0)) - slack
        far_square = square + large - 2.0 * low
        far = np.sqrt(np.maximum(far_square, 0)) + slack
        least = np.maximum(near[:, None] - away, away - far[:, None]) - slack[:, None]
        most = away + (far + slack)[:, None]
        alive[:, j] = (far_square >= -slack ** 2) & ((ranges[:, j, 0] <= most) & (ranges[:, j, 1] >= least)).all(1)
    return alive


class Tree:
    """Rows of a block: split points with the ranges of all their sibling subtrees, down to leaves of rows."""

    def __init__(self, code: np.ndarray, rows: np.ndarray):
        self.rows, self.children = rows, []
        if len(rows) <= LEAF:
            return
        sample = rows[np.linspace(0, len(rows) - 1, min(len(rows), 40 * BRANCHES)).astype(int)]
        self.splits = spread_points(code[sample], BRANCHES)
        away = distances(code[rows], self.splits)
        cell = away.argmin(1)
        if len(np.unique(cell)) > 1:
            self.ranges, self.norms, _ = ranges_of(away, cell, squares(code[rows]))
            self.children = [Tree(code, rows[cell == j]) for j in range(len(self.splits))]


class Search:
    """The best ``k`` rows of a block for each window of scores: higher scores first, then smaller ids."""

    def __init__(self, code: np.ndarray, ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray, k: int, same: bool):
        self.code, self.ids, self.labels, self.numbers, self.k, self.same = code, ids, labels, numbers, k, same
        self.compared = 0

    def run(self, anchors: np.ndarray, anchor_ids: np.ndarray, anchor_labels: np.ndarray, owner: np.ndarray,
            low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows, rows and scores of what was found; ``owner`` is the anchor of each window."""
        self.anchors, self.anchor_ids, self.anchor_labels = anchors, anchor_ids, anchor_labels
        self.owner, self.low, self.high, self.square = owner, low.copy(), high, squares(anchors)
        self.found = [np.empty(0, np.int64)] * 3
        self.pending, self.waiting = [], 0
        self._visit(Tree(self.code, np.arange(len(self.code))), np.arange(len(owner)))
        self._cut()
        return self.found

    def _visit(self, tree: Tree, windows: np.ndarray) -> None:
        if not tree.children:
            step = max(LEAF, PENDING // max(1, len(windows)))
            for at in range(0, len(tree.rows), step):
                self._compare(tree.rows[at:at + step], windows)
            return
        asking, mine = np.unique(self.owner[windows], return_inverse=True)
        away = distances(self.anchors[asking], tree.splits)
        for j in away.mean(0).argsort():
            if len(tree.children[j].rows):
                # The lower ends may have risen since the last subtree.
                alive = meets(away[mine], self.square[asking][mine], self.low[windows], self.high[windows],
                              tree.ranges[:, j:j + 1], tree.norms[j:j + 1])[:, 0]
                if alive.any():
                    self._visit(tree.children[j], windows[alive])

    def _compare(self, rows: np.ndarray, windows: np.ndarray) -> None:
        asking, mine = np.unique(self.owner[windows], return_inverse=True)
        score = scores(self.anchors[asking], self.code[rows])
        self.compared += score.size
        fits = self.anchor_labels[asking][:, None] == self.labels[rows][None]
        fits = fits & (self.anchor_ids[asking][:, None] != self.ids[rows][None]) if self.same else ~fits
        score, fits = score[mine], fits[mine]
        w, r = np.nonzero(fits & (score >= self.low[windows][:, None]) & (score <= self.high[windows][:, None]))
        self.pending.append((windows[w], rows[r], score[w, r]))
        self.waiting += len(w)
        if self.waiting > PENDING:
            self._cut()

    def _cut(self) -> None:
        w, r, s = (np.concatenate(x) for x in zip(self.found, *self.pending, strict=True))
        order = np.lexsort((self.numbers[r], self.ids[r], -s, w))
        w, r, s = w[order], r[order], s[order]
        place = np.arange(len(w)) - np.searchsorted(w, w)
        last = place == self.k - 1
        self.low[w[last]] = np.maximum(self.low[w[last]], s[last])
        self.found = [x[place < self.k] for x in (w, r, s)]
        self.pending, self.waiting = [], 0


def coded(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, code`` of the rows that take part, labels moved where the id is divisible by 7."""
    x = F.col("embedding").cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    code = F.transform(x, lambda v: F.floor(F.least(F.greatest(v * SCALE, F.lit(float(-MOST_CODE))), F.lit(float(MOST_CODE)))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return (vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("int").alias("label"), code.alias("code")))


class Forest:
    """The first level: split points, the subtree of every row, and the ranges between them."""

    def __init__(self, rows: DataFrame):
        """``rows``: vec_id, label, code; they are written to the shared folder with their subtree."""
        total, self.width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("code")), F.lit(0))).first()
        chance = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(1 << 30)) < F.lit(int(min(1, SAMPLE / max(total, 1)) * (1 << 30)))
        sample = [list(r.code) for r in rows.filter(chance).select("code").collect()] or [[]]
        self.splits = spread_points(matrix(pa.array(sample, pa.list_(pa.int64()))), SPLITS)
        splits = self.splits

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell = distances(*aligned(matrix(batch.column("code")), splits)).argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], [*batch.schema.names, "cell"])

        numbered = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "code")
        self.rows = staged(numbered.mapInArrow(deal, DEALT), "dealt")

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                code, points = aligned(matrix(batch.column("code")), splits)
                ranges, norms, n = ranges_of(distances(code, points), batch.column("cell").to_numpy(), squares(code))
                j, i = np.meshgrid(np.flatnonzero(n), np.arange(len(points)), indexing="ij")
                j, i = j.ravel(), i.ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in ((j, pa.int32()), (i, pa.int32()), (n[j], pa.int64()), (ranges[i, j, 0], pa.float64()),
                                                 (ranges[i, j, 1], pa.float64()), (norms[j, 0], pa.float64()), (norms[j, 1], pa.float64()))],
                    ["cell", "split", "n", "least", "most", "small", "large"])

        found = (self.rows.mapInArrow(measure, RANGES).groupBy("cell", "split")
                 .agg(F.sum("n"), F.min("least"), F.max("most"), F.min("small"), F.max("large")).collect())
        self.ranges, self.norms = np.zeros((len(splits), len(splits), 2)), np.tile([np.inf, -np.inf], (len(splits), 1))
        self.ranges[..., 0], self.ranges[..., 1] = np.inf, -np.inf
        counts = {}
        for cell, split, n, least, most, small, large in found:
            self.ranges[split, cell], self.norms[cell], counts[cell] = (least, most), (small, large), n
        size = max(LEAF, ROW_VALUES // max(1, self.width))
        self.blocks = {cell: -(-n // size) for cell, n in counts.items()}

    def _block_count(self) -> Column:
        """Blocks of a subtree; there are at most ``SPLITS`` of them."""
        return F.element_at(F.create_map(*[F.lit(x) for pair in self.blocks.items() for x in pair]), F.col("cell"))

    def search(self, asks: DataFrame, k: int, same: bool, home: bool | None = None) -> DataFrame:
        """``ask, row, vec_id, score`` with at most ``k`` rows of each block for each ask, the best of all among them.

        ``asks``: row, vec_id, label, code and cell of an anchor, and its ``asks`` (ask, low, high). ``same`` looks for
        other ids of the anchor's label, else for other labels. ``home`` visits only the anchor's own subtree, ``False``
        only others, ``None`` all; subtrees whose ranges miss the annulus are not visited.
        """
        splits, ranges, norms = self.splits, self.ranges, self.norms

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                code, points = aligned(matrix(batch.column("code")), splits)
                away, square = distances(code, points), squares(code)
                lists = batch.column("asks")
                owner = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
                low, high = (lists.flatten().field(c).to_numpy() for c in ("low", "high"))
                alive = np.zeros((len(batch), len(points)), bool)
                np.logical_or.at(alive, owner, meets(away[owner], square[owner], low, high, ranges, norms))
                own = np.arange(len(points))[None] == batch.column("cell").to_numpy()[:, None]
                at, cell = np.nonzero(alive if home is None else alive & (own if home else ~own))
                rows = batch.take(pa.array(at, pa.int64()))
                names = ["row", "vec_id", "label", "code", "asks"]
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], pa.array(cell, pa.int32())], [*names, "cell"])

        def answer(left: pa.Table, right: pa.Table) -> pa.Table:
            code, anchors = aligned(matrix(left.column("code")), matrix(right.column("code")))
            lists = right.column("asks").combine_chunks()
            lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
            flat = lists.flatten()
            names, low, high = (flat.field(c).to_numpy() for c in ("ask", "low", "high"))
            owner = np.repeat(np.arange(len(right)), np.diff(lists.offsets.to_numpy()))
            ids, labels, numbers = (left.column(c).to_numpy() for c in ("vec_id", "label", "row"))
            if len(left) and len(right):
                block = Search(code, ids, labels, numbers, k, same)
                w, r, s = block.run(anchors, right.column("vec_id").to_numpy(), right.column("label").to_numpy(), owner, low, high)
            else:
                w = r = s = np.empty(0, np.int64)
            return pa.table([pa.array(x, pa.int64()) for x in (names[w], numbers[r], ids[r], s)], ["ask", "row", "vec_id", "score"])

        groups = max(1, -(-asks.count() // max(LEAF, ANCHOR_VALUES // max(1, self.width))))
        blocks = self._block_count()
        rows = (self.rows.withColumn("block", F.pmod(F.xxhash64("row"), blocks).cast("bigint"))
                .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
        visits = (asks.select("row", "vec_id", "label", "code", "asks", "cell").mapInArrow(visit, VISITS)
                  .withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
                  .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), (blocks - 1).cast("bigint")))))
        return (rows.groupBy("cell", "block", "part").cogroup(visits.groupBy("cell", "block", "part")).applyInArrow(answer, HITS))


def _first(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vectors`` (vec_id, embedding, label).

    Rows with a null id, label or vector, or a component that is null or not finite, take no part. Components beyond
    2^18 count as that; missing components of shorter vectors as 0. An anchor's own id is never its positive. Equal
    scores go by smaller id; rows that repeat are rows of their own, so a repeated anchor gives its rows again, and
    repeated negatives take several ranks. Where fewer positives or negatives exist all are returned. A positive with a
    score below 0 has no fitting negative. Empty tables give no rows; other columns are ignored.

    Every anchor is answered exactly; the work grows with anchors times the rows of the subtrees that ranges do not
    exclude, in blocks of bounded size.
    """
    spark = vectors.sparkSession
    forest = Forest(coded(vectors))
    if not forest.blocks:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
                                         "negative_score bigint")
    anchors = forest.rows.filter(F.col("vec_id") % every == 0)

    def asking(low: Column) -> Column:
        return F.array(F.struct(F.col("row").alias("ask"), low.alias("low"), F.lit(HIGH).alias("high")))

    near = staged(forest.search(anchors.withColumn("asks", asking(F.lit(LOW))), positives, True, home=True), "near")
    enough = _first(near, positives).filter(F.col("rank") == positives).select(F.col("ask").alias("row"), F.col("score").alias("least"))
    rest = anchors.join(enough, "row", "left").withColumn("asks", asking(F.coalesce("least", F.lit(LOW)))).drop("least")
    best = _first(near.unionByName(forest.search(rest, positives, True, home=False)), positives)
    pairs = staged(best.select(F.monotonically_increasing_id().alias("ask"), F.col("ask").alias("anchor"),
                               F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = (pairs.filter("positive_score >= 0")
               .select(F.col("anchor").alias("row"), F.struct("ask", F.expr(f"(positive_score * {LOWEST} + 99) div 100").alias("low"),
                                                              F.expr(f"(positive_score * {HIGHEST}) div 100").alias("high")).alias("a"))
               .groupBy("row").agg(F.collect_list("a").alias("asks")))
    found = _first(forest.search(anchors.join(windows, "row"), negatives, False), negatives)
    named = pairs.join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return (found.select("ask", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(named, "ask")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def sql() -> str:
    """The same in DuckDB, every anchor against every row."""
    return f"""
    WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS c
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS other_id, a.label = b.label AS same,
            list_dot_product(a.c, b.c)::BIGINT AS score
          FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, other_id, br) AS k FROM s WHERE same),
    n AS (SELECT p.anchor_id, p.other_id AS positive_id, row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.other_id, s.br) AS rank,
            s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
          FROM p JOIN s ON p.ar = s.ar WHERE p.k <= {POSITIVES} AND NOT s.same
            AND {LOWEST} * p.score <= 100 * s.score AND 100 * s.score <= {HIGHEST} * p.score)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
