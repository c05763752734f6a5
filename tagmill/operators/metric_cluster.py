"""Density clustering (DBSCAN) of vectors of any length through a metric partition.

Pivots are points of the data. Every point belongs to the cell of its nearest pivot. The
points within ``eps / 2`` of a pivot are neighbours of one another, so where they weigh at
least ``min_pts`` they are core points of one cluster and stand as one *ball*: no pair inside
is formed, however many they are. The triangle inequality decides most of what is left:

* a point as near to a ball's pivot as ``eps`` less the ball's radius is next to all of it,
* one farther than ``eps`` plus the radius is next to none of it,
* a point can only have neighbours in cells whose border is within ``eps`` of it.

Only what these leave open is compared, exactly, in bounded blocks of points, and only as long
as the answer is open. Points visit blocks in rounds, at first those around their own. One that
weighs enough with the neighbours found so far is a core point and asks no more. Core points of
one piece are not compared with each other, and those of the largest piece only answer: every
pair that could still join two pieces has an end outside of it. So where points have many
neighbours, each is compared with as many as it takes to find a few; where they have few, with
all that the partition leaves open.

Crowded cells get more pivots of their own points. Equal vectors are one point with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.session import broadcast_if_small, checkpoint

# Points per pivot that the first choice aims at, bounds of the number of pivots, and points outside of a ball that
# make a cell crowded. They shape the partition only; results do not depend on them.
PER_PIVOT, LEAST_PIVOTS, MOST_PIVOTS, CROWD = 256, 16, 4096, 4096
# Components in a block of points, points that a block has at least before a small table is cut into more than one,
# and cells of a distance matrix held at a time.
BLOCK_VALUES, LEAST_BLOCK, MATRIX = 1 << 21, 1 << 12, 1 << 18
# Distances to pivots held at a time, and partitions that blocks are dealt to beyond one for each group.
AWAY, SPARE = 1 << 20, 256
# Pairs measured by differences at a time.
DOUBTS = 1 << 14
# Share by which the bounds of the triangle inequality are widened, so that rounding leaves out nothing.
SLACK = 1e-7


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _away(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0))


def _meeting(a: np.ndarray, b: np.ndarray, eps: float) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``eps`` of given rows of ``a`` and ``b``, as places in these; those that the product form cannot
    tell apart are measured by differences.

    One product gives the squares. It is taken in single precision where its error, bounded by the
    lengths of the vectors, leaves open only a thin band around ``eps``.
    """
    one, two = (a * a).sum(1), (b * b).sum(1)
    limit, scale = eps * eps, one.max() + two.max()
    # Single precision: (components + 6) roundings of 2^-24 of at most twice the sum of squares.
    doubt = (a.shape[1] + 6) * 2.0 ** -22 * scale
    single = doubt <= 1e-3 * limit and 1e-12 < scale < 1e30
    kind = np.float32 if single else np.float64
    doubt = doubt if single else 1e-12 * (scale + limit)
    left = np.concatenate([a, one[:, None], np.ones((len(a), 1))], axis=1).astype(kind)
    right = np.concatenate([-2 * b, np.ones((len(b), 1)), two[:, None]], axis=1).astype(kind)

    def run(who: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        square = (left[who] @ right[mine].T).ravel()
        found = np.flatnonzero(square <= limit + doubt)
        i, j = np.divmod(found, len(mine))
        unsure = np.flatnonzero(square[found] > limit - doubt)
        if not len(unsure):
            return i, j
        keep = np.ones(len(found), bool)
        for at in range(0, len(unsure), DOUBTS):
            part = unsure[at:at + DOUBTS]
            keep[part] = np.sqrt(((a[who[i[part]]] - b[mine[j[part]]]) ** 2).sum(1)) <= eps
        return i[keep], j[keep]

    return run


def _near(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Pairs within ``eps``."""
    out = np.zeros((len(a), len(b)), bool)
    if out.size:
        out[_meeting(a, b, eps)(np.arange(len(a)), np.arange(len(b)))] = True
    return out


@dataclass
class _Layout:
    """Pivots, balls and blocks; all arrays but the last three go by pivot."""

    pivots: np.ndarray
    eps: float
    dense: np.ndarray   # whether the pivot has a ball
    ball: np.ndarray    # smallest id in the ball
    inner: np.ndarray   # radius of the ball
    outer: np.ndarray   # greatest distance of the other points of the cell, -1 without any
    group: np.ndarray   # balls known to be one cluster have one number
    first: np.ndarray   # first block of the ball (row 1) and of the other points (row 0)
    many: np.ndarray    # how many blocks they have
    order: np.ndarray   # pivots in the order of their blocks
    blocks: int         # how many blocks there are
    balls: int          # first block of balls

    def open(self, away: np.ndarray, far: np.ndarray, cells: np.ndarray, balls: bool) -> np.ndarray:
        """For points, distances to the pivots of ``cells`` and to their own: whose points, or balls, may be neighbours."""
        loose = SLACK * (1 + max(away.max(initial=0.0), far.max(initial=0.0)))
        border = away - far[:, None] <= 2 * self.eps + loose
        if balls:
            return self.dense[cells] & (away <= self.eps + self.inner[cells] + loose) & border
        return (away <= self.eps + self.outer[cells] + loose) & border & (self.outer[cells] >= 0)

    def sure(self, away: np.ndarray) -> np.ndarray:
        """Balls that lie within the radius as a whole."""
        return self.dense & (away <= self.eps - self.inner - SLACK * (1 + away.max(initial=0.0)))


def _deal(pivots: np.ndarray, eps: float) -> Callable:
    """Cell, distance to its pivot, and whether the point is within ``eps / 2`` of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, cell, far = _matrix(batch.column("vec")), np.empty(len(batch), np.int64), np.empty(len(batch))
            step = max(1, AWAY // len(pivots))
            for at in range(0, len(batch), step):
                away = _away(code[at:at + step], pivots)
                cell[at:at + step] = away.argmin(1)
                far[at:at + step] = away.min(1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "w", "vec")), pa.array(cell, pa.int32()), pa.array(far, pa.float64()),
                 pa.array(far <= eps / 2 * (1 - SLACK))], ["id", "w", "vec", "cell", "far", "inside"])

    return run


_DEALT = "id bigint, w bigint, vec array<double>, cell int, far double, inside boolean"


def _sample(points: DataFrame, many: int, total: int, seed: int) -> np.ndarray:
    """About ``many`` vectors chosen by their ids."""
    share = F.lit(int(min(1.0, many / max(total, 1)) * (1 << 30)))
    rows = points.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < share).select("vec").collect()
    return np.array([r.vec for r in rows], float)


def _divided(points: DataFrame, total: int, eps: float, min_pts: int) -> tuple[np.ndarray, DataFrame, dict]:
    """Pivots, dealt points and the figures of each cell; crowded cells get pivots while that makes crowds smaller."""
    pivots = _sample(points, min(MOST_PIVOTS // 2, max(LEAST_PIVOTS, total // PER_PIVOT)), total, 0)
    if not len(pivots):
        pivots = np.array([points.agg(F.min_by("vec", "id")).first()[0]], float)
    crowd, seed = None, 0
    while True:
        dealt = points.mapInArrow(_deal(pivots, eps), _DEALT)
        figures = {r.cell: r for r in dealt.groupBy("cell").agg(
            F.sum(F.when(F.col("inside"), F.col("w"))).alias("weight"), F.min(F.when(F.col("inside"), F.col("id"))).alias("ball"),
            F.max(F.when(F.col("inside"), F.col("far"))).alias("inner"), F.max(F.when(~F.col("inside"), F.col("far"))).alias("outer"),
            F.count_if(F.col("inside")).alias("n_in"), F.count_if(~F.col("inside")).alias("n_out"), F.max("far").alias("far")).collect()}
        left = {c: r.n_out + (0 if (r.weight or 0) >= min_pts else r.n_in) for c, r in figures.items()}
        crowded = [c for c, n in left.items() if n > CROWD]
        now = sum(left[c] for c in crowded)
        if not crowded or len(pivots) >= MOST_PIVOTS or (crowd is not None and now > 0.8 * crowd):
            return pivots, dealt, figures
        crowd, seed = now, seed + 1
        wanted = broadcast_if_small(points.sparkSession.createDataFrame([(c,) for c in crowded], "cell int"))
        dense = [c for c, r in figures.items() if (r.weight or 0) >= min_pts]
        loose = dealt.join(wanted, "cell").filter(~(F.col("inside") & F.col("cell").isin(dense)))
        more = _sample(loose, min(MOST_PIVOTS - len(pivots), max(LEAST_PIVOTS, 4 * now // CROWD)), now, seed)
        if not len(more):
            return pivots, dealt, figures
        pivots = np.concatenate([pivots, more])


def _layout(pivots: np.ndarray, figures: dict, eps: float, min_pts: int, size: int) -> _Layout:
    many = len(pivots)
    dense, ball, inner, outer = np.zeros(many, bool), np.full(many, -1), np.zeros(many), np.full(many, -1.0)
    rows = np.zeros((2, many), np.int64)
    for c, r in figures.items():
        dense[c] = (r.weight or 0) >= min_pts
        if dense[c]:
            ball[c], inner[c], rows[1, c], rows[0, c] = r.ball, r.inner, r.n_in, r.n_out
            outer[c] = -1.0 if r.outer is None else r.outer
        else:
            outer[c], rows[0, c] = r.far, r.n_in + r.n_out
    # Balls whose pivots are within eps are one cluster: pivots are points of their balls.
    group = np.arange(many)
    balls = np.flatnonzero(dense)
    for i in balls:
        linked = np.unique(group[balls[_near(pivots[i:i + 1], pivots[balls], eps)[0]]])
        if len(linked) > 1:
            group[np.isin(group, linked)] = linked[0]
    # Cells next to one another share blocks; what is larger than a block gets several.
    top = _away(pivots, pivots[:16])
    order = np.lexsort((top.min(1), top.argmin(1)))
    first, number, at, filled, edge = np.zeros((2, many), np.int64), np.ones((2, many), np.int64), 0, 0, [0, 0, 0]
    for kind in (0, 1):
        for c in order:
            n = rows[kind, c]
            if filled and filled + n > size:
                at, filled = at + 1, 0
            first[kind, c], number[kind, c] = at, max(1, -(-n // size))
            at, filled = at + number[kind, c] - 1, filled + n
            if number[kind, c] > 1:
                at, filled = at + 1, 0
        # Balls and other points have blocks of their own.
        at, filled = at + (filled > 0), 0
        edge[kind + 1] = at
    return _Layout(pivots, eps, dense, ball, inner, outer, group, first, number, order, int(edge[2]), int(edge[1]))


_PLANNED = ("id bigint, w bigint, vec array<double>, cell int, far double, ball boolean, block int, comp bigint, "
            "touched array<bigint>, blocks array<int>")


def _lists(which: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """For each row of ``which``, the values it marks."""
    ends = np.concatenate([[0], np.cumsum(which.sum(1))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[which], kind))


def _plan(layout: _Layout) -> Callable:
    """Whether a point is in a ball, its block and first piece, balls that it surely touches, one of each cluster, and
    blocks to compare it with, from its own onwards.

    Points of a ball only tell whether their ball touches one of another cluster.
    """
    runs = []
    for kind in (0, 1):
        firsts = layout.first[kind, layout.order]
        start = np.flatnonzero(np.diff(firsts, prepend=-1))
        runs.append((start, np.maximum.reduceat(layout.many[kind, layout.order], start)))
    cells, rows = np.arange(len(layout.pivots)), max(1, AWAY // (len(layout.pivots) + layout.blocks))

    def part(code: np.ndarray, home: np.ndarray, far: np.ndarray, ball: np.ndarray, own: np.ndarray) -> tuple[pa.Array, pa.Array]:
        away = _away(code, layout.pivots)
        known = ball[:, None] & (layout.group[home][:, None] == layout.group[None])
        sure = layout.sure(away)
        wanted = (layout.open(away, far, cells, False) & ~ball[:, None], layout.open(away, far, cells, True) & ~sure & ~known)
        # Cells that follow one another in one block, then the blocks of those that have several.
        wanted = np.concatenate([np.repeat(np.logical_or.reduceat(w[:, layout.order], start, axis=1), many, axis=1)[:, :n]
                                 for w, (start, many), n in zip(wanted, runs, (layout.balls, layout.blocks - layout.balls), strict=True)], axis=1)
        turned = (own[:, None] + np.arange(layout.blocks)) % layout.blocks
        i, c = np.nonzero(sure & ~known)
        _, one = np.unique(np.stack([i, layout.group[c]]), axis=1, return_index=True)
        touched = np.zeros(away.shape, bool)
        touched[i[one], layout.group[c[one]]] = True
        return (_lists(touched, np.broadcast_to(layout.ball, away.shape), pa.int64()),
                _lists(np.take_along_axis(wanted, turned, 1), turned, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), rows):
                batch = whole.slice(at, rows)
                home = batch.column("cell").to_numpy().astype(np.int64)
                ball = batch.column("inside").to_numpy(zero_copy_only=False).astype(bool) & layout.dense[home]
                own = layout.first[ball.astype(int), home] + batch.column("hash").to_numpy() % layout.many[ball.astype(int), home]
                lists = part(_matrix(batch.column("vec")), home, batch.column("far").to_numpy(), ball, own)
                comp = pc.if_else(pa.array(ball), pa.array(layout.ball[layout.group[home]], pa.int64()), batch.column("id"))
                names = ["id", "w", "vec", "cell", "far"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), pa.array(ball), pa.array(own, pa.int32()), comp, *lists],
                    [*names, "ball", "block", "comp", "touched", "blocks"])

    return run


def _tiles(layout: _Layout, left: pa.Table, right: pa.Table, alive: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows that ask and rows of a block that may be neighbours, in bounded parts; who is not ``alive`` by then is passed over."""
    asking, far, cell = _matrix(right.column("vec")), right.column("far").to_numpy(), left.column("cell").to_numpy()
    balls = left.column("block")[0].as_py() >= layout.balls
    high = max(1, math.isqrt(MATRIX) // 2)
    wide, asks = max(1, MATRIX // high), np.argsort(right.column("cell").to_numpy(), kind="stable")
    order = np.argsort(cell, kind="stable")
    for at in range(0, len(order), wide):
        mine = order[at:at + wide]
        cells = np.unique(cell[mine])
        step = max(high, AWAY // len(cells) // high * high)
        todo = asks[alive[asks]]
        for start in range(0, len(todo), step):
            who = todo[start:start + step]
            who = who[layout.open(_away(asking[who], layout.pivots[cells]), far[who], cells, balls).any(1)]
            for s in range(0, len(who), high):
                yield who[s:s + high], mine


def _count(layout: _Layout, min_pts: int) -> Callable:
    """What the neighbours in a block weigh, until it is enough with what was found before."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        total = np.zeros(len(right), np.int64)
        if len(left) and len(right):
            weight, before = left.column("w").to_numpy(), right.column("c").to_numpy()
            near, alive = _meeting(_matrix(right.column("vec")), _matrix(left.column("vec")), layout.eps), before < min_pts
            for who, mine in _tiles(layout, left, right, alive):
                asks, found = near(who, mine)
                if len(asks):
                    total[who] += np.bincount(asks, weight[mine][found], len(who)).astype(np.int64)
                    alive[who] = before[who] + total[who] < min_pts
        return pa.table({"id": right.column("id").cast(pa.int64()), "c": pa.array(total, pa.int64())})

    return run


def _merged(piece: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pieces, each named by its smallest member, once the pieces ``a`` and ``b`` of each pair are one."""
    while True:
        low, high = np.minimum(piece[a], piece[b]), np.maximum(piece[a], piece[b])
        if (low == high).all():
            return piece
        np.minimum.at(piece, high, low)
        while (piece != (up := piece[piece])).any():
            piece = up


def _link(layout: _Layout) -> Callable:
    """``src, dst``: a spanning forest of what the core points of a block and those that ask there join.

    Only what is not one piece yet is compared: who is outside of the piece that most of the points are in with all of
    them, who is inside with the others.
    """
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        src = dst = np.empty(0, np.int64)
        if len(left) and len(right):
            near, alive = _meeting(_matrix(right.column("vec")), _matrix(left.column("vec")), layout.eps), np.ones(len(right), bool)
            names, at = np.unique(np.concatenate([left.column("comp").to_numpy(), right.column("comp").to_numpy()]), return_inverse=True)
            target, asking = at[:len(left)], at[len(left):]
            piece = np.arange(len(names))
            for who, mine in _tiles(layout, left, right, alive):
                here, there = piece[asking[who]], piece[target[mine]]
                values, times = np.unique(there, return_counts=True)
                most, moved = values[times.argmax()], False
                for some, others in ((who[here != most], mine), (who[here == most], mine[there != most])):
                    if len(some) and len(others):
                        i, j = near(some, others)
                        a, b = asking[some[i]], target[others[j]]
                        if (piece[a] != piece[b]).any():
                            piece, moved = _merged(piece, piece[a], piece[b]), True
                if moved:
                    whole = piece[target]
                    if (whole == whole[0]).all():
                        alive &= piece[asking] != whole[0]
            apart = np.flatnonzero(piece != np.arange(len(piece)))
            src, dst = names[apart], names[piece[apart]]
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

    return run


def _border(layout: _Layout) -> Callable:
    """The smallest cluster among the core points next to a point."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        none = np.iinfo(np.int64).max
        best = np.full(len(right), none)
        if len(left) and len(right):
            cluster = left.column("cluster").to_numpy()
            near, alive = _meeting(_matrix(right.column("vec")), _matrix(left.column("vec")), layout.eps), np.ones(len(right), bool)
            for who, mine in _tiles(layout, left, right, alive):
                asks, found = near(who, mine)
                np.minimum.at(best, who[asks], cluster[mine[found]])
        some = pa.array(best < none)
        return pa.table({"id": right.column("id").cast(pa.int64()), "cluster": pa.array(best, pa.int64())}).filter(some)

    return run


def _by(values: list, at: Column) -> Column:
    """The value at each place, counted from 0."""
    return F.element_at(F.lit(values), at + 1)


def _blocks(layout: _Layout, targets: DataFrame, asks: DataFrame, run: Callable, schema: str, size: int) -> DataFrame:
    """Apply ``run`` to each block with those that ask there (their ``blocks``), at most about ``size`` rows of either."""
    tally = {r.block: r["count"] for r in asks.select(F.explode("blocks").alias("block")).groupBy("block").count().collect()}
    if not tally:
        return targets.sparkSession.createDataFrame([], schema)
    # Blocks that many ask in are dealt out again; there are as many counts as blocks.
    turns = [-(-tally.get(b, 0) // size) for b in range(layout.blocks)]
    groups = sum(turns)
    parts = min(4 * groups, groups + SPARE)
    left = targets.withColumn("turns", _by(turns, F.col("block"))).filter("turns > 0")
    left = left.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("turns").cast("bigint") - 1))).drop("turns")
    right = asks.withColumn("block", F.explode("blocks")).drop("blocks")
    # Columns of the same table on both sides would be taken for one another.
    right = right.select(*(F.col(c).alias(c) for c in right.columns), F.pmod(F.xxhash64("id"), _by(turns, F.col("block")).cast("bigint")).alias("turn"))
    key = ("block", "turn")
    return (left.repartition(parts, *key).groupBy(*key).cogroup(right.repartition(parts, *key).groupBy(*key)).applyInArrow(run, schema))


def _rounds(layout: _Layout, size: int, full: int) -> Iterator[tuple[int, int]]:
    """Places in the list of blocks that points visit together: those of a full block at first, then about twice as many."""
    low, high = 0, max(1, full // size)
    while low < layout.blocks:
        # The caller may send the number of points that still ask: few of them visit all blocks at once.
        few = yield low, high
        low, high = high, layout.blocks if few else 2 * high + 1


def _core(layout: _Layout, placed: DataFrame, min_pts: int, total: int, size: int, full: int) -> DataFrame:
    """``placed`` with ``core`` and ``c``, what a point weighs with its neighbours; exact where it is not core."""
    enough = (F.size("touched") > 0) | (F.col("w") >= min_pts)
    plain = placed.filter("NOT ball AND id IS NOT NULL")
    counts = plain.select("id", F.when(enough, F.lit(min_pts)).otherwise(0).cast("bigint").alias("c"))
    asks = plain.filter(~enough).withColumn("c", F.lit(0).cast("bigint"))
    targets = placed.select("id", "w", "vec", "cell", "block")
    rounds = _rounds(layout, size, full)
    low, high = next(rounds)
    while True:
        wanted = asks.select("id", "vec", "cell", "far", "c", F.slice("blocks", low + 1, high - low).alias("blocks"))
        hits = _blocks(layout, targets, wanted, _count(layout, min_pts), "id bigint, c bigint", size)
        counts = checkpoint(counts.unionByName(hits).groupBy("id").agg(F.sum("c").alias("c")))
        if high >= layout.blocks:
            break
        left = counts.filter(F.col("c") < min_pts)
        many = left.count()
        if not many:
            break
        low, high = rounds.send(many * layout.blocks <= total)
        asks = plain.join(broadcast_if_small(left), "id")
    core = F.col("ball") | F.coalesce(F.col("c") >= min_pts, F.lit(False))
    return checkpoint(placed.join(counts, "id", "left").withColumn("core", core))


def _pieces(layout: _Layout, marked: DataFrame, total: int, size: int, full: int, connect: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Core points with ``comp``, the number of their piece."""
    groups = layout.ball[layout.group]
    core = marked.filter("core").select("id", "vec", "cell", "far", "block", "comp", "touched", "blocks")
    links = core.select(F.col("comp").alias("src"), F.explode("touched").alias("dst")) if layout.dense.any() else None
    spark, largest = marked.sparkSession, None
    rounds = _rounds(layout, size, full)
    low, high = next(rounds)
    while True:
        # A block need not be visited from the piece that all its points are in, and only balls must be from the largest.
        skip = [largest] * layout.balls + [None] * (layout.blocks - layout.balls)
        for b in range(layout.balls, layout.blocks):
            inside = layout.dense & (layout.first[1] <= b) & (b < layout.first[1] + layout.many[1])
            pieces = np.unique(groups[inside])
            skip[b] = pieces[0].item() if len(pieces) == 1 else None
        blocks = F.slice("blocks", low + 1, high - low)
        if any(x is not None for x in skip):
            known, piece = [x is not None for x in skip], [0 if x is None else x for x in skip]
            blocks = F.filter(blocks, lambda b: ~_by(known, b) | (_by(piece, b).cast("bigint") != F.col("comp")))  # noqa: B023
        asks = core.select("id", "vec", "cell", "far", "comp", blocks.alias("blocks"))
        asks = asks.filter(F.size("blocks") > 0)
        found = _blocks(layout, core.select("id", "vec", "cell", "block", "comp"), asks, _link(layout), "src bigint, dst bigint", size)
        links = checkpoint((found if links is None else found.unionByName(links)).distinct())
        moved = connect(links)
        core = checkpoint(core.join(broadcast_if_small(moved.select(F.col("node").alias("comp"), "component")), "comp", "left")
                          .withColumn("comp", F.coalesce("component", "comp")).drop("component"))
        if high >= layout.blocks:
            return core
        wanted = [(int(x),) for x in {*groups[layout.dense], *([] if largest is None else [largest])}]
        if wanted:
            now = dict(spark.createDataFrame(wanted, "node bigint").join(moved, "node").collect())
            groups = np.array([now.get(x, x) for x in groups.tolist()], np.int64)
            largest = now.get(largest, largest)
        if largest is None:
            top = core.groupBy("comp").count().orderBy(F.desc("count"), "comp").first()
            if top is None:
                return core
            largest = top.comp
        links, many = None, core.filter(F.col("comp") != largest).count()
        if not many:
            return core
        low, high = rounds.send(many * layout.blocks <= total)


def clusters(points: DataFrame, eps: float, min_pts: int, connect: Callable[[DataFrame], DataFrame],
             number: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``id, cluster, kind`` of ``id, vec`` (doubles, all finite and of one length).

    ``connect`` turns edges ``src, dst`` into ``node, component``; ``number`` adds ``cluster`` to ``component, first_core``.
    """
    eps = float(eps)
    distinct = checkpoint(points.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("w")).select("id", "w", "vec"))
    total, width = distinct.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(1))).first()
    if not total:
        return points.sparkSession.createDataFrame([], "id bigint, cluster bigint, kind int")
    full = max(64, BLOCK_VALUES // max(1, width))
    # A small table is cut finer, so that there are more blocks than cores.
    size = min(full, max(LEAST_BLOCK, total // 16))
    pivots, dealt, figures = _divided(distinct, total, eps, min_pts)
    layout = _layout(pivots, figures, eps, min_pts, size)
    placed = checkpoint(dealt.withColumn("hash", F.xxhash64("id")).mapInArrow(_plan(layout), _PLANNED))

    marked = _core(layout, placed, min_pts, total, size, full)
    core = _pieces(layout, marked, total, size, full, connect)
    first = core.groupBy("comp").agg(F.min("id").alias("first_core")).withColumnRenamed("comp", "component")
    named = checkpoint(core.withColumnRenamed("comp", "component").join(number(first).select("component", "cluster"), "component")
                       .select("id", "vec", "cell", "block", "cluster"))
    # Points that are not core, but not alone: the core points next to them.
    loose = marked.filter("NOT core AND id IS NOT NULL AND c > w").select("id", "vec", "cell", "far", "blocks")
    touched = (_blocks(layout, named, loose, _border(layout), "id bigint, cluster bigint", size)
               .groupBy("id").agg(F.min("cluster").alias("cluster")))
    kinds = named.select("id", "cluster", F.lit(1).alias("kind")).unionByName(touched.select("id", "cluster", F.lit(0).alias("kind")))
    each = distinct.join(kinds, "id", "left").select("id", "w", "vec", F.coalesce("cluster", F.lit(0)).cast("bigint").alias("cluster"),
                                                     F.coalesce("kind", F.lit(-1)).alias("kind"))
    copies = broadcast_if_small(each.filter("w > 1").select("vec", F.col("id").alias("first"), "cluster", "kind"))
    rest = points.join(copies, "vec").filter("id <> first").select("id", "cluster", "kind")
    return each.select("id", "cluster", "kind").unionByName(rest)
