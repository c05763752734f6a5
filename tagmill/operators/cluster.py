"""Density-based clustering (DBSCAN) without comparing all pairs of points.

Points of up to three dimensions are put in a grid whose cells have diagonal ``eps``, so points of one
cell are always neighbours. A cell with at least ``min_pts`` points is *dense*:
all its points are core points of one cluster, whatever their number, and no
pair inside it is ever formed. Only points of sparse cells (fewer than
``min_pts`` each) look into adjacent cells, so the number of distance tests
grows linearly with the number of points. Clusters are connected components of
a graph between cells, not between points. Longer vectors go through the metric
partition of ``metric_cluster``.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.functions.constants import CLUSTER_MIN_POINTS, CLUSTER_RADIUS
from tagmill.functions.geometry import distance
from tagmill.operators import metric_cluster, ranking
from tagmill.session import broadcast_if_small, checkpoint

__all__ = ["dbscan", "connected_components", "distance"]

# Points of one cell are spread over join keys holding about this many each.
CHUNK = 50_000
# Two groups of points are compared directly when one of them has at most this
# many points; otherwise both are split into finer boxes first.
DIRECT = 8
# Vectors of at most this many dimensions are clustered by a grid.
GRID_DIMENSIONS = 3


def _is_star_forest(edges: DataFrame) -> bool:
    several = edges.groupBy("large").agg(F.count("*").alias("n")).filter("n > 1").select("large")
    chained = edges.join(edges.select(F.col("large").alias("small")), "small", "left_semi").select("large")
    return several.unionByName(chained).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node) of an undirected graph given as ``src, dst``.

    Alternates two star operations (Kiveris et al., "Connected Components in
    MapReduce and Beyond", 2014) until every node hangs on one centre that
    hangs on nothing.
    """
    both = F.least("src", "dst").alias("small"), F.greatest("src", "dst").alias("large")
    current = checkpoint(edges.filter("src <> dst").select(*both).distinct())
    while not _is_star_forest(current):
        # Large star: every node links its larger neighbours to its smallest one.
        two_way = current.select(F.col("large").alias("u"), F.col("small").alias("v")).unionByName(
            current.select(F.col("small").alias("u"), F.col("large").alias("v")))
        smallest = two_way.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        linked = (two_way.filter("v > u").join(smallest, "u")
                  .select(F.col("m").alias("small"), F.col("v").alias("large")))
        # Small star: every node links its smaller neighbours and itself to the smallest one.
        least = linked.groupBy("large").agg(F.min("small").alias("m"))
        pulled = linked.join(least, "large")
        current = checkpoint(
            pulled.filter("small <> m").select(F.col("m").alias("small"), F.col("small").alias("large"))
            .unionByName(least.select(F.col("m").alias("small"), "large")).distinct())
    return (current.select(F.col("large").alias("node"), F.col("small").alias("component"))
            .unionByName(current.select(F.col("small").alias("node"), F.col("small").alias("component")).distinct()))


def _box(vector: str, edge: float) -> Column:
    return F.transform(vector, lambda x: F.floor(x / F.lit(edge)))


def _gap(a: str, b: str) -> Column:
    """Squared smallest distance of two boxes, in box edges."""
    steps = F.zip_with(a, b, lambda x, y: F.greatest(F.abs(x - y) - 1, F.lit(0)))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda t, s: t + s * s)


def _reach(a: str, b: str) -> Column:
    """Squared largest distance of two boxes, in box edges."""
    steps = F.zip_with(a, b, lambda x, y: F.abs(x - y) + 1)
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda t, s: t + s * s)


class _Grid:
    """Points with their cells, and joins from cell rows to the points in them."""

    def __init__(self, points: DataFrame, eps: float, dims: int):
        self.eps, self.dims = eps, dims
        # Slightly smaller than eps / sqrt(dims), so rounding never makes a diagonal exceed eps.
        self.edge = eps / math.sqrt(dims) * (1 - 1e-9)
        self.points = points.withColumn("cell", _box("vec", self.edge))
        self.cells = checkpoint(self.points.groupBy("cell").agg(F.count("*").alias("n"), F.min("id").alias("cid")))
        self.spread_points = self.spread(self.points, self.cells)

    @staticmethod
    def spread(keyed: DataFrame, sizes: DataFrame) -> DataFrame:
        """Points keyed by ``cell``, those of large cells divided over several ``salt`` values.

        ``sizes`` holds ``cell, n``. Only cells above ``CHUNK`` need more than
        one salt; how many there are is counted before they are broadcast.
        """
        large = sizes.filter(F.col("n") > CHUNK).select("cell", F.ceil(F.col("n") / CHUNK).alias("__salts"))
        if not large.limit(1).count():
            return keyed.withColumn("salt", F.lit(0).cast("bigint"))
        large = broadcast_if_small(large)
        salts = F.coalesce("__salts", F.lit(1))
        return (keyed.join(large, "cell", "left")
                .withColumn("salt", F.pmod(F.xxhash64("id"), salts)).drop("__salts"))

    @staticmethod
    def reach_all(rows: DataFrame, size: str) -> DataFrame:
        """Copies of a cell row, one for each ``salt`` of its cell."""
        top = F.greatest(F.ceil(F.col(size) / CHUNK), F.lit(1)) - 1
        return rows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), top.cast("bigint"))))

    def inside(self, rows: DataFrame) -> DataFrame:
        """Points of the cells in ``rows(cell, n, ...)``: ``id, vec`` plus the columns of ``rows``."""
        return self.spread_points.join(self.reach_all(rows, "n"), ["cell", "salt"]).drop("salt")

    def adjacent(self) -> DataFrame:
        """Ordered pairs of different cells that may hold points within eps of each other."""
        span = math.ceil(math.sqrt(self.dims) * (1 + 1e-6))
        key = F.transform("cell", lambda c: F.floor(c / F.lit(span)))
        offsets = F.array(*[F.array(*[F.lit(o).cast("bigint") for o in offset])
                            for offset in itertools.product((-1, 0, 1), repeat=self.dims)])
        left = self.cells.select(F.col("cell").alias("cell_a"), F.col("n").alias("n_a"), F.col("cid").alias("a"),
                                 key.alias("key"))
        left = left.withColumn("offset", F.explode(offsets)).select(
            "cell_a", "n_a", "a", F.zip_with("key", "offset", lambda k, o: k + o).alias("key"))
        right = self.cells.select(F.col("cell").alias("cell_b"), F.col("n").alias("n_b"), F.col("cid").alias("b"),
                                  key.alias("key"))
        limit = F.lit((self.eps / self.edge) ** 2 * (1 + 1e-6))
        return (left.join(right, "key").filter(F.col("a") != F.col("b"))
                .filter(_gap("cell_a", "cell_b") <= limit).drop("key"))


def dbscan(df: DataFrame, eps: float = CLUSTER_RADIUS, min_pts: int = CLUSTER_MIN_POINTS,
           dims: int | None = None) -> DataFrame:
    """Cluster ``id, vec array<double>``: ``id, cluster, kind``.

    ``kind`` is 1 for core, 0 for border and -1 for noise; the neighbourhood of
    a point includes the point. ``cluster`` numbers clusters from 1 by their
    smallest core id; noise has 0. A border point between clusters takes the
    smallest number. Rows without a vector, or with a component that is null or
    not finite, are noise. Up to three dimensions go through a grid, more through
    a metric partition over the whole vectors.
    """
    rows = df.select("id", F.col("vec").cast("array<double>").alias("vec"))
    odd = F.col("vec").isNull() | F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    noise = rows.filter(odd).select("id", F.lit(0).cast("bigint").alias("cluster"), F.lit(-1).alias("kind"))
    rows = rows.filter(~odd)
    if dims is None:
        head = rows.select(F.size("vec").alias("d")).head(1)
        dims = head[0].d if head else 1
    if dims > GRID_DIMENSIONS:
        found = metric_cluster.clusters(rows, eps, min_pts, connected_components, _numbered)
    else:
        found = _by_grid(rows, eps, min_pts, dims)
    return found.unionByName(noise)


def _numbered(components: DataFrame) -> DataFrame:
    """Clusters from 1 by their smallest core id."""
    return ranking.global_index(components, ["first_core"], 1, "cluster")


def _by_grid(rows: DataFrame, eps: float, min_pts: int, dims: int) -> DataFrame:
    grid = _Grid(rows, eps, dims)
    pairs = checkpoint(grid.adjacent())
    near = F.lit(eps)

    # Sparse cells: count neighbours of each of their points.
    sparse_cells = grid.cells.filter(F.col("n") < min_pts)
    sparse = grid.inside(sparse_cells)
    probes = sparse.join(pairs.select(F.col("a").alias("cid"), "cell_b", "n_b"), "cid")
    targets = grid.spread_points.select(
        F.col("cell").alias("cell_b"), "salt", F.col("vec").alias("vec_b"))
    met = (grid.reach_all(probes, "n_b").join(targets, ["cell_b", "salt"])
           .filter(distance("vec", "vec_b") <= near)
           .select("id", "vec", "cell", "n", "cid", F.lit(1).cast("bigint").alias("c")))
    counted = (sparse.select("id", "vec", "cell", "n", "cid", F.col("n").alias("c")).unionByName(met)
               .groupBy("id", "vec", "cell", "n", "cid").agg(F.sum("c").alias("c")))
    sparse = checkpoint(counted.select("id", "vec", "cell", "n", "cid", (F.col("c") >= min_pts).alias("core")))
    sparse_core = sparse.filter("core")

    # Cells that hold core points, with the smallest core id in each.
    dense_cells = grid.cells.filter(F.col("n") >= min_pts)
    core_cells = (dense_cells.select("cid", F.col("cid").alias("first_core"))
                  .unionByName(sparse_core.groupBy("cid").agg(F.min("id").alias("first_core"))))

    # Edges with a sparse end: its few core points against the core points of the other cell.
    to_dense = (grid.reach_all(sparse_core.join(pairs.filter(F.col("n_b") >= min_pts)
                                                .withColumnRenamed("a", "cid"), "cid"), "n_b")
                .join(targets, ["cell_b", "salt"]).filter(distance("vec", "vec_b") <= near).select("cid", "b"))
    others = sparse_core.select(F.col("cid").alias("b"), F.col("vec").alias("vec_b"))
    to_sparse = (sparse_core.join(pairs.select(F.col("a").alias("cid"), "b"), "cid").filter("cid < b")
                 .join(others, "b").filter(distance("vec", "vec_b") <= near).select("cid", "b"))
    sparse_edges = to_dense.unionByName(to_sparse).toDF("src", "dst")

    # Edges between dense cells: extreme points settle most of them.
    dense_pairs = pairs.filter((F.col("n_a") >= min_pts) & (F.col("n_b") >= min_pts) & (F.col("a") < F.col("b")))
    edges = sparse_edges
    open_pairs = None
    if dense_pairs.limit(1).count():
        scouts = [f(F.col("vec"), F.get("vec", F.lit(i))) for i in range(dims) for f in (F.min_by, F.max_by)]
        scouts = grid.points.groupBy("cell").agg(F.array_distinct(F.array(*scouts)).alias("scouts"))
        settled = (dense_pairs.join(scouts.toDF("cell_a", "scouts_a"), "cell_a")
                   .join(scouts.toDF("cell_b", "scouts_b"), "cell_b"))
        hit = F.exists("scouts_a", lambda p: F.exists("scouts_b", lambda q: distance(p, q) <= near))
        settled = checkpoint(settled.select("cell_a", "n_a", "a", "cell_b", "n_b", "b", hit.alias("hit")))
        edges = edges.unionByName(settled.filter("hit").select(F.col("a").alias("src"), F.col("b").alias("dst")))
        open_pairs = settled.filter("not hit").drop("hit")
    components = _components_of(core_cells, edges)

    if open_pairs is not None:
        # Pairs already in one cluster need no answer.
        left = components.select(F.col("cid").alias("a"), F.col("component").alias("comp_a"))
        right = components.select(F.col("cid").alias("b"), F.col("component").alias("comp_b"))
        open_pairs = checkpoint(open_pairs.join(left, "a").join(right, "b").filter("comp_a <> comp_b"))
        if open_pairs.limit(1).count():
            late = _closest_within(grid, open_pairs)
            components = _components_of(core_cells, checkpoint(edges.unionByName(late)))

    first = components.groupBy("component").agg(F.min("first_core").alias("first_core"))
    numbered = _numbered(first).select("component", "cluster")
    clusters = checkpoint(components.join(numbered, "component").select("cid", "cluster"))

    # Border points: nearest core cells decide, including their own cell.
    loose = sparse.filter(~F.col("core"))
    own = loose.join(clusters, "cid").select("id", "cluster")
    around = loose.join(pairs.withColumnRenamed("a", "cid"), "cid").join(clusters.toDF("b", "cluster"), "b")
    by_dense = (grid.reach_all(around.filter(F.col("n_b") >= min_pts), "n_b").join(targets, ["cell_b", "salt"])
                .filter(distance("vec", "vec_b") <= near).select("id", "cluster"))
    by_sparse = (around.filter(F.col("n_b") < min_pts).join(others, "b")
                 .filter(distance("vec", "vec_b") <= near).select("id", "cluster"))
    nothing = loose.select("id", F.lit(None).cast("bigint").alias("cluster"))
    border = (own.unionByName(by_dense).unionByName(by_sparse).unionByName(nothing)
              .groupBy("id").agg(F.min("cluster").alias("cluster")))

    dense_rows = grid.inside(dense_cells.join(clusters, "cid")).select("id", "cluster", F.lit(1).alias("kind"))
    core_rows = sparse_core.join(clusters, "cid").select("id", "cluster", F.lit(1).alias("kind"))
    border_rows = border.select("id", F.coalesce("cluster", F.lit(0)).alias("cluster"),
                                F.when(F.col("cluster").isNull(), -1).otherwise(0).alias("kind"))
    return dense_rows.unionByName(core_rows).unionByName(border_rows)


def _components_of(core_cells: DataFrame, edges: DataFrame) -> DataFrame:
    """``cid, first_core, component``; a cell without edges is its own component."""
    linked = connected_components(edges)
    joined = core_cells.join(linked, core_cells["cid"] == linked["node"], "left")
    return checkpoint(joined.select("cid", "first_core", F.coalesce("component", "cid").alias("component")))


def _closest_within(grid: _Grid, open_pairs: DataFrame) -> DataFrame:
    """``src, dst`` of those dense cell pairs that hold two points within eps.

    Boxes are halved level by level. A pair of boxes that certainly reaches
    settles its cells, one that certainly does not is dropped, and one with few
    points on a side is decided by its points. Equal points count once, so boxes
    empty until few are left.
    """
    found = None
    points = checkpoint(grid.points.join(
        open_pairs.select(F.col("cell_a").alias("cell")).unionByName(open_pairs.select(F.col("cell_b").alias("cell"))).distinct(),
        "cell", "left_semi").groupBy("vec").agg(F.min("id").alias("id")))
    todo = open_pairs.select("a", "b", F.col("cell_a").alias("box_a"), "n_a", F.col("cell_b").alias("box_b"), "n_b")
    for level in itertools.count():
        edge = grid.edge / 2 ** level
        boxed = points.select("id", "vec", _box("vec", edge).alias("cell"))
        few = F.least("n_a", "n_b") <= DIRECT
        direct = todo.filter(few)
        small_first = F.col("n_a") <= F.col("n_b")
        sides = direct.select(
            "a", "b",
            F.when(small_first, F.col("box_a")).otherwise(F.col("box_b")).alias("cell"), F.least("n_a", "n_b").alias("n"),
            F.when(small_first, F.col("box_b")).otherwise(F.col("box_a")).alias("other"),
            F.greatest("n_a", "n_b").alias("n_other"))
        # Counts of the boxes in play; the salt of a point depends on its own box only.
        in_play = (todo.select(F.col("box_a").alias("cell"), F.col("n_a").alias("n"))
                   .unionByName(todo.select(F.col("box_b").alias("cell"), F.col("n_b").alias("n"))).distinct())
        boxed = boxed.join(in_play.select("cell"), "cell", "left_semi")
        spread = grid.spread(boxed, in_play)
        near_points = grid.reach_all(sides, "n").join(spread, ["cell", "salt"]).select(
            "a", "b", "vec", F.col("other").alias("cell"), "n_other")
        far_points = spread.select("cell", "salt", F.col("vec").alias("vec_b"))
        hits = (grid.reach_all(near_points, "n_other").join(far_points, ["cell", "salt"])
                .filter(distance("vec", "vec_b") <= F.lit(grid.eps)).select("a", "b").distinct())
        found = hits if found is None else found.unionByName(hits)
        # Children of the boxes that are still too full.
        full = todo.filter(~few)
        parents = (full.select(F.col("box_a").alias("parent"))
                   .unionByName(full.select(F.col("box_b").alias("parent"))).distinct())
        child = points.select(_box("vec", edge / 2).alias("box"))
        child = (child.withColumn("parent", F.transform("box", lambda c: F.floor(c / F.lit(2))))
                 .groupBy("parent", "box").agg(F.count("*").alias("n")).join(parents, "parent", "left_semi"))
        split = (full.select("a", "b", "box_a", "box_b")
                 .join(child.toDF("box_a", "child_a", "n_a"), "box_a")
                 .join(child.toDF("box_b", "child_b", "n_b"), "box_b"))
        radius = (grid.eps / (edge / 2)) ** 2
        split = split.filter(_gap("child_a", "child_b") <= F.lit(radius * (1 + 1e-9)))
        split = checkpoint(split.withColumn("sure", _reach("child_a", "child_b") <= F.lit(radius * (1 - 1e-9))))
        found = checkpoint(found.unionByName(split.filter("sure").select("a", "b")).distinct())
        todo = checkpoint(split.filter("not sure").join(found, ["a", "b"], "left_anti")
                          .select("a", "b", F.col("child_a").alias("box_a"), "n_a",
                                  F.col("child_b").alias("box_b"), "n_b"))
        if not todo.limit(1).count():
            break
    return found.toDF("src", "dst")
