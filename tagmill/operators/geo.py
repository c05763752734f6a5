"""Point-in-area lookup as an equi-join on the cells of a quadtree."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.functions.constants import NOT_FOUND
from tagmill.functions.geometry import in_box, in_cell
from tagmill.functions.normalize import part
from tagmill.session import checkpoint

# Cell edges are powers of two degrees between these exponents; cells of a divided area may be finer.
FINEST_LEVEL, COARSEST_LEVEL = -12, 9
# A cell with more edges than this is divided, each side by 2 ** STEP.
CELL_EDGES, STEP = 64, 2
# Dividing ends where the cells of an area hold this many times its edges: each edge lies in few cells.
GROWTH = 4
# The covers of all levels together are broadcast up to this many bytes.
BROADCAST_BYTES = 64 << 20
# Areas of one cell travel as one array up to this many bytes.
CELL_BYTES = 16 << 20


def load_areas(lines: DataFrame, column: str = "value") -> DataFrame:
    """``code, name, ring`` and bounding box from ``code<TAB>name<TAB>lat,lng;lat,lng;...`` lines.

    Lines with an unreadable vertex are dropped.
    """
    vertices = F.split(part(column, 2), ";")
    ring = F.transform(vertices, lambda v: F.struct(
        F.get(F.split(v, ","), F.lit(0)).try_cast("double").alias("lat"),
        F.get(F.split(v, ","), F.lit(1)).try_cast("double").alias("lng")))
    parsed = lines.select(part(column, 0).alias("code"), part(column, 1).alias("name"), ring.alias("ring"))
    complete = F.forall("ring", lambda p: p["lat"].isNotNull() & p["lng"].isNotNull())
    return with_box(parsed.filter(F.col("ring").isNotNull() & complete))


def with_box(areas: DataFrame) -> DataFrame:
    """Add the bounding box of each ring."""
    return areas.withColumns({
        "min_lat": F.array_min("ring.lat"), "max_lat": F.array_max("ring.lat"),
        "min_lng": F.array_min("ring.lng"), "max_lng": F.array_max("ring.lng"),
    })


def _level() -> Column:
    extent = F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_lng") - F.col("min_lng"),
                        F.lit(2.0 ** FINEST_LEVEL))
    return F.least(F.ceil(F.log2(extent)), F.lit(COARSEST_LEVEL)).cast("int")


def cover_cells(areas: DataFrame) -> DataFrame:
    """Grid cells of each area's box, on a grid whose cells are no smaller than the box.

    Every area gets its own grid level, so it falls in at most four cells
    however large it is.
    """
    leveled = areas.withColumn("level", _level()).withColumn("edge", F.pow(F.lit(2.0), F.col("level")))

    def span(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) / F.col("edge")), F.floor(F.col(high) / F.col("edge")))

    return (leveled.withColumn("cell_lat", F.explode(span("min_lat", "max_lat")))
            .withColumn("cell_lng", F.explode(span("min_lng", "max_lng"))).drop("edge"))


def _divide(edges: int, step: int, growth: int, finest: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function from areas (``lats, lngs`` and the first cell's place) to the cells of their quadtrees."""

    def clip(sides, base, turns, south, north, west, east, slack):
        """What a cell has to know of its parent's edges, to answer for its own points as the whole ring would."""
        lat1, lng1, lat2, lng2 = sides
        near = (np.maximum(lat1, lat2) >= south) & (np.minimum(lat1, lat2) < north)
        right = np.minimum(lng1, lng2) > east + slack
        local = near & ~right & (np.maximum(lng1, lng2) >= west - slack)
        # Rays towards the east cross every edge there, so only the latitudes at which a chain of such edges ends count.
        passed = near & right
        turns = np.concatenate([turns, lat1[passed], lat2[passed]])
        base = bool(base) ^ bool(np.count_nonzero(turns < south) % 2)
        values, times = np.unique(turns[(turns >= south) & (turns < north)], return_counts=True)
        return sides[:, local], base, values[times % 2 == 1]

    def cells(lats, lngs, level, cell_lat, cell_lng):
        sides = np.stack([lats, lngs, np.roll(lats, -1), np.roll(lngs, -1)])
        sides = sides[:, sides[0] != sides[2]]
        # Rounding of a crossing's longitude stays far below this; edges that close to a border are kept.
        slack = float(np.abs(lngs).max()) * 2.0 ** -40
        room = growth * sides.shape[1]

        def cell(parent, level, i, j):
            size = 2.0 ** level
            held = clip(*parent, i * size, (i + 1) * size, j * size, (j + 1) * size, slack)
            return -held[0].shape[1], (level, i, j), held

        root = (sides, False, np.zeros(0))
        heap = [cell(root, level, i, j) for i in range(*cell_lat) for j in range(*cell_lng)]
        heapq.heapify(heap)
        held = -sum(x[0] for x in heap)
        while heap and -heap[0][0] > edges and heap[0][1][0] - step >= finest and held <= room:
            count, (at, i, j), parent = heapq.heappop(heap)
            width = 2 ** step
            held += count
            for x in range(width * i, width * (i + 1)):
                for y in range(width * j, width * (j + 1)):
                    child = cell(parent, at - step, x, y)
                    held -= child[0]
                    heapq.heappush(heap, child)
        for _, place, parent in heap:
            yield *place, *parent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                lats, lngs = np.asarray(row.lats, float), np.asarray(row.lngs, float)
                rows = []
                for level, i, j, sides, base, turns in cells(lats, lngs, row.level, (row.lat_from, row.lat_to), (row.lng_from, row.lng_to)):
                    low, high = max(i * 2.0 ** level, row.min_lat), min((i + 1) * 2.0 ** level, row.max_lat)
                    left, right = max(j * 2.0 ** level, row.min_lng), min((j + 1) * 2.0 ** level, row.max_lng)
                    if low <= high and left <= right:
                        rows.append((row.code, row.min_lat, row.max_lat, row.min_lng, row.max_lng, level, i, j, base, turns, *sides))
                    if len(rows) == 1000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    names = ["code", "min_lat", "max_lat", "min_lng", "max_lng", "level", "cell_lat", "cell_lng",
             "base", "turns", "lat1", "lng1", "lat2", "lng2"]
    return run


def area_cover(areas: DataFrame) -> DataFrame:
    """The quadtree of each area: one row per undivided cell that meets its box.

    ``edges`` holds the edges near the cell, at most ``CELL_EDGES`` unless dividing
    further would repeat too many; ``base`` and ``turns`` stand for all other edges
    of the ring. A cell without edges lies wholly inside (``base``) or outside.
    ``code`` is the smallest code of ``copies`` areas that look the same in the cell.
    Areas without a finite box cover nothing. Rings never leave the task that
    reads them; only cells are exchanged.
    """
    finite = F.lit(True)
    for name in ("min_lat", "max_lat", "min_lng", "max_lng"):
        finite = finite & (F.abs(F.col(name)) < F.lit(float("inf")))
    edge = F.pow(F.lit(2.0), F.col("level"))
    placed = areas.filter(finite).withColumn("level", _level())
    first = {name: F.floor(F.col(side) / edge).cast("bigint") + last
             for name, side, last in (("lat_from", "min_lat", 0), ("lat_to", "max_lat", 1), ("lng_from", "min_lng", 0), ("lng_to", "max_lng", 1))}
    sent = placed.select("code", "min_lat", "max_lat", "min_lng", "max_lng", "level", *[v.alias(k) for k, v in first.items()],
                         F.col("ring.lat").alias("lats"), F.col("ring.lng").alias("lngs"))
    doubles = ", ".join(f"{n} array<double>" for n in ("turns", "lat1", "lng1", "lat2", "lng2"))
    kind = dict(areas.dtypes)["code"]
    cells = sent.mapInPandas(_divide(CELL_EDGES, STEP, GROWTH, 8 * FINEST_LEVEL),
                             f"code {kind}, min_lat double, max_lat double, min_lng double, max_lng double, level int, "
                             f"cell_lat bigint, cell_lng bigint, base boolean, {doubles}")
    cells = cells.withColumn("edges", F.arrays_zip("lat1", "lng1", "lat2", "lng2")).drop("lat1", "lng1", "lat2", "lng2")
    same = [c for c in cells.columns if c != "code"]
    return cells.groupBy(*same).agg(F.min("code").alias("code"), F.count("*").alias("copies"))


def _bytes() -> Column:
    return F.size("edges") * 48 + F.size("turns") * 8 + 96


def locate(points: DataFrame, areas: DataFrame, single_bbox_ok: bool = False) -> DataFrame:
    """Code of the area each point lies in: the input columns plus ``code``.

    ``points`` holds ``lat, lng`` and identifying columns. Points outside every
    area, and points without a finite place, get the text ``null``; of several
    areas the smallest code wins. With ``single_bbox_ok`` a point inside exactly
    one bounding box takes that area without the polygon test.

    A point meets the cells of ``area_cover`` it lies in, one per grid level, and
    tests only their edges. The areas of a cell travel as one array, so a point is
    one row throughout; while the covers fit one budget they are broadcast, the
    smallest levels first, and points are not exchanged, however many lie in a cell.
    """
    cover = area_cover(areas)
    if not single_bbox_ok:
        cover = cover.filter(F.col("base") | (F.size("edges") > 0) | (F.size("turns") > 0))
    cover = checkpoint(cover)
    per_cell = cover.groupBy("level", "cell_lat", "cell_lng").agg(F.sum(_bytes()).alias("bytes"))
    # One row per grid level in use; their number follows from the exponents of doubles, not from the data.
    sizes = per_cell.groupBy("level").agg(F.sum("bytes").alias("all"), F.max("bytes").alias("most")).collect()
    if not sizes:
        return points.withColumn("code", F.lit("null"))
    if max(row.most for row in sizes) > CELL_BYTES:
        return _locate_by_rows(points, cover, sorted(row.level for row in sizes), single_bbox_ok)
    grouped = cover.groupBy("level", "cell_lat", "cell_lng").agg(F.collect_list(F.struct(*_CELL)).alias("areas"))
    joined, found, room = points, [], BROADCAST_BYTES
    for row in sorted(sizes, key=lambda r: (r.all, r.level)):
        name, edge = f"__areas{len(found)}", F.lit(2.0 ** row.level)
        here = grouped.filter(F.col("level") == row.level).select("cell_lat", "cell_lng", F.col("areas").alias(name))
        room -= row.all
        here = F.broadcast(here) if room >= 0 else here
        keys = [F.floor(F.col("lat") / edge) == here["cell_lat"], F.floor(F.col("lng") / edge) == here["cell_lng"]]
        joined = joined.join(here, keys, "left").drop("cell_lat", "cell_lng")
        found.append(name)
    boxed = F.filter(F.flatten(F.array_compact(F.array(*found))), lambda a: in_box("lat", "lng", a))
    inside = F.filter(boxed, lambda a: in_cell("lat", "lng", a["base"], a["turns"], a["edges"]))
    code = F.array_min(F.transform(inside, lambda a: a["code"]))
    if single_bbox_ok:
        boxes = F.aggregate(boxed, F.lit(0).cast("bigint"), lambda n, a: n + a["copies"])
        code = F.when(boxes == 1, F.get(boxed, F.lit(0))["code"]).otherwise(code)
    return joined.select(*points.columns, F.coalesce(code, F.lit("null")).alias("code"))


_CELL = ("code", "copies", "min_lat", "max_lat", "min_lng", "max_lng", "base", "turns", "edges")


def _locate_by_rows(points: DataFrame, cells: DataFrame, levels: list[int], single_bbox_ok: bool) -> DataFrame:
    """``locate`` for covers with too many areas in one cell to travel as one array."""
    once = points.groupBy(*points.columns).agg(F.count("*").cast("int").alias("__times"))
    keyed = once.withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels])))
    edge = F.pow(F.lit(2.0), F.col("level"))
    keyed = keyed.withColumns({"cell_lat": F.floor(F.col("lat") / edge), "cell_lng": F.floor(F.col("lng") / edge)})
    same_cell = [keyed[c] == cells[c] for c in ("level", "cell_lat", "cell_lng")]
    joined = keyed.join(cells, [*same_cell, in_box(keyed["lat"], keyed["lng"])], "left")
    tested = joined.select(*[keyed[c] for c in once.columns], "code", "copies",
                           in_cell(keyed["lat"], keyed["lng"], "base", "turns", "edges").alias("inside"))
    code = F.min(F.when(F.col("inside"), F.col("code")))
    if single_bbox_ok:
        code = F.when(F.sum("copies") == 1, F.min("code")).otherwise(code)
    located = tested.groupBy(*once.columns).agg(F.coalesce(code, F.lit("null")).alias("code"))
    # Equal points were looked up once; give each its row back.
    repeated = located.withColumn("__times", F.explode(F.array_repeat(F.lit(0), F.col("__times"))))
    return repeated.drop("__times")


def rollup(df: DataFrame, names: DataFrame, code: str = "code", default: str | None = None) -> DataFrame:
    """Names of the district, city and province of a six-digit area code; ``null`` passes through."""
    slim = names.select(F.col("code").alias("__code"), F.col("name").alias("__name"))
    keys = {
        "district": F.col(code),
        "city": F.concat(F.substring(code, 1, 4), F.lit("00")),
        "province": F.concat(F.substring(code, 1, 2), F.lit("0000")),
    }
    out = df
    for level, key in keys.items():
        named = slim.withColumnRenamed("__name", level)
        kept = F.when(F.col(code) == "null", F.lit("null")).otherwise(F.coalesce(level, F.lit(default)))
        out = out.join(named, key == named["__code"], "left").drop("__code").withColumn(level, kept)
    return out


def areas_per_entity(visits: DataFrame, areas: DataFrame, single_bbox_ok: bool = False) -> DataFrame:
    """Distinct area names visited per entity, long form ``entity, name``; no area gives ``Not Found``."""
    spots = visits.select("entity", "lat", "lng").distinct()
    located = locate(spots, areas, single_bbox_ok).select("entity", "code").distinct()
    named = located.join(areas.select("code", "name"), "code", "left")
    return named.select("entity", F.coalesce("name", F.lit(NOT_FOUND)).alias("name")).distinct()
