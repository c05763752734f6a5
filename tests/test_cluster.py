"""Clustering against a brute-force version."""

import random

import pytest

from tagmill.operators import cluster, metric_cluster


def brute_force(points, eps, min_pts):
    near = {i: [j for j, q in points.items() if sum((a - b) ** 2 for a, b in zip(p, q)) ** .5 <= eps] for i, p in points.items()}
    core = {i for i in near if len(near[i]) >= min_pts}
    number, out = 0, {}
    for i in sorted(core):
        if i in out:
            continue
        number += 1
        stack = [i]
        while stack:
            k = stack.pop()
            if k not in out:
                out[k] = (number, 1)
                stack += [j for j in near[k] if j in core and j not in out]
    for i in points:
        if i not in core:
            found = [out[j][0] for j in near[i] if j in core]
            out[i] = (min(found), 0) if found else (0, -1)
    return out


def run(spark, points, eps, min_pts, partitions=3):
    df = spark.createDataFrame([(i, list(p)) for i, p in points.items()], "id bigint, vec array<double>").repartition(partitions)
    rows = cluster.dbscan(df, eps, min_pts).collect()
    assert len(rows) == len(points)
    return {r.id: (r.cluster, r.kind) for r in rows}


def uniform(seed, n, dims=2):
    rng = random.Random(seed)
    return {i: tuple(rng.random() for _ in range(dims)) for i in range(n)}


@pytest.mark.parametrize("seed, n, eps, min_pts", [(1, 250, 0.05, 4), (2, 250, 0.08, 6), (4, 150, 0.5, 5)])
def test_uniform_points(spark, seed, n, eps, min_pts):
    points = uniform(seed, n)
    assert run(spark, points, eps, min_pts) == brute_force(points, eps, min_pts)


def test_three_dimensions(spark):
    points = uniform(5, 200, 3)
    assert run(spark, points, 0.15, 4) == brute_force(points, 0.15, 4)


def test_hot_cell_duplicates_and_partitioning(spark, monkeypatch):
    """A third of the points in one spot; salted keys; same result however the input is split."""
    monkeypatch.setattr(cluster, "CHUNK", 10)
    rng = random.Random(6)
    points = uniform(7, 120)
    points.update({200 + i: (0.5, 0.5) for i in range(40)})
    points.update({300 + i: (0.5 + rng.gauss(0, .01), 0.5 + rng.gauss(0, .01)) for i in range(40)})
    expected = brute_force(points, 0.04, 5)
    assert run(spark, points, 0.04, 5, 2) == expected
    assert run(spark, points, 0.04, 5, 7) == expected


def test_dense_blobs_near_the_radius_are_refined(spark, monkeypatch):
    """Dense cells whose closest points decide, some just inside and some just outside the radius."""
    calls = []
    original = cluster._closest_within
    monkeypatch.setattr(cluster, "_closest_within", lambda *a: calls.append(1) or original(*a))
    monkeypatch.setattr(cluster, "DIRECT", 2)
    rng, points, eps = random.Random(8), {}, 0.1
    for blob in range(6):
        # Discs of radius 0.03 whose centres are a little more than one radius apart.
        centre = (blob * (0.155 if blob % 2 else 0.158), (blob % 3) * 0.004)
        for _ in range(30):
            while True:
                dx, dy = rng.uniform(-.03, .03), rng.uniform(-.03, .03)
                if dx * dx + dy * dy <= .0009:
                    break
            points[len(points)] = (centre[0] + dx, centre[1] + dy)
    assert run(spark, points, eps, 4) == brute_force(points, eps, 4)
    assert calls


def test_single_point_and_none(spark):
    assert run(spark, {1: (0.0, 0.0)}, 1.0, 2) == {1: (0, -1)}
    empty = spark.createDataFrame([], "id bigint, vec array<double>")
    assert cluster.dbscan(empty, 1.0, 2).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    out = {r.node: r.component for r in cluster.connected_components(df).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}}


def blobs(seed, width, eps):
    """Tight groups, loose groups, a chain and scattered points."""
    rng, out = random.Random(seed), {}

    def put(centre, spread, n):
        for _ in range(n):
            out[len(out)] = tuple(c + rng.gauss(0, spread) for c in centre)

    for k in range(4):
        put([rng.uniform(-3, 3) for _ in range(width)], eps / 20 if k % 2 else eps / 3.5, 60)
    start = [rng.uniform(-3, 3) for _ in range(width)]
    for k in range(40):
        put([start[0] + k * eps * .45] + start[1:], eps / 50, 2)
    put([0.0] * width, 2.0, 40)
    out.update({len(out) + i: out[3] for i in range(30)})
    return out


@pytest.mark.parametrize("seed, width, eps, min_pts", [(1, 5, 0.6, 4), (2, 16, 1.0, 5), (3, 64, 1.0, 3), (4, 8, 0.5, 12)])
def test_long_vectors(spark, seed, width, eps, min_pts):
    points = blobs(seed, width, eps)
    assert run(spark, points, eps, min_pts) == brute_force(points, eps, min_pts)


def test_long_vectors_in_many_blocks_and_crowds(spark, monkeypatch):
    for name, value in (("PER_PIVOT", 40), ("LEAST_PIVOTS", 4), ("CROWD", 20), ("BLOCK_VALUES", 64 * 6), ("MATRIX", 100)):
        monkeypatch.setattr(metric_cluster, name, value)
    points = blobs(5, 6, 0.6)
    expected = brute_force(points, 0.6, 6)
    assert len({c for c, _ in expected.values()}) > 3 and {k for _, k in expected.values()} == {1, 0, -1}
    assert run(spark, points, 0.6, 6) == expected


def test_rows_without_a_place_are_noise(spark):
    rows = [(1, None), (2, [float("nan")] * 5), (3, [0.0] * 5), (4, [0.0] * 5), (5, [None] + [0.0] * 4), (6, [float("inf")] * 5)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>")
    assert sorted(map(tuple, cluster.dbscan(df, 1.0, 2).collect())) == [(1, 0, -1), (2, 0, -1), (3, 1, 1), (4, 1, 1), (5, 0, -1), (6, 0, -1)]
    empty = df.filter("id = 1")
    assert cluster.dbscan(empty, 1.0, 2, dims=5).count() == 1


def test_long_vectors_visit_blocks_until_they_are_settled(spark, monkeypatch):
    """Where points have many neighbours most visit few of the blocks; far pieces and lone points visit the others."""
    for name, value in (("PER_PIVOT", 20), ("LEAST_PIVOTS", 4), ("BLOCK_VALUES", 64 * 5), ("MATRIX", 400)):
        monkeypatch.setattr(metric_cluster, name, value)
    visits, blocks = [], metric_cluster._blocks

    def counted(layout, targets, asks, *rest):
        visits.append((layout.blocks, asks.selectExpr("coalesce(sum(size(blocks)), 0)").first()[0]))
        return blocks(layout, targets, asks, *rest)

    monkeypatch.setattr(metric_cluster, "_blocks", counted)
    points = uniform(11, 600, 5)
    points.update({600 + i: (p[0] + 1.7, *p[1:]) for i, p in uniform(12, 60, 5).items()})
    points.update({700 + i: (9.0 * i + 9, 0.0, 0.0, 0.0, 0.0) for i in range(5)})
    points.update({710 + i: (0.5, 0.5, 0.5, 0.5, 1.25 + 0.55 * i) for i in range(4)})
    expected = brute_force(points, 0.6, 4)
    assert len({c for c, _ in expected.values()}) > 2 and {k for _, k in expected.values()} == {1, 0, -1}
    assert run(spark, points, 0.6, 4) == expected
    many = visits[0][0]
    assert many >= 10 and len(visits) > 4
    assert sum(n for _, n in visits) < 0.7 * many * len(points)
