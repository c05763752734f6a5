"""Geometry on arrays as native higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distance(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance of two equally long numeric arrays."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap))


def _crosses(lat: Column, lng: Column, lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Does the ray from a point along increasing ``lng`` cross an edge?"""
    at = F.try_divide((lng2 - lng1) * (lat - lat1), lat2 - lat1) + lng1
    return F.coalesce(((lat1 < lat) != (lat2 < lat)) & (lng < at), F.lit(False))


def contains(ring: Column | str, lat: Column | str, lng: Column | str) -> Column:
    """Even-odd test of a point against a ring of ``struct<lat, lng>`` vertices.

    Each edge from a vertex to the next one (cyclic) flips the result when a ray
    from the point along increasing ``lng`` crosses it.
    """
    ring = F.col(ring) if isinstance(ring, str) else ring
    lat = F.col(lat) if isinstance(lat, str) else lat
    lng = F.col(lng) if isinstance(lng, str) else lng
    following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    def crosses(p: Column, q: Column) -> Column:
        return _crosses(lat, lng, p["lat"], p["lng"], q["lat"], q["lng"])

    crossings = F.filter(F.zip_with(ring, following, crosses), lambda hit: hit)
    return F.size(crossings) % 2 == 1


def in_cell(lat: Column | str, lng: Column | str, base: Column | str, turns: Column | str, edges: Column | str) -> Column:
    """``contains`` for a point of a cell that keeps only the edges near it.

    ``base`` and ``turns`` are the parity of the edges left out: it changes at each latitude of ``turns``.
    """
    lat, lng, base, turns, edges = (F.col(c) if isinstance(c, str) else c for c in (lat, lng, base, turns, edges))
    crossed = F.filter(edges, lambda e: _crosses(lat, lng, e["lat1"], e["lng1"], e["lat2"], e["lng2"]))
    return (base.cast("int") + F.size(F.filter(turns, lambda v: v < lat)) + F.size(crossed)) % 2 == 1


def in_box(lat: Column | str, lng: Column | str, box: Column | None = None) -> Column:
    """True if the point lies in a closed box with fields ``min_lat .. max_lng`` (a struct, or columns)."""
    lat = F.col(lat) if isinstance(lat, str) else lat
    lng = F.col(lng) if isinstance(lng, str) else lng

    def side(name: str) -> Column:
        return F.col(name) if box is None else box[name]

    return lat.between(side("min_lat"), side("max_lat")) & lng.between(side("min_lng"), side("max_lng"))
