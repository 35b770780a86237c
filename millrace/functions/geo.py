"""Geometry values as structs, and the exact spatial relation test.

A geometry is ``struct<type, coordinates_json, min_x, min_y, max_x, max_y>``: the
bounding box is plain columns so that it filters in the scan, the coordinates are
read only for rows that pass it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

GEOMETRY_DDL = (
    "struct<type:string,coordinates_json:string,"
    "min_x:double,min_y:double,max_x:double,max_y:double>"
)

# Nesting depth of the coordinates of each GeoJSON type.
COORDINATE_DEPTH = {
    "Point": 0,
    "LineString": 1,
    "MultiPoint": 1,
    "Polygon": 2,
    "MultiLineString": 2,
    "MultiPolygon": 3,
}
RELATIONS = ("INTERSECTS", "DISJOINT", "WITHIN")


# ---------------------------------------------------------------- constructors

def _type_of(depth: int) -> str:
    inner = "array<double>"
    for _ in range(depth):
        inner = f"array<{inner}>"
    return inner


def _positions(coordinates: Column, depth: int) -> Column:
    """All positions of a nested coordinate array as one flat array."""
    if depth == 0:
        return F.array(coordinates)
    for _ in range(depth - 1):
        coordinates = F.flatten(coordinates)
    return coordinates


def geometry(kind: str, coordinates: Column) -> Column:
    """Geometry of nested double arrays; every position needs two or three values."""
    depth = COORDINATE_DEPTH[kind]
    coordinates = coordinates.cast(_type_of(depth))
    positions = _positions(coordinates, depth)
    valid = F.forall(positions, lambda p: F.size(p).isin(2, 3))
    xs = F.transform(positions, lambda p: F.get(p, F.lit(0)))
    ys = F.transform(positions, lambda p: F.get(p, F.lit(1)))
    built = F.struct(
        F.lit(kind).alias("type"),
        F.to_json(F.struct(coordinates.alias("c"))).substr(F.lit(6), F.length(F.to_json(F.struct(coordinates.alias("c")))) - 6)
        .alias("coordinates_json"),
        F.array_min(xs).alias("min_x"),
        F.array_min(ys).alias("min_y"),
        F.array_max(xs).alias("max_x"),
        F.array_max(ys).alias("max_y"),
    )
    problem = F.raise_error(F.lit(f"{kind}: a position needs two or three values")).cast(GEOMETRY_DDL)
    return F.when(coordinates.isNull(), F.lit(None)).when(valid, built).otherwise(problem)


def point(lon: Column, lat: Column, elevation: Column | None = None) -> Column:
    parts = [lon, lat] if elevation is None else [lon, lat, elevation]
    return geometry("Point", F.array(*[p.cast("double") for p in parts]))


def pair_up(flat: Column, width: int = 2) -> Column:
    """Positions of a flat ``lon, lat[, elevation], lon, ...`` array."""
    if width not in (2, 3):
        raise ValueError("positions have two or three values")
    whole = F.size(flat) % width == 0
    count = F.floor(F.size(flat) / width).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.slice(flat, i * width + 1, F.lit(width))
    )
    empty = F.array().cast("array<array<double>>")
    problem = F.raise_error(F.lit(f"coordinate count is not a multiple of {width}")).cast("array<array<double>>")
    return F.when(~whole, problem).when(count == 0, empty).otherwise(cut.cast("array<array<double>>"))


def line_string(positions: Column) -> Column:
    return geometry("LineString", positions)


def multi_point(positions: Column) -> Column:
    return geometry("MultiPoint", positions)


def polygon(rings: Column) -> Column:
    return geometry("Polygon", rings)


def multi_line_string(lines: Column) -> Column:
    return geometry("MultiLineString", lines)


def multi_polygon(polygons: Column) -> Column:
    return geometry("MultiPolygon", polygons)


def parse_feature(text: Column, strict: bool = True) -> Column:
    """GeoJSON Feature text to ``struct<geometry, properties_json>``; another type is an error."""
    kind = F.get_json_object(text, "$.geometry.type")
    raw = F.get_json_object(text, "$.geometry.coordinates")
    result = F.lit(None).cast(GEOMETRY_DDL)
    for name, depth in COORDINATE_DEPTH.items():
        parsed = F.from_json(F.concat(F.lit('{"c":'), raw, F.lit("}")), f"c {_type_of(depth)}")["c"]
        result = F.when(kind == name, geometry(name, parsed)).otherwise(result)
    bad = (F.get_json_object(text, "$.type") != "Feature") | result.isNull()
    feature = F.struct(
        result.alias("geometry"), F.get_json_object(text, "$.properties").alias("properties_json")
    )
    ddl = f"struct<geometry:{GEOMETRY_DDL},properties_json:string>"
    missing = F.lit(None).cast(ddl)
    if strict:
        missing = F.raise_error(F.concat(F.lit("not a GeoJSON feature: "), text)).cast(ddl)
    return F.when(text.isNull(), F.lit(None).cast(ddl)).when(F.coalesce(bad, F.lit(True)), missing).otherwise(feature)


def feature_json(geom: Column, properties_json: Column | None = None) -> Column:
    """GeoJSON Feature text of a geometry."""
    props = F.coalesce(properties_json, F.lit("{}")) if properties_json is not None else F.lit("{}")
    return F.format_string(
        '{"type":"Feature","geometry":{"type":"%s","coordinates":%s},"properties":%s}',
        geom["type"], geom["coordinates_json"], props,
    )


# ------------------------------------------------------------- exact predicate

def _parts(kind: str, coordinates) -> tuple[list, list, list]:
    """Split a geometry into points, lines and polygons (lists of rings)."""
    cut = lambda p: [float(p[0]), float(p[1])]
    line = lambda ps: np.array([cut(p) for p in ps])
    if kind == "Point":
        return [cut(coordinates)], [], []
    if kind == "MultiPoint":
        return [cut(p) for p in coordinates], [], []
    if kind == "LineString":
        return [], [line(coordinates)], []
    if kind == "MultiLineString":
        return [], [line(ps) for ps in coordinates], []
    if kind == "Polygon":
        return [], [], [[line(r) for r in coordinates]]
    if kind == "MultiPolygon":
        return [], [], [[line(r) for r in rings] for rings in coordinates]
    raise ValueError(f"unknown geometry type {kind}")


def _segments(lines: Sequence[np.ndarray]) -> np.ndarray:
    pieces = [np.hstack([ps[:-1], ps[1:]]) for ps in lines if len(ps) > 1]
    return np.vstack(pieces) if pieces else np.empty((0, 4))


def _side(ax, ay, bx, by, px, py):
    return np.sign((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def _on_segment(segments: np.ndarray, x: float, y: float) -> bool:
    if not len(segments):
        return False
    ax, ay, bx, by = segments.T
    level = _side(ax, ay, bx, by, x, y) == 0
    inside = (np.minimum(ax, bx) <= x) & (x <= np.maximum(ax, bx))
    inside &= (np.minimum(ay, by) <= y) & (y <= np.maximum(ay, by))
    return bool((level & inside).any())


def _crossing(a: np.ndarray, b: np.ndarray, proper: bool = False) -> bool:
    """Whether any segment of ``a`` meets one of ``b`` (``proper``: crosses through)."""
    for x1, y1, x2, y2 in a:
        if not len(b):
            return False
        cx, cy, dx, dy = b.T
        d1, d2 = _side(x1, y1, x2, y2, cx, cy), _side(x1, y1, x2, y2, dx, dy)
        d3, d4 = _side(cx, cy, dx, dy, x1, y1), _side(cx, cy, dx, dy, x2, y2)
        if ((d1 * d2 < 0) & (d3 * d4 < 0)).any():
            return True
        if not proper and (
            _on_segment(b, x1, y1) or _on_segment(b, x2, y2)
            or any(_on_segment(np.array([[x1, y1, x2, y2]]), px, py)
                   for px, py in np.vstack([b[:, :2], b[:, 2:]]))
        ):
            return True
    return False


def _in_rings(rings: list, x: float, y: float) -> int:
    """1 strictly inside, 0 on the border, -1 outside (even-odd rule over all rings)."""
    segments = _segments(rings)
    if _on_segment(segments, x, y):
        return 0
    ax, ay, bx, by = segments.T
    spans = (ay > y) != (by > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        cross_x = ax + (y - ay) * (bx - ax) / (by - ay)
    return 1 if int((spans & (x < cross_x)).sum()) % 2 else -1


def _covers_point(shape, x, y) -> bool:
    points, lines, polygons = shape
    return (
        [x, y] in points
        or _on_segment(_segments(lines), x, y)
        or any(_in_rings(rings, x, y) >= 0 for rings in polygons)
    )


def _borders(shape) -> np.ndarray:
    _, lines, polygons = shape
    return _segments(list(lines) + [ring for rings in polygons for ring in rings])


def _vertices(shape) -> list:
    points, lines, polygons = shape
    out = list(points)
    for ps in list(lines) + [ring for rings in polygons for ring in rings]:
        out.extend(ps.tolist())
    return out


def shapes_intersect(a, b) -> bool:
    """Touching borders count as intersecting."""
    if any(_covers_point(b, x, y) for x, y in _vertices(a)):
        return True
    if any(_covers_point(a, x, y) for x, y in _vertices(b)):
        return True
    return _crossing(_borders(a), _borders(b))


def _cuts(segment: np.ndarray, others: np.ndarray) -> list[float]:
    """Positions (0..1) along a segment where it meets other segments."""
    x1, y1, x2, y2 = segment
    ts = [0.0, 1.0]
    for cx, cy, dx, dy in others:
        den = (x2 - x1) * (dy - cy) - (y2 - y1) * (dx - cx)
        if den:
            t = ((cx - x1) * (dy - cy) - (cy - y1) * (dx - cx)) / den
            if 0 < t < 1:
                ts.append(t)
        for px, py in ((cx, cy), (dx, dy)):
            if _on_segment(np.array([segment]), px, py):
                span = (x2 - x1) if abs(x2 - x1) >= abs(y2 - y1) else (y2 - y1)
                if span:
                    ts.append(((px - x1) if abs(x2 - x1) >= abs(y2 - y1) else (py - y1)) / span)
    return sorted(set(ts))


def shape_within(a, b) -> bool:
    """Every part of ``a`` lies in ``b``, borders included."""
    if not all(_covers_point(b, x, y) for x, y in _vertices(a)):
        return False
    others = _borders(b)
    for segment in _borders(a):
        x1, y1, x2, y2 = segment
        ts = _cuts(segment, others)
        for t0, t1 in zip(ts, ts[1:]):
            m = (t0 + t1) / 2
            if not _covers_near(b, x1 + m * (x2 - x1), y1 + m * (y2 - y1)):
                return False
    # A hole of b strictly inside an area of a leaves a part uncovered.
    for rings in a[2]:
        for outer in b[2]:
            for hole in outer[1:]:
                inner = _inner_point(hole)
                if inner and _in_rings(rings, *inner) > 0 and not _covers_point(b, *inner):
                    return False
    return True


def _inner_point(ring: np.ndarray) -> tuple[float, float] | None:
    """A point inside a ring of any form: midway between the first two crossings of a level line."""
    levels = np.unique(ring[:, 1])
    if len(levels) < 2:
        return None
    y = (levels[0] + levels[1]) / 2
    (x1, y1), (x2, y2) = ring[:-1].T, ring[1:].T
    cut = (y1 > y) != (y2 > y)
    xs = np.sort(x1[cut] + (y - y1[cut]) * (x2[cut] - x1[cut]) / (y2[cut] - y1[cut]))
    return (float(xs[0] + xs[1]) / 2, float(y)) if len(xs) > 1 else None


def _covers_near(shape, x: float, y: float, eps: float = 1e-9) -> bool:
    """As ``_covers_point``, forgiving the rounding of a computed midpoint."""
    if _covers_point(shape, x, y):
        return True
    segments = _borders(shape)
    if not len(segments):
        return False
    ax, ay, bx, by = segments.T
    length = np.hypot(bx - ax, by - ay)
    length[length == 0] = 1
    along = np.clip(((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / length**2, 0, 1)
    gap = np.hypot(ax + along * (bx - ax) - x, ay + along * (by - ay) - y)
    return bool((gap <= eps).any())


def _bounds(vertices: list) -> tuple[float, float, float, float]:
    xs, ys = [v[0] for v in vertices], [v[1] for v in vertices]
    return min(xs), min(ys), max(xs), max(ys)


def _covered(shape, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``_covers_point`` of many points at once, for a shape of polygons only."""
    covered = np.zeros(len(x), bool)
    for rings in shape[2]:
        border, odd = np.zeros(len(x), bool), np.zeros(len(x), bool)
        for ax, ay, bx, by in _segments(rings):
            border |= (_side(ax, ay, bx, by, x, y) == 0) & (min(ax, bx) <= x) & (x <= max(ax, bx)) \
                & (min(ay, by) <= y) & (y <= max(ay, by))
            if ay != by:
                odd ^= ((ay > y) != (by > y)) & (x < ax + (y - ay) * (bx - ax) / (by - ay))
        covered |= border | odd
    return covered


def _convex(shape) -> bool:
    """Whether the shape is one polygon without holes that only turns one way, once around."""
    points, lines, polygons = shape
    if points or lines or len(polygons) != 1 or len(polygons[0]) != 1:
        return False
    ring = polygons[0][0]
    steps = np.diff(ring, axis=0)
    steps = steps[(steps != 0).any(axis=1)]
    if len(steps) < 3 or (ring[0] != ring[-1]).any():
        return False
    turns = np.arctan2(*_turn(steps, np.roll(steps, -1, axis=0)))
    return bool(((turns > 0).all() or (turns < 0).all()) and abs(abs(turns.sum()) - 2 * np.pi) < 1e-6)


def _turn(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0], (a * b).sum(axis=1)


def within_each(shapes: list, target) -> list[bool]:
    """``shape_within`` of each shape. A shape with a vertex outside is not within, which is told for all
    shapes at once; one with all vertices in a convex polygon is."""
    if target[0] or target[1]:
        return [shape_within(s, target) for s in shapes]
    vertices = [_vertices(s) for s in shapes]
    sizes = np.array([len(v) for v in vertices], int)
    flat = np.array([p for v in vertices for p in v], float).reshape(-1, 2)
    owner = np.repeat(np.arange(len(shapes)), sizes)
    outside = np.bincount(owner[~_covered(target, flat[:, 0], flat[:, 1])], minlength=len(shapes)) > 0
    convex = _convex(target)
    return [not out and (convex or shape_within(s, target)) for s, out in zip(shapes, outside.tolist())]


def geo_relation(geom: Column, relation: str, shape: dict) -> Column:
    """INTERSECTS, DISJOINT or WITHIN against one literal GeoJSON shape.

    The box test runs on plain columns; only rows whose box meets the shape's box
    reach the vectorised exact test.
    """
    if relation not in RELATIONS:
        raise ValueError(f"relation must be one of {RELATIONS}")
    if shape.get("type") not in COORDINATE_DEPTH:
        raise ValueError(f"unknown geometry type {shape.get('type')!r}")
    target = _parts(shape["type"], shape["coordinates"])
    min_x, min_y, max_x, max_y = _bounds(_vertices(target))
    near = (
        (geom["min_x"] <= max_x) & (geom["max_x"] >= min_x)
        & (geom["min_y"] <= max_y) & (geom["max_y"] >= min_y)
    )
    if relation == "WITHIN":  # the whole box of a shape within lies in the box
        near = (geom["min_x"] >= min_x) & (geom["max_x"] <= max_x) & (geom["min_y"] >= min_y) & (geom["max_y"] <= max_y)

    @F.pandas_udf("boolean")
    def exact(kind: pd.Series, coordinates: pd.Series) -> pd.Series:
        given = (kind.notna() & coordinates.notna()).to_numpy()
        shapes = [_parts(k, json.loads(c)) for k, c in zip(kind[given], coordinates[given])]
        met = pd.Series([None] * len(kind), dtype=object)
        met[given] = within_each(shapes, target) if relation == "WITHIN" else [shapes_intersect(s, target) for s in shapes]
        return met

    # Rows away from the box send nulls, so no coordinates are parsed for them.
    hit = exact(F.when(near, geom["type"]), F.when(near, geom["coordinates_json"]))
    met = near & F.coalesce(hit, F.lit(False))
    return geom.isNotNull() & ~met if relation == "DISJOINT" else met
