"""Geometry as column expressions.

A polygon column is ``ARRAY<ARRAY<ARRAY<STRUCT<x,y>>>>``: parts, each a list of
closed rings (the first is the shell, the others are holes). x is the longitude,
y the latitude; arithmetic is planar. Boxes over the antimeridian are not
supported.

Arguments are SQL texts (mostly column names); the expressions are long, and one
text costs a single call to the JVM.
"""

from __future__ import annotations

from math import cos, pi

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit octagon, counter-clockwise and closed.
OCTAGON = (
    (1.0, 0.0),
    (0.7071067811865476, 0.7071067811865476),
    (0.0, 1.0),
    (-0.7071067811865476, 0.7071067811865476),
    (-1.0, 0.0),
    (-0.7071067811865476, -0.7071067811865476),
    (0.0, -1.0),
    (0.7071067811865476, -0.7071067811865476),
    (1.0, 0.0),
)
#: Distance of the unit octagon's edges from its centre.
OCTAGON_INRADIUS = cos(pi / 8)
MILES_PER_DEGREE = 69.0

# A boundary hit adds this even number, a ray crossing adds 1.
_ON_EDGE = 1 << 40


def ring(x: str, y: str, offsets: list[tuple[str, str]]) -> str:
    """SQL text of a ring from offsets around (x, y)."""
    points = [f"named_struct('x', CAST({x} + {dx} AS DOUBLE), 'y', CAST({y} + {dy} AS DOUBLE))" for dx, dy in offsets]
    return f"array({', '.join(points)})"


def octagon_ring(x: str, y: str, rx: str, ry: str | None = None) -> str:
    ry = rx if ry is None else ry
    return ring(x, y, [(f"({dx!r}D * {rx})", f"({dy!r}D * {ry})") for dx, dy in OCTAGON])


def octagon(x: str, y: str, rx: str, ry: str | None = None) -> Column:
    """One-part polygon around (x, y) with half axes rx and ry in degrees."""
    return F.expr(f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN array(array({octagon_ring(x, y, rx, ry)})) END")


def polygon_from_geojson(text: str) -> Column:
    """Polygon or MultiPolygon text (bare or inside a Feature); anything else is NULL."""
    geometry = f"coalesce(get_json_object({text}, '$.geometry'), {text})"
    coordinates = f"get_json_object({geometry}, '$.coordinates')"
    return F.expr(f"""
        transform(
          CASE get_json_object({geometry}, '$.type')
            WHEN 'Polygon' THEN filter(array(from_json({coordinates}, 'ARRAY<ARRAY<ARRAY<DOUBLE>>>')), part -> part IS NOT NULL)
            WHEN 'MultiPolygon' THEN from_json({coordinates}, 'ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>')
          END,
          part -> transform(part, line -> transform(line, p -> named_struct('x', p[0], 'y', p[1]))))""")


def polygon_to_geojson(parts: str) -> Column:
    """GeoJSON text: Polygon for one part, MultiPolygon for several."""
    numbers = f"transform({parts}, part -> transform(part, line -> transform(line, p -> array(p.x, p.y))))"
    return F.expr(f"""
        CASE WHEN size({parts}) = 1 THEN to_json(named_struct('type', 'Polygon', 'coordinates', {numbers}[0]))
             WHEN size({parts}) > 1 THEN to_json(named_struct('type', 'MultiPolygon', 'coordinates', {numbers})) END""")


def polygon_edges(parts: str) -> Column:
    """Per part, the edges of all its rings as ``STRUCT<ax, ay, bx, by>``."""
    return F.expr(f"""
        transform({parts}, part -> flatten(transform(part, line ->
          zip_with(slice(line, 1, greatest(size(line) - 1, 0)), slice(line, 2, greatest(size(line) - 1, 0)),
                   (a, b) -> named_struct('ax', a.x, 'ay', a.y, 'bx', b.x, 'by', b.y)))))""")


def polygon_box(parts: str) -> dict[str, Column]:
    points = f"flatten(flatten({parts}))"
    return {f"{f}_{c}": F.expr(f"array_{f}(transform({points}, p -> p.{c}))") for c in ("x", "y") for f in ("min", "max")}


def _side(x: str, y: str) -> str:
    """Positive if (x, y) is left of edge ``e``, 0 on its line."""
    return f"((e.bx - e.ax) * ({y} - e.ay) - (e.by - e.ay) * ({x} - e.ax))"


def covers(edges: str, x: str, y: str) -> Column:
    """Whether any part holds the point: even-odd over its edges, boundary included."""
    side = _side(x, y)
    return F.expr(f"""
        exists({edges}, part -> aggregate(part, 0L, (score, e) -> score + CASE
            WHEN {y} BETWEEN least(e.ay, e.by) AND greatest(e.ay, e.by)
             AND {x} BETWEEN least(e.ax, e.bx) AND greatest(e.ax, e.bx) AND {side} = 0 THEN {_ON_EDGE}L
            WHEN (e.ay <= {y} AND {y} < e.by AND {side} > 0) OR (e.by <= {y} AND {y} < e.ay AND {side} < 0) THEN 1L
            ELSE 0L END,
          score -> score >= {_ON_EDGE}L OR score % 2 = 1))""")


def edges_for(edges: str, x0: str, y0: str, y1: str) -> Column:
    """The edges that can decide about points with x >= x0 and y0 <= y <= y1."""
    return F.expr(f"""
        transform({edges}, part -> filter(part, e ->
          least(e.ay, e.by) <= {y1} AND greatest(e.ay, e.by) >= {y0} AND greatest(e.ax, e.bx) >= {x0}))""")


def touches(edges: str, x0: str, x1: str, y0: str, y1: str) -> Column:
    """Whether any edge meets the rectangle."""
    corners = ", ".join(_side(x, y) for x in (x0, x1) for y in (y0, y1))
    return F.expr(f"""
        exists({edges}, part -> exists(part, e ->
          least(e.ax, e.bx) <= {x1} AND greatest(e.ax, e.bx) >= {x0}
          AND least(e.ay, e.by) <= {y1} AND greatest(e.ay, e.by) >= {y0}
          AND least({corners}) <= 0 AND greatest({corners}) >= 0))""")
