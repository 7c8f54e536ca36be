"""Which addresses lie inside which polygon."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescore.functions import geometry
from sitescore.operators.balance import MIN_WORK, balanced_join
from sitescore.session import cut_lineage, spread

CELLS_PER_SIDE = 8
CELL = ("__level", "__cx", "__cy")


def travel_boundary(
    df: DataFrame,
    minutes: float = 5.0,
    mph: float = 30.0,
    radius: float | None = None,
    x: str = "x",
    y: str = "y",
    polygon: str = "polygon",
    text: bool = True,
) -> DataFrame:
    """Add an octagon that holds what a straight drive of ``minutes`` reaches.

    The edges touch the reach and the corners lie beyond it. ``radius`` (degrees
    on both axes, from the centre to the corners) overrides speed and time. The polygon is
    GeoJSON text, or the nested form with ``text=False``. Coordinates that are
    not numbers give a NULL polygon.
    """
    if radius is None:
        # the edges of the octagon, not its corners, must lie beyond the reach
        degrees = mph * minutes / 60.0 / geometry.MILES_PER_DEGREE / geometry.OCTAGON_INRADIUS
        rx, ry = f"({degrees!r}D / cos(radians(__py)))", f"{degrees!r}D"
    else:
        rx = ry = f"{float(radius)!r}D"
    placed = df.withColumns({"__px": F.col(x).try_cast("double"), "__py": F.col(y).try_cast("double")})
    shaped = placed.withColumn(polygon, geometry.octagon("__px", "__py", rx, ry)).drop("__px", "__py")
    return shaped.withColumn(polygon, geometry.polygon_to_geojson(polygon)) if text else shaped


# Side of a cell: a power of two by its level, so dividing by it is exact.
_SIDE = f"(pow(2D, __level) / {CELLS_PER_SIDE})"


def _cells(low: str, high: str) -> Column:
    return F.expr(f"sequence(floor({low} / {_SIDE}), floor({high} / {_SIDE}))")


def polygon_cells(sites: DataFrame, keep: Sequence[str], polygon: str) -> DataFrame:
    """One row (keep, edges, level, cell) per polygon and grid cell it shares points with.

    The level follows the size of the polygon's box, so a polygon of any size
    covers at most (CELLS_PER_SIDE + 2) squared cells of its own level. A cell
    the outline passes carries the edges that matter inside it; a cell wholly
    inside carries NULL, and one wholly outside is left out.
    """
    is_text = dict(sites.dtypes)[polygon] == "string"
    shape = geometry.polygon_from_geojson(polygon) if is_text else F.col(polygon)
    # Exploding one-element arrays keeps the optimizer from inlining a value
    # into every place that uses it.
    shaped = sites.where(F.col(polygon).isNotNull()).select(*keep, F.explode(F.array(shape)).alias("__shape"))
    box = [column.alias(f"__{name}") for name, column in geometry.polygon_box("__shape").items()]
    described = F.struct(geometry.polygon_edges("__shape").alias("__edges"), *box)
    level = F.expr("CAST(ceil(log2(greatest(__max_x - __min_x, __max_y - __min_y, 1e-9D))) AS INT)").alias("__level")
    boxed = shaped.select(*keep, F.inline(F.array(described))).where("__min_x IS NOT NULL").select("*", level)
    rows = boxed.select(*keep, "__edges", "__level", _cells("__min_x", "__max_x").alias("__xs"), _cells("__min_y", "__max_y").alias("__ys"))
    cells = rows.select(*keep, "__edges", "__level", F.explode("__xs").alias("__cx"), "__ys")
    cells = cells.select(*keep, "__edges", "__level", "__cx", F.explode("__ys").alias("__cy"))

    # The rectangle is a little larger than the cell, beyond rounding errors.
    rectangle = F.expr(f"""
        array(named_struct('__x0', (__cx - 1e-6D) * {_SIDE}, '__x1', (__cx + 1.000001D) * {_SIDE},
                           '__y0', (__cy - 1e-6D) * {_SIDE}, '__y1', (__cy + 1.000001D) * {_SIDE}))""")
    placed = cells.select("*", F.inline(rectangle))
    near = F.explode(F.array(geometry.edges_for("__edges", "__x0", "__y0", "__y1"))).alias("__near")
    narrowed = placed.select(*keep, *CELL, "__x0", "__x1", "__y0", "__y1", near)
    passes = F.explode(F.array(geometry.touches("__near", "__x0", "__x1", "__y0", "__y1"))).alias("__outline")
    inside = geometry.covers("__near", "((__x0 + __x1) / 2)", "((__y0 + __y1) / 2)")
    kept = narrowed.select("*", passes).where(F.col("__outline") | inside)
    return kept.select(*keep, F.expr("CASE WHEN __outline THEN __near END").alias("__edges"), *CELL)


def geofence(
    sites: DataFrame,
    addresses: DataFrame,
    keep: Sequence[str] = ("site_id",),
    carry: Sequence[str] = ("addr_id",),
    polygon: str = "polygon",
    x: str = "lon",
    y: str = "lat",
    min_work: int = MIN_WORK,
) -> DataFrame:
    """Join polygons with the points they hold: one row (keep + carry) per hit.

    Points on the boundary count as inside, points in holes do not; polygons
    that are NULL or hold nothing give no row. The join runs on grid cells with
    dense cells split; a point has one cell per level and a polygon one level,
    so a hit appears once.
    """
    # The cells are read three times below and written once.
    cells = cut_lineage(polygon_cells(spread(sites.select(*keep, polygon), *keep), keep, polygon))
    # Powers of two between the smallest and the largest box: a handful of numbers.
    levels = [row[0] for row in cells.select("__level").distinct().collect()]
    points = addresses.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *carry, F.col(x).alias("__x"), F.col(y).alias("__y"), F.explode(F.lit(levels).cast("array<int>")).alias("__level")
    )
    points = points.select("*", *[F.expr(f"floor(__{c} / {_SIDE})").alias(f"__c{c}") for c in ("x", "y")])
    candidates = balanced_join(cells, points, CELL, min_work=min_work, left_by=list(keep), right_by=list(carry))
    return candidates.where(F.col("__edges").isNull() | geometry.covers("__edges", "__x", "__y")).select(*keep, *carry)


def fence_sizes(bridge: DataFrame, key: str = "site_id") -> DataFrame:
    """Addresses per site."""
    return bridge.groupBy(key).agg(F.count(F.lit(1)).alias("locs_in_fence"))
