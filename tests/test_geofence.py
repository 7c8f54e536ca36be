import math
import random

import pytest
from pyspark.sql import functions as F

from sitescore.functions import geometry
from sitescore.operators.geofence import fence_sizes, geofence, polygon_cells, travel_boundary


def inside(rings, x, y):
    """Even-odd over all rings, boundary included, by exact fractions-free arithmetic on floats."""
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
            if side == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
            if (ay <= y < by and side > 0) or (by <= y < ay and side < 0):
                odd = not odd
    return odd


def star(rng, cx, cy, radius, corners):
    """A ring around a centre with random radii: often concave, never self-crossing. Corners on a coarse raster."""
    points = []
    for i in range(corners):
        angle = 2 * math.pi * i / corners
        r = radius * rng.uniform(0.3, 1.0)
        points.append((round(cx + r * math.cos(angle), 2), round(cy + r * math.sin(angle), 2)))
    return [*points, points[0]]


def case(seed):
    rng = random.Random(seed)
    shapes = {}
    for site in range(25):
        radius = rng.choice([0.02, 0.3, 0.5, 4.0, 60.0])
        cx, cy = rng.uniform(-5, 5), rng.uniform(-5, 5)
        rings = [star(rng, cx, cy, radius, rng.randint(3, 12))]
        if rng.random() < 0.3:
            rings.append(star(rng, cx, cy, radius * 0.2, 5))
        shapes[site] = rings
    points = [(i, round(rng.uniform(-6, 6), 2), round(rng.uniform(-6, 6), 2)) for i in range(400)]
    points += [(400 + i, *rng.choice(rng.choice(shapes[s]))) for i, s in enumerate(shapes)]
    points += [(1000 + i, 0.25 + i / 1e4, 0.25) for i in range(200)]
    return shapes, points


def frames(spark, shapes, points):
    text = [(s, '{"type":"Polygon","coordinates":%s}' % [[list(p) for p in ring] for ring in rings]) for s, rings in shapes.items()]
    return spark.createDataFrame(text, "site_id long, polygon string"), spark.createDataFrame(points, "addr_id long, lon double, lat double")


@pytest.mark.parametrize("seed,min_work", [(1, 4_000_000), (2, 1), (3, 50), (4, 1)])
def test_equals_brute_force(spark, seed, min_work):
    shapes, points = case(seed)
    sites, addresses = frames(spark, shapes, points)
    got = sorted(map(tuple, geofence(sites, addresses, min_work=min_work).collect()))
    want = sorted((s, a) for s, rings in shapes.items() for a, x, y in points if inside(rings, x, y))
    assert got == want


def test_partitioning_does_not_matter(spark):
    shapes, points = case(9)
    sites, addresses = frames(spark, shapes, points)
    one = sorted(map(tuple, geofence(sites.coalesce(1), addresses.coalesce(1)).collect()))
    many = sorted(map(tuple, geofence(sites.repartition(7), addresses.repartition(5)).collect()))
    assert one == many


def test_null_and_empty_polygons_drop_out(spark):
    sites = spark.createDataFrame([(1, None), (2, "not json"), (3, '{"type":"Polygon","coordinates":[]}')], "site_id long, polygon string")
    addresses = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 0.0)], "addr_id long, lon double, lat double")
    assert geofence(sites, addresses).collect() == []


def test_cells_of_a_polygon_are_bounded(spark):
    rng = random.Random(5)
    shapes = {i: [star(rng, 0.0, 0.0, 10.0**i, 9)] for i in range(-1, 6)}
    sites, _ = frames(spark, shapes, [(0, 0.0, 0.0)])
    assert polygon_cells(sites, ["site_id"], "polygon").groupBy("site_id").count().agg(F.max("count")).first()[0] <= 100


def test_plan_has_no_theta_join(spark):
    shapes, points = case(3)
    sites, addresses = frames(spark, shapes, points)
    plan = geofence(sites, addresses)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_boundary_by_speed_and_bad_coordinates(spark):
    sites = spark.createDataFrame([(1, "0", "60"), (2, "n/a", "1"), (3, None, "1")], "site_id long, x string, y string")
    rows = {r.site_id: r for r in travel_boundary(sites, minutes=6.0, mph=69.0, text=False).withColumns(geometry.polygon_box("polygon")).collect()}
    assert rows[1].max_y == pytest.approx(60 + 0.1 / math.cos(math.pi / 8)) and rows[1].max_x == pytest.approx(0.2 / math.cos(math.pi / 8))
    assert rows[2].polygon is None and rows[3].polygon is None
    text = travel_boundary(sites, minutes=6.0, mph=69.0)
    assert text.where("polygon IS NULL").count() == 2


def test_boundary_holds_the_reach(spark):
    """Every point within the reach is inside, in every direction."""
    sites = spark.createDataFrame([(1, 10.0, 40.0)], "site_id long, x double, y double")
    reach = 69.0 * 6 / 60 / 69.0
    points = []
    for n in range(360):
        dx, dy = math.cos(math.radians(n)) * reach * 0.999, math.sin(math.radians(n)) * reach * 0.999
        points.append((n, 10.0 + dx / math.cos(math.radians(40.0)), 40.0 + dy))
    addresses = spark.createDataFrame(points, "addr_id long, lon double, lat double")
    assert geofence(travel_boundary(sites, minutes=6.0, mph=69.0, text=False), addresses).count() == 360


def test_fence_sizes(spark):
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "site_id long, addr_id long")
    assert {tuple(r) for r in fence_sizes(bridge).collect()} == {(1, 2), (2, 1)}
