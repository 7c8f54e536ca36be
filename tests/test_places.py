"""Geocoding, roads and streaming against brute force."""

import heapq
import random

import pytest
from sitescore.functions.text import normalise_address
from sitescore.operators.geocode import geocode
from sitescore.operators.geofence import geofence, travel_boundary
from sitescore.operators.reach import network_reach, route_cost
from sitescore.streaming.incremental import geofence_incremental


def test_normalised_lines(spark):
    lines = [("  12  main   street ", "12 MAIN ST"), ("12 Main St.", "12 MAIN ST"), ("1 Street Rd", "1 STREET RD"), ("street", "ST"), ("   ", None), (None, None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(lines)], "i int, a string")
    got = [r[0] for r in df.orderBy("i").select(normalise_address(df["a"])).collect()]
    assert got == [want for _, want in lines]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


@pytest.mark.parametrize("max_edits", [1, 2])
def test_fuzzy_match_equals_brute_force(spark, max_edits):
    rng = random.Random(max_edits)

    def word(n):
        return "".join(rng.choice("ABC") for _ in range(n))

    known = [(i, f"{rng.randint(1, 30)} {word(rng.randint(1, 6))} ST", rng.randint(1, 3), float(i), 0.0) for i in range(300)]
    asked = [(i, f"{rng.randint(1, 30)} {word(rng.randint(1, 6))} ST", rng.randint(1, 4)) for i in range(120)]
    asked += [(1000 + i, "1 A ST", 1) for i in range(50)] + [(2000, None, 1), (2001, "A", 1)]
    fabric = spark.createDataFrame(known, "addr_id long, address_line string, zipcode long, lon double, lat double")
    listings = spark.createDataFrame(asked, "listing_id long, address string, zipcode long")
    rows = geocode(listings, fabric, fuzzy=True, max_edits=max_edits, keep_unmatched=True).collect()
    got = {r.listing_id: (r.geocode_result.addr_id, r.geocode_result.precision, r.geocode_result.error) for r in rows}
    assert len(rows) == len(asked)
    for listing, line, zipcode in asked:
        near = [] if line is None else sorted((edits(line, k[1]), k[0]) for k in known if k[2] == zipcode)
        if near and near[0][0] <= max_edits:
            best = near[0]
            assert got[listing] == (best[1], "exact" if best[0] == 0 else "spelling", None)
        else:
            assert got[listing] == (None, None, "no match")


def test_geocoding_without_a_block_column(spark):
    fabric = spark.createDataFrame([(7, "1 A ST", 1, 0.0, 0.0), (3, "1 A STREET", 2, 1.0, 1.0)], "addr_id long, address_line string, zipcode long, lon double, lat double")
    listings = spark.createDataFrame([(1, "1 a street", 9), (2, "zzz", 9)], "listing_id long, address string, zipcode long")
    assert [(r.listing_id, r.geocode_result.addr_id) for r in geocode(listings, fabric, block=None).collect()] == [(1, 3)]


def roads(seed, nodes=40, count=160):
    rng = random.Random(seed)
    return [(rng.randrange(nodes), rng.randrange(nodes), rng.choice([0.25, 0.5, 1.0, 2.0]), rng.choice([1.0, 2.0, 3.0])) for _ in range(count)]


def dijkstra(edges, start, budget):
    best, queue = {}, [((0.0, 0.0), start)]
    while queue:
        cost, node = heapq.heappop(queue)
        if node in best:
            continue
        best[node] = cost
        for a, b, minutes, miles in edges:
            if a == node and cost[0] + minutes <= budget:
                heapq.heappush(queue, ((cost[0] + minutes, cost[1] + miles), b))
    return best


def test_reach_and_routes_equal_dijkstra(spark):
    edges = roads(3)
    road = spark.createDataFrame(edges, "src long, dst long, minutes double, miles double")
    sites = spark.createDataFrame([(100 + i, i * 3) for i in range(6)] + [(200, 0), (201, None)], "site_id long, node long")
    got = {(r.site_id, r.node): r.minutes for r in network_reach(sites, road, 3.0).collect()}
    want = {(s, n): c[0] for s, start in [(100 + i, i * 3) for i in range(6)] + [(200, 0)] for n, c in dijkstra(edges, start, 3.0).items()}
    assert got == want

    pairs = [(a, b) for a in (0, 3, 6) for b in range(40)]
    costs = route_cost(spark.createDataFrame(pairs, "from_node long, to_node long"), road, 3.0).collect()
    found = {(r.from_node, r.to_node): (r.route.minutes, r.route.distance) if r.route else None for r in costs}
    assert found == {(a, b): dijkstra(edges, a, 3.0).get(b) for a, b in pairs}


def test_off_road_tail(spark):
    road = spark.createDataFrame([(1, 2, 1.0, 1.0)], "src long, dst long, minutes double, miles double")
    sites = spark.createDataFrame([(9, 1)], "site_id long, node long")
    ways = spark.createDataFrame([(2, 50, 0.05), (2, 51, 0.2), (1, 50, 0.1), (1, 52, 0.1)], "node long, addr_id long, miles double")
    got = {r.addr_id: round(r.minutes, 6) for r in network_reach(sites, road, 2.4, ways).collect()}
    assert got == {50: 2.2, 52: 2.4}


def test_edges_need_travel_time(spark):
    road = spark.createDataFrame([(1, 2, 0.0, 1.0)], "src long, dst long, minutes double, miles double")
    with pytest.raises(Exception, match="edge without travel time"):
        network_reach(spark.createDataFrame([(9, 1)], "site_id long, node long"), road, 2.0)


def test_stream_equals_batch_and_takes_each_file_once(spark, tmp_path):
    rng = random.Random(1)
    sites = spark.createDataFrame([(i, rng.uniform(0, 1), rng.uniform(0, 1)) for i in range(30)], "site_id long, x double, y double")
    fabric = spark.createDataFrame([(i, rng.uniform(0, 1), rng.uniform(0, 1)) for i in range(500)], "addr_id long, lon double, lat double").cache()
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def polygons(df):
        return travel_boundary(df, radius=0.1)

    def run():
        geofence_incremental(spark, folder, sites.schema, fabric, out, checkpoint, polygons, files_per_batch=1).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(out).select("site_id", "addr_id").collect())

    def batch(df):
        return sorted(map(tuple, geofence(polygons(df), fabric).collect()))

    sites.where("site_id < 12").coalesce(1).write.mode("append").parquet(folder)
    assert run() == batch(sites.where("site_id < 12"))
    sites.where("site_id >= 12").coalesce(2).write.mode("append").parquet(folder)
    assert run() == batch(sites)
    assert run() == batch(sites)
