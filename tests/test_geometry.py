import json

import pytest
from pyspark.sql import functions as F

from sitescore.functions import geometry

SQUARE = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
U_SHAPE = [[0, 0], [3, 0], [3, 3], [2, 3], [2, 1], [1, 1], [1, 3], [0, 3], [0, 0]]
BIG = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
HOLE = [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]
FAR = [[20, 0], [21, 0], [21, 1], [20, 1], [20, 0]]


def polygon(*rings):
    return json.dumps({"type": "Polygon", "coordinates": list(rings)})


MULTI = json.dumps({"type": "MultiPolygon", "coordinates": [[BIG, HOLE], [FAR]]})
FEATURE = json.dumps({"type": "Feature", "properties": {}, "geometry": json.loads(polygon(SQUARE))})

CASES = [
    (polygon(SQUARE), 0.5, 0.5, True),
    (polygon(SQUARE), 0.0, 0.5, True),
    (polygon(SQUARE), 1.0, 0.25, True),
    (polygon(SQUARE), 0.5, 1.0, True),
    (polygon(SQUARE), 1.0, 1.0, True),
    (polygon(SQUARE), 0.0, 0.0, True),
    (polygon(SQUARE), 1.0000001, 0.5, False),
    (polygon(SQUARE), -1.0, 0.0, False),
    (polygon(SQUARE), 2.0, 1.0, False),
    (polygon(SQUARE[::-1]), 0.5, 0.5, True),
    (polygon(U_SHAPE), 0.5, 2.0, True),
    (polygon(U_SHAPE), 1.5, 2.0, False),
    (polygon(U_SHAPE), 1.5, 1.0, True),
    (polygon(U_SHAPE), 1.5, 0.5, True),
    (polygon(U_SHAPE), 1.5, 3.0, False),
    (polygon(BIG, HOLE), 5.0, 5.0, False),
    (polygon(BIG, HOLE), 4.0, 5.0, True),
    (polygon(BIG, HOLE), 3.0, 4.0, True),
    (MULTI, 20.5, 0.5, True),
    (MULTI, 15.0, 0.5, False),
    (MULTI, 5.0, 5.0, False),
    (MULTI, 1.0, 1.0, True),
    (FEATURE, 0.5, 0.5, True),
]


def test_points_in_polygons(spark):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "i int, g string, x double, y double, want boolean")
    df = df.withColumn("parts", geometry.polygon_from_geojson("g")).withColumn("edges", geometry.polygon_edges("parts"))
    wrong = df.where(F.col("want") != geometry.covers("edges", "x", "y")).select("g", "x", "y", "want").collect()
    assert wrong == []


@pytest.mark.parametrize("text", ["", "{", "[]", '{"type":"Point","coordinates":[1,2]}', '{"type":"Polygon"}', '{"type":"Polygon","coordinates":7}'])
def test_other_text_covers_nothing(spark, text):
    df = spark.createDataFrame([(text,)], "g string").withColumn("parts", geometry.polygon_from_geojson("g"))
    row = df.select(F.coalesce(F.size("parts"), F.lit(-1)).alias("n")).first()
    assert row.n <= 0


def test_geojson_roundtrip(spark):
    texts = [polygon(SQUARE), polygon(BIG, HOLE), MULTI]
    df = spark.createDataFrame([(t,) for t in texts], "g string").withColumn("parts", geometry.polygon_from_geojson("g"))
    back = [json.loads(r[0]) for r in df.select(geometry.polygon_to_geojson("parts")).collect()]
    assert back == [json.loads(t) for t in texts]
