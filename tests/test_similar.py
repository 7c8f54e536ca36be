"""Edit-distance join against all pairs, and parsed geocoding tier by tier."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sitescore.functions.text import parse_address
from sitescore.operators import similar
from sitescore.operators.geocode import geocode_parsed


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_all_pairs(spark, edits):
    rng = random.Random(edits)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(0, 9)))
    left = [(n, rng.choice("xy"), word()) for n in range(150)] + [(900, "x", None), (901, None, "ab")]
    right = [(n, rng.choice("xyz"), word()) for n in range(150)] + [(900, "x", None), (901, None, "ab")]
    a, b = spark.createDataFrame(left, "l long, block string, lt string"), spark.createDataFrame(right, "r long, block string, rt string")
    got = similar.similar_pairs(a, b, ["block"], "lt", "rt", edits).select("l", "r", "__edits").distinct().collect()
    want = {(i, j, distance(s, t)) for i, p, s in left for j, q, t in right if None not in (p, q, s, t) and p == q and distance(s, t) <= edits}
    assert {tuple(r) for r in got} == want and len(want) > 50


def test_rows_of_a_text(spark):
    """A known text gives one row for each segment, a question a few for each length."""
    rng = random.Random(9)
    texts = ["".join(rng.choice("ABCDEFGHIJ 0123") for _ in range(rng.randint(6, 40))) for _ in range(200)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    most = frame.select(F.size(similar.segments("t", 2)).alias("known"), F.size(similar.probes("t", 2)).alias("asked")).agg(F.max("known"), F.max("asked")).first()
    assert most[0] == 3 and most[1] <= 30


def test_parse(spark):
    lines = {
        " 12  main Street ": (12, "MAIN ST", None),
        "12 Main Street, Apt. 4b": (12, "MAIN ST", "4B"),
        "12 main st #7": (12, "MAIN ST", "7"),
        "Main Road": (None, "MAIN RD", None),
        "12": (12, None, None),
        "12b main st": (None, "12B MAIN ST", None),
        "99999999999999999999 main st": (None, "99999999999999999999 MAIN ST", None),
        "": (None, None, None),
        None: (None, None, None),
        "12 Suite Lane": (12, None, "LANE"),
    }
    rows = spark.createDataFrame([(t,) for t in lines], "t string").select("t", parse_address(F.col("t")).alias("p")).collect()
    assert {r.t: tuple(r.p) for r in rows} == lines


FABRIC = [
    (1, "10", "10 MAIN ST", 0.0, 0.0),
    (2, "10", "20 MAIN ST", 10.0, 5.0),
    (3, "10", "20 MAIN ST APT 2", 10.5, 5.5),
    (4, "10", "20 MAIN ST", 11.0, 5.0),
    (5, "10", "5 MAPLE AVE", 3.0, 3.0),
    (6, "20", "4 MAIN ST", 50.0, 50.0),
    (7, "10", "OLD MILL", 1.0, 1.0),
    (8, None, "9 MAIN ST", 1.0, 1.0),
]
#: Question: tier, id and place.
QUESTIONS = {
    ("10 main street", "10"): ("exact", 1, 0.0, 0.0),
    ("20 Main St", "10"): ("exact", 2, 10.0, 5.0),
    ("20 Main St apt 2", "10"): ("exact", 3, 10.5, 5.5),
    ("20 Main St apt 9", "10"): ("exact", 2, 10.0, 5.0),
    ("10 mian st", "10"): ("spelling", 1, 0.0, 0.0),
    ("15 main st", "10"): ("interpolated", None, 5.0, 2.5),
    ("12 mainn st", "10"): ("interpolated", None, 2.0, 1.0),
    ("4 main st", "10"): ("street", None, 0.0, 0.0),
    ("90 main st", "10"): ("street", None, 10.0, 5.0),
    ("4 main st", "20"): ("exact", 6, 50.0, 50.0),
    ("4 nowhere lane", "20"): ("postcode", None, 50.0, 50.0),
    ("old mill", "20"): ("postcode", None, 50.0, 50.0),
    ("7", "20"): ("postcode", None, 50.0, 50.0),
    ("10 main st", "30"): None,
    ("10 main st", None): None,
    (None, "10"): None,
    ("  ", "10"): None,
}


def test_tiers(spark):
    fabric = spark.createDataFrame(FABRIC, "addr_id long, zipcode string, address_line string, lon double, lat double")
    asked = [(n, a, z, "x") for n, (a, z) in enumerate(QUESTIONS)] * 2
    frame = spark.createDataFrame(asked, "n long, address string, zipcode string, street string").repartition(3)
    every = geocode_parsed(frame, fabric, keep_unmatched=True)
    assert every.columns == [*frame.columns, "geocode_result"]
    rows = every.collect()
    assert len(rows) == len(asked)
    for r in rows:
        want, got = QUESTIONS[r.address, r.zipcode], r.geocode_result
        if want is None:
            assert got.error == "no match" and got.addr_id is None and got.x is None
        else:
            assert (got.precision, got.addr_id, got.x, got.y) == want and got.error is None, r
            assert (got.formatted_address is None) == (got.addr_id is None)
    assert geocode_parsed(frame, fabric).count() == 2 * sum(v is not None for v in QUESTIONS.values())
    assert geocode_parsed(frame, fabric.limit(0)).count() == 0 and geocode_parsed(frame.limit(0), fabric).count() == 0
