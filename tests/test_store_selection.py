"""The plan that trains on fenced stores and ranks listings."""

import pytest
from pyspark.sql import functions as F

from registry import queries
from sitescore.sources.location_views import LocationTables

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return LocationTables(spark, FOLDER)


@pytest.fixture(scope="module")
def trained(tables):
    return queries.selection(tables).train(queries.training_sites(tables), tables["reviews"])


def test_stores_are_trained_on_their_own_fence(trained, tables):
    rows = trained.labelled.collect()
    stores = {r.site_id for r in queries.training_sites(tables).collect()}
    assert len(rows) == len({r.site_id for r in rows}) > 20 and {r.site_id for r in rows} <= stores
    assert 0 < sum(r.in_test for r in rows) < len(rows)
    seen = [r.stars for r in rows if not r.in_test]
    assert (trained.lowest, trained.highest) == (min(seen), max(seen))
    assert trained.held_out.first().rmse > 0


def test_ranking(trained, tables):
    plan = queries.selection(tables)
    listings = tables["listings"]
    sites = plan.locate(listings)
    ranked = plan.rank(trained, sites).collect()
    places = {r.site_id: (r.formatted_address, r.x, r.y) for r in sites.collect()}
    assert len(ranked) > 20 and len({r.site_id for r in ranked}) == len(ranked)
    assert all((r.formatted_address, r.x, r.y) == places[r.site_id] for r in ranked)
    scores = [r.score for r in ranked if r.score is not None]
    assert scores == sorted(scores, reverse=True)
    assert all(trained.lowest <= r.stars_score <= trained.highest for r in ranked)
    # the prediction stays with its key whatever the order and partitioning of the listings
    again = plan.rank(trained, plan.locate(listings.orderBy(F.desc("listing_id")).repartition(5))).collect()
    assert [(r.site_id, r.score) for r in again] == [(r.site_id, r.score) for r in ranked]


def test_listings_without_an_address(trained, tables):
    plan = queries.selection(tables)
    nowhere = tables["listings"].withColumn("address", F.lit("nowhere at all"))
    assert plan.rank(trained, plan.locate(nowhere)).count() == 0


def test_nothing_to_learn_from(tables):
    plan = queries.selection(tables)
    with pytest.raises(ValueError):
        plan.train(queries.training_sites(tables), tables["reviews"].limit(0))
