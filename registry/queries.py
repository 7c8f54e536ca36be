"""One query per operator, over the location tables of a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescore.functions import geometry, measures
from sitescore.ml import models
from sitescore.operators import columns, enrich, features, geocode, geofence, outline, quality, rank, reach, sampling
from sitescore.operators.balance import FIND, hot_keys
from sitescore.operators.enrich import FeatureSource
from sitescore.plans import site_selection, tuning
from sitescore.plans.store_selection import StoreSelection
from sitescore.session import cut_lineage, scratch_path
from sitescore.sources import tables
from sitescore.sources.location_views import LocationTables
from sitescore.streaming.incremental import geofence_incremental

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

RADIUS = 0.03
HOLE_RADIUS = 0.01
REACH = 0.03125
BRAND = "Brand#2"
GROUP = "ECONOMY"
EXTRA_SPEND = ["ce_urgent", "ce_high"]
SHRINK = [0.0, 0.25, 0.5, 0.75, 1.0]
BUDGET = 5.0


def query(function: Callable[[LocationTables], DataFrame]) -> Callable[[LocationTables], DataFrame]:
    """Register under the function's name; doubles are rounded as in the SQL twins."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(function(LocationTables(spark, folder)))

    QUERIES[function.__name__] = run
    return function


def _rounded(df: DataFrame) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in doubles})


# -- shared inputs -----------------------------------------------------------


def training_sites(t: LocationTables) -> DataFrame:
    return t["sites"].where(~F.col("is_candidate"))


def candidate_sites(t: LocationTables) -> DataFrame:
    return t["sites"].where(F.col("is_candidate"))


def bridge(t: LocationTables) -> DataFrame:
    """The bridge as a written table: every use of it reads it more than once."""
    if not hasattr(t, "written_bridge"):
        t.written_bridge = cut_lineage(t["geofence_bridge"])
    return t.written_bridge


def bridge_of(t: LocationTables, sites: DataFrame) -> DataFrame:
    return columns.keep_keys(t["geofence_bridge"], sites, "site_id")


def sources(t: LocationTables) -> dict[str, FeatureSource]:
    def census(prefix: str) -> dict[str, str]:
        return {"popby": f"{prefix}_popby", **{f"pop_f{i}": f"{prefix}_f{i}" for i in range(1, 8)}}

    every = [
        FeatureSource("audience", t["audience"], on=("geoid", "code"), drop=("source_file",), one_row_per_key=True),
        FeatureSource("spend", t["consumer_spend"], one_row_per_key=True),
        FeatureSource("family", t["population"], other_keys=("code",), rename=census("fam"), one_row_per_key=True),
        FeatureSource("income", t["population"], other_keys=("code",), rename=census("inc"), one_row_per_key=True),
        FeatureSource("population", t["population"], other_keys=("code",), one_row_per_key=True),
    ]
    return {s.name: s for s in every}


def chosen_columns(t: LocationTables) -> dict[str, list[str]]:
    """Sampled columns per source; the spend columns of interest always stay."""
    chosen = features.sample_columns(list(sources(t).values()))
    chosen["spend"] = sorted({*chosen["spend"], *EXTRA_SPEND})
    return chosen


def frequent(t: LocationTables) -> DataFrame | None:
    """The bridge's hot addresses, found once for all its joins."""
    if not hasattr(t, "hot_addresses"):
        t.hot_addresses = hot_keys(bridge(t), None, ["addr_id"])
    return t.hot_addresses


def homes(t: LocationTables) -> DataFrame:
    return enrich.resolve_addresses(bridge(t), t["address_fabric"], "R", hot=frequent(t))


def enriched(t: LocationTables, name: str, keep_key_as: str | None = None) -> DataFrame:
    source = sources(t)[name]
    hot = frequent(t) if source.on[0] == "addr_id" else FIND
    return enrich.enrich(homes(t), source, keep_key_as=keep_key_as, hot=hot)


def site_features(t: LocationTables) -> site_selection.SiteFeatures:
    s = sources(t)
    return site_selection.SiteFeatures(
        t["address_fabric"], t["poi"], [s["population"], s["spend"], s["audience"]], chosen_columns(t), "population", BRAND, GROUP
    )


def totals(t: LocationTables) -> DataFrame:
    return features.business_totals(bridge(t), t["address_fabric"], t["poi"], BRAND, GROUP)


def routed(t: LocationTables) -> DataFrame:
    return geofence.travel_boundary(t["sites"], radius=RADIUS)


def scores(t: LocationTables) -> DataFrame:
    return t["reviews"].select("site_id", F.col("stars").alias("stars_score")).join(t["sites"].select("site_id"), on="site_id")


def labelled(t: LocationTables) -> DataFrame:
    return t["reviews"].join(t["sites"].select("site_id", "batch_id"), on="site_id")


def baseline(t: LocationTables) -> DataFrame:
    """Labels with the mean of their batch as prediction."""
    rows = labelled(t)
    means = rows.groupBy("batch_id").agg(F.avg("stars").alias("prediction"))
    return rows.join(means, on="batch_id").select("site_id", "stars", "prediction")


# -- sources and sinks -------------------------------------------------------


@query
def scan_sites(t):
    return t["sites"]


@query
def select_sites(t):
    return tables.select_sites(t["sites"], ["site_id", "name", "x", "y"], name_like="%Supplier%", constants={"country": "USA"})


@query
def csv_roundtrip(t):
    path = scratch_path(t.spark, "listings-csv")
    listings = t["listings"]
    tables.write_listings_csv(listings, path)
    return tables.read_listings_csv(t.spark, path, listings.schema)


@query
def param_grid(t):
    grid = models.param_grid(t.spark, n_estimators=[20, 51], max_samples=[0.25, 0.5, 0.75], bootstrap=[True])
    return models.with_sample_rows(grid, columns.keep_keys(t["reviews"], training_sites(t), "site_id"))


@query
def forest_grid(t):
    return models.with_sample_rows(models.forest_grid(t.spark), columns.keep_keys(t["reviews"], training_sites(t), "site_id"))


@query
def table_roundtrip(t):
    name = f"sites_{uuid.uuid4().hex}"
    path = scratch_path(t.spark, "sites-table")
    tables.write_table(t["sites"].select("site_id"), name, path)
    return tables.write_table(t["sites"], name, path)


@query
def append_evolving(t):
    path = scratch_path(t.spark, "evolving")
    tables.append_evolving(training_sites(t).select("site_id", "x", "y"), path)
    tables.append_evolving(t["sites"].where(F.lit(False)), path)
    tables.append_evolving(candidate_sites(t).select("site_id", "x", "y", "price"), path)
    return tables.read_evolving(t.spark, path)


@query
def view_query(t):
    name = f"fabric_{uuid.uuid4().hex}"
    tables.as_view(t["address_fabric"], name)
    return t.spark.sql(f"SELECT zipcode, count(*) AS n_addresses, min(addr_id) AS first_addr FROM {name} GROUP BY zipcode")


@query
def batched_geofence(t):
    steps = {
        "routed": lambda sites: geofence.travel_boundary(sites, radius=RADIUS),
        "fenced": lambda sites: geofence.geofence(sites, t["address_fabric"]),
    }
    out = tables.run_in_batches(t["sites"], steps, scratch_path(t.spark, "batches"))
    return t.spark.read.parquet(out["fenced"]).select("site_id", "addr_id", F.col("batch_id").cast("bigint").alias("batch_id"))


@query
def resumed_geofence(t):
    """The same batches in one job for each step, in two runs: first a few of them, then the others."""
    steps = {
        "routed": lambda sites: geofence.travel_boundary(sites, radius=RADIUS),
        "fenced": lambda sites: geofence.geofence(sites, t["address_fabric"], keep=("site_id", "batch_id")),
    }
    folder = scratch_path(t.spark, "open-batches")
    tables.run_open_batches(t["sites"].where("batch_id < 5"), steps, folder)
    out = tables.run_open_batches(t["sites"], steps, folder)
    fenced = t.spark.read.schema("site_id bigint, addr_id bigint, batch_id bigint").parquet(out["fenced"])
    return fenced.select("site_id", "addr_id", "batch_id")


@query
def batch_join(t):
    return tables.with_batch(t["geofence_bridge"].distinct(), t["sites"])


@query
def run_log(t):
    path = scratch_path(t.spark, "run-log")
    rows = baseline(t)
    for run_id, shift in enumerate((0.0, 0.5)):
        shifted = rows.withColumn("prediction", F.col("prediction") + shift)
        one = models.metrics(shifted)
        run = one.select(
            F.lit("baseline").alias("search_id"),
            F.lit(run_id).alias("run_id"),
            F.lit("finished").alias("status"),
            F.create_map(F.lit("shift"), F.lit(str(shift))).alias("params"),
            F.create_map(*[c for m in ("rmse", "mape", "mae") for c in (F.lit(m), F.col(m))]).alias("metrics"),
        )
        models.log_runs(run, path)
    log = t.spark.read.parquet(path)
    return log.select("run_id", F.col("params")["shift"].alias("shift"), *[F.col("metrics")[m].alias(m) for m in ("rmse", "mape", "mae")])


@query
def table_count(t):
    return quality.table_counts(
        sites=t["sites"], address_fabric=t["address_fabric"], geofence_bridge=t["geofence_bridge"], poi=t["poi"], reviews=t["reviews"]
    )


# -- projections, filters, null rules ----------------------------------------


@query
def project_keys(t):
    return columns.project(enriched(t, "population"), ["site_id", "addr_id", "geoid", "code"], chosen_columns(t)["population"])


@query
def constant_country(t):
    return columns.with_constants(t["listings"], country="USA")


@query
def source_clean(t):
    return sources(t)["family"].clean()


@query
def source_drop(t):
    return FeatureSource("audience", t["audience"], drop=("source_file", "no_such_column")).clean()


@query
def struct_expand(t):
    packed = t["address_fabric"].select("addr_id", F.struct("lon", "lat", "zipcode").alias("place"))
    return columns.expand(packed, "place")


@query
def address_map(t):
    request = columns.request_map(address=F.col("address"), zipcode=F.col("zipcode"), country=F.lit("USA"))
    asked = t["listings"].select("listing_id", request.alias("request"))
    return asked.select("listing_id", F.explode("request").alias("field", "content"))


@query
def brand_sites(t):
    return t["poi"].where(F.col("business_line").like("%widget%"))


@query
def geocoded_only(t):
    coded = geocode.geocode(t["listings"], t["address_fabric"], keep_unmatched=True)
    return columns.keep_not_null(columns.expand(coded, "geocode_result"), ["addr_id"]).select("listing_id", "addr_id", "x", "y")


@query
def split_property(t):
    res, bus = enrich.split_property(bridge(t), t["address_fabric"])
    return res.unionByName(bus)


@query
def related_pois(t):
    return t["poi"].where(F.col("group_name") == GROUP)


@query
def brand_pois(t):
    return t["poi"].where(F.col("brandname") == BRAND).distinct()


@query
def keep_common(t):
    known = columns.keep_keys(t["reviews"], t["sites"], "site_id").withColumn("is_site", F.lit(True))
    unknown = columns.reject_keys(t["reviews"], t["sites"], "site_id").withColumn("is_site", F.lit(False))
    return known.unionByName(unknown)


@query
def dropna_subset(t):
    return columns.keep_not_null(t["poi"], ["sales_volume_local"])


@query
def fill_zero(t):
    return columns.NullPolicy("zero").apply(t["poi"])


@query
def drop_null_columns(t):
    return columns.NullPolicy("drop_columns").fit(t["poi"]).apply(t["poi"])


@query
def cast_xy(t):
    text = t["sites"].select(
        "site_id",
        F.when(F.col("price") < 1000, F.lit("n/a")).otherwise(F.col("x").cast("string")).alias("x"),
        F.col("y").cast("string").alias("y"),
    )
    return columns.cast_numbers(text, ["x", "y"])


@query
def feature_list(t):
    return quality.column_profile(enriched(t, "population"), ["site_id", "prop_type", "addr_id", "zipcode", "geoid", "code"])


@query
def sampled_features(t):
    s, chosen = sources(t), chosen_columns(t)
    return enrich.address_profile(t["address_fabric"].select("addr_id", "geoid"), list(s.values()), chosen)


@query
def feature_lineage(t):
    return features.feature_lineage(list(sources(t).values()))


@query
def dup_columns(t):
    left, right = homes(t), t["population"]
    return quality.duplicate_columns(left.join(right, left["addr_id"] == right["addr_id"], "left"))


@query
def poi_catalogue(t):
    return t["poi"].select("brandname", "business_line", "group_name").distinct()


@query
def prop_types(t):
    return quality.distinct_values(t["address_fabric"], "prop_type")


# -- joins -------------------------------------------------------------------


@query
def join_left_property(t):
    return enrich.with_property_type(bridge(t), t["address_fabric"])


@query
def join_left_spend(t):
    return enriched(t, "spend")


@query
def join_left_population(t):
    return enriched(t, "population")


@query
def join_left_audience(t):
    return enriched(t, "audience", "ap_code")


@query
def join_left_family(t):
    return enriched(t, "family", "family_addr_id")


@query
def join_left_income(t):
    return enriched(t, "income", "income_addr_id")


@query
def residential_addresses(t):
    return enrich.resolve_addresses(bridge(t), t["address_fabric"])


@query
def join_inner_poi(t):
    shops = t["address_fabric"].where(F.col("prop_type") == "B").select("addr_id", "zipcode")
    points = t["poi"].join(shops, on="addr_id")
    return enrich.balanced_join(bridge(t), points, "addr_id")


@query
def join_inner_labels(t):
    return features.with_labels(site_features(t).business(bridge(t)), t["reviews"])


@query
def assemble_features(t):
    population = enriched(t, "population")
    audience = enriched(t, "audience")
    return features.assemble(
        features.proximity_stats(population, "site_id", ["popby"], ["avg", "max"]),
        features.proximity_stats(audience, "site_id", ["ap_f1"], ["avg", "median"]),
        features.census_blocks(population),
    )


@query
def key_diff(t):
    return quality.key_diff(t["reviews"], t["sites"], "site_id", "reviews", "sites")


@query
def training_matrix(t):
    return site_features(t).matrix(bridge_of(t, training_sites(t)), t["reviews"])


@query
def ranked_with_attributes(t):
    return rank.with_attributes(scores(t), t["sites"].select("site_id", "name", "price", "size_sqft"), "stars_score")


@query
def winners(t):
    return rank.winners(scores(t), t["sites"], "stars_score", ["name", "x", "y", "price"])


@query
def geofence_octagon(t):
    return geofence.geofence(geofence.travel_boundary(t["sites"], radius=RADIUS, text=False), t["address_fabric"])


@query
def geofence_geojson(t):
    """An octagon with a hole, and a square beside it, as MultiPolygon text."""
    octagon = geometry.octagon_ring("x", "y", f"{RADIUS}D")
    hole = geometry.octagon_ring("x", "y", f"{HOLE_RADIUS}D")
    square = geometry.ring("x", "y", [("0.04D", "0D"), ("0.06D", "0D"), ("0.06D", "0.02D"), ("0.04D", "0.02D"), ("0.04D", "0D")])
    shapes = t["sites"].select("site_id", F.expr(f"array(array({octagon}, {hole}), array({square}))").alias("parts"))
    text = shapes.select("site_id", geometry.polygon_to_geojson("parts").alias("polygon"))
    return geofence.geofence(text, t["address_fabric"])


# -- aggregations ------------------------------------------------------------


@query
def locs_in_fence(t):
    return geofence.fence_sizes(geofence.geofence(routed(t), t["address_fabric"]))


@query
def property_counts(t):
    return enrich.property_counts(enrich.with_property_type(bridge(t), t["address_fabric"]))


@query
def census_blocks(t):
    return features.census_blocks(enriched(t, "population"))


def _stats(t, name, statistics):
    return features.proximity_stats(enriched(t, name), "site_id", chosen_columns(t)[name], statistics)


@query
def stats_population(t):
    return _stats(t, "population", ["avg", "stddev", "min", "max"])


@query
def stats_spend(t):
    return _stats(t, "spend", ["avg", "stddev", "min", "max"])


@query
def stats_audience(t):
    return _stats(t, "audience", ["avg", "stddev", "min", "max"])


@query
def median_population(t):
    return _stats(t, "population", ["median"])


@query
def median_spend(t):
    return _stats(t, "spend", ["median"])


@query
def median_audience(t):
    return _stats(t, "audience", ["median"])


@query
def related_count(t):
    return totals(t).where(F.col("n_related") > 0).select("site_id", F.col("n_related").alias("related_businesses_count"))


@query
def all_business_count(t):
    return totals(t).select("site_id", F.col("n_all").alias("all_businesses_count"))


@query
def brand_count(t):
    return totals(t).where(F.col("n_brand") > 0).select("site_id", F.col("n_brand").alias("brand_count"))


def _related_average(t, measure):
    average = features.related_average(measure).alias(f"avg_{measure}")
    return totals(t).where(F.col("n_related") > 0).select("site_id", average)


@query
def avg_employee_here(t):
    return _related_average(t, "employee_here")


@query
def avg_employee_count(t):
    return _related_average(t, "employee_count")


@query
def avg_sales(t):
    return _related_average(t, "sales_volume_usd")


@query
def business_features(t):
    return site_features(t).business(bridge(t))


@query
def residential_features(t):
    return site_features(t).residential(bridge(t))


@query
def dedupe_rows(t):
    return t["geofence_bridge"].distinct()


@query
def dedupe_key(t):
    return columns.one_row_per_key(t["poi"], "addr_id")


@query
def min_max_scale(t):
    return rank.min_max(t["sites"].select("site_id", "price", "size_sqft"), ["price", "size_sqft"])


@query
def metric_mape(t):
    return baseline(t).agg(measures.mape(F.col("stars"), F.col("prediction")).alias("mape"))


@query
def metric_mae(t):
    return baseline(t).agg(measures.mae(F.col("stars"), F.col("prediction")).alias("mae"))


@query
def metric_rmse(t):
    return baseline(t).agg(measures.rmse(F.col("stars"), F.col("prediction")).alias("rmse"))


# -- sorts, samples, splits --------------------------------------------------


@query
def smallest_fences(t):
    return rank.rank(geofence.fence_sizes(t["geofence_bridge"]), "locs_in_fence", ascending=True)


@query
def ranked_sites(t):
    return rank.rank(scores(t), "stars_score")


@query
def top_sites(t):
    return rank.top_k(scores(t), "stars_score")


@query
def sample_hash(t):
    return sampling.sample_sites(t["sites"], 0.05).select("site_id", "name")


@query
def train_test_split(t):
    train, test = sampling.split(t["sites"].select("site_id"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# -- scores and geometry -----------------------------------------------------


@query
def combined_score(t):
    sales = features.local_sales(bridge(t), t["address_fabric"], t["poi"])
    rows = scores(t).join(t["sites"].select("site_id", "price", "size_sqft"), on="site_id", how="left")
    return rank.combined_score(rows.join(sales, on="site_id", how="left"))


def _vertices(df: DataFrame) -> DataFrame:
    corner = df.select("site_id", F.posexplode(geometry.polygon_from_geojson("polygon")[0][0]).alias("i", "p"))
    return corner.select("site_id", "i", F.col("p.x").alias("vx"), F.col("p.y").alias("vy"))


@query
def geojson_roundtrip(t):
    return _vertices(routed(t))


@query
def point_in_polygon(t):
    octagons = t["sites"].select("site_id", geometry.octagon("x", "y", f"{RADIUS}D").alias("parts"))
    shapes = octagons.select("site_id", geometry.polygon_edges("parts").alias("edges"))
    pairs = bridge(t).distinct()
    placed = enrich.balanced_join(pairs, t["address_fabric"].select("addr_id", "lon", "lat"), "addr_id", right_unique=True)
    rows = enrich.balanced_join(placed, shapes, "site_id", right_unique=True)
    return rows.select("site_id", "addr_id", geometry.covers("edges", "lon", "lat").alias("inside"))


# -- geocoding, boundaries, roads --------------------------------------------


def _geocoded(t, fuzzy):
    coded = geocode.geocode(t["listings"], t["address_fabric"], fuzzy=fuzzy, keep_unmatched=True)
    return columns.expand(coded.select("listing_id", "geocode_result"), "geocode_result")


@query
def geocode_exact(t):
    return _geocoded(t, False)


@query
def geocode_fuzzy(t):
    return _geocoded(t, True)


@query
def geocode_parsed(t):
    """Listings by number and street; of five, one asks for a number between the known ones and one for a number beyond."""
    words = F.regexp_extract(F.trim("address"), r"^[0-9]+(.*)$", 1)
    number = F.regexp_extract(F.trim("address"), "^([0-9]+)", 1).try_cast("bigint")
    step = F.element_at(F.lit([97, 1000000]), (F.col("listing_id") % 5 - 1).cast("int"))
    asked = t["listings"].withColumn("address", F.when((F.col("listing_id") % 5).isin(2, 3) & number.isNotNull(), F.concat((number + step).cast("string"), words)).otherwise(F.col("address")))
    coded = geocode.geocode_parsed(asked, t["address_fabric"], keep_unmatched=True)
    return columns.expand(coded.select("listing_id", "geocode_result"), "geocode_result")


@query
def travel_boundary(t):
    return _vertices(geofence.travel_boundary(t["sites"], minutes=5.0, mph=30.0))


def site_nodes(t: LocationTables) -> DataFrame:
    """Every site starts at one node of the road table."""
    return t["sites"].select("site_id", (F.col("site_id") * 3).alias("node"))


@query
def network_reach(t):
    return reach.network_reach(site_nodes(t), t["edges"], BUDGET, t["driveways"])


def road_nodes(t: LocationTables) -> DataFrame:
    """A node lies at the address of its number."""
    return t["address_fabric"].select(F.col("addr_id").alias("node"), F.col("lon").alias("x"), F.col("lat").alias("y"))


@query
def network_boundary(t):
    """Size and shape of every outline, measured on its GeoJSON text, in cells."""
    bounded = outline.network_boundary(site_nodes(t), t["edges"], road_nodes(t), BUDGET)
    shapes = bounded.where(F.col("polygon").isNotNull()).withColumn("parts", geometry.polygon_from_geojson("polygon"))
    edges = shapes.select("site_id", F.explode(F.flatten(geometry.polygon_edges("parts"))).alias("e"))
    side = F.lit(outline.CELL_SIDE)
    return edges.groupBy("site_id").agg(
        F.round(F.sum(F.expr("e.ax * e.by - e.bx * e.ay")) / 2 / side / side).cast("long").alias("cells"),
        F.round(F.sum(F.expr("abs(e.bx - e.ax) + abs(e.by - e.ay)")) / side).cast("long").alias("sides"),
        F.count(F.lit(1)).alias("corners"),
        F.min("e.ax").alias("min_x"),
        F.max("e.ax").alias("max_x"),
        F.min("e.ay").alias("min_y"),
        F.max("e.ay").alias("max_y"),
    )


@query
def geofence_network(t):
    """Addresses inside the outline of the road a site reaches."""
    return outline.network_fence(site_nodes(t), t["edges"], road_nodes(t), t["address_fabric"], BUDGET)


@query
def route_cost(t):
    pairs = t["geofence_bridge"].distinct().select((F.col("site_id") * 3).alias("from_node"), F.col("addr_id").alias("to_node"))
    costs = reach.route_cost(pairs, t["edges"], BUDGET)
    return costs.select("from_node", "to_node", F.col("route.distance").alias("distance"), F.col("route.minutes").alias("minutes"))


@query
def geofence_stream(t):
    """New supplier files become sites and are fenced as they arrive."""
    from sitescore.sources.location_views import VIEWS

    out = scratch_path(t.spark, "stream-out")

    def to_sites(batch: DataFrame) -> DataFrame:
        sites = batch.sparkSession.sql(VIEWS["sites"], supplier=batch)
        return geofence.travel_boundary(sites, radius=RADIUS)

    stream = geofence_incremental(
        t.spark,
        t.folder,
        t.base("supplier").schema,
        t["address_fabric"],
        out,
        scratch_path(t.spark, "stream-checkpoint"),
        to_sites,
        pattern="supplier*.parquet",
    )
    stream.awaitTermination()
    return t.spark.read.parquet(out).select("site_id", "addr_id")


# -- models ------------------------------------------------------------------


def prepared(t: LocationTables):
    return site_selection.prepare(training_matrix(t))


def _predictions(t, kind):
    _, train, test = prepared(t)
    return models.fit(kind, train).transform(test).select("site_id", "stars", "prediction")


@query
def assembled_features(t):
    matrix = training_matrix(t)
    fixed = models.FeatureList.fit(matrix)
    return fixed.assemble(matrix).select("site_id", "stars", vector_to_array("features").alias("features"))


@query
def scaled_features(t):
    rows = site_features(t).business(bridge(t))
    train, _ = sampling.split(rows)
    return models.scale_columns(rows, train, columns.numeric_columns(rows.drop("site_id")))


@query
def model_dt(t):
    return _predictions(t, "dt")


@query
def model_rf(t):
    return _predictions(t, "rf")


@query
def model_gbt(t):
    return _predictions(t, "gbt")


@query
def model_comparison(t):
    _, train, test = prepared(t)
    return models.compare({kind: models.fit(kind, train) for kind in ("dt", "rf", "gbt")}, test)


def searched(t: LocationTables) -> DataFrame:
    """The log of the search over the whole grid."""
    _, train, test = prepared(t)
    return models.grid_search(train, test, models.grid_rows(**models.GRID))


def _flat_runs(runs: DataFrame) -> DataFrame:
    return runs.select(
        "run_id",
        "status",
        *[F.col("params")[p].alias(p) for p in ("n_estimators", "criterion", "max_samples")],
        *[F.col("metrics")[m].alias(m) for m in ("rmse", "mape", "mae")],
    )


@query
def grid_search(t):
    return _flat_runs(searched(t))


@query
def best_grid_run(t):
    """The best run of the log of the whole grid."""
    return _flat_runs(models.best_run(searched(t)))


@query
def tuned_search(t):
    """The tuning flow over the whole grid, both criteria measured."""
    return _flat_runs(tuning.tune(training_matrix(t), models.grid_rows(**models.GRID)))


@query
def best_run(t):
    """The best of five baselines that shrink batch means towards the overall mean."""
    rows = labelled(t)
    means = rows.groupBy("batch_id").agg(F.avg("stars").alias("batch_mean"))
    overall = rows.agg(F.avg("stars")).scalar()
    runs = rows.join(means, on="batch_id").select("stars", "batch_mean", overall.alias("mean"), F.posexplode(F.lit(SHRINK)).alias("run_id", "weight"))
    prediction = F.col("weight") * F.col("batch_mean") + (1 - F.col("weight")) * F.col("mean")
    measured = models.metrics(runs.withColumn("prediction", prediction), by=["run_id", "weight"])
    return models.best_run(measured)


@query
def final_model_metrics(t):
    _, train, test = prepared(t)
    return models.train_final(train, test)[1]


def _final_model(t):
    fixed, train, test = prepared(t)
    candidates = site_features(t).matrix(bridge_of(t, candidate_sites(t)))
    return models.train_final(train, test)[0], fixed, candidates


@query
def scored_sites(t):
    model, fixed, candidates = _final_model(t)
    return site_selection.score_sites(model, fixed, candidates)


@query
def median_local_sales(t):
    return features.local_sales(cut_lineage(bridge_of(t, candidate_sites(t))), t["address_fabric"], t["poi"])


@query
def site_ranking(t):
    model, fixed, candidates = _final_model(t)
    attributes = candidate_sites(t).select("site_id", "price", "size_sqft")
    return site_selection.rank_candidates(model, fixed, candidates, attributes, median_local_sales(t))


# -- the whole way from address text -----------------------------------------


def located(t: LocationTables) -> DataFrame:
    """Listings whose address was found, as sites at that address."""
    coded = columns.expand(geocode.geocode(t["listings"], t["address_fabric"], fuzzy=True), "geocode_result")
    return cut_lineage(coded.select(F.col("listing_id").alias("site_id"), "formatted_address", "x", "y", "price", "size_sqft"))


def located_bridge(t: LocationTables, sites: DataFrame) -> DataFrame:
    return geofence.geofence(geofence.travel_boundary(sites, radius=REACH), t["address_fabric"])


@query
def matrix_from_listings(t):
    """Features of every located listing, from its address text on."""
    return site_features(t).matrix(located_bridge(t, located(t)))


@query
def ranking_from_listings(t):
    """Located listings with features, by review stars, sales around them, price and size."""
    sites = located(t)
    around = cut_lineage(located_bridge(t, sites))
    described = columns.keep_keys(sites, site_features(t).matrix(around), "site_id")
    stars = t["reviews"].select("site_id", F.col("stars").alias("stars_score"))
    sales = features.local_sales(around, t["address_fabric"], t["poi"])
    metrics = described.select("site_id", "price", "size_sqft").join(stars, on="site_id").join(sales, on="site_id", how="left")
    return rank.with_attributes(rank.combined_score(metrics), sites.select("site_id", "formatted_address", "x", "y"), "score")


def selection(t: LocationTables) -> StoreSelection:
    return StoreSelection(site_features(t), lambda sites: geofence.travel_boundary(sites, radius=REACH))


@query
def fenced_stores_split(t):
    """Stores with features from their own fence, their label and the part they fall in."""
    trained = selection(t).train(training_sites(t), t["reviews"])
    return trained.labelled


@query
def fenced_model_metrics(t):
    """Hold-out errors of the model trained on fenced stores."""
    return selection(t).train(training_sites(t), t["reviews"]).held_out


def _ranked_by_model(t: LocationTables) -> tuple[DataFrame, float, float]:
    plan = selection(t)
    trained = plan.train(training_sites(t), t["reviews"])
    return plan.rank(trained, plan.locate(t["listings"])), trained.lowest, trained.highest


@query
def model_ranking_from_listings(t):
    """Listings by the score of a model trained on fenced stores, with address and place."""
    return _ranked_by_model(t)[0]


@query
def model_ranking_facts(t):
    """What does not depend on the trees: who is ranked, where, by which metrics, and with a label the stores have."""
    ranked, lowest, highest = _ranked_by_model(t)
    known = F.col("stars_score").between(lowest, highest)
    return ranked.select("site_id", "formatted_address", "x", "y", "price", "size_sqft", "median_sales_volume_local", known.alias("score_in_label_range"))
