import pytest
from pyspark.sql import functions as F

from sitescore.operators import columns, enrich, features, quality
from sitescore.operators.balance import hot_keys
from sitescore.operators.enrich import FeatureSource

FABRIC = "addr_id long, prop_type string, zipcode long, geoid long"
POI = (
    "addr_id long, brandname string, group_name string, employee_here int, employee_count int,"
    " sales_volume_usd double, sales_volume_local double"
)


def test_missing_code_counts_as_one_block(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (1, None), (1, None), (2, 5)], "site_id long, code long")
    assert {tuple(r) for r in features.census_blocks(rows).collect()} == {(1, 2), (2, 1)}


def test_one_address_has_no_deviation(spark):
    rows = spark.createDataFrame([(1, 4.0), (2, 1.0), (2, 2.0), (2, 3.0), (2, 9.0)], "site_id long, v double")
    got = {r.site_id: r for r in features.proximity_stats(rows, "site_id", ["v"]).collect()}
    assert got[1].stddev_v is None and got[1].avg_v == 4.0
    assert got[2].median_v == 2.0 and got[2].min_v == 1.0 and got[2].max_v == 9.0
    filled = columns.NullPolicy().apply(features.proximity_stats(rows, "site_id", ["v"]))
    assert filled.where("site_id = 1").first().stddev_v == 0.0


@pytest.fixture
def shops(spark):
    """Address 10 holds three points, two related; address 11 one unrelated; 12 is a home."""
    fabric = spark.createDataFrame([(10, "B", 1, 1), (11, "B", 1, 1), (12, "R", 1, 1), (13, None, 1, 1)], FABRIC)
    poi = spark.createDataFrame(
        [
            (10, "OURS", "FOOD", 4, 40, 100.0, 1.0),
            (10, "OURS", "FOOD", 4, 40, 100.0, 1.0),
            (10, "OTHER", "FOOD", None, 10, None, None),
            (11, "OURS", "CARS", 7, 70, 700.0, 7.0),
            (12, "OURS", "FOOD", 9, 90, 900.0, 9.0),
            (13, "OURS", "FOOD", 9, 90, 900.0, 9.0),
        ],
        POI,
    )
    return fabric, poi


def naive_business(bridge, fabric, poi):
    """Feature by feature, with all points of all addresses joined."""
    rows = bridge.join(fabric, "addr_id").where("prop_type = 'B'").join(poi, "addr_id")
    brand = bridge.join(fabric, "addr_id").where("prop_type = 'B'").join(poi.where("brandname = 'OURS'").distinct(), "addr_id")
    related = rows.where("group_name = 'FOOD'").groupBy("site_id").agg(
        F.count("addr_id").alias("related_businesses_count"),
        F.avg("employee_here").alias("avg_employee_here"),
        F.avg("employee_count").alias("avg_employee_count"),
        F.avg("sales_volume_usd").alias("avg_sales_volume_usd"),
    )
    every = rows.groupBy("site_id").agg(F.count("addr_id").alias("all_businesses_count"))
    ours = brand.groupBy("site_id").agg(F.count("addr_id").alias("brand_count"))
    names = ["site_id", "related_businesses_count", "avg_employee_here", "avg_employee_count", "all_businesses_count", "brand_count", "avg_sales_volume_usd"]
    return related.join(every, "site_id", "left").join(ours, "site_id", "left").na.fill(0).select(*names)


def test_business_counts_joined_rows(spark, shops):
    fabric, poi = shops
    bridge = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (1, 12), (1, 13), (2, 11), (3, 12), (None, 10)], "site_id long, addr_id long")
    got = sorted(map(tuple, features.business(bridge, fabric, poi, "OURS", "FOOD").collect()))
    want = sorted(map(tuple, naive_business(bridge.where("site_id IS NOT NULL"), fabric, poi).collect()))
    assert got == want
    assert got == [(1, 6, 4.0, 30.0, 7, 3, 100.0)]  # sites without a related point drop out
    once = features.business(bridge, fabric, poi, "OURS", "FOOD", distinct_bridge=True).first()
    assert once.related_businesses_count == 3 and once.all_businesses_count == 4


def test_business_reads_each_input_once(spark, shops, tmp_path):
    fabric, poi = shops
    # long folder names are cut in the plan text otherwise
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    read = {}
    bridge = spark.createDataFrame([(1, 10)], "site_id long, addr_id long")
    for name, df in (("fabric", fabric), ("poi", poi), ("bridge", bridge)):
        df.write.parquet(str(tmp_path / name))
        read[name] = spark.read.parquet(str(tmp_path / name))
    df = features.business(read["bridge"], read["fabric"], read["poi"], "OURS", "FOOD")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    for name in read:
        assert plan.count(f"/{name}]") == 1, plan


def test_median_of_local_sales_skips_unknown(spark, shops):
    fabric, poi = shops
    bridge = spark.createDataFrame([(1, 10), (1, 11), (2, 13)], "site_id long, addr_id long")
    assert [tuple(r) for r in features.local_sales(bridge, fabric, poi).collect()] == [(1, 1.0)]


def homes(spark):
    fabric = spark.createDataFrame([(i, "R" if i % 4 else "B", 100 + i, i % 3) for i in range(20)], FABRIC)
    bridge = spark.createDataFrame([(s, (s * 7 + i) % 20) for s in range(5) for i in range(9)] * 2, "site_id long, addr_id long")
    people = spark.createDataFrame([(i, i % 6, i * 1.5) for i in range(15)], "addr_id long, code long, pop double")
    profile = spark.createDataFrame([(0, 3.0), (1, 4.0)], "code long, likes double")
    return fabric, bridge, people, profile


def sources_of(people, profile, unique):
    return [
        FeatureSource("people", people, other_keys=("code",), one_row_per_key=unique),
        FeatureSource("profile", profile, on=("geoid", "code"), one_row_per_key=unique),
    ]


def test_combined_and_separate_sources_agree(spark):
    fabric, bridge, people, profile = homes(spark)
    chosen = {"people": ["pop"], "profile": ["likes"]}

    def collapse(unique):
        df = features.residential(bridge, fabric, sources_of(people, profile, unique), chosen, "people")
        doubles = {c: F.round(c, 9) for c, kind in df.dtypes if kind == "double"}
        return sorted(map(tuple, df.withColumns(doubles).select(sorted(df.columns)).collect()), key=str)

    assert collapse(True) == collapse(False)
    assert len(collapse(True)) == 5


def test_fan_out_of_a_source_with_repeated_keys(spark):
    fabric, bridge, people, profile = homes(spark)
    twice = people.union(people)
    df = features.residential(bridge, fabric, sources_of(twice, profile, False), {"people": ["pop"], "profile": ["likes"]}, "people")
    rows = enrich.resolve_addresses(bridge, fabric, "R").join(twice, "addr_id", "left")
    want = {tuple(r) for r in rows.groupBy("site_id").agg(F.round(F.stddev_samp("pop"), 9), F.countDistinct("code")).collect()}
    got = {tuple(r) for r in df.select("site_id", F.round("stddev_pop", 9), "code_cnt").collect()}
    assert {g[:2] for g in got} == {w[:2] for w in want}


def test_broken_promise_of_unique_keys_fails(spark):
    fabric, bridge, people, profile = homes(spark)
    df = features.residential(bridge, fabric, sources_of(people.union(people), profile, True), {"people": ["pop"], "profile": ["likes"]}, "people")
    with pytest.raises(Exception, match="people: key occurs twice"):
        df.collect()


def test_column_sampling_repeats_and_depends_on_order(spark):
    _, _, people, profile = homes(spark)
    wide = people.select("addr_id", "code", *[F.lit(i).alias(f"f{i}") for i in range(20)])
    a, b = FeatureSource("a", wide, other_keys=("code",)), FeatureSource("b", wide, other_keys=("code",))
    both = features.sample_columns([a, b])
    assert both == features.sample_columns([a, b]) and [len(v) for v in both.values()] == [5, 5]
    assert features.sample_columns([b])["b"] == both["a"]
    assert both["a"] != both["b"]
    assert len(features.sample_columns([a], n=None, drop_share=0.9)["a"]) == 2


def test_labels_and_matrix_keep_one_row_per_site(spark):
    shops = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "site_id long, n long")
    labels = spark.createDataFrame([(1, 10, 4.0), (1, 9, 4.5), (1, 9, 4.5), (2, 1, 3.0), (9, 1, 1.0)], "site_id long, review_count long, stars double")
    labelled = features.with_labels(shops, labels)
    assert {tuple(r) for r in labelled.collect()} == {(1, 5, 9, 4.5), (2, 6, 1, 3.0)}
    res = spark.createDataFrame([(2, 0.5), (3, 0.6)], "site_id long, avg_x double")
    assert [tuple(r) for r in features.training_matrix(labelled, res).collect()] == [(2, 6, 1, 3.0, 0.5)]


def test_null_policy_is_fitted_once(spark):
    train = spark.createDataFrame([(1, None, 2.0), (2, 1.0, 3.0)], "site_id long, a double, b double")
    later = spark.createDataFrame([(3, 1.0, None)], "site_id long, a double, b double")
    dropping = columns.NullPolicy("drop_columns").fit(train)
    assert dropping.apply(later).columns == ["site_id", "b"]
    assert columns.NullPolicy().fit(train).apply(later).first().b == 0.0


def test_audits(spark):
    left = spark.createDataFrame([(1, "x"), (2, None)], "id long, City string")
    right = spark.createDataFrame([(1, "y")], "id long, CITY string")
    joined = left.join(right, left["id"] == right["id"], "left")
    assert [tuple(r) for r in quality.duplicate_columns(joined).collect()] == [("city", 2, 2), ("id", 2, 3)]
    assert {tuple(r) for r in quality.key_diff(left, right, "id", "a", "b").collect()} == {(2, "a")}
    assert features.column_sets(["b", "a"], ["b", "c"]) == {"union": ["a", "b", "c"], "left_only": ["a"], "right_only": ["c"]}


def test_split_addresses_change_nothing(spark, shops):
    """With every address treated as hot, features stay the same."""
    fabric, bridge, people, profile = homes(spark)
    hot = hot_keys(bridge, None, ["addr_id"], min_work=1)
    assert hot.count() > 5
    chosen = {"people": ["pop"], "profile": ["likes"]}
    sources = sources_of(people, profile, True)

    def rows(df):
        doubles = {c: F.round(c, 9) for c, kind in df.dtypes if kind == "double"}
        return sorted(map(str, df.withColumns(doubles).select(sorted(df.columns)).collect()))

    plain = features.residential(bridge, fabric, sources, chosen, "people", hot=None)
    split = features.residential(bridge, fabric, sources, chosen, "people", hot=hot)
    assert rows(plain) == rows(split)
    _, poi = shops
    places = fabric.union(spark.createDataFrame([(100, "B", 1, 1)], FABRIC))
    for once in (False, True):
        a = features.business(bridge, places, poi, "OURS", "FOOD", distinct_bridge=once, hot=None)
        b = features.business(bridge, places, poi, "OURS", "FOOD", distinct_bridge=once, hot=hot)
        assert rows(a) == rows(b) != []
    looked_up = enrich.resolve_addresses(bridge, fabric, "R", hot=hot)
    assert rows(looked_up) == rows(enrich.resolve_addresses(bridge, fabric, "R", hot=None))
