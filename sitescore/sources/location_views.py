"""Location tables expressed over the star-schema tables.

One text per view, valid on Spark and on DuckDB, with table names in braces:
Spark fills them with DataFrames, the SQL twin with CTE or table names. Numbers
are written ``1e4`` style so that both engines compute in DOUBLE.

Sites and addresses lie in towns of 0.2 x 0.1 degrees. A town holds 100 sites
and 1500 addresses, so more data means more towns and the number of addresses
around a site stays the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitescore.sources.tables import load

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {
    "sites": """
SELECT s_suppkey AS site_id, s_name AS name,
       -96e0 + 0.2e0 * (CAST(floor(s_suppkey / 1e2) AS BIGINT) % 400) + ((s_suppkey * 7919) % 2000) / 1e4 AS x,
       30e0 + 0.1e0 * floor(s_suppkey / 4e4) + ((s_suppkey * 6151) % 1000) / 1e4 AS y,
       s_acctbal AS price, 500 + (s_suppkey * 37) % 4500 AS size_sqft,
       s_nationkey < 5 AS is_candidate, s_suppkey % 26 AS batch_id
FROM {supplier}
""",
    "address_fabric": """
SELECT c_custkey AS addr_id,
       CAST(c_nationkey AS BIGINT) AS geoid,
       CAST(c_nationkey AS BIGINT) * 10 + c_custkey % 10 AS code,
       CASE WHEN c_custkey % 50 = 0 THEN NULL
            WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'B'
            ELSE 'R' END AS prop_type,
       10000 + c_custkey % 97 AS zipcode,
       concat(CAST(c_custkey AS STRING), ' ', c_mktsegment, ' ST') AS address_line,
       -96e0 + 0.2e0 * (CAST(floor(c_custkey / 15e2) AS BIGINT) % 400) + ((c_custkey * 104729) % 1999) / 1e4 AS lon,
       30e0 + 0.1e0 * floor(c_custkey / 6e5) + ((c_custkey * 15485863) % 997) / 1e4 AS lat
FROM {customer}
""",
    "listings": """
SELECT s.s_suppkey AS listing_id,
       CASE WHEN s.s_suppkey % 4 = 0 THEN 'nowhere in particular'
            WHEN s.s_suppkey % 4 = 1 THEN concat(CAST(c.c_custkey AS STRING), ' ', replace(lower(c.c_mktsegment), 'i', 'l'), ' st')
            ELSE concat('  ', CAST(c.c_custkey AS STRING), '   ', lower(c.c_mktsegment), ' Street ')
       END AS address,
       10000 + c.c_custkey % 97 AS zipcode,
       s.s_acctbal AS price, 500 + (s.s_suppkey * 37) % 4500 AS size_sqft
FROM {supplier} s JOIN {customer} c ON c.c_custkey = s.s_suppkey * 3
""",
    "geofence_bridge": """
SELECT l.l_suppkey AS site_id, o.o_custkey AS addr_id
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
""",
    "population": """
SELECT c_custkey AS addr_id,
       CAST(c_nationkey AS BIGINT) * 10 + c_custkey % 10 AS code,
       1 + (c_custkey * 31) % 1000 AS popby,
       (c_custkey * 17) % 101 AS pop_f1, (c_custkey * 13) % 211 AS pop_f2,
       (c_custkey * 7) % 307 AS pop_f3, (c_custkey * 5) % 401 AS pop_f4,
       (c_custkey * 3) % 503 AS pop_f5, (c_custkey * 11) % 601 AS pop_f6,
       c_acctbal AS pop_f7
FROM {customer}
""",
    "consumer_spend": """
SELECT o_custkey AS addr_id,
       count(*) AS ce_orders,
       CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS ce_urgent,
       CAST(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS ce_high,
       CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS ce_low,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS ce_done,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS ce_open,
       min(o_totalprice) AS ce_min, max(o_totalprice) AS ce_max
FROM {orders} GROUP BY o_custkey
""",
    "audience": """
SELECT CAST(n_nationkey AS BIGINT) AS code, n_name AS source_file,
       (n_nationkey * 7) % 5 AS ap_f1, (n_nationkey * 11) % 13 AS ap_f2,
       (n_nationkey * 3) % 17 AS ap_f3, (n_nationkey * 5) % 19 AS ap_f4,
       n_nationkey % 3 AS ap_f5, n_nationkey % 4 AS ap_f6, n_regionkey AS ap_f7
FROM {nation}
""",
    "poi": """
SELECT CAST(floor(p_partkey / 2e0) AS BIGINT) AS addr_id,
       p_brand AS brandname, p_type AS group_name, p_name AS business_line,
       p_size AS employee_here, p_size * (1 + p_partkey % 3) AS employee_count,
       p_retailprice AS sales_volume_usd,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice * 2e0 END AS sales_volume_local
FROM {part}
""",
    "reviews": """
SELECT user_id AS site_id, count(*) AS review_count,
       1e0 + CAST(sum(event_id) % 9 AS DOUBLE) / 2e0 AS stars
FROM {events} GROUP BY user_id
""",
    "edges": """
SELECT c_custkey AS src, (c_custkey * 3 + 1) % (SELECT count(*) FROM {customer}) AS dst,
       0.5e0 + (c_custkey % 5) * 0.25e0 AS minutes,
       0.2e0 + (c_custkey % 4) * 0.1e0 AS miles
FROM {customer}
UNION ALL
SELECT c_custkey, (c_custkey + 1) % (SELECT count(*) FROM {customer}),
       0.75e0 + (c_custkey % 3) * 0.25e0, 0.3e0
FROM {customer}
""",
    "driveways": """
SELECT c_custkey AS node, c_custkey AS addr_id, (c_custkey % 7) * 0.02e0 AS miles FROM {customer}
""",
}


class LocationTables:
    """The views of one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = load(self.spark, self.folder, name)
        return self._frames[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            text = VIEWS[name]
            used = {t: self.base(t) for t in BASE_TABLES if "{" + t + "}" in text}
            self._frames[name] = self.spark.sql(text, **used)
        return self._frames[name]
