"""SQL twins of the queries, for DuckDB on the same tables.

Each text starts with the location views it needs as CTEs. Doubles are rounded
to 6 digits on both sides, after adding 1e-9: an average that ends in an exact 5
then rounds the same way whatever order its terms were summed in.
"""

from __future__ import annotations

from sitescore.functions.geometry import OCTAGON
from sitescore.functions.text import SUFFIXES
from sitescore.operators.sampling import SEED, TEST_SHARE
from sitescore.sources.location_views import BASE_TABLES, VIEWS

_NAMES = {name: name for name in BASE_TABLES}

# Columns the seeded draw keeps, in its order; spend with its columns of interest.
AUDIENCE = ["ap_f6", "ap_f1", "ap_f7", "ap_f3", "ap_f5"]
SPEND = ["ce_done", "ce_high", "ce_low", "ce_open", "ce_orders", "ce_urgent"]
FAMILY = ["fam_f6", "fam_popby", "fam_f7", "fam_f5", "fam_f1"]
INCOME = ["inc_f3", "inc_f4", "inc_f6", "inc_popby", "inc_f1"]
POPULATION = ["pop_f6", "pop_f1", "pop_f3", "pop_f4", "pop_f2"]

AUDIENCE_ALL = [f"ap_f{i}" for i in range(1, 8)]
SPEND_ALL = ["ce_orders", "ce_urgent", "ce_high", "ce_low", "ce_done", "ce_open", "ce_min", "ce_max"]
POPULATION_ALL = ["popby", *[f"pop_f{i}" for i in range(1, 8)]]


def _census(table: str, prefix: str) -> str:
    renamed = ", ".join(f"pop_f{i} AS {prefix}_f{i}" for i in range(1, 8))
    return f"{table} AS (SELECT addr_id, code, popby AS {prefix}_popby, {renamed} FROM population)"


def _view(name: str) -> str:
    return f"{name} AS ({VIEWS[name].format(**_NAMES).strip()})"


def sql(views: str, body: str, *ctes: str, recursive: bool = False) -> str:
    parts = [*[_view(v) for v in views.split()], *ctes]
    head = ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" if parts else ""
    return head + body.strip()


# -- shared CTEs -------------------------------------------------------------

HOMES = """homes AS (
SELECT DISTINCT b.site_id, f.prop_type, f.addr_id, f.zipcode, f.geoid
FROM geofence_bridge b JOIN address_fabric f ON b.addr_id = f.addr_id
WHERE f.prop_type = 'R' AND b.site_id IS NOT NULL)"""

POP_ROWS = "pop_rows AS (SELECT h.*, p.code, " + ", ".join(f"p.{c}" for c in POPULATION_ALL) + " FROM homes h LEFT JOIN population p ON h.addr_id = p.addr_id)"
SPEND_ROWS = "spend_rows AS (SELECT h.*, " + ", ".join(f"s.{c}" for c in SPEND_ALL) + " FROM homes h LEFT JOIN consumer_spend s ON h.addr_id = s.addr_id)"
AUD_ROWS = "aud_rows AS (SELECT h.*, a.code AS ap_code, " + ", ".join(f"a.{c}" for c in AUDIENCE_ALL) + " FROM homes h LEFT JOIN audience a ON h.geoid = a.code)"
BLOCKS = "blocks AS (SELECT site_id, count(*) AS code_cnt FROM (SELECT DISTINCT site_id, code FROM pop_rows) d GROUP BY site_id)"

_SQL_STATS = {
    "avg": "round(avg({c}) + 1e-9, 6)",
    "stddev": "round(stddev_samp({c}) + 1e-9, 6)",
    "min": "min({c})",
    "max": "max({c})",
    "median": "quantile_disc({c}, 0.5)",
}


def _stats(columns: list[str], statistics: list[str]) -> str:
    return ", ".join(f"{_SQL_STATS[s].format(c=c)} AS {s}_{c}" for s in statistics for c in columns)


def _stats_sql(views: str, rows: str, source: str, columns: list[str], statistics: list[str]) -> str:
    return sql(views, f"SELECT site_id, {_stats(columns, statistics)} FROM {source} GROUP BY site_id", HOMES, rows)


FOUR = ["avg", "stddev", "min", "max"]
ALL_STATS = [*FOUR, "median"]

_CORNERS = ", ".join(f"({i}, CAST({x!r} AS DOUBLE), CAST({y!r} AS DOUBLE))" for i, (x, y) in enumerate(OCTAGON))
OCTAGON_CTE = f"octagon(i, ux, uy) AS (VALUES {_CORNERS})"


def _sides(name: str, radius: str) -> str:
    return f"""{name} AS (
SELECT s.site_id, s.x + a.ux * {radius} AS ax, s.y + a.uy * {radius} AS ay, s.x + b.ux * {radius} AS bx, s.y + b.uy * {radius} AS by_
FROM sites s CROSS JOIN octagon a JOIN octagon b ON b.i = a.i + 1)"""


SIDES = _sides("sides", "0.03e0")
HOLE_SIDES = _sides("hole_sides", "0.01e0")
_CROSS = "(bx - ax) * (lat - ay) - (by_ - ay) * (lon - ax)"
FENCE = f"""fence AS (
SELECT s.site_id, f.addr_id FROM sides s CROSS JOIN address_fabric f
GROUP BY s.site_id, f.addr_id HAVING min({_CROSS}) >= 0)"""
FENCE_VIEWS = "sites address_fabric"

TRAINING_BRIDGE = """site_bridge AS (
SELECT b.* FROM geofence_bridge b JOIN sites s ON b.site_id = s.site_id WHERE NOT s.is_candidate)"""


def _shop_points(bridge: str) -> str:
    return f"""shop_points AS (
SELECT b.site_id, p.* FROM {bridge} b JOIN address_fabric f ON b.addr_id = f.addr_id JOIN poi p ON p.addr_id = b.addr_id
WHERE f.prop_type = 'B' AND b.site_id IS NOT NULL),
brand_points AS (
SELECT b.site_id, p.addr_id FROM {bridge} b JOIN address_fabric f ON b.addr_id = f.addr_id
JOIN (SELECT DISTINCT * FROM poi WHERE brandname = 'Brand#2') p ON p.addr_id = b.addr_id
WHERE f.prop_type = 'B' AND b.site_id IS NOT NULL),
related AS (
SELECT site_id, count(addr_id) AS related_businesses_count, avg(employee_here) AS avg_employee_here,
       avg(employee_count) AS avg_employee_count, avg(sales_volume_usd) AS avg_sales_volume_usd
FROM shop_points WHERE group_name = 'ECONOMY' GROUP BY site_id),
everything AS (SELECT site_id, count(addr_id) AS all_businesses_count FROM shop_points GROUP BY site_id),
branded AS (SELECT site_id, count(addr_id) AS brand_count FROM brand_points GROUP BY site_id),
shops AS (
SELECT r.site_id, r.related_businesses_count, round(coalesce(r.avg_employee_here, 0) + 1e-9, 6) AS avg_employee_here,
       round(coalesce(r.avg_employee_count, 0) + 1e-9, 6) AS avg_employee_count, coalesce(e.all_businesses_count, 0) AS all_businesses_count,
       coalesce(b.brand_count, 0) AS brand_count, round(coalesce(r.avg_sales_volume_usd, 0) + 1e-9, 6) AS avg_sales_volume_usd
FROM related r LEFT JOIN everything e ON r.site_id = e.site_id LEFT JOIN branded b ON r.site_id = b.site_id)"""


SHOP_VIEWS = "geofence_bridge address_fabric poi"
SHOPS = _shop_points("geofence_bridge")

_POP_STATS = f"pop_stats AS (SELECT site_id, {_stats(POPULATION, ALL_STATS)} FROM pop_rows GROUP BY site_id)"
_SPEND_STATS = f"spend_stats AS (SELECT site_id, {_stats(SPEND, ALL_STATS)} FROM spend_rows GROUP BY site_id)"
_AUD_STATS = f"aud_stats AS (SELECT site_id, {_stats(AUDIENCE, ALL_STATS)} FROM aud_rows GROUP BY site_id)"


def _stat_names(table: str, columns: list[str]) -> str:
    return ", ".join(f"{table}.{s}_{c}" for s in ALL_STATS for c in columns)


RESIDENTIAL = f"""res AS (
SELECT p.site_id, {_stat_names("p", POPULATION)}, {_stat_names("s", SPEND)}, {_stat_names("a", AUDIENCE)}, b.code_cnt
FROM pop_stats p LEFT JOIN spend_stats s ON p.site_id = s.site_id LEFT JOIN blocks b ON p.site_id = b.site_id
LEFT JOIN aud_stats a ON p.site_id = a.site_id)"""
RES_CTES = (POP_ROWS, SPEND_ROWS, AUD_ROWS, BLOCKS, _POP_STATS, _SPEND_STATS, _AUD_STATS, RESIDENTIAL)
RES_VIEWS = "geofence_bridge address_fabric population consumer_spend audience"

SCORES = "scores AS (SELECT r.site_id, r.stars AS stars_score FROM reviews r JOIN sites s ON r.site_id = s.site_id)"
LABELLED = "labelled AS (SELECT r.site_id, r.review_count, r.stars, s.batch_id FROM reviews r JOIN sites s ON r.site_id = s.site_id)"
BASELINE = """baseline AS (
SELECT l.site_id, l.stars, m.prediction FROM labelled l
JOIN (SELECT batch_id, avg(stars) AS prediction FROM labelled GROUP BY batch_id) m ON l.batch_id = m.batch_id)"""
_MAPE = "100 * avg(abs(stars - prediction) / nullif(stars, 0))"
_MAE = "avg(abs(stars - prediction))"
_RMSE = "sqrt(avg((stars - prediction) * (stars - prediction)))"


def _bucket(key: str) -> str:
    once = f"((({key} % 2147483647) * 48271 + {SEED}) % 2147483647)"
    return f"((({once} * 48271 + {SEED}) % 2147483647) % 10000)"


_IN_TEST = f"{_bucket('site_id')} < {round(TEST_SHARE * 10000)}"

_SALES = """sales AS (
SELECT b.site_id, quantile_disc(p.sales_volume_local, 0.5) AS median_sales_volume_local
FROM {bridge} b JOIN address_fabric f ON b.addr_id = f.addr_id JOIN poi p ON p.addr_id = b.addr_id
WHERE f.prop_type = 'B' AND p.sales_volume_local IS NOT NULL GROUP BY b.site_id)"""


def _scaled(column: str) -> str:
    return f"({column} - min({column}) OVER ()) / nullif(max({column}) OVER () - min({column}) OVER (), 0)"


# Normalised address line: upper case, single blanks, last word shortened.
def _line(column: str) -> str:
    clean = f"trim(regexp_replace(upper({column}), '[\\s.,]+', ' ', 'g'))"
    for long, short in SUFFIXES.items():
        clean = f"regexp_replace({clean}, '(^| ){long}$', '\\1{short}')"
    return f"nullif({clean}, '')"


ASKED = f"asked AS (SELECT listing_id, {_line('address')} AS line, zipcode FROM listings)"
KNOWN = f"known AS (SELECT addr_id, lon, lat, zipcode, address_line, {_line('address_line')} AS line FROM address_fabric)"
EXACT = """exact AS (
SELECT a.listing_id, arg_min(k, k.addr_id) AS k FROM asked a JOIN known k ON a.line = k.line AND a.zipcode = k.zipcode GROUP BY a.listing_id)"""
NEAR = """near AS (
SELECT a.listing_id, arg_min(k, levenshtein(a.line, k.line) * 1e12 + k.addr_id) AS k
FROM asked a JOIN known k ON a.zipcode = k.zipcode AND levenshtein(a.line, k.line) <= 2
WHERE a.listing_id NOT IN (SELECT listing_id FROM exact) GROUP BY a.listing_id)"""


def _geocode(matches: str) -> str:
    return f"""
SELECT a.listing_id, m.k.addr_id AS addr_id, round(m.k.lon + 1e-9, 6) AS x, round(m.k.lat + 1e-9, 6) AS y,
       m.k.address_line AS formatted_address, m.precision, CASE WHEN m.listing_id IS NULL THEN 'no match' END AS error
FROM asked a LEFT JOIN ({matches}) m ON a.listing_id = m.listing_id"""


_EXACT_ROWS = "SELECT listing_id, k, 'exact' AS precision FROM exact"

# From address text to the features around the address found.
LOCATED = """located AS (
SELECT l.listing_id AS site_id, m.k.address_line AS formatted_address, m.k.lon AS x, m.k.lat AS y, l.price, l.size_sqft
FROM listings l JOIN (SELECT * FROM exact UNION ALL SELECT * FROM near) m ON l.listing_id = m.listing_id)"""
CHAIN_VIEWS = "listings address_fabric population consumer_spend audience poi reviews"
CHAIN = (
    ASKED,
    KNOWN,
    EXACT,
    NEAR,
    LOCATED,
    OCTAGON_CTE,
    _sides("sides", "0.03125e0").replace("FROM sites s", "FROM located s"),
    FENCE,
    HOMES.replace("geofence_bridge b", "fence b"),
    *RES_CTES,
    _shop_points("fence"),
)

# All ways of a source within the budget.
WAYS = """ways(source, node, minutes, miles) AS (
SELECT DISTINCT {start}, {start}, 0e0, 0e0 FROM {origin}
UNION
SELECT w.source, e.dst, w.minutes + e.minutes, w.miles + e.miles
FROM ways w JOIN edges e ON w.node = e.src WHERE w.minutes + e.minutes <= 5)"""

# Cells of a 1/128 degree grid near the road a site gets along in 5 minutes, and its nodes.
ROAD_CELLS = (
    """ways(source, node, minutes) AS (
SELECT site_id, site_id * 3, 0e0 FROM sites
UNION SELECT w.source, e.dst, w.minutes + e.minutes FROM ways w JOIN edges e ON w.node = e.src WHERE w.minutes + e.minutes <= 5)""",
    "best AS (SELECT source, node, min(minutes) AS minutes FROM ways GROUP BY source, node)",
    """road AS (
SELECT b.source, p.lon AS x0, p.lat AS y0, p.lon + s.share * (q.lon - p.lon) AS x1, p.lat + s.share * (q.lat - p.lat) AS y1
FROM (SELECT b.*, e.dst, least(1e0, (5e0 - b.minutes) / e.minutes) AS share FROM best b JOIN edges e ON b.node = e.src) s
JOIN best b ON b.source = s.source AND b.node = s.node JOIN address_fabric p ON p.addr_id = s.node JOIN address_fabric q ON q.addr_id = s.dst
UNION ALL SELECT b.source, p.lon, p.lat, p.lon, p.lat FROM best b JOIN address_fabric p ON p.addr_id = b.node)""",
    "wide AS (SELECT *, 1e0 / 128 AS s, 0.1e0 / 69e0 AS m, 0.1e0 / 69e0 / cos(radians(y0)) AS b FROM road)",
    """lanes AS (
SELECT *, unnest(generate_series(CAST(floor((least(x0, x1) - b) / s) AS BIGINT), CAST(floor((greatest(x0, x1) + b) / s) AS BIGINT))) AS cx FROM wide)""",
    "beside AS (SELECT *, greatest(least(x0, x1), cx * s - b) AS xa, least(greatest(x0, x1), (cx + 1) * s + b) AS xb FROM lanes)",
    """passed AS (
SELECT source, cx, s, m, CASE WHEN x0 = x1 THEN y0 ELSE y0 + (xa - x0) * ((y1 - y0) / (x1 - x0)) END AS ya,
       CASE WHEN x0 = x1 THEN y1 ELSE y0 + (xb - x0) * ((y1 - y0) / (x1 - x0)) END AS yb FROM beside)""",
    """cells AS (
SELECT DISTINCT source, cx, unnest(generate_series(CAST(floor((least(ya, yb) - m) / s) AS BIGINT), CAST(floor((greatest(ya, yb) + m) / s) AS BIGINT))) AS cy
FROM passed)""",
)

_SAMPLE_N = "(SELECT count(*) FROM reviews r JOIN sites s ON r.site_id = s.site_id WHERE NOT s.is_candidate)"


def _counted(table: str, columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, '{source}' AS source, count({c}) AS non_null FROM {table}" for c in columns)


_MATRIX_NAMES = ["related_businesses_count", "avg_employee_here", "avg_employee_count", "all_businesses_count", "brand_count", "avg_sales_volume_usd"]


ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_sites": sql("sites", "SELECT site_id, name, round(x + 1e-9, 6) AS x, round(y + 1e-9, 6) AS y, price, size_sqft, is_candidate, batch_id FROM sites"),
    "select_sites": sql("sites", "SELECT site_id, name, round(x + 1e-9, 6) AS x, round(y + 1e-9, 6) AS y, 'USA' AS country FROM sites WHERE name LIKE '%Supplier%' AND site_id IS NOT NULL"),
    "csv_roundtrip": sql("listings", "SELECT * FROM listings"),
    "param_grid": sql(
        "sites reviews",
        f"""SELECT n_estimators, max_samples, TRUE AS bootstrap, CAST(floor(max_samples * {_SAMPLE_N} + 0.5) AS BIGINT) AS sample_rows
FROM (SELECT unnest([20, 51]) AS n_estimators), (SELECT unnest([0.25e0, 0.5e0, 0.75e0]) AS max_samples)""",
    ),
    "forest_grid": sql(
        "sites reviews",
        f"""SELECT CAST(n.i AS BIGINT) AS n_estimators, criterion, TRUE AS bootstrap, round(m.i * 0.1e0 + 1e-9, 6) AS max_samples,
       CAST(floor(m.i * 0.1e0 * {_SAMPLE_N} + 0.5) AS BIGINT) AS sample_rows
FROM range(10, 50) n(i), (SELECT unnest(['mse', 'mae']) AS criterion), range(1, 10) m(i)""",
    ),
    "table_roundtrip": sql("sites", "SELECT site_id, name, round(x + 1e-9, 6) AS x, round(y + 1e-9, 6) AS y, price, size_sqft, is_candidate, batch_id FROM sites"),
    "append_evolving": sql("sites", "SELECT site_id, round(x + 1e-9, 6) AS x, round(y + 1e-9, 6) AS y, CASE WHEN is_candidate THEN price END AS price FROM sites"),
    "view_query": sql("address_fabric", "SELECT zipcode, count(*) AS n_addresses, min(addr_id) AS first_addr FROM address_fabric GROUP BY zipcode"),
    "batched_geofence": sql(FENCE_VIEWS, "SELECT f.site_id, f.addr_id, s.batch_id FROM fence f JOIN sites s ON f.site_id = s.site_id", OCTAGON_CTE, SIDES, FENCE),
    "batch_join": sql("sites geofence_bridge", "SELECT b.site_id, b.addr_id, s.batch_id FROM (SELECT DISTINCT * FROM geofence_bridge) b LEFT JOIN sites s ON b.site_id = s.site_id"),
    "run_log": sql(
        "sites reviews",
        f"""SELECT run_id, CAST(shift AS VARCHAR) AS shift, round({_RMSE} + 1e-9, 6) AS rmse, round({_MAPE} + 1e-9, 6) AS mape, round({_MAE} + 1e-9, 6) AS mae
FROM (SELECT r.run_id, r.shift, b.stars, b.prediction + r.shift AS prediction
      FROM baseline b, (SELECT 0 AS run_id, 0e0 AS shift UNION ALL SELECT 1, 0.5e0) r) p GROUP BY run_id, shift""",
        LABELLED,
        BASELINE,
    ),
    "table_count": sql(
        "sites address_fabric geofence_bridge poi reviews",
        " UNION ALL ".join(f"SELECT '{v}' AS table_name, count(*) AS n_rows FROM {v}" for v in ("sites", "address_fabric", "geofence_bridge", "poi", "reviews")),
    ),
    # projections, filters, null rules
    "project_keys": sql("geofence_bridge address_fabric population", f"SELECT site_id, addr_id, geoid, code, {', '.join(POPULATION)} FROM pop_rows", HOMES, POP_ROWS),
    "constant_country": sql("listings", "SELECT *, 'USA' AS country FROM listings"),
    "source_clean": sql("population", "SELECT * FROM family", _census("family", "fam")),
    "source_drop": sql("audience", f"SELECT code, {', '.join(AUDIENCE_ALL)} FROM audience"),
    "struct_expand": sql("address_fabric", "SELECT addr_id, round(lon + 1e-9, 6) AS lon, round(lat + 1e-9, 6) AS lat, zipcode FROM address_fabric"),
    "address_map": sql(
        "listings",
        """SELECT listing_id, 'address' AS field, address AS content FROM listings
UNION ALL SELECT listing_id, 'zipcode', CAST(zipcode AS VARCHAR) FROM listings
UNION ALL SELECT listing_id, 'country', 'USA' FROM listings""",
    ),
    "brand_sites": sql("poi", "SELECT * FROM poi WHERE business_line LIKE '%widget%'"),
    "geocoded_only": sql(
        "listings address_fabric",
        "SELECT listing_id, k.addr_id AS addr_id, round(k.lon + 1e-9, 6) AS x, round(k.lat + 1e-9, 6) AS y FROM exact",
        ASKED,
        KNOWN,
        EXACT,
    ),
    "split_property": sql(
        "geofence_bridge address_fabric",
        "SELECT b.addr_id, b.site_id, f.prop_type FROM geofence_bridge b LEFT JOIN address_fabric f ON b.addr_id = f.addr_id WHERE f.prop_type IN ('R', 'B')",
    ),
    "related_pois": sql("poi", "SELECT * FROM poi WHERE group_name = 'ECONOMY'"),
    "brand_pois": sql("poi", "SELECT DISTINCT * FROM poi WHERE brandname = 'Brand#2'"),
    "keep_common": sql("reviews sites", "SELECT r.*, r.site_id IN (SELECT site_id FROM sites) AS is_site FROM reviews r"),
    "dropna_subset": sql("poi", "SELECT * FROM poi WHERE sales_volume_local IS NOT NULL"),
    "fill_zero": sql("poi", "SELECT * REPLACE (coalesce(sales_volume_local, 0) AS sales_volume_local) FROM poi"),
    "drop_null_columns": sql("poi", "SELECT * EXCLUDE (sales_volume_local) FROM poi"),
    "cast_xy": sql("sites", "SELECT site_id, round(CASE WHEN price < 1000 THEN NULL ELSE x END + 1e-9, 6) AS x, round(y + 1e-9, 6) AS y FROM sites"),
    "feature_list": sql(
        "geofence_bridge address_fabric population",
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS feature, count(*) AS n_rows, count(*) - count({c}) AS n_null FROM pop_rows" for i, c in enumerate(POPULATION_ALL)
        ),
        HOMES,
        POP_ROWS,
    ),
    "sampled_features": sql(
        "address_fabric population consumer_spend audience",
        f"""SELECT x.addr_id, {', '.join([f'a.{c}' for c in AUDIENCE] + [f's.{c}' for c in SPEND] + [f'f.{c}' for c in FAMILY] + [f'i.{c}' for c in INCOME] + [f'p.{c}' for c in POPULATION])}
FROM address_fabric x LEFT JOIN audience a ON x.geoid = a.code LEFT JOIN consumer_spend s ON x.addr_id = s.addr_id
LEFT JOIN family f ON x.addr_id = f.addr_id LEFT JOIN income i ON x.addr_id = i.addr_id LEFT JOIN population p ON x.addr_id = p.addr_id""",
        _census("family", "fam"),
        _census("income", "inc"),
    ),
    "feature_lineage": sql(
        "population consumer_spend audience",
        " UNION ALL ".join(
            [
                _counted("audience", AUDIENCE_ALL, "audience"),
                _counted("consumer_spend", SPEND_ALL, "spend"),
                _counted("family", ["fam_popby", *[f"fam_f{i}" for i in range(1, 8)]], "family"),
                _counted("income", ["inc_popby", *[f"inc_f{i}" for i in range(1, 8)]], "income"),
                _counted("population", POPULATION_ALL, "population"),
            ]
        ),
        _census("family", "fam"),
        _census("income", "inc"),
    ),
    "dup_columns": sql(
        "geofence_bridge address_fabric population",
        """SELECT 'addr_id' AS column_name, 2 AS copies, CAST(count(h.addr_id) + count(p.addr_id) AS BIGINT) AS non_null
FROM homes h LEFT JOIN population p ON h.addr_id = p.addr_id
UNION ALL """
        + " UNION ALL ".join(f"SELECT '{c}', 1, count({c}) FROM pop_rows" for c in ["site_id", "prop_type", "zipcode", "geoid", "code", *POPULATION_ALL]),
        HOMES,
        POP_ROWS,
    ),
    "poi_catalogue": sql("poi", "SELECT DISTINCT brandname, business_line, group_name FROM poi"),
    "prop_types": sql("address_fabric", "SELECT DISTINCT prop_type FROM address_fabric"),
    # joins
    "join_left_property": sql("geofence_bridge address_fabric", "SELECT b.addr_id, b.site_id, f.prop_type FROM geofence_bridge b LEFT JOIN address_fabric f ON b.addr_id = f.addr_id"),
    "join_left_spend": sql("geofence_bridge address_fabric consumer_spend", "SELECT * FROM spend_rows", HOMES, SPEND_ROWS),
    "join_left_population": sql(
        "geofence_bridge address_fabric population", "SELECT * FROM pop_rows", HOMES, POP_ROWS
    ),
    "join_left_audience": sql("geofence_bridge address_fabric audience", "SELECT * FROM aud_rows", HOMES, AUD_ROWS),
    "join_left_family": sql(
        "geofence_bridge address_fabric population",
        f"SELECT h.*, f.addr_id AS family_addr_id, f.code, f.fam_popby, {', '.join(f'f.fam_f{i}' for i in range(1, 8))} FROM homes h LEFT JOIN family f ON h.addr_id = f.addr_id",
        HOMES,
        _census("family", "fam"),
    ),
    "join_left_income": sql(
        "geofence_bridge address_fabric population",
        f"SELECT h.*, f.addr_id AS income_addr_id, f.code, f.inc_popby, {', '.join(f'f.inc_f{i}' for i in range(1, 8))} FROM homes h LEFT JOIN income f ON h.addr_id = f.addr_id",
        HOMES,
        _census("income", "inc"),
    ),
    "residential_addresses": sql(
        "geofence_bridge address_fabric",
        "SELECT DISTINCT b.site_id, f.prop_type, f.addr_id, f.zipcode, f.geoid FROM geofence_bridge b LEFT JOIN address_fabric f ON b.addr_id = f.addr_id WHERE f.prop_type IS NOT NULL",
    ),
    "join_inner_poi": sql(
        SHOP_VIEWS, "SELECT b.site_id, f.zipcode, p.* FROM geofence_bridge b JOIN address_fabric f ON b.addr_id = f.addr_id JOIN poi p ON p.addr_id = b.addr_id WHERE f.prop_type = 'B'"
    ),
    "join_inner_labels": sql(f"{SHOP_VIEWS} reviews", "SELECT s.*, r.review_count, r.stars FROM shops s JOIN reviews r ON s.site_id = r.site_id", SHOPS),
    "assemble_features": sql(
        "geofence_bridge address_fabric population audience",
        """SELECT p.site_id, p.avg_popby, p.max_popby, a.avg_ap_f1, a.median_ap_f1, b.code_cnt
FROM (SELECT site_id, round(avg(popby) + 1e-9, 6) AS avg_popby, max(popby) AS max_popby FROM pop_rows GROUP BY site_id) p
LEFT JOIN (SELECT site_id, round(avg(ap_f1) + 1e-9, 6) AS avg_ap_f1, quantile_disc(ap_f1, 0.5) AS median_ap_f1 FROM aud_rows GROUP BY site_id) a ON p.site_id = a.site_id
LEFT JOIN blocks b ON p.site_id = b.site_id""",
        HOMES,
        POP_ROWS,
        AUD_ROWS,
        BLOCKS,
    ),
    "key_diff": sql(
        "reviews sites",
        """SELECT site_id, 'reviews' AS found_in FROM (SELECT site_id FROM reviews EXCEPT SELECT site_id FROM sites) a
UNION ALL SELECT site_id, 'sites' FROM (SELECT site_id FROM sites EXCEPT SELECT site_id FROM reviews) b""",
    ),
    "training_matrix": sql(
        f"{RES_VIEWS} poi reviews sites",
        "SELECT s.*, l.review_count, l.stars, r.* EXCLUDE (site_id) FROM shops s JOIN reviews l ON s.site_id = l.site_id JOIN res r ON s.site_id = r.site_id",
        TRAINING_BRIDGE,
        HOMES.replace("geofence_bridge b", "site_bridge b"),
        *RES_CTES,
        _shop_points("site_bridge"),
    ),
    "ranked_with_attributes": sql("sites reviews", "SELECT c.site_id, c.stars_score, s.name, s.price, s.size_sqft FROM scores c LEFT JOIN sites s ON c.site_id = s.site_id", SCORES),
    "winners": sql(
        "sites reviews",
        """SELECT c.site_id, c.stars_score, s.name, round(s.x + 1e-9, 6) AS x, round(s.y + 1e-9, 6) AS y, s.price
FROM (SELECT * FROM scores ORDER BY stars_score DESC NULLS LAST, site_id LIMIT 3) c JOIN sites s ON c.site_id = s.site_id""",
        SCORES,
    ),
    "geofence_octagon": sql(FENCE_VIEWS, "SELECT * FROM fence", OCTAGON_CTE, SIDES, FENCE),
    "geofence_geojson": sql(
        FENCE_VIEWS,
        """SELECT f.site_id, f.addr_id FROM fence f LEFT JOIN in_hole h ON f.site_id = h.site_id AND f.addr_id = h.addr_id WHERE h.addr_id IS NULL
UNION SELECT s.site_id, f.addr_id FROM sites s JOIN address_fabric f ON f.lon BETWEEN s.x + 0.04e0 AND s.x + 0.06e0 AND f.lat BETWEEN s.y + 0e0 AND s.y + 0.02e0""",
        OCTAGON_CTE,
        SIDES,
        HOLE_SIDES,
        FENCE,
        f"in_hole AS (SELECT s.site_id, f.addr_id FROM hole_sides s CROSS JOIN address_fabric f GROUP BY s.site_id, f.addr_id HAVING min({_CROSS}) > 0)",
    ),
    # aggregations
    "locs_in_fence": sql(FENCE_VIEWS, "SELECT site_id, count(*) AS locs_in_fence FROM fence GROUP BY site_id", OCTAGON_CTE, SIDES, FENCE),
    "property_counts": sql(
        "geofence_bridge address_fabric",
        """SELECT (SELECT count(*) FROM typed WHERE prop_type = 'R') AS n_res, (SELECT count(*) FROM typed WHERE prop_type = 'B') AS n_bus""",
        "typed AS (SELECT f.prop_type FROM geofence_bridge b LEFT JOIN address_fabric f ON b.addr_id = f.addr_id)",
    ),
    "census_blocks": sql("geofence_bridge address_fabric population", "SELECT * FROM blocks", HOMES, POP_ROWS, BLOCKS),
    "stats_population": _stats_sql("geofence_bridge address_fabric population", POP_ROWS, "pop_rows", POPULATION, FOUR),
    "stats_spend": _stats_sql("geofence_bridge address_fabric consumer_spend", SPEND_ROWS, "spend_rows", SPEND, FOUR),
    "stats_audience": _stats_sql("geofence_bridge address_fabric audience", AUD_ROWS, "aud_rows", AUDIENCE, FOUR),
    "median_population": _stats_sql("geofence_bridge address_fabric population", POP_ROWS, "pop_rows", POPULATION, ["median"]),
    "median_spend": _stats_sql("geofence_bridge address_fabric consumer_spend", SPEND_ROWS, "spend_rows", SPEND, ["median"]),
    "median_audience": _stats_sql("geofence_bridge address_fabric audience", AUD_ROWS, "aud_rows", AUDIENCE, ["median"]),
    "related_count": sql(SHOP_VIEWS, "SELECT site_id, related_businesses_count FROM related", SHOPS),
    "all_business_count": sql(SHOP_VIEWS, "SELECT * FROM everything", SHOPS),
    "brand_count": sql(SHOP_VIEWS, "SELECT * FROM branded", SHOPS),
    "avg_employee_here": sql(SHOP_VIEWS, "SELECT site_id, round(avg_employee_here + 1e-9, 6) AS avg_employee_here FROM related", SHOPS),
    "avg_employee_count": sql(SHOP_VIEWS, "SELECT site_id, round(avg_employee_count + 1e-9, 6) AS avg_employee_count FROM related", SHOPS),
    "avg_sales": sql(SHOP_VIEWS, "SELECT site_id, round(avg_sales_volume_usd + 1e-9, 6) AS avg_sales_volume_usd FROM related", SHOPS),
    "business_features": sql(SHOP_VIEWS, "SELECT * FROM shops", SHOPS),
    "residential_features": sql(RES_VIEWS, "SELECT * FROM res", HOMES, *RES_CTES),
    "dedupe_rows": sql("geofence_bridge", "SELECT DISTINCT * FROM geofence_bridge"),
    "dedupe_key": sql(
        "poi",
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY addr_id ORDER BY brandname NULLS FIRST, group_name NULLS FIRST,
business_line NULLS FIRST, employee_here NULLS FIRST, employee_count NULLS FIRST, sales_volume_usd NULLS FIRST, sales_volume_local NULLS FIRST) AS rn FROM poi) d WHERE rn = 1""",
    ),
    "min_max_scale": sql("sites", f"SELECT site_id, price, size_sqft, round({_scaled('price')} + 1e-9, 6) AS adj_price, round({_scaled('size_sqft')} + 1e-9, 6) AS adj_size_sqft FROM sites"),
    "metric_mape": sql("sites reviews", f"SELECT round({_MAPE} + 1e-9, 6) AS mape FROM baseline", LABELLED, BASELINE),
    "metric_mae": sql("sites reviews", f"SELECT round({_MAE} + 1e-9, 6) AS mae FROM baseline", LABELLED, BASELINE),
    "metric_rmse": sql("sites reviews", f"SELECT round({_RMSE} + 1e-9, 6) AS rmse FROM baseline", LABELLED, BASELINE),
    # sorts, samples, splits
    "smallest_fences": sql("geofence_bridge", "SELECT site_id, count(*) AS locs_in_fence FROM geofence_bridge GROUP BY site_id ORDER BY locs_in_fence, site_id"),
    "ranked_sites": sql("sites reviews", "SELECT * FROM scores ORDER BY stars_score DESC NULLS LAST, site_id", SCORES),
    "top_sites": sql("sites reviews", "SELECT * FROM scores ORDER BY stars_score DESC NULLS LAST, site_id LIMIT 3", SCORES),
    "sample_hash": sql("sites", f"SELECT site_id, name FROM sites WHERE {_bucket('site_id')} < 500"),
    "train_test_split": sql("sites", f"SELECT site_id, CASE WHEN {_IN_TEST} THEN 'test' ELSE 'train' END AS part FROM sites"),
    # scores and geometry
    "combined_score": sql(
        f"{SHOP_VIEWS} sites reviews",
        f"""SELECT site_id, round(2e0 * {_scaled('stars_score')} + 1e0 * {_scaled('median_sales_volume_local')} - 2e0 * {_scaled('price')} + 0.5e0 * {_scaled('size_sqft')} + 1e-9, 6) AS score,
       stars_score, median_sales_volume_local, price, size_sqft
FROM (SELECT c.site_id, c.stars_score, s.price, s.size_sqft, m.median_sales_volume_local
      FROM scores c LEFT JOIN sites s ON c.site_id = s.site_id LEFT JOIN sales m ON c.site_id = m.site_id) t""",
        SCORES,
        _SALES.format(bridge="geofence_bridge"),
    ),
    "geojson_roundtrip": sql("sites", "SELECT s.site_id, o.i, round(s.x + o.ux * 0.03e0 + 1e-9, 6) AS vx, round(s.y + o.uy * 0.03e0 + 1e-9, 6) AS vy FROM sites s CROSS JOIN octagon o", OCTAGON_CTE),
    "point_in_polygon": sql(
        f"{FENCE_VIEWS} geofence_bridge",
        f"""SELECT b.site_id, b.addr_id, min({_CROSS}) >= 0 AS inside FROM (SELECT DISTINCT * FROM geofence_bridge) b
JOIN sides s ON b.site_id = s.site_id JOIN address_fabric f ON b.addr_id = f.addr_id GROUP BY b.site_id, b.addr_id""",
        OCTAGON_CTE,
        SIDES,
    ),
    # geocoding, boundaries, roads
    "geocode_exact": sql("listings address_fabric", _geocode(_EXACT_ROWS), ASKED, KNOWN, EXACT),
    "geocode_fuzzy": sql("listings address_fabric", _geocode(f"{_EXACT_ROWS} UNION ALL SELECT listing_id, k, 'spelling' FROM near"), ASKED, KNOWN, EXACT, NEAR),
    "geocode_parsed": sql(
        "listings address_fabric",
        """SELECT q.listing_id, h.addr_id,
       round(CASE WHEN h.addr_id IS NOT NULL THEN h.lon WHEN m.street IS NULL THEN z.lon WHEN lo.number IS NULL THEN hi.lon WHEN hi.number IS NULL THEN lo.lon
             ELSE lo.lon + CAST(q.number - lo.number AS DOUBLE) / (hi.number - lo.number) * (hi.lon - lo.lon) END + 1e-9, 6) AS x,
       round(CASE WHEN h.addr_id IS NOT NULL THEN h.lat WHEN m.street IS NULL THEN z.lat WHEN lo.number IS NULL THEN hi.lat WHEN hi.number IS NULL THEN lo.lat
             ELSE lo.lat + CAST(q.number - lo.number AS DOUBLE) / (hi.number - lo.number) * (hi.lat - lo.lat) END + 1e-9, 6) AS y,
       h.address_line AS formatted_address,
       CASE WHEN h.addr_id IS NOT NULL THEN CASE WHEN m.street = q.street THEN 'exact' ELSE 'spelling' END
            WHEN m.street IS NOT NULL THEN CASE WHEN lo.number IS NULL OR hi.number IS NULL THEN 'street' ELSE 'interpolated' END
            WHEN z.zipcode IS NOT NULL THEN 'postcode' END AS precision,
       CASE WHEN z.zipcode IS NULL THEN 'no match' END AS error
FROM q LEFT JOIN meant m ON m.listing_id = q.listing_id
LEFT JOIN houses h ON h.zipcode = q.zipcode AND h.street = m.street AND h.number = q.number
LEFT JOIN low l ON l.listing_id = q.listing_id LEFT JOIN houses lo ON lo.zipcode = q.zipcode AND lo.street = m.street AND lo.number = l.number
LEFT JOIN high g ON g.listing_id = q.listing_id LEFT JOIN houses hi ON hi.zipcode = q.zipcode AND hi.street = m.street AND hi.number = g.number
LEFT JOIN centre z ON z.zipcode = q.zipcode""",
        f"""q AS (
SELECT listing_id, zipcode, CAST(nullif(regexp_extract(line, '^([0-9]+) ', 1), '') AS BIGINT)
       + CASE WHEN listing_id % 5 = 2 THEN 97 WHEN listing_id % 5 = 3 THEN 1000000 ELSE 0 END AS number, regexp_replace(line, '^[0-9]+ ', '') AS street
FROM (SELECT listing_id, zipcode, {_line('address')} AS line FROM listings) a)""",
        f"""known AS (
SELECT addr_id, lon, lat, zipcode, address_line, CAST(regexp_extract(line, '^([0-9]+) ', 1) AS BIGINT) AS number, regexp_replace(line, '^[0-9]+ ', '') AS street
FROM (SELECT *, {_line('address_line')} AS line FROM address_fabric) f)""",
        "houses AS (SELECT zipcode, street, number, min(addr_id) AS addr_id, arg_min(lon, addr_id) AS lon, arg_min(lat, addr_id) AS lat, arg_min(address_line, addr_id) AS address_line FROM known GROUP BY ALL)",
        "streets AS (SELECT DISTINCT zipcode, street FROM known)",
        """meant AS (
SELECT q.listing_id, min({'edits': levenshtein(q.street, s.street), 'street': s.street}).street AS street FROM q JOIN streets s ON q.zipcode = s.zipcode
WHERE q.number IS NOT NULL AND levenshtein(q.street, s.street) <= 2 GROUP BY q.listing_id)""",
        "low AS (SELECT q.listing_id, max(h.number) AS number FROM q JOIN meant m USING (listing_id) JOIN houses h ON h.zipcode = q.zipcode AND h.street = m.street AND h.number <= q.number GROUP BY ALL)",
        "high AS (SELECT q.listing_id, min(h.number) AS number FROM q JOIN meant m USING (listing_id) JOIN houses h ON h.zipcode = q.zipcode AND h.street = m.street AND h.number >= q.number GROUP BY ALL)",
        "centre AS (SELECT zipcode, avg(lon) AS lon, avg(lat) AS lat FROM address_fabric GROUP BY zipcode)",
    ),
    "travel_boundary": sql(
        "sites",
        """SELECT s.site_id, o.i, round(s.x + o.ux * r.corner / cos(radians(s.y)) + 1e-9, 6) AS vx, round(s.y + o.uy * r.corner + 1e-9, 6) AS vy
FROM (SELECT 2.5e0 / 69e0 * sqrt(4e0 - 2e0 * sqrt(2e0)) AS corner) r CROSS JOIN sites s CROSS JOIN octagon o""",
        OCTAGON_CTE,
    ),
    "network_reach": sql(
        "sites edges driveways",
        """SELECT w.source AS site_id, d.addr_id, round(min(w.minutes + d.miles / 2.5e0 * 60e0) + 1e-9, 6) AS minutes FROM ways w JOIN driveways d ON w.node = d.node
WHERE d.miles <= 0.1e0 AND w.minutes + d.miles / 2.5e0 * 60e0 <= 5 GROUP BY w.source, d.addr_id""",
        """ways(source, node, minutes) AS (
SELECT site_id, site_id * 3, 0e0 FROM sites
UNION SELECT w.source, e.dst, w.minutes + e.minutes FROM ways w JOIN edges e ON w.node = e.src WHERE w.minutes + e.minutes <= 5)""",
        recursive=True,
    ),
    "network_boundary": sql(
        "sites edges address_fabric",
        """SELECT c.source AS site_id, c.cells, 4 * c.cells - 2 * coalesce(n.pairs, 0) AS sides, v.corners,
       round(c.x0 / 128e0 + 1e-9, 6) AS min_x, round(c.x1 / 128e0 + 1e-9, 6) AS max_x, round(c.y0 / 128e0 + 1e-9, 6) AS min_y, round(c.y1 / 128e0 + 1e-9, 6) AS max_y
FROM (SELECT source, count(*) AS cells, min(cx) AS x0, max(cx) + 1 AS x1, min(cy) AS y0, max(cy) + 1 AS y1 FROM cells GROUP BY source) c
JOIN corners v ON v.source = c.source LEFT JOIN pairs n ON n.source = c.source""",
        *ROAD_CELLS,
        """pairs AS (
SELECT a.source, count(*) AS pairs FROM cells a JOIN cells b ON a.source = b.source AND ((b.cx = a.cx + 1 AND b.cy = a.cy) OR (b.cx = a.cx AND b.cy = a.cy + 1))
GROUP BY a.source)""",
        # the cells around a grid point, one bit each: one or three make a corner, two across make two
        """around AS (
SELECT source, cx + q.i AS vx, cy + q.j AS vy, sum(q.bit) AS mask FROM cells, (VALUES (0, 0, 1), (1, 1, 2), (1, 0, 4), (0, 1, 8)) q(i, j, bit)
GROUP BY source, cx + q.i, cy + q.j)""",
        """corners AS (
SELECT source, CAST(sum(CASE WHEN mask IN (3, 12) THEN 2 WHEN mask IN (5, 6, 9, 10, 15) THEN 0 ELSE 1 END) AS BIGINT) AS corners FROM around GROUP BY source)""",
        recursive=True,
    ),
    "geofence_network": sql(
        "sites edges address_fabric",
        """SELECT DISTINCT c.source AS site_id, f.addr_id FROM cells c JOIN near f ON c.cx = f.cx AND c.cy = f.cy""",
        *ROAD_CELLS,
        # a point on a grid line belongs to the cells on both sides
        """near AS (
SELECT addr_id, cx, unnest([CAST(floor(lat * 128) AS BIGINT), CAST(ceil(lat * 128) AS BIGINT) - 1]) AS cy
FROM (SELECT addr_id, lat, unnest([CAST(floor(lon * 128) AS BIGINT), CAST(ceil(lon * 128) AS BIGINT) - 1]) AS cx FROM address_fabric) f)""",
        recursive=True,
    ),
    "route_cost": sql(
        "edges geofence_bridge",
        """SELECT p.from_node, p.to_node, round(c.best.miles + 1e-9, 6) AS distance, round(c.best.minutes + 1e-9, 6) AS minutes
FROM (SELECT DISTINCT site_id * 3 AS from_node, addr_id AS to_node FROM geofence_bridge) p
LEFT JOIN (SELECT source, node, min({'minutes': minutes, 'miles': miles}) AS best FROM ways GROUP BY source, node) c
ON p.from_node = c.source AND p.to_node = c.node""",
        WAYS.format(start="site_id * 3", origin="geofence_bridge"),
        recursive=True,
    ),
    "geofence_stream": sql(FENCE_VIEWS, "SELECT * FROM fence", OCTAGON_CTE, SIDES, FENCE),
    # models
    "scaled_features": sql(
        SHOP_VIEWS,
        "SELECT s.site_id, " + ", ".join(f"round((s.{c} - t.m_{c}) / nullif(t.d_{c}, 0) + 1e-9, 6) AS {c}" for c in _MATRIX_NAMES) + " FROM plain s, t",
        SHOPS,
        """plain AS (
SELECT r.site_id, r.related_businesses_count, coalesce(r.avg_employee_here, 0) AS avg_employee_here, coalesce(r.avg_employee_count, 0) AS avg_employee_count,
       coalesce(e.all_businesses_count, 0) AS all_businesses_count, coalesce(b.brand_count, 0) AS brand_count, coalesce(r.avg_sales_volume_usd, 0) AS avg_sales_volume_usd
FROM related r LEFT JOIN everything e ON r.site_id = e.site_id LEFT JOIN branded b ON r.site_id = b.site_id)""",
        "t AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in _MATRIX_NAMES) + f" FROM plain WHERE NOT {_IN_TEST})",
    ),
    "best_run": sql(
        "sites reviews",
        f"""SELECT run_id, weight, round({_RMSE} + 1e-9, 6) AS rmse, round({_MAPE} + 1e-9, 6) AS mape, round({_MAE} + 1e-9, 6) AS mae
FROM (SELECT r.run_id, r.weight, l.stars, r.weight * b.prediction + (1 - r.weight) * (SELECT avg(stars) FROM labelled) AS prediction
      FROM labelled l JOIN baseline b ON l.site_id = b.site_id, (VALUES (0, 0e0), (1, 0.25e0), (2, 0.5e0), (3, 0.75e0), (4, 1e0)) r(run_id, weight)) p
GROUP BY run_id, weight ORDER BY round({_MAPE}, 9), run_id LIMIT 1""",
        LABELLED,
        BASELINE,
    ),
    "median_local_sales": sql(
        f"{SHOP_VIEWS} sites",
        "SELECT * FROM sales",
        "site_bridge AS (SELECT b.* FROM geofence_bridge b JOIN sites s ON b.site_id = s.site_id WHERE s.is_candidate)",
        _SALES.format(bridge="site_bridge"),
    ),
    # the whole way from address text
    "matrix_from_listings": sql(CHAIN_VIEWS, "SELECT s.*, r.* EXCLUDE (site_id) FROM shops s JOIN res r ON s.site_id = r.site_id", *CHAIN),
    "ranking_from_listings": sql(
        CHAIN_VIEWS,
        f"""SELECT site_id, round(2e0 * {_scaled('stars_score')} + 1e0 * {_scaled('median_sales_volume_local')} - 2e0 * {_scaled('price')} + 0.5e0 * {_scaled('size_sqft')} + 1e-9, 6) AS score,
       stars_score, median_sales_volume_local, price, size_sqft, formatted_address, round(x + 1e-9, 6) AS x, round(y + 1e-9, 6) AS y
FROM (SELECT l.*, c.stars AS stars_score, m.median_sales_volume_local
      FROM located l JOIN reviews c ON l.site_id = c.site_id LEFT JOIN sales m ON l.site_id = m.site_id
      WHERE l.site_id IN (SELECT s.site_id FROM shops s JOIN res r ON s.site_id = r.site_id)) t""",
        *CHAIN,
        _SALES.format(bridge="fence"),
    ),
    "fenced_stores_split": sql(
        "sites address_fabric population consumer_spend audience poi reviews",
        f"SELECT s.site_id, r.stars, {_IN_TEST.replace('site_id', 's.site_id')} AS in_test FROM shops s JOIN res USING (site_id) JOIN reviews r ON r.site_id = s.site_id",
        OCTAGON_CTE,
        _sides("sides", "0.03125e0").replace("FROM sites s CROSS JOIN octagon a", "FROM (SELECT * FROM sites WHERE NOT is_candidate) s CROSS JOIN octagon a"),
        FENCE,
        HOMES.replace("geofence_bridge b", "fence b"),
        *RES_CTES,
        _shop_points("fence"),
    ),
    "model_ranking_facts": sql(
        CHAIN_VIEWS,
        """SELECT l.site_id, l.formatted_address, round(l.x + 1e-9, 6) AS x, round(l.y + 1e-9, 6) AS y, l.price, l.size_sqft, m.median_sales_volume_local,
       true AS score_in_label_range
FROM located l LEFT JOIN sales m ON l.site_id = m.site_id WHERE l.site_id IN (SELECT s.site_id FROM shops s JOIN res r ON s.site_id = r.site_id)""",
        *CHAIN,
        _SALES.format(bridge="fence"),
    ),
}
ORACLES["resumed_geofence"] = ORACLES["batched_geofence"]
