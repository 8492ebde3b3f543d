"""The queries of the driver contract over the given tables, each with its DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placemetrics.functions import casts
from placemetrics.operators import cells, checks, membership, polygons, profile, reconcile, versions
from placemetrics import geo_sql as geo
from placemetrics.plans import activity, freshness, world
from placemetrics.plans.world import table
from placemetrics.sources import landing
from placemetrics.sources.zones import derived, stored

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- casts and scalars


@query("""SELECT l_orderkey, l_linenumber, trunc(try_cast(q AS DOUBLE))::BIGINT AS quantity, try_cast(p AS DOUBLE) AS price,
  try_cast(d AS DATE) AS shipped, coalesce(l_returnflag = 'R', false) AS returned, l_returnflag = 'A' AS accepted,
  100.0 * l_discount / nullif(l_tax, 0) AS pct, cast(date_trunc('month', try_cast(d AS DATE)) AS DATE) AS month
FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN 'unknown' ELSE l_quantity::BIGINT::VARCHAR || '.00000' END AS q,
  CASE WHEN l_linenumber = 3 THEN 'abc' ELSE l_extendedprice::VARCHAR END AS p,
  CASE WHEN l_linenumber = 3 THEN 'never' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS d FROM lineitem)""")
def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    li, junk = table(spark, sf, "lineitem"), F.col("l_linenumber") == 3
    q = F.when(junk, "unknown").otherwise(F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(".00000")))
    p, d = F.when(junk, "abc").otherwise(F.col("l_extendedprice").cast("string")), F.when(junk, "never").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    return li.select(
        "l_orderkey", "l_linenumber", casts.safe_int(q).alias("quantity"), casts.safe_number(p).alias("price"), casts.safe_cast(d, "date").alias("shipped"),
        casts.flag(F.col("l_returnflag"), "R").alias("returned"), casts.flag(F.col("l_returnflag"), "A", nullable=True).alias("accepted"),
        casts.percentage(F.col("l_discount"), F.col("l_tax")).alias("pct"), casts.month(d).alias("month"),
    )


@query("""SELECT json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing, count(*) AS n,
  round(avg(date_diff('second', ts, TIMESTAMP '2024-02-01') / 3600.0), 4) AS mean_age_hours FROM events GROUP BY 1, 2""")
def json_scalars(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("at", F.date_trunc("second", "ts").cast("timestamp_ntz"))
    age = casts.hours_between(F.col("at"), F.lit(world.NOW).cast("timestamp_ntz"))
    keyed = e.select(casts.json_scalar(F.col("props"), "$.k").alias("k"), casts.json_scalar(F.col("props"), "$.missing").alias("missing"), age.alias("age"))
    return keyed.groupBy("k", "missing").agg(F.count("*").alias("n"), F.round(F.avg("age"), 4).alias("mean_age_hours"))


# ---- versions

_VERSIONED = """v AS (SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type, '2024-03-01' AS ingested_at, 'first' AS version, ts AS updated_at FROM events
  UNION ALL SELECT event_id::VARCHAR, user_id::VARCHAR, event_type, '2024-03-02', 'second', ts FROM events WHERE event_id % 10 = 0)"""
_LATEST = f"WITH {_VERSIONED} SELECT event_id, user_id, event_type, ingested_at, version FROM v QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY updated_at DESC NULLS LAST, ingested_at DESC NULLS LAST) = 1"
_COLS = ["event_id", "user_id", "event_type", "ingested_at", "version"]


@query(_LATEST)
def latest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return versions.latest_by_key(world.versioned_events(spark, sf), ["event_id"], ["updated_at", "ingested_at"]).select(*_COLS)


@query(_LATEST)
def latest_by_max(spark: SparkSession, sf: str) -> DataFrame:
    return versions.latest_by_max(world.versioned_events(spark, sf), ["event_id"], ["updated_at", "ingested_at"]).select(*_COLS)


@query("SELECT event_id, user_id, event_type, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def single_newest(spark: SparkSession, sf: str) -> DataFrame:
    return versions.single_newest(table(spark, sf, "events"), ["ts", "event_id"]).select("event_id", "user_id", "event_type", "ts")


@query(f"WITH {_VERSIONED} SELECT event_id, user_id, event_type, ingested_at, version FROM v WHERE event_id IN (SELECT event_id FROM v WHERE ingested_at = '2024-03-02') QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY updated_at DESC, ingested_at DESC) = 1")
def touched_keys(spark: SparkSession, sf: str) -> DataFrame:
    v = world.versioned_events(spark, sf)
    return versions.touched(v, v.filter("ingested_at = '2024-03-02'"), ["event_id"], ["updated_at", "ingested_at"]).select(*_COLS)


@query("SELECT c_custkey, c_name, c_acctbal + CASE WHEN c_custkey % 7 = 0 THEN 100 ELSE 0 END AS c_acctbal FROM customer")
def keyed_merge(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return versions.merge(c, c.filter("c_custkey % 7 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 100), ["c_custkey"])


@query("SELECT 'events' AS table_name, count(DISTINCT event_id)::BIGINT AS rows, max(event_id) AS watermark FROM events")
def input_state(spark: SparkSession, sf: str) -> DataFrame:
    return versions.input_state(table(spark, sf, "events"), "event_id", "event_id", "events")


# ---- coordinates, cells, polygons

_POINTS = """p AS (SELECT c_custkey AS k, c_custkey % 97 AS bad, 37.6::DOUBLE + ((c_custkey * 7919) % 33000) / 1e5::DOUBLE AS la, -123.2::DOUBLE + ((c_custkey * 104729) % 92000) / 1e5::DOUBLE AS lo FROM customer),
s AS (SELECT k, CASE bad WHEN 1 THEN 'missing' WHEN 2 THEN 'unparseable' WHEN 3 THEN 'impossible' WHEN 4 THEN 'out_of_bounds'
  ELSE CASE WHEN la BETWEEN 37.6 AND 37.93 AND lo BETWEEN -123.2 AND -122.28 THEN 'ok' ELSE 'out_of_bounds' END END AS status,
  CASE bad WHEN 4 THEN 33.954319593 ELSE la END::DOUBLE AS la, CASE bad WHEN 4 THEN -84.19922231 ELSE lo END::DOUBLE AS lo FROM p)"""
_X0, _Y0 = "(-123.2::DOUBLE + (n % 5) * 0.184::DOUBLE)", "(37.6::DOUBLE + (n // 5) * 0.066::DOUBLE)"
_X1, _Y1 = "(-123.2::DOUBLE + (n % 5 + 1) * 0.184::DOUBLE)", "(37.6::DOUBLE + (n // 5 + 1) * 0.066::DOUBLE)"
_MEMBER = f"""{_POINTS}, n AS (SELECT n_nationkey AS n FROM nation), t AS (SELECT n, {_X0} AS x0, {_Y0} AS y0, {_X1} AS x1, {_Y1} AS y1 FROM n),
m AS (SELECT k::VARCHAR AS row_key, 'nation' AS boundary_set, n::VARCHAR AS boundary_id FROM s JOIN t ON s.status = 'ok' AND lo >= x0 AND lo < x1 AND la >= y0 AND la < y1
  WHERE NOT (n = 0 AND lo >= x0 + 0.06::DOUBLE AND lo < x0 + 0.12::DOUBLE) AND NOT (n = 24 AND lo >= x0 + 0.09::DOUBLE AND la >= y0 + 0.03::DOUBLE)
    AND NOT (n = 12 AND lo >= x0 + 0.05::DOUBLE AND lo < x0 + 0.1::DOUBLE AND la >= y0 + 0.02::DOUBLE AND la < y0 + 0.04::DOUBLE)
  UNION ALL SELECT k::VARCHAR, 'region', r_regionkey::VARCHAR FROM s JOIN region ON s.status = 'ok' AND lo >= -123.2::DOUBLE AND lo < -123.2::DOUBLE + 5 * 0.184::DOUBLE
    AND la >= 37.6::DOUBLE + r_regionkey * 0.066::DOUBLE AND la < 37.6::DOUBLE + (r_regionkey + 1) * 0.066::DOUBLE)"""
_IN_NATION = """lo >= x0 AND lo < x1 AND la >= y0 AND la < y1 AND NOT (n = 0 AND lo >= x0 + 0.06::DOUBLE AND lo < x0 + 0.12::DOUBLE)
  AND NOT (n = 24 AND lo >= x0 + 0.09::DOUBLE AND la >= y0 + 0.03::DOUBLE) AND NOT (n = 12 AND lo >= x0 + 0.05::DOUBLE AND lo < x0 + 0.1::DOUBLE AND la >= y0 + 0.02::DOUBLE AND la < y0 + 0.04::DOUBLE)"""
_IN_REGION = """lo >= -123.2::DOUBLE AND lo < -123.2::DOUBLE + 5 * 0.184::DOUBLE AND la >= 37.6::DOUBLE + r_regionkey * 0.066::DOUBLE AND la < 37.6::DOUBLE + (r_regionkey + 1) * 0.066::DOUBLE"""
_ROOT = 3.0**0.5


def _cell_sql(resolution: int) -> str:
    s, c = cells.side(resolution), cells._COS
    return f"""SELECT k, ({resolution}::BIGINT * {1 << 58}::BIGINT + (cq::BIGINT + {1 << 27}) * {1 << 29}::BIGINT + (cr::BIGINT + {1 << 27}))::BIGINT AS cell FROM (
  SELECT k, CASE WHEN dq > dr AND dq > dt THEN -rr - rt ELSE rq END AS cq, CASE WHEN NOT (dq > dr AND dq > dt) AND dr > dt THEN -rq - rt ELSE rr END AS cr FROM (
    SELECT k, rq, rr, rt, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rt - t) AS dt FROM (
      SELECT k, q, r, -q - r AS t, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor(-q - r + 0.5) AS rt FROM (
        SELECT k, ({_ROOT / 3.0!r}::DOUBLE * x - y / 3.0::DOUBLE) / {s!r}::DOUBLE AS q, ({2.0 / 3.0!r}::DOUBLE * y) / {s!r}::DOUBLE AS r FROM (
          SELECT k, {cells.RADIUS * c!r}::DOUBLE * radians(lo) AS x, {cells.RADIUS / c!r}::DOUBLE * sin(radians(la)) AS y FROM s WHERE status IN ('ok', 'out_of_bounds'))))))"""


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return cells.points(world.coordinates(table(spark, sf, "customer"), "c_custkey"), "customer", "c_custkey", "lat_text", "lon_text")


def _point_table(spark: SparkSession, sf: str) -> DataFrame:
    """Points with their cells are a derived table; reading it keeps the cell formula out of every later plan."""
    return derived(spark, sf, "points", lambda: _points(spark, sf))


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "edges", lambda: polygons.edges(world.boundaries(spark, sf)))


def _ring_edges(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "ring-edges", lambda: polygons.edges(world.rings(spark, sf)))


def _ring_shapes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Edges of each distinct ring by its number, and the rings that have it."""
    shape = derived(spark, sf, "ring-shapes", lambda: polygons.shapes(world.rings(spark, sf)))
    edge = derived(spark, sf, "ring-shape-edges", lambda: polygons.edges(shape, ("shape",)))
    return edge, derived(spark, sf, "ring-owners", lambda: polygons.owners(world.rings(spark, sf), shape))


def _bridge(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "bridge", lambda: polygons.bridge(_edges(spark, sf), (8,), keep=stored))


def _ring_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "ring-bridge", lambda: ring_bridge(spark, sf))


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "assigned", lambda: membership.assign(_point_table(spark, sf), _bridge(spark, sf), _edges(spark, sf), 8))


@query(f"WITH {_POINTS} SELECT 'customer' AS source_table, count(*) AS total, " + ", ".join(f"count(*) FILTER (status = '{x}') AS {x}" for x in cells.STATUSES) + " FROM s")
def coordinate_status(spark: SparkSession, sf: str) -> DataFrame:
    return cells.status_breakdown(_points(spark, sf))


@query(f"WITH {_POINTS}, a AS ({_cell_sql(8)}), b AS ({_cell_sql(10)}) SELECT 'customer' AS source_table, s.k::VARCHAR AS row_key, status AS coordinate_status, status = 'ok' AS is_usable_coordinate, a.cell AS h3_r8, b.cell AS h3_r10 FROM s LEFT JOIN a ON a.k = s.k LEFT JOIN b ON b.k = s.k")
def point_cells(spark: SparkSession, sf: str) -> DataFrame:
    return _points(spark, sf).select("source_table", "row_key", "coordinate_status", "is_usable_coordinate", "h3_r8", "h3_r10")


@query(f"""WITH n AS (SELECT n_nationkey AS n FROM nation), t AS (SELECT n, {_X0} AS x0, {_Y0} AS y0, {_X1} AS x1, {_Y1} AS y1 FROM n),
r AS (SELECT n, x0, y0, x1, y1, 1 AS w FROM t WHERE n NOT IN (0, 24) UNION ALL SELECT n, x0, y0, x0 + 0.06, y1, 1 FROM t WHERE n = 0 UNION ALL SELECT n, x0 + 0.12, y0, x1, y1, 1 FROM t WHERE n = 0
  UNION ALL SELECT n, x0 + 0.05, y0 + 0.02, x0 + 0.1, y0 + 0.04, -1 FROM t WHERE n = 12 UNION ALL SELECT n, x0, y0, x1, y0 + 0.03, 1 FROM t WHERE n = 24 UNION ALL SELECT n, x0, y0 + 0.03, x0 + 0.09, y1, 1 FROM t WHERE n = 24)
SELECT 'nation' AS boundary_set, n::VARCHAR AS boundary_id, round(sum(w * radians(x1 - x0) * (sin(radians(y1)) - sin(radians(y0)))) * 6371.0088 * 6371.0088, 5) AS area_sq_km FROM r GROUP BY n""")
def polygon_area(spark: SparkSession, sf: str) -> DataFrame:
    return polygons.area(_edges(spark, sf)).filter("boundary_set = 'nation'").withColumn("area_sq_km", F.round("area_sq_km", 5))


@query(f"WITH {_MEMBER} SELECT 'customer' AS source_table, row_key, boundary_set, boundary_id FROM m")
def point_boundary(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf).drop("assignment_method")


@query(f"WITH {_MEMBER}, w AS (SELECT row_key, max(CASE WHEN boundary_set = 'nation' THEN boundary_id END) AS nation, max(CASE WHEN boundary_set = 'region' THEN boundary_id END) AS region FROM m GROUP BY 1) SELECT s.k::VARCHAR AS row_key, status AS coordinate_status, nation, region FROM s LEFT JOIN w ON w.row_key = s.k::VARCHAR")
def point_geography(spark: SparkSession, sf: str) -> DataFrame:
    return membership.point_geography(_points(spark, sf), _assigned(spark, sf), world.SETS).select("row_key", "coordinate_status", *world.SETS)


_SAMPLE = "few AS (SELECT k, la, lo FROM s WHERE status = 'ok' ORDER BY sha256(k::VARCHAR), k::VARCHAR LIMIT 500)"
_ASKED = "asked AS (SELECT few.k, b.boundary_set, la, lo FROM few, (VALUES ('nation'), ('region')) b(boundary_set))"


@query(f"""WITH {_MEMBER}, {_SAMPLE}, {_ASKED} SELECT 'customer' AS source_table, k::VARCHAR AS row_key, a.boundary_set, boundary_id AS exact_boundary_id, boundary_id AS stored_boundary_id
  FROM asked a LEFT JOIN m ON m.row_key = k::VARCHAR AND m.boundary_set = a.boundary_set""")
def membership_oracle(spark: SparkSession, sf: str) -> DataFrame:
    """A sample's answers against every polygon, without cells, beside the stored membership."""
    answers = membership.oracle(membership.sample(_point_table(spark, sf), 500), world.boundaries(spark, sf))
    held = _assigned(spark, sf).select("source_table", "row_key", "boundary_set", F.col("boundary_id").alias("stored_boundary_id"))
    return answers.join(held, ["source_table", "row_key", "boundary_set"], "left").select("source_table", "row_key", "boundary_set", "exact_boundary_id", "stored_boundary_id")


@query(f"""WITH {_MEMBER}, {_SAMPLE}, {_ASKED} SELECT a.boundary_set, count(*) FILTER (a.k % 5 = 0 AND m.boundary_id IS NOT NULL) AS disagreeing
  FROM asked a LEFT JOIN m ON m.row_key = k::VARCHAR AND m.boundary_set = a.boundary_set GROUP BY 1""")
def membership_disagreement(spark: SparkSession, sf: str) -> DataFrame:
    """The failing side of the exactness check: stored membership that lost every fifth point's places is found out."""
    answers = membership.oracle(membership.sample(_point_table(spark, sf), 500), world.boundaries(spark, sf))
    spoilt = _assigned(spark, sf).filter("cast(row_key as bigint) % 5 <> 0")
    wrong = membership.disagreement(answers, spoilt).groupBy("boundary_set").agg(F.count("*").alias("n"))
    return answers.select("boundary_set").distinct().join(wrong, "boundary_set", "left").select("boundary_set", F.coalesce("n", F.lit(0).cast("long")).alias("disagreeing"))


@query(f"""WITH {_MEMBER}, {_SAMPLE}, {_ASKED} SELECT 'customer' AS source_table, k::VARCHAR AS row_key, a.boundary_set, boundary_id AS exact_boundary_id
  FROM asked a LEFT JOIN m ON m.row_key = k::VARCHAR AND m.boundary_set = a.boundary_set""")
def membership_oracle_reused(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of a cache are kept but for moved points and for sets whose polygons moved: wrong ones planted there must not survive."""
    few, b = membership.sample(_point_table(spark, sf), 500), world.boundaries(spark, sf)
    old = stored(membership.oracle(few, b), "answers")
    wrong = (F.col("boundary_set") == "region") | (F.col("row_key").cast("long") % 3 == 0)
    spoilt = old.withColumns({"exact_boundary_id": F.when(wrong, "none").otherwise(F.col("exact_boundary_id")), "latitude": F.when(wrong & (F.col("boundary_set") == "nation"), F.col("latitude") + 1).otherwise(F.col("latitude"))})
    again = membership.oracle(few, b, cache=spoilt, moved=b.filter("boundary_set = 'region'"))
    return again.select("source_table", "row_key", "boundary_set", "exact_boundary_id")


@query(f"""WITH {_MEMBER}, {_SAMPLE}, {_ASKED}, {geo.cell_of("few", "lo", "la", 8, "fc")}, mid AS (SELECT fc.k, {geo.center_lon("q", "r", 8)} AS lo, {geo.center_lat("r", 8)} AS la FROM fc),
c AS (SELECT k, 'nation' AS boundary_set, min(n::VARCHAR) AS cell_id FROM mid JOIN t ON {_IN_NATION} GROUP BY 1 UNION ALL SELECT k, 'region', min(r_regionkey::VARCHAR) FROM mid JOIN region ON {_IN_REGION} GROUP BY 1),
n2 AS (SELECT a.boundary_set, count(*) AS points, count(*) FILTER (m.boundary_id IS NOT DISTINCT FROM c.cell_id) AS agreeing FROM asked a
  LEFT JOIN m ON m.row_key = a.k::VARCHAR AND m.boundary_set = a.boundary_set LEFT JOIN c ON c.k = a.k AND c.boundary_set = a.boundary_set GROUP BY 1)
SELECT *, agreeing / points AS agreement, agreeing / points >= CASE boundary_set WHEN 'nation' THEN 0.9 ELSE 0.94 END AS passes FROM n2""")
def cell_agreement(spark: SparkSession, sf: str) -> DataFrame:
    answers = membership.oracle(membership.sample(_point_table(spark, sf), 500), world.boundaries(spark, sf))
    return membership.cell_agreement(answers, _bridge(spark, sf), {"nation": 0.9, "region": 0.94}, 8)


@query(f"WITH {geo.EDGES}, {geo.bridge('e', (8,))} SELECT * FROM bridge")
def bridge(spark: SparkSession, sf: str) -> DataFrame:
    return polygons.bridge(_edges(spark, sf), (8,), keep=stored)


@query(f"WITH {geo.RING_EDGES}, {geo.bridge('e', (8, 10))} SELECT * FROM bridge")
def ring_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """Slanted, holed and tiny polygons at both resolutions."""
    edge, owned = _ring_shapes(spark, sf)
    return polygons.bridge(edge, (8, 10), ("shape",), stored, owned)


@query(f"WITH {geo.RING_EDGES}, {geo.bridge('e', (8, 10))} SELECT boundary_set, resolution, count(*) AS covering, count(*) FILTER (is_interior) AS interior, round(100.0 * count(*) FILTER (NOT is_interior) / count(*), 6) AS pct_on_boundary FROM bridge GROUP BY 1, 2")
def bridge_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return polygons.bridge_statistics(_ring_bridge(spark, sf)).withColumn("pct_on_boundary", F.round("pct_on_boundary", 6))


_ORDERED = _POINTS.replace("c_custkey", "o_orderkey").replace("customer", "orders")


@query(f"WITH {geo.RING_EDGES}, {_ORDERED}, usable AS (SELECT * FROM s WHERE status = 'ok') SELECT k::VARCHAR AS row_key, boundary_set, min(boundary_id) AS boundary_id FROM ({geo.inside('usable', 'e', ['k'], 'lo', 'la')}) GROUP BY 1, 2")
def ring_membership(spark: SparkSession, sf: str) -> DataFrame:
    """Orders' points in slanted polygons, by cells of resolution 10."""
    points = cells.points(world.coordinates(table(spark, sf, "orders"), "o_orderkey"), "orders", "o_orderkey", "lat_text", "lon_text")
    points = stored(points.select("source_table", "row_key", "latitude", "longitude", "is_usable_coordinate", "h3_r10"), "order-points")
    edge, owned = _ring_shapes(spark, sf)
    return membership.assign_by_runs(points, _ring_runs(spark, sf), edge, 10, stored, owned).select("row_key", "boundary_set", "boundary_id")


def _ring_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of each distinct ring."""
    return derived(spark, sf, "ring-runs", lambda: polygons.compact_cover(_ring_shapes(spark, sf)[0], 10, ("shape",), stored))


@query(f"WITH {geo.RING_EDGES}, {geo.bridge('e', (10,))} SELECT boundary_set, boundary_id, {geo.packed('q', 'r', 10)} AS h3_cell, is_center AND NOT is_touched AS is_interior FROM cov_10")
def compact_cover(spark: SparkSession, sf: str) -> DataFrame:
    """The cells that the runs of the compact cover stand for."""
    runs = _ring_runs(spark, sf).join(_ring_shapes(spark, sf)[1], "shape").withColumn("q", F.explode(F.sequence("q0", "q1")))
    return runs.select("boundary_set", "boundary_id", cells.pack(F.col("q"), F.col("r"), 10).alias("h3_cell"), "is_interior")


@query(f"WITH {geo.RING_EDGES} SELECT boundary_set, boundary_id, round(sum(CASE ring WHEN 0 THEN a ELSE -a END), 6) AS area_sq_km FROM (SELECT boundary_set, boundary_id, poly, ring, abs(sum(radians(x2 - x1) * (sin(radians(y1)) + sin(radians(y2))))) * {polygons.RADIUS**2 / 2.0!r}::DOUBLE AS a FROM e GROUP BY 1, 2, 3, 4) GROUP BY 1, 2")
def ring_area(spark: SparkSession, sf: str) -> DataFrame:
    return polygons.area(_ring_edges(spark, sf)).withColumn("area_sq_km", F.round("area_sq_km", 6))


@query(f"WITH {_MEMBER}, {geo.centers_of('nation', 8)}, held AS (SELECT n, count(*) AS k FROM mine GROUP BY 1), pc AS (SELECT c_nationkey AS n, count(*) AS people, count(*) FILTER (c_acctbal > 0) AS homes FROM customer GROUP BY 1) SELECT 8 AS resolution, {geo.packed('q', 'r', 8)} AS h3_cell, round(people / k, 6) AS population, round(homes / k, 6) AS housing_units FROM mine JOIN held USING (n) JOIN pc USING (n)")
def cell_population(spark: SparkSession, sf: str) -> DataFrame:
    return _cells(spark, sf).withColumns({c: F.round(c, 6) for c in ("population", "housing_units")})


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    """People and housing units of every cell, spread from the nations."""
    return derived(spark, sf, "cell-population", lambda: membership.interpolate(world.residents(spark, sf), _bridge(spark, sf), ["population", "housing_units"], "nation"))


@query("""SELECT 'all' AS spread, 8 AS resolution, sum(n)::DOUBLE AS allocated, max(people)::DOUBLE AS expected, abs(sum(n) - max(people)) <= 1 AS passes FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), (SELECT count(*) AS people FROM customer)
UNION ALL SELECT 'without one', 8, count(*) FILTER (c_nationkey <> 3), count(*), abs(count(*) FILTER (c_nationkey = 3)) <= 1 FROM customer""")
def population_conserved(spark: SparkSession, sf: str) -> DataFrame:
    """What is spread over cells is what there was; a spread that loses a nation is found out."""
    people = world.residents(spark, sf)
    lossy = membership.interpolate(people.filter("boundary_id <> '3'"), _bridge(spark, sf), ["population"], "nation")
    parts = [membership.conserved(c.select("resolution", "population"), people, "population").withColumn("spread", F.lit(n)) for n, c in (("all", _cells(spark, sf)), ("without one", lossy))]
    return activity.union_all(parts).withColumn("allocated", F.round("allocated", 4))


@query(f"WITH {geo.EDGES}, {geo.representative('e')} SELECT boundary_set, boundary_id, round(longitude, 9) AS longitude, round(latitude, 9) AS latitude FROM rep")
def representative_points(spark: SparkSession, sf: str) -> DataFrame:
    return polygons.representative(_edges(spark, sf)).withColumns({c: F.round(c, 9) for c in ("longitude", "latitude")})


@query(f"WITH {geo.RING_EDGES} SELECT boundary_set, boundary_id, poly, ring, nth // 4 AS place, round(x1, 5) AS x, round(y1, 5) AS y FROM e WHERE nth % 4 = 0 UNION ALL SELECT boundary_set, boundary_id, poly, ring, 4, round(x1, 5), round(y1, 5) FROM e WHERE nth = 0")
def thinned_polygons(spark: SparkSession, sf: str) -> DataFrame:
    t = polygons.thinned(_ring_edges(spark, sf), every=4).select("boundary_set", "boundary_id", "poly", "ring", F.posexplode("points").alias("place", "p"))
    return t.select("boundary_set", "boundary_id", "poly", "ring", F.col("place").cast("long").alias("place"), F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


# ---- activity, dimensions, questions

_SPINE = """e AS (SELECT 'orders' AS dataset, coalesce(o_orderpriority, 'Unknown') AS category, cast(date_trunc('month', o_orderdate) AS DATE) AS event_month, c_nationkey::VARCHAR AS place
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderdate IS NOT NULL UNION ALL
  SELECT 'lineitem', coalesce(nullif(l_returnflag, 'N'), 'Unknown'), cast(date_trunc('month', l_shipdate) AS DATE), s_nationkey::VARCHAR FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_shipdate IS NOT NULL),
c AS (SELECT place, dataset, category, event_month, count(*) AS event_count FROM e WHERE place IS NOT NULL GROUP BY ALL)"""
_DIM = f"""n AS (SELECT n_nationkey AS n FROM nation), t AS (SELECT n, {_X0} AS x0, {_Y0} AS y0, {_X1} AS x1, {_Y1} AS y1 FROM n), {geo.AREAS},
pc AS (SELECT c_nationkey AS n, count(*) AS people, count(*) FILTER (c_acctbal > 0) AS homes FROM customer GROUP BY 1), bc AS (SELECT s_nationkey AS n, count(*) FILTER (s_acctbal > 0) AS firms FROM supplier GROUP BY 1),
d AS (SELECT t.n::VARCHAR AS boundary_id, coalesce(people, 0)::BIGINT AS population, coalesce(homes, 0)::BIGINT AS housing_units, coalesce(firms, 0)::BIGINT AS businesses, area_sq_km FROM t LEFT JOIN pc USING (n) LEFT JOIN bc USING (n) JOIN areas ON boundary_set = 'nation' AND areas.boundary_id = t.n::VARCHAR)"""
_MART = f"{_SPINE}, {_DIM}, mart AS (SELECT place, dataset, category, event_month, event_count, population, housing_units, businesses, area_sq_km, 1000.0 * event_count / nullif(population, 0) AS per_1000_residents, 1000.0 * event_count / nullif(housing_units, 0) AS per_1000_housing_units, 1000.0 * event_count / nullif(businesses, 0) AS per_1000_businesses, event_count / area_sq_km AS per_sq_km FROM c JOIN d ON place = boundary_id)"


def _spine(spark: SparkSession, sf: str) -> DataFrame:
    return activity.spine(world.place_events(spark, sf))


def _dimension(spark: SparkSession, sf: str, place: str = "nation") -> DataFrame:
    """Boundaries with the people of the cells they own."""
    areas = polygons.area(_edges(spark, sf)).filter(F.col("boundary_set") == place).select("boundary_id", "area_sq_km")
    return activity.dimension(areas, activity.population_by_boundary(_cells(spark, sf), _bridge(spark, sf), place), world.firms(spark, sf, place))


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return activity.by_neighborhood(activity.counts(_spine(spark, sf)), _dimension(spark, sf))


@query(f"WITH {_SPINE} SELECT * FROM c")
def activity_counts(spark: SparkSession, sf: str) -> DataFrame:
    return activity.counts(_spine(spark, sf))


_DENSE = "round(population / area_sq_km, 6) AS population_density, round(businesses / area_sq_km, 6) AS business_density"


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in names})


@query(f"WITH {_DIM}, {geo.centers_of('nation', 8)}, held AS (SELECT n, count(*) AS cell_count FROM mine GROUP BY 1) SELECT boundary_id, boundary_id::BIGINT AS boundary_number, population, housing_units, businesses, round(area_sq_km, 6) AS area_sq_km, cell_count, {_DENSE} FROM d JOIN held ON held.n::VARCHAR = boundary_id")
def dim_nation(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(activity.with_integer_key(_dimension(spark, sf)), "area_sq_km", "population_density", "business_density")


@query(f"""WITH {_DIM}, r AS (SELECT r_regionkey AS k FROM region), {geo.centers_of('nation', 8)}, cc AS (SELECT n // 5 AS k, count(*) AS cell_count FROM mine GROUP BY 1),
p AS (SELECT n // 5 AS k, sum(people)::BIGINT AS population, sum(homes)::BIGINT AS housing_units FROM pc GROUP BY 1), f AS (SELECT n // 5 AS k, sum(firms)::BIGINT AS businesses FROM bc GROUP BY 1)
SELECT r.k || '.0' AS boundary_id, r.k::BIGINT AS boundary_number, coalesce(population, 0) AS population, coalesce(housing_units, 0) AS housing_units, coalesce(businesses, 0) AS businesses, round(area_sq_km, 6) AS area_sq_km, cell_count,
  round(coalesce(population, 0) / area_sq_km, 6) AS population_density, round(coalesce(businesses, 0) / area_sq_km, 6) AS business_density
FROM r LEFT JOIN p USING (k) LEFT JOIN f USING (k) LEFT JOIN cc USING (k) JOIN areas ON boundary_set = 'region' AND areas.boundary_id = r.k::VARCHAR""")
def dim_region(spark: SparkSession, sf: str) -> DataFrame:
    """The second dimension: ids as text such as '3.0' beside their integer, people from the cells that regions own."""
    dim = _dimension(spark, sf, "region").withColumn("boundary_id", F.concat("boundary_id", F.lit(".0")))
    return _rounded(activity.with_integer_key(dim), "area_sq_km", "population_density", "business_density")


_RATES = ("per_1000_residents", "per_1000_housing_units", "per_1000_businesses", "per_sq_km")


@query(f"WITH {_MART} SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in (*_RATES, 'area_sq_km'))}) FROM mart")
def activity_by_nation(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_mart(spark, sf), *_RATES, "area_sq_km")


_CELLS = f"""{_MEMBER}, {geo.cell_of("(SELECT * FROM s WHERE status IN ('ok', 'out_of_bounds'))", "lo", "la", 8, "pcell")}, {geo.centers_of('nation', 8)}, held AS (SELECT n, count(*) AS k FROM mine GROUP BY 1),
pop AS (SELECT c_nationkey AS n, count(*) AS people, count(*) FILTER (c_acctbal > 0) AS homes FROM customer GROUP BY 1),
ev AS (SELECT q, r, coalesce(o_orderpriority, 'Unknown') AS category, cast(date_trunc('month', o_orderdate) AS DATE) AS event_month, count(*) AS event_count
  FROM orders JOIN pcell ON o_custkey = pcell.k WHERE o_orderdate IS NOT NULL GROUP BY ALL),
mid AS (SELECT DISTINCT q, r, {geo.center_lon('q', 'r', 8)} AS lo, {geo.center_lat('r', 8)} AS la FROM ev),
lab AS (SELECT q, r, min(n::VARCHAR) AS nation FROM mid JOIN t ON {_IN_NATION} GROUP BY 1, 2), lab2 AS (SELECT q, r, min(r_regionkey::VARCHAR) AS region FROM mid JOIN region ON {_IN_REGION} GROUP BY 1, 2),
cellmart AS (SELECT {geo.packed('ev.q', 'ev.r', 8)} AS h3_cell, 'orders' AS dataset, category, event_month, event_count, people / held.k AS population, homes / held.k AS housing_units, nation, region
  FROM ev LEFT JOIN mine ON mine.q = ev.q AND mine.r = ev.r LEFT JOIN held ON held.n = mine.n LEFT JOIN pop ON pop.n = mine.n LEFT JOIN lab ON lab.q = ev.q AND lab.r = ev.r LEFT JOIN lab2 ON lab2.q = ev.q AND lab2.r = ev.r)"""


def _cell_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' orders by the cell of the customer."""
    points = _point_table(spark, sf).select(F.col("row_key").cast("long").alias("c_custkey"), F.col("h3_r8").alias("cell"))
    o = table(spark, sf, "orders").join(points, F.col("o_custkey") == F.col("c_custkey"))
    events = activity.spine([o.select(F.lit("orders").alias("dataset"), F.col("o_orderkey").cast("string").alias("row_key"), F.col("o_orderpriority").alias("category"), F.col("o_orderdate").cast("string").alias("event_date"), F.col("cell").alias("place"))])
    owned = _bridge(spark, sf).filter("is_primary")
    labels = {s: owned.filter(F.col("boundary_set") == s) for s in world.SETS}
    return activity.by_cell(activity.counts(events), _cells(spark, sf).select("h3_cell", "population", "housing_units"), labels)


@query(f"""WITH {_CELLS} SELECT * REPLACE (round(population, 6) AS population, round(housing_units, 6) AS housing_units), 8 AS resolution, round(1000.0 * event_count / nullif(population, 0), 6) AS per_1000_residents,
  round(1000.0 * event_count / nullif(housing_units, 0), 6) AS per_1000_housing_units, round(event_count / {cells.AREA[8]!r}, 6) AS per_sq_km FROM cellmart""")
def activity_by_cell(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_cell_mart(spark, sf), "population", "housing_units", "per_1000_residents", "per_1000_housing_units", "per_sq_km")


_CELL_RATES = f"{_CELLS}, cr AS (SELECT h3_cell, sum(event_count)::BIGINT AS events, round(max(population), 6) AS denominator, round(1000.0 * sum(event_count) / nullif(max(population), 0), 6) AS rate FROM cellmart GROUP BY 1)"


@query(f"WITH {_CELL_RATES} SELECT * FROM cr WHERE denominator > 0 ORDER BY rate DESC, h3_cell LIMIT 20")
def cells_by_rate(spark: SparkSession, sf: str) -> DataFrame:
    r = _rounded(activity.rates(_cell_mart(spark, sf), ["h3_cell"], "population").filter("denominator > 0"), "denominator", "rate")
    return activity.top(r, [F.col("rate").desc(), F.col("h3_cell").asc()], 20)


@query(f"WITH {_CELL_RATES}, x AS (SELECT h3_cell, events, round(events / {cells.AREA[8]!r}, 6) AS density, rate FROM cr) SELECT *, rank() OVER (ORDER BY events DESC NULLS LAST)::INT AS count_rank, rank() OVER (ORDER BY density DESC NULLS LAST)::INT AS density_rank, rank() OVER (ORDER BY rate DESC NULLS LAST)::INT AS rate_rank FROM x")
def cell_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """At one resolution the rank by density is the rank by count; the rank by rate is another."""
    r = activity.rates(_cell_mart(spark, sf), ["h3_cell"], "population").drop("denominator")
    return activity.three_ranks(_rounded(r.withColumn("density", F.col("events") / cells.AREA[8]), "density", "rate"))


@query(f"""WITH {_MEMBER}, {geo.cell_of("(SELECT * FROM s WHERE status IN ('ok', 'out_of_bounds'))", "lo", "la", 8, "pcell")}, {geo.centers_of('nation', 8)}, own AS (SELECT q, r, min(n::VARCHAR) AS nation FROM mine GROUP BY 1, 2),
x AS (SELECT c_custkey, c_mktsegment AS title, own.nation FROM customer LEFT JOIN pcell ON pcell.k = c_custkey LEFT JOIN own USING (q, r)), y AS (SELECT title, count(*) AS title_rows, count(DISTINCT nation) AS title_values FROM x GROUP BY 1)
SELECT * FROM x LEFT JOIN y USING (title)""")
def title_locations(spark: SparkSession, sf: str) -> DataFrame:
    """One row a location with its approximate place, and totals of its title, which is not unique, on every row."""
    points = _point_table(spark, sf).select(F.col("row_key").cast("long").alias("c_custkey"), F.col("h3_r8").alias("h3_cell"))
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("title")).join(points, "c_custkey", "left")
    return activity.locations(rows, _bridge(spark, sf).filter("is_primary and boundary_set = 'nation'"), "title", "nation").drop("h3_cell")


@query(f"WITH {_MART} SELECT place, sum(event_count)::BIGINT AS events, max(population) AS denominator, round(1000.0 * sum(event_count) / nullif(max(population), 0), 6) AS rate, 'TPC customers' AS denominator_vintage, min(event_month) AS first_month, max(event_month) AS last_month FROM mart WHERE dataset = 'orders' GROUP BY place HAVING max(population) > 0 ORDER BY rate DESC, place LIMIT 20")
def reports_per_1000(spark: SparkSession, sf: str) -> DataFrame:
    """Rate by place with the numerator's window and the denominator's vintage beside it."""
    m = _mart(spark, sf).filter("dataset = 'orders' and population > 0").groupBy("place")
    r = m.agg(F.sum("event_count").alias("events"), F.max("population").alias("denominator"), F.min("event_month").alias("first_month"), F.max("event_month").alias("last_month"))
    r = r.withColumns({"rate": F.round(casts.rate(F.col("events"), F.col("denominator")), 6), "denominator_vintage": F.lit("TPC customers")})
    return activity.top(r, [F.col("rate").desc(), F.col("place").asc()], 20).select("place", "events", "denominator", "rate", "denominator_vintage", "first_month", "last_month")


@query(f"WITH {_MART}, r AS (SELECT place, sum(event_count)::BIGINT AS events, max(businesses) AS denominator, round(1000.0 * sum(event_count) / nullif(max(businesses), 0), 6) AS rate FROM mart GROUP BY place) SELECT *, (SELECT count(*) FROM r WHERE rate IS NULL) AS excluded_places, (SELECT count(*) FROM r) AS all_places FROM r WHERE rate IS NOT NULL ORDER BY rate, place LIMIT 10")
def lowest_rates(spark: SparkSession, sf: str) -> DataFrame:
    m = _mart(spark, sf)
    return activity.lowest_with_exclusions(m, "place", "businesses", 10).withColumn("rate", F.round("rate", 6))


@query("""WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, cast(date_trunc('month', o_orderdate) AS DATE) AS event_month FROM orders)
SELECT event_month, o_orderpriority AS category, count(*) AS records, count(DISTINCT o_custkey) AS customers FROM o WHERE event_month < (SELECT max(event_month) FROM o) GROUP BY 1, 2""")
def filings_per_month(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("event_month", casts.month(F.col("o_orderdate")))
    return activity.complete_months(o).groupBy("event_month", F.col("o_orderpriority").alias("category")).agg(F.count("*").alias("records"), F.count_distinct("o_custkey").alias("customers"))


@query("SELECT s_nationkey AS nation, count(*) AS suppliers, count(DISTINCT s_name) AS ever, count(DISTINCT CASE WHEN s_acctbal > 0 THEN s_name END) AS active FROM supplier GROUP BY 1 ORDER BY suppliers DESC, nation LIMIT 15")
def registry_counts(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation"))
    out = s.agg(F.count("*").alias("suppliers"), F.count_distinct("s_name").alias("ever"), F.count_distinct(F.when(F.col("s_acctbal") > 0, F.col("s_name"))).alias("active"))
    return activity.top(out, [F.col("suppliers").desc(), F.col("nation").asc()], 15)


@query(f"WITH {_MART} SELECT place, dataset, sum(event_count)::BIGINT AS events, round(1000.0 * sum(event_count) / nullif(max(population), 0), 6) AS by_residents, round(1000.0 * sum(event_count) / nullif(max(businesses), 0), 6) AS by_businesses FROM mart GROUP BY 1, 2")
def two_denominators(spark: SparkSession, sf: str) -> DataFrame:
    sums = _mart(spark, sf).groupBy("place", "dataset").agg(F.sum("event_count").alias("events"), F.max("population").alias("p"), F.max("businesses").alias("b"))
    return sums.select("place", "dataset", "events", F.round(casts.rate(F.col("events"), F.col("p")), 6).alias("by_residents"), F.round(casts.rate(F.col("events"), F.col("b")), 6).alias("by_businesses"))


@query(f"WITH {_MART}, r AS (SELECT place, sum(event_count)::BIGINT AS events, round(sum(event_count) / 0.7373275976, 6) AS density, round(1000.0 * sum(event_count) / nullif(max(population), 0), 6) AS rate FROM mart GROUP BY place) SELECT *, rank() OVER (ORDER BY events DESC NULLS LAST)::INT AS count_rank, rank() OVER (ORDER BY density DESC NULLS LAST)::INT AS density_rank, rank() OVER (ORDER BY rate DESC NULLS LAST)::INT AS rate_rank FROM r")
def three_ranks(spark: SparkSession, sf: str) -> DataFrame:
    r = activity.rates(_mart(spark, sf), ["place"], "population").drop("denominator")
    r = r.withColumns({"density": F.round(F.col("events") / cells.AREA[8], 6), "rate": F.round("rate", 6)})
    return activity.three_ranks(r)


@query("SELECT doc_id, source, lang, count(*) OVER (PARTITION BY source) AS source_rows, n AS source_values FROM documents LEFT JOIN (SELECT source, count(DISTINCT lang) AS n FROM documents GROUP BY 1) t USING (source)")
def group_totals(spark: SparkSession, sf: str) -> DataFrame:
    return activity.with_group_totals(table(spark, sf, "documents").select("doc_id", "source", "lang"), "source", "lang", "source")


@query("SELECT conv_id, max(CASE WHEN role = 'user' THEN n END) AS user_turns, max(CASE WHEN role = 'assistant' THEN n END) AS assistant_turns FROM (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY 1, 2) GROUP BY 1")
def pivoted_roles(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "conversations").groupBy("conv_id", "role").agg(F.count("*").alias("n"))
    return n.groupBy("conv_id").agg(*(F.max(F.when(F.col("role") == r, F.col("n"))).alias(f"{r}_turns") for r in ("user", "assistant")))


@query("SELECT doc_id, 'quality' AS measure, quality::INT AS value FROM labels UNION ALL SELECT doc_id, 'toxic', toxic::INT FROM labels")
def wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select("doc_id", F.expr("stack(2, 'quality', cast(quality as int), 'toxic', cast(toxic as int)) as (measure, value)"))


# ---- landing and zones


@query("SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type, props AS _source_props, '2024-03-01' AS _ingested_at, 'r1' AS _ingest_run_id FROM events")
def landed_records(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", F.col("user_id").alias("User ID"), "event_type", F.col("props").alias(":props"))
    return landing.land_records(e, "r1", "2024-03-01")


@query("SELECT strftime(max(ts), '%Y-%m-%d') AS position FROM events")
def resume_position(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.resume_position(table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day")), "day", start="2020-01-01")


@query("SELECT strftime(ts, '%Y-%m-%d') AS ingest_date, count(*) AS rows FROM events GROUP BY 1")
def partition_state(spark: SparkSession, sf: str) -> DataFrame:
    return versions.partition_state(_daily(spark, sf), "ingest_date")


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"))


# ---- checks, reconciliation, upkeep


@query("""SELECT unnest(['not_null_l_orderkey', 'not_null_l_returnflag', 'accepted_values_l_returnflag', 'accepted_range_l_discount', 'accepted_range_l_quantity']) AS check_name,
  unnest([count(*) FILTER (l_orderkey IS NULL), count(*) FILTER (l_returnflag IS NULL), count(*) FILTER (l_returnflag NOT IN ('A', 'R')), count(*) FILTER (l_discount < 0.02 OR l_discount > 0.08), count(*) FILTER (l_quantity > 40)]) AS failures FROM lineitem""")
def simple_checks(spark: SparkSession, sf: str) -> DataFrame:
    return checks.simple(table(spark, sf, "lineitem"), ["l_orderkey", "l_returnflag"], {"l_returnflag": ["A", "R"]}, {"l_discount": (0.02, 0.08), "l_quantity": (None, 40)})


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


@query("SELECT l_quantity, count(*) AS n FROM lineitem WHERE l_linenumber > 1 AND (l_quantity < 5 OR l_quantity > 45) GROUP BY 1")
def out_of_range(spark: SparkSession, sf: str) -> DataFrame:
    return checks.out_of_range(table(spark, sf, "lineitem"), "l_quantity", 5, 45, "l_linenumber > 1")


@query("SELECT 'orders_have_rich_customers' AS check_name, count(*) AS failures FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def relationship_check(spark: SparkSession, sf: str) -> DataFrame:
    rich = table(spark, sf, "customer").filter("c_acctbal > 0")
    return checks.as_result(checks.orphans(table(spark, sf, "orders"), "o_custkey", rich, "c_custkey"), "orders_have_rich_customers")


@query("""WITH c AS (SELECT count(*) AS whole, count(*) FILTER (c_nationkey < 20) AS part, count(*) FILTER (c_acctbal > 0) AS rich FROM customer),
x AS (SELECT 'all' AS part, whole AS found, whole AS expected FROM c UNION ALL SELECT 'some', part, whole FROM c UNION ALL SELECT 'more than there are', whole, rich FROM c)
SELECT part, found, expected, round((expected - found) / expected, 9) AS shortfall, found <= expected AND (expected - found) / expected <= 0.05 AS passes FROM x""")
def population_reconciles(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension against its source: whole, short by some nations, and with more people than there are."""
    dim, c = _dimension(spark, sf), table(spark, sf, "customer").withColumn("one", F.lit(1))
    cases = {"all": (dim, c), "some": (dim.filter("cast(boundary_id as int) < 20"), c), "more than there are": (dim, c.filter("c_acctbal > 0"))}
    return activity.union_all([checks.reconciles(d, "population", whole, "one").withColumn("part", F.lit(name)) for name, (d, whole) in cases.items()]).withColumn("shortfall", F.round("shortfall", 9))


@query("SELECT max(ts) AS newest, round(date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01') / 3600.0, 4) AS age_hours, CASE WHEN date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01') / 3600.0 > 72 THEN 'error' WHEN date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01') / 3600.0 > 24 THEN 'warn' ELSE 'pass' END AS status FROM events")
def source_freshness(spark: SparkSession, sf: str) -> DataFrame:
    out = checks.source_freshness(table(spark, sf, "events"), "ts", F.lit(world.NOW).cast("timestamp_ntz"), 24, 72)
    return out.withColumn("age_hours", F.round("age_hours", 4))


_DAYS = "days AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1)"


@query(f"""WITH {_DAYS}, claims AS (SELECT day AS run_id, n + CASE WHEN day = '2024-01-03' THEN 1 ELSE 0 END AS w, CASE WHEN day = '2024-01-04' THEN '2024-01-05' ELSE day END AS p FROM days WHERE day <> '2024-01-02' UNION ALL SELECT 'empty', 0, '2024-01-01')
SELECT coalesce(run_id, day) AS run_id, coalesce(w, 0)::BIGINT AS rows_written, coalesce(n, 0)::BIGINT AS rows_held, CASE WHEN w IS NULL THEN 'unrecorded' WHEN w <> coalesce(n, 0) THEN 'miscounted' WHEN n > 0 AND p <> day THEN 'wrong_partition' ELSE 'ok' END AS verdict FROM claims FULL JOIN days ON run_id = day""")
def run_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    raw = _daily(spark, sf).withColumn("run_id", F.col("ingest_date"))
    days = raw.groupBy("ingest_date").agg(F.count("*").alias("n")).filter("ingest_date <> '2024-01-02'")
    claims = days.select(F.col("ingest_date").alias("run_id"), (F.col("n") + F.when(F.col("ingest_date") == "2024-01-03", 1).otherwise(0)).alias("rows_written"), F.when(F.col("ingest_date") == "2024-01-04", "2024-01-05").otherwise(F.col("ingest_date")).alias("ingest_date"))
    empty = raw.agg(F.lit("empty").alias("run_id"), F.lit(0).cast("long").alias("rows_written"), F.lit("2024-01-01").alias("ingest_date"))
    return reconcile.runs_against_rows(claims.unionByName(empty), reconcile.held_by_run(raw))


@query("SELECT max(event_id) + 1 AS claimed, max(event_id) AS held, 'ahead' AS drift FROM events")
def position_drift(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return reconcile.position_drift(e.select((F.col("event_id") + 1).alias("watermark_out")), e, "event_id")


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """A newest snapshot of all customers but two, before it two older ones with one row newer than its successor."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    old = c.filter("key % 3 = 0").withColumns({"day": F.lit("2024-01-01"), "v": F.lit(1)})
    mid = c.filter("key % 2 = 0").withColumns({"day": F.lit("2024-01-02"), "v": F.when(F.col("key") == 10, 9).otherwise(2)})
    new = c.filter("key not in (7, 8)").withColumns({"day": F.lit("2024-01-03"), "v": F.lit(3)})
    return old.unionByName(mid).unionByName(new)


_SNAP = """r AS (SELECT c_custkey AS key, '2024-01-01' AS day, 1 AS v FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, '2024-01-02', CASE WHEN c_custkey = 10 THEN 9 ELSE 2 END FROM customer WHERE c_custkey % 2 = 0),
k AS (SELECT c_custkey AS key FROM customer WHERE c_custkey NOT IN (7, 8)),
s AS (SELECT day, count(*) AS rows, count(*) FILTER (k.key IS NULL) AS unreachable, count(*) FILTER (k.key IS NOT NULL AND v > 3) AS regressed FROM r LEFT JOIN k USING (key) GROUP BY day)"""


@query(f"WITH {_SNAP} SELECT *, unreachable = 0 AND regressed = 0 AS proven FROM s")
def supersession(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.supersession(_snapshots(spark, sf), "day", "key", "v")


@query(f"WITH {_SNAP}, d AS (SELECT day FROM s UNION SELECT '2024-01-03' FROM customer), n AS (SELECT day, dense_rank() OVER (ORDER BY day DESC)::INT AS nth FROM d) SELECT day, nth, CASE WHEN nth <= 1 THEN 'newest' WHEN coalesce(unreachable = 0 AND regressed = 0, false) THEN 'drop' ELSE 'unproven' END AS fate FROM n LEFT JOIN s USING (day)")
def retention(spark: SparkSession, sf: str) -> DataFrame:
    rows = _snapshots(spark, sf)
    return reconcile.retention(rows, reconcile.supersession(rows, "day", "key", "v"), "day", 1)


@query(f"WITH {_DAYS}, o AS (SELECT day, n - CASE WHEN day = '2024-01-05' THEN 1 ELSE 0 END AS n FROM days WHERE day <> '2024-01-09') SELECT day AS ingest_date, CASE WHEN o.n IS NULL THEN 'new' WHEN days.n > o.n THEN 'grown' ELSE 'same' END AS state, CASE WHEN o.n IS NULL OR days.n > o.n THEN 'partition' ELSE 'none' END AS rebuild FROM days LEFT JOIN o USING (day)")
def changed_partitions(spark: SparkSession, sf: str) -> DataFrame:
    new = versions.partition_state(_daily(spark, sf), "ingest_date")
    old = new.filter("ingest_date <> '2024-01-09'").withColumn("rows", F.col("rows") - F.when(F.col("ingest_date") == "2024-01-05", 1).otherwise(0))
    return reconcile.changed_partitions(old, new, "ingest_date")


_THEN = """then_ AS (SELECT 'events' AS t, count(*) AS n, max(event_id) AS w FROM events WHERE ts < (SELECT max(ts)::DATE FROM events)
  UNION ALL SELECT 'orders', count(*), max(CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN -1 ELSE o_orderkey END) FROM orders UNION ALL SELECT 'part', count(*), max(p_partkey) FROM part),
now_ AS (SELECT 'events' AS t, count(*) AS n, max(event_id) AS w FROM events UNION ALL SELECT 'orders', count(*), max(o_orderkey) FROM orders UNION ALL SELECT 'part', count(*), max(p_partkey) FROM part)"""


@query(f"WITH {_THEN} SELECT t AS table_name, CASE WHEN then_.n <> now_.n THEN 'stale' WHEN then_.w <> now_.w THEN 'drift' ELSE 'current' END AS state FROM then_ JOIN now_ USING (t)")
def derived_staleness(spark: SparkSession, sf: str) -> DataFrame:
    """States of three inputs as they are against earlier ones: without the newest day, with an older newest key, unchanged."""
    e, o, p = (table(spark, sf, n) for n in ("events", "orders", "part"))
    state = lambda df, key, name: versions.input_state(df, key, key, name)
    now = activity.union_all([state(e, "event_id", "events"), state(o, "o_orderkey", "orders"), state(p, "p_partkey", "part")])
    last = e.agg(F.to_date(F.max("ts")).alias("last"))
    newest = o.agg(F.max("o_orderkey").alias("newest"))
    older = o.join(F.broadcast(newest)).withColumn("o_orderkey", F.when(F.col("o_orderkey") == F.col("newest"), -1).otherwise(F.col("o_orderkey")))
    before = e.join(F.broadcast(last)).filter(F.col("ts") < F.col("last"))
    then = activity.union_all([state(before, "event_id", "events"), state(older, "o_orderkey", "orders"), state(p, "p_partkey", "part")])
    return reconcile.derived_staleness(then, now)


# ---- freshness, profile, parity


@query(f"""WITH {_POINTS}, l AS (SELECT 'events' AS dataset, count(*) AS row_count, max(ts) AS latest_load, 72.0 AS sla FROM events UNION ALL SELECT 'orders', count(*), max(o_orderdate), NULL FROM orders
  UNION ALL SELECT 'customer', count(*), NULL, NULL FROM customer UNION ALL SELECT 'lineitem', count(*), max(l_shipdate), 1000000 FROM lineitem),
runs AS (SELECT dataset, arg_max(status, run_id) AS last_run FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 'events' ELSE 'lineitem' END AS dataset, 'r' || strftime(ts, '%Y-%m-%d') AS run_id, CASE WHEN max(event_id) % 2 = 0 THEN 'failed' ELSE 'success' END AS status FROM events GROUP BY ALL) GROUP BY 1),
log AS (SELECT year(o_orderdate) AS inv, CASE o_orderkey % 3 WHEN 0 THEN 'events' WHEN 1 THEN 'orders' ELSE 'lineitem' END AS dataset, CASE WHEN o_orderkey % 3 = 1 AND o_totalprice > 100000 THEN 'fail' WHEN o_orderkey % 3 = 0 AND o_totalprice > 100000 THEN 'warn' ELSE 'pass' END AS status FROM orders),
ck AS (SELECT dataset, count(*) AS checks, count(*) FILTER (status = 'fail') AS failed_checks, count(*) FILTER (status = 'warn') AS warned_checks FROM log WHERE inv = (SELECT max(inv) FROM log) GROUP BY 1),
q AS (SELECT 'customer' AS dataset, count(*) AS coordinates, count(*) FILTER (status = 'ok') AS usable, count(*) FILTER (status IN ('unparseable', 'impossible')) AS malformed FROM s),
a AS (SELECT l.*, date_diff('second', date_trunc('second', latest_load), TIMESTAMP '2024-02-01') / 3600.0::DOUBLE AS age, last_run, checks, failed_checks, warned_checks, coordinates, usable, malformed
  FROM l LEFT JOIN runs USING (dataset) LEFT JOIN ck USING (dataset) LEFT JOIN q USING (dataset)),
b AS (SELECT *, CASE WHEN sla IS NULL THEN false WHEN age IS NULL THEN true ELSE age > sla END AS is_stale FROM a)
SELECT dataset, row_count, round(age, 4) AS age_hours, is_stale, last_run AS last_run_status, checks, failed_checks, warned_checks, round(100.0 * (coordinates - usable) / nullif(coordinates, 0), 6) AS pct_unusable,
  NOT is_stale AND coalesce(last_run <> 'failed', true) AND coalesce(failed_checks, 0) = 0 AND coalesce(malformed, 0) = 0 AS is_healthy FROM b""")
def pipeline_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Four sources: run records, the check log and the quality of coordinates all come from the tables."""
    e, o, c, li = (table(spark, sf, n) for n in ("events", "orders", "customer", "lineitem"))
    registry = spark.createDataFrame([("events", 72.0), ("orders", None), ("customer", None), ("lineitem", 1000000.0)], "dataset string, sla_hours double")
    load = freshness.loads({"events": (e, "ts"), "orders": (o, "o_orderdate"), "customer": (c.withColumn("at", F.lit(None).cast("timestamp")), "at"), "lineitem": (li, "l_shipdate")})
    day = F.concat(F.lit("r"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id")
    runs = e.groupBy(F.when(F.col("event_id") % 2 == 0, "events").otherwise("lineitem").alias("dataset"), day).agg(F.when(F.max("event_id") % 2 == 0, "failed").otherwise("success").alias("status"))
    k, dear = F.col("o_orderkey") % 3, F.col("o_totalprice") > 100000
    year = F.year("o_orderdate").cast("string")
    log = o.select(year.alias("invocation_id"), year.alias("run_started_at"), F.when(k == 0, "events").when(k == 1, "orders").otherwise("lineitem").alias("dataset"), F.when((k == 1) & dear, "fail").when((k == 0) & dear, "warn").otherwise("pass").alias("status"))
    status = cells.status_breakdown(_points(spark, sf))
    quality = status.select(F.col("source_table").alias("dataset"), F.col("total").alias("coordinates"), F.col("ok").alias("usable"), (F.col("unparseable") + F.col("impossible")).alias("malformed"))
    out = freshness.freshness(registry, load, runs, log, quality, F.lit(world.NOW).cast("timestamp_ntz"))
    return out.select("dataset", "row_count", F.round("age_hours", 4).alias("age_hours"), "is_stale", "last_run_status", "checks", "failed_checks", "warned_checks", F.round("pct_unusable", 6).alias("pct_unusable"), "is_healthy")


def _profile_sql(column: str, shape: str) -> str:
    number = shape in ("numeric", "cell")
    of = lambda f: f"{f}({column})::DOUBLE" if shape == "numeric" else "NULL::DOUBLE"
    time = lambda f: f"strftime({f}({column}), '%Y-%m-%d')" if shape == "temporal" else "NULL::VARCHAR"
    top = f"(SELECT string_agg(v || ':' || n, ',' ORDER BY n DESC, v) FROM (SELECT {column}::VARCHAR AS v, count(*) AS n FROM lines WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 5))" if shape in ("category", "boolean") else "NULL"
    distinct = "NULL" if shape == "blob" else f"count(DISTINCT {column})"
    low = "true" if shape == "blob" else f"count({column}) = 0 OR (count(DISTINCT {column}) = 1 AND '{column}' <> 'one_described')"
    return f"SELECT '{column}' AS column_name, '{shape}' AS shape, count(*) FILTER ({column} IS NULL) AS n_nulls, {distinct} AS n_distinct, {of('min')} AS low, {of('max')} AS high, {of('median') if number else 'NULL::DOUBLE'} AS median, {time('min')} AS first_time, {time('max')} AS last_time, {top} AS top_values, {low} AS low_signal FROM lines"


_SHAPES = {"l_quantity": "numeric", "l_extendedprice": "numeric", "l_returnflag": "category", "ship": "temporal", "dear": "boolean", "cell": "cell", "words": "string", "parts": "blob", "nothing": "category", "one": "category", "one_described": "category"}


@query("WITH lines AS (SELECT l_quantity, l_extendedprice, l_returnflag, l_shipdate::DATE AS ship, l_extendedprice > 50000 AS dear, l_orderkey AS cell, l_orderkey || '-' || l_linenumber AS words, [l_linenumber] AS parts, NULL::VARCHAR AS nothing, 'x' AS one, 'x' AS one_described FROM lineitem) " + " UNION ALL ".join(_profile_sql(c, s) for c, s in _SHAPES.items()))
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of every shape: numbers, a category, times, a flag, a cell, free text, a blob, all null, constant, constant but described."""
    li = table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_returnflag", F.col("l_shipdate").cast("date").alias("ship"), (F.col("l_extendedprice") > 50000).alias("dear"), F.col("l_orderkey").alias("cell"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("words"), F.array("l_linenumber").alias("parts"), F.lit(None).cast("string").alias("nothing"), F.lit("x").alias("one"), F.lit("x").alias("one_described"),
    )
    return profile.profile(li, cells=("cell",), described=("one_described",)).drop("n_rows")


@query("SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value LIMIT 5")
def frequent_values(spark: SparkSession, sf: str) -> DataFrame:
    return profile.frequent(table(spark, sf, "part"), "p_type")


def _digest_sql(*parts: str) -> str:
    return f"bit_xor(('0x' || substring(md5({' || chr(1) || '.join(parts)}), 1, 15))::BIGINT)"


_ORDER_TEXT = {"o_custkey": "coalesce(o_custkey::VARCHAR, '<null>')", "o_orderdate": "coalesce(strftime(o_orderdate, '%Y-%m-%d'), '<null>')", "o_orderkey": "o_orderkey::VARCHAR", "o_orderpriority": "coalesce(o_orderpriority, '<null>')", "o_totalprice": "coalesce(printf('%.9f', o_totalprice::DOUBLE), '<null>')"}


@query(f"SELECT count(*) AS n_rows, {_digest_sql(*_ORDER_TEXT.values())} AS rows_digest, " + ", ".join(f"{_digest_sql('o_orderkey::VARCHAR', t)} AS {c}_digest" for c, t in _ORDER_TEXT.items() if c != "o_orderkey") + " FROM orders")
def table_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    return profile.fingerprint(o, ["o_orderkey"])


@query("SELECT 'o_totalprice' AS column_name, o_orderkey FROM orders WHERE o_orderkey % 1000 = 7 ORDER BY o_orderkey LIMIT 5")
def differing_keys(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    changed = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 1000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return profile.differing(o, changed, ["o_orderkey"])


@query("SELECT max(n) AS left_max, max(m) AS right_max, sum(n)::BIGINT AS left_rows, coalesce(sum(n) FILTER (m IS NULL), 0)::BIGINT AS unmatched, CASE WHEN max(n) <= 1 THEN 'one' ELSE 'many' END || '_to_' || CASE WHEN max(m) <= 1 THEN 'one' ELSE 'many' END AS kind FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) LEFT JOIN (SELECT c_custkey AS k, count(*) AS m FROM customer WHERE c_acctbal > 0 GROUP BY 1) USING (k)")
def join_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return profile.cardinality(table(spark, sf, "orders"), table(spark, sf, "customer").filter("c_acctbal > 0"), "o_custkey", "c_custkey")


@query("SELECT nation, month, n FROM (SELECT c_nationkey AS nation, cast(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY nation ORDER BY n DESC, month) = 1")
def busiest_month(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    n = o.groupBy(F.col("c_nationkey").alias("nation"), casts.month(F.col("o_orderdate")).alias("month")).agg(F.count("*").alias("n"))
    first = Window.partitionBy("nation").orderBy(F.col("n").desc(), "month")
    return n.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")
