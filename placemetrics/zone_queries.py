"""Queries of landing, staging, run records, checks, upkeep, profiles and streams over the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemetrics.functions import casts
from placemetrics.operators import cells, checks, profile, ranks, reconcile, versions
from placemetrics.plans import activity, freshness, staging, world
from placemetrics.plans.world import table
from placemetrics.sources import landing, zones
from placemetrics.streaming import feeds

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as landed text: id, user, type, properties, time."""
    e = table(spark, sf, "events")
    return e.select(F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("user"), "event_type", "props", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


_EVENTS = "ev AS (SELECT event_id::VARCHAR AS id, user_id::VARCHAR AS user, event_type, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated_at FROM events)"


# ---- landing


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, '{\"priority\":\"' || o_orderpriority || '\",\"tags\":[\"' || o_orderstatus || '\",\"x\"]}' AS detail, o_custkey::VARCHAR AS _source_cust, '2024-03-01' AS _ingested_at, 'r1' AS _ingest_run_id FROM orders")
def landed_nested(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    detail = F.struct(F.col("o_orderpriority").alias("priority"), F.array("o_orderstatus", F.lit("x")).alias("tags")).alias("Detail")
    return landing.land_records(o.select("o_orderkey", detail, F.col("o_custkey").alias(":cust")), "r1", "2024-03-01")


@query(f"WITH {_EVENTS} SELECT id, user, CASE WHEN id::BIGINT % 2 = 1 THEN event_type END AS event_type, '2024-03-0' || (1 + id::BIGINT % 2) AS ingest_date, 'r' || (id::BIGINT % 2) AS _ingest_run_id FROM ev WHERE id::BIGINT % 3 < 2")
def raw_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of different columns appended to one zone, then some of its partitions read with the columns united."""
    raw, e = zones.fresh_path(spark, "raw"), _events(spark, sf)
    k = F.col("id").cast("long")
    for n, cols in ((0, ["id", "user"]), (1, ["id", "user", "event_type"]), (2, ["id"])):
        part = e.filter((k % 3 < 2) & (k % 2 == n) if n < 2 else k % 3 == 2).select(*cols)
        landing.append_batch(landing.land_records(part, f"r{n}", "now"), raw, f"2024-03-0{n + 1}")
    return landing.read_raw(spark, raw, ["2024-03-01", "2024-03-02"]).select("id", "user", "event_type", "ingest_date", "_ingest_run_id")


@query(f"WITH {_EVENTS} SELECT id, user, event_type, props, updated_at FROM ev WHERE updated_at > (SELECT median(updated_at::TIMESTAMP)::DATE::VARCHAR FROM ev)")
def resumed_json(spark: SparkSession, sf: str) -> DataFrame:
    """JSON records after a position, in the order of position and key."""
    drops, e = zones.fresh_path(spark, "json"), _events(spark, sf)
    e.write.json(drops)
    after = e.agg(F.median(F.unix_timestamp("updated_at")).alias("m")).select(F.date_format(F.timestamp_seconds("m"), "yyyy-MM-dd")).first()[0]
    return landing.read_json(spark, drops, "id string, user string, event_type string, props string, updated_at string", since=after, lines=True)


@query(f"WITH {_EVENTS}, x AS (SELECT *, row_number() OVER (ORDER BY updated_at, id) AS nth FROM ev) SELECT id, updated_at FROM x WHERE nth <= 100")
def first_in_total_order(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select("id", "updated_at").orderBy("updated_at", "id").limit(100)


@query("""WITH d AS (SELECT '2024-03-0' || (1 + event_id % 3) AS day, count(*) AS n, max(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS m FROM events GROUP BY 1)
SELECT 'run-' || day AS run_id, 'events' AS dataset, day AS ingest_date, n AS rows_written, m AS watermark_out, 'success' AS status FROM d
UNION ALL SELECT 'run-none', 'events', min(day), 0, NULL, 'success' FROM d UNION ALL SELECT 'run-broken', 'events', min(day), 0, NULL, 'failed' FROM d""")
def run_records(spark: SparkSession, sf: str) -> DataFrame:
    """A record for every run: of three batches, of one without rows, of one that fails on its way."""
    raw, runs, e = zones.fresh_path(spark, "raw"), zones.fresh_path(spark, "runs"), _events(spark, sf)
    days = [f"2024-03-0{n}" for n in (1, 2, 3)]
    batches = [(f"run-{d}", d, e.filter(F.col("id").cast("long") % 3 == n)) for n, d in enumerate(days)]
    broken = e.withColumn("user", F.assert_true(F.col("id") < "")).limit(10)
    for run, day, rows in [*batches, ("run-none", days[0], e.filter("id is null")), ("run-broken", days[0], broken)]:
        try:
            landing.ingest(rows, raw, runs, "updated_at", run_id=run, dataset="events", ingest_date=day, finished_at="2024-03-01 00:00:00", mode="delta")
        except Exception as e_:
            if run != "run-broken":
                raise e_
    return landing.read_runs(spark, runs).select("run_id", "dataset", "ingest_date", "rows_written", "watermark_out", "status")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0")
def refreshed_table(spark: SparkSession, sf: str) -> DataFrame:
    """A refresh replaces a table; one that fetched nothing keeps it."""
    path, c = zones.fresh_path(spark, "refresh"), table(spark, sf, "customer").select("c_custkey", "c_name")
    for fresh in (c, c.filter("c_custkey % 2 = 0"), c.filter("c_custkey < 0")):
        landing.full_refresh(fresh, path)
    return zones.read_version(spark, path, c.schema)


@query("SELECT n_name, count(*) AS customers, count(x.note) AS notes FROM nation JOIN customer ON n_nationkey = c_nationkey LEFT JOIN (SELECT NULL::BIGINT AS c_custkey, NULL::VARCHAR AS note WHERE false) x USING (c_custkey) GROUP BY 1")
def zone_views(spark: SparkSession, sf: str) -> DataFrame:
    """Tables as views by name, an optional one missing, queried in SQL."""
    missing = zones.fresh_path(spark, "absent")
    landing.load_views(spark, {"zone_nation": f"{sf}/nation.parquet", "zone_customer": f"{sf}/customer.parquet", "zone_notes": missing}, {"zone_notes": "c_custkey long, note string"})
    return spark.sql("SELECT n_name, count(*) AS customers, count(note) AS notes FROM zone_nation JOIN zone_customer ON n_nationkey = c_nationkey LEFT JOIN zone_notes USING (c_custkey) GROUP BY 1")


@query("SELECT o_custkey, count(*)::INT AS n_orders, max(o_orderdate)::DATE AS last_order FROM orders GROUP BY 1")
def derived_table(spark: SparkSession, sf: str) -> DataFrame:
    path, schema = zones.fresh_path(spark, "derived"), "o_custkey long, n_orders int, last_order date"
    landing.write_derived(table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("last_order")), schema, path)
    return landing.read_derived(spark, schema, path)


def _hash_sql(select: str) -> str:
    """The schema hash of a query, from DuckDB's own description of it."""
    kinds = "CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE lower(column_type) END"
    return f"(SELECT sha256(string_agg(column_name || ':' || {kinds}, chr(10) ORDER BY place)) FROM (SELECT *, row_number() OVER () AS place FROM (DESCRIBE {select})))"


_BY_NATION = "SELECT c_nationkey::BIGINT AS c_nationkey, count(*) AS n FROM customer GROUP BY 1"
_BY_DAY = "SELECT o_orderdate::DATE AS o_orderdate, count(*) AS n FROM orders GROUP BY 1"


@query(f"SELECT 'by_nation' AS mart, count(*) AS rows, {_hash_sql(_BY_NATION)} AS schema_hash, '2024-03-02' AS published_at FROM ({_BY_NATION}) UNION ALL SELECT 'orders_by_day', count(*), {_hash_sql(_BY_DAY)}, '2024-03-02' FROM ({_BY_DAY})")
def published_marts(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest after a second publication that no longer has one of the marts."""
    root = zones.fresh_path(spark, "marts")
    by = table(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("long").alias("c_nationkey")).agg(F.count("*").alias("n"))
    days = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("o_orderdate")).agg(F.count("*").alias("n"))
    landing.publish_all({"by_nation": by, "gone": by.limit(1)}, root, "2024-03-01")
    return landing.publish_all({"by_nation": by, "orders_by_day": days}, root, "2024-03-02").select("mart", "rows", "schema_hash", "published_at")


_CURVED = "SELECT (o_orderkey * 7919 % 4096)::BIGINT AS q, (o_custkey * 104729 % 4096)::BIGINT AS r, count(*) AS orders FROM orders GROUP BY 1, 2"


@query(f"WITH m AS ({_CURVED}) SELECT *, true AS few_files FROM m WHERE q BETWEEN 1000 AND 1200 AND r BETWEEN 500 AND 700 UNION ALL SELECT NULL, NULL, count(*), true FROM m")
def published_district(spark: SparkSession, sf: str) -> DataFrame:
    """A mart laid out along a space-filling curve of its cells: the rows of a district, from under a fifth of the files, and the count of all rows."""
    root, o = zones.fresh_path(spark, "marts"), table(spark, sf, "orders")
    mart = o.groupBy((F.col("o_orderkey") * 7919 % 4096).cast("long").alias("q"), (F.col("o_custkey") * 104729 % 4096).cast("long").alias("r")).agg(F.count("*").alias("orders"))
    place = {"q": F.col("q"), "r": F.col("r")}
    size = zones.stored(mart, "size").select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0]
    landing.publish_all({"cells": mart}, root, "now", {"cells": (cells.curve(cells.pack(F.col("q"), F.col("r"), 8)), place)}, file_bytes=max(1, size // 40))
    whole = landing.read_published(spark, root, "cells", mart.schema)
    near = landing.read_published(spark, root, "cells", mart.schema, {"q": (1000, 1200), "r": (500, 700)})
    few = F.lit(5 * len(near.inputFiles()) < len(whole.inputFiles()))
    none = F.lit(None).cast("long")
    return near.filter("q between 1000 and 1200 and r between 500 and 700").withColumn("few_files", few).unionByName(whole.agg(F.count("*").alias("orders")).select(none.alias("q"), none.alias("r"), "orders", F.lit(True).alias("few_files")))


# ---- staging


@query("""SELECT c_custkey::VARCHAR AS business_location_id, 'T' || c_nationkey AS tax_id, c_name AS business_name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE DATE '2020-01-01' + (c_custkey % 1000)::INT END AS location_started_on,
  c_custkey % 3 <> 0 AS is_active, c_custkey % 4 = 0 AS pays_parking_tax, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END::BIGINT AS upstream_supervisor_district, c_acctbal > 0 AS is_newest_positive FROM customer""")
def staged_businesses(spark: SparkSession, sf: str) -> DataFrame:
    """Newest version of landed businesses, renamed, typed and flagged; every customer is landed twice."""
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    landed = c.select(
        k.cast("string").alias("uniqueid"), F.concat(F.lit("T"), "c_nationkey").alias("ttxid"), F.col("c_name").alias("dba_name"),
        F.when(k % 5 == 0, "n/a").otherwise(F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int")), "yyyy-MM-dd'T'00:00:00.000")).alias("location_start_date"),
        F.when(k % 3 == 0, "2024-01-01T00:00:00.000").alias("location_end_date"), F.when(k % 4 == 0, "true").otherwise("false").alias("parking_tax"),
        F.when(k % 7 == 0, "none").otherwise(F.concat("c_nationkey", F.lit(".00000"))).alias("supervisor_district"),
        F.when(F.col("c_acctbal") > 0, "positive").otherwise("other").alias("city"),
    )
    dataset = next(d for d in staging.DATASETS if d.name == "business_locations")
    names = {line.split()[0] for line in dataset.columns.split(";") if line.strip()}
    landed = landed.withColumns({n: F.lit(None).cast("string") for n in sorted(names - set(landed.columns))})
    old = landed.withColumns({"dba_name": F.lit("old name"), "city": F.lit("positive"), staging.UPDATED: F.lit("2024-01-01T00:00:00.000Z"), staging.INGESTED: F.lit("2024-01-01")})
    raw = old.unionByName(landed.withColumns({staging.UPDATED: F.lit("2024-02-01T00:00:00.000Z"), staging.INGESTED: F.lit("2024-02-01")}))
    out = staging.stage(raw, dataset)
    return out.select("business_location_id", "tax_id", "business_name", F.to_date("location_started_at").alias("location_started_on"), "is_active", "pays_parking_tax", "upstream_supervisor_district", (F.col("business_city") == "positive").alias("is_newest_positive"))


@query("SELECT p_partkey::VARCHAR AS block_group_geoid, p_size::BIGINT AS population, p_retailprice::DOUBLE * 1000 / 1e6 AS land_area_sq_km, CASE WHEN p_partkey % 2 = 0 THEN p_size + 0.5 END::DOUBLE AS internal_point_latitude FROM part")
def staged_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Square metres as text become square kilometres."""
    p = table(spark, sf, "part")
    landed = p.select(F.col("p_partkey").cast("string").alias("geoid"), F.col("p_size").cast("string").alias("pop100"), (F.col("p_retailprice").cast("double") * 1000).cast("string").alias("arealand"), F.when(F.col("p_partkey") % 2 == 0, (F.col("p_size") + 0.5).cast("string")).alias("intptlat"), F.lit("2024-01-01T00:00:00.000Z").alias(staging.UPDATED), F.lit("2024-01-01").alias(staging.INGESTED))
    dataset = next(d for d in staging.DATASETS if d.name == "block_groups")
    names = {line.split()[0] for line in dataset.columns.split(";") if line.strip()}
    out = staging.stage(landed.withColumns({n: F.lit(None).cast("string") for n in sorted(names - set(landed.columns))}), dataset)
    return out.select("block_group_geoid", "population", "land_area_sq_km", "internal_point_latitude")


@query("SELECT o_orderkey::VARCHAR AS case_id, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey % 100 END::BIGINT AS cell, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'n' || (o_custkey % 25) END AS nation FROM orders")
def staged_with_geography(spark: SparkSession, sf: str) -> DataFrame:
    """Rows keep their number when the geography of their points is joined on, found or not."""
    o = table(spark, sf, "orders")
    dataset = next(d for d in staging.DATASETS if d.name == "service_requests")
    names = {line.split()[0] for line in dataset.columns.split(";") if line.strip()}
    landed = o.select(F.col("o_orderkey").cast("string").alias("service_request_id"), F.lit("2024-01-01T00:00:00.000Z").alias(staging.UPDATED), F.lit("2024-01-01").alias(staging.INGESTED))
    landed = landed.withColumns({n: F.lit(None).cast("string") for n in sorted(names - {"service_request_id"})})
    place = o.filter("o_orderkey % 11 <> 0").select(F.lit("311_cases").alias("source_table"), F.col("o_orderkey").cast("string").alias("row_key"), (F.col("o_custkey") % 100).alias("cell"), F.concat(F.lit("n"), F.col("o_custkey") % 25).alias("nation"))
    other = place.withColumns({"source_table": F.lit("building_permits"), "nation": F.lit("wrong")})
    return staging.stage(landed, dataset, place.unionByName(other)).select("case_id", "cell", "nation")


# Every column of the other datasets, filled by rule from a key k; each record is landed twice, the older one with other values.
_TEXTS = {
    "text": ("concat('{c}-', {k} % 13)", "'{c}-' || ({k} % 13)"),
    "whole": ("if({k} % 7 = 0, 'none', concat({k} % 1000, '.00000'))", "CASE WHEN {k} % 7 <> 0 THEN {k} % 1000 END::BIGINT"),
    "float": ("concat({k} % 100, '.5')", "({k} % 100 + 0.5)::DOUBLE"),
    "timestamp": ("if({k} % 11 = 0, null, concat(cast(date_add(date'2020-01-01', cast({k} % 1000 as int)) as string), 'T00:00:00.000'))", "CASE WHEN {k} % 11 <> 0 THEN DATE '2020-01-01' + ({k} % 1000)::INT END"),
    "flag_y": ("if({k} % 3 = 0, 'Y', 'N')", "{k} % 3 = 0"),
    "flag_y_or_null": ("if({k} % 5 = 0, null, if({k} % 3 = 0, 'Y', 'N'))", "CASE WHEN {k} % 5 <> 0 THEN {k} % 3 = 0 END"),
}


def _projected(name: str) -> list[list[str]]:
    """Source, name and kind of a dataset's columns but its key."""
    dataset = next(d for d in staging.DATASETS if d.name == name)
    parsed = [line.split() for line in dataset.columns.split(";") if line.strip()]
    return [[p[0], p[1] if len(p) > 1 else p[0], p[2] if len(p) > 2 else "text"] for p in parsed if p[0] != dataset.key]


def _staged(name: str, given: str, k: str) -> None:
    """Registers the query that stages a dataset whole, from a given table by its key."""
    dataset = next(d for d in staging.DATASETS if d.name == name)
    own = next(p for p in (line.split() for line in dataset.columns.split(";")) if p and p[0] == dataset.key)
    key = own[1] if len(own) > 1 else own[0]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        made = {source: F.expr(_TEXTS[kind][0].format(c=source, k=k)) for source, _, kind in _projected(name)}
        landed = table(spark, sf, given).select(F.col(k).cast("string").alias(dataset.key), *(c.cast("string").alias(n) for n, c in made.items()))
        old = landed.withColumns({n: F.lit("old") for n in made} | {staging.UPDATED: F.lit("2024-01-01T00:00:00.000Z"), staging.INGESTED: F.lit("2024-03-01")})
        new = landed.withColumns({staging.UPDATED: F.lit("2024-02-01T00:00:00.000Z"), staging.INGESTED: F.lit("2024-02-01")})
        out = staging.stage(new.unionByName(old), dataset).drop("source_updated_at", "ingested_at")
        return out.withColumns({c: F.to_date(c) for c, t in out.dtypes if t.startswith("timestamp")})

    run.__name__ = f"staged_{dataset.name}"
    columns = ", ".join(f"{_TEXTS[kind][1].format(c=source, k=k)} AS {column}" for source, column, kind in _projected(name))
    whole = "::BIGINT" if len(own) > 2 else "::VARCHAR"
    query(f"SELECT {k}{whole} AS {key}, {columns} FROM {given}")(run)


_staged("service_requests", "orders", "o_orderkey")
_staged("building_permits", "orders", "o_orderkey")
_staged("film_locations", "part", "p_partkey")
_staged("neighborhoods", "supplier", "s_suppkey")
_staged("districts", "supplier", "s_suppkey")


# ---- scalars


@query("SELECT l_orderkey, l_linenumber, l_quantity::INT AS whole, l_shipdate::DATE AS day, l_extendedprice::DOUBLE AS price, l_returnflag = 'R' AS yes FROM lineitem")
def strict_casts(spark: SparkSession, sf: str) -> DataFrame:
    """Casts of text that is known to be well formed."""
    li = table(spark, sf, "lineitem")
    text = li.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").cast("string").alias("q"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("d"), F.col("l_extendedprice").cast("string").alias("p"), F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("y"))
    return text.select("l_orderkey", "l_linenumber", casts.cast_strict(F.col("q"), "int").cast("int").alias("whole"), casts.cast_strict(F.col("d"), "date").alias("day"), casts.cast_strict(F.col("p"), "float").alias("price"), casts.cast_strict(F.col("y"), "bool").alias("yes"))


@query("SELECT o_orderpriority, (date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH)::DATE AS complete_month, count(*) FILTER (date_trunc('month', o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH FROM orders)) AS in_it FROM orders GROUP BY 1")
def complete_months(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    whole = o.agg(casts.complete_month(F.max("o_orderdate")).alias("whole"))
    each = o.join(F.broadcast(whole)).groupBy("o_orderpriority")
    return each.agg(casts.complete_month(F.max("o_orderdate")).alias("complete_month"), F.count_if(casts.month(F.col("o_orderdate")) == F.col("whole")).alias("in_it"))


@query("SELECT c_custkey, sha256(c_custkey::VARCHAR || chr(1) || coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END, chr(2))) AS mark, CASE WHEN length(t) > 120 THEN substring(t, 1, 117) || '...' ELSE t END AS short FROM (SELECT *, repeat(c_name || ' ', (c_custkey % 9)::INT) AS t FROM customer)")
def hashed_and_shortened(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").withColumns({"name": F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")), "t": F.expr("repeat(c_name || ' ', cast(c_custkey % 9 as int))")})
    return c.select("c_custkey", casts.stable_hash(F.col("c_custkey"), F.col("name")).alias("mark"), casts.shortened(F.col("t")).alias("short"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 37.6::DOUBLE + (c_custkey % 300) / 1000::DOUBLE END AS lat, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE -122.9::DOUBLE + (c_custkey % 500) / 1000::DOUBLE END AS lon FROM customer")
def geojson_points(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinates out of GeoJSON text, longitude first; no point, no coordinates."""
    k = F.col("c_custkey")
    lat, lon = F.lit(37.6) + (k % 300) / F.lit(1000.0), F.lit(-122.9) + (k % 500) / F.lit(1000.0)
    point = F.when(k % 5 == 0, '{"type":"Point"}').otherwise(F.concat(F.lit('{"type":"Point","coordinates":['), lon.cast("string"), F.lit(","), lat.cast("string"), F.lit("]}")))
    y, x = cells.from_geojson(F.col("point"))
    return table(spark, sf, "customer").withColumn("point", point).select("c_custkey", y.cast("double").alias("lat"), x.cast("double").alias("lon"))


# ---- checks and their log


@query("""WITH r AS (SELECT unnest(['not_null_l_returnflag', 'accepted_values_l_returnflag', 'accepted_range_l_quantity']) AS check_name,
  unnest([count(*) FILTER (l_returnflag IS NULL), count(*) FILTER (l_returnflag NOT IN ('A', 'R')), count(*) FILTER (l_quantity > 40)]) AS failures FROM lineitem)
SELECT 'i2' AS invocation_id, '2024-01-02' AS run_started_at, check_name, failures, CASE WHEN failures = 0 THEN 'pass' WHEN check_name LIKE 'accepted_values%' THEN 'warn' ELSE 'fail' END AS status FROM r
UNION ALL SELECT 'i3', '2024-01-03', check_name, failures, CASE WHEN failures = 0 THEN 'pass' WHEN check_name LIKE 'accepted_values%' THEN 'warn' ELSE 'fail' END FROM r""")
def check_log(spark: SparkSession, sf: str) -> DataFrame:
    """Three invocations appended to the log, which then keeps the newest two whole."""
    path, li = zones.fresh_path(spark, "check-log"), table(spark, sf, "lineitem")
    for n in (1, 2, 3):
        found = checks.simple(li, ["l_returnflag"], {"l_returnflag": ["A", "R"]}, {"l_quantity": (None, 40)})
        checks.log_rows(found, f"i{n}", f"2024-01-0{n}", warn=["accepted_values_l_returnflag"]).write.mode("append").parquet(path)
    return checks.newest_runs(spark.read.parquet(path), 2)


_REGISTRY = "region nation customer supplier orders lineitem events documents embeddings pages benchmark labels lost".split()
_GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query(f"""WITH found AS ({" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _GIVEN)}), held AS (SELECT table_name FROM found WHERE n > 0), registry AS (SELECT unnest({_REGISTRY!r}) AS table_name)
SELECT table_name, 'missing' AS problem FROM (FROM registry EXCEPT FROM held) UNION ALL SELECT table_name, 'unregistered' FROM (FROM held EXCEPT FROM registry)""")
def registered_tables(spark: SparkSession, sf: str) -> DataFrame:
    """A registry against the tables that are found in the folder and hold rows."""
    registry = spark.createDataFrame([(t,) for t in _REGISTRY], "table_name string")
    names = [p.rsplit("/", 1)[1].removesuffix(".parquet") for p in zones.found_paths(spark, f"{sf}/*.parquet")]
    found = activity.union_all([table(spark, sf, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t in names])
    return checks.registered(registry, found.filter("n > 0").select("table_name"))


def _columns_sql(name: str, select: str) -> str:
    return f"SELECT '{name}' AS table_name, column_name FROM (DESCRIBE {select})"


_LEFT_COLUMNS = f"{_columns_sql('orders', 'SELECT * FROM orders')} UNION ALL {_columns_sql('customer', 'SELECT * FROM customer')}"
_RIGHT_COLUMNS = f"""{_columns_sql('orders', "SELECT *, 1 AS o_comment_hash, '' AS o_clerk_name FROM orders")} UNION ALL {_columns_sql('customer', 'SELECT * EXCLUDE (c_acctbal) FROM customer')}"""


@query(f"WITH a AS ({_LEFT_COLUMNS}), b AS ({_RIGHT_COLUMNS}) SELECT *, 'left' AS side FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'right' FROM (FROM b EXCEPT FROM a)")
def column_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Columns by (table, column) of two versions of two tables, both ways."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    named = lambda name, df: profile.schema_rows(df).select(F.lit(name).alias("table_name"), "column_name")
    left = named("orders", o).unionByName(named("customer", c))
    right = named("orders", o.withColumns({"o_comment_hash": F.lit(1), "o_clerk_name": F.lit("")})).unionByName(named("customer", c.drop("c_acctbal")))
    return profile.column_differences(left, right)


_OLD_SCHEMA = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
_NEW_SCHEMA = "SELECT c_custkey, c_name AS c_title, c_nationkey, c_acctbal::VARCHAR AS c_acctbal, 1 AS c_new FROM customer"


@query(f"""WITH o AS (SELECT column_name AS name, column_type AS kind, row_number() OVER () AS place FROM (DESCRIBE {_OLD_SCHEMA})), n AS (SELECT column_name AS name, column_type AS kind, row_number() OVER () AS place FROM (DESCRIBE {_NEW_SCHEMA})),
gone AS (SELECT o.* FROM o ANTI JOIN n USING (name)), come AS (SELECT n.* FROM n ANTI JOIN o USING (name)), pair AS (SELECT gone.name AS was, come.name AS now FROM gone JOIN come USING (kind, place))
SELECT was AS column_name, 'renamed' AS change, now AS new_name FROM pair UNION ALL SELECT name, 'removed', NULL FROM gone WHERE name NOT IN (SELECT was FROM pair) UNION ALL SELECT name, 'added', NULL FROM come WHERE name NOT IN (SELECT now FROM pair)
UNION ALL SELECT name, CASE WHEN o.kind <> n.kind THEN 'retyped' ELSE 'reordered' END, NULL FROM o JOIN n USING (name) WHERE o.kind <> n.kind OR o.place <> n.place""")
def schema_changes(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    new = c.select("c_custkey", F.col("c_name").alias("c_title"), "c_nationkey", F.col("c_acctbal").cast("string"), F.lit(1).alias("c_new"))
    return profile.schema_changes(profile.schema_rows(c), profile.schema_rows(new))


_LOGGED = "l AS (SELECT '2024-03-0' || (1 + event_id % 3) AS day, event_id::VARCHAR AS id, user_id::VARCHAR AS user, CASE WHEN event_id % 3 = 1 AND user_id % 2 = 0 THEN event_type END AS kind, CASE WHEN event_id % 3 > 0 AND user_id % 5 = 0 THEN ts::VARCHAR END AS noted FROM events)"


@query(f"""WITH {_LOGGED} SELECT column_name, 'string' AS column_type, min(day) AS first_seen, max(day) AS last_seen, count(DISTINCT day) AS batches FROM
  (UNPIVOT l ON id, user, kind, noted INTO NAME column_name VALUE v) GROUP BY 1 UNION ALL SELECT unnest(['_ingested_at', '_ingest_run_id']), 'string', min(day), max(day), count(DISTINCT day) FROM l""")
def schema_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log of a zone's columns, from batches of JSON whose null fields are left out, so that columns come and go with the data."""
    raw, e = zones.fresh_path(spark, "raw"), table(spark, sf, "events")
    k, user = F.col("event_id") % 3, F.col("user_id")
    lines = e.select(
        k.alias("batch"), F.col("event_id").cast("string").alias("id"), user.cast("string").alias("user"), F.when((k == 1) & (user % 2 == 0), F.col("event_type")).alias("kind"), F.when((k > 0) & (user % 5 == 0), F.col("ts").cast("string")).alias("noted")
    )
    for n in (0, 1, 2):
        drop = zones.fresh_path(spark, "json")
        lines.filter(F.col("batch") == n).drop("batch").write.json(drop)
        landing.append_batch(landing.land_records(spark.read.option("primitivesAsString", True).json(drop), f"r{n}", "now"), raw, f"2024-03-0{n + 1}")
    return landing.zone_columns(spark, raw)


# ---- reconciliation and upkeep


@query("""SELECT CASE WHEN event_id % 5 = 0 THEN 'early' ELSE 'late' END AS table_name, CASE WHEN user_id % 10 = 0 THEN '(no run id)' ELSE 'r' || (user_id % 10) END AS run_id, count(*) AS rows_held,
  count(DISTINCT strftime(ts, '%Y-%m-%d') || '/' || (event_id % 3)) AS files_held, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS n_partitions FROM events GROUP BY 1, 2""")
def rows_of_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, files and partitions of each run in each table; rows without a run are named."""
    day = F.date_format("ts", "yyyy-MM-dd")
    raw = table(spark, sf, "events").select(
        F.when(F.col("event_id") % 5 == 0, "early").otherwise("late").alias("table_name"), F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("r"), F.col("user_id") % 10)).alias("run_id"),
        day.alias("ingest_date"), F.concat_ws("/", day, F.col("event_id") % 3).alias("file"),
    )
    return reconcile.held_by_run(raw, by=("table_name",), file="file").select("table_name", "run_id", "rows_held", "files_held", F.size("partitions").cast("long").alias("n_partitions"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS ingest_date, count(*) AS rows, count(DISTINCT event_id % 3) AS files, count(DISTINCT user_id) AS keys FROM events GROUP BY 1")
def partition_files(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"), (F.col("event_id") % 3).alias("file"), "user_id")
    return versions.partition_state(e, "ingest_date", file="file", key="user_id")


_STATES = "s AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, count(DISTINCT event_id % 3) AS f FROM events GROUP BY 1), w AS (SELECT *, row_number() OVER (ORDER BY day) AS k, count(*) OVER () AS days FROM s)"


@query(f"""WITH {_STATES}, c AS (SELECT u.case_, day, CASE WHEN case_ = 'shrunk' AND k = 2 THEN n + 1 WHEN case_ IN ('grown', 'half') AND (k = 2 OR (case_ = 'half' AND k <= days)) THEN n - 1 ELSE n END AS was,
  CASE WHEN case_ = 'files' AND k = 3 THEN f + 1 ELSE f END AS files_were, n, f, case_ = 'vanished' AND k = 1 AS gone FROM w, (VALUES ('grown'), ('files'), ('shrunk'), ('vanished'), ('half'), ('swapped')) u(case_)),
d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) > 1 AND min(user_id) < max(user_id) AS differs FROM events GROUP BY 1),
t AS (SELECT case_, day, CASE WHEN gone THEN 'vanished' WHEN n > was THEN 'grown' WHEN n < was THEN 'shrunk' WHEN f <> files_were THEN 'grown' WHEN case_ = 'swapped' AND differs AND day = (SELECT day FROM w WHERE k = 2) THEN 'changed' ELSE 'same' END AS state FROM c JOIN d USING (day)),
v AS (SELECT case_, bool_or(state IN ('vanished', 'shrunk')) OR count(*) FILTER (state <> 'same') >= 0.5 * count(*) AS whole FROM t GROUP BY 1)
SELECT case_ AS scenario, day AS ingest_date, state, CASE WHEN whole THEN 'table' WHEN state <> 'same' THEN 'partition' ELSE 'none' END AS rebuild FROM t JOIN v USING (case_)""")
def rebuild_plans(spark: SparkSession, sf: str) -> DataFrame:
    """What is rebuilt when partitions grow, get files, shrink, vanish, are touched by half, or have two values swapped."""
    e = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"), (F.col("event_id") % 3).alias("file"), "event_id", "user_id")
    state = lambda df: versions.partition_state(df, "ingest_date", file="file", digest=["event_id", "user_id"])
    now = zones.stored(state(e), "states")
    k = {r.ingest_date: i for i, r in enumerate(now.select("ingest_date").orderBy("ingest_date").limit(3).collect(), 1)}
    first, second, third = (next(d for d, n in k.items() if n == i) for i in (1, 2, 3))
    at = lambda day: F.col("ingest_date") == day
    ends = e.filter(at(second)).agg(F.min_by("event_id", F.struct("user_id", "event_id")).alias("one"), F.max_by("event_id", F.struct("user_id", "event_id")).alias("two"), F.min("user_id").alias("u1"), F.max("user_id").alias("u2"))
    other = F.when(at(second) & (F.col("event_id") == F.col("one")), F.col("u2")).when(at(second) & (F.col("event_id") == F.col("two")), F.col("u1")).otherwise(F.col("user_id"))
    swapped = zones.stored(state(e.join(F.broadcast(ends)).withColumn("user_id", other)), "states")
    less = lambda where, by: now.withColumn("rows", F.when(where, F.col("rows") - by).otherwise(F.col("rows")))
    cases = {
        "grown": (less(at(second), 1), now), "files": (now.withColumn("files", F.when(at(third), F.col("files") + 1).otherwise(F.col("files"))), now),
        "shrunk": (less(at(second), -1), now), "vanished": (now, now.filter(~at(first))), "half": (less(F.lit(True), 1), now), "swapped": (swapped, now),
    }
    return activity.union_all([reconcile.changed_partitions(old, new, "ingest_date").withColumn("scenario", F.lit(name)) for name, (old, new) in cases.items()])


@query("""WITH k AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS key, c_custkey FROM customer)
SELECT '2024-01-01' AS day, count(*) AS rows, count(*) FILTER (key IS NULL OR c_custkey % 10 = 3) AS unreachable, 0::BIGINT AS regressed, count(*) FILTER (key IS NULL OR c_custkey % 10 = 3) = 0 AS proven FROM k WHERE c_custkey % 2 = 1 OR c_custkey % 4 = 0
UNION ALL SELECT '2024-01-02', count(*), 0, count(*) FILTER (c_custkey % 9 = 0), count(*) FILTER (c_custkey % 9 = 0) = 0 FROM k WHERE c_custkey % 10 <> 3 AND key IS NOT NULL AND c_custkey % 3 = 0""")
def supersession_with_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A null key is never found again; keys that are gone or whose version went back leave a partition unproven."""
    c = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")).alias("key"), "c_custkey")
    old = c.filter("c_custkey % 2 = 1 or c_custkey % 4 = 0").select("key", F.lit("2024-01-01").alias("day"), F.lit(1).alias("v"))
    mid = c.filter("c_custkey % 10 <> 3 and key is not null and c_custkey % 3 = 0").select("key", F.lit("2024-01-02").alias("day"), F.when(F.col("c_custkey") % 9 == 0, 9).otherwise(2).alias("v"))
    new = c.filter("c_custkey % 10 <> 3").select("key", F.lit("2024-01-03").alias("day"), F.lit(3).alias("v"))
    return reconcile.supersession(old.unionByName(mid).unionByName(new), "day", "key", "v")


@query("""WITH e AS (SELECT event_type AS t, max(event_id) AS held FROM events GROUP BY 1), x AS (SELECT *, row_number() OVER (ORDER BY t) AS k FROM e)
SELECT t AS event_type, CASE k WHEN 1 THEN held WHEN 2 THEN held + 1 WHEN 3 THEN held - 1 END AS claimed, held, CASE k WHEN 1 THEN 'none' WHEN 2 THEN 'ahead' WHEN 3 THEN 'behind' ELSE 'unclaimed' END AS drift FROM x""")
def position_drifts(spark: SparkSession, sf: str) -> DataFrame:
    """Claimed positions that agree, are ahead, are behind, or are missing, one kind of event each."""
    e = table(spark, sf, "events")
    kinds = e.select("event_type").distinct()
    claims = _off_by(kinds).join(e, "event_type").select("event_type", (F.col("event_id") + F.col("by")).alias("watermark_out"))
    return reconcile.position_drift(claims, e, "event_id", by=["event_type"])


def _off_by(kinds: DataFrame) -> DataFrame:
    """The first three kinds by name, with what their claims are off by."""
    off = F.element_at(F.array(F.lit(0), F.lit(1), F.lit(-1)), F.col("k").cast("int"))
    return ranks.numbered(kinds, [F.col("event_type")], "k").filter("k <= 3").select("event_type", off.alias("by"))


_PRUNED = """r AS (SELECT c_custkey AS key, '2024-01-01' AS day, 1 AS v FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, '2024-01-02', CASE WHEN c_custkey = 10 THEN 9 ELSE 2 END FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, '2024-01-03', 3 FROM customer WHERE c_custkey NOT IN (7, 8)),
k AS (SELECT key FROM r WHERE day = '2024-01-03'), s AS (SELECT day, count(*) AS rows, bool_and(k.key IS NOT NULL AND v <= 3) AS proven FROM r LEFT JOIN k USING (key) GROUP BY day)"""


@query(f"WITH {_PRUNED} SELECT day AS ingest_date, rows, 'run-' || day AS run_id FROM s WHERE day = '2024-01-03' OR NOT proven")
def pruned_zone(spark: SparkSession, sf: str) -> DataFrame:
    """Days of a snapshot zone, with their runs, after a retention plan has been applied to both; a dry run before it leaves all."""
    raw, runs, c = zones.fresh_path(spark, "raw"), zones.fresh_path(spark, "runs"), table(spark, sf, "customer")
    k = F.col("c_custkey")
    days = {"2024-01-01": (k % 3 == 0, F.lit(1)), "2024-01-02": (k % 2 == 0, F.when(k == 10, 9).otherwise(2)), "2024-01-03": (~k.isin(7, 8), F.lit(3))}
    for day, (where, v) in days.items():
        rows = c.filter(where).select(k.alias("key"), v.alias("v"))
        landing.ingest(rows, raw, runs, "v", run_id=f"run-{day}", dataset="customers", ingest_date=day, finished_at="2024-03-01 00:00:00", mode="snapshot")
    held = landing.read_raw(spark, raw)
    fates = zones.stored(reconcile.retention(held, reconcile.supersession(held, "ingest_date", "key", "v"), "ingest_date", 1), "fates")
    for dry in (True, False):
        landing.prune(spark, raw, runs, fates, "2024-03-02 00:00:00", dry_run=dry)
    left = landing.read_raw(spark, raw).groupBy("ingest_date").agg(F.count("*").alias("rows"))
    return left.join(landing.read_runs(spark, runs).select("ingest_date", "run_id"), "ingest_date", "full_outer")


@query("SELECT 'events' AS dataset, count(*) AS row_count, max(ts) AS latest_load, max('r' || event_id) AS latest_run FROM events UNION ALL SELECT 'views', count(*), max(ts), max('r' || event_id) FROM events WHERE event_type = 'view'")
def latest_loads(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("run", F.concat(F.lit("r"), "event_id"))
    return freshness.loads({"events": (e, "ts"), "views": (e.filter("event_type = 'view'"), "ts")}, run="run")


# ---- streams


_SINCE = "(SELECT (max(updated_at)::DATE - 7)::VARCHAR FROM ev)"


@query(f"""WITH {_EVENTS}, r AS (SELECT 's-' || (id::BIGINT % 2) AS _ingest_run_id, count(*) AS landed, count(*) FILTER (updated_at < {_SINCE}) AS late FROM ev GROUP BY 1), again AS (SELECT count(*) AS n FROM ev WHERE id::BIGINT % 6 = 0)
SELECT id, user, event_type, updated_at, max(updated_at) OVER ()[:10] AS ingest_date, _ingest_run_id, late AS rows_late, CASE _ingest_run_id WHEN 's-1' THEN n ELSE 0 END AS rows_again FROM ev JOIN r ON _ingest_run_id = 's-' || (id::BIGINT % 2), again""")
def streamed_landing(spark: SparkSession, sf: str) -> DataFrame:
    """JSON drops landed by a stream that is started twice; the second drop sends a third of the first one again. Run records count these and the late ones."""
    drops, raw, runs = (zones.fresh_path(spark, n) for n in ("drops", "raw", "stream-runs"))
    e = _events(spark, sf)
    day, k = e.agg(F.max("updated_at")).first()[0][:10], F.col("id").cast("long")
    for part in (k % 2 == 0, (k % 2 == 1) | (k % 6 == 0)):
        e.filter(part).coalesce(1).write.mode("append").json(drops)
        feeds.land_stream(spark, drops, "id string, user string, event_type string, props string, updated_at string", raw, f"{raw}-check", "s", day, runs, "updated_at", key="id").awaitTermination()
    records = landing.read_runs(spark, runs).select(F.col("run_id").alias("_ingest_run_id"), "rows_late", "rows_again")
    got = spark.read.parquet(raw).withColumn("ingest_date", F.col("ingest_date").cast("string"))
    return got.join(F.broadcast(records), "_ingest_run_id").select("id", "user", "event_type", "updated_at", "ingest_date", "_ingest_run_id", "rows_late", "rows_again")


@query("SELECT user_id::VARCHAR AS user, arg_max(event_id, struct_pack(t := ts, e := event_id))::VARCHAR AS id, arg_max(event_type, struct_pack(t := ts, e := event_id)) AS event_type FROM events GROUP BY 1")
def streamed_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest event of every user, kept current over two drops, the newer half first."""
    drops, latest = zones.fresh_path(spark, "drops"), zones.fresh_path(spark, "latest")
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user"), F.format_string("%012d", "event_id").alias("id"), "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))
    schema, k = "user string, id string, event_type string, at string", F.col("id").cast("long")
    for newer in (True, False):
        e.filter((k % 2 == 0) if newer else (k % 2 == 1)).coalesce(4).write.mode("append").json(drops)
        feeds.latest_stream(spark, drops, schema, latest, f"{latest}-check", ["user"], ["at", "id"]).awaitTermination()
    return feeds.read_latest(spark, latest, schema).select("user", F.col("id").cast("long").cast("string").alias("id"), "event_type")


@query("""WITH e AS (SELECT user_id, event_id, event_type || '-' || event_id % 97 AS place, ts + to_months((event_id % 4)::INT) AS moved FROM events),
l AS (SELECT user_id, arg_max(place, struct_pack(t := moved, e := event_id)) AS place, date_trunc('month', max(moved))::DATE AS event_month FROM e GROUP BY 1) SELECT place, event_month, count(*) AS event_count FROM l GROUP BY 1, 2""")
def streamed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly counts over the newest event of every user, kept by its changes: users move place and month from drop to drop, and groups vanish."""
    drops, latest, counts = (zones.fresh_path(spark, n) for n in ("drops", "latest", "counts"))
    at = F.col("ts") + F.make_interval(months=(F.col("event_id") % 4).cast("int"))
    e = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user"), F.format_string("%012d", "event_id").alias("id"), F.concat_ws("-", "event_type", F.col("event_id") % 97).alias("place"), F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
    )
    schema = "user string, id string, place string, at string"
    for part in (0, 1, 2):
        e.filter(F.col("id").cast("long") % 3 == part).coalesce(4).write.mode("append").json(drops)
        feeds.recount_stream(spark, drops, schema, latest, counts, f"{latest}-check", ["user"], ["at", "id"], "place", "at").awaitTermination()
    return feeds.read_counts(spark, counts, "place")
