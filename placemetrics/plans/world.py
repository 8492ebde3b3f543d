"""Inputs for the queries, derived from the given tables: places, points, polygons, versioned rows and registries."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "2024-02-01 00:00:00"
WEST, SOUTH, WIDE, HIGH = -123.2, 37.6, 0.184, 0.066
SETS = ("nation", "region")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def coordinates(df: DataFrame, key: str) -> DataFrame:
    """lat_text and lon_text from a key, some of them bad on purpose."""
    k = F.col(key)
    lat, lon = F.lit(SOUTH) + ((k * 7919) % 33000) / F.lit(1e5), F.lit(WEST) + ((k * 104729) % 92000) / F.lit(1e5)
    bad = k % 97
    texts = {
        "lat_text": F.when(bad == 1, "").when(bad == 2, "abc").when(bad == 3, "0").when(bad == 4, "33.954319593").otherwise(lat.cast("string")),
        "lon_text": F.when(bad == 3, "0").when(bad == 4, "-84.19922231").otherwise(lon.cast("string")),
    }
    return df.withColumns(texts)


def boundaries(spark: SparkSession, sf: str) -> DataFrame:
    """A tiling of 25 nations, one with a hole, one of two parts, one L-shaped; and five strips of regions."""
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"))
    box = {"x0": F.lit(WEST) + (F.col("k") % 5) * F.lit(WIDE), "y0": F.lit(SOUTH) + F.expr("k div 5") * F.lit(HIGH)}
    n = n.withColumns(box).withColumns({"x1": F.lit(WEST) + (F.col("k") % 5 + 1) * F.lit(WIDE), "y1": F.lit(SOUTH) + (F.expr("k div 5") + 1) * F.lit(HIGH)})

    def ring(*points: tuple[str, str]) -> str:
        return "concat('[', " + ", ',', ".join(f"'[', {x}, ',', {y}, ']'" for x, y in points) + ", ']')"

    def rect(x0: str, y0: str, x1: str, y1: str) -> str:
        return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))

    whole = rect("x0", "y0", "x1", "y1")
    hole = rect("x0 + 0.05", "y0 + 0.02", "x0 + 0.1", "y0 + 0.04")
    two = f"concat('{{\"type\":\"MultiPolygon\",\"coordinates\":[[', {rect('x0', 'y0', 'x0 + 0.06', 'y1')}, '],[', {rect('x0 + 0.12', 'y0', 'x1', 'y1')}, ']]}}')"
    ell = ring(("x0", "y0"), ("x1", "y0"), ("x1", "y0 + 0.03"), ("x0 + 0.09", "y0 + 0.03"), ("x0 + 0.09", "y1"), ("x0", "y1"))
    one = lambda r: f"concat('{{\"type\":\"Polygon\",\"coordinates\":[', {r}, ']}}')"
    shape = f"case k when 0 then {two} when 12 then {one(f'concat({whole}, {chr(39)},{chr(39)}, {hole})')} when 24 then {one(ell)} else {one(whole)} end"
    shape = re.sub(r"(\+ 0\.\d+)", r"\1D", shape)  # doubles, not decimals
    nations = n.select(F.lit("nation").alias("boundary_set"), F.col("k").cast("string").alias("boundary_id"), F.expr(shape).alias("geojson"))
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("k"))
    r = r.withColumns({"x0": F.lit(WEST), "x1": F.lit(WEST) + 5 * F.lit(WIDE), "y0": F.lit(SOUTH) + F.col("k") * F.lit(HIGH), "y1": F.lit(SOUTH) + (F.col("k") + 1) * F.lit(HIGH)})
    return nations.unionByName(r.select(F.lit("region").alias("boundary_set"), F.col("k").cast("string").alias("boundary_id"), F.expr(one(whole)).alias("geojson")))


#: Directions of a ring's sixteen vertices.
ROUND = [(round(math.cos(math.pi * i / 8), 6), round(0.8 * math.sin(math.pi * i / 8), 6)) for i in range(16)]


def rings(spark: SparkSession, sf: str) -> DataFrame:
    """A ring of sixteen slanted edges for each supplier, a thousand to a set: every seventh with a hole, every tenth tiny."""
    k = F.col("s_suppkey")
    x, y = F.lit(WEST + 0.02) + (k % 40) * F.lit(0.022), F.lit(SOUTH + 0.01) + (F.expr("s_suppkey div 40") % 25) * F.lit(0.0128)
    size = F.when(k % 10 == 0, 0.0002).otherwise(0.006)

    def ring(part: float):
        points = [F.concat(F.lit("["), F.round(x + size * F.lit(part) * a, 6).cast("string"), F.lit(","), F.round(y + size * F.lit(part) * b, 6).cast("string"), F.lit("]")) for a, b in ROUND]
        return F.concat(F.lit("["), F.concat_ws(",", *points), F.lit("]"))

    shape = F.concat(F.lit('{"type":"Polygon","coordinates":['), ring(1.0), F.when(k % 7 == 0, F.concat(F.lit(","), ring(0.5))).otherwise(""), F.lit("]}"))
    return table(spark, sf, "supplier").select(F.concat(F.lit("ring"), F.expr("s_suppkey div 1000")).alias("boundary_set"), k.cast("string").alias("boundary_id"), shape.alias("geojson"))


def versioned_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as strings, every tenth again later with another value, and a tie on the first order column."""
    e = table(spark, sf, "events")
    first = e.select(*(F.col(c).cast("string").alias(c) for c in ("event_id", "user_id", "event_type")), F.col("ts").cast("string").alias("updated_at"), F.lit("2024-03-01").alias("ingested_at"), F.lit("first").alias("version"))
    again = first.filter("cast(event_id as bigint) % 10 = 0").withColumns({"ingested_at": F.lit("2024-03-02"), "version": F.lit("second")})
    return first.unionByName(again)


def place_events(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Orders by their customer's nation and lineitems by their supplier's, as datasets of the spine."""
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("place"))
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("place"))
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    orders = o.join(c, o["o_custkey"] == c["c_custkey"], "left").select(F.lit("orders").alias("dataset"), F.col("o_orderkey").cast("string").alias("row_key"), F.col("o_orderpriority").alias("category"), F.col("o_orderdate").cast("string").alias("event_date"), "place")
    items = li.join(s, li["l_suppkey"] == s["s_suppkey"], "left").select(F.lit("lineitem").alias("dataset"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_key"), F.nullif("l_returnflag", F.lit("N")).alias("category"), F.col("l_shipdate").cast("string").alias("event_date"), "place")
    return [orders, items]


def residents(spark: SparkSession, sf: str) -> DataFrame:
    """People and housing units (customers, and those with a balance) of every nation."""
    c = table(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("string").alias("boundary_id"))
    return c.agg(F.count("*").alias("population"), F.count_if(F.col("c_acctbal") > 0).alias("housing_units"))


def firms(spark: SparkSession, sf: str, place: str = "nation") -> DataFrame:
    """Active businesses (suppliers with a balance) of every nation or region."""
    own = F.col("s_nationkey") if place == "nation" else F.expr("s_nationkey div 5")
    return table(spark, sf, "supplier").groupBy(own.cast("string").alias("boundary_id")).agg(F.count_if(F.col("s_acctbal") > 0).alias("businesses"))
