"""Coordinates and hexagon cells as column expressions: a grid on a cylindrical equal-area plane, ids in a BIGINT."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemetrics.functions.casts import safe_number

RADIUS, PARALLEL = 6371.0088, 37.77
#: Cell areas in square kilometres by resolution.
AREA = {8: 0.7373275976, 10: 0.0150475019}
#: City box: south, north, west, east.
BOX = (37.60, 37.93, -123.20, -122.28)
STATUSES = ("ok", "missing", "unparseable", "impossible", "out_of_bounds")

_COS = math.cos(math.radians(PARALLEL))
_ROOT3 = math.sqrt(3.0)


def side(resolution: int) -> float:
    return math.sqrt(2.0 * AREA[resolution] / (3.0 * _ROOT3))


def coordinate_status(lat: Column, lon: Column, box: tuple[float, float, float, float] = BOX) -> Column:
    """missing, unparseable, impossible, out_of_bounds or ok, tested in this order, from the texts of a coordinate."""
    y, x = safe_number(lat), safe_number(lon)
    empty = lat.isNull() | lon.isNull() | (F.trim(lat) == "") | (F.trim(lon) == "")
    odd = F.isnan(y) | F.isnan(x) | (F.abs(y) > 90) | (F.abs(x) > 180) | ((y == 0) & (x == 0))
    inside = y.between(box[0], box[1]) & x.between(box[2], box[3])
    return F.when(empty, "missing").when(y.isNull() | x.isNull(), "unparseable").when(odd, "impossible").when(~inside, "out_of_bounds").otherwise("ok")


def plane_x(lon: Column) -> Column:
    return F.lit(RADIUS * _COS) * F.radians(lon)


def plane_y(lat: Column) -> Column:
    return F.lit(RADIUS / _COS) * F.sin(F.radians(lat))


def corner_lon(x: Column) -> Column:
    return F.degrees(x / F.lit(RADIUS * _COS))


def corner_lat(y: Column) -> Column:
    return F.degrees(F.asin(y * F.lit(_COS / RADIUS)))


def pack(q: Column, r: Column, resolution: int) -> Column:
    return (F.lit(resolution).cast("long") * F.lit(1 << 58) + (q.cast("long") + (1 << 27)) * F.lit(1 << 29) + (r.cast("long") + (1 << 27))).cast("long")


def unpack(cell: Column) -> tuple[Column, Column]:
    """q and r of a cell."""
    low = F.lit((1 << 29) - 1)
    return F.shiftright(cell, 29).bitwiseAND(low) - (1 << 27), cell.bitwiseAND(low) - (1 << 27)


def _spread_bits(x: Column) -> Column:
    """The low 31 bits of a number with a zero between any two of them."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def curve(cell: Column) -> Column:
    """Place of a cell along a Z-order curve over q and r: cells near each other are mostly near along it."""
    q, r = unpack(cell)
    return _spread_bits(q + (1 << 27)).bitwiseOR(F.shiftleft(_spread_bits(r + (1 << 27)), 1))


def cell(lat: Column, lon: Column, resolution: int) -> Column:
    """The cell that holds a point; NULL for a null coordinate."""
    s = side(resolution)
    x, y = plane_x(lon), plane_y(lat)
    q, r = (F.lit(_ROOT3 / 3.0) * x - y / 3.0) / s, (F.lit(2.0 / 3.0) * y) / s
    t = -q - r
    rq, rr, rt = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(t + 0.5)
    dq, dr, dt = F.abs(rq - q), F.abs(rr - r), F.abs(rt - t)
    first, second = (dq > dr) & (dq > dt), dr > dt
    return pack(F.when(first, -rr - rt).otherwise(rq), F.when(~first & second, -rq - rt).otherwise(rr), resolution)


def points(df: DataFrame, source: str, key: str, lat: str, lon: str) -> DataFrame:
    """source_table, row_key, latitude, longitude, coordinate_status, is_usable_coordinate, h3_r8, h3_r10."""
    status = coordinate_status(F.col(lat), F.col(lon))
    rows = df.select(F.lit(source).alias("source_table"), F.col(key).cast("string").alias("row_key"), status.alias("coordinate_status"), F.col(lat).alias("__lat"), F.col(lon).alias("__lon"))
    seen = F.col("coordinate_status").isin("ok", "out_of_bounds")
    rows = rows.withColumns({"latitude": F.when(seen, safe_number(F.col("__lat"))), "longitude": F.when(seen, safe_number(F.col("__lon")))})
    at = [cell(F.col("latitude"), F.col("longitude"), r).alias(f"h3_r{r}") for r in (8, 10)]
    return rows.select("source_table", "row_key", "latitude", "longitude", "coordinate_status", (F.col("coordinate_status") == "ok").alias("is_usable_coordinate"), *at)


def status_breakdown(rows: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("coordinate_status") == s).alias(s) for s in STATUSES]
    return rows.groupBy("source_table").agg(F.count("*").alias("total"), *counts)


def from_geojson(col: Column) -> tuple[Column, Column]:
    """Latitude and longitude texts of a GeoJSON point, which gives longitude first."""
    return F.get_json_object(col, "$.coordinates[1]"), F.get_json_object(col, "$.coordinates[0]")
