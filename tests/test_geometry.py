"""Containment, area, covering cells and membership on shapes with known answers."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from placemetrics.operators import cells, membership, polygons


def square(x0, y0, x1, y1):
    return f"[[{x0},{y0}],[{x1},{y0}],[{x1},{y1}],[{x0},{y1}],[{x0},{y0}]]"


def poly(*rings):
    return '{"type":"Polygon","coordinates":[' + ",".join(rings) + "]}"


SHAPES = [
    ("tiles", "a", poly(square(0, 0, 1, 1))), ("tiles", "b", poly(square(1, 0, 2, 1))), ("tiles", "c", poly(square(0, 1, 1, 2))), ("tiles", "d", poly(square(1, 1, 2, 2))),
    ("odd", "hole", poly(square(0, 0, 2, 2), square(0.5, 0.5, 1.5, 1.5))), ("odd2", "two", '{"type":"MultiPolygon","coordinates":[[' + square(0, 0, 0.5, 2) + "],[" + square(1.5, 0, 2, 2) + "]]}"),
    ("none", "point", '{"type":"Point","coordinates":[1,1]}'), ("none", "bad", "not json"), ("none", "null", None), ("flat", "line", poly("[[0,0],[1,1],[0,0]]")),
]
POINTS = [(x / 4, y / 4) for x in range(-1, 10) for y in range(-1, 10)]


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame(SHAPES, "boundary_set string, boundary_id string, geojson string")


def test_both_containment_forms_agree_and_edges_have_one_owner(spark, shapes):
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(POINTS)], "n long, longitude double, latitude double")
    pairs = points.crossJoin(shapes.select("boundary_set", "boundary_id"))
    joined = {(r.n, r.boundary_set, r.boundary_id) for r in polygons.inside(pairs, polygons.edges(shapes), ["n"]).collect()}
    hit = points.crossJoin(shapes).filter(polygons.contains(polygons.polygons(F.col("geojson")), F.col("longitude"), F.col("latitude")))
    assert joined == {(r.n, r.boundary_set, r.boundary_id) for r in hit.collect()}
    for i, (x, y) in enumerate(POINTS):
        owners = [b for n, s, b in joined if n == i and s == "tiles"]
        assert len(owners) == (1 if 0 <= x < 2 and 0 <= y < 2 else 0)
        assert ((i, "odd", "hole") in joined) == (0 <= x < 2 and 0 <= y < 2 and not (0.5 <= x < 1.5 and 0.5 <= y < 1.5))
        assert ((i, "odd2", "two") in joined) == (0 <= y < 2 and (0 <= x < 0.5 or 1.5 <= x < 2))
    assert not [b for _, s, b in joined if s in ("none", "flat")]


def test_area(shapes):
    got = {(r.boundary_set, r.boundary_id): r.area_sq_km for r in polygons.area(polygons.edges(shapes)).collect()}
    assert math.isclose(got["tiles", "a"], 12363.718145180046, rel_tol=1e-12)
    tiles = sum(v for (s, _), v in got.items() if s == "tiles")
    assert math.isclose(got["odd", "hole"], tiles - polygon_km(0.5, 0.5, 1.5, 1.5), rel_tol=1e-9)
    assert math.isclose(got["odd2", "two"], polygon_km(0, 0, 0.5, 2) * 2, rel_tol=1e-9)


def polygon_km(x0, y0, x1, y1):
    return math.radians(x1 - x0) * (math.sin(math.radians(y1)) - math.sin(math.radians(y0))) * polygons.RADIUS**2


@pytest.mark.parametrize(
    ("lat", "lon", "status"),
    [("37.7", "-122.4", "ok"), (None, "1", "missing"), ("not-a-number", "", "missing"), ("abc", "-122.4", "unparseable"), ("1.5d", "2", "unparseable"), ("0", "0", "impossible"),
     ("5999163.5213", "2110903.9816", "impossible"), ("NaN", "1", "impossible"), ("33.954319593", "-84.19922231", "out_of_bounds")],
)
def test_coordinate_status(spark, lat, lon, status):
    df = spark.createDataFrame([("k", lat, lon)], "k string, lat string, lon string")
    r = cells.points(df, "t", "k", "lat", "lon").first()
    assert r.coordinate_status == status
    assert (r.h3_r8 is None) == (status in ("missing", "unparseable", "impossible")) == (r.latitude is None)


def test_membership_with_a_slanted_boundary_equals_the_exact_test(spark):
    shape = [("s", "left", poly("[[-122.6,37.62],[-122.45,37.62],[-122.41,37.8],[-122.52,37.78]]")), ("s", "right", poly("[[-122.45,37.62],[-122.3,37.66],[-122.35,37.82],[-122.41,37.8]]")),
             ("t", "tiny", poly(square(-122.4001, 37.7, -122.4, 37.7001)))]
    b = spark.createDataFrame(shape, "boundary_set string, boundary_id string, geojson string")
    rng = random.Random(1)
    given = [(str(i), str(rng.uniform(37.6, 37.83)), str(rng.uniform(-122.62, -122.28))) for i in range(1500)] + [("mid", "37.70005", "-122.40005")]
    points = cells.points(spark.createDataFrame(given, "k string, lat string, lon string"), "t", "k", "lat", "lon")
    edge = polygons.edges(b)
    bridge = polygons.bridge(edge, (8,)).cache()
    kept = {(r.boundary_set, r.boundary_id): r for r in bridge.groupBy("boundary_set", "boundary_id").agg(F.count_if("is_interior").alias("i"), F.count_if("is_allocation_cell").alias("a"), F.count_if(F.col("is_interior") & ~F.col("is_allocation_cell")).alias("bad")).collect()}
    assert kept["s", "left"].i > 0 and kept["t", "tiny"].a == 1 and not any(r.bad for r in kept.values())
    assert bridge.filter("is_primary").groupBy("boundary_set", "resolution", "h3_cell").count().filter("count > 1").count() == 0
    assigned = membership.assign(points, bridge, edge, 8)
    answers = membership.oracle(points.filter("is_usable_coordinate"), b)
    assert answers.filter("exact_boundary_id is not null").count() > 500
    assert membership.disagreement(answers, assigned).count() == 0
    again = membership.oracle(points.filter("is_usable_coordinate"), b, cache=answers)
    assert again.exceptAll(answers).count() == 0
