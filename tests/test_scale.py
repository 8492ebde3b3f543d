"""Ranks, medians, parity, partition digests, covers: the forms that hold at scale against plain ones, and how much each task sees."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from placemetrics import queries
from placemetrics.operators import cells, membership, polygons, profile, ranks, reconcile, versions
from placemetrics.plans import activity
from placemetrics.sources import landing
from placemetrics.sources.zones import stored


def test_ranks_equal_a_window_over_the_whole_table(spark):
    rng = random.Random(2)
    given = [(i, rng.choice([None, 1.0, 2.0, 2.0, 2.0, 3.5]) if i % 3 else float(rng.randint(0, 400)), rng.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(given, "id long, density double, events int").withColumn("rate", F.col("density") / 7).repartition(6)
    got = activity.three_ranks(df)
    by = {"count_rank": "events", "density_rank": "density", "rate_rank": "rate"}
    want = df.withColumns({name: F.rank().over(Window.orderBy(F.col(c).desc_nulls_last())) for name, c in by.items()})
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert "SinglePartition" not in got._jdf.queryExecution().toString()
    numbers = ranks.numbered(df, [F.col("events").desc(), F.col("id")]).collect()
    assert [r.id for r in sorted(numbers, key=lambda r: r.row_number)] == [i for i, _, e in sorted(given, key=lambda g: (-g[2], g[0]))]
    assert not ranks.numbered(df.limit(0), [F.col("id")]).collect() and not ranks.ranked(df.limit(0), "events", "n").collect()


@pytest.mark.parametrize("tail", [1e12, 5.0])
def test_median_of_a_heavy_tail_sees_a_small_part(spark, monkeypatch, tail):
    sizes, real = [], profile.stored
    monkeypatch.setattr(profile, "stored", lambda df, name: sizes.append((name, (out := real(df, name)).count())) or out)
    values = spark.range(100_000).select((F.col("id") * 7 % 100_000 / 1000).alias("x")).unionByName(spark.createDataFrame([(tail,)], "x double"))
    numbers = [i * 7 % 100_000 / 1000 for i in range(100_000)] + [tail]
    row = profile.profile(values).first()
    assert row["median"] == statistics.median(numbers) and row["high"] == max(numbers)
    assert all(n < 0.05 * 100_000 for name, n in sizes if name == "middles")
    monkeypatch.setattr(profile, "SORTED", 100)
    sizes.clear()
    assert profile.profile(values).first()["median"] == statistics.median(numbers)
    assert [n for name, n in sizes if name == "middles"][-1] <= 100


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 1.0, 1.0, 9.0], [2.0] * 5 + [1.0] * 5, [None, 4.0, float("inf")], [float(x % 13) for x in range(1000)]])
def test_median_of_small_columns(spark, values):
    got = profile.profile(spark.createDataFrame([(v,) for v in values], "x double")).first()["median"]
    assert got == statistics.median([v for v in values if v is not None])


def test_parity_joins_only_the_ranges_that_differ(spark):
    a = spark.range(20_000).select(F.col("id").alias("k"), *(F.col("id").cast("string").alias(f"c{n}") for n in range(4)), F.lit(None).cast("double").alias("empty"))
    b = a.withColumns({"c1": F.when(F.col("k") == 17, "x").otherwise(F.col("c1")), "c3": F.when(F.col("k").isin(17, 19_000), None).otherwise(F.col("c3"))}).filter("k <> 5")
    leaves, cols = profile.differing_ranges(a, b, ["k"])
    assert len(leaves) == 3 and set(cols) == {"c0", "c1", "c2", "c3", "empty"}
    got = {(r.column_name, r.k) for r in profile.differing(a, b, ["k"]).collect()}
    assert got == {("c0", 5), ("c1", 5), ("c2", 5), ("c3", 5), ("empty", 5), ("c1", 17), ("c3", 17), ("c3", 19_000)}
    plan = profile.differing(a, b, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1
    rows = a.withColumn("leaf", F.pmod(F.xxhash64(profile.canonical(F.col("k"), "bigint")), F.lit(profile.LEAVES).cast("long"))).filter(F.col("leaf").isin(leaves)).count()
    assert rows < 60  # of 20,000
    assert profile.differing_ranges(a, a, ["k"]) == ([], []) and not profile.differing(a, a, ["k"]).collect()


def test_a_partition_written_again_with_as_many_rows_is_found(spark):
    rows = [("d1", 1, "a"), ("d1", 2, "b"), ("d2", 3, "c"), ("d2", 3, "c"), ("d3", 4, None), ("d4", 5, "e"), ("d4", 6, "f")]
    state = lambda given: versions.partition_state(spark.createDataFrame(given, "day string, k int, v string"), "day", digest=["k", "v"])
    swapped = [("d1", 1, "b"), ("d1", 2, "a"), *rows[2:]]
    fate = lambda new: {r.day: (r.state, r.rebuild) for r in reconcile.changed_partitions(state(rows), state(new), "day").collect()}
    assert fate(swapped) == {"d1": ("changed", "partition"), "d2": ("same", "none"), "d3": ("same", "none"), "d4": ("same", "none")}
    assert {s for s, _ in fate(rows[::-1]).values()} == {"same"}
    once = [*rows[:2], ("d2", 3, "c"), ("d2", 9, "c"), *rows[4:]]
    assert fate(once)["d2"] == ("changed", "partition")
    with pytest.raises(ValueError, match="digest"):
        reconcile.changed_partitions(versions.partition_state(spark.createDataFrame(rows, "day string, k int, v string"), "day"), state(rows), "day")


def star(x, y, size, points, inner=0.45):
    import math

    at = [(x + size * (1 if i % 2 else inner) * math.cos(math.pi * i / points), y + 0.8 * size * (1 if i % 2 else inner) * math.sin(math.pi * i / points)) for i in range(2 * points)]
    return "[" + ",".join(f"[{a:.7f},{b:.7f}]" for a, b in at) + "]"


@pytest.fixture(scope="module")
def stars(spark):
    shapes = [("s", "spiky", '{"type":"Polygon","coordinates":[' + star(-122.5, 37.7, 0.05, 9) + "]}"), ("s", "holed", '{"type":"Polygon","coordinates":[' + star(-122.35, 37.75, 0.06, 7, 0.8) + "," + star(-122.35, 37.75, 0.02, 5) + "]}"),
              ("t", "two", '{"type":"MultiPolygon","coordinates":[[' + star(-122.6, 37.8, 0.03, 4) + "],[" + star(-122.59, 37.8, 0.03, 6) + "]]}"), ("t", "flat", '{"type":"Polygon","coordinates":[[[-122.7,37.65],[-122.4,37.65],[-122.4,37.6501],[-122.7,37.6501]]]}')]
    return spark.createDataFrame(shapes, "boundary_set string, boundary_id string, geojson string")


def test_cover_equals_a_test_of_every_cell(spark, stars):
    """Centres by the test without cells; touched cells by many points along each edge, which must all lie in covered cells."""
    edge = polygons.edges(stars)
    cover = polygons.cover(edge, 8).cache()
    assert cover.count() == cover.select("boundary_set", "boundary_id", "q", "r").distinct().count()
    box = [cells.cell(F.lit(a), F.lit(b), 8) for a in (37.55, 37.9) for b in (-122.8, -122.2)]
    corners = [cells.unpack(c) for c in box]
    lows = spark.range(1).select(*(F.least(*(c[i] for c in corners)).alias(f"a{i}") for i in (0, 1)), *(F.greatest(*(c[i] for c in corners)).alias(f"b{i}") for i in (0, 1))).first()
    grid = spark.range(lows.a0, lows.b0 + 1).withColumnRenamed("id", "q").crossJoin(spark.range(lows.a1, lows.b1 + 1).withColumnRenamed("id", "r"))
    lon, lat = polygons._center(F.col("q"), 8), cells.corner_lat(F.col("r") * (1.5 * cells.side(8)))
    held = grid.crossJoin(stars).filter(polygons.contains(polygons.polygons(F.col("geojson")), lon, lat)).select("boundary_set", "boundary_id", "q", "r")
    centers = cover.filter("is_center").select("boundary_set", "boundary_id", "q", "r")
    assert centers.exceptAll(held).count() == 0 == held.exceptAll(centers).count() and held.count() > 50
    along = edge.withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(400)))).select("boundary_set", "boundary_id", (F.col("x1") + F.col("f") / 400 * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + F.col("f") / 400 * (F.col("y2") - F.col("y1"))).alias("y"))
    q, r = cells.unpack(cells.cell(F.col("y"), F.col("x"), 8))
    along = along.select("boundary_set", "boundary_id", q.alias("q"), r.alias("r")).distinct()
    touched = cover.filter("is_touched").select("boundary_set", "boundary_id", "q", "r")
    assert along.exceptAll(touched).count() == 0
    assert touched.count() <= along.count() * 1.1  # the rest are corners that an edge only grazes, a thousandth enlarged


@pytest.mark.parametrize("resolution", [8, 10])
def test_the_compact_cover_stands_for_the_cover(spark, stars, resolution):
    edge = polygons.edges(stars)
    cover = polygons.cover(edge, resolution).select("boundary_set", "boundary_id", "q", "r", (F.col("is_center") & ~F.col("is_touched")).alias("is_interior"))
    runs = polygons.compact_cover(edge, resolution).cache()
    spread = runs.withColumn("q", F.explode(F.sequence("q0", "q1"))).select("boundary_set", "boundary_id", "q", "r", "is_interior")
    assert spread.exceptAll(cover).count() == 0 == cover.exceptAll(spread).count()
    assert runs.filter(f"floor(q0 / {polygons.RUN}) <> block or floor(q1 / {polygons.RUN}) <> block").count() == 0


def test_a_large_inside_is_few_rows(spark):
    square = '{"type":"Polygon","coordinates":[[[-122.75,37.62],[-122.31,37.62],[-122.31,37.92],[-122.75,37.92]]]}'
    edge = polygons.edges(spark.createDataFrame([("s", "1", square)], "boundary_set string, boundary_id string, geojson string"))
    runs = polygons.compact_cover(edge, 10).cache()
    n = runs.agg(F.sum(F.col("q1") - F.col("q0") + 1)).first()[0]
    assert n > 80_000 and runs.count() < n / 10


def test_membership_by_runs_is_membership_by_cells(spark, stars):
    edge, rng = polygons.edges(stars), random.Random(4)
    given = [(str(i), str(rng.uniform(37.6, 37.85)), str(rng.uniform(-122.75, -122.28))) for i in range(700)]
    points = cells.points(spark.createDataFrame(given, "k string, lat string, lon string"), "t", "k", "lat", "lon")
    a = membership.assign(points, polygons.bridge(edge, (10,), keep=stored), edge, 10)
    b = membership.assign_by_runs(points, polygons.compact_cover(edge, 10, keep=stored), edge, 10)
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count() and a.count() > 40
    assert membership.disagreement(membership.oracle(points.filter("is_usable_coordinate"), stars), b).count() == 0


def test_a_zone_is_read_by_its_schema_log(spark, tmp_path):
    raw = str(tmp_path / "raw")
    for n, cols in enumerate(("a string, b string", "b string, c string", "a string, d string")):
        landing.append_batch(landing.land_records(spark.createDataFrame([("1", "2")], cols), f"r{n}", "now"), raw, f"2024-01-0{n + 1}")
    assert {r.column_name: (r.first_seen[-1], r.last_seen[-1], r.batches) for r in landing.zone_columns(spark, raw).collect() if r.column_name[0] != "_"} == {"a": ("1", "3", 2), "b": ("1", "2", 2), "c": ("2", "2", 1), "d": ("3", "3", 1)}
    whole = landing.read_raw(spark, raw)
    assert set(whole.columns) == {"a", "b", "c", "d", "_ingested_at", "_ingest_run_id", "ingest_date"} and whole.count() == 3
    assert {"c", "d"}.isdisjoint(landing.read_raw(spark, raw, ["2024-01-01"]).columns)
    assert landing.read_raw(spark, raw, ["2024-01-02", "2024-01-03"]).orderBy("ingest_date").select("a", "b", "c", "d").collect() == [(None, "1", "2", None), ("1", None, None, "2")]


@pytest.fixture(scope="module")
def copied(spark, small, tmp_path_factory):
    """Suppliers and orders once and four times, the copies shifted by keys that put rings and points where the first ones lie."""
    at = {n: str(tmp_path_factory.mktemp(f"copies{n}")) for n in (1, 4)}
    for n, path in at.items():
        for name, key, shift in (("supplier", "s_suppkey", 7000), ("orders", "o_orderkey", 97 * 3_036_000)):
            copy = spark.range(n).withColumnRenamed("id", "copy")
            spark.read.parquet(f"{small}/{name}.parquet").crossJoin(copy).withColumn(key, F.col(key) + F.col("copy") * shift).drop("copy").write.parquet(f"{path}/{name}.parquet")
    return at


def test_copies_of_points_and_rings_are_tested_once(spark, copied, monkeypatch):
    tested, real = {}, polygons.inside
    for n, path in copied.items():
        counts = tested[n] = []
        monkeypatch.setattr(polygons, "inside", lambda candidates, *more, _to=counts: _to.append(candidates.count()) or real(candidates, *more))
        rows = queries.ring_membership(spark, path).collect()
        if n == 1:
            once = {(int(r.row_key), int(r.boundary_set[4:]), int(r.boundary_id)) for r in rows}
    assert tested[1] == tested[4] and min(tested[1]) > 0
    got = [(int(r.row_key), int(r.boundary_set[4:]), int(r.boundary_id)) for r in rows]
    assert sorted(got) == sorted((k + 97 * 3_036_000 * i, s + 7 * j, b + 7000 * j) for k, s, b in once for i in range(4) for j in range(4)) and once


def test_membership_by_shapes_is_membership_by_boundaries(spark, stars):
    again = stars.filter("boundary_id <> 'flat'").withColumns({"boundary_id": F.concat(F.lit("a"), "boundary_id"), "boundary_set": F.when(F.col("boundary_id") == "holed", "u").otherwise(F.col("boundary_set"))})
    both, rng = stars.unionByName(again), random.Random(5)
    given = [(str(i), *rng.choice([(str(rng.uniform(37.6, 37.85)), str(rng.uniform(-122.75, -122.28))), ("37.7", "-122.5"), ("37.75", "-122.31"), ("37.8", "-122.6")])) for i in range(500)]
    points = cells.points(spark.createDataFrame(given, "k string, lat string, lon string"), "t", "k", "lat", "lon")
    shape = stored(polygons.shapes(both), "shapes")
    owned, edge = polygons.owners(both, shape), polygons.edges(shape, ("shape",))
    assert shape.count() == 4 and owned.count() == 7
    got = membership.assign_by_runs(points, polygons.compact_cover(edge, 10, ("shape",), stored), edge, 10, stored, owned).cache()
    want = membership.assign(points, polygons.bridge(polygons.edges(both), (10,), keep=stored), polygons.edges(both), 10)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    assert {r.assignment_method for r in got.collect()} == {"interior_cell", "exact_refinement"} and got.select("boundary_set").distinct().count() == 3


def test_copies_of_rings_are_covered_once(spark, copied, monkeypatch):
    walked, rows, real = {}, {}, polygons.cover
    for n, path in copied.items():
        counts = walked[n] = []
        monkeypatch.setattr(polygons, "cover", lambda edge, *more, _to=counts: _to.append(edge.count()) or real(edge, *more))
        rows[n] = [(int(r.boundary_set[4:]), int(r.boundary_id), *r[2:]) for r in queries.ring_bridge(spark, path).collect()]
    assert walked[1] == walked[4] and min(walked[1]) > 0
    assert sorted(rows[4]) == sorted((s + 7 * j, b + 7000 * j, *more) for s, b, *more in rows[1] for j in range(4)) and len(rows[1]) > 500
