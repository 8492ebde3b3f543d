"""Landing, run records, refresh, views, publishing, streams, retention of logs and upkeep by partitions."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from placemetrics.functions import casts
from placemetrics.operators import checks, profile, reconcile, versions
from placemetrics.sources import landing, zones
from placemetrics.streaming import feeds, parted


def test_landing_round_trip(spark, tmp_path):
    raw = str(tmp_path / "raw")
    first = spark.createDataFrame([Row(id="1", **{":updated": "2024-01-01", "Loc": Row(a=1, b=[1, 2])})])
    landing.append_batch(landing.land_records(first, "r1", "now"), raw, "2024-01-01")
    landing.append_batch(landing.land_records(spark.createDataFrame([("2", 5)], "id string, extra int"), "r2", "now"), raw, "2024-01-02")
    got = landing.read_raw(spark, raw)
    assert set(dict(got.dtypes).values()) == {"string"}
    assert got.filter("id = '1'").first().loc == '{"a":1,"b":[1,2]}' and got.filter("id = '2'").first().extra == "5"
    assert landing.read_raw(spark, raw, ["2024-01-02"], with_file=True).count() == 1
    with pytest.raises(ValueError, match="no partitions"):
        landing.read_raw(spark, raw, [])
    record = landing.run_record(got.filter("_ingest_run_id = 'r9'"), "_source_updated", run_id="r9", status="success").first()
    assert (record.rows_written, record.watermark_out, record.status) == (0, None, "success")


def test_json_source_refresh_views_and_publish(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([{"id": "b", "updated_at": "2"}, {"id": "a", "updated_at": "2"}, {"id": "c", "updated_at": "1"}]))
    got = landing.read_json(spark, str(tmp_path / "in"), since="1")
    assert [r.id for r in got.collect()] == ["a", "b"]
    target = str(tmp_path / "t")
    assert landing.full_refresh(got, target) and not landing.full_refresh(got.limit(0), target)
    assert zones.read_version(spark, target, got.schema).count() == 2
    for n in (1, 2, 3):
        assert landing.full_refresh(got.limit(n), target)
    assert [v for v, _ in zones.versions(spark, target)] == [2, 3]
    (tmp_path / "t" / "version=000000000009").mkdir()  # a version whose writing has not ended
    assert zones.read_version(spark, target, got.schema).count() == 2
    target = zones.versions(spark, target)[-1][1]
    landing.load_views(spark, {"things": target, "absent": str(tmp_path / "no")}, {"absent": "x long"})
    assert spark.sql("select * from absent").columns == ["x"] and spark.table("things").count() == 2
    row = landing.publish(spark.table("things"), "things", str(tmp_path / "p"), "now").first()
    assert row.file.startswith(row.folder) or row.folder in row.file
    assert row.rows == 2 and row.bytes > 0 and len(row.schema_hash) == 64
    assert landing.read_derived(spark, "id int", str(tmp_path / "d")).count() == 0
    landing.write_derived(spark.range(3), "id int", str(tmp_path / "d"))
    assert landing.read_derived(spark, "id int", str(tmp_path / "d")).dtypes == [("id", "int")]
    root = str(tmp_path / "marts")
    landing.publish_all({"a": spark.range(3), "b": spark.range(4)}, root, "t1")
    old = landing.read_published(spark, root, "b", spark.range(0).schema)
    assert {r.mart: r.rows for r in landing.publish_all({"b": spark.range(5)}, root, "t2").collect()} == {"b": 5}
    assert old.count() == 4  # a reader of the manifest before still finds its files
    landing.publish_all({"b": spark.range(6)}, root, "t3")
    assert not list((tmp_path / "marts" / "a").glob("*")) and len(list((tmp_path / "marts" / "b").glob("*"))) == 2
    assert landing.read_published(spark, root, "b", spark.range(0).schema).count() == 6


def test_a_run_is_recorded_whether_it_succeeds_or_not(spark, tmp_path):
    raw, runs = str(tmp_path / "raw"), str(tmp_path / "runs")
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, `:updated` string")
    known = {"dataset": "d", "ingest_date": "2024-01-01", "finished_at": "2024-01-01 00:00:00"}
    landing.ingest(rows, raw, runs, ":updated", run_id="r1", **known)
    landing.ingest(rows.limit(0), raw, runs, ":updated", run_id="r2", **known)
    with pytest.raises(Exception, match="(?i)divi"):
        landing.ingest(rows.withColumn("x", F.expr("cast(id as int) / 0")), raw, runs, ":updated", run_id="r3", **known)
    got = {r.run_id: (r.status, r.rows_written, r.watermark_out, r.error is None) for r in landing.read_runs(spark, runs).collect()}
    assert got == {"r1": ("success", 2, "b", True), "r2": ("success", 0, None, True), "r3": ("failed", 0, None, False)}


def test_streams(spark, tmp_path):
    drops, schema = tmp_path / "drops", "id string, place string, ts string, v string"
    drops.mkdir()
    (drops / "1.json").write_text('{"id":"1","place":"x","ts":"2024-01-05","v":"old"}\n{"id":"2","place":"x","ts":"2024-01-07","v":"a"}\n')
    latest, raw = str(tmp_path / "latest"), str(tmp_path / "raw")

    def run():
        feeds.land_stream(spark, str(drops), schema, raw, str(tmp_path / "c1"), "run", "2024-02-01").awaitTermination()
        feeds.latest_stream(spark, str(drops), schema, latest, str(tmp_path / "c2"), ["id"], ["ts"]).awaitTermination()

    run()
    (drops / "2.json").write_text('{"id":"1","place":"x","ts":"2024-02-01","v":"new"}\n{"id":"2","place":"x","ts":"2023-12-01","v":"late"}\n')
    run()
    assert spark.read.parquet(raw).count() == 4
    rows = feeds.read_latest(spark, latest, schema)
    assert {r.id: r.v for r in rows.collect()} == {"1": "new", "2": "a"}
    # a folder that no record names, as after a crash, is not read
    (tmp_path / "latest" / "data" / "version=000000000002-x" / "__part=0").mkdir(parents=True)
    (drops / "3.json").write_text('{"id":"3","place":"y","ts":"2024-03-01","v":"z"}\n')
    assert feeds.read_latest(spark, latest, schema).count() == 2
    run()
    assert {r.id: r.v for r in feeds.read_latest(spark, latest, schema).collect()} == {"1": "new", "2": "a", "3": "z"}
    counts = feeds.recount(rows, rows.filter("id = '1'"), "place", "ts").collect()
    assert [(r.place, str(r.event_month), r.event_count) for r in counts] == [("x", "2024-02-01", 1)]


SCHEMA = "id string, place string, ts string"
DROPS = [
    [("1", "A", "2024-01-05"), ("2", "A", "2024-01-09"), ("3", "B", "2024-02-01"), ("4", None, None)],
    [("1", "B", "2024-02-02"), ("2", "A", "2023-12-01"), ("5", "C", "2024-05-05")],
    [("5", "A", "2024-06-01"), ("4", "D", "2024-01-01"), ("3", "B", "2024-02-01")],
    [("6", "E", "2024-07-01")],
]
STATES = [
    {("A", "2024-01-01"): 2, ("B", "2024-02-01"): 1, (None, "None"): 1},
    {("A", "2024-01-01"): 1, ("B", "2024-02-01"): 2, (None, "None"): 1, ("C", "2024-05-01"): 1},
    {("A", "2024-01-01"): 1, ("B", "2024-02-01"): 2, ("A", "2024-06-01"): 1, ("D", "2024-01-01"): 1},
    {("A", "2024-01-01"): 1, ("B", "2024-02-01"): 2, ("A", "2024-06-01"): 1, ("D", "2024-01-01"): 1, ("E", "2024-07-01"): 1},
]


@pytest.fixture(autouse=True)
def few_parts(monkeypatch):
    monkeypatch.setattr(feeds, "PARTS", 3)


class Follow:
    """A stream of the drops above, one drop at a time."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        (root / "drops").mkdir()

    def run(self, drop=None):
        if drop is not None:
            lines = [json.dumps(dict(zip(("id", "place", "ts"), r, strict=True))) for r in DROPS[drop]]
            (self.root / "drops" / f"{drop}.json").write_text("\n".join(lines))
        at = [str(self.root / n) for n in ("drops", "latest", "counts", "check")]
        feeds.recount_stream(self.spark, at[0], SCHEMA, at[1], at[2], at[3], ["id"], ["ts"], "place", "ts").awaitTermination()

    def counts(self):
        return {(r.place, str(r.event_month)): r.event_count for r in feeds.read_counts(self.spark, str(self.root / "counts"), "place").collect()}

    def keys(self):
        return {r.id: r.place for r in feeds.read_latest(self.spark, str(self.root / "latest"), SCHEMA).collect()}


def test_counts_follow_keys_that_move(spark, tmp_path):
    follow = Follow(spark, tmp_path)
    for k, state in enumerate(STATES):
        follow.run(k)
        assert follow.counts() == state
    assert follow.keys() == {"1": "B", "2": "A", "3": "B", "4": "D", "5": "A", "6": "E"}
    kept = parted.newest(spark, str(tmp_path / "latest"))
    assert [v for v, _ in zones.versions(spark, str(tmp_path / "latest" / "log"))] == [kept[0] - 1, kept[0]]  # swept behind the newest two


@pytest.mark.parametrize("lost", [1, 2, 3])
def test_a_lost_commit_of_the_stream_changes_nothing(spark, tmp_path, lost):
    follow = Follow(spark, tmp_path)
    for k in range(lost + 1):
        follow.run(k)
    for name in (f"{lost}", f".{lost}.crc"):
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    before = follow.keys()
    follow.run()
    assert follow.counts() == STATES[lost] and follow.keys() == before
    for k in range(lost + 1, 4):
        follow.run(k)
    assert follow.counts() == STATES[3]


@pytest.mark.parametrize(("step", "done"), [("write_parts", False), ("write_parts", True), ("commit", True), ("sweep", True)])
@pytest.mark.parametrize("table", ["latest", "counts"])
def test_a_crash_at_any_point_changes_nothing(spark, tmp_path, monkeypatch, step, table, done):
    follow, real = Follow(spark, tmp_path), getattr(parted, step)
    follow.run(0)
    follow.run(1)

    def breaks(*given, **named):
        if not any(str(x).endswith(f"/{table}") for x in given):
            return real(*given, **named)
        if done:
            real(*given, **named)
        raise RuntimeError("crash")

    monkeypatch.setattr(parted, step, breaks)
    with pytest.raises(Exception, match="crash"):
        follow.run(2)
    assert len(follow.keys()) >= 5  # what readers see is a whole version
    monkeypatch.setattr(parted, step, real)
    follow.run()
    assert follow.counts() == STATES[2]
    follow.run(3)
    assert follow.counts() == STATES[3] and len(follow.keys()) == 6


def test_counts_without_a_feed_are_counted_anew(spark, tmp_path):
    follow = Follow(spark, tmp_path)
    for k in (0, 1, 2):
        follow.run(k)
    other = str(tmp_path / "other")
    feeds.count_changes(spark, str(tmp_path / "latest"), other, SCHEMA, "place", "ts")
    assert {(r.place, str(r.event_month)): r.event_count for r in feeds.read_counts(spark, other, "place").collect()} == STATES[2]


def test_records_sent_again_land_once(spark, tmp_path):
    (tmp_path / "d").mkdir()
    raw, runs = str(tmp_path / "raw"), str(tmp_path / "runs")
    first = ['{"id":"1","at":"2024-02-01"}', '{"id":"1","at":"2024-02-01"}', '{"id":"2","at":"2023-01-01"}', '{"at":"2024-02-01"}']
    for n, lines in enumerate((first, ['{"id":"1","at":"2024-02-01"}', '{"id":"1","at":"2024-02-02"}', '{"at":"2024-02-01"}', '{"id":"2","at":"2023-01-01"}'])):
        (tmp_path / "d" / f"{n}.json").write_text("\n".join(lines))
        feeds.land_stream(spark, str(tmp_path / "d"), "id string, at string", raw, str(tmp_path / "c"), "r", "2024-02-03", runs, "at", key="id").awaitTermination()
    assert sorted((r.id or "", r.at) for r in spark.read.parquet(raw).collect()) == [("", "2024-02-01"), ("", "2024-02-01"), ("1", "2024-02-01"), ("1", "2024-02-02"), ("2", "2023-01-01")]
    assert [(r.rows_written, r.rows_again, r.rows_late) for r in landing.read_runs(spark, runs).orderBy("run_id").collect()] == [(3, 1, 1), (2, 2, 0)]


def test_versions_and_upkeep(spark):
    rows = spark.createDataFrame([("k", "2", "open"), ("k", "3", "Closed"), ("j", None, "x"), (None, "1", "y")], "key string, at string, v string")
    assert {r.key: r.v for r in versions.latest_by_key(rows, ["key"], ["at"]).collect()} == {"k": "Closed", "j": "x", None: "y"}
    assert versions.input_state(rows, "key", "at", "t").first().rows == 3
    old = spark.createDataFrame([("a", 1), ("b", 2)], "day string, rows int")
    fate = lambda new: {r.day: (r.state, r.rebuild) for r in reconcile.changed_partitions(old, spark.createDataFrame(new, "day string, rows int"), "day").collect()}
    assert fate([("a", 1), ("b", 2)]) == {"a": ("same", "none"), "b": ("same", "none")}
    assert fate([("a", 1), ("b", 2), ("c", 1)])["c"] == ("new", "partition")
    assert fate([("a", 1), ("b", 1)])["b"] == ("shrunk", "table") and fate([("a", 1)])["b"] == ("vanished", "table")
    log = spark.createDataFrame([(f"i{k}", k) for k in range(5) for _ in range(3)], "invocation_id string, run_started_at int")
    assert {r.invocation_id for r in checks.newest_runs(log, 2).collect()} == {"i3", "i4"} and checks.newest_runs(log, 2).count() == 6
    with pytest.raises(ValueError, match="bound"):
        checks.out_of_range(rows, "at")
    with pytest.raises(ValueError, match="logical type"):
        casts.safe_cast(F.col("x"), "decimal")


def test_retention_keeps_unproven_partitions_and_their_runs(spark):
    rows = spark.createDataFrame([("1", "a", 1), ("1", "b", 1), ("2", "a", 2), ("2", "gone", 1), ("3", "a", 2), ("3", "b", 2)], "day string, key string, v int")
    proof = reconcile.supersession(rows, "day", "key", "v")
    assert {r.day: (r.unreachable, r.regressed, r.proven) for r in proof.collect()} == {"1": (0, 0, True), "2": (1, 0, False)}
    fates = reconcile.retention(rows, proof, "day", 1)
    assert {r.day: r.fate for r in fates.collect()} == {"1": "drop", "2": "unproven", "3": "newest"}
    assert reconcile.kept_rows(rows, fates, "day").count() == 6 and reconcile.kept_rows(rows, fates, "day", dry_run=False).count() == 4
    with pytest.raises(ValueError, match="snapshot"):
        reconcile.retention(rows, proof, "day", 1, refresh="delta")
    nameless = spark.createDataFrame([("1", None, 1), ("2", None, 2)], "day string, key string, v int")
    assert reconcile.supersession(nameless, "day", "key", "v").first().unreachable == 1  # a null key is never found again
    runs = spark.createDataFrame([("r1", "1"), ("r2", "1"), ("r2", "2")], "run_id string, day string")
    assert [r.run_id for r in reconcile.runs_to_drop(runs, fates, "day").collect()] == ["r1"]


def test_schema_changes_and_parity(spark):
    a = spark.createDataFrame([(1, 1.5, "x"), (2, float("nan"), None)], "k int, v double, s string")
    b = a.withColumn("v", F.when(F.col("k") == 1, 2.5).otherwise(F.col("v")))
    assert profile.fingerprint(a, ["k"]).first() == profile.fingerprint(a.orderBy(F.desc("k")), ["k"]).first()
    assert [(r.column_name, r.k) for r in profile.differing(a, b, ["k"]).collect()] == [("v", 1)]
    old, new = profile.schema_rows(a), profile.schema_rows(a.select("k", F.col("v").cast("string"), F.lit(1).alias("n")))
    assert {r.column_name: r.change for r in profile.schema_changes(old, new).collect()} == {"v": "retyped", "s": "removed", "n": "added"}
    renamed = profile.schema_rows(a.withColumnRenamed("s", "t"))
    assert [(r.column_name, r.change, r.new_name) for r in profile.schema_changes(old, renamed).collect()] == [("s", "renamed", "t")]
