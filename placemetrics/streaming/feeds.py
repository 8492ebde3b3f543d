"""Streams of JSON drops: landing, a latest-version table kept current, and monthly counts that follow its changes.

The latest-version table and the counts are tables in parts (``parted``): a batch is applied once its record is complete, and one
that a restart replays is applied again from the state before it, or not at all where its record was complete already. So a
crash at any point, and a commit of the stream's own that is lost, leave the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from placemetrics.functions.casts import month
from placemetrics.sources.landing import land_records, run_record, safe_name
from placemetrics.sources.zones import found_paths, remove, stored
from placemetrics.streaming import parted

#: Parts of a table; a batch rewrites those that its keys fall into.
PARTS = 64


def _run(spark: SparkSession, drops: str, schema: str, checkpoint: str, one) -> StreamingQuery:
    return spark.readStream.schema(schema).json(drops).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _landed_before(spark: SparkSession, raw: str, names: list[str], own: str, since: str) -> DataFrame:
    """Key and position of what other batches landed since a day."""
    done = [p.removesuffix("/_SUCCESS") for p in found_paths(spark, f"{raw}/ingest_date=*/batch=*/_SUCCESS")]
    paths = [p for p in done if p.split("ingest_date=")[1].split("/")[0] >= since and not p.endswith(own)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def land_stream(
    spark: SparkSession, drops: str, schema: str, raw: str, checkpoint: str, run_id: str, day: str, runs: str | None = None, position: str | None = None, key: str | None = None, horizon: int = 7
) -> StreamingQuery:
    """Every drop once into the raw zone, with a run record for each batch; the checkpoint is the resume position.

    With a ``key``, a record sent again, of one key and position, lands once: batches are held against what the zone landed in the
    last ``horizon`` days. The zone itself is that state, as a state store would have to drop what comes late. A record whose position is
    older than the horizon lands all the same and is counted as late; what had landed before is counted too. Records without key or
    position always land.
    """

    def one(batch: DataFrame, number: int) -> None:
        session, name = batch.sparkSession, f"{run_id}-{number}"
        own = f"ingest_date={day}/batch={name}"
        rows, counts = land_records(batch, name, day), {}
        since = session.range(1).select(F.date_sub(F.lit(day).cast("date"), horizon).cast("string")).first()[0]
        if key:
            names = [safe_name(key), safe_name(position or "_ingested_at")]
            nameless = F.col(names[0]).isNull() | F.col(names[1]).isNull()
            fresh = rows.filter(~nameless).dropDuplicates(names).join(_landed_before(session, raw, names, own, since), names, "left_anti")
            rows = fresh.select(rows.columns).unionByName(rows.filter(nameless))
        rows.write.mode("overwrite").parquet(f"{raw}/{own}")
        if runs:
            done = session.read.parquet(f"{raw}/{own}").select("*", F.col("_metadata.file_path").alias("source_file"))
            if key:
                landed, late = done.agg(F.count("*"), F.count_if(F.col(names[1]) < since)).first()
                counts = {"rows_again": batch.count() - landed, "rows_late": late}
            record = run_record(done, position or "_ingested_at", files="source_file", run_id=name, ingest_date=day, mode="stream", status="success", **counts)
            record.write.mode("overwrite").json(f"{runs}/run={name}")

    return _run(spark, drops, schema, checkpoint, one)


def read_latest(spark: SparkSession, path: str, schema) -> DataFrame:
    """The latest-version table as of its newest version."""
    return parted.rows(spark, path, schema)


def apply_batch(batch: DataFrame, number: int, latest: str, key: list[str], order: list[str], stream: str, readers: list[str] | None = None) -> None:
    """The next version of a latest-version table: the newest row of every key of the batch and of the parts that they fall into.

    A batch number that this stream has applied already changes nothing. Of equal rows by ``order`` the one that the table holds stays,
    else the least by hash. Versions that a reader has not applied yet are kept, and the one before the newest, for those who just listed it.
    """
    spark = batch.sparkSession
    version, held, marks = parted.newest(spark, latest)
    if marks.get(stream, -1) >= number:
        return
    parts = marks.get("parts", PARTS)
    columns, part = batch.columns, F.pmod(F.xxhash64(*key), F.lit(parts).cast("long")).cast("int")
    touched = [r[0] for r in batch.select(part).distinct().collect()]  # ``parts`` values at most
    if touched:
        rows = batch.withColumn("__old", F.lit(False))
        paths = [held[t] for t in touched if t in held]
        if paths:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(*paths).withColumn("__old", F.lit(True)))
        rows = rows.withColumn("__part", part).repartition(len(touched), "__part")
        whole = Window.partitionBy("__part", *key)
        newest = whole.orderBy(*(F.col(c).desc_nulls_last() for c in order), F.col("__old").desc(), F.xxhash64(*(F.col(c).cast("string") for c in columns)))
        rows = rows.withColumns({"__n": F.row_number().over(newest), "__was": F.first(F.when(F.col("__old"), F.struct(*columns)), ignorenulls=True).over(whole)}).filter("__n = 1")
        fresh = rows.select(*columns, "__part", (~F.col("__old")).alias("__changed"), F.when(~F.col("__old"), F.col("__was")).alias("__before"))
        held = held | parted.write_parts(fresh, latest, version + 1)
    parted.commit(spark, latest, version + 1, held, marks | {"parts": parts, stream: number})
    applied = [parted.newest(spark, r)[2].get("applied", -1) for r in readers or []]
    parted.sweep(spark, latest, min([version, *(a + 1 for a in applied)]))


def _stream_name(spark: SparkSession) -> str:
    return "stream " + (spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "")


def latest_stream(spark: SparkSession, drops: str, schema: str, latest: str, checkpoint: str, key: list[str], order: list[str]) -> StreamingQuery:
    """The newest version of every key, whatever the order of arrival. A batch rewrites only the parts that its keys fall into."""
    return _run(spark, drops, schema, checkpoint, lambda batch, number: apply_batch(batch, number, latest, key, order, _stream_name(batch.sparkSession)))


def recount(latest: DataFrame, touched: DataFrame, place: str, ts: str) -> DataFrame:
    """Counts by place and month, over the whole latest table, of the groups that some rows belong to: what the kept counts must equal."""
    rows = latest.withColumn("event_month", month(F.col(ts)))
    groups = touched.select(place, month(F.col(ts)).alias("event_month")).distinct()
    return rows.join(groups, [place, "event_month"], "left_semi").groupBy(place, "event_month").agg(F.count("*").alias("event_count"))


def _moves(feed: DataFrame, place: str, ts: str) -> DataFrame:
    """The change of each group: one out of the group of the row before, one into that of the row after."""

    def image(side: str, n: int) -> Column:
        return F.when(F.col(side).isNotNull(), F.struct(F.col(f"{side}.{place}").alias(place), month(F.col(f"{side}.{ts}")).alias("event_month"), F.lit(n).cast("long").alias("event_count")))

    both = feed.select(F.explode(F.array(image("before", -1), image("after", 1))).alias("m")).filter("m is not null").select("m.*")
    return both.groupBy(place, "event_month").agg(F.sum("event_count").alias("event_count")).filter("event_count <> 0")


def count_changes(spark: SparkSession, latest: str, counts: str, schema: str, place: str, ts: str) -> None:
    """Brings the counts by place and month up to the newest version of a latest-version table, by its feed of changes.

    A row that moves is taken out of its old group and added to the new one; a group that comes to 0 is gone. The counts say which
    version they hold, so nothing is applied twice. Where the feed no longer reaches back that far they are counted anew.
    """
    to = parted.newest(spark, latest)[0]
    version, held, marks = parted.newest(spark, counts)
    since = marks.get("applied", -1)
    if to == since:
        return
    fields = T.StructType.fromDDL(schema)
    feed = parted.feed(spark, latest, fields, since)
    if feed is None:
        held, feed = {}, parted.rows(spark, latest, fields).select(F.lit(None).cast(fields).alias("before"), F.struct(*fields.names).alias("after"))
    parts = marks.get("parts", PARTS)
    part = F.pmod(F.xxhash64(place), F.lit(parts).cast("long")).cast("int")
    moves = stored(_moves(feed, place, ts).withColumn("__part", part), "moves")
    touched = [r[0] for r in moves.select("__part").distinct().collect()]  # ``parts`` values at most
    if touched:
        paths, plain = [held[t] for t in touched if t in held], moves.drop("__part")
        rows = moves if not paths else moves.unionByName(spark.read.schema(plain.schema).parquet(*paths).withColumn("__part", part))
        fresh = rows.repartition(len(touched), "__part").groupBy("__part", place, "event_month").agg(F.sum("event_count").alias("event_count")).filter("event_count <> 0")
        held = {k: v for k, v in held.items() if k not in touched} | parted.write_parts(fresh, counts, version + 1)
    parted.commit(spark, counts, version + 1, held, {"parts": parts, "applied": to})
    parted.sweep(spark, counts, version)
    for path in {p.rsplit("/", 1)[0] for p in moves.inputFiles()}:
        remove(spark, path)


def recount_stream(spark: SparkSession, drops: str, schema: str, latest: str, counts: str, checkpoint: str, key: list[str], order: list[str], place: str, ts: str) -> StreamingQuery:
    """A latest-version table and its monthly counts by place, both kept current by one stream."""

    def one(batch: DataFrame, number: int) -> None:
        apply_batch(batch, number, latest, key, order, _stream_name(batch.sparkSession), readers=[counts])
        count_changes(batch.sparkSession, latest, counts, schema, place, ts)

    return _run(spark, drops, schema, checkpoint, one)


def read_counts(spark: SparkSession, path: str, place: str) -> DataFrame:
    return parted.rows(spark, path, f"`{place}` string, event_month date, event_count long")
