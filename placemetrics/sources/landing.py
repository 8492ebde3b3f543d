"""Landing of nested records as an append-only all-string zone, its run records, reads, refreshes, views and publishing."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemetrics.operators.profile import schema_hash
from placemetrics.operators.reconcile import runs_to_drop
from placemetrics.sources.zones import found_paths, read_version, remove, stored, versions, write_version

RUNS = (
    "run_id string, dataset string, table_name string, ingest_date string, started_at timestamp, finished_at timestamp, watermark_in string, "
    "watermark_out string, rows_written long, files_written long, mode string, status string, error string, rows_again long, rows_late long"
)


def safe_name(name: str) -> str:
    prefix, rest = ("_source_", name[1:]) if name.startswith(":") else ("", name)
    return prefix + "".join(c if c.isalnum() else "_" for c in rest).lower()


def land_records(df: DataFrame, run_id: str, ingested_at: str) -> DataFrame:
    """Every column as a string under a safe name, nested values as JSON, with lineage columns."""

    def text(f: T.StructField) -> Column:
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        return (F.to_json(F.col(f"`{f.name}`")) if nested else F.col(f"`{f.name}`").cast("string")).alias(safe_name(f.name))

    return df.select(*(text(f) for f in df.schema.fields), F.lit(ingested_at).alias("_ingested_at"), F.lit(run_id).alias("_ingest_run_id"))


_LOG = "ingest_date string, position int, column_name string, column_type string"


def append_batch(df: DataFrame, path: str, ingest_date: str) -> None:
    """Appends a batch, and the batch's columns to the zone's schema log; logged first, so that no column is ever unknown."""
    columns = [(ingest_date, i, c, k) for i, (c, k) in enumerate(df.dtypes)]
    df.sparkSession.createDataFrame(columns, _LOG).coalesce(1).write.mode("append").json(f"{path}/_schema")
    df.withColumn("ingest_date", F.lit(ingest_date)).write.mode("append").partitionBy("ingest_date").parquet(path)


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.schema(_LOG).json(f"{path}/_schema") if found_paths(spark, f"{path}/_schema/*.json") else None


def zone_columns(spark: SparkSession, path: str) -> DataFrame:
    """Every column that a zone's batches had: its type, the first and the last day with it, and the number of days."""
    log = _log(spark, path)
    log = spark.createDataFrame([], _LOG) if log is None else log
    return log.groupBy("column_name", "column_type").agg(F.min("ingest_date").alias("first_seen"), F.max("ingest_date").alias("last_seen"), F.count_distinct("ingest_date").alias("batches"))


def read_raw(spark: SparkSession, path: str, partitions: list[str] | None = None, with_file: bool = False) -> DataFrame:
    """All or some partitions, columns united by name, the partition key a string.

    The columns are those that the schema log has for the partitions asked for, so no file is opened to find them; only a zone
    without a log has its files' schemas merged.
    """
    if partitions is not None and not partitions:
        raise ValueError("no partitions asked for")
    log = _log(spark, path)
    if log is None:
        df = spark.read.option("mergeSchema", True).parquet(path)
    else:
        asked = log if partitions is None else log.filter(F.col("ingest_date").isin(partitions))
        columns = asked.groupBy("column_name").agg(F.min(F.struct("ingest_date", "position")).alias("at"), F.first("column_type").alias("kind")).orderBy("at", "column_name").collect()  # a row a column
        fields = [*(f"`{r[0]}` {r[2]}" for r in columns), "ingest_date string"]
        df = spark.read.schema(", ".join(fields)).parquet(path)
    df = df.withColumn("ingest_date", F.col("ingest_date").cast("string"))
    if with_file:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df if partitions is None else df.filter(F.col("ingest_date").isin(partitions))


def after(df: DataFrame, since: str | None, position: str, key: str) -> DataFrame:
    """Records after a position, in the order of position and key."""
    return (df.filter(F.col(position) > since) if since else df).orderBy(position, key)


def read_json(spark: SparkSession, path: str, schema: str | None = None, since: str | None = None, position: str = "updated_at", key: str = "id", lines: bool = False) -> DataFrame:
    """JSON records, pages of arrays or one a line, after a position, in the order of position and key."""
    reader = spark.read.option("multiLine", not lines).option("primitivesAsString", True)
    return after((reader.schema(schema) if schema else reader).json(path), since, position, key)


def ingest(rows: DataFrame, raw: str, runs: str, position: str, **known: str) -> None:
    """Land a batch and append its run record, also for a batch without rows and for one that fails."""
    spark = rows.sparkSession
    try:
        append_batch(land_records(rows, known["run_id"], known["finished_at"]), raw, known["ingest_date"])
    except Exception as e:
        failed = run_record(rows.limit(0), position, status="failed", error=shorten(str(e)), **known)
        failed.write.mode("append").json(runs)
        raise
    done = read_raw(spark, raw, [known["ingest_date"]], with_file=True) if not rows.isEmpty() else None
    if done is None:
        run_record(rows.limit(0), position, status="success", **known).write.mode("append").json(runs)
        return
    own = done.filter(F.col("_ingest_run_id") == known["run_id"])
    run_record(own, safe_name(position), files="source_file", status="success", **known).write.mode("append").json(runs)


def shorten(text: str, most: int = 500) -> str:
    return text if len(text) <= most else text[: most - 3] + "..."


def run_record(rows: DataFrame, position: str, files: str | None = None, **known: str) -> DataFrame:
    """One record of a run, from the rows just written; a run without rows has one too."""
    written = F.count_distinct(files) if files else F.lit(0).cast("long")
    one = rows.agg(F.count("*").alias("rows_written"), F.max(position).alias("watermark_out"), written.alias("files_written"))
    names = T.StructType.fromDDL(RUNS).fields
    made = ("rows_written", "watermark_out", "files_written")
    return one.select(*((F.col(f.name).cast(f.dataType) if f.name in made else F.lit(known.get(f.name)).cast(f.dataType)).alias(f.name) for f in names))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run records, without those of runs whose rows have been pruned."""
    rows = spark.read.schema(RUNS).json(path)
    return rows.join(rows.filter("status = 'pruned'").select("run_id"), "run_id", "left_anti").select(rows.columns)


def prune(spark: SparkSession, raw: str, runs: str, fates: DataFrame, at: str, partition: str = "ingest_date", dry_run: bool = True) -> DataFrame:
    """Applies a retention plan to a zone and its run records in one step: (kind, name) of what goes. In a dry run, the default, nothing does.

    Runs all of whose partitions go are marked as pruned first and the partitions removed afterwards, so that after a crash in
    between the plan, made again from what is left, still finds the partitions.
    """
    gone = fates.filter("fate = 'drop'").select(F.lit("partition").alias("kind"), F.col(partition).alias("name"))
    done = runs_to_drop(read_runs(spark, runs), fates, partition).select(F.lit("run").alias("kind"), F.col("run_id").alias("name"))
    out = stored(gone.unionByName(done), "pruned")  # a row a partition and a run
    if not dry_run:
        marks = out.filter("kind = 'run'").select(F.col("name").alias("run_id"), F.lit("pruned").alias("status"), F.lit(at).cast("timestamp").alias("finished_at"))
        marks.coalesce(1).write.mode("append").json(runs)
        for r in out.filter("kind = 'partition'").collect():
            remove(spark, f"{raw}/{partition}={r.name}")
    return out


def full_refresh(fresh: DataFrame, path: str) -> bool:
    """Replace a table only after a complete fetch; an empty result keeps the old one, and so does a crash."""
    if fresh.isEmpty():
        return False
    write_version(fresh, path)
    return True


def load_views(spark: SparkSession, tables: dict[str, str], optional: dict[str, str] | None = None) -> list[str]:
    """Register tables as views; an optional one (name to schema) that is missing becomes an empty typed view, others are errors."""
    from pyspark.errors import AnalysisException

    for name, path in tables.items():
        try:
            df = spark.read.option("mergeSchema", True).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND" or name not in (optional or {}):
                raise
            df = spark.createDataFrame([], optional[name])
        df.createOrReplaceTempView(name)
    return sorted(tables)


def write_derived(df: DataFrame, schema: str, path: str) -> None:
    """A derived table is replaced as a whole, in its declared schema."""
    fields = T.StructType.fromDDL(schema).fields
    write_version(df.select(*(F.col(f.name).cast(f.dataType) for f in fields)), path)


def read_derived(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """The newest complete state of a derived table in its declared schema; an empty one if there is none yet."""
    found = read_version(spark, path, T.StructType.fromDDL(schema))
    return spark.createDataFrame([], schema) if found is None else found


#: Bytes of a published file.
FILE_BYTES = 128 << 20
_MANIFEST = "mart string, folder string, file string, rows long, bytes long, ranges map<string, struct<low: double, high: double>>, schema_hash string, published_at string"
_MARTS = "mart string, rows long, bytes long, schema_hash string, published_at string"


def publish(df: DataFrame, name: str, path: str, at: str, along: Column | None = None, ranges: dict[str, Column] | None = None, file_bytes: int | None = None) -> DataFrame:
    """Write a mart into a new folder under ``path`` and return its manifest rows, one a file.

    The mart is computed once, at full width. Its size then gives the number of files, and its rows are dealt to them by ranges of
    ``along`` (a space-filling curve of a cell, say), or evenly. ``ranges`` are numbers whose least and greatest value each file's row carries,
    so that a reader opens only the files that can hold what it asks for.
    """
    spark = df.sparkSession
    whole = stored(df, "mart")
    size = whole.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]
    files = max(1, -(-size // (file_bytes or FILE_BYTES)))
    dealt = whole.repartition(files) if along is None else whole.withColumn("__along", along).repartitionByRange(files, "__along").sortWithinPartitions("__along").drop("__along")
    folder = f"{path}/{uuid.uuid4().hex}"
    dealt.write.parquet(folder)
    for spent in {f.rsplit("/", 1)[0] for f in whole.inputFiles()}:
        remove(spark, spent)
    done = spark.read.schema(df.schema).parquet(folder).withColumns({"__file": F.col("_metadata.file_path"), "__bytes": F.col("_metadata.file_size")})
    held = [F.struct(F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")) for c in (ranges or {}).values()]
    kept = F.map_from_arrays(F.array(*(F.lit(n) for n in ranges)), F.array(*held)) if ranges else F.create_map().cast("map<string, struct<low: double, high: double>>")
    rows = done.groupBy("__file", "__bytes").agg(F.count("*").alias("rows"), kept.alias("ranges"))
    fixed = {"mart": name, "folder": folder, "schema_hash": schema_hash(df), "published_at": at}
    rows = rows.select(F.col("__file").alias("file"), F.col("__bytes").alias("bytes"), "rows", "ranges", *(F.lit(v).alias(k) for k, v in fixed.items()))
    return rows.select([f.name for f in T.StructType.fromDDL(_MANIFEST)])


def publish_all(marts: dict[str, DataFrame], root: str, at: str, layout: dict[str, tuple[Column, dict[str, Column]]] | None = None, file_bytes: int | None = None) -> DataFrame:
    """Publish marts under ``root`` and then their manifest, a row a mart returned.

    A mart counts once a manifest names its folder, so a reader finds the old marts whole until then, and after a crash. Folders that
    neither the new manifest nor the one before names are removed. ``layout`` has curve and ranges of marts.
    """
    rows = [publish(df, name, f"{root}/{name}", at, *(layout or {}).get(name, (None, None)), file_bytes) for name, df in marts.items()]
    spark, manifest = rows[0].sparkSession, f"{root}/manifest"
    write_version(reduce(lambda a, b: a.unionByName(b), rows).coalesce(1), manifest)  # a row a file
    known = [spark.read.schema(_MANIFEST).parquet(v) for _, v in versions(spark, manifest)]
    named = {r[0].rsplit("/", 2)[-2] + "/" + r[0].rsplit("/", 1)[-1] for df in known for r in df.select("folder").distinct().collect()}
    for path in found_paths(spark, f"{root}/*/*"):
        mart, folder = path.rsplit("/", 2)[-2:]
        if mart != "manifest" and f"{mart}/{folder}" not in named:
            remove(spark, path)
    new = read_version(spark, manifest, T.StructType.fromDDL(_MANIFEST))
    return new.groupBy("mart", "schema_hash", "published_at").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).select([f.name for f in T.StructType.fromDDL(_MARTS)])


def read_published(spark: SparkSession, root: str, name: str, schema: T.StructType, within: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """A published mart, or those of its files that can hold rows with the named ranges' values ``within`` bounds; the caller still filters."""
    files = read_version(spark, f"{root}/manifest", T.StructType.fromDDL(_MANIFEST)).filter(F.col("mart") == name)
    for c, (low, high) in (within or {}).items():
        r = F.col("ranges")[c]
        files = files.filter((r["high"] >= low) & (r["low"] <= high))
    paths = [r[0] for r in files.select("file").collect()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
