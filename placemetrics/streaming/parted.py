"""Tables kept in parts that a stream rewrites: a commit record for each version, and a feed of what it changed.

A version writes the parts that it changes into a folder of its own and then a record that names, for every part, the folder that
holds it; nothing counts before its record is complete. Records also carry marks: how far each stream, or each table that the
feed goes to, has been applied. What is written but never recorded, after a crash, is never read. Folders are removed only
once no kept record names them, and records only once every reader of the feed has applied them.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from placemetrics.sources.zones import found_paths, remove, versions

_RECORD = "kind string, name string, value string"


def newest(spark: SparkSession, path: str) -> tuple[int, dict[int, str], dict[str, int]]:
    """Number, parts and marks of the newest version; -1 before the first one."""
    have = versions(spark, f"{path}/log")
    return (have[-1][0], *_record(spark, have[-1][1])) if have else (-1, {}, {})


def _record(spark: SparkSession, at: str) -> tuple[dict[int, str], dict[str, int]]:
    rows = spark.read.schema(_RECORD).json(at).collect()  # a row a part and a mark
    return {int(r.name): r.value for r in rows if r.kind == "part"}, {r.name: int(r.value) for r in rows if r.kind == "mark"}


def write_parts(df: DataFrame, path: str, version: int) -> dict[int, str]:
    """Rows, already dealt by their column __part, in a new folder of this version; the folder of each part that has rows."""
    folder = f"{path}/data/version={version:012d}-{uuid.uuid4().hex}"
    df.write.partitionBy("__part").parquet(folder)
    names = [p.rsplit("/", 1)[1] for p in found_paths(df.sparkSession, f"{folder}/__part=*")]
    return {int(name.removeprefix("__part=")): f"{folder}/{name}" for name in names}


def commit(spark: SparkSession, path: str, version: int, parts: dict[int, str], marks: dict[str, int]) -> None:
    rows = [("part", str(k), v) for k, v in sorted(parts.items())] + [("mark", k, str(v)) for k, v in sorted(marks.items())]
    spark.createDataFrame(rows, _RECORD).coalesce(1).write.mode("overwrite").json(f"{path}/log/version={version:012d}")


def _number(folder: str) -> int:
    return int(re.search(r"version=(\d+)-", folder)[1])


def sweep(spark: SparkSession, path: str, first: int) -> None:
    """Removes records before version ``first``, and folders of such versions that no later record names."""
    have = versions(spark, f"{path}/log")
    named = {p.rsplit("/", 2)[1] for v, at in have if v >= first for p in _record(spark, at)[0].values()}
    for folder in found_paths(spark, f"{path}/data/version=*"):
        if _number(f"{folder}/") < first and folder.rsplit("/", 1)[1] not in named:
            remove(spark, folder)
    for v, at in have:
        if v < first:
            remove(spark, at)


def rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table as of its newest version."""
    parts = newest(spark, path)[1]
    return spark.read.schema(schema).parquet(*parts.values()) if parts else spark.createDataFrame([], schema)


def feed(spark: SparkSession, path: str, schema: T.StructType, since: int) -> DataFrame | None:
    """What the versions after ``since`` changed, a row a key and version: before (null for a new key) and after. None where a record is gone."""
    have = {v: at for v, at in versions(spark, f"{path}/log") if v > since}
    if not have or set(have) != set(range(since + 1, max(have) + 1)):
        return None
    folders = [p for v, at in have.items() for p in _record(spark, at)[0].values() if _number(p) == v]
    wide = T.StructType([*schema.fields, T.StructField("__changed", T.BooleanType()), T.StructField("__before", schema)])
    found = spark.read.schema(wide).parquet(*folders) if folders else spark.createDataFrame([], wide)
    return found.filter("__changed").selectExpr("__before as before", f"struct({', '.join(f'`{c}`' for c in schema.names)}) as after")
