"""Tables written once and read again, and tables that are replaced version by version."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; one of its own only where the session names none, which only a local session may do."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-zones-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def found_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in any file system that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    hits = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(h.getPath()) for h in hits or [])


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Complete versions of a table, oldest first."""
    done = [p.removesuffix("/_SUCCESS") for p in found_paths(spark, f"{path}/version=*/_SUCCESS")]
    return sorted((int(re.search(r"version=(\d+)$", p)[1]), p) for p in done)


def write_version(df: DataFrame, path: str, number: int | None = None, keep: int = 2) -> None:
    """A new version beside the old ones. It counts once it is complete, so a crash leaves the last one in place.

    Writing a number again replaces that version; versions beyond the newest ``keep`` are removed afterwards.
    """
    spark = df.sparkSession
    have = versions(spark, path)
    number = number if number is not None else (have[-1][0] + 1 if have else 0)
    df.write.mode("overwrite").parquet(f"{path}/version={number:012d}")
    for _, old in versions(spark, path)[:-keep]:
        remove(spark, old)


def read_version(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The newest complete version, or None."""
    have = versions(spark, path)
    return spark.read.schema(schema).parquet(have[-1][1]) if have else None


_DERIVED: dict[tuple, tuple] = {}


def _stamp(spark: SparkSession, pattern: str) -> tuple:
    """Names, sizes and times of what matches a glob: another stamp means that something was written again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    hits = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return tuple(sorted((str(h.getPath()), h.getLen(), h.getModificationTime()) for h in hits or []))


def derived(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """A table derived from the tables of ``sf``: built and written once in an application, then read by every query that needs it.

    It is built again where a table of ``sf`` has been written since.
    """
    key = (spark.sparkContext.applicationId, sf, name, _stamp(spark, f"{sf}/*.parquet"))
    if key not in _DERIVED:
        df, path = build(), fresh_path(spark, name)
        df.write.parquet(path)
        _DERIVED[key] = (path, df.schema)
    path, schema = _DERIVED[key]
    return spark.read.schema(schema).parquet(path)
