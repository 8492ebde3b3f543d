"""Helpers shared by the operators: input tables, tables written to the cluster's shared folder, hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one only where a local session names none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, and every executor can read it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def fold(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo: the fold that the contracts use. A null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batch, column: str, most: int = 4 << 20) -> Iterator:
    """Slices of an Arrow batch whose ``column`` holds about ``most`` bytes, one row at least: what a task makes of a batch stays small."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    starts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        yield batch.slice(a, b - a)
