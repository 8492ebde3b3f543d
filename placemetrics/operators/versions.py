"""Versioned rows: newest version per key, touched keys, keyed merge, state of an input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest(order: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def latest_by_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Newest version per key; ties go by the given columns in turn. Spark keeps one row a key before the shuffle."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*_newest(order)))).filter("__n = 1").drop("__n")


def latest_by_max(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """As ``latest_by_key`` by aggregation, without a sort of wide rows; ``order`` must not be null for a key's newest row."""
    rest = [c for c in df.columns if c not in key]
    newest = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return newest.select(*key, *(F.col(f"__r.{c}").alias(c) for c in rest)).select(*df.columns)


def single_newest(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(*_newest(order)).limit(1)


def touched(df: DataFrame, changed: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Newest versions, over the whole table, of the keys that the changed rows hold."""
    return latest_by_key(df.join(changed.select(*key).distinct(), key, "left_semi"), key, order)


def merge(cache: DataFrame, fresh: DataFrame, key: list[str]) -> DataFrame:
    """Cached rows and fresh ones; fresh rows win."""
    return cache.join(fresh.select(*key), key, "left_anti").unionByName(fresh)


def input_state(df: DataFrame, key: str, watermark: str, name: str) -> DataFrame:
    """Rows after deduplication (all null keys are one) and the newest position."""
    nulls = F.max(F.when(F.col(key).isNull(), 1).otherwise(0))
    return df.agg((F.count_distinct(key) + nulls).alias("rows"), F.max(watermark).alias("watermark")).select(F.lit(name).alias("table_name"), "rows", "watermark")


def partition_state(df: DataFrame, partition: str, file: str | None = None, key: str | None = None, digest: list[str] | None = None) -> DataFrame:
    """Rows, and where named the different files and keys, of each partition, and a digest of its rows by some columns.

    The digest is of the rows as a multiset: it does not depend on their order, and repeated rows count (sum and xor of row hashes).
    """
    more = [F.count_distinct(c).alias(n) for n, c in (("files", file), ("keys", key)) if c]
    if digest:
        own = F.xxhash64(*digest)
        more.append(F.concat_ws(":", F.sum(own.cast("decimal(20,0)")), F.bit_xor(own)).alias("digest"))
    return df.groupBy(partition).agg(F.count("*").alias("rows"), *more)
