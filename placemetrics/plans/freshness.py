"""One row a source: counts, ages, staleness, coordinate quality, check totals, health. ``now`` is an argument."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemetrics.functions.casts import hours_between, percentage
from placemetrics.operators.versions import latest_by_key, single_newest


def is_stale(sla: Column, age: Column) -> Column:
    """Without an agreed age never stale; without a load always."""
    return F.when(sla.isNull(), False).when(age.isNull(), True).otherwise(age > sla)


def is_healthy(stale: Column, run_status: Column, failed: Column, malformed: Column) -> Column:
    return F.when(stale, False).when(F.coalesce(run_status == "failed", F.lit(False)), False).when(F.coalesce(failed, F.lit(0)) > 0, False).when(F.coalesce(malformed, F.lit(0)) > 0, False).otherwise(True)


def loads(tables: dict[str, tuple[DataFrame, str]], run: str | None = None) -> DataFrame:
    """dataset, row_count, latest_load and latest_run of each named table, its load column and the column with its run."""
    last = F.max(run) if run else F.lit(None).cast("string")
    parts = [df.agg(F.count("*").alias("row_count"), F.max(c).cast("timestamp_ntz").alias("latest_load"), last.alias("latest_run")).withColumn("dataset", F.lit(name)) for name, (df, c) in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).select("dataset", "row_count", "latest_load", "latest_run")


def check_totals(results: DataFrame) -> DataFrame:
    """Checks of the newest invocation by dataset and status."""
    newest = single_newest(results.select("invocation_id", "run_started_at").distinct(), ["run_started_at", "invocation_id"])
    own = results.join(F.broadcast(newest.select("invocation_id")), "invocation_id", "left_semi")
    return own.groupBy("dataset").agg(F.count("*").alias("checks"), F.count_if(F.col("status").isin("fail", "error")).alias("failed_checks"), F.count_if(F.col("status") == "warn").alias("warned_checks"))


def freshness(registry: DataFrame, load: DataFrame, runs: DataFrame, checks: DataFrame, quality: DataFrame, now: Column) -> DataFrame:
    last = latest_by_key(runs, ["dataset"], ["run_id"]).select("dataset", F.col("status").alias("last_run_status"))
    out = registry.join(load, "dataset", "left").join(last, "dataset", "left").join(check_totals(checks), "dataset", "left").join(quality, "dataset", "left")
    out = out.withColumn("age_hours", hours_between(F.col("latest_load"), now))
    out = out.withColumn("is_stale", is_stale(F.col("sla_hours"), F.col("age_hours")))
    return out.withColumns(
        {
            "is_healthy": is_healthy(F.col("is_stale"), F.col("last_run_status"), F.col("failed_checks"), F.col("malformed")),
            "pct_unusable": percentage(F.col("coordinates") - F.col("usable"), F.col("coordinates")),
        }
    )
