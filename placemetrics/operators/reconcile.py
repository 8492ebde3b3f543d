"""Run reconciliation, resume positions, supersession proofs, retention, changed partitions, staleness of derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def held_by_run(raw: DataFrame, by: tuple[str, ...] = (), file: str | None = None) -> DataFrame:
    """Rows, partitions and, if named, files of each run (and table, say); rows without a run id are named."""
    files = [F.count_distinct(file).alias("files_held")] if file else []
    run = F.coalesce("run_id", F.lit("(no run id)")).alias("run_id")
    return raw.groupBy(*by, run).agg(F.count("*").alias("rows_held"), *files, F.array_sort(F.collect_set("ingest_date")).alias("partitions"))


def runs_against_rows(claims: DataFrame, held: DataFrame) -> DataFrame:
    """Each run's verdict: ok, miscounted, wrong_partition, unrecorded; a claim of no rows without rows is fine."""
    both = claims.join(held, "run_id", "full_outer")
    claimed, rows = F.coalesce("rows_written", F.lit(0)), F.coalesce("rows_held", F.lit(0))
    verdict = (
        F.when(F.col("rows_written").isNull(), "unrecorded")
        .when(claimed != rows, "miscounted")
        .when((rows > 0) & ~F.col("partitions").eqNullSafe(F.array("ingest_date")), "wrong_partition")
        .otherwise("ok")
    )
    return both.select("run_id", claimed.cast("long").alias("rows_written"), rows.cast("long").alias("rows_held"), verdict.alias("verdict"))


def resume_position(raw: DataFrame, column: str, since: str | None = None, start: str | None = None) -> DataFrame:
    """An explicit position, else the newest one held, else the start."""
    return raw.agg(F.max(column).alias("held")).select(F.coalesce(F.lit(since), F.col("held"), F.lit(start)).alias("position"))


def position_drift(claims: DataFrame, raw: DataFrame, column: str, by: list[str] = ()) -> DataFrame:
    """Claimed and held newest positions, of the whole or of each group, and how they differ."""
    claimed, held = claims.groupBy(*by).agg(F.max("watermark_out").alias("claimed")), raw.groupBy(*by).agg(F.max(column).alias("held"))
    both = claimed.join(held, list(by), "full_outer") if by else claimed.join(F.broadcast(held))
    return both.withColumn("drift", F.when(F.col("claimed").eqNullSafe(F.col("held")), "none").when(F.col("claimed").isNull(), "unclaimed").when(F.col("held").isNull() | (F.col("claimed") > F.col("held")), "ahead").otherwise("behind"))


def supersession(rows: DataFrame, partition: str, key: str, version: str, datasets: list[str] = ()) -> DataFrame:
    """Every partition against the newest of its dataset: keys not in it, keys whose version went back; proven if there is neither."""
    by = list(datasets)
    newest = rows.groupBy(*by).agg(F.max(partition).alias("keeper"))
    marked = rows.join(F.broadcast(newest), by) if by else rows.join(F.broadcast(newest))
    keep = marked.filter(F.col(partition) == F.col("keeper")).groupBy(*by, key).agg(F.max(version).alias("kept_version"))
    old = marked.filter(F.col(partition) < F.col("keeper"))
    both = old.join(keep, [*by, key], "left")
    missing = F.col("kept_version").isNull()
    out = both.groupBy(*by, partition).agg(
        F.count("*").alias("rows"), F.count_if(missing).alias("unreachable"), F.count_if(F.col("kept_version") < F.col(version)).alias("regressed")
    )
    return out.withColumn("proven", (F.col("unreachable") == 0) & (F.col("regressed") == 0))


def retention(rows: DataFrame, proof: DataFrame, partition: str, keep: int, refresh: str = "snapshot") -> DataFrame:
    """Each partition's fate: newest ``keep`` stay, older ones go if proven. A plan: nothing is dropped by it.

    Only a snapshot dataset holds all its rows in each partition; for any other kind a plan is refused.
    """
    if refresh != "snapshot":
        raise ValueError(f"retention needs a snapshot dataset, not {refresh}")
    if keep < 1:
        raise ValueError("the newest partition stays")
    ranked = rows.select(partition).distinct().withColumn("nth", F.dense_rank().over(Window.orderBy(F.col(partition).desc())))
    fate = F.when(F.col("nth") <= keep, "newest").when(F.coalesce("proven", F.lit(False)), "drop").otherwise("unproven")
    return ranked.join(proof.select(partition, "proven"), partition, "left").select(partition, "nth", fate.alias("fate"))


def kept_rows(rows: DataFrame, fates: DataFrame, partition: str, dry_run: bool = True) -> DataFrame:
    """The rows that stay when a plan is applied; all of them in a dry run, which is the default."""
    return rows if dry_run else rows.join(F.broadcast(fates.filter("fate = 'drop'").select(partition)), partition, "left_anti")


def runs_to_drop(runs: DataFrame, fates: DataFrame, partition: str) -> DataFrame:
    """Runs all of whose partitions go."""
    gone = fates.filter("fate = 'drop'").select(partition).withColumn("gone", F.lit(True))
    return runs.join(gone, partition, "left").groupBy("run_id").agg(F.every(F.coalesce("gone", F.lit(False))).alias("all_gone")).filter("all_gone").select("run_id")


def changed_partitions(old: DataFrame, new: DataFrame, partition: str, share: float = 0.5) -> DataFrame:
    """New or grown partitions are rebuilt alone; a shrunk or vanished one, or a share of them touched, rebuilds the table.

    A partition has grown or shrunk by its rows; with equal rows and another number of files it counts as grown, and with equal rows
    and files but another digest it has changed: it was written again with other values.
    """
    for c in ("files", "digest"):
        if (c in old.columns) != (c in new.columns):
            raise ValueError(f"both states need {c}, or none")
    have = lambda df, c, kind: F.col(c).cast(kind) if c in df.columns else F.lit(0).cast(kind)
    mine = lambda df, name: df.select(partition, F.col("rows").alias(f"{name}_rows"), have(df, "files", "long").alias(f"{name}_files"), have(df, "digest", "string").alias(f"{name}_digest"))
    both = mine(old, "old").join(mine(new, "new"), partition, "full_outer")
    state = (
        F.when(F.col("old_rows").isNull(), "new").when(F.col("new_rows").isNull(), "vanished").when(F.col("new_rows") > F.col("old_rows"), "grown")
        .when(F.col("new_rows") < F.col("old_rows"), "shrunk").when(F.col("new_files") != F.col("old_files"), "grown")
        .when(~F.col("new_digest").eqNullSafe(F.col("old_digest")), "changed").otherwise("same")
    )
    both = both.select(partition, state.alias("state"))
    totals = both.agg(F.max(F.col("state").isin("vanished", "shrunk")).alias("lost"), (F.count_if(F.col("state") != "same") >= share * F.count("*")).alias("much"))
    rebuild = F.when(F.col("lost") | F.col("much"), "table").when(F.col("state") != "same", "partition").otherwise("none")
    return both.join(F.broadcast(totals)).select(partition, "state", rebuild.alias("rebuild"))


def derived_staleness(then: DataFrame, now: DataFrame) -> DataFrame:
    """Rows added make a derived table stale; the same rows with a newer position have drifted."""
    both = then.select("table_name", F.col("rows").alias("then_rows"), F.col("watermark").alias("then_mark")).join(
        now.select("table_name", F.col("rows").alias("now_rows"), F.col("watermark").alias("now_mark")), "table_name", "full_outer"
    )
    state = F.when(~F.col("then_rows").eqNullSafe(F.col("now_rows")), "stale").when(~F.col("then_mark").eqNullSafe(F.col("now_mark")), "drift").otherwise("current")
    return both.select("table_name", state.alias("state"))
