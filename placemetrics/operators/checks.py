"""Data checks: each gives rows of (check_name, failures), simple ones in one pass over the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def simple(df: DataFrame, not_null: list[str] = (), accepted: dict[str, list] | None = None, ranges: dict[str, tuple] | None = None) -> DataFrame:
    """not_null, accepted_values and accepted_range of a table in one aggregate; NULL passes the last two, bounds are inclusive."""
    tests = [(f"not_null_{c}", F.col(c).isNull()) for c in not_null]
    tests += [(f"accepted_values_{c}", ~F.col(c).isin(v)) for c, v in (accepted or {}).items()]
    for c, (low, high) in (ranges or {}).items():
        if low is None and high is None:
            raise ValueError(f"a range check of {c} needs a bound")
        tests.append((f"accepted_range_{c}", reduce(lambda a, b: a | b, [x for x in (low is not None and F.col(c) < low, high is not None and F.col(c) > high) if x is not False])))
    one = df.agg(*(F.count_if(t).alias(n) for n, t in tests))
    pairs = ", ".join(f"'{n}', `{n}`" for n, _ in tests)
    return one.selectExpr(f"stack({len(tests)}, {pairs}) as (check_name, failures)")


def duplicates(df: DataFrame, cols: list[str], where: str = "true") -> DataFrame:
    """Groups that occur more than once; NULLs are one group."""
    return df.filter(where).groupBy(*cols).agg(F.count("*").alias("n")).filter("n > 1")


def out_of_range(df: DataFrame, col: str, low=None, high=None, where: str = "true") -> DataFrame:
    tests = [t for t in (None if low is None else F.col(col) < low, None if high is None else F.col(col) > high) if t is not None]
    if not tests:
        raise ValueError(f"a range check of {col} needs a bound")
    return df.filter(where).filter(reduce(lambda a, b: a | b, tests)).groupBy(col).agg(F.count("*").alias("n"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key passes."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def reconciles(part: DataFrame, column: str, whole: DataFrame, total: str, within: float = 0.05) -> DataFrame:
    """Sum of a dimension against a source total: a shortfall above ``within`` or any surplus fails."""
    both = part.agg(F.sum(column).alias("found")).join(F.broadcast(whole.agg(F.sum(total).alias("expected"))))
    short = (F.col("expected") - F.col("found")) / F.col("expected")
    return both.withColumns({"shortfall": short, "passes": (F.col("found") <= F.col("expected")) & (short <= within)})


def as_result(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def registered(registry: DataFrame, found: DataFrame, name: str = "table_name") -> DataFrame:
    """Tables that are registered and not there, or there and not registered: table_name, problem."""
    missing = registry.select(name).distinct().join(found.select(name).distinct(), name, "left_anti").withColumn("problem", F.lit("missing"))
    strange = found.select(name).distinct().join(registry.select(name).distinct(), name, "left_anti").withColumn("problem", F.lit("unregistered"))
    return missing.unionByName(strange)


def log_rows(results: DataFrame, invocation: str, started: str, warn: list[str] = ()) -> DataFrame:
    """Check results as rows of the log: failures of a check named in ``warn`` only warn."""
    failed = F.when(F.col("check_name").isin(list(warn)), "warn").otherwise("fail") if warn else F.lit("fail")
    status = F.when(F.col("failures") > 0, failed).otherwise("pass")
    return results.select(F.lit(invocation).alias("invocation_id"), F.lit(started).alias("run_started_at"), "check_name", "failures", status.alias("status"))


def newest_runs(log: DataFrame, keep: int = 50) -> DataFrame:
    """Rows of the newest ``keep`` invocations, whole invocations only."""
    newest = log.groupBy("invocation_id").agg(F.max("run_started_at").alias("at")).orderBy(F.col("at").desc(), F.col("invocation_id").desc()).limit(keep)
    return log.join(newest.select("invocation_id"), "invocation_id", "left_semi")


def source_freshness(df: DataFrame, ts: str, now, warn_hours: float, error_hours: float) -> DataFrame:
    from placemetrics.functions.casts import hours_between

    age = df.agg(F.max(ts).alias("newest")).withColumn("age_hours", hours_between(F.col("newest"), now))
    return age.withColumn("status", F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error").when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))
