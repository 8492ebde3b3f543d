"""Numbers and ranks over a whole table, without a task that holds it.

The table is cut into ranges of the order by sampled bounds and each range is sorted in its own task; the rows of a range are
counted, and the counts before it are its offset. Equal values may be dealt over several ranges: what a range needs to know of
the ones before it is one row a range, which is all that the driver sees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemetrics.sources.zones import stored

_IN_RANGE = (1 << 33) - 1


def _ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The table sorted range by range and written: __range, and __at from 0 in each. Written once more before, so that a range read again is the same."""
    rows = stored(df, "unranked").withColumn("__tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, F.col("__tie")).sortWithinPartitions(*order, F.col("__tie")).withColumn("__at", F.monotonically_increasing_id())
    rows = rows.withColumn("__range", F.shiftright("__at", 33).cast("int")).withColumn("__at", F.col("__at").bitwiseAND(F.lit(_IN_RANGE)))
    return stored(rows.drop("__tie"), "ranges")


def _numbers(of: dict[int, int]) -> Column:
    """A number for each range, from a map as long as there are ranges."""
    return F.create_map(*(F.lit(x) for kv in of.items() for x in (kv[0], kv[1])))[F.col("__range")] if of else F.lit(None).cast("long")


def numbered(df: DataFrame, order: list[Column], name: str = "row_number") -> DataFrame:
    """1, 2, 3 and so on in the given order over the whole table. Rows equal in the order come one after another, in any order."""
    rows = _ranges(df, order)
    offsets, total = {}, 0
    for r in rows.groupBy("__range").count().orderBy("__range").collect():  # one row a range
        offsets[r[0]], total = total, total + r[1]
    return rows.withColumn(name, (_numbers(offsets) + F.col("__at") + 1).cast("long")).drop("__range", "__at")


def ranked(df: DataFrame, by: str, name: str) -> DataFrame:
    """Rank by a column, largest first, nulls last: equal values share the number of the first of them, and the next value counts them all."""
    rows = _ranges(df, [F.col(by).desc_nulls_last()]).withColumn("__value", F.xxhash64(by))
    rows = rows.withColumn("__first", F.min("__at").over(Window.partitionBy("__range", "__value")))
    ends = rows.groupBy("__range").agg(F.count("*"), F.min_by("__value", "__at"), F.max_by("__value", "__at"), F.max("__first")).orderBy("__range").collect()  # one row a range
    offsets, carried, total, last = {}, {}, 0, (None, 0)
    for at, n, first_value, last_value, last_at in ends:
        offsets[at] = total
        goes_on = last[0] == first_value
        carried[at] = last[1] if goes_on else total + 1  # the rank of the range's first value
        last = (last_value, carried[at] if last_at == 0 else total + last_at + 1)
        total += n
    value = F.when(F.col("__first") == 0, _numbers(carried)).otherwise(_numbers(offsets) + F.col("__first") + 1)
    return rows.withColumn(name, value.cast("int")).drop("__range", "__at", "__value", "__first")
