"""Column profiles, frequent values, schema hashes, table fingerprints and parity, cardinality of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemetrics.functions.casts import canonical
from placemetrics.sources.zones import stored


def _shape(kind: str, name: str = "", cells: tuple[str, ...] = ()) -> str:
    if name in cells:
        return "cell"
    if kind in ("boolean",):
        return "boolean"
    if kind.startswith(("timestamp", "date")):
        return "temporal"
    if kind in ("double", "float", "int", "bigint", "smallint", "tinyint") or kind.startswith("decimal"):
        return "numeric"
    return "string" if kind == "string" else "blob"


#: Parts that a round of the median cuts what is left of a column into, and values of a column that are sorted in one task at most.
SPLITS, SORTED = 64, 1_000_000


def _median(counts: DataFrame, splits: int | None = None, most: int | None = None) -> DataFrame:
    """column_name and exact median of (column_name, number, n), n rows for each different number.

    Sampled quantiles cut the different numbers of a column into parts of about equal size, whatever their spread; only the part that holds
    the middle goes on, and is cut again until it is small enough to sort.
    """
    splits, most = splits or SPLITS, most or SORTED
    total = counts.groupBy("column_name").agg(F.sum("n").alias("all"))
    rows = counts.select("column_name", "number", "n").join(F.broadcast(total), "column_name").withColumn("before", F.lit(0).cast("long"))
    at = [i / splits for i in range(1, splits)]
    low, high = F.expr("(all - 1) div 2"), F.expr("all div 2")  # the two middle places, counted from 0
    widest = None
    while True:
        cuts = rows.groupBy("column_name").agg(F.percentile_approx("number", at, 1000).alias("cuts"))  # a row a column
        placed = rows.join(F.broadcast(cuts), "column_name").withColumn("part", F.lit(0))
        for step in (1 << b for b in reversed(range((splits - 1).bit_length()))):  # how many cuts lie below, by halves
            further = F.col("part") + step
            placed = placed.withColumn("part", F.when((further < splits) & (F.get("cuts", further - 1) < F.col("number")), further).otherwise(F.col("part")))
        placed = placed.drop("cuts")
        parts = placed.groupBy("column_name", "part").agg(F.sum("n").alias("m"), F.first("all").alias("all"), F.first("before").alias("before"))
        parts = parts.withColumn("upto", F.col("before") + F.sum("m").over(Window.partitionBy("column_name").orderBy("part")))
        held = parts.filter((F.col("upto") > low) & (F.col("upto") - F.col("m") <= high))
        start = F.min(F.col("upto") - F.col("m")).over(Window.partitionBy("column_name"))
        held = held.select("column_name", "part", start.alias("start"))
        rows = stored(placed.join(F.broadcast(held), ["column_name", "part"]).select("column_name", "number", "n", "all", F.col("start").alias("before")), "middles")
        now = rows.groupBy("column_name").count().agg(F.max("count")).first()[0] or 0
        if now <= most or now == widest:
            break
        widest = now
    few = rows.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy("column_name").orderBy("number")))
    both = few.filter((F.col("upto") > low) & (F.col("upto") - F.col("n") <= high)).groupBy("column_name").agg(F.min("number").alias("x"), F.max("number").alias("y"))
    return both.select("column_name", ((F.col("x") + F.col("y")) / 2).alias("median"))


def profile(df: DataFrame, few: int = 50, top: int = 5, cells: tuple[str, ...] = (), described: tuple[str, ...] = ()) -> DataFrame:
    """One row a column: shape, nulls, distinct values, range and median of numbers, first and last time, most frequent values, low signal.

    The table is read once: (column, value) pairs are counted before the shuffle and the rest follows from the counts. A
    constant column has low signal unless it is among the ``described`` ones.
    """
    cols = [(c, _shape(k, c, cells)) for c, k in df.dtypes]
    entries = []
    for nth, (c, shape) in enumerate(cols):
        value = F.col(f"`{c}`")
        whole = shape == "numeric" and dict(df.dtypes)[c] in ("int", "smallint", "tinyint", "float", "double")  # the number says all that the text does
        text = F.when(value.isNotNull(), F.lit("")) if shape == "blob" or whole else value.cast("string")
        number = value.cast("double") if shape == "numeric" else F.lit(None).cast("double")
        entries.append(F.struct(F.lit(nth).alias("nth"), text.alias("text"), number.alias("number")))
    counts = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").groupBy("nth", "text", "number").agg(F.count("*").alias("n"))
    names, shapes = F.array(*(F.lit(c) for c, _ in cols)), F.array(*(F.lit(x) for _, x in cols))
    counts = stored(counts.select(F.get(names, F.col("nth")).alias("column_name"), F.get(shapes, F.col("nth")).alias("shape"), "text", "number", "n"), "counts")
    real = F.col("text").isNotNull()
    most = F.slice(F.array_sort(F.collect_list(F.when(F.col("nth") <= top, F.struct((-F.col("n")).alias("m"), "text")))), 1, top)
    order = Window.partitionBy("column_name").orderBy(F.col("text").isNull(), F.col("n").desc(), "text")
    best = counts.filter(real & F.col("shape").isin("string", "boolean")).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= top)
    best = best.groupBy("column_name").agg(F.concat_ws(",", F.transform(most, lambda x: F.concat_ws(":", x["text"], (-x["m"]).cast("string")))).alias("top_values"))
    one = counts.groupBy("column_name", "shape").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(~real, F.col("n"))), F.lit(0)).alias("n_nulls"), F.count_if(real).alias("n_distinct"),
        F.min("number").alias("low"), F.max("number").alias("high"), F.min(F.when(F.col("shape") == "temporal", F.col("text"))).alias("first_time"), F.max(F.when(F.col("shape") == "temporal", F.col("text"))).alias("last_time"),
    )
    one = one.withColumn("n_distinct", F.when(F.col("shape") != "blob", F.col("n_distinct")))
    one = one.join(_median(counts.filter("number is not null")), "column_name", "left").join(best, "column_name", "left")
    category = (F.col("shape") == "string") & (F.col("n_distinct") <= few) & (F.col("n_distinct") < F.col("n_rows"))
    one = one.withColumns({"shape": F.when(category, "category").otherwise(F.col("shape")), "top_values": F.when(category | (F.col("shape") == "boolean"), F.col("top_values"))})
    constant = F.coalesce(F.col("n_distinct") == 1, F.lit(False)) & ~F.col("column_name").isin(list(described) or [""])
    return one.withColumn("low_signal", (F.col("shape") == "blob") | (F.col("n_nulls") == F.col("n_rows")) | constant)


def frequent(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    return df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "value").limit(k)


def schema_rows(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(i, c, k) for i, (c, k) in enumerate(df.dtypes)], "position int, column_name string, column_type string")


def schema_hash(df: DataFrame) -> str:
    import hashlib

    return hashlib.sha256("\n".join(f"{c}:{k}" for c, k in df.dtypes).encode()).hexdigest()


def schema_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Added, removed, renamed, retyped and reordered columns of two sets of schema rows.

    A removed and an added column of the same type at the same position are one renamed column, reported under its old name.
    """
    both = old.select("column_name", F.col("column_type").alias("t0"), F.col("position").alias("p0")).join(
        new.select("column_name", F.col("column_type").alias("t1"), F.col("position").alias("p1")), "column_name", "full_outer"
    )
    change = F.when(F.col("t0").isNull(), "added").when(F.col("t1").isNull(), "removed").when(F.col("t0") != F.col("t1"), "retyped").when(F.col("p0") != F.col("p1"), "reordered")
    found = both.withColumn("change", change).filter("change is not null")
    gone, come = found.filter("change = 'removed'"), found.filter("change = 'added'")
    pair = gone.select(F.col("column_name").alias("was"), F.col("t0").alias("kind"), F.col("p0").alias("place")).join(
        come.select(F.col("column_name").alias("now"), F.col("t1").alias("kind"), F.col("p1").alias("place")), ["kind", "place"]
    )
    single = found.join(pair.select(F.col("was").alias("column_name")).unionByName(pair.select(F.col("now").alias("column_name"))), "column_name", "left_anti")
    none = F.lit(None).cast("string")
    return single.select("column_name", "change", none.alias("new_name")).unionByName(pair.select(F.col("was").alias("column_name"), F.lit("renamed").alias("change"), F.col("now").alias("new_name")))


def column_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """(table_name, column_name) rows of either side that the other lacks, with the side."""
    cols = ["table_name", "column_name"]
    a, b = left.select(*cols), right.select(*cols)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def fingerprint(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows, a digest of whole rows, and one for each column keyed by the grain; none depends on order."""
    kinds = dict(df.dtypes)
    text = {c: canonical(F.col(c), kinds[c]) for c in sorted(kinds)}
    grain = [text[k] for k in key]
    digest = lambda *parts: F.bit_xor(F.conv(F.substring(F.md5(F.concat_ws("\u0001", *parts)), 1, 15), 16, 10).cast("long"))
    return df.agg(F.count("*").alias("n_rows"), digest(*text.values()).alias("rows_digest"), *(digest(*grain, t).alias(f"{c}_digest") for c, t in text.items() if c not in key))


#: Leaves of the digest tree of a comparison, and leaves under a node.
LEAVES, FAN = 4096, 64


def _leaves(df: DataFrame, key: list[str], kinds: dict[str, str]) -> DataFrame:
    """leaf, n and a digest of every column, keyed by the grain; neither depends on order."""
    own = F.xxhash64(*(canonical(F.col(k), kinds[k]) for k in key))
    rows = df.withColumn("__own", own).withColumn("leaf", F.pmod("__own", F.lit(LEAVES).cast("long")))
    digests = [F.bit_xor(F.xxhash64("__own", canonical(F.col(c), k))).alias(c) for c, k in kinds.items() if c not in key]
    return rows.groupBy("leaf").agg(F.count("*").alias("__n"), F.sum(F.col("__own").cast("decimal(38,0)")).alias("__keys"), *digests)


def differing_ranges(a: DataFrame, b: DataFrame, key: list[str]) -> tuple[list[int], list[str]]:
    """Leaves of the key's hash and columns in which two tables differ, from a digest tree compared from the top down.

    Each table is read once for its leaves; nodes are sums of leaves, and only leaves under a node that differs are compared.
    """
    kinds = {c: k for c, k in a.dtypes if c in b.columns}
    names = ["__n", "__keys", *(c for c in kinds if c not in key)]
    x, y = (stored(_leaves(t, key, kinds), "leaves") for t in (a, b))
    up = [F.sum(c).alias(c) if c in ("__n", "__keys") else F.bit_xor(c).alias(c) for c in names]
    node = F.expr(f"leaf div {FAN}")

    def unlike(p: DataFrame, q: DataFrame, by: str) -> DataFrame:
        both = p.alias("p").join(q.alias("q"), by, "full_outer")
        off = {c: ~F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}")) for c in names}
        missing = F.col("p.__n").isNull() | F.col("q.__n").isNull() | off["__n"] | off["__keys"]
        return both.select(by, *((missing | off[c]).alias(c) for c in names if c in kinds), missing.alias("__missing")).filter(" or ".join(f"`{c}`" for c in (*(c for c in names if c in kinds), "__missing")))

    top = unlike(x.groupBy(node.alias("node")).agg(*up), y.groupBy(node.alias("node")).agg(*up), "node").select("node")
    under = lambda t: t.withColumn("node", node).join(F.broadcast(top), "node", "left_semi").drop("node")
    found = unlike(under(x), under(y), "leaf").collect()  # LEAVES rows at most
    return sorted(r["leaf"] for r in found), [c for c in names if c in kinds and any(r[c] for r in found)]


def differing(a: DataFrame, b: DataFrame, key: list[str], most: int = 5) -> DataFrame:
    """column_name and up to ``most`` keys whose values differ; keys that one table lacks differ in every column.

    Only rows of the leaves that differ are joined, once for all columns.
    """
    leaves, cols = differing_ranges(a, b, key)
    kinds = dict(a.dtypes)
    if not leaves or not cols:
        return a.select(F.lit("").alias("column_name"), *key).limit(0)
    text = lambda t, side: [canonical(F.col(c), kinds[c]).alias(f"{side}_{c}") for c in cols]
    of = a.sparkSession.createDataFrame([(leaf,) for leaf in leaves], "leaf long")

    def part(t: DataFrame, side: str) -> DataFrame:
        own = F.pmod(F.xxhash64(*(canonical(F.col(k), kinds[k]) for k in key)), F.lit(LEAVES).cast("long"))
        return t.withColumn("leaf", own).join(F.broadcast(of), "leaf", "left_semi").select(*key, *text(t, side), F.lit(True).alias(f"{side}_has"))

    both = part(a, "a").join(part(b, "b"), key, "full_outer")
    unlike = F.array_compact(F.array(*(F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in cols)))
    each = both.select(*key, F.explode(unlike).alias("column_name"))
    order = Window.partitionBy("column_name").orderBy(*key)
    return each.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= most).select("column_name", *key)


def cardinality(left: DataFrame, right: DataFrame, lkey: str, rkey: str) -> DataFrame:
    """Measured kind of a join and the share of left rows without a match."""
    a = left.groupBy(F.col(lkey).alias("k")).agg(F.count("*").alias("n"))
    b = right.groupBy(F.col(rkey).alias("k")).agg(F.count("*").alias("m"))
    both = a.join(b, "k", "left")
    out = both.agg(F.max("n").alias("left_max"), F.max("m").alias("right_max"), F.sum("n").alias("left_rows"), F.coalesce(F.sum(F.when(F.col("m").isNull(), F.col("n"))), F.lit(0)).alias("unmatched"))
    side = lambda c: F.when(F.coalesce(F.col(c), F.lit(1)) <= 1, "one").otherwise("many")
    return out.withColumn("kind", F.concat(side("left_max"), F.lit("_to_"), side("right_max")))
