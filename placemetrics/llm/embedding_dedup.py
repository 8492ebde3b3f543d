"""Near-duplicate embeddings by a forest of random-projection trees.

Every tree splits a bounded sample (``SAMPLE`` vectors of lowest hash) along random directions, again and again, until a
leaf stands for about ``LEAF`` vectors of one label. All vectors then go down every tree; one that falls near a cut goes to both
sides (spill). A linked pair differs along a random direction by about the link distance over the root of the number of components, so
that is the scale of the overlap (``MARGIN`` of it on each side): a cut parts few linked pairs, and several trees part a pair all
together hardly ever. Of ``TRIES`` directions and ``CUTS`` cuts of each a node takes those that leave the fewest pairs within
labels, among the cuts that part at most ``LOSS`` of the linked pairs known from the sample; where there is none, as inside
a dense group, the node stays a leaf and is compared whole. A label that some tree leaves whole is compared in that tree alone, others in all.
Vectors of one label that share a leaf are compared by cosine in double precision. A pair that meets in several leaves
counts in the first of them only, so links are counted without listing pairs; each leaf gives its members' numbers of links
and a link to the smallest member of their group there, and those are united. A leaf with more than ``ROWS`` vectors or
``VOLUME`` components of a label is cut into blocks that meet two by two, so a group of any size is compared whole.

Links are exact where a label is left whole; else a pair is missed only if every tree parts it (recall measured in the tests).
Equal vectors of a label are compared once, with their number. A vector that is null, zero, or holds a null or non-finite
component, or whose label or id is null, links with nothing and is its own component. Repeated rows count as vectors of
their own. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemetrics.llm.common import stored, table
from placemetrics.llm.components import components

TREES = 4
SAMPLE, LEAF, LEAST = 16384, 1024, 8
#: Directions that a node tries, cuts of each, on so many of its sampled vectors at most; the share of pairs that a split may leave.
TRIES, CUTS, TRIED, GAIN = 8, 63, 2048, 0.9
#: Overlap on each side of a cut, in link distances over the root of the number of components; share of the sample's linked pairs that a cut may part.
MARGIN, LOSS = 0.5, 0.01
#: Sampled vectors among which linked pairs are looked for, and pairs kept.
PAIRED, KNOWN = 8192, 50_000
#: Vectors, and components of them, in a block of a leaf.
ROWS, VOLUME = 2048, 1 << 20


class Tree:
    """Inner nodes by number: direction, cut, children. Other numbers are leaves."""

    def __init__(self, sample: np.ndarray, kinds: np.ndarray, leaf: float, margin: float, seed: int, near: np.ndarray | None = None):
        rng = np.random.default_rng(seed)
        self.at: dict[int, int] = {}
        self.margin = margin
        directions, cuts, children = [], [], []
        todo, nodes = [(0, np.arange(len(sample)), np.zeros((0, 2), dtype=np.int64) if near is None else near)], 1
        while todo:
            node, rows, pairs = todo.pop()
            if np.bincount(kinds[rows]).max() <= leaf:
                continue
            found = self._split(sample, kinds, rows, pairs, rng)
            if found is None:
                continue
            direction, cut = found
            p = sample[rows] @ direction
            left, right = p < cut + margin, p >= cut - margin
            if left.all() or right.all():
                continue
            self.at[node] = len(cuts)
            directions.append(direction)
            cuts.append(cut)
            children.append((nodes, nodes + 1))
            for number, side in ((nodes, left), (nodes + 1, right)):
                inside = np.zeros(len(sample), dtype=bool)
                inside[rows[side]] = True
                todo.append((number, rows[side], pairs[inside[pairs].all(axis=1)]))
            nodes += 2
        self.directions, self.cuts, self.children = np.array(directions).reshape(len(cuts), sample.shape[1]), np.array(cuts), children

    def _split(self, sample: np.ndarray, kinds: np.ndarray, rows: np.ndarray, pairs: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float] | None:
        """The direction and cut that leave the fewest pairs within labels: random ones, and ones from one vector to another."""
        few = rng.choice(rows, TRIED, replace=False) if len(rows) > TRIED else rows
        few = few[np.argsort(kinds[few], kind="stable")]
        own = kinds[few]
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        all_pairs = (np.diff(starts, append=len(few)).astype(np.float64) ** 2).sum()
        best, least = None, GAIN
        for k in range(TRIES):
            i, j = rng.integers(len(few), size=2)
            direction = sample[few[i]] - sample[few[j]] if k % 4 == 3 else rng.normal(size=sample.shape[1])
            norm = np.linalg.norm(direction)
            if norm == 0:
                continue
            direction = direction / norm
            p = (sample[few] @ direction)[:, None]
            cuts = np.quantile(p, np.arange(1, CUTS + 1) / (CUTS + 1))
            left, right = (np.add.reduceat(side.astype(np.float64), starts, axis=0) for side in (p < cuts + self.margin, p >= cuts - self.margin))
            cost = (left**2 + right**2).sum(axis=0) / all_pairs
            if len(pairs):
                ends = np.sort((sample @ direction)[pairs], axis=1)
                ends = ends[ends[:, 1] - ends[:, 0] > 2 * self.margin] + [self.margin, -self.margin]
                parted = np.searchsorted(np.sort(ends[:, 0]), cuts) - np.searchsorted(np.sort(ends[:, 1]), cuts)
                cost[parted > LOSS * len(pairs)] = np.inf
            at = int(cost.argmin())
            if cost[at] < least:
                best, least = (direction, float(cuts[at])), float(cost[at])
        return best

    def leaves(self, unit: np.ndarray) -> list[list[int]]:
        """For each vector the leaves that it falls into."""
        found: list[list[int]] = [[] for _ in unit]
        todo = [(0, np.arange(len(unit)))]
        while todo:
            node, rows = todo.pop()
            k = self.at.get(node)
            if k is None:
                for i in rows.tolist():
                    found[i].append(node)
                continue
            p = unit[rows] @ self.directions[k]
            for child, side in zip(self.children[k], (p < self.cuts[k] + self.margin, p >= self.cuts[k] - self.margin), strict=True):
                if side.any():
                    todo.append((child, rows[side]))
        return found


def _by_length(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows and the matrix of the vectors of each length, out of an Arrow column without nulls."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths, values = pc.list_value_length(column).to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, values[starts[at][:, None] + np.arange(length)]


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def linked(unit: np.ndarray, kinds: np.ndarray, threshold: float, seed: int = 0) -> np.ndarray:
    """Linked pairs of one label among the first PAIRED vectors of a sample, KNOWN of them at most."""
    unit, kinds = unit[:PAIRED], kinds[:PAIRED]
    found = []
    for start in range(0, len(unit), 512):
        i, j = np.nonzero((unit[start : start + 512] @ unit.T >= threshold) & (kinds[start : start + 512, None] == kinds))
        keep = i + start < j
        found.append(np.stack((i[keep] + start, j[keep]), axis=1))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
    return pairs if len(pairs) <= KNOWN else np.random.default_rng(seed).choice(pairs, KNOWN, replace=False)


def forest(sample: np.ndarray, kinds: np.ndarray, n: int, threshold: float, trees: int = TREES) -> list[Tree]:
    """Trees for n vectors, from a sample of them: whatever their labels, a leaf stands for about LEAF vectors of one."""
    margin = MARGIN * float(np.sqrt(max(0.0, 2 - 2 * threshold))) / np.sqrt(max(1, sample.shape[1])) + 1e-6  # more than rounding can add
    unit, leaf = _unit(sample), max(LEAST, LEAF * len(sample) / max(n, 1))
    near = linked(unit, kinds, threshold) if np.bincount(kinds).max() > leaf else None
    return [Tree(unit, kinds, leaf, margin, seed, near) for seed in range(trees)]


def grow(rows: DataFrame, n: int, length: int, threshold: float, trees: int = TREES) -> list[Tree]:
    """Trees for vectors of one length, from a sample of at most SAMPLE rows."""
    draw = F.pmod(F.xxhash64("vector", F.lit("sample")), F.lit(1 << 30))
    few = rows.filter(F.size("vector") == length).withColumn("draw", draw).filter(F.col("draw") < int(min(1.0, 1.2 * SAMPLE / max(n, 1)) * (1 << 30)))
    few = few.orderBy("draw", "rep").limit(SAMPLE).select("vector", F.xxhash64("label").alias("kind")).toArrow()
    if not few.num_rows:
        return [Tree(np.zeros((1, length)), np.zeros(1, np.int64), LEAST, 0.0, seed) for seed in range(trees)]  # one leaf
    ((_, sample),) = _by_length(few["vector"])
    return forest(sample, np.unique(few["kind"].to_numpy(), return_inverse=True)[1], n, threshold, trees)


def _shared_first(leaves: np.ndarray, leaf: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether this leaf is the first in which the pairs (i, j) meet."""
    first = np.ones(len(i), dtype=bool)
    a, b = leaves[i], leaves[j]
    for x in range(a.shape[1]):
        for y in range(b.shape[1]):
            first &= ~((a[:, x] == b[:, y]) & (a[:, x] >= 0) & (a[:, x] < leaf))
    return first


def _compare(key: tuple, t, threshold: float):
    """One leaf, or two blocks of it: rep, links, root."""
    import pyarrow as pa

    _, leaf, first_block, second_block = (x.as_py() for x in key)
    ids, weight, block = t["rep"].to_numpy(), t["copies"].to_numpy(), t["block"].to_numpy()
    # only leaves before this one matter
    lists = [[y for y in x if y < leaf] for x in t["leaves"].to_pylist()]
    width = max(map(len, lists))
    padded = np.array([x + [-1] * (width - len(x)) for x in lists], dtype=np.int64).reshape(len(lists), width)
    links, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for at, m in _by_length(t["vector"]):
        norm = np.linalg.norm(m, axis=1)
        for start in range(0, len(at), 256):
            cos = (m[start : start + 256] @ m.T) / (norm[start : start + 256, None] * norm)
            x, y = np.nonzero(cos >= threshold)
            i, j = at[x + start], at[y]
            use = i < j
            if first_block != second_block:
                use &= block[i] != block[j]
            i, j = i[use], j[use]
            new = _shared_first(padded, leaf, i, j)
            i, j = i[new], j[new]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            while (root[root] != root).any():
                root = root[root]
            apart = np.unique((root[i] * len(ids) + root[j])[root[i] != root[j]])
            for a, b in zip((apart // len(ids)).tolist(), (apart % len(ids)).tolist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    if ids[a] > ids[b]:
                        a, b = b, a
                    root[b] = a
    hit = np.flatnonzero(links)
    return pa.table({"rep": pa.array(ids[hit], pa.int64()), "links": pa.array(links[hit]), "root": pa.array(ids[[find(int(i)) for i in hit]], pa.int64())})


def link(df: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label", trees: int = TREES) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row a vector."""
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    odd: Column = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists("vector", lambda x: x != 0)
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(odd, F.lit(True))
    marks = [F.xxhash64("vector").alias("h1"), F.xxhash64("vector", F.lit("second")).alias("h2")]
    good = rows.filter(fine).select("vec_id", "label", "vector", *marks)
    groups = good.groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    groups = stored(groups, "vectors")
    counts = groups.groupBy(F.size("vector").alias("length")).count().collect()  # a row for each length that vectors have
    grown = spark.sparkContext.broadcast({r["length"]: grow(groups, r["count"], r["length"], threshold, trees) for r in counts})  # SAMPLE bounds a tree

    schema = T.StructType([*groups.schema.fields, T.StructField("leaves", T.ArrayType(T.LongType()))])

    def route(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            leaves: list = [None] * batch.num_rows
            for at, m in _by_length(batch.column("vector")):
                unit = _unit(m)
                for i, found in zip(at.tolist(), zip(*(t.leaves(unit) for t in grown.value[m.shape[1]]), strict=True), strict=True):
                    leaves[i] = [tree << 32 | x for tree, own in enumerate(found) for x in sorted(own)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int64()))], names=schema.names)

    routed = groups.mapInArrow(route, schema)
    routed = stored(routed, "leaves")
    tree = F.shiftright("leaf", 32)
    held = routed.select("label", F.size("vector").alias("length"), F.explode("leaves").alias("leaf")).groupBy("label", "leaf").agg(F.count("*").alias("held"), F.sum("length").alias("volume"))
    held = stored(held.join(groups.groupBy("label").agg(F.count("*").alias("all")), "label"), "leaf-sizes")
    whole = held.filter("held = all").groupBy("label").agg(F.min(tree).alias("alone"))  # a tree that leaves the label whole is enough
    sizes = held.join(whole, "label", "left").filter((F.col("held") > 1) & (F.col("alone").isNull() | (F.col("alone") == tree)))
    blocks = F.greatest(F.expr(f"(held + {ROWS - 1}) div {ROWS}"), F.expr(f"(volume + {VOLUME - 1}) div {VOLUME}"))
    sizes = sizes.select("label", "leaf", blocks.cast("int").alias("blocks"))
    taken = F.filter("leaves", lambda x: F.col("alone").isNull() | (F.shiftright(x, 32) == F.col("alone")))
    met = routed.join(whole, "label", "left").select("label", "rep", "copies", "vector", taken.alias("leaves")).withColumn("leaf", F.explode("leaves"))
    met = met.join(sizes, ["label", "leaf"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    # two blocks meet in one group; a block meets itself in a group of its own
    met = met.select("label", "leaf", "first", "second", "rep", "copies", "vector", "leaves", "block")
    found = met.groupBy("label", "leaf", "first", "second").applyInArrow(lambda k, t: _compare(k, t, threshold), "rep long, links long, root long")
    found = stored(found, "leaf-links")

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    united = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per = groups.select("label", "h1", "h2", "rep", "copies").join(links, "rep", "left").join(united.withColumnRenamed("node", "rep"), "rep", "left")
    per = per.select(
        "label", "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    some = good.select("vec_id", "label", "h1", "h2").join(per, ["label", "h1", "h2"]).select("vec_id", "n_links", "component_id")
    none = rows.filter(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "embeddings"))


QUERIES = {"op9_embedding_dedup": op9_embedding_dedup}

SQL = {
    "op9_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN degree ON degree.a = vec_id
"""
}
