"""Exact top-k search by no-random-access aggregation over sorted lists.

In a block of vectors each dimension is a list, sorted by that component, that a query reads from its better end: from the
top for a positive weight, from the bottom for a negative one. A query reads all its lists down together, step by step, and
keeps for what it has seen a lower bound (what is unread counts as the far end of its list) and an upper bound (what is
unread counts as the value last read). It stops as soon as nothing outside its best k can qualify: neither an unseen vector,
whose bound is the sum of the values last read, nor a seen one below the k-th lower bound. Only then are the scores of what
is left resolved. Blocks of vectors and blocks of queries meet in pairs, so a task holds one of each, of bounded size;
the best k of all blocks are then ranked.

Components become floor(scale * x), whole numbers, and sums are whole too, so no score is rounded; one that a long cannot
hold is an error. A vector that is null, or holds a null, NaN or infinite component, takes no part, nor does one with a null
id. Ties go to the smaller id. Equal rows are candidates of their own, except that a query never meets rows of its own id.
Vectors of another length than a query's are not compared with it. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemetrics.llm.common import table

#: Vectors and queries of a block at most; blocks that a smaller table is cut into, and rows of such a block at least.
BLOCK, QUERY_BLOCK, PARTS, LEAST = 16384, 4096, 8, 1024
#: Places of the lists read at first, and the growth of a step: bounds are compared after each step.
STEP, GROWTH = 32, 1.2
#: Queries that read in step.
BATCH = 256


class Lists:
    """The sorted lists of a block: which vector stands where in each dimension, and the reverse."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(len(vectors), dtype=np.int32)[:, None], axis=0)
        self.least, self.most = vectors.min(axis=0), vectors.max(axis=0)
        self.size = np.maximum(np.abs(self.least.astype(np.float64)), np.abs(self.most.astype(np.float64)))


def no_random_access(lists: Lists, weights: np.ndarray, eligible: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions and scores of what may be among the best k of the eligible vectors, ties included, and how many entries were read."""
    n, dims = len(lists.vectors), np.flatnonzero(weights)
    if float((np.abs(weights.astype(np.float64)) * lists.size).sum()) >= 2.0**61:
        raise OverflowError("a score is beyond a long")
    left, depth = np.flatnonzero(eligible), 0
    if len(left) > k and len(dims):
        w, up = weights[dims], weights[dims] > 0
        order, vectors = lists.order[:, dims], lists.vectors[:, dims]
        worst = w * np.where(up, lists.least[dims], lists.most[dims])
        gain, seen = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)  # a lower bound is gain and the sum of the worst
        at, open_ = np.arange(len(dims)), True
        while depth < n and len(left) > k:
            t = np.arange(depth, min(n, max(depth + STEP, int(depth * GROWTH))))
            rows = np.where(up, order[n - 1 - t], order[t])
            read = vectors[rows, at] * w - worst
            np.add.at(gain, rows.ravel(), read.ravel())
            depth, last = int(t[-1]) + 1, read[-1]
            if open_:
                seen[rows.ravel()] = True
                known = np.flatnonzero(seen & eligible)
                if len(known) < k:
                    continue
                bar = np.partition(gain[known], len(known) - k)[len(known) - k]
                if last.sum() >= bar and depth < n:
                    continue  # an unseen vector may still qualify
                open_, left = False, known
            bar = np.partition(gain[left], len(left) - k)[len(left) - k]
            left = left[gain[left] + last.sum() >= bar]
            place = lists.place[left][:, dims]
            unread = np.where(up, n - 1 - place, place) >= depth
            left = left[gain[left] + unread @ last >= bar]
    return left, lists.vectors[left] @ weights, depth * len(dims)


def together(lists: Lists, queries: np.ndarray, eligible: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """As ``no_random_access`` for several queries that read in step, a slice of all lists at a time; sums must stay below 2**53.

    A query that is done leaves the batch; a vector that no query still needs leaves the lists.
    """
    n, dims = lists.vectors.shape
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    above, below = (lists.vectors - lists.least).astype(np.float64), (lists.vectors - lists.most).astype(np.float64)
    from_top = n - 1 - lists.place
    column = np.arange(dims)
    left: list[np.ndarray] = [np.flatnonzero(e) for e in eligible]
    read = np.zeros(len(queries), dtype=np.int64)
    active = np.array([len(x) > k for x in left]) & queries.any(axis=1)
    act, rows = np.flatnonzero(active), np.arange(n)
    gain, alive, depth = np.zeros((len(act), n)), eligible[act].copy(), 0
    while len(act) and depth < n:
        to = min(n, max(STEP, n // 64) if not depth else min(2 * depth, depth + max(1, n // 4)))
        top, bottom = (from_top[rows] >= depth) & (from_top[rows] < to), (lists.place[rows] >= depth) & (lists.place[rows] < to)
        hit = np.flatnonzero((top | bottom).any(axis=1))
        if len(hit):
            gain[:, hit] += up[act] @ np.where(top[hit], above[rows[hit]], 0).T + down[act] @ np.where(bottom[hit], below[rows[hit]], 0).T
        depth = to
        read[act] = depth * (queries[act] != 0).sum(axis=1)
        last_up, last_down = up[act] * above[lists.order[n - depth], column], down[act] * below[lists.order[depth - 1], column]
        unseen = last_up.sum(axis=1) + last_down.sum(axis=1)
        known = np.where(alive, gain, -1.0)
        ready = np.flatnonzero((unseen < known.max(axis=1)) | (depth == n))
        if not len(ready):
            continue
        size = known.shape[1]
        bar = np.partition(known[ready], size - k, axis=1)[:, size - k] if size > k else np.full(len(ready), -1.0)
        some = unseen[ready] < bar if depth < n else np.ones(len(ready), dtype=bool)
        ready, bar = ready[some], bar[some]
        if not len(ready):
            continue
        upper = gain[ready] + unseen[ready, None] - last_up[ready] @ (from_top[rows] < depth).T - last_down[ready] @ (lists.place[rows] < depth).T
        alive[ready] &= upper >= bar[:, None] - 0.5  # whole numbers: half of one covers rounding
        done = np.zeros(len(act), dtype=bool)
        done[ready] = (alive[ready].sum(axis=1) <= k) | (depth == n)
        for i in np.flatnonzero(done):
            left[act[i]] = rows[alive[i]]
        needed = alive[~done].any(axis=0)
        act, gain, alive, rows = act[~done], gain[~done][:, needed], alive[~done][:, needed], rows[needed]
    for q, at in enumerate(left):
        yield at, lists.vectors[at] @ queries[q], int(read[q])


def _by_length(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and matrix of the vectors of each length in an Arrow column of lists."""
    whole = column.combine_chunks()
    flat, ends = whole.flatten().to_numpy(zero_copy_only=False), np.asarray(whole.offsets, dtype=np.int64)
    starts, sizes = ends[:-1] - ends[0], np.diff(ends)
    for length in np.unique(sizes):
        rows = np.flatnonzero(sizes == length)
        yield int(length), rows, flat[starts[rows][:, None] + np.arange(length)].astype(np.int64).reshape(len(rows), int(length))


def _answers(m: np.ndarray, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    if not m.shape[1]:
        for o in own:
            left = np.flatnonzero(ids != o)
            yield left, np.zeros(len(left), np.int64), 0
        return
    lists = Lists(m)
    small = float(np.abs(queries.astype(np.float64)).max() * lists.size.max()) * m.shape[1] < 2.0**51
    for i in range(0, len(queries), BATCH):
        part, eligible = queries[i : i + BATCH], ids[None, :] != own[i : i + BATCH, None]
        yield from together(lists, part, eligible, k) if small else (no_random_access(lists, w, e, k) for w, e in zip(part, eligible, strict=True))


def search(df: DataFrame, key: str, vector: str, is_query: str, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score for every row where ``is_query`` (an SQL condition on ``key`` as __id) holds."""
    fine = F.col("__id").isNotNull() & F.col("__v").isNotNull() & ~F.exists("__v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(key).alias("__id"), F.col(vector).cast("array<double>").alias("__v")).filter(fine)
    rows = rows.select("__id", F.transform("__v", lambda x: F.floor(x * scale).cast("long")).alias("__v"))
    n, nq = rows.agg(F.count("*"), F.count_if(F.expr(is_query))).first()
    blocks = max(1, -(-n // BLOCK), min(PARTS, -(-n // LEAST)))
    query_blocks = max(1, -(-nq // QUERY_BLOCK), min(PARTS, -(-nq // (LEAST // PARTS))))
    spread = F.pmod(F.xxhash64("__id"), F.lit(blocks).cast("long"))
    vectors = rows.withColumn("block", spread).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = rows.filter(is_query).withColumn("query_block", F.pmod(F.xxhash64("__id", F.lit("query")), F.lit(query_blocks)).cast("int"))
    queries = queries.withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    schema = T.StructType([T.StructField("query_id", df.schema[key].dataType), T.StructField("vec_id", df.schema[key].dataType), T.StructField("score", T.LongType())])

    def meet(q, v):
        import pyarrow as pa

        found: list[list] = [[], [], []]
        vid, qid = v["__id"].to_numpy(), q["__id"].to_numpy()
        asked = {length: (at, m) for length, at, m in _by_length(q["__v"])} if q.num_rows else {}
        for length, at, m in _by_length(v["__v"]) if asked and v.num_rows else ():
            if length not in asked:
                continue
            ids, own_ids, weights = vid[at], qid[asked[length][0]], asked[length][1]
            for own, (left, score, _) in zip(own_ids, _answers(m, weights, ids, own_ids, k), strict=True):
                best = np.lexsort((ids[left], -score))[:k]
                found[0] += [own] * len(best)
                found[1] += ids[left[best]].tolist()
                found[2] += score[best].tolist()
        kind = q.schema.field("__id").type
        return pa.table({"query_id": pa.array(found[0], kind), "vec_id": pa.array(found[1], kind), "score": pa.array(found[2], pa.int64())})

    best = queries.groupBy("block", "query_block").cogroup(vectors.groupBy("block", "query_block")).applyInArrow(meet, schema)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "__id % 50 = 0")


QUERIES = {"op8_topk_search": op8_topk_search}

SQL = {
    "op8_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_inner_product(q.v, c.v), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
}
