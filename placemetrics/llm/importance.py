"""Target-distribution importance resampling over hashed word runs, with CRCs computed in length-bucketed matrices.

A text's features are its runs of 1 to ``RUN`` words. Of a slice of texts each different feature is hashed once: words are
coded, runs are pairs of codes, and the different features of one length stand as rows of a matrix of bytes whose CRCs are
brought forward column by column, all rows at once; the results are scattered back to the features. A first scan counts the
buckets of the documents and of the target; what comes to the driver is one number a bucket. From the two histograms each bucket has
a gain (log ratio, smoothed by one), a second scan sums the gains of each document's features, and documents are drawn without
replacement by Gumbel keys: the largest sums of weight and noise. The noise is a hash of seed and doc_id, so reruns agree. The
drawn are numbered by ranges of the order (``operators.ranks``), so no task sorts the whole.

Words are the maximal runs of characters other than ASCII ones that are no lower-case letter or digit, after A to Z are
lower-cased. A null or empty text has no word, no feature and weight 0; documents under ``least`` words are never drawn. A null
doc_id counts as the empty text in the hash and comes last among ties. Repeated rows are documents of their own. An empty
table of documents gives an empty table; an empty target counts no feature. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemetrics.llm.common import slices, stored, table
from placemetrics.operators.ranks import numbered

#: Words of a feature at most; buckets; seed of the noise; percent drawn; words of a document that may be drawn; bytes scanned together.
RUN, BUCKETS, SEED, PERCENT, LEAST, SLICE = 3, 10_000, 42, 5, 20, 2 << 20
#: Bytes of a text as words are read: A to Z lower-cased, every other ASCII character that is no letter or digit a space.
READ = np.frombuffer(bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower(), dtype=np.uint8)


def _crc_table() -> np.ndarray:
    """The table of the reflected polynomial 0xEDB88320, by its rule."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1).astype(np.uint32)
    return value


CRC = _crc_table()


def crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of byte strings inside ``data``: those of one length as a matrix, column by column, scattered back to their places."""
    out = np.zeros(len(starts), dtype=np.uint32)
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
        at, size = order[a:b], int(sizes[order[a]])
        step = max(1, (4 << 20) // max(size, 1))
        for k in range(0, len(at), step):
            rows = at[k : k + step]
            matrix = data[starts[rows][None, :] + np.arange(size)[:, None]]  # a column of the strings is a row in memory
            crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
            for column in matrix:
                crc = CRC[(crc ^ column) & 0xFF] ^ (crc >> 8)
            out[rows] = ~crc
    return out


def features(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of an Arrow array of texts: words of each text, place of the text of each feature, its number among the different ones, and their buckets."""
    import pyarrow as pa
    import pyarrow.compute as pc

    n = len(texts)
    given = pc.fill_null(texts, "").cast(pa.large_string())
    bounds = np.frombuffer(given.buffers()[1], np.int64)[given.offset : given.offset + n + 1]
    raw = READ[np.frombuffer(given.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]] if n else np.zeros(0, np.uint8)
    at = bounds - (bounds[0] if n else 0)
    solid = raw != 32
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[at[:-1][at[:-1] < len(raw)]] |= solid[at[:-1][at[:-1] < len(raw)]]  # texts stand side by side
    words = np.concatenate(([0], np.cumsum(first)))[at]
    per_text = np.diff(words)
    total = int(words[-1]) if n else 0
    nothing = np.zeros(0, dtype=np.int64)
    if not total:
        return per_text, nothing, nothing, nothing
    starts = np.flatnonzero(first)
    sizes = np.add.reduceat(solid, starts, dtype=np.int64)
    # the words again, one space after each, so that a run of words is one stretch of bytes
    kept = np.flatnonzero(solid)
    owner = np.repeat(np.arange(total), sizes)
    line = np.full(len(kept) + total, 32, dtype=np.uint8)
    line[np.arange(len(kept)) + owner] = raw[kept]
    begin = np.cumsum(sizes + 1) - sizes - 1
    end = begin + sizes
    coded = pa.Array.from_buffers(pa.large_binary(), total, [None, pa.py_buffer(np.append(np.cumsum(sizes) - sizes, len(kept)).astype(np.int64)), pa.py_buffer(raw[kept])]).dictionary_encode()
    word = coded.indices.to_numpy().astype(np.int64)
    of_text = np.repeat(np.arange(n), per_text)
    place, number, buckets, found, code = [], [], [], 0, word
    for run in range(1, RUN + 1):
        if run > 1:
            code = code[:-1] * len(coded.dictionary) + word[run - 1 :]
        whole = of_text[: total - run + 1] == of_text[run - 1 :]  # a run stays within its text
        if not whole.any():
            break
        index = np.flatnonzero(whole)
        _, example, which = np.unique(code[index], return_index=True, return_inverse=True)
        code = np.zeros(len(code), dtype=np.int64)
        code[index] = which
        example = index[example]
        buckets.append(crcs(line, begin[example], end[example + run - 1] - begin[example]).astype(np.int64) % BUCKETS)
        place.append(of_text[index])
        number.append(which + found)
        found += len(example)
    return per_text, np.concatenate(place), np.concatenate(number), np.concatenate(buckets)


def histogram(df: DataFrame, text: str = "text") -> np.ndarray:
    """Features of the whole table in each bucket."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts = np.zeros(BUCKETS, dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, text, SLICE):
                _, _, number, buckets = features(batch.column(text))
                counts += np.bincount(buckets[number], minlength=BUCKETS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in df.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():  # BUCKETS rows
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t = int(corpus.sum()), int(target.sum())
    ratio = [(b + 1) * (s + BUCKETS) / ((a + 1) * (t + BUCKETS)) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def weighed(df: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and the sum of gains of each document's features."""
    shared = df.sparkSession.sparkContext.broadcast(gain)
    rows = df.select(doc_id, text)
    made = [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    schema = T.StructType([rows.schema[doc_id], *made])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for batch in slices(whole, text, SLICE):
                words, place, number, buckets = features(batch.column(text))
                weight = np.zeros(len(words), dtype=np.int64)
                if len(place):
                    np.add.at(weight, place, shared.value[buckets][number])
                n = sum(np.maximum(words - k, 0) for k in range(RUN))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(n), pa.array(weight)], names=schema.names)

    return rows.mapInArrow(run, schema)


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank: every document, the drawn ones numbered from the highest score."""
    gain = gains(histogram(docs, text), histogram(target, text))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = stored(weighed(docs, gain, doc_id, text).withColumn("score", (F.col("weight") + noise).cast("long")), "weighed")
    able = rows.filter(F.col("n_words") >= least)
    drawn = able.count() * percent // 100
    names = [doc_id, "n_features", "weight", "score"]
    place = numbered(able, [F.col("score").desc(), F.col(doc_id).asc_nulls_last()], "rank")
    place = place.select(*names, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return place.unionByName(rows.filter(F.col("n_words") < least).select(*names, F.lit(None).cast("long").alias("rank")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the benchmark texts."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op12_importance_resampling": op12_importance_resampling}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_RUNS = "list_concat(w, list_concat(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))"
SQL = {
    "op12_importance_resampling": f"""
WITH lut AS (SELECT list(list_reduce([v::BIGINT, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, b: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY v) AS t FROM range(256) r(v)),
d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
df AS MATERIALIZED (SELECT row, unnest({_RUNS}) AS f FROM d), bf AS MATERIALIZED (SELECT unnest({_RUNS}) AS f FROM b),
names AS MATERIALIZED (SELECT f, list_transform(range(1, len(hex(f.encode())) // 2 + 1), lambda i: ('0x' || hex(f.encode())[2 * i - 1 : 2 * i])::BIGINT) AS x FROM (SELECT f FROM df UNION SELECT f FROM bf)),
hashed AS MATERIALIZED (SELECT f, xor(list_reduce(list_prepend(4294967295, x), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM names, lut),
s AS (SELECT bucket, count(*) AS s FROM df JOIN hashed USING (f) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM bf JOIN hashed USING (f) GROUP BY 1),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::BIGINT AS big_s, (SELECT coalesce(sum(t), 0) FROM t)::BIGINT AS big_t),
gain AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (big_s + 10000))::DOUBLE / ((coalesce(s, 0) + 1) * (big_t + 10000))::DOUBLE))::BIGINT AS g
  FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
weights AS (SELECT row, sum(g)::BIGINT AS weight FROM df JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY 1),
scored AS (SELECT doc_id, len(w) AS n_words, (len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0))::BIGINT AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN weights USING (row)),
n AS (SELECT 5 * count(*) // 100 AS drawn FROM scored WHERE n_words >= 20),
placed AS (SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM placed, n
"""
}
