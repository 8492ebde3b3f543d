"""Language identification by averaged hashed subword embeddings and a linear softmax, with calibrated rejection.

Subwords are the 2-, 3- and 4-byte windows of the lower-cased text with runs of other than letters made one space; each is
hashed into ``BUCKETS``. A document is the mean of its subwords' embeddings. Embeddings and softmax are trained together by
stochastic gradient descent in numpy on at most ``TRAIN_ROWS`` different labelled texts, those of lowest hash; one in ``HELD`` of them
is kept from training to set the temperature and the confidence below which a document is rejected.

A text that is null or has no letter is ``und`` with score 0 and is rejected. Rows without a language teach nothing; with
no labelled row at all every document is ``und``. Equal texts get equal answers; an empty table gives an empty table; other
columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemetrics.llm.common import fold, slices, table

BUCKETS, DIM = 1 << 15, 16
TRAIN_ROWS, HELD = 4000, 8
EPOCHS, RATE = 6, 8.0
#: Share of rightly recognised held-out documents that may fall below the rejection threshold, and its upper limit.
LOST, STRICTEST = 0.002, 0.5
#: Characters that are turned into features at a time.
CHUNK = 1 << 20
UNKNOWN = "und"

_MULTIPLY = {2: np.uint32(2654435761), 3: np.uint32(2246822519), 4: np.uint32(3266489917)}


def _letters(text: str) -> bytes:
    """Lower-cased letters, other runs as one space, a space at either end; empty if there is no letter."""
    lowered = text.lower()
    if lowered.isascii():
        raw = np.frombuffer(lowered.encode(), dtype=np.uint8)
        letter = (raw >= 97) & (raw <= 122)
        raw = np.where(letter, raw, 32).astype(np.uint8)
        keep = letter | np.concatenate(([False], letter[:-1]))
        out = raw[keep].tobytes().strip() if len(raw) else b""
    else:
        out = " ".join("".join([c if c.isalpha() else " " for c in lowered]).split()).encode("utf-8", "ignore")
    return b" " + out + b" " if out else b""


def _subwords(raw: bytes) -> np.ndarray:
    """Bucket of every window of 2, 3 and 4 bytes."""
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    code, found = b, []
    for n in (2, 3, 4):
        if len(b) < n:
            break
        code = code[: len(b) - n + 1] * np.uint32(256) + b[n - 1 :]
        found.append((code * _MULTIPLY[n]) >> np.uint32(17))
    return np.concatenate(found).astype(np.int32)


def _parts(raw: bytes) -> Iterator[bytes]:
    """Overlapping parts of a long text: every window of 4 bytes lies in one part, shorter ones at the seams count twice."""
    for i in range(0, max(1, len(raw) - 3), CHUNK):
        yield raw[i : i + CHUNK + 3]


def features(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, the distinct buckets of a text and their shares of its subwords; texts without letters are left out."""
    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("shares", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole, "__text")):
            rows, buckets, shares = [], [], []
            for i, value in enumerate(batch.column("__text")):
                raw = _letters(value.as_py() or "")
                if raw:
                    counts = sum(np.bincount(_subwords(p), minlength=BUCKETS) for p in _parts(raw))
                    at = np.flatnonzero(counts)
                    rows.append(i)
                    buckets.append(at.astype(np.int32))
                    shares.append((counts[at] / counts.sum()).astype(np.float32))
            kept = batch.take(pa.array(rows, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*(kept.column(i) for i in range(len(keep))), pa.array(buckets, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))], names=schema.names
            )

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    """Names of languages, one row of logits for each bucket (embedding times softmax weights), bias, temperature, threshold."""

    def __init__(self, names: list[str], logits: np.ndarray, bias: np.ndarray, temperature: float, threshold: float):
        self.names, self.logits, self.bias, self.temperature, self.threshold = names, logits, bias, temperature, threshold

    def raw_scores(self, raw: bytes) -> np.ndarray:
        total, n = np.zeros(len(self.names)), 0
        for part in _parts(raw):
            found = _subwords(part)
            n += len(found)
            total += np.bincount(found, minlength=BUCKETS).astype(np.float32) @ self.logits if len(found) > BUCKETS else self.logits[found].sum(axis=0)
        return total / n + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        raw = _letters(text or "")
        if not raw or not self.names:
            return UNKNOWN, 0.0, True
        p = _softmax(self.raw_scores(raw) / self.temperature)
        best = int(p.argmax())
        return self.names[best], float(p[best]), bool(p[best] < self.threshold)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """rows: language, buckets, shares. Training order and first weights follow the seed alone."""
    names = sorted({r[0] for r in rows})
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    rng, at = np.random.default_rng(seed), {n: i for i, n in enumerate(names)}
    order = rng.permutation(len(rows))
    held = {int(i) for i in order[: len(rows) // HELD]} if len(rows) >= 10 * HELD else set()
    use = np.array([i for i in order if int(i) not in held])
    table_ = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = rng.normal(0, 0.1, (DIM, len(names))).astype(np.float32), np.zeros(len(names), np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(use):
            name, buckets, shares = rows[i]
            mean = shares @ table_[buckets]
            g = _softmax(mean @ weights + bias)
            g[at[name]] -= 1
            back = weights @ g
            weights -= rate * 0.1 * np.outer(mean, g)
            bias -= rate * 0.01 * g
            table_[buckets] -= rate * shares[:, None] * back
    logits = (table_ @ weights).astype(np.float32)
    z = np.array([rows[i][2] @ logits[rows[i][1]] + bias for i in sorted(held)]) if held else np.zeros((0, len(names)))
    y = np.array([at[rows[i][0]] for i in sorted(held)], dtype=int)
    temperature, threshold = 1.0, 0.0
    if len(y):
        def loss(t: float) -> float:
            return float(-np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean())

        temperature = min(np.geomspace(0.1, 10, 41), key=loss)
        p = _softmax(z / temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == y]
        threshold = min(STRICTEST, float(np.quantile(right, LOST))) if len(right) else 0.0
    return Model(names, logits, bias.astype(float), float(temperature), threshold)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", most: int = TRAIN_ROWS) -> Model:
    """Train on at most ``most`` of the rows that have a language, those with the lowest hash of text and language."""
    import pyarrow as pa

    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text", "lang"))
    n = rows.agg(F.approx_count_distinct("mark")).first()[0]
    if not n:
        return train([])
    rows = rows.withColumn("draw", F.pmod("mark", F.lit(1 << 30))).filter(F.col("draw") < int(min(1.0, 1.5 * most / n) * (1 << 30)))
    rows = rows.groupBy("mark", "draw", "lang").agg(F.any_value("text").alias("text"))  # copies are one row of the sample
    found = features(rows, ["lang", "draw"]).orderBy("draw", "lang").limit(most).toArrow()
    names = found["lang"].to_pylist()
    buckets, shares = (found[c].combine_chunks() for c in ("buckets", "shares"))
    ends = np.asarray(buckets.offsets)
    flat = np.array(buckets.values, np.int32), np.array(shares.values, np.float32)
    del found, buckets, shares
    gc.collect()
    pa.default_memory_pool().release_unused()  # the driver keeps one copy of the sample, and that only while it trains
    return train([(k, flat[0][a:b], flat[1][a:b]) for k, a, b in zip(names, ends[:-1], ends[1:], strict=True)])


def identify(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred, score (calibrated probability of that language), rejected."""
    schema = T.StructType(
        [*df.select(*keep).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    )
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, whatever the data
    body = text if text in keep else "__text"  # a text goes to Python once

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m = shared.value
        for whole in batches:
            for batch in slices(whole, body):
                found = [m.predict(t.as_py()) for t in batch.column(body)]
                names, scores, rejected = zip(*found, strict=True) if found else ((), (), ())
                cols = [*(batch.column(i) for i in range(len(keep))), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return df.select(*keep, *([] if text in keep else [F.col(text).alias(body)])).mapInArrow(run, schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(fold("doc_id", 3) != 1))
    return identify(docs, model, ["doc_id"]).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {"op7_language_id": op7_language_id}
SQL: dict[str, str] = {}
