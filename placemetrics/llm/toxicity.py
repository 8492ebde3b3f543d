"""Toxicity by noisy-channel deobfuscation, then a score of the restored text.

A trigram model of letters is counted over all documents. Words that look disguised (symbols or digits against letters, a
letter three times in a row, single letters with separators between) become lattices: each character may stand for the
letters that the channel allows at a cost, repeated letters and separators may be dropped, and Viterbi decoding under the
letter model picks the reading. The restored text is scored by words and word beginnings of 4 to 6 bytes, hashed into
``BUCKETS``: those far more frequent in toxic documents are evidence, and a logistic model of how much evidence a document
has, how strong and how dense it is gives the score.

The classifier is fitted on at most ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` other labelled documents, those of lowest hash,
after near copies among them are dropped. Labels of a repeated doc_id count as the highest; null labels and ids teach
nothing. Without labels of both kinds every score is the share of toxic labels. Null texts are empty texts; a text without
evidence scores low whatever its length. Equal texts get equal scores; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemetrics.llm.common import fold, stored, table
from placemetrics.llm.near_dedup import _mix, kmers, normal, word_hashes

TOXIC_ROWS, CLEAN_ROWS = 4000, 8000
BUCKETS = 1 << 20
#: Evidence must be in so many toxic documents that, were it in none but them by chance, the odds would be below CHANCE, and
#: LIFT times as frequent there as in others.
CHANCE, LIFT = 1e-6, 8.0
CHUNK = 1 << 20

# The letters that a symbol may stand for.
CHANNEL = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "*": "aeiou", "€": "e", "£": "l", "¥": "y",
}
SEPARATORS = " .-_*"
#: Costs, as negative logarithms: a symbol read as a letter, a symbol dropped, the second of a double letter dropped, one of
#: a longer run dropped, a separator dropped.
READ, DROP, DOUBLE, REPEAT, SEPARATE = 0.5, 8.0, 4.0, 0.1, 0.1

#: Letters by number: 0 is a word's edge, then a to z, ß, à to ÿ; other letters share the last number.
LETTERS = "abcdefghijklmnopqrstuvwxyzß" + "".join(chr(c) for c in range(0xE0, 0x100) if c not in (0xF7,))
SIZE = len(LETTERS) + 2
_NUMBER = {c: i + 1 for i, c in enumerate(LETTERS)}
_CLASS = np.array([_NUMBER.get(chr(c), 0) for c in range(256)], dtype=np.int32)
_SYMBOL = np.array([chr(c) in CHANNEL for c in range(256)])
_GAP = np.array([chr(c) in SEPARATORS for c in range(256)])
_SPACE = np.array([c in (9, 10, 11, 12, 13, 32, 160) for c in range(256)])


def _one_byte(lowered: str) -> np.ndarray:
    """A byte for each character; characters beyond Latin-1 become '?'."""
    return np.frombuffer(lowered.encode("latin-1", "replace"), dtype=np.uint8)


def letter_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts of letters over all texts: SIZE ** 3 sums, whatever the data."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts = np.zeros(SIZE**3, dtype=np.int64)
        for batch in batches:
            for t in batch.column(0):
                low = (t.as_py() or "").lower()
                for i in range(0, len(low), CHUNK):
                    c = np.concatenate(([0, 0], _CLASS[_one_byte(low[i : i + CHUNK])], [0]))
                    counts += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["gram", "n"])

    found = docs.select(text).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SIZE**3)
    counts[found["gram"].to_numpy()] = found["n"].to_numpy()
    return counts.reshape(SIZE, SIZE, SIZE)


def letter_model(counts: np.ndarray) -> np.ndarray:
    """Costs of a letter after two others: trigram, bigram and single letters, mixed."""
    c = counts.copy()
    c[:, 0, 0] = 0  # space after space tells nothing
    one = c.sum(axis=(0, 1)) + 1
    two = c.sum(axis=0) + 0.1
    p1, p2 = one / one.sum(), two / two.sum(axis=1, keepdims=True)
    seen = c.sum(axis=2, keepdims=True)
    p3 = (c + 5 * p2[None]) / (seen + 5)
    return -np.log(0.75 * p3 + 0.2 * p2[None] + 0.05 * p1).astype(np.float32)


def decode(token: str, costs: np.ndarray) -> str:
    """The likeliest letters behind a disguised word, by Viterbi over pairs of last letters."""
    paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    before, run = "", 1
    for i, c in enumerate(token):
        run = run + 1 if c == before else 1
        number = _NUMBER.get(c, SIZE - 1 if c.isalpha() else 0)
        options = [(number, c, 0.0)] if number else [(_NUMBER[x], x, READ) for x in CHANNEL.get(c, "")]
        if not number:
            options.append((0, "", SEPARATE if c in SEPARATORS else DROP))
        elif run > 1:
            options.append((0, "", REPEAT if run > 2 or token[i + 1 : i + 2] == c else DOUBLE))
        following: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, out) in paths.items():
            for n, letter, extra in options:
                state = (b, n) if letter else (a, b)
                total = cost + extra + (float(costs[a, b, n]) if letter else 0.0)
                if state not in following or total < following[state][0]:
                    following[state] = (total, (out, letter) if letter else out)
        paths, before = following, c
    (_, _), (_, out) = min(paths.items(), key=lambda x: x[1][0] + float(costs[x[0][0], x[0][1], 0]))
    letters = []
    while out:
        out, letter = out
        letters.append(letter)
    return "".join(reversed(letters))


def disguised(low: str) -> list[tuple[int, int]]:
    """Places of words to be decoded in a lower-cased text, in order, apart from one another."""
    b = _one_byte(low)
    if len(b) < 3:
        return []
    letter, symbol = _CLASS[b] > 0, _SYMBOL[b]
    touch = np.flatnonzero((letter[:-1] & symbol[1:]) | (symbol[:-1] & letter[1:]))
    thrice = np.flatnonzero((b[:-2] == b[1:-1]) & (b[1:-1] == b[2:]) & letter[2:])
    alone = letter & ~np.concatenate(([False], letter[:-1])) & ~np.concatenate((letter[1:], [False]))
    linked = np.zeros(len(b), dtype=bool)
    linked[:-2] = alone[:-2] & _GAP[b[1:-1]] & alone[2:]
    spans = []
    hits = np.flatnonzero(linked)
    if len(hits):
        apart = np.flatnonzero((np.diff(hits) != 2) | (b[hits[1:] + 1] != b[hits[:-1] + 1]))
        for i, j in zip(np.concatenate(([0], apart + 1)), np.concatenate((apart, [len(hits) - 1])), strict=True):
            if j - i >= 2:  # four single letters or more
                spans.append((int(hits[i]), int(hits[j]) + 3))
    at = np.concatenate((touch, thrice))
    if len(at):
        space = np.flatnonzero(_SPACE[b])
        word = np.unique(np.searchsorted(space, at))
        edges = np.concatenate(([-1], space, [len(b)]))
        spans += [(int(edges[w]) + 1, int(edges[w + 1])) for w in word]
    spans.sort()
    kept: list[tuple[int, int]] = []
    for s in spans:
        if not kept or s[0] >= kept[-1][1]:
            kept.append(s)
    return kept


class Restorer:
    """Restores texts under a letter model, remembering decoded words."""

    def __init__(self, costs: np.ndarray):
        self.costs, self.known = costs, {}

    def __call__(self, text: str | None) -> str:
        low = (text or "").lower()
        out, last = [], 0
        for start, end in disguised(low):
            token = low[start:end]
            if token not in self.known:
                if len(self.known) > 200_000:
                    self.known.clear()
                self.known[token] = decode(token, self.costs)
            out += [low[last:start], self.known[token]]
            last = end
        return "".join([*out, low[last:]]) if out else low


def evidence(restored: str) -> tuple[np.ndarray, int]:
    """Buckets of all words and of their beginnings of 4, 5 and 6 bytes; the number of words."""
    words = normal(restored)
    if not words:
        return np.zeros(0, dtype=np.int64), 0
    b = np.frombuffer(words + b" " * 6, dtype=np.uint8)
    starts = np.concatenate(([0], np.flatnonzero(b[: len(words)] == 32) + 1))
    whole = word_hashes(words).astype(np.uint64)
    code, inside, found = np.zeros(len(starts), dtype=np.uint64), np.ones(len(starts), dtype=bool), [whole]
    for k in range(6):
        c = b[starts + k]
        inside &= c != 32
        code = code * np.uint64(256) + c
        if k >= 3:
            found.append((code * np.uint64(8) + np.uint64(k))[inside])
    return (_mix(np.concatenate(found)) >> np.uint64(44)).astype(np.int64), len(starts)


def _shape(hits: np.ndarray, n_words: int) -> list[float]:
    """What the logistic model sees of a document: amount, strength, best and density of its evidence."""
    hits = hits[hits > 0]
    return [float(np.log1p(len(hits))), float(np.log1p(hits.sum())), float(hits.max()) if len(hits) else 0.0, min(1.0, 10 * len(hits) / max(n_words, 1))]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights, intercept last, by Newton's method with a small ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _map(df: DataFrame, keep: list[str], schema: T.StructType, text: str, make) -> DataFrame:
    """One row out for each row in: the kept columns and what ``make()`` returns for the text."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        one, types = make(), to_arrow_schema(schema)
        for batch in batches:
            made = [one(t.as_py()) for t in batch.column("__text")]
            columns = list(zip(*made, strict=True)) if made else [()] * len(schema)
            new = [pa.array(c, types.field(i).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *new], names=[*keep, *schema.names])

    rows = df.select(*keep, F.col(text).alias("__text"))
    return rows.mapInArrow(run, T.StructType([*rows.select(*keep).schema.fields, *schema.fields]))


class Model:
    def __init__(self, costs: np.ndarray, buckets: np.ndarray, weights: np.ndarray, logistic: np.ndarray, share: float):
        self.costs, self.buckets, self.weights, self.logistic, self.share = costs, buckets, weights, logistic, share

    def scorer(self):
        restore, table_ = Restorer(self.costs), np.zeros(BUCKETS, dtype=np.float32)
        table_[self.buckets] = self.weights

        def score(text: str | None) -> tuple[float, str]:
            restored = restore(text)
            found, n = evidence(restored)
            if not len(self.logistic):
                return self.share, restored
            z = float(np.dot([*_shape(table_[found], n), 1.0], self.logistic))
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), restored

        return score


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """docs: doc_id and text; labels: doc_id, toxic. Only the labels given are learned from."""
    spark = docs.sparkSession
    costs = letter_model(letter_counts(docs, text))
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_clean, n_toxic = (int(x or 0) for x in marked.agg(F.sum(F.lit(1) - F.col("toxic")), F.sum("toxic")).first())
    share = n_toxic / (n_toxic + n_clean) if n_toxic + n_clean else 0.0
    if not n_toxic or not n_clean:
        return Model(costs, np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0), share)
    draw = F.xxhash64("doc_id", F.lit("toxicity"))
    few = marked.filter("toxic = 1").orderBy(draw, "doc_id").limit(TOXIC_ROWS).unionByName(marked.filter("toxic = 0").orderBy(draw, "doc_id").limit(CLEAN_ROWS))
    few = spark.createDataFrame(few.toArrow())  # TOXIC_ROWS + CLEAN_ROWS rows at most
    taught = stored(docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(few), "doc_id"), "toxicity-rows")

    shared = spark.sparkContext.broadcast(costs)

    def marks():
        def one(t: str | None) -> tuple:
            h = kmers(word_hashes(normal(t or "")))
            return tuple(int((_mix(h ^ np.uint64(s)) >> np.uint64(1)).min()) if len(h) else 0 for s in (1, 2, 3))
        return one

    signs = T.StructType([T.StructField(f"s{i}", T.LongType()) for i in range(3)])
    own = _map(taught, ["doc_id", "toxic"], signs, "text", marks).orderBy("doc_id").toArrow().to_pandas()
    for s in signs.names:
        own = own.drop_duplicates(s)
    kept = spark.createDataFrame(own[["doc_id", "toxic"]]) if len(own) else None
    n1, n0 = int((own["toxic"] == 1).sum()), int((own["toxic"] == 0).sum())
    taught = taught.drop("toxic").join(F.broadcast(kept), "doc_id").select("doc_id", "toxic", "text").dropDuplicates(["doc_id"])

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        restore, counts = Restorer(shared.value), np.zeros((2, BUCKETS), dtype=np.int32)
        for batch in batches:
            for label, t in zip(batch.column("toxic").to_pylist(), batch.column("text"), strict=True):
                counts[1 if label else 0, np.unique(evidence(restore(t.as_py()))[0])] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[1, at], pa.int64()), pa.array(counts[0, at], pa.int64())], names=["bucket", "n1", "n0"])

    sums = taught.mapInArrow(count, "bucket long, n1 long, n0 long").groupBy("bucket").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    support = int(np.ceil(np.log(CHANCE) / np.log(n1 / (n1 + n0)))) if n0 else 1
    found = sums.filter(F.col("n1") >= support).toArrow().to_pandas().sort_values("bucket")  # at most BUCKETS rows
    rate1, rate0 = (found["n1"] + 0.5) / (n1 + 1), (found["n0"] + 0.5) / (n0 + 1)
    strong = (rate1 / rate0 >= LIFT).to_numpy()
    buckets, weights = found["bucket"].to_numpy()[strong], np.log(rate1 / rate0).to_numpy()[strong].astype(np.float32)
    evident = spark.sparkContext.broadcast((buckets, weights))

    def shapes():
        restore, table_ = Restorer(shared.value), np.zeros(BUCKETS, dtype=np.float32)
        table_[evident.value[0]] = evident.value[1]

        def one(t: str | None) -> tuple:
            hits, n = evidence(restore(t))
            return (_shape(table_[hits], n),)
        return one

    x = _map(taught, ["doc_id", "toxic"], T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))]), "text", shapes).orderBy("doc_id").toArrow()
    y = np.asarray(x["toxic"].to_pylist(), dtype=float)
    w = _logistic(np.asarray(x["x"].to_pylist()), y)
    w[-1] += np.log(n_toxic / n_clean) - np.log(max(n1, 1) / max(n0, 1))  # the sample has more toxic rows than the corpus
    return Model(costs, buckets, weights, w, share)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", restored: bool = False) -> DataFrame:
    """``keep`` columns, score from 0 to 1, and on request the restored text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SIZE ** 3 costs and BUCKETS weights at most
    made = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("restored", T.StringType())][: 1 + restored])

    def make():
        one = shared.value.scorer()
        return one if restored else lambda t: one(t)[:1]

    return _map(docs, keep, made, text, make)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(fold("doc_id", 5) != 0))
    scored = score(docs, model, ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op2_toxicity": op2_toxicity}
SQL: dict[str, str] = {}
