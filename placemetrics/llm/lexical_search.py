"""Ranked lexical search by an Aho-Corasick scan of the documents' texts: no index of the documents is made.

The items' terms become the words of an automaton, each between two guards. A text is read as bytes in which every byte that
ends a term is a guard and A to Z are lower case, so that the automaton finds exactly whole terms, and neighbours share a guard.
Its outputs are numbers of terms, which map to the items that hold them. The documents are scanned twice: once for the
documents that hold each term and the size of the corpus, once for the scores, by which each task keeps its best k of each item.

An automaton and its terms go to every task; items are dealt into as many blocks as it takes for a block's item texts to stay under
``BLOCK_BYTES`` on average (an item is never cut), and each block scans the documents anew. The k best of an item are found in two steps, first within
parts of the tasks' candidates.

Terms are the maximal runs of characters other than ASCII ones that are no letter or digit; only A to Z are lower-cased. A null
or empty text has no term and takes no part in N. Rows of one item_id are one item with all their terms; an item without terms
or without a scoring document has no row. Repeated rows of documents are documents of their own. Equal scores go by doc_id, a
null one last. An empty table of documents or items gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemetrics.llm.common import slices, stored, table

#: Bytes of item texts behind one automaton, bytes of document text scanned together, scores held together.
BLOCK_BYTES, SLICE, CELLS = 8 << 20, 4 << 20, 1 << 21
#: Parts of an item's candidates in the first step of ranking.
PARTS = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of a text as the automaton reads them.
READ = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0)))


class Automaton:
    """The automaton of some items: terms by number, and the items of each term."""

    def __init__(self, words: list[str], holders: list[list[int]]):
        import ahocorasick

        self.size = len(words)
        self.starts = np.concatenate(([0], np.cumsum([len(h) for h in holders]))).astype(np.int64)
        self.items = np.array([i for h in holders for i in h], dtype=np.int64)
        self.words = ahocorasick.Automaton()
        for k, w in enumerate(words):
            self.words.add_word(f" {w.encode().decode('latin-1')} ", k)
        self.words.make_automaton()

    def scan(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The terms that each text holds: place of the text, term, occurrences; and the number of all terms of each text."""
        owner, found, sizes = [], [], np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            if not text:
                continue
            read = b" " + text.encode().translate(READ) + b" "
            solid = np.frombuffer(read, dtype=np.uint8) != 32
            sizes[k] = np.count_nonzero(solid[1:] & ~solid[:-1])
            hits = np.fromiter((t for _, t in self.words.iter(read.decode("latin-1"))), dtype=np.int64)
            found.append(hits)
            owner.append(np.full(len(hits), k, dtype=np.int64))
        if not found:
            nothing = np.zeros(0, dtype=np.int64)
            return nothing, nothing, nothing, sizes
        key, times = np.unique(np.concatenate(owner) * self.size + np.concatenate(found), return_counts=True)
        return key // self.size, key % self.size, times, sizes


def count(df: DataFrame, automaton, text: str) -> DataFrame:
    """term, docs, words: documents that hold each term; row -1 has the documents with any term at all and all their terms."""
    shared = df.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        automaton = shared.value
        df_, n, total = np.zeros(automaton.size, dtype=np.int64), 0, 0
        for whole in batches:
            for batch in slices(whole, text, SLICE):
                _, term, _, sizes = automaton.scan(batch.column(text).to_pylist())
                df_ += np.bincount(term, minlength=automaton.size)
                n, total = n + np.count_nonzero(sizes), total + int(sizes.sum())
        at = np.flatnonzero(df_)
        columns = [np.append(at, -1), np.append(df_[at], n), np.append(np.zeros(len(at), np.int64), total)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "docs", "words"])

    found = df.select(text).mapInArrow(run, "term long, docs long, words long")
    return found.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words"))


class Best:
    """The best k of each item among the documents seen so far: higher score, then smaller id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, dtype=np.int64)
        self.held = np.zeros((4, 0), dtype=np.int64)  # item, score, id, whether the id is null

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Scores by document and item."""
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        rows = np.concatenate((self.held, np.stack((item, scores[doc, item], ids[doc], null[doc]))), axis=1)
        rows = rows[:, np.lexsort((rows[2], rows[3], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        place = np.arange(rows.shape[1]) - first
        self.held = rows[:, place < self.k]
        full = rows[:, place == self.k - 1]
        self.least[full[0]] = full[1]


def scored(df: DataFrame, automaton, weights: np.ndarray, n_docs: int, all_words: int, key: str, text: str, k: int) -> DataFrame:
    """item, id, score: each task's best k documents of every item."""
    n_items = int(automaton.items.max()) + 1
    shared = df.sparkSession.sparkContext.broadcast((automaton, weights))
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField(key, T.LongType()), T.StructField("score", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        automaton, weights = shared.value
        best, step = Best(n_items, k), max(1, CELLS // n_items)
        for whole in batches:
            for batch in slices(whole, text, SLICE):
                ids, null = pc.fill_null(batch.column(key), 0).to_numpy(), np.asarray(pc.is_null(batch.column(key))).astype(np.int64)
                doc, term, tf, sizes = automaton.scan(batch.column(text).to_pylist())
                m = 10 + (90 * sizes * n_docs) // max(all_words, 1)
                worth = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                for start in range(0, len(sizes), step):
                    a, b = np.searchsorted(doc, (start, start + step))
                    held = automaton.starts[term[a:b] + 1] - automaton.starts[term[a:b]]
                    within = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
                    item = automaton.items[np.repeat(automaton.starts[term[a:b]], held) + within]
                    scores = np.zeros((min(step, len(sizes) - start), n_items), dtype=np.int64)
                    np.add.at(scores, (np.repeat(doc[a:b] - start, held), item), np.repeat(worth[a:b], held))
                    best.add(scores, ids[start : start + step], null[start : start + step])
        item, score, id_, is_null = best.held
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(id_, pa.int64(), mask=is_null.astype(bool)), pa.array(score)], names=schema.names)

    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, item_id: str = "item_id", doc_id: str = "doc_id", k: int = 10, text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("__item"), F.explode(terms(F.col(text))).alias("term")).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("__item"), F.lit(blocks).cast("long"))), "terms")
    out = None
    for block in range(blocks):
        rows = asked.filter(F.col("block") == block).groupBy("term").agg(F.collect_list(F.struct("__item")).alias("items")).collect()  # BLOCK_BYTES of items
        if not rows:
            continue
        names = {i: n for n, i in enumerate({i for r in rows for (i,) in r[1]})}
        automaton = Automaton([r[0] for r in rows], [[names[i] for (i,) in r[1]] for r in rows])
        counted = {r[0]: r for r in count(docs, automaton, text).collect()}  # a row for each term of the block
        n, words = (counted[-1][1], counted[-1][2]) if -1 in counted else (0, 0)
        found = np.array([counted[t][1] if t in counted else 0 for t in range(automaton.size)], dtype=np.float64)
        weights = np.floor(1000.0 * np.log((2.0 * n + 2.0) / (2.0 * found + 1.0))).astype(np.int64)
        best = scored(docs, automaton, weights, n, words, doc_id, text, k)
        known = spark.createDataFrame([(v, i) for i, v in names.items()], T.StructType([T.StructField("item", T.LongType()), T.StructField(item_id, items.schema[item_id].dataType)]))
        best = best.join(F.broadcast(known), "item").drop("item")
        out = best if out is None else out.unionByName(best)
    if out is None:
        fields = [items.schema[item_id], T.StructField("rank", T.IntegerType()), T.StructField(doc_id, T.LongType()), T.StructField("score", T.LongType())]
        return spark.createDataFrame([], T.StructType(fields))
    order = [F.col("score").desc(), F.col(doc_id).asc_nulls_last()]
    for by in ([item_id, "part"], [item_id]):
        rows = out.withColumn("part", F.pmod(F.xxhash64(doc_id), F.lit(PARTS).cast("long"))) if len(by) == 2 else out
        out = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)
    return out.select(item_id, "rank", doc_id, "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op11_lexical_search": op11_lexical_search}

_TERMS = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')"
SQL = {
    "op11_lexical_search": f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
sized AS (SELECT row, doc_id, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sized),
items AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT DISTINCT term FROM items),
tf AS MATERIALIZED (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) JOIN asked USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM tf, corpus GROUP BY term, docs),
scored AS (
  SELECT item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM items JOIN tf USING (term) JOIN w USING (term) JOIN sized USING (row), corpus GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, row)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
}
