"""Personal data by patterns, and information-theoretic sanitisation of the terms that give protected entities away.

Patterns find e-mail addresses, IP addresses, card and telephone numbers. Each distinct value is a protected entity. Words
within ``WINDOW`` words of an entity co-occur with it; over the whole corpus, the share of a word's documents in which it
stands by one entity estimates how far seeing the word gives that entity away. Few texts are weak evidence, so the lower end
of the share's confidence interval (Wilson's, one-sided at nine in ten, over the different texts that support it) is what
counts, and the share against the entity's own frequency is the information gained. A term that gains ``BITS`` bits or more
and whose disclosure reaches ``GENERALISE`` is generalised, from ``REMOVE`` on removed: its places are added to the spans in
every text, as kinds ``generalise`` and ``remove``, and ``sanitised`` rewrites the texts. No single text passes (1 of 1 has a
lower end of 0.38): a word must stand near the same entity in two different texts at least, in all that hold it (2 of 2:
0.55), and in more if some hold it elsewhere; seven of seven are removed (0.81). Copies of a text count as one.

Pairs with too few texts to pass whatever their share go before anything is counted. Two filters, bitmaps of hashed terms,
say which words of a text are worth counting or looking up; joins on the terms' own hashes then decide. A null text is an empty one and has no spans. Equal texts have equal spans; repeated
rows count as documents of their own, but as one text. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemetrics.llm.common import slices, stored, table
from placemetrics.llm.near_dedup import _Powers, _mix, normal

WINDOW, BITS, GENERALISE, REMOVE, Z = 8, 6.0, 0.5, 0.8, 1.2816
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "generalise", "remove")
#: Bits of a filter: sixteen a term or more, between these bounds; a fuller one lets more words through to the joins.
FILTER, MOST_FILTER = 1 << 20, 1 << 24
#: Terms whose counts a task holds before it hands them on.
HELD = 1 << 18

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in the order of kinds, then starts. Every pattern is read once, left to right."""
    out = []
    at, last = text.find("@"), 0
    while at >= 0:
        before = text[last:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if local else None
        # characters up to a failed @ cannot be part of a later local part, as it holds no @
        last = m.end() if m else at + 1
        if m:
            out.append((0, at - local, m.end()))
        at = text.find("@", last)
    if "." in text:
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def term_hashes(words: bytes) -> np.ndarray:
    """A 64-bit hash for each of the words, which are separated by single spaces."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    b = np.frombuffer(words, dtype=np.uint8)
    up, down = _Powers.to(len(b))
    space = b == 32
    starts = np.concatenate(([0], np.flatnonzero(space) + 1))
    value = (b.astype(np.uint64) + np.uint64(1)) * up[: len(b)]
    value[space] = 0
    return _mix(np.add.reduceat(value, starts) * down[starts])


def _entity(kind: int, value: str) -> int:
    value = _digits(value) if kind in (2, 3) else value.lower()
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _near(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Entities of a text and the terms within WINDOW words of each, as two lists of pairs without repeats."""
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    starts = np.array([w[0] for w in words])
    taken = np.zeros(len(words), dtype=bool)
    ends = np.array([w[1] for w in words])
    inside = [(int(np.searchsorted(ends, s, side="right")), int(np.searchsorted(starts, e))) for _, s, e in spans]
    for i, j in inside:
        taken[i:j] = True
    pairs = set()
    for (kind, s, e), (i, j) in zip(spans, inside, strict=True):
        around = [k for k in (*range(max(0, i - WINDOW), i), *range(j, min(len(words), j + WINDOW))) if not taken[k] and words[k][1] - words[k][0] >= 3]
        if around:
            hashed = term_hashes(b" ".join(normal(text[words[k][0] : words[k][1]]) for k in around)).view(np.int64)
            entity = _entity(kind, text[s:e])
            pairs |= {(entity, int(h)) for h in hashed}
    a, b = zip(*sorted(pairs), strict=True) if pairs else ((), ())
    return list(a), list(b)


_FOUND = "array<struct<kind:int,start:int,end:int>>"


def entities(df: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, two hashes of the text, base spans, and parallel lists of entities and the terms near them."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in (part for whole in batches for part in slices(whole, "__text")):
            marks, spans, ents, terms = [], [], [], []
            for t in batch.column("__text"):
                body = t.as_py() or ""
                found = base_spans(body)
                e, w = _near(body, found) if found else ([], [])
                marks.append(hashlib.blake2b(body.encode("utf-8", "replace"), digest_size=16).digest())
                spans.append([{"kind": k, "start": s, "end": x} for k, s, x in found])
                ents.append(e)
                terms.append(w)
            two = np.frombuffer(b"".join(marks), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(spans, span), pa.array(ents, pa.list_(pa.int64())), pa.array(terms, pa.list_(pa.int64()))],
                names=["doc_id", "t1", "t2", "spans", "entities", "terms"],
            )

    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("__text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, t1 long, t2 long, spans {_FOUND}, entities array<long>, terms array<long>")


def _filter(terms: DataFrame) -> np.ndarray:
    """Which buckets of hashed terms hold one: a bitmap whose size is a power of two."""
    size = FILTER
    n = terms.select("term").distinct().count()
    while size < 16 * n and size < MOST_FILTER:
        size *= 2
    found = terms.select(F.pmod("term", F.lit(size)).alias("bucket")).groupBy("bucket").agg(F.lit(1).alias("one")).select("bucket").toArrow()  # MOST_FILTER rows at most
    out = np.zeros(size, dtype=bool)
    out[found["bucket"].to_numpy()] = True
    return np.packbits(out)


def _worth(hashed: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return bits[(hashed & np.uint64(len(bits) - 1)).astype(np.int64)]


def document_counts(df: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """term, n_docs: in how many rows a term of the filter stands."""
    shared = df.sparkSession.sparkContext.broadcast(_filter(terms))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(terms: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], names=["term", "n"])

        bits = np.unpackbits(shared.value).astype(bool)
        held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in (part for whole in batches for part in slices(whole, text)):
            seen = []
            for t in batch.column(0):
                hashed = term_hashes(normal(t.as_py() or ""))
                seen.append(np.unique(hashed[_worth(hashed, bits)]))
            each, n = np.unique(np.concatenate(seen) if seen else np.zeros(0, np.uint64), return_counts=True)
            held, where = np.unique(np.concatenate((held, each)), return_inverse=True)
            counts = np.bincount(where, weights=np.concatenate((counts, n)), minlength=len(held)).astype(np.int64)
            if len(held) >= HELD:
                yield rows(held, counts)
                held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield rows(held, counts)

    return df.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_docs"))


def term_places(df: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """t1, t2, term, start, end of every term of the filter, once for equal texts of a batch."""
    shared = df.sparkSession.sparkContext.broadcast(_filter(terms))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits = np.unpackbits(shared.value).astype(bool)
        for batch in (part for whole in batches for part in slices(whole, text)):
            done, rows = set(), []
            for t in batch.column(0):
                body = t.as_py() or ""
                hashed = term_hashes(normal(body))
                hit = np.flatnonzero(_worth(hashed, bits))
                mark = hashlib.blake2b(body.encode("utf-8", "replace"), digest_size=16).digest() if len(hit) else b""
                if not len(hit) or mark in done:
                    continue
                done.add(mark)
                t1, t2 = np.frombuffer(mark, dtype=np.int64).tolist()
                words = [(m.start(), m.end()) for m in _WORD.finditer(body)]
                signed = hashed.view(np.int64)
                rows += [(t1, t2, int(signed[k]), *words[k]) for k in hit.tolist()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            types = [pa.int64()] * 3 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types, strict=True)], names=["t1", "t2", "term", "start", "end"])

    return df.select(text).mapInArrow(run, "t1 long, t2 long, term long, start int, end int")


def revealing(found: DataFrame, df: DataFrame, text: str) -> DataFrame:
    """term, kind (its number in KINDS) for the terms that pass the thresholds; ``found`` is from ``entities``."""
    near = found.filter(F.size("entities") > 0)
    pairs = near.select("t1", F.explode(F.arrays_zip("entities", "terms")).alias("p")).select("t1", "p.entities", "p.terms")
    by_text = pairs.groupBy("entities", "terms", "t1").agg(F.count("*").alias("n"))
    together = by_text.groupBy(F.col("entities").alias("entity"), F.col("terms").alias("term")).agg(F.count("*").alias("texts"), F.sum("n").alias("n_both"))
    # the lower end for a share of one: what more texts without the entity could only bring down
    together = stored(together.filter(F.col("texts") / (F.col("texts") + F.lit(Z**2)) + 1e-9 >= GENERALISE), "pii-pairs")
    held = near.select(F.explode(F.array_distinct("entities")).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    n_docs = document_counts(df, together, text)
    joined = together.join(n_docs, "term").join(held, "entity")
    share = F.col("n_both") / F.col("n_docs")
    # copies of a text are no evidence of their own: as many texts as the share says that the term has
    seen = F.col("texts") / share
    low = (share + Z**2 / (2 * seen) - Z * F.sqrt(share * (1 - share) / seen + Z**2 / (4 * seen * seen))) / (1 + Z**2 / seen)
    bits = F.log2(share / (F.col("n_entity") / F.lit(float(max(found.count(), 1)))))
    passed = joined.withColumns({"low": low + 1e-9, "bits": bits}).filter((F.col("low") >= GENERALISE) & (F.col("bits") >= BITS))
    return passed.groupBy("term").agg(F.max(F.when(F.col("low") >= REMOVE, len(BASE) + 1).otherwise(len(BASE))).alias("kind"))


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base (spans of the patterns) and added (spans of revealing terms): one row a row of ``df``; t1 and t2 name the text."""
    found = stored(entities(df, key, text), "pii-entities")
    terms = stored(revealing(found, df, text), "pii-terms")
    places = term_places(df, terms, text).join(terms, "term")
    added = places.groupBy("t1", "t2").agg(F.array_sort(F.collect_set(F.struct("kind", "start", "end"))).alias("added"))
    out = found.select("doc_id", "t1", "t2", F.col("spans").alias("base")).join(added, ["t1", "t2"], "left")
    return out.select("doc_id", "t1", "t2", "base", F.coalesce("added", F.array().cast(_FOUND)).alias("added"))


def rewritten(text: Column, spans: Column) -> Column:
    """The text with its spans, in order of start, replaced: entities by their kind, generalised terms by what sort of word they
    are, removed ones by nothing. A span inside an earlier one is covered by it."""

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        word = F.substring(text, x["start"] + 1, x["end"] - x["start"])
        sort = F.when(word.rlike(r"^[0-9]+$"), "<number>").when(word.rlike("[0-9]"), "<code>").when(word.rlike(r"^\p{Lu}"), "<name>").otherwise("<word>")
        mark = F.element_at(F.array(*(F.lit(f"<{k}>") for k in BASE), sort, F.lit("")), x["kind"] + 1)
        gap = F.substring(text, acc["at"] + 1, F.greatest(x["start"], acc["at"]) - acc["at"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], gap, mark)).otherwise(acc["out"]).alias("out"))

    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("long"), x["end"].alias("end"), x["kind"].alias("kind"))))
    done = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return F.when(F.size(spans) > 0, F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))).otherwise(text)


def sanitised(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and its text without personal data and the terms that give it away: one row a row of ``df``."""
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn("mark", F.sha2(F.coalesce("text", F.lit("")), 256))
    spans = find(rows, "mark", "text").select(F.col("doc_id").alias("mark"), F.concat("base", "added").alias("spans")).filter(F.size("spans") > 0)
    found = rows.join(spans.groupBy("mark").agg(F.any_value("spans").alias("spans")), "mark", "left")  # equal texts have equal spans
    return found.select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(rewritten(F.col("text"), F.col("spans"))).alias("text"))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"size(filter(base, x -> x.kind = {i}))").cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_joined(F.array_sort("base")), 256).alias("base_sha256"), _joined(F.array_sort(F.concat("base", "added"))).alias("spans"))


QUERIES = {"op6_pii": op6_pii}
SQL: dict[str, str] = {}
