"""Near-duplicate documents by Order MinHash, candidates verified by banded alignment.

A document is its run of words: lower-cased, ASCII characters other than letters and digits separating. Its k-mers are the
runs of five words, each labelled with its occurrence number. Each of ``BANDS`` hash functions samples the ``SAMPLED``
k-mers of least hash and keeps their order in the text: two documents fall into one bucket where they agree on both, which
follows edit similarity. With a share p of the words replaced at random s = (1 - p) ** 5 of the k-mers stand and a band
agrees with chance (s / (2 - s)) ** 2; of 16 bands one does with chance 0.95 at 10 %, 0.74 at 15 % and 0.47 at 20 %.
In a bucket every document is compared with the first one. Then, in each bucket that still holds several classes, every
two documents of different classes are compared whose lengths allow a link. A bucket is cut by
length into cells, and a large cell into blocks that meet two by two.

A pair is a link if, aligned word by word inside a band as wide as the allowed edits, at least 0.8 of the longer one stands
unedited. What spares an alignment loses nothing: a word that one of the two lacks costs an edit.

Documents of the same words are copies, collapsed before anything is compared, so a group of copies costs one comparison.
Documents are classes of links: ``class_id`` is the smallest doc_id of the class, and that document is kept.

A null text is an empty one. Texts without words are copies only of the same text. Texts of one to four words have one
k-mer of all their words. Texts are compared as such, so rows of one doc_id may be of different classes; of several texts
of a class's smallest doc_id the one of least hash is kept, and rows that repeat it are. A class without any doc_id has a
null class_id and keeps the rows of one text. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemetrics.llm.common import slices, stored, table, text_or_empty
from placemetrics.llm.components import components

K, SAMPLED, BANDS, SIMILARITY = 5, 2, 16, 0.8
#: Documents, and words of them, in a block of a cell that still holds several classes; k-mers counted at a time there.
ROWS, VOLUME, COLUMNS = 512, 1 << 19, 4096
#: Parts that a class is dealt in.
SALTS = 32
#: Documents of a link are in the same or in neighbouring steps of length.
STEP = float(np.log(1 / SIMILARITY)) + 1e-6
#: Cells of the table of mismatches that an alignment may use; beyond it, one row is held at a time.
CELLS = 4_000_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SEEDS = np.random.default_rng(11).integers(1, 2**63, size=BANDS, dtype=np.uint64)
_SEPARATE = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, as far as texts have needed them."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 1 << 17)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                factors = np.full(n, base, dtype=np.uint64)
                factors[0] = 1
                setattr(cls, name, np.multiply.accumulate(factors))
        return cls.up, cls.down


def normal(text: str) -> bytes:
    """The words of a text, one space between them."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_SEPARATE).split())


def word_hashes(words: bytes) -> np.ndarray:
    """One 32-bit hash for each word."""
    if not words:
        return np.zeros(0, dtype=np.uint32)
    b = np.frombuffer(words, dtype=np.uint8)
    up, down = _Powers.to(len(b))
    space = b == 32
    starts = np.concatenate(([0], np.flatnonzero(space) + 1))
    value = (b.astype(np.uint64) + _U(1)) * up[: len(b)]
    value[space] = 0
    return (_mix(np.add.reduceat(value, starts) * down[starts]) >> _U(32)).astype(np.uint32)


def kmers(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of K words; of all words if there are fewer."""
    w = words.astype(np.uint64) + _U(1)
    n = min(K, len(w))
    if not n:
        return w
    h = np.zeros(len(w) - n + 1, dtype=np.uint64)
    for j in range(n):
        h = h * _U(0x100000001B3) + w[j : j + len(h)]
    return _mix(h)


def _occurrences(h: np.ndarray) -> np.ndarray:
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    out = np.empty(len(h), dtype=np.int64)
    out[order] = np.arange(len(s)) - first
    return out


def sketch(h: np.ndarray) -> np.ndarray:
    """For each band one number that stands for the sampled k-mers in text order."""
    labelled = _mix(h + _occurrences(h).astype(np.uint64) * _U(_BASE))
    out, some = _SEEDS.copy(), max(1, min(BANDS, CELLS // len(h)))
    for start in range(0, BANDS, some):  # all bands at once but for very long texts
        v = (labelled[None, :] ^ _SEEDS[start : start + some, None]) * _U(0xD6E8FEB86659FD93)
        v ^= v >> _U(32)
        rows, at = np.arange(len(v)), []
        for _ in range(min(SAMPLED, len(h))):
            least = v.argmin(axis=1)
            v[rows, least] = np.iinfo(np.uint64).max
            at.append(least)
        for p in np.sort(np.stack(at), axis=0):
            out[start : start + some] = _mix(out[start : start + some] * _U(31) + labelled[p])
    return out.view(np.int64)


def _labelled(words: np.ndarray) -> np.ndarray:
    """Word hashes with their occurrence numbers: texts share as many words as these have in common."""
    w = words.astype(np.uint64)
    return _mix(w + _occurrences(w).astype(np.uint64) * _U(_BASE)) if len(w) else w


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    start = int(differ[0]) if len(differ) else n
    a, b = a[start:], b[start:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    end = int(differ[0]) if len(differ) else n
    return a[: len(a) - end], b[: len(b) - end]


def _furthest(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """Edits between a and b if there are ``band`` at most: how far each diagonal gets with 0, 1, 2 ... edits."""
    n, width = len(a), 2 * band + 1
    padded = np.full(n + width, -1, dtype=np.int64)
    stop = min(len(b), n + band + 1)
    padded[band : band + stop] = b[:stop]
    differ = np.lib.stride_tricks.sliding_window_view(padded, n)[:width] != a
    next_ = np.full((width, n + 1), n, dtype=np.int64)
    next_[:, :n] = np.minimum.accumulate(np.where(differ, np.arange(n), n)[:, ::-1], axis=1)[:, ::-1]
    end, rows, low = len(b) - n + band, np.arange(width), np.full(1, -(1 << 40))
    far = np.full(width, -(1 << 40))
    far[band] = next_[band, 0]
    for edits in range(band + 1):
        if far[end] >= n:
            return edits
        step = np.maximum(far + 1, np.maximum(np.concatenate((low, far[:-1])), np.concatenate((far[1:] + 1, low))))
        live = step >= 0
        at = np.minimum(np.where(live, step, 0), n)
        far = np.where(live, next_[rows, at], -(1 << 40))
    return None


def _by_rows(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """As ``_furthest``, in memory of the band alone."""
    width, far = 2 * band + 1, len(a) + len(b) + 1
    k = np.arange(width)
    padded = np.full(len(a) + len(b) + 2 * width, -1, dtype=np.int64)
    padded[band : band + len(b)] = b
    row = np.where(k >= band, k - band, far)
    for i, word in enumerate(a):
        match = row + (padded[i : i + width] != word)
        row = np.minimum(match, np.concatenate((row[1:] + 1, [far])))
        row[k + i + 1 < band] = far
        row = np.minimum.accumulate(row - k) + k
    found = int(row[len(b) - len(a) + band])
    return found if found <= band else None


def edits_within(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    """Whether ``limit`` or fewer words changed, put in or taken out turn a into b."""
    if abs(len(a) - len(b)) > limit:
        return False
    a, b = _trimmed(a.astype(np.int64), b.astype(np.int64))
    if not len(a) or not len(b):
        return max(len(a), len(b)) <= limit
    band = max(4, abs(len(a) - len(b)))
    while True:
        band = min(band, limit)
        if abs(len(a) - len(b)) <= band:
            found = (_furthest if (2 * band + 1) * len(a) <= CELLS else _by_rows)(a, b, band)
            if found is not None:
                return True
        if band == limit:
            return False
        band *= 4


def _edits(n: int) -> int:
    """How many words of the longer of two near copies may be edited."""
    return int((1 - SIMILARITY) * n + 1e-9)


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    n = max(len(a), len(b))
    limit = _edits(n)
    if n - min(len(a), len(b)) > limit:
        return False
    # every word that the shorter one lacks takes an edit
    if n - len(np.intersect1d(_labelled(a), _labelled(b), assume_unique=True)) > limit:
        return False
    return edits_within(a, b, limit)


def sketches(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, content (a hash of the text), two numbers that stand for the text's words, and its bands (null for a text without words)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole, "__text")):
            marks, bands = [], []
            for t in batch.column("__text"):
                raw = t.as_py() or ""
                words = normal(raw)
                marks.append(hashlib.blake2b(words or b" " + raw.encode("utf-8", "replace"), digest_size=16).digest())
                bands.append(sketch(kmers(word_hashes(words))) if words else None)
            two = np.frombuffer(b"".join(marks), dtype=np.int64).reshape(-1, 2)
            made = [pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("content"), *made], names=["doc_id", "content", "m1", "m2", "bands"])

    rows = df.select(F.col(key).cast("long").alias("doc_id"), content(text).alias("content"), F.col(text).alias("__text"))
    return rows.mapInArrow(run, "doc_id long, content long, m1 long, m2 long, bands array<long>")


def content(text: str = "text") -> Column:
    """A hash of the whole text; null counts as empty."""
    return F.xxhash64(text_or_empty(text))


def _words_of(docs: DataFrame) -> DataFrame:
    """rep and the 32-bit hashes of its words."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole, "text")):
            packed = [word_hashes(normal(t.as_py() or "")).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(packed, pa.binary())], names=["rep", "words"])

    return docs.select("rep", "text").mapInArrow(run, "rep long, words binary")


def _verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Links among pairs (a, b). Sort-merge at every size: the words follow the data, and a broadcast of them would not hold."""
    both = pairs.join(words.select(F.col("rep").alias("a"), F.col("words").alias("x")).hint("merge"), "a")
    both = both.join(words.select(F.col("rep").alias("b"), F.col("words").alias("y")).hint("merge"), "b")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = [_linked(np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "dedup-links")


def _stars(members: DataFrame, on: list[str]) -> DataFrame:
    """Members of buckets of two and more, each with its bucket's smallest member as center."""
    centers = members.groupBy(*on).agg(F.min("rep").alias("center"), F.count("*").alias("held")).filter(F.col("held") > 1).drop("held")
    return members.join(centers, on)


def _pairs(stars: DataFrame) -> DataFrame:
    return stars.filter("rep <> center").groupBy(F.col("center").alias("a"), F.col("rep").alias("b")).agg(F.lit(1).alias("one")).select("a", "b")


def _shared(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many labelled words each of one shares with each of two."""
    flat = np.concatenate([*one, *two])
    doc = np.repeat(np.arange(len(one) + len(two)), [len(x) for x in (*one, *two)])
    _, column, held = np.unique(flat, return_inverse=True, return_counts=True)
    common = held > 1
    column, doc = (np.cumsum(common) - 1)[column[common[column]]], doc[common[column]]
    order = np.argsort(column, kind="stable")
    column, doc = column[order], doc[order]
    both = np.zeros((len(one), len(two)), dtype=np.float64)
    for start in range(0, int(common.sum()), COLUMNS):
        low, high = np.searchsorted(column, (start, start + COLUMNS))
        m = np.zeros((len(one) + len(two), COLUMNS), dtype=np.float32)
        m[doc[low:high], column[low:high] - start] = 1
        both += m[: len(one)] @ m[len(one) :].T
    return both


def _compare(key: tuple, t):
    """Links that unite classes in one cell, or in two blocks of it. A pair counts in the first band on which it agrees."""
    import pyarrow as pa

    band, _, cell, first_block, second_block = (x.as_py() for x in key)
    ids, own, level, block = (t[c].to_numpy() for c in ("rep", "own", "level", "block"))
    found: list[tuple[int, int]] = []
    x, y = np.flatnonzero(block == first_block), np.flatnonzero(block == second_block)
    if len(x) and len(y) and len(np.unique(own)) > 1:
        words = [np.frombuffer(w.as_buffer(), np.uint32) for w in t["words"]]
        labelled = [_labelled(w) for w in words]
        n = np.array([len(w) for w in words])
        longer = np.maximum(n[x, None], n[y])
        lacking = longer - _shared([labelled[i] for i in x], [labelled[j] for j in y])
        use = (lacking <= (1 - SIMILARITY) * longer + 1e-9) & (own[x, None] != own[y]) & ((level[x, None] == cell) | (level[y] == cell))
        if first_block == second_block:
            use &= x[:, None] < y
        i, j = np.nonzero(use)
        i, j = x[i], y[j]
        if band and len(i):
            bands = np.array(t["bands"].to_pylist(), dtype=np.int64)[:, :band]
            new = np.concatenate([~(bands[i[k : k + 65536]] == bands[j[k : k + 65536]]).any(axis=1) for k in range(0, len(i), 65536)])
            i, j = i[new], j[new]
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                root[c] = root.get(root[c], root[c])
                c = root[c]
            return c

        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            c, d = find(int(own[a])), find(int(own[b]))
            if c != d and _linked(words[a], words[b]):
                root[max(c, d)] = min(c, d)
                found.append((int(ids[a]), int(ids[b])))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _across(stars: DataFrame, united: DataFrame, words: DataFrame) -> DataFrame:
    """Links between different classes within buckets: all pairs that share a bucket and may be links by length."""
    sizes = words.select("rep", F.expr("greatest(1, cast(length(words) div 4 as int))").alias("n"))
    named = sizes.join(united.select(F.col("node").alias("rep"), "component"), "rep", "left").select("rep", "n", F.coalesce("component", "rep").alias("own"))
    named = named.withColumn("level", F.floor(F.log("n") / F.lit(STEP)).cast("int"))
    cells = stars.select("rep", "band", "bucket").join(named, "rep").withColumn("cell", F.explode(F.array(F.col("level"), F.col("level") + 1)))
    on = ["band", "bucket", "cell"]
    mixed = cells.groupBy(*on).agg(F.min("own").alias("low"), F.max("own").alias("high"), F.max("level").alias("top"), F.count("*").alias("held"), F.sum("n").alias("volume"))
    blocks = F.greatest(F.expr(f"(held + {ROWS - 1}) div {ROWS}"), F.expr(f"(volume + {VOLUME - 1}) div {VOLUME}")).cast("int")
    mixed = mixed.filter("low <> high and top = cell").select(*on, blocks.alias("blocks"))
    met = cells.join(mixed, on).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = stored(met.select(*on, "rep", "own", "level", "block", "blocks"), "dedup-mixed")
    met = met.join(words.hint("merge"), "rep").withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    # two blocks meet in one group; a block meets itself in a group of its own
    met = met.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    met = met.select(*on, "first", "second", "rep", "own", "level", "block", "bands", "words")
    return stored(met.groupBy(*on, "first", "second").applyInArrow(lambda k, t: _compare(k, t), "a long, b long"), "dedup-links")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id, kept, content (a hash of the text): one row a row of ``df``."""
    marked = stored(sketches(df, key, text), "dedup-sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")).alias("first")
    reps = marked.groupBy("m1", "m2").agg(first, F.any_value("bands").alias("bands"))
    # a number for each text that holds once the table is written: an id may stand for several texts, or for none
    reps = stored(reps.withColumn("rep", F.monotonically_increasing_id()), "dedup-reps")
    bands = reps.filter("bands is not null").select("rep", "bands", F.posexplode("bands").alias("band", "bucket"))
    stars = stored(_stars(bands.select("rep", "band", "bucket"), ["band", "bucket"]), "dedup-buckets")
    pairs = stored(_pairs(stars), "dedup-pairs")
    ids = stars.groupBy("rep").agg(F.lit(1).alias("one")).select("rep")
    ids = reps.join(ids, "rep").select("rep", F.col("first.doc_id").alias("id"), F.col("first.content").alias("mark"))
    docs = df.select(F.col(key).cast("long").alias("doc_id"), content(text).alias("content"), F.col(text).alias("text"))
    same = (F.col("content") == F.col("mark")) & F.col("doc_id").eqNullSafe(F.col("id"))
    words = _words_of(docs.join(ids.hint("merge"), same)).groupBy("rep").agg(F.max("words").alias("words"))  # one row for repeated rows
    words = stored(words.join(reps.select("rep", "bands"), "rep"), "dedup-words")
    links = _verified(pairs, words)

    united = stored(components(links), "dedup-classes")
    more = _across(stars, united, words)
    if not more.isEmpty():
        united = stored(components(links.unionByName(more)), "dedup-classes")
    per = reps.select("m1", "m2", "rep", "first").join(united.withColumnRenamed("node", "rep"), "rep", "left")
    # the leader of a class goes to its members in SALTS parts, so that a large class is dealt over as many tasks
    salt = F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")
    per = per.select("m1", "m2", "first", F.col("component").isNotNull().alias("linked"), F.coalesce("component", "rep").alias("component"), salt.alias("salt"))
    leaders = per.filter("linked").groupBy("component").agg(F.min("first").alias("leader"))
    leaders = leaders.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    per = per.join(leaders, ["component", "salt"], "left").select("m1", "m2", F.coalesce("leader", "first").alias("leader"))
    per = stored(per, "dedup-leaders")
    out = marked.select("doc_id", "content", "m1", "m2").join(per, ["m1", "m2"])
    kept = F.col("doc_id").eqNullSafe(F.col("leader.doc_id")) & (F.col("content") == F.col("leader.content"))
    return out.select("doc_id", F.col("leader.doc_id").alias("class_id"), kept.alias("kept"), "content")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


QUERIES = {"op5_near_dedup": op5_near_dedup}
SQL: dict[str, str] = {}
