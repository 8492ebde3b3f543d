"""Lexical search, importance resampling and token counts against plain readings of their definitions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from placemetrics.llm import importance, lexical_search, token_counts
from tests.test_queries import TABLES, plain

LOWER = str.maketrans(lexical_search.UPPER, lexical_search.LOWER)


@pytest.fixture(scope="module")
def file():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def tokens(file):
    return token_counts.Tokens(file)


@pytest.fixture(scope="module")
def library(file):
    return Tokenizer.from_str(file.decode())


@pytest.mark.parametrize("module", [lexical_search, importance])
def test_sql(spark, small, module):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{small}/{t}.parquet'")
    for name, query in module.QUERIES.items():
        got, want = query(spark, small).toPandas(), con.sql(module.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and len(got)
        assert plain(got) == plain(want)


# lexical search


def ranked(docs, items, k=10):
    """Every score by the definition, with whole numbers."""
    words = lambda t: re.findall(lexical_search.TERM, (t or "").translate(LOWER))
    read = [(i, Counter(words(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in read), sum(c.total() for _, c in read)
    df = Counter(w for _, c in read for w in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in asked.items():
        best = []
        for i, c in read:
            m = 10 + 90 * c.total() * n // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in terms if c[w])
            if score > 0:
                best.append((-score, i is None, i or 0, i))
        out += [(item, r, b[3], -b[0]) for r, b in enumerate(sorted(best, key=lambda b: b[:3])[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "The same WORDS, again"), (2, "nothing-here ǅ ÉCOLE"), (3, None), (None, "text of ten"), (4, "日本語 a1 é"), (1, "more of item one: lorem"), (5, "...")]


def test_lexical_search_on_odd_rows(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({"term": F.lit(1), "block": F.lit(2), "rank": F.lit(3), "items": F.lit("x"), "doc_id": F.lit(9)})
    got = [tuple(r) for r in lexical_search.search(odd, items).collect()]
    assert sorted(got, key=repr) == ranked([(r.doc_id, r.text) for r in odd.collect()], ITEMS)
    assert not lexical_search.search(none, items).collect() and not lexical_search.search(odd, items.limit(0)).collect()


def test_lexical_search_in_blocks_and_with_ties(spark, monkeypatch):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("ab b c d é-f g,h") for _ in range(rng.randint(0, 30)))) for i in range(150)] + [(1000 + i, "a c d") for i in range(60)]
    items = [(i, " ".join(rng.sample(["a", "b", "c", "d", "é", "f", "g", "h", "zz"], 4))) for i in range(30)]
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 40)
    monkeypatch.setattr(lexical_search, "CELLS", 64)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in lexical_search.search(frame, spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert sorted(got, key=repr) == ranked(docs, items)


def test_automaton_finds_whole_terms_only():
    a = lexical_search.Automaton(["he", "she", "hers", "é"], [[0], [0, 1], [1], [1]])
    doc, term, times, sizes = a.scan(["She he-HE hershe hers\nsheshe", None, "", "É é éé"])
    assert list(zip(doc.tolist(), term.tolist(), times.tolist(), strict=True)) == [(0, 0, 2), (0, 1, 1), (0, 2, 1), (3, 3, 1)]
    assert sizes.tolist() == [6, 0, 0, 3]


# importance resampling


def runs(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abAÉé日 \n.1_", max_size=30)), max_size=8))
def test_features_are_the_runs(texts):
    words, place, number, buckets = importance.features(pa.array(texts, pa.string()))
    assert words.tolist() == [runs(t)[0] for t in texts]
    got = Counter(zip(place.tolist(), buckets[number].tolist() if len(place) else [], strict=True))
    assert got == Counter((k, zlib.crc32(f.encode()) % importance.BUCKETS) for k, t in enumerate(texts) for f in runs(t)[1])


def test_features_of_a_slice_of_a_larger_array():
    texts = pa.array(["one two", None, "three four five", "", "six"], pa.string())
    whole, part = importance.features(texts.slice(1, 3)), importance.features(pa.array([None, "three four five", ""], pa.string()))
    assert all(np.array_equal(a, b) for a, b in zip(whole, part, strict=True))


def test_crcs_of_every_length():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    starts, sizes = rng.integers(0, 4000, 700), rng.integers(0, 90, 700)
    assert importance.crcs(data, starts, sizes).tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, sizes, strict=True)]


def drawn(docs, target, percent=5, least=20):
    s, t = (Counter(zlib.crc32(f.encode()) % 10000 for x in side for f in runs(x)[1]) for side in ([x for _, x in docs], target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000))))
    out = []
    for i, x in docs:
        n, fs = runs(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(zlib.crc32(f.encode()) % 10000) for f in fs)
        out.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    taken = able[: len(able) * percent // 100]
    return Counter((*r[:4], k) for k, r in enumerate(taken, 1)) + Counter((*r[:4], None) for r in able[len(taken) :] + [r for r in out if r[4] < least])


def test_resampling_on_odd_rows(spark, odd, none):
    target = spark.createDataFrame([("Lorem ipsum of ten",), (None,), ("",)], "text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    got = importance.resample(odd, target, percent=50, least=3)
    assert Counter(tuple(r) for r in got.collect()) == drawn(docs, ["Lorem ipsum of ten"], 50, 3)
    assert not importance.resample(none, target).collect()
    assert Counter(tuple(r) for r in importance.resample(odd, target.limit(0), percent=50, least=3).collect()) == drawn(docs, [], 50, 3)


def test_resampling_of_many_ties(spark):
    docs = [(k, "one two three four") for k in range(400)] + [(9, f"{k} one two three") for k in range(300)]
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame([("one two",)], "text string"), percent=60, least=2)
    want = drawn(docs, ["one two"], 60, 2)
    rows = [tuple(r) for r in got.collect()]
    assert Counter(r[:4] for r in rows) == Counter(r[:4] for r in want.elements())
    assert sorted(r[4] for r in rows if r[4]) == list(range(1, 421))
    assert {(r[3], r[4]) for r in rows if r[4]} == {(r[3], r[4]) for r in want if r[4]}


# token counts


def test_counts_equal_the_library_on_whole_documents(spark, file, library):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    own = token_counts.Tokens(file)
    assert own.counts(texts).tolist() == [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


ALPHABET = "'rveltsmdainohb1!ÉΣσ́İſ日 \n.<|>-_²٣ \u0085Ⅷ"


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(alphabet=ALPHABET, max_size=60), st.text(max_size=30), st.text(alphabet="aeinrtsohl", max_size=60)))
def test_counts_of_any_text(tokens, library, text):
    assert tokens.counts([text]).tolist() == [len(library.encode(text, add_special_tokens=False).ids)]


SPECIAL = ["<|endoftext|>", "a<|startoftext|>b", "'<|endoftext|>s", "<|endoftext|><|endoftext|> x", "<|endoftext", "it's we'll I'd they've you're 'tis ''s '' ' 'r 'v 'l", "é <|endoftext|>́"]


def test_special_tokens_and_contractions(tokens, library):
    assert tokens.counts(SPECIAL).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in SPECIAL]


def test_every_code_point_of_the_basic_plane(tokens, library):
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(1, 0x10000, 7) if not 0xD800 <= c < 0xE000]
    assert tokens.counts(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_token_of_the_vocabulary_and_pairs(tokens, library):
    rng = random.Random(5)
    vocabulary = [t.replace("</w>", "") for t in library.get_vocab()]
    letters = {c: bytes([b]) for b, c in enumerate(token_counts._byte_letters())}
    spelt = [b"".join(letters.get(c, b"") for c in t).decode(errors="replace") for t in vocabulary]
    texts = [a + rng.choice(spelt) for a in rng.sample(spelt, 12000)]
    assert tokens.counts(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 96])
def test_state_maps_compose_at_any_chunk(tokens, chunk):
    rng = random.Random(chunk)
    classes = np.array([rng.randrange(10) for _ in range(2000)] + [token_counts.SPACE], dtype=np.uint8)
    state, first = 0, np.zeros(len(classes), dtype=bool)
    for k, c in enumerate(classes):
        mark = tokens.emits[state, c]
        first[k] |= bool(mark & token_counts.BEGINS)
        if mark & token_counts.BEGAN:
            first[k - 1] = True
        state = tokens.to[state, c]
    assert np.array_equal(token_counts.begins(classes, tokens.to, tokens.emits, chunk), first)


def test_a_small_table_begins_anew(file, library, monkeypatch):
    monkeypatch.setattr(token_counts, "CELLS", 3000)
    monkeypatch.setattr(token_counts, "GROUP", 64)
    monkeypatch.setattr(token_counts, "SLICE", 300)
    texts = ["the quick brown foxes jumped overlong and unthinkingly " * 9, "x" * 700 + " y", "", None]
    assert token_counts.Tokens(file).counts(texts).tolist() == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_counts_on_odd_rows(spark, odd, none, file, library):
    got = token_counts.count_tokens(odd, ["doc_id", "ids", "size"], file).collect()
    want = [(r.doc_id, 13 + 1, 1, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect()]
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got) and any(r.over_limit for r in got)
    assert not token_counts.count_tokens(none, ["doc_id"], file).collect()


def test_other_files_are_refused(file):
    with pytest.raises(ValueError):
        token_counts.Tokens(file.replace(b'"Lowercase"', b'"NFC"'))


def test_normal_forms_are_stable(tokens):
    assert tokens.normal("ΟΔΟΣ") == "οδοσ" and tokens.normal("É") == unicodedata.normalize("NFC", "é")
