"""BPE, toxicity, language, personal data and secrets against brute force, public libraries and held-out rows."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers as tokenizers
import pytest
from pyspark.sql import functions as F

from placemetrics.llm import bpe, language_id, pii, secret_scan, toxicity
from placemetrics.llm.common import fold, table


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ranks():
    return bpe.rank_file(tokenizers.path("byte_bpe_50k.tiktoken"))


def test_bpe_equals_the_library_on_whole_documents(spark, small, library):
    texts = {r.doc_id: r.text or "" for r in table(spark, small, "documents").collect()}
    got = bpe.op1_bpe(spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_round_trip_of_odd_rows(spark, odd, none, library):
    texts = sorted((r.doc_id or -1, r.text or "") for r in odd.select("doc_id", "text").collect())
    got = bpe.transcode(odd, ["doc_id", "n_chars"], ranks(), tokenizers.PATTERN, decode=True).collect()
    assert sorted((r.doc_id or -1, bytes(r.decoded).decode()) for r in got) == texts
    for r in got:
        ids = library.encode_ordinary(bytes(r.decoded).decode())
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids)
    assert bpe.transcode(none, ["doc_id"], ranks(), tokenizers.PATTERN, decode=True).count() == 0


def test_bpe_long_pieces_and_decoding_alone(spark, library):
    rng = random.Random(3)
    texts = ["a" * 3000, "ab" * 700, "".join(rng.choice("abcdef") for _ in range(400)), "日本語" * 200, "=-" * 400, " " * 500 + "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = bpe.transcode(df, ["doc_id"], ranks(), tokenizers.PATTERN)
    for r in coded.collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids)
    back = bpe.transcode(coded, ["doc_id"], ranks(), tokenizers.PATTERN, source="ids", encode=False, decode=True)
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == dict(enumerate(texts))


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("you 1d10t and m0r0n", "you idiot and moron"), ("p@th3tic", "pathetic"), ("i d i o t here", "idiot here"), ("stuuuupid", "stupid"), ("plain words", "plain words"), ("", "")],
)
def test_deobfuscation(spark, given, wanted):
    docs = spark.createDataFrame([("an idiot and a moron is stupid and pathetic , in plain words " * 20,)], "text string")
    assert toxicity.Restorer(toxicity.letter_model(toxicity.letter_counts(docs)))(given) == wanted


def test_toxicity_on_held_out_and_disguised_rows(spark):
    rng = random.Random(1)
    words = ["alpha", "river", "stone", "window", "garden", "paper", "silver", "forest", "market", "music", "letter", "summer"]
    given = []
    for i in range(900):
        text = " ".join(rng.choice(words) for _ in range(40))
        given.append((i, f"{text} such a worthless idiot" if i % 3 == 0 else text, int(i % 3 == 0)))
    df = spark.createDataFrame(given, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.filter(fold("doc_id", 5) != 0).select("doc_id", "toxic"))
    held = toxicity.score(df.filter(fold("doc_id", 5) == 0), model, ["toxic"]).collect()
    assert all((r.score >= 0.5) == bool(r.toxic) for r in held)
    new = spark.createDataFrame([(1, "garden music w0rthl3ss summer"), (2, "garden music 1d10t"), (3, "garden music summer"), (4, None), (5, "")], "doc_id long, text string")
    assert {r.doc_id: r.score >= 0.5 for r in toxicity.score(new, model, ["doc_id"]).collect()} == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_toxicity_of_odd_rows_and_without_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int")
    scored = toxicity.score(odd, toxicity.fit(odd, labels), ["doc_id"]).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    empty = toxicity.fit(none, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, empty, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(none, empty, ["doc_id"], restored=True).count() == 0


def test_language_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = language_id.op7_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 300 and right > 0.97
    assert got.filter("rejected").count() < 0.02 * n


def test_language_of_odd_rows(spark, odd, none):
    model = language_id.fit(odd)
    got = language_id.identify(odd, model, ["doc_id", "text", "lang"]).collect()
    assert len(got) == odd.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or (r.score == 0 and r.rejected)) and 0 <= r.score <= 1
        assert not letters or r.lang_pred in model.names
    assert language_id.identify(none, language_id.fit(none), ["doc_id"]).count() == 0


PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def personal(text: str) -> list[tuple[int, int, int]]:
    def luhn(d: str) -> bool:
        doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(d[::-1])]
        return sum(n - 9 if n > 9 else n for n in doubled) % 10 == 0

    out = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            fine = (True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else True, 13 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15)[k]
            if fine:
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans_of_personal_data():
    rng = random.Random(2)
    for alphabet, length, n in (("a1.@ -+(b2é%", 30, 20000), ("0123456789 .-+", 60, 10000)):
        for _ in range(n):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(length)))
            assert pii.base_spans(text) == personal(text), text
    assert pii.base_spans("1" * 6000 + ".0.0.1 " + "a" * 100_000 + "0" * 5000 + ".1.1.1") == [(1, 106007, 111013)]


def test_terms_that_give_an_entity_away(spark):
    filler = ["river stone window", "garden paper silver", "forest market music", "letter summer winter"]
    given = [(i, f"{filler[i % 4]} number {i} write to zanzibarson at zan@example.com about {filler[(i + 1) % 4]}") for i in range(4)]
    given += [(i, f"{filler[i % 4]} number {i} write to someone at home about {filler[(i + 2) % 4]}") for i in range(4, 600)]
    given += [(600, "an old note of Zanzibarson without address"), (601, given[0][1])]
    df = spark.createDataFrame(given, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(df).collect()}
    texts = dict(given)
    marked = {i: {texts[i][s.start : s.end] for s in r.added} for i, r in found.items() if r.added}
    assert marked == {**{i: {"zanzibarson"} for i in (0, 1, 2, 3, 601)}, 600: {"Zanzibarson"}}
    assert all([(s.kind, s.start, s.end) for s in found[i].base] == personal(texts[i]) for i in texts)


def giving_away(texts: dict[int, str]) -> dict[int, list[tuple[int, int, int]]]:
    """The spans that the method adds, by counting over all texts in plain Python."""
    word = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")
    together, entities, n_docs, rows = defaultdict(set), defaultdict(set), Counter(), defaultdict(set)
    for i, t in texts.items():
        places, spans = [(m.start(), m.end()) for m in word.finditer(t)], personal(t)
        n_docs.update({t[a:b].lower() for a, b in places})
        free = [all(b <= s or a >= e for _, s, e in spans) for a, b in places]
        for kind, s, e in spans:
            name = (kind, re.sub("[^0-9]", "", t[s:e]) if kind in (2, 3) else t[s:e].lower())
            entities[name].add(i)
            before = [k for k, (_, b) in enumerate(places) if b <= s][-8:]
            after = [k for k, (a, _) in enumerate(places) if a >= e][:8]
            for k in before + after:
                a, b = places[k]
                if free[k] and b - a >= 3:
                    together[name, t[a:b].lower()].add(t)
                    rows[name, t[a:b].lower()].add(i)
    kinds: dict[str, int] = {}
    for (name, term), by in together.items():
        share = len(rows[name, term]) / n_docs[term]
        n = len(by) / share
        z = 1.2816
        low = (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if low + 1e-9 >= 0.5 and math.log2(share / (len(entities[name]) / len(texts))) >= 6:
            kinds[term] = max(kinds.get(term, 0), 5 if low + 1e-9 >= 0.8 else 4)
    return {i: sorted((kinds[t[m.start() : m.end()].lower()], m.start(), m.end()) for m in word.finditer(t) if t[m.start() : m.end()].lower() in kinds) for i, t in texts.items()}


def test_added_spans_equal_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    for k in range(20):
        texts[10_000 + k] = f"meeting {k} of Quarbolix{k % 2} with bo{k % 2}@example.org in room r{k} about tandarel" + (" today" if k % 3 else "")
    got = pii.find(spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")).collect()
    want = giving_away(texts)
    assert {r.doc_id: [(s.kind, s.start, s.end) for s in r.added] for r in got} == want
    kinds = Counter(kind for spans in want.values() for kind, _, _ in spans)
    assert kinds[5] >= 20 and sum(kinds.values()) >= 20


def test_terms_need_more_than_one_text(spark):
    """Planted terms near their entity in 1, 2, 3 and 10 texts, and in 3 texts of which one is a copy; single words are no evidence."""
    words = ["river", "stone", "window", "garden", "paper", "silver", "forest", "market"]
    given, planted = [], {"onceling": 1, "twicerin": 2, "thricebel": 3, "tenfoldar": 10}
    for term, n in planted.items():
        given += [(len(given) + k, f"{words[k % 8]} and {words[(k + 3) % 8]} by {term} at {term[:4]}x@example.com, single{term}{k}") for k in range(n)]
    given += [(100 + k, "a note of copyfell at copy@example.com") for k in range(3)]
    given += [(1000 + k, f"{words[k % 8]} and {words[(k // 8) % 8]} by the {words[(k // 64) % 8]} at a note of number {k}") for k in range(1500)]
    texts = dict(given)
    got = pii.find(spark.createDataFrame(given, "doc_id long, text string")).collect()
    marked = Counter((pii.KINDS[s.kind], texts[r.doc_id][s.start : s.end]) for r in got for s in r.added)
    assert marked == {("generalise", "twicerin"): 2, ("generalise", "thricebel"): 3, ("remove", "tenfoldar"): 10}
    assert {r.doc_id: [(s.kind, s.start, s.end) for s in r.added] for r in got} == giving_away(texts)


def test_sanitised_texts(spark):
    given = [(i, f"note {i} river{i} from Zanzibarson zan@example.com end{i}") for i in range(5)] + [(i, f"some other note from {i}") for i in range(10, 400)] + [(5, "Zanzibarson alone"), (6, None), (7, "call +44 20 7946 0958 now")]
    got = {r.doc_id: r.text for r in pii.sanitised(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert got[0] == "note 0 river0 from <name> <email> end0" and got[5] == "<name> alone" and got[6] is None and got[10] == "some other note from 10"
    assert got[7] == "call <phone> now"


def test_held_out_labels_of_the_test_data(spark):
    folder = "/root/testdata/sf0.1"
    got = toxicity.op2_toxicity(spark, folder).join(table(spark, folder, "labels").filter("toxic is not null").select("doc_id", "toxic"), "doc_id").filter("held_out")
    right = got.groupBy("toxic").agg(F.count("*").alias("n"), F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("share")).collect()
    share = {r.toxic: r.share for r in right}
    # measured 0.999 and 0.876: the rows missed are labelled toxic and hold no toxic word
    assert share[0] >= 0.98 and share[1] >= 0.85, right


def test_personal_data_of_odd_rows(odd, none):
    assert pii.find(odd).count() == odd.count()
    assert pii.find(none).count() == 0


SECRETS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
]


def secrets(text: str) -> list[tuple[int, int, int]]:
    return sorted((m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(SECRETS) for m in p.finditer(text) if len(m[g]) >= n)


def test_base_spans_of_secrets_and_ownership(spark):
    rng = random.Random(4)
    parts = ["password", "Token", "api_key", "=", ": ", '"', "AKIA", "ABCDEFGH1234", "0123456789abcdef", "é", " ", "x", "secret=secret=abcdefghijkl", "."]
    given = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(25))), f"s{i % 3}") for i in range(300)]
    given += [(1000 + i, "copied token = deadbeef00112233aa", f"s{i}") for i in range(4)] + [(2000, "mine: password=Zx81kQ02mmLp7", "s0"), (2001, "seen again Token: Zx81kQ02mmLp7", "s0")]
    df = spark.createDataFrame(given, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secret_scan.scan(df).collect()}
    for i, text, _ in given:
        assert [(h.start, h.kind, h.end) for h in got[i].hits] == secrets(text), text
    assert all(not got[1000 + i].live and got[1000 + i].n_examples == 2 for i in range(4))
    assert [given[-2][1][p.start : p.end] for p in got[2000].live] == ["Zx81kQ02mmLp7"] and got[2001].live


def test_secrets_of_odd_rows(spark, odd, none):
    many = odd.select("doc_id", F.lit("token=abcdefgh1234 " * 1300).alias("text"), "source").limit(2).unionByName(odd.select("doc_id", "text", "source"))
    got = secret_scan.scan(many).collect()
    assert len(got) == odd.count() + 2 and max(len(r.hits) for r in got) == 1300
    assert secret_scan.scan(none).count() == 0
    text = spark.range(1).select(secret_scan.redact(F.lit("ab cd ef"), F.expr("array(struct(0 as start, 2 as end), struct(1 as start, 5 as end))")).alias("t")).first()
    assert text.t == "<secret> ef"
