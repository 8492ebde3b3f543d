"""Mixing, HTML extraction, near-dedup, search, embeddings and the pipeline against brute force."""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from placemetrics.llm import embedding_dedup, html_extract, language_id, mixing, near_dedup, secret_scan, topk_search
from placemetrics.llm.common import stored, table
from placemetrics.llm.components import components


def sql_rows(sql: str, folder: str):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    return con.sql(sql).df()


@pytest.mark.parametrize("module", [mixing, topk_search, embedding_dedup, secret_scan])
def test_queries_equal_their_sql(spark, small, module):
    for name, sql in module.SQL.items():
        got, want = module.QUERIES[name](spark, small).toPandas(), sql_rows(sql, small)
        assert sorted(got.columns) == sorted(want.columns)
        by = sorted(want.columns)
        assert sorted(map(repr, got[by].astype(object).values.tolist())) == sorted(map(repr, want[by].astype(object).values.tolist()))


def test_mix_of_odd_rows(spark, odd, none):
    got = mixing.mix(odd).toPandas()
    assert len(got) == odd.count() and (got.taken <= 3 * got["size"]).all()
    assert (got.taken[got["size"] == 0] == 0).all()
    by = got.groupby("source", dropna=False).agg(s=("source_size", "max"), n=("size", "sum"), t=("target", "max"))
    assert (by.s == by.n).all() and (by.t <= 3 * by.s + 1e-9).all()
    assert math.isclose(by.t.sum(), got["size"].sum())
    again = mixing.mix(odd.repartition(3)).toPandas()
    key = ["doc_id", "source", "size", "taken", "first_slot", "n_slots"]
    assert sorted(map(repr, got[key].values.tolist())) == sorted(map(repr, again[key].values.tolist()))
    assert mixing.mix(none).count() == 0


def test_every_source_is_taken_to_its_target(spark, monkeypatch):
    """Sources of one word to a million, with slots of a large corpus: none misses its target, to the word."""
    monkeypatch.setattr(mixing, "SLOTS", 16)
    given = [(i, "w " * 4000, "large") for i in range(250)] + [(1000 + i, "w " * 30, f"small{i % 20:02}") for i in range(20)] + [(2000, "w", "one"), (2001, "", "none"), (2002, "a b c", None)]
    df = spark.createDataFrame(given, "doc_id long, text string, source string")
    got = mixing.mix(df).toPandas()
    by = got.groupby("source", dropna=False).agg(t=("target", "max"), n=("taken", "sum"), s=("source_size", "max"))
    assert (abs(by.n - by.t) <= 0.5).all() and by.t["one"] == 3 and by.n[by.index.isna()].item() == 9
    assert (got.taken <= 3 * got["size"]).all()
    parts = mixing.blocks(df).filter("slot is not null")
    assert parts.select("slot", "sid").distinct().groupBy("slot").count().filter("count > 1").count() == 0
    per = mixing.targets(df.select("source", mixing.n_words().alias("size"))).select("sid", "slot", "words").toPandas().set_index("sid")
    held = parts.groupBy("sid", "slot").agg(F.sum(F.col("high") - F.col("low")).alias("n")).filter("n > 0").toPandas().sort_values("slot")
    for sid, n in held.groupby("sid")["n"]:  # equal blocks in every source, the last one the remainder
        assert (n.iloc[:-1] == per.slot[sid]).all() and 0 < n.iloc[-1] <= per.slot[sid] and n.sum() == per.words[sid]


def slot_shares(spark, sizes):
    """The schedule's source ids in the order of slots, and each source's share of the words."""
    per = stored(mixing.targets(spark.createDataFrame(sizes, "source string, size long")), "per")
    words = per.select("sid", "words").toPandas().set_index("sid")["words"]
    return mixing.schedule(per).toPandas().sort_values("i")["sid"].to_numpy(), words / words.sum()


def farthest(order, shares, run=1000):
    """By how much a source's share of a run of so many slots differs from its share of the words, at most."""
    off = 0.0
    for sid, share in shares.items():
        sums = np.concatenate(([0], np.cumsum(order == sid)))
        off = max(off, np.abs((sums[run:] - sums[:-run]) / run - share).max())
    return off


def test_every_stretch_of_slots_holds_the_sources_in_their_shares(spark, monkeypatch):
    sizes = [("large", 1_000_000), ("middle", 300_000), ("small", 50_000), ("tiny", 90), (None, 120_000)]
    order, shares = slot_shares(spark, sizes)
    assert len(order) >= 65_536 * 0.99 and farthest(order[: 65_000], shares) < 0.01
    monkeypatch.setattr(mixing, "GOLDEN", 0.0001)
    assert farthest(slot_shares(spark, sizes)[0][:65_000], shares) > 0.2


def test_points_find_their_source_among_many(spark):
    order, shares = slot_shares(spark, [(f"s{i:05}", 1 + i % 7) for i in range(3000)] + [("z", 100_000)])
    ends = np.cumsum(shares.to_numpy())
    at = 0.5 + np.arange(len(order)) * mixing.GOLDEN
    want = np.searchsorted(ends, at - np.floor(at), side="right") + 1
    met = int((order[: len(want)] == want).sum())
    assert len(shares) == 3001 and met >= int(0.9 * len(want))  # those after the last point are for what sources lack


def test_rows_of_one_id_or_none_are_told_apart_without_a_hot_window(spark):
    given = [(None, "a b c d", "x")] * 40 + [(5, f"w{i} " * (i + 1), "x") for i in range(30)] + [(6, "one", "y")]
    got = mixing.mix(spark.createDataFrame(given, "doc_id long, text string, source string").repartition(5)).toPandas()
    assert len(got) == 71 and got.taken.sum() == got["size"].sum() or abs(got.taken.sum() - got["size"].sum()) <= 1
    assert (got[got.doc_id.isna()].taken <= 12).all()


def test_a_value_is_an_example_by_owners_or_by_repositories(spark):
    def text(i, value):
        return f"notes {i} password = {value} end"

    given = [(i, text(i, "aB3dE5gH7jK9"), "one") for i in range(19)]  # one owner, below the spread: live
    given += [(100 + i, text(i, "zY8xW6vU4tS2"), "one") for i in range(20)]  # one owner, twenty repositories: an example
    given += [(200 + i, text(i, "mN5bV4cX3zL2"), f"o{i}") for i in range(3)]  # three owners: an example
    given += [(300 + i, text(0, "qW1eR2tY3uI4"), "one") for i in range(50)]  # copies of one text: one repository, live
    got = {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame(given, "doc_id long, text string, source string")).collect()}
    live = {i for i, r in got.items() if r.live}
    assert live == {*range(19), *range(300, 350)} and all(got[i].n_examples == (i < 300 and i >= 100) for i in got)


PAGE = (
    "<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var x='</p>';</script></head><body><nav><ul><li><a href=/a>Home</a></li>"
    "</ul></nav><!-- <p>hidden</p> --><div class='ad'>Buy {i} now</div><article><h1>Title &amp; more {i}</h1><p><b>First  paragraph,\n with &lt;text&gt; number {i}.<br>"
    "<p>Second &#233; paragraph, long enough to count.</p></article><footer>&copy; foot</footer></body></html>"
)


def test_pages(spark):
    odd = [None, "", "plain text", "<p", "<script>x", "<article><p>a &am", "<div class=content><h2>Head</h2><p>Some text.</p><div class=comments><p>nice</p></div></div>"]
    given = [(i, f"u{i}", PAGE.format(i=i), "t", 1) for i in range(60)] + [(100 + i, None, t, "t", 1) for i, t in enumerate(odd)]
    df = spark.createDataFrame(given, "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: r.text for r in html_extract.extract(df, html_extract.fit(df), ["page_id", "url"]).collect()}
    for i in range(60):
        assert got[i] == f"Title & more {i}\n\nFirst paragraph, with <text> number {i}.\n\nSecond é paragraph, long enough to count."
    assert [got[100 + i] for i in range(6)] == ["", "", "plain text", "", "", "a &am"]
    assert got[106] == "Head\n\nSome text."
    assert html_extract.extract(df.limit(0), html_extract.fit(df.limit(0)), ["page_id"]).count() == 0


def scrambled(source: str, seed: int) -> str:
    """The page with semantic elements turned into divs and every class, id and role into noise."""
    rng = random.Random(seed)
    source = re.sub(r"(?i)<(/?)(article|main|nav|header|footer|aside)\b", r"<\1div", source)
    return re.sub(r"""(?i)\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", lambda m: f'{m[1]}="x{rng.randrange(10**6)}"', source)


def read_article(source: str) -> str:
    """What lies in the page's article, block by block, read with the standard library."""
    blocks, inside = [""], False

    class Reader(HTMLParser):
        def handle_starttag(self, tag, attrs):
            nonlocal inside
            inside |= tag == "article"
            if tag in ("p", "h1", "article"):
                blocks.append("")
            if tag == "br" and inside:
                blocks[-1] += " "

        def handle_endtag(self, tag):
            nonlocal inside
            if tag in ("p", "h1", "article"):
                blocks.append("")
            inside &= tag != "article"

        def handle_data(self, data):
            if inside:
                blocks[-1] += data

    reader = Reader(convert_charrefs=True)
    reader.feed(source)
    reader.close()
    return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def test_every_page_equals_a_plain_reading_of_its_article(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    want = {r.page_id: read_article(r.html or "") for r in pages.collect()}
    got = {r.page_id: r.text for r in html_extract.op4_html_extract(spark, "/root/testdata/sf0.01").collect()}
    assert got == want and sum(map(bool, want.values())) > 200


def test_trees_read_pages_whose_markup_says_nothing(spark):
    """Names scrambled, semantic elements gone: the word lists that gave the labels find nothing, the trees the article."""
    pages = [r.html for r in table(spark, "/root/testdata/sf0.01", "pages").filter("html is not null").orderBy("page_id").collect()]
    model = html_extract.train(pages[:120])
    held = pages[120:]
    blind = [html_extract.Page(scrambled(h, i)) for i, h in enumerate(held)]
    assert all((p.declared() != 1).all() for p in blind)
    texts = [p.extract(o) for p, o in zip(blind, html_extract.log_odds(blind, model), strict=True)]
    assert sum(t == read_article(h) for t, h in zip(texts, held, strict=True)) >= 0.95 * len(held)


FORMS = [
    "<p>{12} <a href=/x>{3}</a> {9} <em>{2}</em>.</p>", "<ul><li>{3}</li><li>{15} <a href=/q>{2}</a></li><li>{18}</li></ul>", "<ol><li>{12}</li><li>{20}</li></ol>",
    "<table><tr><th>{1}</th><th>{2}</th></tr><tr><td>{3}</td><td>{8}</td></tr></table>", "<blockquote>{20}</blockquote>", "<blockquote><p>{20}</p></blockquote>",
    "<dl><dt>{1}</dt><dd>{9}</dd><dt>{1}</dt><dd>{12}</dd></dl>", "<figure><img src=a.png><figcaption>{8}</figcaption></figure>", "<section><h2>{4}</h2><p>{40}</p></section>", "<pre>{15}</pre>",
    "<div>{30}</div>", "<details><summary>{3}</summary><p>{20}</p></details>", "<h3>{3}</h3><p>{25}</p>",
]
UNWANTED = [
    "<aside>Advert {9}</aside>", '<div class="comments"><p>{9}</p><p>{9}</p></div>', '<div class="related"><h3>Related</h3><ul><li><a href=/1>{9}</a></li></ul></div>', '<div class="advert">{9}</div>',
    "<nav><a href=#a>{2}</a> <a href=#b>{3}</a></nav>", "<form><p>{9}</p><input></form>", '<section class="comment-list"><div class="comment"><b>{1}</b><div>{9}</div></div></section>',
]


def plain_blocks(source: str) -> list[str]:
    marked = re.sub(r"</?(?:p|div|li|[uo]l|t[dhr]|table|blockquote|d[ldt]|figure|figcaption|section|h\d|pre|details|summary)\b[^>]*>", "\0", source)
    return [b for b in (" ".join(html.unescape(b).split()) for b in re.sub(r"<[^>]*>", "", marked.replace("<br>", " ")).split("\0")) if b]


def test_trees_read_forms_that_the_given_pages_do_not_have(spark):
    """Thirteen forms of main text, kept whole with the words of their links, names scrambled or not; boilerplate inside the article goes."""
    pages = [r.html for r in table(spark, "/root/testdata/sf0.01", "pages").filter("html is not null").orderBy("page_id").collect()]
    model = html_extract.train(pages[:150])
    held, right, scrambled_right, n = [h for h in pages[150:] if h.count("<p>") > 2 and "</article>" in h], 0, 0, 0
    for k, source in enumerate(held):
        before, body, after = re.match(r"(.*<article>)(.*)(</article>.*)$", source, re.S).groups()
        words, rng, at = re.sub(r"<[^>]*>", " ", body).split(), random.Random(k), body.rfind("<p>")

        def fill(form):
            return re.sub(r"\{(\d+)\}", lambda m: " ".join(rng.choices(words, k=int(m[1]))), form)  # noqa: B023

        for j, form in enumerate(FORMS):
            inner, unwanted = fill(form), fill(UNWANTED[(k + j) % len(UNWANTED)])
            want = "\n\n".join(plain_blocks(body[:at] + inner + body[at:]))
            forms = [html_extract.Page(before + body[:at] + inner + unwanted + body[at:] + after), html_extract.Page(scrambled(before + body[:at] + inner + body[at:] + after, k))]
            named, blind = (p.extract(o) for p, o in zip(forms, html_extract.log_odds(forms, model), strict=True))
            right, scrambled_right, n = right + (named == want), scrambled_right + (blind == want), n + 1
    assert n > 500 and right >= 0.95 * n and scrambled_right >= 0.95 * n, (right, scrambled_right, n)


@pytest.mark.parametrize(
    ("source", "verdict"),
    [("<p>a <b>b <i>c</i></b> d</p>", [0, 1, 1, 1]), ("<div><a>x</a> <a>y</a><p>z</p></div>", [0, 1, 2, 3, 4]), ("<div>so <a>x</a><p>z</p></div>", [0, 1, 1, 3]), ("<x-app><div>z</div></x-app><a>b</a>", [0, 1, 2, 3])],
)
def test_inline_elements_take_the_verdict_of_their_sentence(source, verdict):
    assert html_extract.Page(source).judged().tolist() == verdict


@pytest.mark.parametrize(
    ("source", "text"),
    [("<article><p title=it's>One.</p><p>Two.</p></article>", "One.\n\nTwo."), ("<article><p data-x='a>b'>One.</p><!-- open <p>Two.", "One."), ("<article>" + "<p>word</p>" * 3000, "\n\n".join(["word"] * 3000)),
     ("<article><p a=\"1>One.</p></article>", "One."), ("<article>" + "<div>" * 400 + "deep", "deep")],
)
def test_odd_markup(source, text):
    page = html_extract.Page(source)
    assert page.extract(page.declared().astype(float) - 0.5) == text


def test_truncated_and_whole_pages_of_the_test_data(spark, small):
    got = html_extract.op4_html_extract(spark, small).collect()
    assert len(got) == table(spark, small, "pages").count()
    assert all(r.n_chars == len(r.text) and "track(" not in r.text for r in got)


@pytest.mark.parametrize("words", [100, 300, 1000])
@pytest.mark.parametrize("share", [0.1, 0.15, 0.18])
def test_sketches_of_linked_texts_meet(words, share):
    rng, met = np.random.default_rng(words), 0
    for _ in range(300):
        one = rng.integers(0, 3000, words).astype(np.uint32)
        two, at = one.copy(), rng.choice(words, int(share * words), replace=False)
        two[at] = rng.integers(3000, 6000, len(at))
        assert near_dedup.edits_within(one, two, int(0.2 * words))
        met += bool((near_dedup.sketch(near_dedup.kmers(one)) == near_dedup.sketch(near_dedup.kmers(two))).any())
    s = (1 - share) ** 5
    chance = 1 - (1 - (s / (2 - s)) ** 2) ** near_dedup.BANDS
    assert abs(met / 300 - chance) <= 4 * (chance * (1 - chance) / 300) ** 0.5, met  # four standard errors of 300 draws


def distance(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("cells", [4_000_000, 0])
def test_banded_alignment(monkeypatch, cells):
    monkeypatch.setattr(near_dedup, "CELLS", cells)
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 40))]
        b = a[:]
        for _ in range(rng.randrange(8)):
            i, what = rng.randrange(len(b) + 1), rng.randrange(3)
            b[i : i + (what != 0)] = [rng.randrange(6)] * (what != 2)
        limit = rng.randrange(9)
        assert near_dedup.edits_within(np.array(a, np.uint32), np.array(b, np.uint32), limit) == (distance(a, b) <= limit)


def edit_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Of whole arrays, row by row, without a band."""
    row, step = np.arange(len(b) + 1), np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        new = np.minimum(row[1:] + 1, row[:-1] + (b != x))
        row = np.minimum.accumulate(np.concatenate(([i], new)) - step) + step
    return int(row[-1])


def brute_links(texts: dict[int, str]) -> list[tuple[int, int]]:
    """All pairs whose words differ in a fifth of the longer one at most; only lengths and bags of words spare an alignment."""
    words = {d: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", t.lower()) for d, t in texts.items()}
    number: dict[str, int] = {}
    coded = {d: np.array([number.setdefault(x, len(number)) for x in w], dtype=np.int64) for d, w in words.items()}
    bags, links, ids = {d: Counter(w) for d, w in words.items()}, [], sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            longer, shorter = max(len(words[a]), len(words[b])), min(len(words[a]), len(words[b]))
            if not longer:
                if texts[a] == texts[b]:
                    links.append((b, a))
            elif shorter >= 0.8 * longer and (bags[a] & bags[b]).total() >= 0.8 * longer - 1e-9 and edit_distance(coded[a], coded[b]) <= 0.2 * longer + 1e-9:
                links.append((b, a))
    return links


def brute_classes(texts: dict[int, str]) -> dict[int, int]:
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in brute_links(texts):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {d: find(d) for d in texts}


def test_near_copies_equal_brute_force(spark, small):
    texts = {r.doc_id: r.text or "" for r in table(spark, small, "documents").collect()}
    rng = random.Random(9)
    base = [f"word{rng.randrange(400)}" for _ in range(220)]
    for i in range(60):  # a large group whose members differ, all with a passage that unrelated texts share
        w = base[:]
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"new{i}"
        texts[1000 + i] = " ".join(w)
        texts[2000 + i] = " ".join(base[:60] + [f"own{i}x{j}" for j in range(60)])
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.classes(df).collect()}
    assert got == brute_classes(texts)


def test_near_copies_in_a_crowd_that_shares_a_passage(spark):
    passage = " ".join(f"p{j}" for j in range(150))
    texts = {i: passage + "".join(f" own{i}x{j}" for j in range(50)) for i in range(600)}  # 0.75 of the words stand: not linked
    texts |= {1000 + i: passage + "".join(f" own{i + 1000 * (j > 9)}x{j}" for j in range(50)) for i in range(100, 200)}  # 0.8 of document i
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.classes(df).collect()}
    assert got == {i: i - 1000 if i >= 1000 else i for i in texts}


def test_scattered_edits_are_near_copies(spark):
    """Words replaced at random up to a tenth, which leaves half of the k-mers or fewer: the alignment decides."""
    rng = random.Random(3)
    texts = {}
    for i in range(300):
        w = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 900))]
        texts[i] = " ".join(w)
        for k in rng.sample(range(len(w)), int(len(w) * rng.choice([0.02, 0.05, 0.1]))):
            w[k] = f"new{i}"
        texts[1000 + i] = " ".join(w)
    got = {r.doc_id: r.class_id for r in near_dedup.classes(spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")).collect()}
    assert all(got[i] == i for i in range(300))
    assert sum(got[1000 + i] == i for i in range(300)) >= 0.97 * 300


def test_two_texts_of_one_id_are_classes_of_their_own(spark):
    one, two = (" ".join(f"{c}{j}" for j in range(100)) for c in "ab")
    given = [(1, one), (2, two), (7, one + " more"), (7, two + " more"), (9, "first text of nine"), (9, "second of nine"), (None, one + " end"), (None, "no id at all"), (None, "no id at all"), (None, "another")]
    got = near_dedup.classes(spark.createDataFrame(given, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.kept) for r in got) == sorted(
        [(1, 1, True), (2, 2, True), (7, 1, False), (7, 2, False), (9, 9, True), (9, 9, True), (0, 1, False), (0, 0, True), (0, 0, True), (0, 0, True)]
    )
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in given], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, "another"), (0, "no id at all"), (1, one), (2, two), (9, "first text of nine"), (9, "second of nine")])


def test_near_copies_of_odd_rows(odd, none):
    got = near_dedup.classes(odd).collect()
    assert len(got) == odd.count()
    by = {(r.doc_id, r.class_id) for r in got}
    assert {(5, 5), (6, 5), (None, 5), (1, 1), (2, 1), (3, 3), (8, 8), (4, 4)} <= by
    assert near_dedup.classes(none).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7), (31, 0), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(32)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_search_of_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(2)
    given = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(300 + i, [0.5] * 8) for i in range(40)]
    given += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, [1.0] * 8), (404, [1.0] * 3), (405, [])]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in given], "vec_id long, embedding array<double>, score int, rank int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk_search.search(df, "vec_id", "embedding", "__id % 50 = 0").collect())
    fine = {i: np.floor(256 * np.array(v)) for i, v in given if i is not None and i < 400}
    want = []
    for q in (i for i in fine if i % 50 == 0):
        best = sorted(((-int(fine[q] @ v), i) for i, v in fine.items() if i != q))[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk_search.search(df.limit(0), "vec_id", "embedding", "__id % 50 = 0").count() == 0


def test_lists_are_read_as_far_as_they_must():
    rng = np.random.default_rng(7)
    n, dims, k = 6000, 24, 5
    skewed = np.floor(256 * rng.exponential(size=(n, dims)) ** 4).astype(np.int64)
    lists, read = topk_search.Lists(skewed), []
    for q in range(0, 200, 5):
        weights = np.where(rng.random(dims) < 0.2, skewed[q] + 1, 0)
        left, score, entries = topk_search.no_random_access(lists, weights, np.arange(n) != q, k)
        full = skewed @ weights
        full[q] = -1
        assert sorted(score.tolist())[-k:] == sorted(full.tolist())[-k:]
        read.append(entries / (n * max(1, (weights != 0).sum())))
    assert np.mean(read) < 0.25, np.mean(read)  # of all list entries
    own = np.arange(0, 200, 5)
    queries = np.stack([np.where(rng.random(dims) < 0.2, skewed[q] + 1, 0) for q in own]) * np.where(rng.random((len(own), dims)) < 0.1, -1, 1)
    few = []
    for i, (left, score, entries) in enumerate(topk_search.together(lists, queries, np.arange(n) != own[:, None], k)):
        full = np.delete(skewed @ queries[i], own[i])
        assert sorted(score.tolist())[-k:] == sorted(full.tolist())[-k:] or not queries[i].any()
        few.append(entries / (n * max(1, (queries[i] != 0).sum())))
    assert np.mean(few) < 0.4, np.mean(few)
    dense = rng.integers(-300, 300, size=(700, 16))
    for i, (left, score, _) in enumerate(topk_search.together(topk_search.Lists(dense), dense[:70], np.arange(700) != np.arange(70)[:, None], k)):
        assert sorted(score.tolist())[-k:] == sorted(np.delete(dense @ dense[i], i).tolist())[-k:]
    big = np.array([[2**52 + 1, 3], [2**52, 4], [1, 2], [5, 5], [2**52 + 1, 2]], dtype=np.int64)
    left, score, _ = topk_search.no_random_access(topk_search.Lists(big), np.array([7, 1]), np.ones(5, bool), 2)
    assert sorted(score.tolist())[-2:] == [7 * (2**52 + 1) + 2, 7 * (2**52 + 1) + 3]  # beyond 2**53, exact
    with pytest.raises(OverflowError):
        topk_search.no_random_access(topk_search.Lists(big), np.array([2**40, 1]), np.ones(5, bool), 2)


def test_embedding_groups_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(30, 32))
    given = []
    for i in range(1500):
        v = centers[i % 30] + rng.normal(size=32) * (0.05 if i % 3 else 1.0) if i < 1200 else centers[0] + rng.normal(size=32) * 0.03
        given.append((i, v.tolist(), i % 2 if i < 1200 else 0))
    given += [(2000 + i, centers[1].tolist(), 1) for i in range(5)] + [(2100, None, 1), (2101, [0.0] * 32, 1), (2102, [float("nan")] * 32, 1), (2103, centers[1].tolist(), None), (2000, centers[1].tolist(), 1), (2104, [1.0, 2.0], 1)]
    df = spark.createDataFrame([(a, b, c, 5) for a, b, c in given], "vec_id long, embedding array<double>, label int, rep int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.link(df).collect())
    n, root = len(given), list(range(len(given)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links, ok = [0] * n, [k for k, (_, v, label) in enumerate(given) if v is not None and label is not None and len(v) == 32 and np.isfinite(v).all() and any(v)]
    m = np.array([given[k][1] for k in ok])
    cos = (m @ m.T) / np.outer(np.linalg.norm(m, axis=1), np.linalg.norm(m, axis=1))
    for i, j in zip(*np.nonzero(cos >= 0.98), strict=True):
        a, b = ok[i], ok[j]
        if a != b and given[a][2] == given[b][2]:
            links[a] += 1
            x, y = find(a), find(b)
            if given[x][0] > given[y][0]:
                x, y = y, x
            root[y] = x
    want = sorted((given[k][0], links[k], given[find(k)][0], given[find(k)][0] == given[k][0]) for k in range(n))
    exact = sum(a == b for a, b in zip(got, want, strict=True)) / n
    assert [(a[0], a[2]) for a in got] == [(b[0], b[2]) for b in want] and exact > 0.99
    assert sum(g[1] for g in got) >= 0.999 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert embedding_dedup.link(df.limit(0)).count() == 0


def test_no_link_of_a_large_dense_group_is_missed(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=64) + rng.normal(size=(6000, 64)) * rng.choice([0.05, 0.1, 0.13], size=(6000, 1))
    m = np.concatenate((m, rng.normal(size=(500, 64))))
    df = spark.createDataFrame([(i, v.tolist(), "one") for i, v in enumerate(m)], "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: r.n_links for r in embedding_dedup.link(df).collect()}
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    want = np.concatenate([(unit[i : i + 1000] @ unit.T >= 0.98).sum(axis=1) - 1 for i in range(0, len(m), 1000)])
    assert want.sum() > 1_000_000 and [got[i] for i in range(len(m))] == want.tolist()


def test_pipeline_stages_on_their_own_input(spark, small):
    docs = table(spark, small, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, small), name)
        if name != "bpe":
            assert docs.columns == corpus_pipeline.COLUMNS
        kept[name] = docs
        if name == "language_id":
            model = language_id.fit(before.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
            want = [r.doc_id for r in before.collect() if not model.predict(r.text)[2]]
            assert sorted(r.doc_id for r in docs.collect()) == sorted(want)
        if name == "near_dedup":
            classes = brute_classes({r.doc_id: r.text or "" for r in before.collect()})
            assert sorted(r.doc_id for r in docs.collect()) == sorted(set(classes.values()))
        if name == "secret_scan":
            assert docs.count() == before.count()
            changed = docs.join(before.select("doc_id", F.col("text").alias("old")), "doc_id").filter("text <> old").collect()
            assert changed and all("<secret>" in r.text and r.n_chars == len(r.text) for r in changed)
        if name == "mixing":
            assert docs.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    texts = sorted((r.doc_id, r.text) for r in kept["mixing"].collect())
    assert sorted((r.doc_id, r.text) for r in kept["bpe"].collect()) == texts


def test_pipeline_of_odd_rows(spark, odd, none):
    for given in (odd, none):
        docs = given
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, ""), name)
        assert docs.count() <= 3 * given.count()
