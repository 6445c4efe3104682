"""Each text operator against plain Python, and its edge cases."""

from __future__ import annotations

import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from floatlake.llm import common, decontaminate, html, language, licenses, lines, packing, quality, queries, simhash, substrings, urls, wordtable  # noqa: E402

SF = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"w{i}" for i in range(60))
#: Nulls, empty and long texts, ties, copies, repeated rows, odd white space.
EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, PASSAGE), (6, "pre " + PASSAGE + " post"), (6, "pre " + PASSAGE + " post"),
    (7, PASSAGE), (8, PASSAGE.replace(" ", "\n", 20)), (9, "a\u00a0b\u2003c \x1c d " * 30), (10, ("x " * 70 + "\n") * 3),
    (11, "A Line That Is Long Enough\nother"), (12, " a line that is LONG enough\r\nmore"), (13, "\ta line that is long enough"),
    (13, "a line that is long enough\n\n"), (14, "ÉTÉ line that is long enough"), (15, "été line that is long enough"),
    (16, "ÉTÉ LINE that is long enough"), (17, "ÉTÉ line that is long enough"), (18, "word " * 30_000 + PASSAGE), (19, "\U0001F600 \ud7ff été"),
    (20, "1234 5678 !!"), (None, PASSAGE), (None, None),
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "en", "s", None, 7, "z") for i, t in EDGES]
    schema = "doc_id long, text string, lang string, source string, n_chars long, did long, GONE string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def nothing(edges):
    return edges.limit(0)


@pytest.fixture(scope="module")
def documents(spark):
    return queries.table(spark, SF, "documents")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def with_least(rows):
    return [(common.NO_ID if i is None else i, t) for i, t in rows]


def real(i):
    return None if i == common.NO_ID else i


def same(found, expected):
    order = lambda rows: sorted(rows, key=repr)
    assert order(found) == order(expected)


@pytest.mark.parametrize("name", ["edges", "documents"])
def test_substrings(name, request):
    df = request.getfixturevalue(name)
    found = [tuple(r) for r in substrings.drop_repeated_windows(df).select("doc_id", "n_words", "n_removed", "kept").collect()]
    expected = [(real(i), n, gone, kept) for i, n, gone, kept in brute.repeated_windows(with_least(pairs(df)))]
    same(found, expected)
    assert sum(x[2] for x in found) > 0


@pytest.mark.parametrize("length", [32, 7, 40])
def test_substrings_of_other_lengths(spark, length):
    rng = np.random.default_rng(length)
    base = [f"t{x}" for x in rng.integers(0, 9, 300)]
    rows = [(i, " ".join(base[a : a + n])) for i, (a, n) in enumerate(zip(rng.integers(0, 250, 40), rng.integers(1, 120, 40), strict=True))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in substrings.drop_repeated_windows(df, length=length).select("doc_id", "n_words", "n_removed", "kept").collect()]
    same(found, list(brute.repeated_windows(rows, length)))


def test_levels_double():
    assert substrings.levels(50) == [25, 50]
    assert substrings.levels(64) == [16, 32, 64]
    assert substrings.levels(51) == [51]


@pytest.mark.parametrize("name", ["edges", "documents"])
def test_lines(name, request):
    df = request.getfixturevalue(name)
    found = [tuple(r) for r in lines.drop_repeated_lines(df).select("doc_id", "n_lines", "n_dropped", "kept").collect()]
    same(found, [(real(i), *x) for i, *x in brute.repeated_lines(with_least(pairs(df)))])
    assert sum(x[2] for x in found) > 0
    kept = lines.with_kept_lines(df)
    assert kept.columns == df.columns
    texts = {(i, t): k for (i, t), (_, _, _, k) in zip(with_least(pairs(df)), brute.repeated_lines(with_least(pairs(df))), strict=True)}
    same(pairs(kept), [(real(i), None if t is None else texts[i, t]) for i, t in with_least(pairs(df))])


def test_line_runs_hold_each_key_once(spark):
    runs = lines.LineRuns(common.Workspace(spark, "test"))
    batches = [[(k, k, 1, 100 - b) for k in range(b, b + 5)] for b in range(5)]
    for rows in batches:
        runs.add(spark.createDataFrame(rows, "k1 long, k2 long, n long, holder long"))
    held = [r.k1 for run in runs._all() for r in run.collect()]
    assert sorted(held) == list(range(9))
    assert {r.k1: (r.n, r.holder) for r in runs.tallies().collect()} == {
        k: (sum(b <= k < b + 5 for b in range(5)), 100 - min(b for b in range(5) if b <= k < b + 5)) for k in range(9)
    }


@pytest.mark.parametrize("name", ["edges", "documents"])
def test_simhash(name, request):
    df = request.getfixturevalue(name)
    found = [tuple(r) for r in simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()]
    same(found, [(real(i), f, real(c)) for i, f, c in brute.components(with_least(pairs(df)))])
    first = simhash.first_of_each(df)
    assert first.columns == df.columns
    expected = [real(i) for i, _, c in brute.components(with_least(pairs(df))) if i == c]
    same([r.doc_id for r in first.collect()], expected)


@pytest.mark.parametrize("node_rows", [200_000, 20])
def test_trie_links_find_every_component(spark, monkeypatch, node_rows):
    monkeypatch.setattr(simhash, "NODE_ROWS", node_rows)
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = set()
    for seed in seeds.tolist():
        for _ in range(40):
            seed ^= sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 4)), replace=False))
            values.add(seed)
    values = sorted(values)
    df = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    links = simhash.near_links(df, common.Workspace(spark, "test")).collect()
    assert all(1 <= ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in links)
    roots = simhash.components(spark.createDataFrame(links, "a long, b long"), common.Workspace(spark, "test"))
    found = {r.node: r.component for r in roots.collect()}
    groups: dict[int, set] = {}
    for v in values:
        s = v - 2**64 if v >= 2**63 else v
        groups.setdefault(found.get(s, s), set()).add(v)
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    expected: dict[int, set] = {}
    for v in values:
        expected.setdefault(root(v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_trie_links_between_two_nodes():
    rng = np.random.default_rng(8)
    for depth in (21, 29, 61):
        values, groups = [], []
        for number, apart in enumerate((0, 1, 3, 2**7)):
            top = int(rng.integers(0, 2 ** (depth - 8))) << 8
            low = rng.integers(0, 2 ** min(12, 64 - depth), 500, dtype=np.uint64).tolist()
            own = sorted({(top ^ (apart if k % 2 else 0)) << (64 - depth) | x for k, x in enumerate(low)})
            values += own
            groups += [number] * len(own)
        values, groups = np.array(values, np.uint64), np.array(groups)
        i, j = simhash.trie_links(values, groups, 2, np.full(len(values), depth))
        found = set(zip(i.tolist(), j.tolist(), strict=True))
        node = values >> np.uint64(64 - depth)
        mixed = np.isin(groups, (1, 2, 3))
        expected = {
            (a, b) for a in range(len(values)) for b in np.flatnonzero((groups == groups[a]) & (np.bitwise_count(values ^ values[a]) <= 2)).tolist()
            # Links inside one node of two are found where that node is paired with itself.
            if a < b and (node[a] != node[b] or not mixed[a])
        }
        assert found == expected and expected


@pytest.mark.parametrize("name", ["edges", "documents"])
def test_statistics(name, request):
    df = request.getfixturevalue(name)
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.statistics(df).collect()]
    same(found, [(i, *brute.statistics(t)) for i, t in pairs(df)])


def test_quality_finds_bad_documents(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.1", x) for x in ("documents", "labels"))
    found = quality.quality_verdicts(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    kept = dict(map(tuple, found))
    assert kept[1] > 0.96 and kept[0] < 0.05


def test_quality_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 0), (5, 1), (None, 1), (6, None)], "doc_id long, quality int")
    rows = quality.quality_verdicts(edges, labels).collect()
    assert len(rows) == len(EDGES) and all(r.kept is not None and 0 <= r.anomaly <= 1 for r in rows)
    assert not any(r.kept for r in rows if r.base_failed)
    assert quality.quality_verdicts(nothing, labels.limit(0)).count() == 0
    assert quality.quality_verdicts(edges, labels.limit(0)).filter("kept = base_failed").count() == 0


def test_urls(spark):
    addresses = [
        "https://a.example.org/es/1", "https://a.example.org/en/12?x=1", "http://example.org/en/1#a", "HTTP://WWW.X.COM/fr/a", "https://x.com/de/", "https://x.com/de",
        "http://x.net", "http://", "no scheme", None, "", "https://org/", "http://notexample.org/es/", "x://y://z.org/a", "http://ads.x.net/a", "http://b.spam-farm.net?q#f",
        "http://x.org", "http://\u00c4.ORG/\n/x", "http://a.example.org/es/1",
    ]
    pages = spark.createDataFrame([(i, u, 1, "r") for i, u in enumerate(addresses)], "page_id long, url string, host int, RULE string")
    rules = spark.createDataFrame(queries.URL_RULES, "key string, verdict string")
    listed = urls.hosts_with_words(pages, queries.HOST_WORDS)

    def judge(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
            host = rest[:end].translate(brute.LOWER)
            tail = rest[end:]
            path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
        fits = []
        for key, verdict in queries.URL_RULES:
            own, _, start = key.partition("/")
            if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
                fits.append((len(key), key, verdict))
        import re

        bad = bool(set(re.split(r"[.\-]", host)) & set(queries.HOST_WORDS))
        _, rule, verdict = max(fits, default=(0, None, "block" if bad else "allow"))
        return host, path, rule, verdict

    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_verdicts(pages, rules, listed).collect()}
    assert found == {i: judge(u) for i, u in enumerate(addresses)}
    assert urls.url_verdicts(pages.limit(0), rules, listed).count() == 0
    assert urls.url_verdicts(pages, rules.limit(0), listed.limit(0)).filter("verdict <> 'allow'").count() == 0


def test_cascade_is_exact(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("host"), F.col("id").cast("string")).alias("key"))
    listed = universe.filter(F.pmod(F.xxhash64("key"), F.lit(7)) == 0).unionByName(spark.range(5).select(F.concat(F.lit("x"), "id").alias("key")))
    cascade = urls.build_cascade(universe, listed, common.Workspace(spark, "test"), "c")
    assert len(cascade.levels) > 2
    keys = [r.key for r in universe.collect()]
    expected = {r.key for r in listed.collect()}
    assert [k for k, x in zip(keys, cascade.contains(keys), strict=True) if x] == [k for k in keys if k in expected]


def test_urls_in_several_passes(spark, monkeypatch):
    pages = queries.table(spark, SF, "pages")
    rules = spark.createDataFrame(queries.URL_RULES, "key string, verdict string")
    listed = urls.hosts_with_words(pages, queries.HOST_WORDS)
    whole = urls.url_verdicts(pages, rules, listed).collect()
    monkeypatch.setattr(urls, "BROADCAST_BITS", 200)
    same(list(map(tuple, urls.url_verdicts(pages, rules, listed).collect())), list(map(tuple, whole)))


@pytest.mark.parametrize("name", ["edges", "documents"])
def test_license_base(name, request):
    df = request.getfixturevalue(name)
    found = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, list(r.base)) for r in licenses.scan_licenses(df).collect()]
    same(found, [(i, *brute.phrase_places(brute.license_words(t), licenses.BASE_PHRASES)) for i, t in pairs(df)])


def test_license_spans(spark):
    mit = licenses.TEMPLATES["mit-notice"].split()
    apache = "Licensed under the Apache License, Version 2.0"
    texts = {
        1: "word " * 50 + apache + " tail", 2: " ".join(mit), 3: " ".join(mit[:9] + ["extra"] + mit[9:]), 4: " ".join(mit[:5]), 5: "cc by cc by CC-BY all rights reserved all rights reserved",
        6: "Licensed under CC BY-NC 4.0.", 7: f"{apache} and {apache}", 8: "the mit license was not released", 9: None, 10: "a b",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("t", F.lit(1))
    rows = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    spans = {i: [(x.label, x.first_word, x.last_word) for x in r.spans] for i, r in rows.items()}
    assert spans[1] == [("apache-2.0", 50, 57)]
    assert spans[2] == [("mit-notice", 0, len(mit) - 1)] and rows[2].score == 1
    assert spans[3] == [("mit-notice", 0, len(mit))] and rows[3].score >= 0.8
    assert spans[4] == spans[8] == spans[9] == spans[10] == []
    assert (rows[5].n_base, rows[5].first_word, rows[5].last_word, list(rows[5].labels), rows[5].score) == (5, 0, 9, ["cc-by", "reserved"], 1)
    assert list(rows[6].labels) == ["cc-by", "cc-by-nc-4.0"]
    assert spans[7] == [("apache-2.0", 0, 7), ("apache-2.0", 9, 16)]
    plan = licenses.scan_licenses(df)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_license_followed_by_a_part_of_itself(spark):
    texts = {
        1: "Released under the MIT License. The MIT License permits all", 2: "Licensed under CC BY 4.0 (CC BY 4.0)",
        3: "Released under the MIT License. The MIT License; released under the MIT License", 4: "the MIT License the MIT License the MIT License",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    spans = {i: [(x.label, x.first_word, x.last_word, x.score) for x in r.spans] for i, r in rows.items()}
    assert spans[1] == [("mit", 0, 4, 1.0)] and list(rows[1].labels) == ["mit"] and rows[1].score == 1
    assert spans[2] == [("cc-by-4.0", 0, 5, 1.0)] and list(rows[2].labels) == ["cc-by", "cc-by-4.0"]
    assert spans[3] == [("mit", 0, 4, 1.0), ("mit", 8, 12, 1.0)]
    assert spans[4] == []


def test_leaks(spark):
    docs, items = (queries.table(spark, SF, x) for x in ("documents", "benchmark"))
    texts = [(i, decontaminate.words_of(t)) for i, t in pairs(docs)]
    known = [(r.item_id, decontaminate.words_of(r.text)) for r in items.collect()]
    expected = {}
    for i, words in texts:
        own = set(words)
        for k, item in known:
            if sum(w in own for w in item) >= 0.8 * len(item) and (d := brute.edit_distance(item, words)) <= int(0.2 * len(item)):
                expected[i, k] = d
    found = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaked_items(docs, items).collect()}
    assert found == expected and found


def test_edited_leaks_reach_the_recall(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(k, " ".join(rng.choice(vocabulary, int(rng.integers(15, 80))))) for k in range(150)]
    docs = []
    for k, text in items:
        words = text.split()
        for _ in range(len(words) // 10):
            at = int(rng.integers(0, len(words)))
            words[at : at + int(rng.integers(0, 2))] = [str(rng.choice(vocabulary))] if rng.random() < 0.7 else []
        docs.append((k, " ".join([*rng.choice(vocabulary, 200), *words, *rng.choice(vocabulary, 200)])))
    found = decontaminate.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    pairs_found = {(r.doc_id, r.item_id) for r in found.collect()}
    assert all(a == b for a, b in pairs_found)
    assert len(pairs_found) >= decontaminate.RECALL * len(items)


def test_leak_edges(spark, edges, nothing, monkeypatch):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (None, "w1 w2 w3"), (4, PASSAGE), (4, PASSAGE), (5, "!!!")], "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.first_word) for r in decontaminate.leaked_items(edges, items).collect()}
    assert {(4, 3, 0), (5, 4, 0), (6, 4, 1), (7, None, 1), (18, 4, 30_000), (None, 4, 0)} <= found
    assert not {i for i, *_ in found} - {4, 5, 6, 7, 8, 18, None}
    assert decontaminate.leaked_items(nothing, items).count() == 0
    assert decontaminate.leaked_items(edges, items.limit(0)).count() == 0
    clean = decontaminate.clean_documents(edges, items)
    assert clean.columns == edges.columns
    same([r.doc_id for r in clean.collect()], [i for i, t in EDGES if i not in (4, 5, 6, 7, 8, 18) and t != PASSAGE])
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 100)
    assert {(r.doc_id, r.item_id, r.first_word) for r in decontaminate.leaked_items(edges, items).collect()} == found


def test_language_accuracy(spark):
    rows = queries.op7_language_id(spark, "/root/testdata/sf0.01").join(queries.table(spark, "/root/testdata/sf0.01", "documents"), "doc_id")
    held = [(r.lang, r.lang_pred) for r in rows.filter("held_out").collect()]
    assert sum(a == b for a, b in held) / len(held) > 0.98
    for r in rows.select("doc_id", "held_out").limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_language_edges(edges, nothing):
    rows = {(r.doc_id, r.text): r.language for r in language.identify(edges, F.lit(True)).collect()}
    assert {r.lang_pred for (_, t), r in rows.items() if not t or not any(c.isalpha() for c in t)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert language.identify(nothing, F.lit(True)).count() == 0
    assert {r.language.lang_pred for r in language.identify(edges, F.lit(False)).collect()} == {"und"}
    kept = language.in_known_language(edges)
    assert kept.columns == edges.columns and {r.doc_id for r in kept.collect()} & {1, 2, 3, 20} == set()


@pytest.mark.parametrize("name", ["edges", "documents"])
def test_packing_round_trip(name, request):
    from tokenizers import Tokenizer

    df = request.getfixturevalue(name)
    full = Tokenizer.from_file(queries.TOKENIZER[0])
    extra = ["a  b   c \n d", "<|endoftext|> x", " lead", "tail ", "\n\n x\n y", "a\u00a0 b \u2003c", "don't it's 12 3\u00bd"]
    if name == "edges":
        texts = [t for _, t in EDGES] + extra
        df = df.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    pieces = packing.pack_documents(df, *queries.TOKENIZER).collect()
    filled, documents = {}, {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.setdefault(p.sequence_id, 0) and p.length > 0
        filled[p.sequence_id] += p.length
    assert all(n & (n - 1) == 0 and n <= 1024 for n in filled.values())
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        own = documents.setdefault(p.doc_id, [])
        assert p.start == len(own)
        own += np.frombuffer(p.ids, "<u4").tolist()
        assert len(p.ids) == 4 * p.length
    assert documents == {i: [*full.encode(t or "", add_special_tokens=False).ids, 0] for i, t in pairs(df)}
    assert all(p.doc_tokens == len(documents[p.doc_id]) for p in pieces)


def test_packing_edges(spark, nothing):
    assert packing.pack_documents(nothing, *queries.TOKENIZER).count() == 0
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None)], "doc_id long, text string")
    assert packing.pack_documents(twice, *queries.TOKENIZER).agg(F.sum("length")).first()[0] == 7
    with pytest.raises(ValueError):
        packing.pack_documents(nothing, *queries.TOKENIZER, tiers=(1000,))


def test_step_groups_hold_one_tier(documents):
    rows = packing.pack_documents(documents, *queries.TOKENIZER).groupBy("step_group").agg(F.sum("length").alias("n"), F.countDistinct("tier").alias("k")).collect()
    assert all(r.n <= 16_384 and r.k == 1 for r in rows)


def test_window_minimum():
    values = np.random.default_rng(1).integers(0, 1000, 200).astype(np.uint64)
    for n in (1, 2, 3, 26, 200, 201):
        assert wordtable.window_minimum(values, n).tolist() == [values[i : i + n].min() for i in range(len(values) - n + 1)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy <div>now</div></div><!-- c -->
<article class="post"><h1>Title &amp; more</h1><p>One&nbsp;two <b>th</b>ree<br>four<p>Five &lt;six&gt;<form>Name <input name="q>"></form>
<aside>Side</aside><div id="comments"><p>Reader</p></div><section class="newsletter-signup">Mail</section><p>Last</p></article>
<footer>End</footer></body>"""


def test_page_blocks():
    assert [t for t, inside in html.page_blocks(PAGE) if inside] == ["Title & more", "One two three four", "Five <six>", "Last"]
    assert html.page_blocks("") == [] and html.page_blocks("plain <b>text") == [("plain text", False)]
    assert html.page_blocks("<p>a</p><div class=ad>x") == [("a", False)]
    assert html.page_blocks("<div hidden>x</div><p>y <unfinished") == [("y", False)]
    wrapped = '<div class="page with-sidebar"><article><p>a</p></article><div class="related"><article>b</article></div></div><div class="adBox">c</div>'
    assert html.page_blocks(wrapped) == [("a", True)]
    assert html.page_blocks('<main><p class="cookieNote">x<p>y<div id="postComments"><article>z</article></div></main>') == [("y", True)]


def test_names_of_headings_and_text_inside_articles():
    kept = (
        '<h2 id="related-work">a</h2><section id="search-algorithms"><p id="social">b</p></section><p class="notice">c</p>'
        '<p>d<span class="hl-comment">e</span> <a class="share" id="skip">f</a></p><h3 class="promotion">g</h3><div id="cookie-recipes">h</div>'
    )
    assert html.page_blocks(f"<article>{kept}</article>") == [(x, True) for x in ("a", "b", "c", "de f", "g", "h")]
    gone = '<div class="related">x</div><div id="comments">x</div><ul id="comment-12"><li>x</ul><section role="search">x</section><p class="ad">x</p><h2 hidden>x</h2>'
    assert html.page_blocks(f"<article><p>a</p>{gone}</article>") == [("a", True)]
    assert html.page_blocks("<div id='site-search'>x</div><p>z</p>") == [("z", False)]


def test_boilerplate_goes_by_host(spark):
    notice = "this site uses small files to remember what you like please agree"
    pages = [(i, f"http://h.org/{i}", f"<div>{notice}</div><div>{' '.join(f'u{i}x{k}' for k in range(20))}</div>") for i in range(30)]
    pages += [(2**60 + 1, "http://big.org/", "<p>one page</p>")]
    pages += [(100 + i, f"http://other{i}.org/", f"<p>{notice}</p>") for i in range(3)] + [(200, None, None), (201, "x", ""), (200, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(1))
    found = {}
    for r in html.main_texts(df).collect():
        found.setdefault(r.page_id, " ".join(r.blocks))
    assert all(found[i] == " ".join(f"u{i}x{k}" for k in range(20)) for i in range(30))
    assert all(found[100 + i] == notice for i in range(3)) and found[200] == found[201] == ""
    assert found[2**60 + 1] == "one page"
    assert html.main_texts(df).count() == len(pages) and html.main_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize("tag", ["article", "div"])
def test_copies_are_no_boilerplate(tag):
    text = lambda i: " ".join(f"u{i}x{k}" for k in range(20))
    notice = " ".join(f"n{k}" for k in range(12))
    page = lambda *blocks: html.page_blocks("".join(f"<{tag}><p>{x}</p></{tag}>" for x in blocks))
    assert html.chunk_texts([page(text(0))] * 5) == [[text(0)]] * 5
    assert html.chunk_texts([page(text(0))] * 6 + [page(text(i)) for i in range(1, 5)]) == [[text(0)]] * 6 + [[text(i)] for i in range(1, 5)]
    # The notice goes from pages of other words too; copies stay copies, and a page of the notice alone stays.
    pages = [page(notice, text(i)) for i in (0, 0, 0, 1, 2, 3, 4, 5)] + [page(notice)]
    assert html.chunk_texts(pages) == [[text(i)] for i in (0, 0, 0, 1, 2, 3, 4, 5)] + [[notice]]


def test_articles_are_kept_whole(spark):
    import re as _re
    from html import unescape

    pages = queries.table(spark, "/root/testdata/sf0.01", "pages")
    found = {r.page_id: r.text for r in queries.op6_html_extraction(spark, "/root/testdata/sf0.01").collect()}
    for r in pages.collect():
        article = r.html[r.html.index("<article>") :].split("</article>")[0]
        blocks = [" ".join(unescape(_re.sub(r"<br>|<[^>]*>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in _re.split(r"</?(?:p|h1|article)>", article)]
        assert found[r.page_id] == " ".join(x for x in blocks if x)


def test_repeated_tokens():
    rng = np.random.default_rng(4)
    tokens, page_of = rng.integers(0, 3, 300), np.sort(rng.integers(0, 9, 300))
    counts = html.repeated_tokens(tokens, page_of, 5)
    for i in range(300):
        own = tuple(tokens[i : i + 5])
        whole = i + 5 <= 300 and page_of[i] == page_of[i + 4]
        pages = {page_of[j] for j in range(296) if tuple(tokens[j : j + 5]) == own and page_of[j] == page_of[j + 4]}
        assert counts[i] == (len(pages) if whole else 0)


@pytest.mark.parametrize("text", [" " * 2_000_000, "a\n" + "\n" * 300_000 + " b", ("x" + " " * 99_999) * 3, "\u00a0" * 400_000, "y" * 400_000])
def test_long_gaps_are_encoded(text):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(queries.TOKENIZER[0])
    assert packing.encoder(*queries.TOKENIZER)(text).tolist() == full.encode(text, add_special_tokens=False).ids
