"""URL filters: levels of the cascades, large lists, hosts of very many labels."""

from __future__ import annotations

import random
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from floatlake.llm import queries, urls  # noqa: E402


def judged(rules, listed, host, path):
    """Rule and verdict by trying every key."""
    def fits(key):
        own, slash, start = key.partition("/")
        return (host == own or host.endswith("." + own)) and path.startswith(slash + start)

    hit = max(((len(k), len(k.partition("/")[0]), k) for k in rules if fits(k)), default=None)
    if hit:
        return hit[2], rules[hit[2]]
    return None, "block" if any(map(fits, listed)) else "allow"


def test_lists_of_thousands(spark, monkeypatch):
    """Rules and listed hosts and paths, each thousands, through several levels of Bloom filters."""
    rng = random.Random(8)
    built = []
    build = urls.build_cascade
    monkeypatch.setattr(urls, "build_cascade", lambda *a: built.append(build(*a)) or built[-1])
    name = lambda: f"h{rng.randrange(6000)}.{rng.choice(['a.org', 'b.net', 'org', 'c.d.com'])}"
    rules = {name() + rng.choice(["", "/", "/x", "/x/y", "/q"]): rng.choice(["allow", "block"]) for _ in range(4000)}
    listed = {name() + rng.choice(["", "/x", "/long/path/1"]) for _ in range(4000)}
    pages = [(i, f"http://{rng.choice(['', 'w.', 'v.w.'])}{name()}{rng.choice(['', '/', '/x/y/z', '/long/path/12', '/q?a=1'])}") for i in range(3000)]
    found = urls.url_verdicts(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(sorted(rules.items()), "key string, verdict string"),
        spark.createDataFrame([(k,) for k in sorted(listed)], "key string"),
    ).collect()
    small_rules, small_listed = {}, {}
    for k, v in rules.items():
        small_rules.setdefault(k.partition("/")[0], {})[k] = v
    for k in listed:
        small_listed.setdefault(k.partition("/")[0], set()).add(k)
    for r in found:
        labels = r.host.split(".")
        parents = [".".join(labels[i:]) for i in range(len(labels))]
        own_rules = {k: v for p in parents for k, v in small_rules.get(p, {}).items()}
        own_listed = {k for p in parents for k in small_listed.get(p, ())}
        assert (r.rule, r.verdict) == judged(own_rules, own_listed, r.host, r.path)
    assert len({(r.rule is None, r.verdict) for r in found}) == 4
    assert all(len(c.levels) >= 2 for c in built)


def test_the_registered_lists_are_held_by_filters(spark, monkeypatch):
    built = []
    build = urls.build_cascade
    monkeypatch.setattr(urls, "build_cascade", lambda *a: built.append((a[3], build(*a))) or built[-1][1])
    queries.op3_url_filters(spark, "/root/testdata/sf0.01").collect()
    levels = {name: len(cascade.levels) for name, cascade in built}
    # Two of the five rules allow: of their keys so few others pass the first level that no second one is built.
    assert levels["rules0"] >= 2 and levels["allowed0"] >= 1 and levels["listed0"] >= 2


def test_hosts_of_very_many_labels(spark):
    long = ".".join(f"l{i}" for i in range(40_000))
    start = time.perf_counter()
    assert urls.candidate_keys(long + ".bad.org", "/x", [0, 2], 11) == ["bad.org/x", "bad.org", "org/x", "org"]
    assert time.perf_counter() - start < 0.5
    pages = spark.createDataFrame([(i, f"http://{long}.{host}/x") for i, host in enumerate(["bad.org", "good.org"])], "page_id long, url string")
    rules = spark.createDataFrame([("bad.org/x", "block"), ("org", "allow")], "key string, verdict string")
    found = {r.page_id: (r.rule, r.verdict) for r in urls.url_verdicts(pages, rules, rules.limit(0).select("key")).collect()}
    assert found == {0: ("bad.org/x", "block"), 1: ("org", "allow")}
