"""URL rules by a cascade, and mixing sources."""

from __future__ import annotations

import math
import random

import pytest

from settle.llm import source_mix, url_cascade
from settle.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, host string, rule string, key string"

# --- URL rules --------------------------------------------------------------------------------


def plain_verdict(url, rules):
    """Host, path, longest fitting rule and its verdict, by the letter of the definition."""
    url = url or ""
    rest = url.partition("://")[2] if "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [
        (len(h + p), len(h), h + p, verdict)
        for verdict, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


URLS = [
    None, "", "no scheme", "://", "http://", "http://org", "http://org/", "HTTP://A.ORG/x", "ftp://xorg/",
    "http://example.org/es/", "http://www.Example.ORG/es/a?b#c", "http://example.org/es",
    "http://example.org/en/1", "http://example.org/en/12/3", "http://notexample.org/es/",
    "http://a.com/fr/x", "http://a.com/de/x", "http://com/de/", "http://a.com?x=/de/", "x://a.com#/fr/",
    "http://a.b://c.org/", "http://ÉX.org/", "http://KELVIN\u212a.org/\nx?", "http://..com/de/", "a:// /fr/",
]


def judged(spark, scratch, urls, rules=URL_RULES):
    rows = [(i, url, None, "clash", "clash", "clash") for i, url in enumerate(urls)]
    pages = spark.createDataFrame(rows, PAGES)
    found = url_cascade.judge(pages, url_cascade.rule_table(spark, rules), scratch).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}


def test_rules_by_their_definition(spark, scratch):
    found = judged(spark, scratch, URLS)
    assert found == {i: plain_verdict(url, URL_RULES) for i, url in enumerate(URLS)}


def test_long_lists_are_exact(spark, scratch):
    own = random.Random(1)
    hosts = [f"h{own.randrange(400)}.{own.choice(['net', 'org'])}" for _ in range(400)]
    rules = {(own.choice(["allow", "block"]), h, own.choice(["/", "/a/", "/a/b", ""])) for h in hosts}
    rules = list({(h, p): (v, h, p) for v, h, p in rules}.values())
    urls = [f"http://{own.choice(['', 'www.'])}h{own.randrange(600)}.{own.choice(['net', 'org'])}"
            f"{own.choice(['', '/', '/a/', '/a/bc', '/x'])}" for _ in range(3000)]  # fmt: skip
    found = judged(spark, scratch, urls, rules)
    assert found == {i: plain_verdict(url, rules) for i, url in enumerate(urls)}


def test_every_key_of_the_universe_is_answered_exactly(spark, scratch):
    listed = [f"l{i}" for i in range(300)]
    others = [f"o{i}" for i in range(20_000)]
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    cascade = url_cascade.build(frame(listed), frame(listed + others + others), scratch, "test")
    assert len(cascade.levels) > 2
    assert cascade.listed(listed).all() and not cascade.listed(others).any()
    assert sum(level.bits for level in cascade.levels[1:]) < 20 * len(listed)


def test_no_pages_and_no_rules(spark, scratch):
    assert judged(spark, scratch, []) == {}
    assert {v[2:] for v in judged(spark, scratch, URLS, []).values()} == {(None, "allow")}


# --- mixing -----------------------------------------------------------------------------------


def corpus(seed=1, sizes=(400, 60, 50, 7)):
    own = random.Random(seed)
    rows = []
    for s, n in enumerate(sizes):
        rows += [(len(rows) + i, "w " * own.randrange(1, 80), "en", f"s{s}") for i in range(n)]
    return rows


def mixture(documents, scratch, rows, **targets):
    frame = source_mix.prepared(documents(rows), ["doc_id"])
    return source_mix.mix(frame, scratch, **targets).select("row.doc_id", "*").collect()


def tokens(rows):
    out = {}
    for _, text, _, source in rows:
        out[source] = out.get(source, 0) + len((text or "").split())
    return out


def test_repetition_is_limited_and_nothing_left_out(documents, scratch):
    rows = corpus()
    found = mixture(documents, scratch, rows, repetition=2.0, block_tokens=200)
    own, got = tokens(rows), {}
    for r in found:
        got[r.source] = got.get(r.source, 0) + r.n_tokens
    assert {r.doc_id for r in found} == {row[0] for row in rows}
    assert got["s0"] == own["s0"]
    for source, n in own.items():
        assert n <= got[source] <= 2 * n + 80
    assert got["s3"] > 1.9 * own["s3"]  # the smallest source is at the limit
    assert got["s1"] / own["s1"] < got["s3"] / own["s3"]


def test_entropy_is_reached(documents, scratch):
    rows = corpus(2)
    found = mixture(documents, scratch, rows, repetition=None, entropy=1.0, budget=40_000, block_tokens=100)
    got = {}
    for r in found:
        got[r.source] = got.get(r.source, 0) + r.n_tokens
    total = sum(got.values())
    entropy = -sum(n / total * math.log(n / total) for n in got.values())
    assert abs(total - 40_000) < 200 and abs(entropy - 1.0) < 0.02


def test_passes_are_permutations_of_blocks(documents, scratch):
    rows = corpus(3)
    found = mixture(documents, scratch, rows, repetition=3.0, block_tokens=150)
    keys: dict[tuple, set] = {}
    for r in found:
        keys.setdefault((r["pass"], r.source, r.block), set()).add(r.block_key)
    assert all(len(k) == 1 for k in keys.values())
    order = lambda p: [b for _, b in sorted((min(k), b) for (q, s, b), k in keys.items()
                                            if (q, s) == (p, "s1"))]
    assert sorted(order(0)) != order(0) and order(0) != order(1)
    assert len({(r["pass"], r.doc_id) for r in found}) == len(found)


def test_the_layout_does_not_matter(documents, scratch):
    rows = corpus(4)
    frame = source_mix.prepared(documents(rows), ["doc_id"])
    one = source_mix.mix(frame.coalesce(1), scratch, block_tokens=100).drop("row").collect()
    scratch.path += "-2"
    two = source_mix.mix(frame.repartition(7), scratch, block_tokens=100).drop("row").collect()
    assert sorted(map(repr, one)) == sorted(map(repr, two))


def test_only_sql_functions_are_used(documents, scratch):
    frame = source_mix.prepared(documents(corpus()), ["doc_id", "text"])
    plan = source_mix.mix(frame, scratch)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_mix_of_odd_rows(documents, scratch):
    from .conftest import clashing, odd_rows

    frame = clashing(documents(odd_rows()))
    found = source_mix.mixed_documents(frame, scratch)
    assert found.columns == frame.columns
    rows = found.collect()
    seen = [r for r in rows if r.doc_id == 8]
    assert len(seen) >= 2 and {r.doc_id for r in rows} == {None, *range(12)}


def test_mix_of_nothing_and_of_no_tokens(documents, scratch):
    assert source_mix.mixed_documents(documents([]), scratch).count() == 0
    scratch.path += "-2"
    assert source_mix.mixed_documents(documents([None, "", " "]), scratch).count() == 3


def test_targets_are_either_or(documents, scratch):
    frame = source_mix.prepared(documents(["a"]), ["doc_id"])
    with pytest.raises(ValueError, match="either|give"):
        source_mix.mix(frame, scratch, repetition=None)
