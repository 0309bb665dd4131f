"""Operators that compare documents: exact and near duplicates, repeated passages, components."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from settle.llm import bit_fields, components, exact_dedup, jaccard_join, substring_dedup

from .conftest import ODD, clashing, odd_rows

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


# --- exact duplicates -------------------------------------------------------------------------


def plain_exact(rows):
    groups: dict[str, list] = {}
    for doc_id, text in rows:
        groups.setdefault(SPACE.sub(" ", text or ""), []).append(doc_id)
    return {
        (doc_id, min(ids), len(ids), doc_id == min(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for doc_id in ids
    }


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("first_bytes", [1, 3, 64])
def test_exact_groups_by_brute_force(documents, scratch, first_bytes):
    own = random.Random(first_bytes)
    texts = ["".join(own.choice("ab \n") for _ in range(own.randrange(12))) for _ in range(300)]
    texts += ["é" * 70 + end for end in ("x", "y", "x", "", "  z", "\tz")]
    texts += ["p" * 500, "p" * 500, "p" * 501, None, ""]
    rows = list(enumerate(texts))
    own.shuffle(rows)
    found = exact_dedup.deduplicate(documents(rows), scratch, first_bytes).select(*COLUMNS)
    assert {tuple(r) for r in found.collect()} == plain_exact(rows)


def test_exact_of_odd_rows(documents, scratch):
    found = exact_dedup.deduplicate(clashing(documents(odd_rows())), scratch).collect()
    assert len(found) == len(odd_rows())
    same = [r for r in found if r.group_size == 4 and r.keep_id == 8]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.kept) for r in same) == [
        (False, 8, False), (False, 8, True), (False, 9, False), (True, 0, False)
    ]
    empty = [r for r in found if r.keep_id == 0]
    assert sorted(r.kept for r in empty) == [False, False, True]


def test_exact_of_nothing(documents, scratch):
    assert exact_dedup.deduplicate(documents([]), scratch).count() == 0


# --- near duplicates --------------------------------------------------------------------------


def shingle_set(text):
    words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
             for w in words_of(text)]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_near(rows):
    sets = {doc_id: shingle_set(text) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {(doc_id, len(s), root(doc_id)) for doc_id, s in sets.items()}


def near_corpus(seed, prose, passage=""):
    """Copies with edits of all sizes, chains of edits, and texts that only share a passage."""
    own = random.Random(seed)
    texts = []
    for group in range(12):
        base = prose(seed * 100 + group, own.choice([6, 30, 60, 90])).split()
        for _ in range(own.choice([1, 3, 9])):
            words = list(base)
            for _ in range(own.randrange(5)):
                at = own.randrange(len(words))
                words[at : at + 1] = own.choice([[], ["edit%d" % own.randrange(9)], [words[at].upper()]])
            texts.append(" ".join(words))
            if own.random() < 0.5:
                base = words or base  # a chain: far from the first, near to the last
    texts += [f"{prose(seed + i, 20 + i)} {passage} {prose(seed - i, 9)}" for i in range(40)]
    own.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("chunk", [1, 2, 64])
def test_near_components_by_brute_force(documents, scratch, prose, monkeypatch, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    rows = near_corpus(chunk, prose, prose(999, 40))
    found = jaccard_join.near_duplicates(documents(rows), scratch)
    assert {tuple(r) for r in found.collect()} == plain_near(rows)


def test_frequent_shingles_only_change_the_order(documents, scratch, prose, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 4)
    monkeypatch.setattr(jaccard_join, "LOCALLY_FREQUENT", 2)
    rows = near_corpus(7, prose, prose(998, 60))
    found = jaccard_join.near_duplicates(documents(rows), scratch)
    assert {tuple(r) for r in found.collect()} == plain_near(rows)


def test_full_fields_change_nothing(documents, scratch, prose, monkeypatch):
    for name in ("FREQUENT_BITS", "SHARED_BITS", "WANTED_BITS"):
        monkeypatch.setattr(jaccard_join, name, 6)
    rows = near_corpus(8, prose, prose(997, 30))
    found = jaccard_join.near_duplicates(documents(rows), scratch)
    assert {tuple(r) for r in found.collect()} == plain_near(rows)


def test_linked_sets_share_enough_of_their_signatures():
    own = np.random.default_rng(4)
    field = np.zeros(1, np.uint64)
    field |= own.integers(0, 2**63, 1, np.uint64)
    for _ in range(500):
        n = int(own.integers(1, 200))
        both = own.integers(0, 2**64, n, np.uint64)
        a = np.unique(np.concatenate([both, own.integers(0, 2**64, int(own.integers(0, n // 4 + 1)), np.uint64)]))
        b = np.unique(np.concatenate([both, own.integers(0, 2**64, int(own.integers(0, n // 4 + 1)), np.uint64)]))
        common, every = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * common < 80 * every:
            continue
        signed = [jaccard_join.signature(x, field) for x in (a, b)]
        shared = len(np.intersect1d(*signed))
        bases = [s[: jaccard_join.base_length(len(x))] for s, x in zip(signed, (a, b), strict=True)]
        assert len(np.intersect1d(*bases)) >= 1
        for x in (a, b):
            assert shared >= jaccard_join.least_shared(len(x))


def test_near_of_odd_rows(documents, scratch):
    found = jaccard_join.near_duplicates(clashing(documents(odd_rows())), scratch).collect()
    assert len(found) == len(odd_rows())
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert by_id[8] == by_id[9] == {(1, 8)}
    assert by_id[0] == {(0, 0)} and by_id[1] == {(0, 1)} and by_id[5] == {(1, 5)}
    assert by_id[None] == {(1, None), (0, None)}
    assert len(ODD) == 12


def test_near_of_nothing(documents, scratch):
    assert jaccard_join.near_duplicates(documents([]), scratch).count() == 0


# --- repeated passages ------------------------------------------------------------------------


def plain_repeats(rows, window=13):
    first: dict[tuple, int] = {}
    for doc_id, text in rows:
        words = words_of(text)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = set()
    for doc_id, text in rows:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < doc_id:
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.add((doc_id, len(words), len(gone), kept))
    return out


def passages(seed, prose):
    own = random.Random(seed)
    shared = [prose(seed * 50 + i, own.choice([12, 13, 14, 40])) for i in range(6)]
    texts = []
    for i in range(60):
        parts = [prose(seed * 1000 + i * 10 + k, own.randrange(12)) for k in range(3)]
        for _ in range(own.randrange(3)):
            parts.insert(own.randrange(len(parts) + 1), own.choice(shared))
        texts.append(own.choice([" ", "\n", " \t "]).join(parts))
    texts += [texts[5]] * 9 + [shared[3]] * 4 + ["again " * 40] * 3
    return list(enumerate(texts))


@pytest.mark.parametrize(("hot", "bits"), [(256, 26), (2, 26), (2, 6)])
def test_repeats_by_brute_force(documents, scratch, prose, monkeypatch, hot, bits):
    monkeypatch.setattr(substring_dedup, "HOT_DOCUMENTS", hot)
    monkeypatch.setattr(substring_dedup, "SHARED_BITS", bits)
    monkeypatch.setattr(substring_dedup, "HOT_PARTS", 3)
    rows = passages(hot + bits, prose)
    found = substring_dedup.remove_repeats(documents(rows).repartition(3), scratch)
    assert {tuple(r) for r in found.collect()} == plain_repeats(rows)


def test_equal_windows_have_equal_minimisers(prose):
    a, b = prose(1, 60).encode().split(), prose(2, 30).encode().split()
    own = substring_dedup.minimisers(a)
    moved = substring_dedup.minimisers(b + a)
    assert len(own) == 60 - 12 and (moved[30:] == own).all()
    first, end = substring_dedup.super_kmers(own)
    assert first[0] == 0 and end[-1] == len(own) and (first[1:] == end[:-1]).all()
    assert len(first) < len(own) / 2


def test_repeats_of_odd_rows(documents, scratch, prose):
    long = prose(3, 20)
    rows = [*odd_rows(), (100, long, "en", "s"), (100, long + " end", "en", "s"), (101, long, "en", "s"),
            (None, long, "en", "s"), (102, long, None, None), (102, long, None, None)]
    found = substring_dedup.remove_repeats(clashing(documents(rows)), scratch).collect()
    assert len(found) == len(rows)
    removed = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in found if r.n_words in (20, 21))
    assert removed == [(-1, 20, 0), (100, 20, 0), (100, 21, 0), (101, 20, 20), (102, 20, 20), (102, 20, 20)]


def test_repeats_of_nothing(documents, scratch):
    assert substring_dedup.remove_repeats(documents([]), scratch).count() == 0


# --- helpers ----------------------------------------------------------------------------------


def test_fields_hold_what_was_put_in(spark):
    own = np.random.default_rng(2)
    values = own.integers(-(2**63), 2**63 - 1, 500)
    frame = spark.createDataFrame([(int(v),) for v in values], "value long")
    field = bit_fields.field_of(frame, 20)
    assert bit_fields.in_field(field, values.view(np.uint64)).all()
    other = own.integers(0, 2**64, 5000, np.uint64)
    assert bit_fields.in_field(field, other).mean() < 0.01


@pytest.mark.parametrize(("seed", "few"), [(0, 0), (1, 100_000), (2, 0)])
def test_components_by_brute_force(spark, scratch, monkeypatch, seed, few):
    monkeypatch.setattr(components, "FEW", few)
    own = random.Random(seed)
    edges = [(own.randrange(60), own.randrange(60)) for _ in range(40)]
    edges += [(i, i + 1) for i in range(100, 140)] + [(500, j) for j in range(501, 520)] + [(7, 7)]
    label = {x: x for e in edges for x in e}
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.label for r in components.components(frame, scratch, "test").collect()}
    lonely = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: low for x, low in label.items() if x not in lonely}


@pytest.mark.parametrize("seed", range(4))
def test_far_links_join_what_plain_comparison_joins(seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "AT_A_TIME", 1 + 5 * seed)
    monkeypatch.setattr(jaccard_join, "LAID_OUT", 3 + 40 * seed)
    own = np.random.default_rng(seed)
    base = [np.unique(own.integers(0, 2**63, 60).astype(np.uint64)) for _ in range(3)]
    pivot = base[0]
    points = []
    for i in range(70):
        values = base[i % 3].copy()
        change = own.random(len(values)) < own.choice([0, 0.03, 0.08, 0.2])
        values[change] = own.integers(0, 2**63, int(change.sum())).astype(np.uint64)
        values = np.unique(values)
        away = 1 - len(np.intersect1d(values, pivot)) / len(np.union1d(values, pivot))
        points.append(jaccard_join.Point(i, int(own.integers(0, 40)), values, away))
    far = points[::2]
    parent = {p.label: p.label for p in points}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in far:
        for b in points:
            both = len(np.intersect1d(a.values, b.values))
            if 100 * both >= 80 * (len(a.values) + len(b.values) - both):
                parent[max(root(a.label), root(b.label))] = min(root(a.label), root(b.label))
    found = jaccard_join.far_links(far, points)
    assert len(found) < len(parent)
    got = {x: x for x in parent}
    for a, b in sorted(found, key=lambda p: p[1]):
        assert b < a
        got[a] = b
    assert got == {x: root(x) for x in parent}
    assert jaccard_join.far_links([], points) == jaccard_join.far_links(far, []) == set()
