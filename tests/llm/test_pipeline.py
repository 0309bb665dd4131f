"""The pipeline, its stages on odd rows, and the registered queries against SQL."""

from __future__ import annotations

import pytest
from conftest import SMALL

import corpus_pipeline
import verify
from settle.llm.common import table
from settle.llm.queries import QUERIES
from settle.llm.sql import SQL

from .conftest import clashing, odd_rows
from .test_groups import plain_exact, plain_near
from .test_texts import plain_counts


@pytest.fixture(scope="module")
def duck():
    return verify.oracle(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, duck, name):
    same, detail = verify.compare(spark, duck, SMALL, name, SQL[name])
    assert same, detail


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "jaccard_join", "source_mix", "byte_bpe"
    ]


def test_stages_by_brute_force(spark, scratch):
    """Each stage's decisions, one after the other, from the definitions."""
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    outputs = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        outputs[name] = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    before = {(r.doc_id, r.text) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()}
    good = set()
    for doc_id, text in before:
        n, _, _, _, repeated = plain_counts(text) if len(text) < 5000 else (99, 0, 0, 0, 0)
        if n >= 50 and 100 * repeated <= 50 * n:
            good.add((doc_id, text))
    assert outputs["quality_rules"] <= good and len(outputs["quality_rules"]) > 0.9 * len(good)
    firsts = {r[0] for r in plain_exact(outputs["quality_rules"]) if r[3]}
    assert {d for d, _ in outputs["exact_dedup"]} == firsts
    least = {d for d, _, component in plain_near(outputs["exact_dedup"]) if d == component}
    assert {d for d, _ in outputs["jaccard_join"]} == least
    assert outputs["source_mix"] == outputs["jaccard_join"]
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert final.count() == docs.count() > len(outputs["source_mix"])


def test_stages_survive_odd_rows(spark, documents):
    frame = clashing(documents(odd_rows()))
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, SMALL)
        if name != "byte_bpe":
            assert out.columns == frame.columns
        sizes[name] = out.count()
        assert stage(spark, documents([]), SMALL).count() == 0
    # no row has fifty words; three empty texts are one, and so are four equal ones
    assert sizes["quality_rules"] == 0
    assert sizes["exact_dedup"] == len(odd_rows()) - 2 - 3
    assert sizes["byte_bpe"] == len(odd_rows())


def test_quality_stage_keeps_clean_documents(spark, documents, prose):
    rows = [(i, prose(i, 100 + i), "en", "s") for i in range(80)]
    rows += [(None, prose(500, 150), "en", "s"), (3, "spam eggs " * 60, "en", "s")]
    out = corpus_pipeline.quality_rules(spark, documents(rows), SMALL).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted(
        [(False, i) for i in range(80)] + [(True, 0)]
    )


def test_near_duplicates_are_judged_by_their_own_text(spark, documents, prose):
    """Rows that repeat an id: one is a near copy of an earlier document, two are near copies."""
    a, b, c = prose(1, 90), prose(2, 90), prose(3, 90)
    rows = [(3, a), (5, a + " more"), (5, b), (7, c), (7, c + " more"), (9, c + " yet"), (None, a), (8, "")]
    out = corpus_pipeline.near_duplicates(spark, clashing(documents(rows)), SMALL).collect()
    found = sorted((r.doc_id or 0, r.text) for r in out)
    assert [r for r in found if r[0] != 7] == sorted([(0, a), (3, a), (5, b), (8, "")])
    assert len([r for r in found if r[0] == 7]) == 1
