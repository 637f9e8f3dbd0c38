"""Every stage against a check of its own input, over a whole table with planted cases."""

import re

import pytest

import corpus_pipeline as P
from test_decontamination import brute as leaks
from test_near_dedup import brute as groups
from test_pii import brute as personal
from textmill.llm import toxicity

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def states(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(P.stored(stage(spark, out[-1], SMALL), name))
    return out


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns(states):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "benchmark_passages", "personal_data", "source_mix"]
    assert all(s.columns == states[0].columns for s in states[:-1])


def test_toxicity(spark, states):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in toxicity.report(states[0], labels).collect()}
    assert set(rows(states[1])) == {i for i, p in scores.items() if not p} and any(scores.values())


def test_near_duplicates(states):
    before = sorted((r.doc_id, r.text) for r in states[1].collect())
    assert sorted(rows(states[2])) == sorted(i for i, _, _, kept in groups(before, 5, 80) if kept)


def test_benchmark_passages(spark, states):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = leaks([(r.doc_id, r.text) for r in states[2].collect()], items)
    assert set(rows(states[3])) == {r[0] for r in found if not r[5]} and any(r[5] for r in found)


def test_personal_data(states):
    before, after = rows(states[3]), rows(states[4])
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.n_chars == len(r.text)
        spans = personal(before[i].text)
        assert all(before[i].text[s:e] not in r.text or k == "card" for s, e, k in spans)
        assert spans or re.search(r"\[(email|ip|card|phone)\]", r.text) or r.text == before[i].text


def test_source_mix(spark, states):
    before, after = rows(states[4]), rows(states[5])
    assert set(after) <= set(before) and all(0 < r.taken <= 2 * r.size for r in after.values())
    taken, target = {}, {}
    for r in after.values():
        assert r.text == before[r.doc_id].text
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in taken)


def test_run_is_the_stages(spark, states):
    assert sorted(map(repr, P.run(spark, SMALL).collect())) == sorted(map(repr, states[-1].collect()))
