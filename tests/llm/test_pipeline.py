"""The pipeline against what its stages do, one by one, on a small corpus."""

import re

import corpus_pipeline
from tests.llm.test_near_duplicates import brute
from tideline.llm import decontaminate, quality_classifier, secrets
from tideline.session import materialise


def steps(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    yield docs
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, data))
        yield docs


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_each_stage_decides_on_what_it_gets(spark):
    data = "/root/testdata/sf0.01"
    raw, good, single, clean, masked, mixed = steps(spark, data)
    assert [f.columns for f in (good, single, clean, masked)] == [raw.columns] * 4

    model = quality_classifier.fit(raw, spark.read.parquet(f"{data}/labels.parquet"))
    rows = raw.collect()
    scores = {r.doc_id: s for r, s in zip(rows, model.scores([r.text for r in rows]), strict=True)}
    assert ids(good) == {d for d, s in scores.items() if s >= quality_classifier.THRESHOLD}

    pairs = [(r.doc_id, r.text) for r in good.collect()]
    assert ids(single) == {c for _, c in brute(pairs)}

    items = spark.read.parquet(f"{data}/benchmark.parquet")
    leaks = {r.doc_id for r in decontaminate.find_matches(single, items).collect()}
    assert leaks and ids(clean) == ids(single) - leaks

    before = {r.doc_id: r for r in clean.collect()}
    limits = secrets.fit(clean)
    changed = 0
    for r in masked.collect():
        assert secrets.spans(r.text, limits) == [] and r.n_chars == len(r.text)
        assert re.sub(r"\[SECRET\]", "", r.text) == r.text or before[r.doc_id].text != r.text
        changed += r.text != before[r.doc_id].text
    assert changed and ids(masked) == ids(clean)

    taken = {}
    for r in mixed.collect():
        assert 0 < r.taken <= 3 * r["size"]
        taken[r.source] = (taken.get(r.source, (0, 0))[0] + r.taken, r.target)
    assert all(abs(t - target) < 1 for t, target in taken.values())


def test_run_is_its_stages(spark, data):
    *_, last = steps(spark, data)
    once = sorted(map(str, corpus_pipeline.run(spark, data).collect()))
    assert once and once == sorted(map(str, last.collect()))


def test_edges(spark, edges, nothing, data):
    for docs in (edges, nothing):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, data))
            assert name == "mixing" or docs.columns == columns
    assert docs.count() == 0
