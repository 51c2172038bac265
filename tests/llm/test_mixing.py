import random
import re

import pytest
from pyspark.sql import functions as F

from tideline.llm import mixing

DOCS = "doc_id bigint, source string, text string"


def shares(sizes, weights, limit):
    """Sharing out again and again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = {}, float(sum(sizes.values()))
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(full.values())
        out = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if out[s] > limit * sizes[s]]
        if not over:
            return full | out
        full |= {s: float(limit * sizes[s]) for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 40, 300, 2000, 9000]) for i in range(rng.randrange(1, 14))}
    sizes[None] = 17
    sizes["é"] = 3
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert found == pytest.approx(shares(sizes, mixing.WEIGHTS, mixing.LIMIT))


def documents(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(700):
        source = rng.choices(["hot", "b", "c", "d", None], [8, 4, 2, 1, 1])[0]
        n = rng.choice([0, 1, 3, 10, 30, 60, 200])
        rows.append((i, source, " ".join(rng.choice(["word", "x", "#### $$"]) for _ in range(n))))
    return rows + [(700, "b", None), (3, rows[3][1], rows[3][2]), (None, "c", "a b c"), (None, None, None)]


def test_budgets_are_met_to_the_word(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 20)
    rows = documents(1)
    size = lambda t: len(re.findall(mixing.WORD, t or ""))
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target = shares(sizes, mixing.WEIGHTS, mixing.LIMIT)
    found = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    taken = {}
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.epochs * r["size"] <= r.taken <= min(3, r.epochs + 1) * r["size"]
    assert all(target[s] - 1 - 1e-6 <= taken[s] <= target[s] + 1e-6 for s in sizes)
    # slices do not change what is taken, nor do reruns
    again = mixing.mix(spark.createDataFrame(rows[::-1], DOCS).repartition(7)).collect()
    monkeypatch.setattr(mixing, "SLICE_ROWS", 10**9)
    whole = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    plain = lambda x: sorted(map(str, x))
    assert plain(found) == plain(again) == plain(whole)


def test_an_id_with_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 50)
    rows = documents(2) + [(None, "hot", "a few words of it")] * 420 + [(9000, "b", "one two three")] * 60
    docs = spark.createDataFrame(rows, DOCS)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    # in the order of their keys the copies take words up to the budget, one of them in part
    hot = sorted(r.taken - r.epochs * r["size"] for r in found if r.doc_id is None and r.source == "hot")
    assert len(hot) == 420 and sum(0 < t < 5 for t in hot) <= 1
    size = lambda t: len(re.findall(mixing.WORD, t or ""))
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target, taken = shares(sizes, mixing.WEIGHTS, mixing.LIMIT), {}
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(target[s] - 1 - 1e-6 <= taken[s] <= target[s] + 1e-6 for s in sizes)
    monkeypatch.setattr(mixing, "SLICE_ROWS", 10**9)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(docs).collect()))


def test_slices_are_even_whatever_the_weights(spark):
    text = F.when(F.col("id") % 3 == 0, "#$#$#$").otherwise("plain words")
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    level = mixing.quality_level(F.col("text"))
    rows = docs.select(mixing.sampling_key(F.col("doc_id"), level).alias("key"), level.alias("level"))
    n = {r.level: r["count"] for r in rows.groupBy("level").count().collect()}
    assert set(n) == {1, mixing.LEVELS}
    below = sum(c * (1 - F.exp(-F.col("key") * (w / mixing.LEVELS))) for w, c in n.items()) / 20_000
    parts = [r["count"] for r in rows.groupBy(F.floor(below * 20).alias("s")).count().collect()]
    assert len(parts) == 20 and max(parts) < 1200 and min(parts) > 800


def test_better_documents_come_first(spark):
    level = F.when(F.col("id") % 2 == 0, 10).otherwise(2)
    rows = spark.range(20_000).select(level.alias("level"), mixing.sampling_key(F.col("id"), level).alias("key"))
    first = rows.orderBy("key").limit(1000).groupBy("level").count().collect()
    n = {r.level: r["count"] for r in first}
    assert 4 < n[10] / n[2] < 6.3


def test_main_path_has_no_python(spark, data):
    plan = mixing.mix(spark.read.parquet(f"{data}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_edges(edges, nothing):
    found = mixing.mix(edges).collect()
    assert len(found) == edges.count() and all(0 <= r.taken <= 3 * r["size"] for r in found)
    assert {r["size"] for r in found if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mix(nothing).count() == 0
