import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tideline.llm import importance

DOCS = "doc_id long, text string"


def features(text, run):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(words[i : i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]
    return words, [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute(rows, target, run=1):
    own, wanted = Counter(), Counter()
    for _, text in rows:
        own.update(features(text, run)[1])
    for text in target:
        wanted.update(features(text, run)[1])
    s_all, t_all = sum(own.values()) + 10_000, sum(wanted.values()) + 10_000
    out = []
    for key, text in rows:
        words, found = features(text, run)
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((own[b] + 1) * t_all))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(words), len(found), weight, score, None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for rank, r in enumerate(able[: 10 * len(able) // 100], 1):
        r[5] = rank
    return sorted(map(tuple, out), key=str)


def found(df):
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "naïve", "ŒUVRE", "x1", "don't", "Über", "a_b", "😀", *(f"w{i}" for i in range(50))]
    return [" ".join(rng.choices(words, k=rng.choice([0, 3, 19, 20, 25, 60]))) for _ in range(n)]


@pytest.mark.parametrize("run", [1, 2, 3])
def test_same_as_plain_counting(spark, run, monkeypatch):
    monkeypatch.setattr(importance, "HEAD", 15)
    rows = list(enumerate(texts(run, 300))) + [(None, texts(9, 1)[0]), (5000, None), (5001, "")]
    target = texts(77, 20)[:10]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    result = importance.resample(spark.createDataFrame(rows, DOCS).repartition(3), frame, run=run)
    assert found(result) == brute(rows, target, run)


def test_repeated_rows_have_ranks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(importance, "CHUNK", 7)
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text)] * 100 + [(None, text)] * 100 + [(i, t) for i, t in enumerate(texts(3, 200), 10)]
    target = [text]
    result = importance.resample(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(text,)], "text string"))
    expected = brute(rows, target)
    assert found(result) == expected
    assert sum(r[5] is not None for r in expected) > 7


def test_head_is_exact_for_any_table(spark):
    words = [w.encode() for w in ("the", "naïve", "of", "x")]
    head = importance.Vocabulary(words[:2], [(words[0], words[1])], 2, 10_000)
    plain = importance.Vocabulary([], [], 2, 10_000)
    assert head.features(words * 3).tolist() == plain.features(words * 3).tolist()
    assert plain.features(words).tolist() == [zlib.crc32(f.encode()) % 10_000 for f in ("the", "naïve", "of", "x", "the naïve", "naïve of", "of x")]


def test_edges(spark, edges, nothing):
    target = spark.createDataFrame([("the cat sat on the mat",), (None,)], "text string")
    out = importance.resample(edges, target, percent=50)
    assert out.count() == edges.count()
    assert [r["rank"] for r in out.where("rank is not null").collect()] == []  # one text is long enough, half of it none
    assert importance.resample(edges, target, percent=100).where("rank = 1").collect()[0].doc_id == 8
    assert importance.resample(nothing, target).collect() == []
    assert importance.resample(edges, target.limit(0)).count() == edges.count()
