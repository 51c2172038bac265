import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tideline.llm import spelling


def brute_counts(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x7f" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return counts


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    kept = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    others = {w: [o for o in kept if near(w, o)] for w in kept}
    form = {}
    for w, found in others.items():
        best = min(found, key=lambda o: (-kept[o], o), default=None)
        form[w] = best if best and kept[best] >= 2 * kept[w] else None
    out = []
    for w in kept:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, kept[w], len(others[w]), kept[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_same_as_all_pairs(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choices("abÀé", k=rng.randint(4, 8))): rng.choice([1, 2, 3, 4, 7, 30, 200]) for _ in range(500)}
    counted = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = brute(words)
    assert rows_of(spelling.group_variants(counted)) == expected
    assert any(r[2] not in (r[0], r[1]) for r in expected)
    # filters of a few blocks a pass, so lengths are split by hash
    assert rows_of(spelling.group_variants(counted, filter_bytes=256)) == expected


def test_counts_whole_texts(spark, docs_of, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(60).collect()
    rows = [(r.doc_id, r.text) for r in docs]
    counts = brute_counts(rows)
    found = spelling.count_words(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.word: r.n for r in found.collect()} == counts


def test_filters_have_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(1)
    h = spelling.mix(rng.integers(0, 1 << 62, 20_000).astype(np.uint64))
    f = spelling.Filter(spelling.blocks_for(10_000), 0, 1)
    at, mask = f.bits_of(h[:10_000])
    np.bitwise_or.at(f.bits, at, mask)
    assert len(f.hits(h[:10_000])) == 10_000
    assert len(f.hits(h[10_000:])) < 100


def test_edits_hash_like_the_words_they_make():
    words = ["hello", "aabbb", "éaÀzz"]
    letters = np.array(sorted({ord(c) for w in words for c in w}), np.uint32)
    points = np.concatenate([p for _, p in spelling._by_length(words)])
    made = set()
    for hashes, row, place, letter in spelling.edits(points, letters, True, True):
        texts = [
            words[r][:p] + (chr(letters[c]) if c >= 0 else "") + words[r][p + 1 :]
            for r, p, c in zip(row.tolist(), place.tolist(), letter.tolist())
        ]
        assert (spelling.word_hashes(texts) == hashes).all()
        assert len(set(zip(row.tolist(), texts))) == len(texts)
        made |= set(zip(row.tolist(), texts))
    assert (0, "helo") in made and (1, "abbb") in made and (0, "hollo") in made and (0, "hallo") not in made


def test_passes_keep_to_the_budget():
    counts = {5: 10, 6: 100_000, 7: 3_000_000, 8: 20}
    for chosen in spelling.passes(counts, 1 << 20):
        used = sum(spelling.blocks_for(-(-counts[n] // parts)) * 64 for n, _, parts in chosen)
        assert used <= (1 << 20) + 64 * len(chosen)
    assert sorted({n for p in spelling.passes(counts, 1 << 20) for n, _, _ in p}) == [5, 6, 7, 8]


def test_edges(spark, edges, nothing):
    assert spelling.group_variants(spelling.count_words(nothing)).collect() == []
    counted = spelling.count_words(edges)
    assert {r.word: r.n for r in counted.collect()}["the"] == 9
    # repeated words and a very long one, three times each
    long = "ab" * 30_000
    rows = [(1, f"{long} {long} {long} {long}c {long}c {long}c"), (2, "Hello " * 9 + "hallo hallo hallo")]
    found = {r.word: r for r in spelling.group_variants(spelling.count_words(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert found["hallo"].form == "hello" and found["hallo"].form_n >= 8
    assert found[long].n_near == 1 and found[long].form is None and found[long].root == long
