import random
import re
from collections import Counter

import numpy as np
import pytest

from tideline.llm import decontaminate, queries, tokens
from tideline.llm.decontaminate import HammingIndex, fingerprints, signs

ITEMS = "item_id bigint, text string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def counts(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(docs, items, least=0.8):
    """Best similarity of every document and item, over every window of the item's size."""
    out = {}
    for n, (d, text) in enumerate(docs):
        w = words(text)
        for i, item in items:
            v = words(item)
            k = min(5, len(v))
            if not k:
                continue
            want, best = counts(v, k), 0.0
            for s in range(max(1, len(w) - len(v) + 1)):
                seen = counts(w[s : s + len(v)], k)
                shared = (seen & want).total()
                best = max(best, shared / (seen.total() + want.total() - shared) if shared else 0.0)
            if best >= least:
                out[n, d, i] = best
    return out


def test_index_finds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.zeros(200, np.uint64)
    for i in range(200):
        for bit in rng.choice(64, i % 30, replace=False):
            flips[i] |= np.uint64(1) << np.uint64(bit)
    asked = base[np.arange(200) % 40] ^ flips
    q, p, d = HammingIndex(base).search(asked)
    mine = set(zip(q.tolist(), p.tolist(), d.tolist(), strict=True))
    every = np.bitwise_count(asked[:, None] ^ base[None, :])
    near = np.argwhere(every <= decontaminate.RADIUS)
    assert mine == {(int(a), int(b), int(every[a, b])) for a, b in near}


def test_similar_windows_lie_within_the_radius():
    rng = random.Random(2)
    far = 0
    for _ in range(300):
        a = [rng.getrandbits(64) for _ in range(36)]
        b = a[4:] + [rng.getrandbits(64) for _ in range(4)]
        x, y = (fingerprints(signs(np.array(s, np.uint64)).sum(0, keepdims=True))[0] for s in (a, b))
        far += int(np.bitwise_count(x ^ y)) > decontaminate.RADIUS
    assert far == 0


def test_matches_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    phrase = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(phrase(rng.choice([1, 3, 4, 5, 9, 30, 30, 41])))) for i in range(25)]
    items += [(25, items[5][1]), (26, None), (27, "..."), (None, " ".join(phrase(20)))]
    docs = []
    for d in range(120):
        w = phrase(rng.randrange(0, 120))
        for _ in range(rng.randrange(3)):
            item = words(rng.choice(items)[1])
            for _ in range(rng.randrange(3)):
                if item:
                    item[rng.randrange(len(item))] = rng.choice(vocabulary)
            at = rng.randrange(len(w) + 1)
            w[at:at] = item
        docs.append((d, " ".join(w)))
    docs += [(200, None), (201, ""), (None, items[10][1]), (7, docs[7][1]), (202, items[6][1].upper() + "!")]
    found = decontaminate.find_matches(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEMS)
    ).collect()
    expected = brute(docs, items)
    mine = Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in found)
    assert mine == Counter((d, i, round(s, 9)) for (_, d, i), s in expected.items())
    assert len(expected) > 30


def test_registered_query_matches_brute_force(spark, data):
    rows = queries.op2_decontaminate(spark, data).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    # windows that share nothing cannot match, so only documents with a shared shingle are tried
    known = {s for _, t in items for s in counts(words(t), 5)}
    near = [(d, t) for d, t in docs if known & set(counts(words(t), 5))]
    assert {(r.doc_id, r.item_id) for r in rows} == {(d, i) for _, d, i in brute(near, items)}
    assert rows


def test_contaminated_documents_go_whole_rows_stay(spark, docs_of, edges, nothing):
    items = spark.createDataFrame([(1, "sat on the mat and it was not the only"), (2, None)], ITEMS)
    kept = decontaminate.drop_contaminated(edges, items)
    assert kept.columns == edges.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "7", "8", "9", "None"]
    assert decontaminate.drop_contaminated(nothing, items).count() == 0
    assert decontaminate.find_matches(nothing, items).count() == 0
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.find_matches(edges, none).count() == 0
    assert decontaminate.drop_contaminated(edges, none).count() == edges.count()


@pytest.mark.parametrize("blocks", [1, 3])
def test_items_in_blocks_give_the_same(spark, data, monkeypatch, blocks):
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", -(-items.count() // blocks))
    rows = decontaminate.find_matches(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {
        (r.doc_id, r.item_id) for r in queries.op2_decontaminate(spark, data).collect()
    }


def test_short_texts_have_no_window_beyond_their_end():
    hashes, bounds = tokens.words(["a b c"])
    assert tokens.shingles(hashes, bounds, 5)[1].tolist() == [0, 0]
