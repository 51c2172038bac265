import base64
import gzip
import hashlib
import heapq
import random

import pytest

from tideline.llm import queries, warc

PAGES = "page_id bigint, url string, html string"
TRICKY = "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
ROWS = [
    (1, "http://www.B.example.com/x?q=1#top", TRICKY),
    (2, "http://b.example.com/x", TRICKY),
    (2, "http://b.example.com/x", TRICKY),
    (3, None, None),
    (4, "https://user@a.com:8080/ b\n", ""),
    (None, "x y", ""),
    (5, "http://a.com", "z" * 3_000_000),
    (-6, "http://a.com", "\x00\U0001f600"),
    (7, "", "\r\n\r\n"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    last = {}
    for p, _, h in rows:
        last[h or ""] = max((x for x in (last.get(h or ""), p) if x is not None), default=None)
    for p, _, h in rows:
        first = last[h or ""]
        kind = ("response", None) if p == first else ("revisit", first)
        yield (p, len((h or "").encode()), digest(h), *kind)


def plain(rows):
    return sorted(map(str, rows))


def found(frame):
    names = "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    return [tuple(r) for r in frame.select(*names).collect()]


@pytest.mark.parametrize("per_file", [2, 1000])
def test_round_trip(spark, per_file):
    pages = spark.createDataFrame(ROWS, PAGES).repartition(3)
    index = warc.archive_index(pages, records_per_file=per_file)
    assert plain(found(index)) == plain(expected(ROWS))


def test_joined_by_shuffle_it_is_the_same(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    assert plain(found(warc.archive_index(spark.createDataFrame(ROWS, PAGES)))) == plain(expected(ROWS))


def test_archive_is_warc_and_payloads_come_back(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write(spark.createDataFrame(ROWS, PAGES).repartition(2), path)
    payloads = {}
    for file in (tmp_path / "archive").glob("part-*"):
        data = file.read_bytes()
        raw = gzip.decompress(data)
        for offset, url, time, page, size, sha, kind, first, payload in warc.parse(data):
            assert raw[offset:].startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode())
            if kind == "response":
                payloads.setdefault(page, payload)
    assert {p: t.decode() for p, t in payloads.items()} == {
        p: h or "" for p, _, h in ROWS if (p, "response") in {(x[0], x[3]) for x in expected(ROWS)}
    }


def test_runs_are_sorted_and_merged_in_order(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f"http://h{rng.randrange(6)}.example.com/{rng.randrange(9)}", f"p{rng.randrange(150)}") for i in range(400)]
    rows += [(i, "http://hot.example.com/", f"q{i}") for i in range(400, 700)]
    path = str(tmp_path / "archive")
    warc.write(spark.createDataFrame(rows, PAGES).repartition(4), path, records_per_file=60)
    runs = warc.read_runs(spark, path)
    by_run = {}
    for r in sorted(runs.collect(), key=lambda r: (r.run, r.offset)):
        by_run.setdefault(r.run, []).append((r.key, r.time, r.page_id))
    assert len(by_run) > 8 and all(own == sorted(own) for own in by_run.values())
    merged = [(r.key, r.time, r.page_id) for r in warc.merge_runs(runs).collect()]
    assert merged == sorted(merged) and len(merged) == 700
    assert plain(found(warc.merge_runs(runs))) == plain(expected(rows))


def test_loser_tree_merges_as_heapq_does():
    rng = random.Random(2)
    for k in range(9):
        runs = [sorted(rng.randrange(30) for _ in range(rng.randrange(12))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == list(heapq.merge(*runs))


def test_damage_is_noticed():
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: x\r\nWARC-Target-URI: u\r\n"
    http = "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\n"
    text = f"{head}WARC-Payload-Digest: sha1:{digest('abc')}\r\nContent-Length: {len(http) + 3}\r\n\r\n{http}abc\r\n\r\n"
    assert len(list(warc.parse(gzip.compress(text.encode())))) == 1
    # members one after another are one archive
    assert len(list(warc.parse(gzip.compress(text.encode()) * 3))) == 3
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(text.replace("abc\r", "abd\r").encode())))
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(text[:-8].encode())))


def test_url_keys(spark):
    urls = [r.url for r in spark.createDataFrame(ROWS, PAGES).collect()]
    frame = spark.createDataFrame([(u,) for u in urls], "url string").select(warc.url_key(warc.F.col("url")))
    assert [r[0] for r in frame.collect()][:5] == [
        "com,example,b)/x?q=1",
        "com,example,b)/x",
        "com,example,b)/x",
        "",
        "com,a)/ b\n",
    ]


def test_registered_query_and_empty_table(spark, data):
    pages = [tuple(r) for r in spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").collect()]
    assert plain(found(queries.op5_warc(spark, data))) == plain(expected(pages))
    assert warc.archive_index(spark.createDataFrame([], PAGES)).count() == 0
