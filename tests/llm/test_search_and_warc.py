"""Top-k search against all pairs; archives read back whole."""

import base64
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanewise.llm import inner_products, warc

VECTORS = "vec_id bigint, embedding array<float>, score int, rank string"


def vectors(seed, n=400, width=12):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = rng.choice([0.1, 1, 1, 3])
        rows.append((i, [rng.gauss(0, size) / (k + 1) for k in range(width)]))
    common = [0.5] * width
    rows += [(1000 + i, common) for i in range(120)]
    rows += [(2000, None), (2100, [math.nan] * width), (2200, [1.0, None]), (2300, [math.inf])]
    rows += [(2400, []), (2500, [1.0]), (2600, [3e38] * width), (None, common), (100, rows[100][1])]
    return rows


def long(score):
    return min(max(score, -(2**63)), 2**63 - 1)


def brute(rows, top):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        single = [float(x) for x in np.array(v, dtype="float32")]
        whole.append((i, [math.floor(1024 * x) for x in single]))
    out = []
    for q in sorted({i for i, _ in whole if i % 100 == 0}):
        own = min(v for i, v in whole if i == q)
        scored = sorted((-long(sum(a * b for a, b in zip(own, v))), i) for i, v in whole if i != q)
        out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:top])]
    return out


@pytest.mark.parametrize("seed,chunk", [(1, 1024), (2, 16)])
def test_top_inner_products(spark, seed, chunk, monkeypatch):
    monkeypatch.setattr(inner_products, "CHUNK_VECTORS", chunk)
    monkeypatch.setattr(inner_products, "BLOCK_QUERIES", 5)
    rows = vectors(seed)
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], VECTORS).repartition(4)
    whole = inner_products.integer_vectors(frame)
    found = inner_products.top_inner_products(whole, F.col("vec_id") % 100 == 0, 10)
    assert sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == brute(rows, 10)


def test_few_or_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0], 0, ""), (1, [2.0], 0, ""), (100, [1.5], 0, "")], VECTORS)
    asked = F.col("vec_id") % 100 == 0
    found = inner_products.top_inner_products(inner_products.integer_vectors(frame), asked).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(found)] == [(0, 1, 1), (0, 2, 100), (100, 1, 1), (100, 2, 0)]
    none = inner_products.integer_vectors(frame.limit(0))
    assert inner_products.top_inner_products(none, asked).count() == 0


def searched(spark, rows, top=10):
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], VECTORS).repartition(3)
    whole = inner_products.integer_vectors(frame)
    found = inner_products.top_inner_products(whole, F.col("vec_id") % 100 == 0, top)
    return sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("rows", [
    [(0, [1.0])],
    [(0, [1.0, 2.0]), (1, [0.5]), (2, [-1.0, 3.0])],
    [(1, [1.0]), (2, [2.0])],
    [(0, []), (100, [])],
])
def test_tables_of_one_vector_or_query(spark, rows):
    assert searched(spark, rows) == brute(rows, 10)


def test_blocks_of_one_query(spark, monkeypatch):
    monkeypatch.setattr(inner_products, "BLOCK_QUERIES", 1)
    rows = vectors(5, n=301)
    assert searched(spark, rows) == brute(rows, 10)


def test_tasks_without_a_candidate_left():
    ids, rows = np.arange(1, 21), np.ones((20, 3))
    none = [np.zeros(0, dtype=np.int64) for _ in range(3)]
    block = inner_products.Block(np.array([0]), np.full((1, 3), 5.0), np.eye(3), 1, np.array([15.5]))
    best = inner_products._search_sorted(ids, rows, block, none, 10)
    assert [len(x) for x in best] == [0, 0, 0]


@pytest.mark.parametrize("size", [2e5, 1e8, 1e12, 1e30, 3e38])
def test_large_components_keep_their_value(spark, size):
    rng = random.Random(int(size) % 997)
    rows = [(i, [rng.choice([0.0, 1.0, -1.0, rng.gauss(0, size / 10), 0.9 * size]) for _ in range(4)]) for i in range(120)]
    rows += [(0 + 1000, [200000.0]), (1001, [131072.0]), (1002, [300000.0]), (1100, [1.0, 1.0])]
    assert searched(spark, rows) == brute(rows, 10)


PAGES = "page_id bigint, url string, html string, n int, start int, file string"
FALSE = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 0\r\n\r\n\r\n\r\nWARC/1.1\r\n"


def pages(seed):
    rng = random.Random(seed)
    bodies = [None, "", "<p>é漢</p>", "WARC/1.1\r\n", FALSE, FALSE * 3, "\r\n", "\r\n\r\n", "x" * 70_000, "\n\r\r"]
    rows = [(i, rng.choice([None, "http://a/b", "http://a\r\nX: y"]), rng.choice(bodies)) for i in range(120)]
    # A whole record with a right digest inside a payload.
    inner = "<b>in</b>"
    digest = base64.b32encode(hashlib.sha1(inner.encode()).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Length: {len(inner)}\r\n\r\n{inner}"
    trap = (
        "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\n"
        f"WARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(http)}\r\n\r\n{http}\r\n\r\n"
    )
    rows += [(200, "u", trap + FALSE), (201, "u", trap * 2), (-5, "u", "<p>é漢</p>")]
    rows += [(300, "u", "only once"), (None, "u", "x" * 70_000), (-5, "u", "<p>é漢</p>"), (None, None, "no id")]
    return rows


def expected(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        at = first.get(html or "")
        shared = sum((h or "") == (html or "") for _, _, h in rows) > 1
        refers = at if shared and at is not None and at != i else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "response" if refers is None else "revisit", refers))
    return out


@pytest.mark.parametrize("file_bytes", [8_000_000, 200_000])
def test_archives_come_back(spark, file_bytes, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", file_bytes)
    rows = pages(1)
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], PAGES).repartition(3)
    folder = warc.archive_folder(spark)
    warc.write_archives(frame, folder)
    got = [tuple(r) for r in warc.read_archives(spark, folder).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected(rows)))
    whole = b"".join(r.content for r in spark.read.format("binaryFile").load(folder).collect())
    assert whole.count(b"WARC-Type") > len(rows)


def test_small_payloads_can_all_be_responses(spark):
    frame = spark.createDataFrame([(1, "u", "ab", 0, 0, ""), (2, "u", "ab", 0, 0, ""), (3, "u", "abc", 0, 0, ""), (4, "u", "abc", 0, 0, "")], PAGES)
    folder = warc.archive_folder(spark)
    warc.write_archives(frame, folder, min_revisit_bytes=3)
    got = {r.page_id: r.refers_to for r in warc.read_archives(spark, folder).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_no_pages(spark):
    folder = warc.archive_folder(spark)
    warc.write_archives(spark.createDataFrame([], PAGES), folder)
    assert warc.read_archives(spark, folder).count() == 0


def test_a_broken_payload_is_an_error(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "part-0.txt").write_bytes(record.encode())
    with pytest.raises(Exception, match="broken record"):
        warc.read_archives(spark, str(tmp_path)).collect()
