"""Line dedup, runs of words and spelling variants against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import brute
from lanewise.llm import line_index, periodic_runs, spelling
from lanewise.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, k int, `first` string, payload map<string,int>"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(d, t, 1, "x", {"a": 1}) for d, t in rows], DOCS).repartition(parts)


def whole_documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


# --- lines ---


def odd_lines(seed):
    rng = random.Random(seed)
    lines = ["", " ", "short", "A Common Line here", " a common line HERE\t", "ÄÖÜ äöü ÄÖÜ", "äöü äöü äöü",
             "x" * 9, "y" * 10, "y" * 11, "éééééééééé", "ééééééééé", "tail\rinside a line", "\x0b\x0cvertical blanks\x0c", "漢字" * 5]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 6)))) for i in range(80)]
    rows += [(None, "A Common Line here\nA Common Line here"), (500, None), (501, ""), (502, "\n\n")]
    rows += [rows[3], rows[3], (3, "another text\nof document three"), (-4, "A Common Line here"), (-4, "y" * 10)]
    rows += [(600, "\n".join(f"line number {i}" for i in range(20_000))), (601, "line number 77\nline number 78\nnew line here")]
    return rows


@pytest.mark.parametrize("chunk_bytes,shard_keys,probes", [(8_000_000, 400_000, 1_000_000), (2_000, 100, 40)])
def test_lines_equal_brute(spark, monkeypatch, chunk_bytes, shard_keys, probes):
    monkeypatch.setattr(line_index, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(line_index, "SHARD_KEYS", shard_keys)
    monkeypatch.setattr(line_index.probe, "__defaults__", (probes,))
    rows = odd_lines(1)
    got = line_index.drop_repeated_lines(frame(spark, rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.line_dedup(rows)))


def test_no_lines(spark):
    assert line_index.drop_repeated_lines(frame(spark, [(1, "a")]).limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 5000])
def test_shards_are_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for _ in range(2))
    a[: n // 2] = 7  # keys that differ in one half only
    counts, firsts = rng.integers(1, 600, n), rng.integers(-9, 9, n)
    shard = line_index.Shard.load(line_index.Shard.build(a, b, counts, firsts).dump())
    slots = shard.find(a, b)
    assert sorted(slots.tolist()) == list(range(n))
    assert (shard.counts[slots] == np.minimum(counts, 255)).all()
    several = counts > 1
    assert (shard.firsts[shard.holder[slots[several]]] == firsts[several]).all()
    others = rng.integers(0, 2**63, 1000).astype(np.uint64)
    assert (shard.find(others, others) >= 0).sum() == 0


# --- runs ---


def random_words(rng):
    n, kinds = rng.choice([0, 1, 11, 12, 13, 40, 200]), rng.choice([1, 2, 3, 12])
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    if n > 20 and rng.random() < 0.7:
        a = rng.randrange(n - 5)
        p = rng.randint(1, (n - a) // 2)
        words[a:] = [words[a + (i - a) % p] for i in range(a, n)]
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_equal_brute(spark, monkeypatch, seed):
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 700)
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 50)
    monkeypatch.setattr(periodic_runs, "LONG_WORDS", 100)
    rng = random.Random(seed)
    texts = [" ".join(random_words(rng)) for _ in range(150)]
    # Fibonacci words have runs at many periods; squares within squares.
    a, b = ["x"], ["x", "y"]
    while len(b) < 300:
        a, b = b, b + a
    texts += [" ".join(b), "a " * 3000, "é\t  é\n  " * 20, "a b " * 5 + "a", "a a b " * 9 + "c " * 30]
    rows = [*enumerate(texts), (None, "x " * 12), (5, None), (5, texts[5]), (-1, "x " * 11), (-2, "")]
    got = periodic_runs.collapse_runs(frame(spark, rows)).collect()
    expected = []
    for d, t in rows:
        words = brute.WORD.findall(t or "")
        found = brute.runs(words)
        expected.append((d, len(words), found, brute.collapsed(words, found)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in got]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_no_runs(spark):
    assert periodic_runs.collapse_runs(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_runs_query(spark):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    docs = [d for d in whole_documents(spark) if len(d[1] or "") < 6000]
    assert len(docs) > 500
    for d, t in docs:
        words = brute.WORD.findall(t or "")
        h = zlib.crc32(str(d).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute.runs(words)
        r = got[d]
        assert r.n_runs == len(found)
        assert r.runs_sha256 == brute.sha("".join(f"{s},{n},{p}\n" for s, n, p in found))
        assert r.collapsed_sha256 == brute.sha(brute.collapsed(words, found))
        if found:
            s, n, p = min(found, key=lambda x: (-x[1], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, n, p, 1000 * n // p)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4


# --- words ---


def near_words(seed):
    rng = random.Random(seed)
    words = {"".join(rng.choices("eatzé", k=rng.randint(1, 7))) for _ in range(400)}
    words |= {"e" * n for n in range(1, 40)} | {"e" * 20 + "q" * n for n in range(12, 20)}
    # The same letters in every order; words longer than what is compared as arrays.
    words |= {"".join(rng.sample("abcdefg", 7)) for _ in range(100)}
    long = "".join(rng.choices("eatz", k=300))
    words |= {long, long[:200] + long[201:], "q" + long, long[:-1] + "ü", long[:100] + "漢" + long[101:]}
    words |= {"x" * spelling.WIDTH, "x" * (spelling.WIDTH + 1), "x" * (spelling.WIDTH - 1) + "y"}
    return {w: rng.choice([1, 2, 3, 5, 9, 20, 50, 100]) for w in words}


@pytest.mark.parametrize("node_words,shard_words", [(20_000, 20_000), (15, 60)])
def test_variants_equal_brute(spark, monkeypatch, node_words, shard_words):
    monkeypatch.setattr(spelling, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(spelling, "BLOCK", 64)
    counts = near_words(1)
    words = spark.createDataFrame([(w, n, 1, "x") for w, n in counts.items()], "word string, n bigint, node int, path string")
    got = spelling.variants(words, node_words=node_words).collect()
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got]
    assert sorted(map(str, got)) == sorted(map(str, brute.spelling_variants(counts)))
    assert any(w != f != r for w, f, r, *_ in got if f) and max(x[4] for x in got) > 5


def test_no_words(spark):
    words = spelling.word_counts(frame(spark, [(1, None), (2, ""), (None, "12 ..")]))
    assert spelling.variants(words).count() == 0
    assert spelling.variants(spelling.word_counts(frame(spark, [(1, "a")]).limit(0))).count() == 0


def test_word_counts(spark):
    rows = [(1, "Hello hello ÀÉhello×÷ hell"), (None, "HELLO l'hello İhello"), (1, "Hello " * 3), (2, "x" * 70_000)]
    got = {r.word: r.n for r in spelling.word_counts(frame(spark, rows)).collect()}
    assert got == {"hello": 8, "ÀÉhello×÷": 1, "x" * 70_000: 1}


def test_words_query(spark):
    counts = Counter()
    for d, t in whole_documents(spark):
        for w in spelling.LETTERS.findall(t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{d}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in QUERIES["op12_spelling_variants"](spark, SF_DIR).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute.spelling_variants(counts)))
