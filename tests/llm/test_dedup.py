"""Near and substring dedup against all pairs and all windows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from lanewise.llm import golay, graph, packed, simhash, substrings

DOCS = "doc_id bigint, text string, key string, kept int, n_chars bigint"


def frame_of(spark, rows, parts=4):
    wide = [(d, t, "x", 3, len(t or "")) for d, t in rows]
    return spark.createDataFrame(wide, DOCS).repartition(parts)


def test_golay_words_are_within_three_bits_of_their_codeword():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 500)
    near = golay.nearby(words)
    assert max(len(set(row)) for row in near.tolist()) == 6
    for bit in range(23):
        flipped = golay.nearest(words ^ (1 << bit)).tolist()
        assert all(a in row for a, row in zip(flipped, near.tolist(), strict=True))


def near_prints(seed):
    """Chains and clouds of fingerprints, and strangers."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(200)]
    for _ in range(12):
        word = rng.getrandbits(64)
        for _ in range(12):
            out.append(word)
            word ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
    center = rng.getrandbits(64)
    out += [center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(300)]
    # Far from the center in one segment only, so that they share its keys.
    out += [center ^ (rng.getrandbits(21) << 43) for _ in range(200)]
    return sorted(set(out) | {0, 1, 3, (1 << 64) - 1})


@pytest.mark.parametrize("seed,key_fingerprints", [(1, 40), (2, 3), (3, 1)])
def test_links_connect_what_all_pairs_connect(spark, seed, key_fingerprints):
    prints = near_prints(seed)
    signed = [p - (p >> 63 << 64) for p in prints]
    distinct = spark.createDataFrame([(s,) for s in signed], "bits bigint")
    links = [(r.a, r.b) for r in simhash.near_links(distinct, key_fingerprints).collect()]
    assert all(0 < ((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in links)
    found = graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    root = {r.node: r.root for r in found}
    assert len(root) == len(found)
    expected = brute.linked(prints)
    least = {}
    for s, r in zip(signed, expected, strict=True):
        least[r] = min(least.get(r, s), s)
    for s, r in zip(signed, expected, strict=True):
        assert root.get(s, s) == least[r]


def test_components(spark):
    path = [(i, i + 1) for i in range(150)] + [(500, i) for i in range(501, 700)]
    links = spark.createDataFrame([*path, (7, 7), (None, 3), (900, 899)], "a bigint, b bigint")
    root = {r.node: r.root for r in graph.components(links).collect()}
    assert {root[i] for i in range(151)} == {0}
    assert {root[i] for i in range(500, 700)} == {500}
    assert root[900] == 899 and len(root) == 151 + 200 + 2
    assert graph.components(links.limit(0)).count() == 0


def near_documents(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("aBcdé") for _ in range(3)) for _ in range(400)]
    rows = [(None, "a b c"), (5, None), (6, ""), (7, "   \n"), (8, "One"), (9, "one two"), (9, "one two")]
    for i in range(40):
        words = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            words[rng.randrange(400)] = "zz"
        rows.append((10 + i, rng.choice([" ", "\t\n"]).join(words)))
    for i in range(30):
        rows.append((100 + i, " ".join(rng.choice(base) for _ in range(rng.randint(1, 60)))))
    return rows


def test_near_duplicates(spark):
    rows = near_documents(4)
    got = simhash.near_duplicates(frame_of(spark, rows))
    plain = brute.near_duplicates(rows)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain))
    assert simhash.near_duplicates(frame_of(spark, [])).count() == 0
    kept = simhash.keep_first(frame_of(spark, rows))
    assert kept.columns == ["doc_id", "text", "key", "kept", "n_chars"]
    firsts = {c for _, _, c in plain if c is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(firsts)


def repeating_documents(seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = [(None, " ".join(passage)), (3, None), (4, ""), (5, " ".join(["again"] * 200))]
    rows += [(6, " ".join(["again"] * 90)), (7, " ".join(passage)), (7, "x " + " ".join(passage))]
    for i in range(60):
        words = [rng.choice("ab") if rng.random() < 0.5 else f"u{rng.random()}" for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            at, n = rng.randrange(50), rng.choice([5, 12, 13, 14, 40])
            cut = rng.randint(0, len(words))
            words[cut:cut] = passage[at : at + n]
        rows.append((rng.randint(0, 90), rng.choice([" ", "\n"]).join(words)))
    ab = ["".join(rng.choice("ab") for _ in range(1)) for _ in range(3000)]
    rows += [(200 + i, " ".join(ab[rng.randrange(2000):][: rng.randint(10, 900)])) for i in range(12)]
    return rows + rows[-3:] + rows[7:9]


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(spark, seed, monkeypatch):
    rows = repeating_documents(seed)
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 6000)
    monkeypatch.setattr(substrings, "RANGE_BYTES", 9000)
    monkeypatch.setattr(substrings, "GROUP_BYTES", 7000)
    got = substrings.repeats_removed(frame_of(spark, rows, 5)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.substring_dedup(rows)))


def test_wide_hashes_settle_what_narrow_ones_cannot(monkeypatch):
    """Hashes of four bits collide all the time, pairs of hashes do not."""
    honest = substrings._edge_hashes

    def poor(hashed, wide):
        part, narrow, *rest = honest(hashed, wide)
        return [part, narrow & np.uint64(15), *rest]

    monkeypatch.setattr(substrings, "_edge_hashes", poor)
    texts = [" ".join(f"{c}{i}" for i in range(400)).encode() for c in "wv"]
    docs = [(n, 10 * n, packed.hash_words([text])[0]) for n, text in enumerate(texts)]
    marks = [
        [kind for _, kind, _ in substrings._chunk_rows(docs, 4, 1, wide)].count(substrings.LOCAL)
        for wide in (False, True)
    ]
    assert marks == [1, 0]


def test_false_marks_are_noticed(spark, monkeypatch):
    """Where a mark's source says something else, the narrow result is not used."""
    rows = [(1, " ".join(f"a{i}" for i in range(40))), (2, " ".join(f"b{i}" for i in range(40)))]
    honest, asked = substrings._repeated_edges, []

    def lying(documents, ranges, groups, wide):
        asked.append(wide)
        marks = honest(documents, ranges, groups, wide)
        if wide:
            return marks
        one, two = [np.array([substrings.text_key(t.encode())]) for _, t in rows]
        zero = np.zeros(1, dtype=np.int64)
        false = [zero + 2, two, zero + 5, zero + 1, one, zero + 7, zero + 9]
        rows_of = [(g, substrings.LOCAL, bytearray(p)) for g, p in substrings._pack_marks(false, groups)]
        return marks.unionByName(spark.createDataFrame(rows_of, substrings.ROW))

    monkeypatch.setattr(substrings, "_repeated_edges", lying)
    got = substrings.repeats_removed(frame_of(spark, rows)).collect()
    assert asked == [False, True]
    assert sorted(map(tuple, got)) == brute.substring_dedup(rows)


def test_edges_branch_where_nodes_have_several_neighbours(spark):
    """Passages that share their middle: paths end where an edge leaves or enters besides."""
    middle = [f"m{i}" for i in range(20)]
    start, end = [[f"{c}{i}" for i in range(20)] for c in "se"]
    texts = [start + middle + end, start + middle + end, middle + ["z"] * 3, ["other"] + middle + end]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    frame = frame_of(spark, rows).select("doc_id", "text")
    marks = substrings._repeated_edges(frame, 1, 1, False).persist()
    assert substrings._branching_edges(marks).count() == 0
    more = frame_of(spark, [*rows, (9, " ".join(["q"] * 13 + middle)), (10, " ".join(["q"] * 13 + middle))])
    marks = substrings._repeated_edges(more.select("doc_id", "text"), 1, 1, False).persist()
    pairs = {(r.a, r.b) for r in substrings._branching_edges(marks).collect()}
    # Into the middle's first node come the passage's start and the run of q.
    assert len(pairs) == 2 and len({b for _, b in pairs}) == 1
    paths = substrings._paths(marks, substrings._branching_edges(marks), 1)
    spans = [packed.unpack(r.payload) for r in paths.filter(F.col("kind") == substrings.SPANS).collect()]
    lengths = sorted(zip(*[c.tolist() for c in (spans[0][0], spans[0][2], spans[0][6])], strict=True))
    # Document 1 repeats 48 windows: 20 up to the one before the middle's first, then 28.
    assert [x for x in lengths if x[0] == 1] == [(1, 0, 20), (1, 20, 28)]


def test_documents_without_their_repeats(spark):
    rows = [(1, "a\tb  " + " ".join(f"p{i}" for i in range(20))), (2, " ".join(f"p{i}" for i in range(20)))]
    rows += [(3, "own  words " + " ".join(f"p{i}" for i in range(14)) + "\nend"), (None, "p " * 20), (4, None)]
    kept = substrings.remove_repeats(frame_of(spark, rows))
    assert kept.columns == ["doc_id", "text", "key", "kept", "n_chars"]
    got = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert got[1][0] == rows[0][1] and got[2] == ("", 0) and got[4] == (None, 0)
    assert got[3] == ("own words end", 13) and got[None][0] == "p " * 20
    assert substrings.remove_repeats(frame_of(spark, [])).count() == 0
