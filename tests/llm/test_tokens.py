"""BPE coding and packing against the tokenizer library."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lanewise.llm import bpe, packing
from lanewise.llm.queries import BYTE_BPE, BYTE_RANKS, WORD_BPE, vocabulary

ODD = [
    "a", "b", "ab", "É", "e\u0301", "\u0301", " ", "  ", "\n", "\t", "\x0b", "\u00a0", "\u3000",
    "\u0085", "\x1c", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "Σ", "ß",
    "İ", "1", "٣", "!", "|", "漢字", "\U0001f600", "\u200d", "\0", "ﬁ", "가", "ᄀ", "ᅡ", "²",
]


def odd_texts(n, seed, most=300):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return {name: Tokenizer.from_file(vocabulary(name)) for name in (WORD_BPE, BYTE_BPE)}


def test_spliced_ids_are_the_librarys(library):
    coder, tokenizer = bpe.Coder(vocabulary(WORD_BPE)), library[WORD_BPE]
    passage = " ".join(odd_texts(30, 9))
    texts = odd_texts(600, 1) + [passage, "x " + passage, passage * 3, "", "é" * 5000, " " * 3000]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        n, got, tokens = coder.encode(text)
        assert (n, got.decode(), tokens.decode()) == (len(ids), " ".join(map(str, ids)), decoded)


def test_shared_passages_are_cut_alike():
    passage = " ".join(odd_texts(200, 3)).encode()
    one, two = bpe.content_cuts(passage), bpe.content_cuts(b"other start " + passage)
    inner = {c + 12 for c in one[1:-1]}
    assert len(inner) > 5 and inner <= set(two)


def test_a_join_that_does_not_agree_takes_the_whole_text(monkeypatch):
    coder = bpe.Coder(vocabulary(WORD_BPE))
    text = " ".join(f"word{i}" for i in range(2000))
    monkeypatch.setattr(coder, "_agrees", lambda *_: False)
    assert coder.encode(text) == coder._directly(text.encode())


def test_memory_keeps_two_generations():
    made = []
    memory = bpe.Memory(lambda k: made.append(k) or k * 2, 3)
    assert [memory[k] for k in (1, 2, 3, 4, 1, 4)] == [2, 4, 6, 8, 2, 8]
    assert made == [1, 2, 3, 4]


DOCS = "doc_id bigint, text string, ids string, n_tokens int, row int, length string"


def rows_of(texts):
    return [(i, t, "x", 1, 2, "y") for i, t in enumerate(texts)]


def test_documents_are_coded(spark, library):
    texts = [None, "", *odd_texts(20, 4), "same text", "same text"]
    frame = spark.createDataFrame(rows_of(texts) + [(None, "a b", "x", 1, 2, "y")], DOCS)
    got = {r.doc_id: r for r in bpe.encode_documents(frame, vocabulary(WORD_BPE)).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate(texts):
        ids = library[WORD_BPE].encode(text or "", add_special_tokens=False).ids
        assert got[i].ids == " ".join(map(str, ids)) and got[i].n_tokens == len(ids)
        assert got[i].decoded == library[WORD_BPE].decode(ids, skip_special_tokens=False)
    assert bpe.encode_documents(frame.limit(0), vocabulary(WORD_BPE)).count() == 0


def test_fast_and_slow_encoders_agree():
    fast = packing._encoder(vocabulary(BYTE_BPE), vocabulary(BYTE_RANKS))
    slow = packing._encoder(vocabulary(BYTE_BPE), None)
    for text in odd_texts(500, 2) + ["a" * 3000, " " * 3000, "x" * (packing.LONG_TEXT + 5)]:
        assert fast(text).tolist() == slow(text).tolist()


@pytest.mark.parametrize("length", [1, 1023, 1024, 1025, 2048, 5000])
def test_cuts(length):
    pieces = packing.cut(length)
    assert sum(n for _, n in pieces) == length
    assert all(n == 1024 for _, n in pieces[1:]) and pieces[0][1] <= 1024
    assert [s for s, _ in pieces] == np.cumsum([0] + [n for _, n in pieces[:-1]]).tolist()


@pytest.mark.parametrize("seed", range(6))
def test_bins_hold_everything_once(seed):
    rng = random.Random(seed)
    kind = [(1, 1023), (300, 600), (513, 513), (1, 20), (340, 345), (100, 520)][seed]
    lengths = [rng.randint(*kind) for _ in range(800)]
    bins = packing.pack_lengths(lengths)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    fills = [sum(lengths[i] for i in b) for b in bins]
    assert max(fills) <= 1024
    assert len(bins) >= -(-sum(lengths) // 1024)


def test_local_search_empties_bins():
    """1 moves beside 8 and 3, 4 changes places with 2, and 2 moves beside 5 and 5."""
    search = packing.Bins([4, 1, 8, 3, 8, 2, 5, 5], 12)
    for members in ({0, 1}, {2, 3}, {4, 5}, {6, 7}):
        search.members.append(set(members))
        search.fill.append(sum(search.lengths[i] for i in members))
    search.search()
    assert search.members == [set(), {1, 2, 3}, {0, 4}, {5, 6, 7}]


def test_two_change_places_with_one():
    search = packing.Bins([3, 4, 6, 5, 12], 12)
    for members in ({0, 1}, {2, 3}):
        search.members.append(set(members))
        search.fill.append(sum(search.lengths[i] for i in members))
    search.index(1)
    assert search.improve(0)
    assert search.members == [{2}, {0, 1, 3}]


def bins_of(capacity, *bins):
    search = packing.Bins([size for b in bins for size in b], capacity)
    for b in bins:
        first = sum(map(len, search.members))
        search.members.append(set(range(first, first + len(b))))
        search.fill.append(sum(b))
    return search


def test_any_two_change_places_with_one():
    """5 and 2, not neighbours by length, against 6."""
    search = bins_of(12, [5, 3, 2], [6, 5])
    search.index(1)
    assert search.improve(0)
    assert search.members == [{1, 3}, {0, 2, 4}]
    assert search.fill == [9, 12]


def steps_left(search, capacity):
    """Steps of the neighbourhood that would make the sum of squared fills grow."""
    bins = [[search.lengths[i] for i in b] for b in search.members if b]
    found = []
    for s, source in enumerate(bins):
        given = {(a,) for a in source} | set(itertools.combinations(source, 2))
        for t, target in enumerate(bins):
            for out in given if s != t else ():
                for back in [0, *target] if len(out) == 1 else target:
                    gain = sum(out) - back
                    full = sum(target) + gain
                    if gain > 0 and sum(source) < full <= capacity:
                        found.append((source, target, out, back))
    return found


@pytest.mark.parametrize("seed", range(40))
def test_local_search_ends_when_no_step_is_left(seed):
    rng = random.Random(seed)
    capacity = rng.choice([12, 40, 100])
    lengths = [rng.randint(capacity // 5, capacity * 3 // 5) for _ in range(rng.randint(5, 60))]
    search = packing.Bins(lengths, capacity)
    search.best_fit()
    search.search()
    assert sorted(i for b in search.members for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= capacity for b in search.members)
    used = sum(map(bool, search.members))
    assert used <= -(-sum(lengths) // capacity) or not steps_left(search, capacity)


def test_sequences(spark, library):
    texts = [None, "", "one two", *odd_texts(40, 5, 900), "word " * 3000, "same", "same"]
    rows = rows_of(texts) + [(None, "null id", "x", 1, 2, "y"), (2, "one two", "x", 1, 2, "y")]
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    got = packing.pack_documents(frame, vocabulary(BYTE_BPE), vocabulary(BYTE_RANKS)).collect()
    tokens, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        tokens[(r.doc_id, r.piece)].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts[:-1]]).tolist()
        assert sum(n for _, n in parts) <= 1024
    total = 0
    for doc_id, text in [(r[0], r[1]) for r in rows]:
        ids = library[BYTE_BPE].encode(text or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        for piece, (start, n) in enumerate(packing.cut(len(ids))):
            crc = zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
            found = tokens[(doc_id, piece)]
            assert (start, n, crc) in {(r.start, r.length, r.ids_crc32) for r in found}
    assert sum(r.length for r in got) == total
    assert packing.pack_documents(frame.limit(0), vocabulary(BYTE_BPE)).count() == 0
