"""Classifier and language model: what they learn, and that it is whole."""

import math
import pathlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import two_word_model
from lanewise.llm import classifier, packed, suffix_lm
from lanewise.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, score string, row int, label string"


def frame_of(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], DOCS).repartition(3)


def labelled(seed, n=300):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        words = ["".join(rng.choice("aeinrst") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(5, 90))]
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good)))
    return rows, labels


def test_preferences_are_learned(spark):
    rows, labels = labelled(1)
    shown = spark.createDataFrame(labels[:200], "doc_id bigint, quality int")
    model = classifier.train(frame_of(spark, rows), shown)
    scored = classifier.score_documents(frame_of(spark, rows), model)
    got = {r.row.doc_id: r.score for r in scored.collect()}
    hidden = [(got[i] >= 0.7) == bool(q) for i, q in labels[200:]]
    assert sum(hidden) >= 0.97 * len(hidden)
    assert all(0 <= s <= 1 for s in got.values())


def test_odd_rows_have_scores_and_odd_labels_are_left_out(spark):
    rows, labels = labelled(2, 120)
    odd = [(None, "text"), (500, None), (501, ""), (502, "x" * 200_000), (3, rows[3][1])]
    extra = [(None, 0), (600, 0), (4, 1 - labels[4][1]), (5, None), (6, 7)]
    marks = spark.createDataFrame([*labels, *extra], "doc_id bigint, quality int")
    frame = frame_of(spark, rows + odd)
    kept = classifier.keep_preferred(frame, marks)
    assert kept.columns == frame.columns
    scored = classifier.score_documents(frame, classifier.train(frame, marks)).collect()
    assert len(scored) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in scored)
    assert classifier.keep_preferred(frame.limit(0), marks).count() == 0


def test_one_class_teaches_nothing(spark):
    frame = frame_of(spark, [(1, "a"), (2, "b")])
    marks = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, quality int")
    assert classifier.train(frame, marks) is None
    assert classifier.keep_preferred(frame, marks).count() == 2


def test_a_repeated_document_does_not_push_out_the_other_class(spark):
    rows, labels = labelled(3)
    bad = next(i for i, q in labels if not q)
    shown = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = classifier.train(frame_of(spark, rows + [rows[bad]] * 500), shown, class_rows=30)
    assert model is not None
    once = classifier.train(frame_of(spark, rows), shown, class_rows=30)
    assert np.allclose(model.weights, once.weights) and np.allclose(model.mean, once.mean)


def test_the_threshold_covers_all_labelled_documents_of_the_input(spark):
    rows, labels = labelled(4)
    absent = [(1000 + i, 0) for i in range(900)]
    shown = spark.createDataFrame(labels + absent, "doc_id bigint, quality int")
    frame = frame_of(spark, rows + rows[:5])
    model = classifier.train(frame, shown, class_rows=8)
    scored = classifier.score_documents(frame, model).collect()
    below = {r.row.doc_id for r in scored if r.score < 0.7}
    assert len(below) == sum(q == 0 for _, q in labels)


def test_ranks_of_scores(spark):
    values = [0.5, -3.0, 0.5, 0.5, 1e-300, 7.25, 1e9, 0.5000000000000001, -3.0]
    frame = spark.createDataFrame([(v,) for v in values], "raw double")
    assert [classifier._ranked(frame, i) for i in range(len(values))] == sorted(values)


def test_features_equal_plain_ones():
    rng = random.Random(4)
    pieces = ["word", "Word", "é漢", " ", "  ", "\n", "\n\n", "\t", "12", "!?", "<a>", "\x00", "\x0b", "x" * 40]
    texts = ["", " ", "\n", "one", *["".join(rng.choices(pieces, k=rng.randint(1, 120))) for _ in range(200)]]
    for text in texts:
        assert classifier.text_features(text) == pytest.approx(brute.quality_features(text), abs=1e-9)


def test_query_equals_a_plain_classifier(spark):
    """Features, pairs, loss and quantile once more, by plain means."""
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op4_pairwise_quality"](spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumn("h", F.xxhash64("doc_id"))
    shown = [r for r in labels.orderBy("h", "doc_id").collect()
             if r.doc_id in texts and zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.quality is not None]
    features = {d: brute.quality_features(t) for d, t in texts.items()}
    good, bad = [[features[r.doc_id] for r in shown if r.quality == q] for q in (1, 0)]
    raw = dict(zip(texts, brute.preference_scores(good, bad, [features[d] for d in texts]), strict=True))
    ordered = sorted(raw[r.doc_id] for r in shown)
    cut = (ordered[len(bad) - 1] + ordered[len(bad)]) / 2
    assert len(got) == len(texts) and len(bad) > 5
    for d in texts:
        score = 1 / (1 + math.exp(-min(30, max(-30, raw[d] - cut + math.log(0.7 / 0.3)))))
        assert got[d].score == pytest.approx(score, abs=2e-3)
        assert abs(raw[d] - cut) < 5e-3 or got[d].predicted == int(raw[d] >= cut)


def test_held_out_accuracy(spark):
    got = QUERIES["op4_pairwise_quality"](spark, SF_DIR).toPandas()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    remainder = got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4)
    assert (got.held_out == (remainder == 2)).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    hidden = got[got.held_out].merge(labels, on="doc_id")
    assert (hidden.predicted == hidden.quality).mean() >= 0.95


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b""]


def corpus(seed):
    rng = random.Random(seed)
    follows = {(a, b): rng.sample("abcdefgh", 2) for a in "abcdefgh" for b in "abcdefgh"}
    rows = []
    for i in range(150):
        past, word, words = "a", rng.choice("abcdefgh"), []
        for _ in range(rng.randint(0, 80)):
            words.append(rng.choice([word, word.upper()]) if rng.random() < 0.95 else f"rare{rng.randint(0, 300)}")
            likely = follows[(past, word)] if rng.random() < 0.9 else "abcdefgh"
            past, word = word, rng.choice(likely)
        rows.append((i, " ".join(words)))
    return [*rows, (None, "a b c"), (900, None), (901, "é   x"), *rows[:4]]


@pytest.mark.parametrize("least", [3, 40])
def test_scores_and_base_scores(spark, least, monkeypatch):
    monkeypatch.setattr(suffix_lm, "MIN_COUNT", least)
    monkeypatch.setattr(suffix_lm, "CHUNK_BYTES", 2500)
    monkeypatch.setattr(suffix_lm, "RANGE_BYTES", 3000)
    rows = corpus(1)
    scored, total = suffix_lm.score(frame_of(spark, rows), F.col("doc_id") % 5 != 0)
    counts = Counter(t for d, x in rows if d is None or d % 5 for t in tokens_of(x))
    n, v = sum(counts.values()), len(counts)
    assert total == n
    expected = sorted(
        (str(d), len(t), sum(counts[w] > 0 for w in t),
         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6))
        for d, t in ((d, tokens_of(x)) for d, x in rows)
    )
    got = scored.collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == expected
    base, own = sum(r.base_score for r in got), sum(r.score for r in got)
    assert own > base + (50 if least == 3 else 0)


def test_every_state_adds_up_to_one(spark):
    spark.sparkContext.addPyFile(two_word_model.__file__)
    tree, *_ = two_word_model.learn(frame_of(spark, corpus(2)).select("doc_id", "text"))
    assert (~np.isnan(tree.pair_log)).sum() > 10 and len(tree.triples) > 10
    numbers = np.arange(len(tree.hashes))
    shift = two_word_model.ID_BITS
    unknown = 1 - np.power(10.0, tree.log_single).sum()
    one_word = {}
    for word in numbers.tolist():
        pair = two_word_model._find(tree.pairs, word << shift | numbers)
        one = tree.after_word(np.full(len(numbers), word), pair, tree.log_single)
        one_word[word] = one
        rest = 10 ** tree.word_rest[word] * unknown
        assert np.power(10.0, one).sum() + rest == pytest.approx(1)
    for context, pair in enumerate(tree.pairs.tolist()):
        last = pair & (1 << shift) - 1
        two = tree.after_pair(np.full(len(numbers), context), numbers, one_word[last])
        rest = 10 ** (tree.pair_rest[context] + tree.word_rest[last]) * unknown
        assert np.power(10.0, two).sum() + rest == pytest.approx(1)


def plain_scores(learned, texts, depth):
    """Scores of a tree of contexts of up to ``depth`` tokens, without Spark or hashes."""
    counts = [Counter() for _ in range(depth + 2)]
    for t in map(tokens_of, learned):
        for size in range(1, depth + 2):
            counts[size].update(tuple(t[i : i + size]) for i in range(len(t) - size + 1))
    base = math.log10(sum(counts[1].values()) + len(counts[1]) + 1)
    rests = {}

    def chance(context, word):
        if not context:
            return math.log10(counts[1][(word,)] + 1) - base
        n, shorter = counts[len(context) + 1][(*context, word)], chance(context[1:], word)
        if context not in rests:
            return shorter
        if n >= suffix_lm.MIN_COUNT:
            return math.log10((n - suffix_lm.DISCOUNT) / counts[len(context)][context])
        return rests[context] + shorter

    for size in range(1, depth + 1):
        entries = {}
        for gram, n in counts[size + 1].items():
            if n >= suffix_lm.MIN_COUNT:
                entries.setdefault(gram[:-1], []).append((gram[-1], n))
        found = {}
        for context, follow in entries.items():
            total = counts[size][context]
            own = [(n - suffix_lm.DISCOUNT) / total for _, n in follow]
            short = [chance(context[1:], w) for w, _ in follow]
            rest = max(1 - sum(own), 1e-12), max(1 - sum(10**x for x in short), 1e-12)
            gain = sum(n * (math.log(o) - x * math.log(10)) for (_, n), o, x in zip(follow, own, short, strict=True))
            gain += max(total - sum(n for _, n in follow), 0) * math.log(rest[0] / rest[1])
            if gain >= suffix_lm.MIN_DIVERGENCE:
                found[context] = math.log10(rest[0] / rest[1])
        rests.update(found)
    return [
        sum(chance(tuple(t[max(0, i - depth) : i]), w) for i, w in enumerate(t))
        for t in map(tokens_of, texts)
    ]


@pytest.mark.parametrize("depth", [1, 2, 5])
def test_scores_are_those_of_the_whole_tree(spark, depth, monkeypatch):
    monkeypatch.setattr(suffix_lm, "MAX_DEPTH", depth)
    monkeypatch.setattr(suffix_lm, "RANGE_BYTES", 3000)
    rows = corpus(3)
    scored, _ = suffix_lm.score(frame_of(spark, rows), F.col("doc_id") % 5 != 0)
    expected = plain_scores([x for d, x in rows if d is None or d % 5], [x for _, x in rows], depth)
    got = sorted((str(r.doc_id), r.score) for r in scored.collect())
    wanted = sorted((str(d), x) for (d, _), x in zip(rows, expected, strict=True))
    assert [d for d, _ in got] == [d for d, _ in wanted]
    assert [x for _, x in got] == pytest.approx([x for _, x in wanted])


def test_rare_contexts_are_kept_in_a_large_corpus(spark):
    """Three times in four million tokens."""
    rows = [(1, "some odd pair"), (2, "some odd pair"), (3, "some odd pair"), (4, "some odd pair")]
    filler = spark.range(10, 50).select(
        F.col("id").alias("doc_id"), F.expr("repeat('so it goes ', 35000)").alias("text")
    )
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(filler)
    scored, total = suffix_lm.score(frame, F.col("doc_id") != 4)
    assert total > 4_000_000
    got = scored.filter("doc_id = 4").first()
    assert got.n_known == 4 and got.score > got.base_score + 10


def test_long_contexts_become_states(spark):
    """What follows "a b a b a b a b" tells only from the word before it."""
    rng = random.Random(5)
    def text(n):
        return " ".join(f"{x} a b a b a b a b {x}{x}" for x in (rng.choice("pqrs") for _ in range(n)))

    rows = [(i, text(40)) for i in range(20)]
    scored, _ = suffix_lm.score(frame_of(spark, rows), F.col("doc_id") % 5 != 0)
    depth = suffix_lm.MAX_DEPTH
    learned, got = [x for d, x in rows if d % 5], {r.doc_id: r.score for r in scored.collect()}
    expected = plain_scores(learned, [x for _, x in rows], depth)
    assert [got[d] for d, _ in rows] == pytest.approx(expected)
    assert got[0] > plain_scores(learned, [rows[0][1]], 2)[0] + 20


def test_distinct_values():
    """Also of values that differ in their lower bits only."""
    rng = np.random.default_rng(1)
    wide = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    near = wide[:50, None] + np.arange(8, dtype=np.uint64)
    for values in (wide[:0], wide[:1], rng.choice(wide, 3000), rng.choice(near.ravel(), 3000)):
        found, number, first = suffix_lm._distinct(values)
        assert (found == np.unique(values)).all() and len(found) == len(set(values.tolist()))
        assert (found[number] == values).all() and (values[first] == found).all()


def test_tables_stay_small_and_meet_in_shares(spark, monkeypatch):
    """The disk that the tables of two lengths take at once, for a text of which many pairs and
    some long passages are frequent; the scores are those of the whole tree."""
    rng = random.Random(7)
    words = ["".join(rng.choices("aeinrst", k=5)) for _ in range(400)]
    passages = [rng.choices(words, k=60) for _ in range(40)]
    rows = []
    for i in range(120):
        text = [w for _ in range(6) for w in [*rng.choices(words, k=100), *rng.choice(passages)]]
        rows.append((i, " ".join(text)))
    size = sum(len(x) for _, x in rows)
    monkeypatch.setattr(suffix_lm, "CHUNK_BYTES", size // 5)
    monkeypatch.setattr(suffix_lm, "MEETING_SHARE", 10)
    monkeypatch.setattr(suffix_lm, "MEETING_BYTES", 1)
    written, most = {}, []

    def bytes_of(folder):
        return sum(f.stat().st_size for f in folder.rglob("*.parquet"))

    def watched(df, name, *args, **kwargs):
        table = materialize(df, name, *args, **kwargs)
        path = next(iter(table.inputFiles())).removeprefix("file:")
        written[name] = next(p for p in pathlib.Path(path).parents if p.name.startswith(f"{name}-"))
        most.append(sum(bytes_of(p) for p in written.values()))
        return table

    materialize = suffix_lm.materialize
    monkeypatch.setattr(suffix_lm, "materialize", watched)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    scored, _ = suffix_lm.score(frame, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r.score for r in scored.collect()}
    assert max(most) < 0.6 * size
    assert {f"parts-2-{n}" for n in range(2)} <= written.keys()
    learned = [x for d, x in rows if d % 5]
    wanted = plain_scores(learned, [x for _, x in rows], suffix_lm.MAX_DEPTH)
    assert [got[d] for d, _ in rows] == pytest.approx(wanted)


def test_words_are_hashed_as_they_are():
    texts = [b"", b" \t", b"one", b"One two\none", b"x" * 9000 + b" " + b"y" * 3, "é É".encode()]
    texts += [b"long " * 600_000, b"one"]
    hashes, counts = packed.hash_words(texts)
    words = [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts]
    named = dict(zip(words, hashes.tolist(), strict=True))
    assert [named[w] for w in words] == hashes.tolist() and len(set(named.values())) == len(named)
    lowered, _ = packed.hash_words(texts, lower=True)
    again, _ = packed.hash_words([t.lower() for t in texts])
    assert (lowered == again).all() and (lowered != hashes).sum() == 1


def test_nothing_learned_and_nothing_scored(spark):
    frame = frame_of(spark, [(1, "a b"), (2, None)])
    scored, total = suffix_lm.score(frame, F.lit(False))
    assert total == 0 and {(r.doc_id, r.n_tokens, r.n_known, r.score) for r in scored.collect()} == {(1, 3, 0, 0.0), (2, 1, 0, 0.0)}
    scored, total = suffix_lm.score(frame.limit(0), F.lit(True))
    assert scored.count() == 0 and total == 0
