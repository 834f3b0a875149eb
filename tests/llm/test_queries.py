"""The registered queries against their oracle, and the pipeline against plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import brute
import corpus_pipeline
from compare import compare, oracle_connection
from lanewise.llm import classifier, packing
from lanewise.llm.oracle import ORACLE
from lanewise.llm.queries import BYTE_BPE, QUERIES, WORD_BPE, vocabulary

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_oracle(spark, name):
    rows, problem = compare(spark, oracle_connection(SF_DIR), SF_DIR, name, QUERIES[name], ORACLE[name])
    assert problem is None, problem
    assert rows > 0


def test_near_duplicates_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op6_golay_simhash"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == sorted(brute.near_duplicates([tuple(r) for r in rows]))


def check_packing(packed, docs):
    """Whole documents, gapless sequences of at most 1024 tokens, and few of them."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(BYTE_BPE))
    pieces, sequences = {(r.doc_id, r.piece): r for r in packed}, defaultdict(list)
    assert len(pieces) == len(packed)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    total = 0
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        for n, (start, size) in enumerate(packing.cut(len(ids))):
            crc = zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())
            r = pieces.pop((doc_id, n))
            assert (r.start, r.length, r.ids_crc32) == (start, size, crc)
    assert not pieces
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts[:-1]]).tolist()
        assert sum(n for _, n in parts) <= 1024
    assert len(sequences) <= 1.02 * total / 1024 + 1


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    packed = QUERIES["op8_best_fit_packing"](spark, SF_DIR).collect()
    check_packing(packed, [tuple(r) for r in docs])


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r for r in docs.collect()}
    names = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, before, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        names.append(name)
        if name == "quality rules":
            failed = {}
            for i, r in kept.items():
                m = brute.rule_measures(r.text)
                failed[i] = m[1] < 10 or 100 * m[4] > 20 * m[1]
            kept = {i: r for i, r in kept.items() if not failed[i]}
        elif name == "quality classifier":
            model = classifier.train(before, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            scores = model.score(np.array([classifier.text_features(r.text) for r in kept.values()]))
            kept = {i: r for (i, r), s in zip(kept.items(), scores, strict=True) if s >= 0.7}
        elif name == "near dedup":
            named = brute.near_duplicates([(i, r.text) for i, r in kept.items()])
            kept = {i: kept[i] for i, _, c in named if i == c}
        elif name == "substring dedup":
            plain = brute.substring_dedup([(i, r.text) for i, r in kept.items()])
            assert {r.doc_id for r in rows} == set(kept) and docs.columns == columns
            texts = {r.doc_id: r.text for r in rows}
            for i, _, removed, sha in plain:
                if not removed:
                    assert texts[i] == kept[i].text
                else:
                    assert brute.sha(texts[i]) == sha
            assert all(r.n_chars == len(r.text) for r in rows if r.text != kept[r.doc_id].text)
            kept = {r.doc_id: r for r in rows}
        else:
            check_packing(rows, [(i, r.text) for i, r in kept.items()])
            continue
        assert docs.columns == columns
        if name != "substring dedup":
            assert sorted(map(str, rows)) == sorted(map(str, kept.values()))
    assert len(names) == 5


def test_stages_take_odd_rows_and_none(spark):
    odd = spark.createDataFrame(
        [
            (None, None, None, None, None, 1, "a", None, None), (1, None, "en", "s", 0, 1, "a", {}, (1, {"k": 1})),
            (1, None, "en", "s", 0, 1, "a", {"x": 1}, None), (2, "", "en", "s", 0, 1, "b", {"x": None}, (None, None)),
            (3, " ".join(f"w{i}" for i in range(60)), None, None, None, 2, None, None, None),
            (4, " ".join(f"w{i}" for i in range(60)), "en", "t", 9, 2, "c", {"x": 2, "y": 3}, (2, {})),
            (5, " ".join(f"long{i}" for i in range(30_000)), "en", "t", 9, 2, "c", None, None),
        ],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, row string,"
        " counts map<string,int>, nested struct<doc_id:int,more:map<string,int>>",
    )
    for frame in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF_DIR)
            out.collect()
            if name != "best-fit packing":
                assert out.columns == frame.columns
            if frame is not odd:
                assert out.count() == 0


def test_bpe_query(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(WORD_BPE))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op5_bpe"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for d, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        r = got[d]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == brute.sha(" ".join(map(str, ids)))
        assert r.decoded_sha256 == brute.sha(decoded)


def test_language_model_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in QUERIES["op7_suffix_tree_lm"](spark, SF_DIR).collect()}
    tokens = {d: [*(t or "").encode().lower().split(), b""] for d, t in docs}
    held = {d for d in tokens if zlib.crc32(str(d).encode()) % 7 == 2}
    counts = Counter(t for d, ts in tokens.items() if d not in held for t in ts)
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(docs) and held
    for d, ts in tokens.items():
        r = rows[d]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (d in held, len(ts), n)
        assert r.n_known == sum(counts[t] > 0 for t in ts)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score <= 0
    assert sum(rows[d].score for d in held) > sum(rows[d].base_score for d in held)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.count() > 100 and "sequence_id" in out.columns
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
