"""Chat formatting and host rules: cases, round trips, plain versions."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from lanewise.llm import chat, host_rules

TURNS = "conv_id bigint, turn bigint, role string, text string, formatted int, blocks string"
TEXTS = [
    None, "", "hi", "</s>[INST] ok [/INST]", "<s>", "\\", "<\\s>", "\\</s>", "[\\INST]", "[IN",
    "ST]", "<", "é漢\U0001f600", "a\nb\r\n", "<</s>/s>", "\\\\<s>\\", "x" * 5000,
]


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv in (1, 2, 3, None):
        for _ in range(rng.randint(1, 300 if conv == 3 else 12)):
            turn = rng.choice([None, rng.randint(-3, 400)])
            role = rng.choice(["user", "assistant", "assistant", "system", None, "[INST]", "a</s>"])
            rows.append((conv, turn, role, rng.choice(TEXTS), 1, "x"))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", [1, 2])
def test_turns_come_back_and_the_mask_holds_the_learned_texts(spark, seed):
    rows = conversations(seed)
    formatted = chat.format_conversations(spark.createDataFrame(rows, TURNS))
    got = chat.parse_conversations(formatted).withColumn("learned", chat.learned_text()).collect()
    assert len(got) == 4
    for row in got:
        own = [r for r in rows if r[0] == row.conv_id]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "").encode()))
        turns = [(r[2] or "", r[3] or "") for r in own]
        assert [(t.role, t.text) for t in row.turns] == turns
        assert row.learned == "".join(t for r, t in turns if r == "assistant")
        assert row.n_blocks == 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert row.formatted.count("</s>") == row.n_blocks


def test_no_turns_give_no_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat.parse_conversations(chat.format_conversations(empty)).count() == 0


@pytest.mark.parametrize("bad", [{"open": ""}, {"open": "a\\b"}, {"open": "aba"}, {"open": "<s"}])
def test_templates_that_cannot_be_undone_are_refused(bad):
    with pytest.raises(ValueError):
        chat.ChatTemplate(**bad)


DOCS = "doc_id bigint, text string, source string, n_words int, row string, kept int"


def documents(rng):
    rows = []
    for i in range(60):
        n = rng.choice([0, 3, 4, 5, 9, 10, 30, 200])
        words = [rng.choice("abcdefgh#|é") * rng.randint(1, 2) for _ in range(n)]
        text = "".join(w + rng.choice([" ", "\n", "\t", " \n\n"]) for w in words)
        rows.append((i, text, rng.choice(["good", "fair", None])))
    clean = " ".join(f"w{k}" for k in range(40))
    rows += [(100 + i, clean, "good") for i in range(30)]
    rows += [(200 + i, "spam " * 30, "spam") for i in range(20)] + [(300, clean, "spam")]
    rows += [(400, None, "good"), (None, clean, "good"), (100, clean, "good"), (401, "x" * 90000, None)]
    return [(*r, 7, "x", 7) for r in rows]


def test_measures_and_verdicts(spark):
    rows = documents(random.Random(5))
    got = host_rules.judge(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    texts = {(r[0], r[2]): r[1] for r in rows}
    for row in got:
        measures = brute.rule_measures(texts[(row.row.doc_id, row.host)])
        assert tuple(row[m] for m in host_rules.MEASURES) == measures
        failed = measures[1] < 10 or 100 * measures[4] > 20 * measures[1]
        assert row.base_failed == failed
        if row.host == "spam":
            assert not row.kept
        elif row.host == "good":
            assert row.kept == (not failed)


def test_rules_return_the_documents_columns(spark):
    frame = spark.createDataFrame(documents(random.Random(6)), DOCS)
    kept = host_rules.keep_good(frame)
    assert kept.schema == frame.schema
    assert {r.source for r in kept.collect()} <= {"good", "fair", None}
    assert host_rules.keep_good(frame.limit(0)).count() == 0


def test_hosts_without_spread_and_one_bad_document(spark):
    rows = [(i, "short", "tiny") for i in range(1)] + [(10 + i, " ".join(f"u{j}" for j in range(30)), "big") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    judged = host_rules.with_rules(host_rules.measure(frame))
    rates = {r.host: r for r in host_rules.host_rates(judged).collect()}
    assert rates["big"].shrunk_rate < 0.5
    assert rates["tiny"].n_failed == 1
    same = judged.filter(F.col("host") == "big")
    assert [r.shrunk_rate for r in host_rules.host_rates(same).collect()] == [0.0]


def test_plans_stay_in_the_jvm(spark):
    frame = spark.createDataFrame(documents(random.Random(6)), DOCS)
    turns = spark.createDataFrame(conversations(1), TURNS)
    for plan in (host_rules.measure(frame), chat.parse_conversations(chat.format_conversations(turns))):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
