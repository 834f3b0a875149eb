"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.llm import (
    bpe, chat, classifier, host_rules, inner_products, line_index, packing, periodic_runs, simhash,
    spelling, substrings, suffix_lm, warc,
)
from lanewise.llm.tables import SPACE, bound, table

# Vocabulary files are looked up by name where the tokenizer package is installed.
WORD_BPE, BYTE_BPE, BYTE_RANKS = "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.parse_conversations(chat.format_conversations(turns.unionByName(own)))
    line = F.lit("\n")
    digest = F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line))
    learned = formatted.withColumn("learned", chat.learned_text())
    return learned.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(digest, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        F.col("n_blocks").cast("bigint").alias("n_blocks"),
    )


@query
def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = inner_products.integer_vectors(table(spark, sf_dir, "embeddings"))
    return inner_products.top_inner_products(vectors, F.col("vec_id") % 100 == 0)


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats_removed(table(spark, sf_dir, "documents"))


@query
def op4_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    model = classifier.train(documents, labels)
    return classifier.score_documents(documents, model).select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(
            F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)
        ).alias("held_out"),
        "score",
        (F.col("score") >= classifier.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    scored, tokens = suffix_lm.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return packing.pack_documents(documents, vocabulary(BYTE_BPE), vocabulary(BYTE_RANKS))


@query
def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    measured = host_rules.measure(documents).select(
        F.col("row.doc_id").alias("doc_id"), "host", *host_rules.MEASURES
    )
    judged = host_rules.materialize(host_rules.with_rules(measured), "host-rules")
    return host_rules.verdicts(judged).drop("host")


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder)


def with_repeated_tails(documents: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by the checksum of their doc_id, go on in a
    period from some word on."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = documents.select("doc_id", "text", checksum.alias("h"))
    words = F.array_remove(F.split("text", SPACE), "")
    g = F.floor(F.col("h") / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        times = F.ceil((n - a) / p)
        tail = F.flatten(F.array_repeat(F.slice(w, a.cast("int") + 1, p.cast("int")), times.cast("int")))
        longer = F.concat(F.slice(w, F.lit(1), a.cast("int")), tail)
        return F.when(n > 0, F.array_join(F.slice(longer, F.lit(1), n), " ")).otherwise("")

    text = F.when(F.col("h") % 10 == 0, bound(words, repeated)).otherwise(F.col("text"))
    return chosen.select("doc_id", text.alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_repeated_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.collapse_runs(documents)
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"], r["period"]))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *r_text(r)), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.minus")).alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(F.lit(-1000) * F.col("longest.minus") / F.col("longest.period"))
        .cast("bigint")
        .alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def r_text(run: Column) -> list[Column]:
    return [run[c].cast("string") for c in ("start", "length", "period")]


def without_a_letter(doc_id: int, word: str) -> str:
    """One word of 97, by the checksum of its document and itself, loses a letter."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(table(spark, sf_dir, "documents"), without_a_letter)
    return spelling.variants(counts.filter(F.col("n") >= spelling.MIN_COUNT))


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_index.drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )
