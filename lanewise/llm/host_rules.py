"""Quality rules by host, with DataFrame expressions only.

Every document is measured on its own; rule failures are added up by host, the hosts'
failure rates are shrunk by a beta prior fitted to all hosts, and a host whose shrunk
rate is too high loses all its documents.

Cases: a NULL text has no words; a NULL host is a host of its own; repeated rows count
each; no rows give no rows; the row's own columns travel in the struct ``row`` and so
clash with nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.llm.tables import SPACE, WORD, bound
from lanewise.session import materialize

WINDOW_WORDS = 5
SYMBOLS = "[#*$%&|<>]"
MEASURES = ["word_chars", "n_words", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rules:
    """A document fails below ``min_words`` or above ``max_repeat_percent`` of repeated
    words; a host fails above ``max_host_failure``."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_host_failure: float = 0.5


def _window_hashes(words: Column) -> Column:
    """One hash per window of words, from one hash per word."""
    n = F.greatest(F.size(words) - (WINDOW_WORDS - 1), F.lit(0))

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, F.lit(1), n),
            lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW_WORDS)]),
        )

    return bound(F.transform(words, lambda w: F.xxhash64(w)), windows)


def _covered_words(words: Column) -> Column:
    """Words in windows that occur twice or more, by comparing the windows themselves.

    Sorting the windows with their places puts equal ones side by side; the places of
    repeated windows, in order, cover up to five words each.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW_WORDS - 1)),
        lambda i: F.struct(
            F.array_join(F.slice(words, i, F.lit(WINDOW_WORDS)), " ").alias("window"),
            i.alias("place"),
        ),
    )
    ordered = F.sort_array(windows)

    def repeated(ordered: Column) -> Column:
        found = F.filter(
            ordered,
            lambda w, i: (w["window"] == F.get(ordered, i + 1)["window"])
            | ((i > 0) & (w["window"] == F.get(ordered, i - 1)["window"])),
        )
        return F.sort_array(F.transform(found, lambda w: w["place"]))

    def covered(places: Column) -> Column:
        widths = F.transform(
            places,
            lambda p, i: F.least(
                F.lit(WINDOW_WORDS), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW_WORDS))
            ),
        )
        return F.aggregate(widths, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return bound(ordered, lambda o: bound(repeated(o), covered))


def measure(documents: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """(row, host, measures): ``row`` is the document with all its columns."""
    base = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.col(host).alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    split = base.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    hashed = split.withColumns({"hashes": _window_hashes(F.col("words")), "lines": lines})
    # Equal windows have equal hashes, so only documents with an equal pair of hashes
    # need their windows compared.
    suspect = F.size(F.array_distinct("hashes")) < F.size("hashes")
    return hashed.select(
        "row",
        "host",
        F.aggregate(
            "words", F.lit(0).cast("bigint"), lambda a, w: a + F.char_length(w)
        ).alias("word_chars"),
        F.size("words").cast("bigint").alias("n_words"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(suspect, _covered_words(F.col("words")))
        .otherwise(F.lit(0).cast("bigint"))
        .alias("n_repeat_words"),
    )


def with_rules(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Adds ``base_failed``."""
    return measured.withColumn(
        "base_failed",
        (F.col("n_words") < rules.min_words)
        | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")),
    )


def host_rates(judged: DataFrame) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate).

    The beta prior is fitted by moments over the hosts' own rates: its mean is theirs,
    its weight in documents is m(1 - m) / variance - 1, at least one. Without any
    spread between hosts the prior weighs as much as an average host.
    """
    hosts = judged.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(
        F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg("n_docs").alias("docs")
    ).first()
    mean, spread = prior.m or 0.0, prior.v or 0.0
    weight = max(1.0, mean * (1 - mean) / spread - 1) if spread > 0 else float(prior.docs or 1)
    shrunk = (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight)
    return hosts.withColumn("shrunk_rate", shrunk)


def verdicts(judged: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Adds ``kept``. ``judged`` is read twice, so it should be a written table.

    The rejected hosts are written too: few are broadcast by their measured bytes, many
    are sorted.
    """
    rejected = host_rates(judged).filter(F.col("shrunk_rate") > rules.max_host_failure)
    rejected = materialize(
        rejected.select(F.col("host").alias("rejected_host"), F.lit(True).alias("_bad")),
        "rejected-hosts",
    )
    joined = judged.join(rejected, F.col("host").eqNullSafe(F.col("rejected_host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("_bad").isNull()).drop(
        "rejected_host", "_bad"
    )


def judge(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every document."""
    return verdicts(materialize(with_rules(measure(documents), rules), "host-rules"), rules)


def keep_good(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(documents, rules).filter("kept").select("row.*")
