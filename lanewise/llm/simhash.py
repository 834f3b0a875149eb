"""SimHash near duplicates, found with Golay-code keys.

A fingerprint takes the majority of its shingles' XXH64 bits. Distinct fingerprints are
linked when they differ in at most two bits, which is found on three segments of a
fingerprint: of two differing bits, some segment has none, and the segment after it (in
a circle) has at most one; or else both hold none. So a fingerprint is filed under each
segment's own bits with the index of the codeword nearest to the next segment, and looks
itself up under all codewords nearby. Candidates are verified by their bit distance.

Where more than ``KEY_FINGERPRINTS`` fingerprints share a key, comparing all of them
would grow with the square; all fingerprints that touch such a key are linked in another
exact way: two differ in at most two bits just if they share one of the 65 words within
one bit of themselves, and each such word is linked as a star.

Cases: a NULL or empty text has fingerprint zero and is linked like any other; a NULL
doc_id names no component but its row stays; repeated rows share fingerprint and
component; no rows give no rows; texts are used whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.golay import nearby, nearest
from lanewise.llm.graph import components
from lanewise.llm.tables import python_tasks
from lanewise.session import materialize

SHINGLE_WORDS, HASH_SEED, MAX_BITS = 3, 42, 2
KEY_FINGERPRINTS = 40
HASHES_AT_ONCE = 1 << 15

# Lowest bit and width of the three segments.
SEGMENTS = [(0, 22), (22, 21), (43, 21)]


def text_fingerprint(text: str, shingle_words: int, seed: int) -> int:
    """Unsigned 64-bit fingerprint."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(shingle_words, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    spans = list(zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True))
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), HASHES_AT_ONCE):
        hashes = [digest(joined[a:b], seed) for a, b in spans[at : at + HASHES_AT_ONCE]]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(spans)).tobytes(), "big")


def fingerprints(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, seed: int = HASH_SEED
) -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [text_fingerprint(t.as_py() or "", shingle_words, seed) for t in batch[1]]
            signed = np.array(bits, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(signed)], names=["doc_id", "bits"]
            )

    python_tasks(documents.sparkSession)
    chosen = documents.select(F.col("doc_id").cast("bigint"), "text")
    return chosen.mapInArrow(run, "doc_id bigint, bits bigint")


def _with_keys(distinct: DataFrame) -> DataFrame:
    """(bits, filed, sought): the keys a fingerprint is filed and looked up under."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch[0].to_numpy().view(np.uint64)
            parts = [((bits >> np.uint64(b)) & np.uint64((1 << w) - 1)).astype(np.int64)
                     for b, w in SEGMENTS]
            filed, sought = [], []
            for own, part in enumerate(parts):
                base = (own << 40) | (part << 12)
                beside = parts[(own + 1) % len(parts)]
                filed.append(base | nearest(beside))
                sought.append(base[:, None] | nearby(beside))
            columns = [batch[0]]
            for table in (np.stack(filed, axis=1), np.concatenate(sought, axis=1)):
                offsets = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(table.ravel())))
            yield pa.RecordBatch.from_arrays(columns, names=["bits", "filed", "sought"])

    python_tasks(distinct.sparkSession)
    return distinct.mapInArrow(run, "bits bigint, filed array<bigint>, sought array<bigint>")


def near_links(distinct: DataFrame, key_fingerprints: int = KEY_FINGERPRINTS) -> DataFrame:
    """(a, b) that connect distinct fingerprints ``bits`` just as all pairs within two
    bits do; every row is itself such a pair."""
    keyed = materialize(_with_keys(distinct.select("bits")), "fingerprint-keys")
    filed = keyed.select(F.explode("filed").alias("key"), F.col("bits").alias("a"))
    sought = keyed.select(
        F.explode(F.array_distinct("sought")).alias("key"), F.col("bits").alias("b")
    )
    crowds = filed.groupBy("key").agg(F.count("*").alias("n"))
    shared = materialize(crowds.filter(F.col("n") > 1), "shared-keys")
    crowded = shared.filter(F.col("n") > key_fingerprints).select("key")
    # A key with one fingerprint on file still meets others that look it up.
    few = filed.join(crowded, "key", "left_anti")
    close = few.join(sought, "key").filter(
        (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
    )
    touched = sought.join(crowded, "key", "left_semi").select(F.col("b").alias("bits")).distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(64)])
    words = touched.select(
        "bits", F.explode(F.transform(flips, lambda f: F.col("bits").bitwiseXOR(f))).alias("word")
    )
    # At most 65 fingerprints are within one bit of a word.
    stars = words.groupBy("word").agg(F.collect_list("bits").alias("near"))
    star_links = stars.filter(F.size("near") > 1).select(
        F.array_min("near").alias("a"), F.explode("near").alias("b")
    )
    return close.select("a", "b").unionByName(star_links.filter(F.col("a") != F.col("b"))).distinct()


def near_duplicates(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, seed: int = HASH_SEED
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row."""
    marked = materialize(fingerprints(documents, shingle_words, seed), "fingerprints")
    distinct = materialize(
        marked.groupBy("bits").agg(F.min("doc_id").alias("first")), "distinct-fingerprints"
    )
    roots = materialize(components(near_links(distinct)), "fingerprint-roots")
    rooted = distinct.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("bits").alias("named"), "component_id")
    hexed = F.lpad(F.lower(F.hex("bits")), 16, "0")
    return marked.join(named, F.col("bits") == F.col("named")).select(
        "doc_id", hexed.alias("fingerprint"), "component_id"
    )


def keep_first(documents: DataFrame) -> DataFrame:
    """One document of each component: a row with the smallest doc_id.

    Rows that repeat that doc_id are told apart by all their columns, written as JSON, so
    columns of any type may be among them; one of them stays.
    Rows without a doc_id go unless their component has no other rows; of those, one stays.
    """
    named = near_duplicates(documents)
    firsts = materialize(
        named.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy(F.col("doc_id").alias("_first"))
        .agg(F.count("*").alias("_rows")),
        "first-documents",
    )
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))

    def having(chosen: DataFrame) -> DataFrame:
        """Sorted at every size: the ids grow with the documents."""
        chosen = chosen.hint("merge")
        return rows.join(chosen, F.col("row.doc_id").eqNullSafe(F.col("_first")), "left_semi")

    once = having(firsts.filter(F.col("_rows") == 1))
    repeated = having(firsts.filter(F.col("_rows") > 1))
    return once.unionByName(
        repeated.groupBy("row.doc_id").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    ).select("row.*")
