"""Removal of lines that repeat across documents, with a sharded minimal perfect hash.

A line's key is the line without ASCII white space at both ends, A-Z in lower case. Keys of
``MIN_CHARS`` code points or more are named by 128 bits; equal names are taken for equal keys.

1. One pass cuts the documents into chunks, written with their texts compressed and every
   line numbered by its key. A chunk has one row per key, however often its documents hold it.
2. Keys are added up over all chunks, map-side first, and dealt to shards by their name. A
   shard gets a minimal perfect hash: levels of bits in which a key that is alone at its
   place stays and the others go on to the next level. The rank of its bit is the key's slot in
   the shard's arrays: a fingerprint, the number of documents up to 255, and for keys of two
   documents or more the smallest doc_id.
3. The keys of the chunks probe the arrays of their shard. Only keys found in several
   documents are answered. A shard with more probes than ``PROBES`` is repeated for parts of
   them, so a line that every chunk holds crowds no task.
4. Answers meet their chunk, whose texts lose the lines.

Cases: a NULL or empty text is one empty line; a NULL doc_id neither loses lines nor holds
any; rows of one doc_id are one document and keep each other's lines; equal rows are all
returned; texts of any length are whole; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.packed import _mix, batch_of, pack, unpack
from lanewise.llm.tables import python_tasks, share_of
from lanewise.session import materialize

MIN_CHARS = 10
CHUNK_BYTES = 8_000_000  # of text
SHARD_KEYS = 400_000  # chunk keys, distinct or not, that lead to one more shard
PROBES = 1_000_000  # of one shard that one task answers
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"

_CHUNKS = "chunk bigint, payload binary, k int, a bigint, b bigint, first bigint, last bigint, docs int"
_CHUNKS_ARROW = [
    ("chunk", pa.int64()), ("payload", pa.binary()), ("k", pa.int32()), ("a", pa.int64()),
    ("b", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("docs", pa.int32()),
]
_KEPT = "doc_id bigint, n_lines bigint, n_dropped bigint, text string"
_KEPT_ARROW = [
    ("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())
]


def line_key(line: bytes) -> bytes | None:
    """The key of a line that may be dropped; None if it is too short."""
    key = line.strip(SPACE_BYTES).lower()
    if len(key) < MIN_CHARS:
        return None
    # A code point has four bytes at most.
    if len(key) < 4 * MIN_CHARS and len(key.decode()) < MIN_CHARS:
        return None
    return key


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = _mix(a ^ (b * np.uint64(2 * level + 1)) ^ np.uint64(level << 32))
    return ((mixed >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


class Shard:
    """Arrays behind a minimal perfect hash over pairs of 64-bit numbers.

    ``sizes`` are the places of each level, ``bits`` tell which of them hold a key.
    """

    def __init__(self, sizes, bits, fingerprints, counts, firsts):
        self.sizes, self.bits = sizes, bits
        self.fingerprints, self.counts, self.firsts = fingerprints, counts, firsts
        self.rank = np.cumsum(bits) - 1
        self.holder = np.cumsum(counts > 1) - 1

    @classmethod
    def build(cls, a, b, counts, firsts) -> Shard:
        """From distinct pairs (a, b)."""
        slots = np.empty(len(a), dtype=np.int64)
        left, sizes, bits, before = np.arange(len(a)), [], [], 0
        while len(left):
            size = max(8, len(left) + len(left) // 4)
            place = _place(a[left], b[left], len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            stays = alone[place]
            slots[left[stays]] = before + np.cumsum(alone)[place[stays]] - 1
            before += int(alone.sum())
            sizes.append(size)
            bits.append(alone)
            left = left[~stays]
        order = np.argsort(slots)
        counts = np.minimum(counts, 255).astype(np.uint8)[order]
        return cls(
            np.array(sizes, dtype=np.int64),
            np.concatenate(bits) if bits else np.zeros(0, dtype=bool),
            b[order].astype(np.uint32),
            counts,
            firsts[order][counts > 1],
        )

    def dump(self) -> bytes:
        return pack(self.sizes, np.packbits(self.bits), self.fingerprints, self.counts, self.firsts)

    @classmethod
    def load(cls, payload: bytes) -> Shard:
        sizes, bits, *arrays = unpack(payload)
        return cls(sizes, np.unpackbits(bits, count=int(sizes.sum())).astype(bool), *arrays)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of the pairs, -1 where the shard has no such pair by its fingerprint."""
        slots = np.full(len(a), -1, dtype=np.int64)
        left, before = np.arange(len(a)), 0
        for level, size in enumerate(self.sizes.tolist()):
            place = before + _place(a[left], b[left], level, size)
            here = self.bits[place]
            slots[left[here]] = self.rank[place[here]]
            left, before = left[~here], before + size
            if not len(left):
                break
        found = np.flatnonzero(slots >= 0)
        wrong = self.fingerprints[slots[found]] != b[found].astype(np.uint32)
        slots[found[wrong]] = -1
        return slots


def _chunk_rows(docs: list[tuple[int | None, bytes]], chunk: int) -> Iterator[pa.RecordBatch]:
    import pickle

    import xxhash
    import zstandard

    docs.sort(key=lambda d: (d[0] is None, d[0] or 0))
    number: dict[bytes, int] = {}
    numbers, first, last, held = [], [], [], []
    name = xxhash.xxh3_128_digest
    for doc_id, data in docs:
        for line in data.split(b"\n"):
            key = line_key(line) if doc_id is not None else None
            if key is None:
                numbers.append(-1)
                continue
            digest = name(key)
            k = number.setdefault(digest, len(first))
            numbers.append(k)
            if k == len(first):
                first.append(doc_id)
                last.append(doc_id)
                held.append(1)
            elif last[k] != doc_id:
                last[k] = doc_id
                held[k] += 1
    plain = pickle.dumps((docs, np.array(numbers, dtype=np.int32).tobytes()), protocol=5)
    payload = zstandard.ZstdCompressor(level=3).compress(plain)
    yield batch_of([(chunk, payload, *[None] * 6)], _CHUNKS_ARROW)
    names = np.frombuffer(b"".join(number), dtype=np.int64).reshape(-1, 2)
    n = len(names)
    columns = [np.full(n, chunk), None, np.arange(n, dtype=np.int32), names[:, 0].copy(), names[:, 1].copy()]
    columns += [np.array(first, dtype=np.int64), np.array(last, dtype=np.int64), np.array(held, dtype=np.int32)]
    for at in range(0, n, 100_000):
        part = slice(at, at + 100_000)
        arrays = [
            pa.nulls(min(n - at, 100_000), kind) if c is None else pa.array(c[part], kind)
            for c, (_, kind) in zip(columns, _CHUNKS_ARROW, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=[x for x, _ in _CHUNKS_ARROW])


def chunks_of(documents: DataFrame) -> DataFrame:
    """A written table: per chunk one row with its texts, and one row per key (two
    numbers) with its smallest and largest doc_id there and how many it has."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                data = (text.as_py() or "").encode()
                held.append((doc_id, data))
                size += len(data) + 1
                if size >= CHUNK_BYTES:
                    yield from _chunk_rows(held, chunk)
                    held, size, chunk = [], 0, chunk + 1
        if held:
            yield from _chunk_rows(held, chunk)

    python_tasks(documents.sparkSession)
    slim = documents.select(F.col("doc_id").cast("bigint"), "text")
    return materialize(slim.mapInArrow(scan, _CHUNKS), "line-chunks")


def line_index(chunks: DataFrame, shards: int) -> DataFrame:
    """(shard, index): the dumped ``Shard`` over the distinct keys of each shard."""

    def build(group: pa.Table) -> pa.Table:
        a, b = (group[c].to_numpy().view(np.uint64) for c in ("a", "b"))
        index = Shard.build(a, b, group["n"].to_numpy(), group["first"].to_numpy())
        return pa.table(
            {"shard": pa.array([group["shard"][0].as_py()], pa.int64()), "index": [index.dump()]}
        )

    keys = chunks.filter(F.col("k").isNotNull())
    # A doc_id in several chunks counts in each of them, but never as a second document.
    several = F.col("first") != F.col("last")
    distinct = (
        keys.groupBy("a", "b")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("docs").alias("n"))
        .select(
            _shard(shards), "a", "b", "first", F.when(several, F.col("n")).otherwise(1).alias("n")
        )
    )
    return materialize(
        distinct.groupBy("shard").applyInArrow(build, "shard bigint, index binary"), "line-index"
    )


def _shard(shards: int):
    return F.pmod("a", F.lit(shards).cast("bigint")).alias("shard")


def probe(chunks: DataFrame, index: DataFrame, shards: int, probes: int = PROBES) -> DataFrame:
    """(chunk, k, first) for the chunks' keys that several documents hold."""

    def answer(group: pa.Table) -> pa.Table:
        at = group["index"].is_valid().to_numpy(zero_copy_only=False)
        shard = Shard.load(group["index"].filter(pa.array(at))[0].as_py())
        asked = group.filter(pa.array(~at))
        slots = shard.find(*(asked[c].to_numpy().view(np.uint64) for c in ("a", "b")))
        if (slots < 0).any():
            raise RuntimeError("a key is missing in its shard")
        repeated = shard.counts[slots] > 1
        return pa.table(
            {
                "chunk": asked["chunk"].to_numpy()[repeated],
                "k": asked["k"].to_numpy()[repeated],
                "first": shard.firsts[shard.holder[slots[repeated]]],
            }
        )

    keys = chunks.filter(F.col("k").isNotNull()).select("chunk", "k", "a", "b", _shard(shards))
    parts = materialize(
        keys.groupBy("shard").agg(F.ceil(F.count("*") / probes).cast("bigint").alias("parts")),
        "probe-parts",
    )
    asked = keys.join(parts, "shard").select(
        "shard", F.pmod(F.xxhash64("chunk"), "parts").alias("part"), "chunk", "k", "a", "b"
    )
    repeated = index.join(parts, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), "index"
    )
    rows = asked.unionByName(repeated, allowMissingColumns=True)
    return rows.groupBy("shard", "part").applyInArrow(answer, "chunk bigint, k int, first bigint")


def _finish(group: pa.Table) -> pa.Table:
    """The chunk's documents without the lines that a smaller doc_id holds."""
    import pickle

    import zstandard

    at = group["payload"].is_valid().to_numpy(zero_copy_only=False)
    payload = group["payload"].filter(pa.array(at))[0].as_py()
    docs, numbers = pickle.loads(zstandard.ZstdDecompressor().decompress(payload))
    numbers = np.frombuffer(numbers, dtype=np.int32)
    holder = np.full(max(numbers.max(initial=-1) + 2, 1), np.iinfo(np.int64).max)
    answers = group.filter(pa.array(~at))
    holder[answers["k"].to_numpy()] = answers["first"].to_numpy()
    # Number -1 finds the last entry, which is never below a doc_id.
    first = holder[numbers]
    out, begin = [], 0
    for doc_id, data in docs:
        lines = data.split(b"\n")
        mine = first[begin : begin + len(lines)]
        begin += len(lines)
        stays = np.ones(len(lines), dtype=bool) if doc_id is None else mine >= doc_id
        kept = int(stays.sum())
        if kept < len(lines):
            data = b"\n".join([line for line, stay in zip(lines, stays.tolist(), strict=True) if stay])
        out.append((doc_id, len(lines), len(lines) - kept, data.decode()))
    return pa.Table.from_batches([batch_of(out, _KEPT_ARROW)])


def drop_repeated_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) for every row: the text without lines whose key a
    document with a smaller doc_id holds."""
    chunks = chunks_of(documents)
    shards = share_of(chunks.filter(F.col("k").isNotNull()).count(), SHARD_KEYS)
    answers = probe(chunks, line_index(chunks, shards), shards)
    texts = chunks.filter(F.col("payload").isNotNull()).select("chunk", "payload")
    rows = texts.unionByName(answers, allowMissingColumns=True)
    return rows.groupBy("chunk").applyInArrow(_finish, _KEPT)
