"""Removal of passages that repeat across documents, on a de Bruijn graph of words.

A node is a window of 13 words that documents with different ids hold; the one with the
smallest id is its source. An edge is a stretch of 14 words of a document from one node to the
next.

1. Windows meet by hash. A task first settles what its own documents repeat among
   themselves and sends a window only for the smallest of them, so a passage that a third of all
   documents share sends one window per task and not one per document.
2. The nodes meet their documents again, which give the edges, each once per group of
   documents. Nodes that several edges leave, or enter, are found by grouping the edges, and
   joins with them tell which edges branch.
3. Where no edge branches, the nodes of a document compact into a path: a stretch of windows that
   follow each other in the document and in their source.
4. Paths meet the texts of both ends by coordinate. The words they cover are removed,
   and the two texts are compared there. If a hash has lied, all is done again with
   hashes twice as wide.

What travels of windows and texts is packed: hashes, places and texts of many documents in one
row, dealt by hash range or document group, whose sizes do not depend on the input.

Cases: a NULL text has no words; a NULL doc_id neither loses words nor is a source;
rows of one doc_id never remove words from each other; equal rows are treated alike and
all returned; texts under 13 words have no window; no rows give no rows; other columns
are ignored or, in ``remove_repeats``, kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.packed import (
    KEY_MASK, ROW, ROW_ARROW, batch_of, hash_words, pack, steps, text_key, unpack,
)
from lanewise.llm.tables import SPACE, bound, python_tasks, share_of
from lanewise.session import delete_folder, materialize

WINDOW = 13
CHUNK_BYTES = 6_000_000  # of text, whose edges a task settles among themselves
RANGE_BYTES = 8_000_000  # of text, for one range of hashes: over a million windows
GROUP_BYTES = 8_000_000  # of text, for one group of documents

EDGES, LOCAL = 0, 1
SPANS, REQUESTS, TEXTS = 0, 1, 2

_RESULT = (
    "doc_id bigint, text_key bigint, n_words bigint, n_removed bigint, kept_sha256 string,"
    " kept array<struct<start:int,length:int>>, copy int, path bigint, own boolean, digest binary"
)
_MULTIPLIERS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]


def _edge_hashes(hashed: np.ndarray, wide: bool) -> list[np.ndarray]:
    """For every window of words, given their hashes: a hash that chooses its range, then
    one or two that name it."""
    n = len(hashed)
    out = []
    for multiplier in _MULTIPLIERS[: 3 if wide else 2]:
        total = np.zeros(n - WINDOW + 1, dtype=np.uint64)
        for j in range(WINDOW):
            total *= np.uint64(multiplier)
            total += hashed[j : n - WINDOW + 1 + j]
        total ^= total >> np.uint64(29)
        total *= np.uint64(multiplier)
        total ^= total >> np.uint64(32)
        out.append(total)
    return out


def _group_of(doc_id: np.ndarray, text_key: np.ndarray, groups: int) -> np.ndarray:
    mixed = doc_id.astype(np.uint64) * np.uint64(_MULTIPLIERS[0]) ^ text_key.view(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(_MULTIPLIERS[1])
    return ((mixed >> np.uint64(33)) % np.uint64(groups)).astype(np.int64)


_RESULT_ARROW = [
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()),
    ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("kept", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
    ("copy", pa.int32()), ("path", pa.int64()), ("own", pa.bool_()), ("digest", pa.binary()),
]


# Every pass writes its tables; what was shuffled for them is of no more use.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A mark says that the window of a document (doc, key) at a place is repeated in a source
# (doc, key) at a place, and by which hash. Marks are kept as seven parallel arrays. A source
# is marked with itself, as its window is a node as well.


def _pack_marks(marks: list[np.ndarray], groups: int) -> Iterator[tuple[int, bytes]]:
    """(document group, marks of the group); runs of places cost next to nothing."""
    group = _group_of(marks[0], marks[1], groups)
    order = np.lexsort((marks[2], marks[1], marks[0], group))
    marks = [m[order] for m in marks]
    edges = np.flatnonzero(np.diff(group[order])) + 1
    for part in np.split(np.arange(len(order)), edges):
        if len(part):
            doc, key, place, source, source_key, source_place, name = [m[part] for m in marks]
            packed = [doc, key, place, source, source_key, source_place - place]
            yield int(group[order[part[0]]]), pack(*map(steps, packed), name)


def _unpack_marks(payloads: list[bytes]) -> list[np.ndarray]:
    """By document and place, each once: a source other than itself goes first."""
    parts = []
    for payload in payloads:
        *packed, name = unpack(payload)
        parts.append([*map(np.cumsum, packed), name])
    marks = [np.concatenate(columns) for columns in zip(*parts, strict=True)]
    marks[5] = marks[5] + marks[2]
    order = np.lexsort((_own(marks), marks[2], marks[1], marks[0]))
    marks = [m[order] for m in marks]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([m[1:] != m[:-1] for m in marks[:3]], axis=0)
    return [m[new] for m in marks]


def _own(marks: list[np.ndarray]) -> np.ndarray:
    """Which marks are those of sources."""
    doc, key, place, source, source_key, source_place, _ = marks
    return (doc == source) & (key == source_key) & (place == source_place)


def _follows(marks: list[np.ndarray]) -> np.ndarray:
    """Which marks follow the one before in the same document."""
    doc, key, place = marks[:3]
    out = np.zeros(len(place), dtype=bool)
    out[1:] = (place[1:] == place[:-1] + 1) & (doc[1:] == doc[:-1]) & (key[1:] == key[:-1])
    return out


def _marks_of(rows: list[np.ndarray], name: np.ndarray, first: np.ndarray, repeated: np.ndarray):
    """Marks of the repeated windows and of their sources, given (doc, key, place)."""
    at = np.flatnonzero(repeated)
    sources = np.unique(first[at])
    at = np.concatenate((at, sources))
    source = np.concatenate((first[at[: len(at) - len(sources)]], sources))
    return [*[c[at] for c in rows], *[c[source] for c in rows], name[at].view(np.int64)]


def _settle(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For edges given in the order (document, place): the position of each edge's first
    holder, and whether the edge is in a document of another id than that holder."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    opens = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    first = np.empty(len(order), dtype=np.int64)
    first[order] = order[np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))]
    return first, doc != doc[first]


def _settle_wide(hashes: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_settle`` for edges named by two hashes: equal pairs become equal numbers."""
    if len(hashes) == 1:
        return _settle(hashes[0], doc)
    order = np.lexsort(hashes)
    changed = np.zeros(len(order), dtype=bool)
    for h in hashes:
        changed[1:] |= h[order][1:] != h[order][:-1]
    numbers = np.empty(len(order), dtype=np.int64)
    numbers[order] = np.cumsum(changed)
    return _settle(numbers, doc)


def _chunk_rows(
    docs: list[tuple[int, int, np.ndarray]], ranges: int, groups: int, wide: bool
) -> Iterator[tuple[int, int, bytes]]:
    """Packed edges by range and locally known marks by document group; ``docs`` are
    (doc_id, text key, hashes of the words)."""
    docs = sorted(docs, key=lambda d: d[:2])
    counts = [len(words) - WINDOW + 1 for _, _, words in docs]
    hashes = zip(*[_edge_hashes(words, wide) for _, _, words in docs], strict=True)
    columns = [np.concatenate(c) for c in hashes]
    doc = np.repeat(np.array([d for d, _, _ in docs], dtype=np.int64), counts)
    key = np.repeat(np.array([k for _, k, _ in docs], dtype=np.int64), counts)
    place = np.concatenate([np.arange(n, dtype=np.int64) for n in counts])
    first, repeated = _settle_wide(columns[1:], doc)
    if repeated.any():
        marks = _marks_of([doc, key, place], columns[1], first, repeated)
        for group, payload in _pack_marks(marks, groups):
            yield ranges + group, LOCAL, payload
    sent = np.flatnonzero(~repeated)
    upper = columns[0][sent] >> np.uint64(32)
    part = (upper * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    by_part = np.argsort(part, kind="stable")
    sent, part = sent[by_part], part[by_part]
    for rows in np.split(np.arange(len(sent)), np.flatnonzero(np.diff(part)) + 1):
        if not len(rows):
            continue
        at = sent[rows]
        docs_here = np.flatnonzero(np.concatenate(
            ([True], (doc[at[1:]] != doc[at[:-1]]) | (key[at[1:]] != key[at[:-1]]))
        ))
        sizes = np.diff(np.append(docs_here, len(at)))
        heads = at[docs_here]
        places = steps(place[at]).astype(np.int32)
        named = pack(steps(doc[heads]), key[heads], sizes.astype(np.int32), places)
        raw = b"".join([c[at].tobytes() for c in columns[1:]])
        yield int(part[rows[0]]), EDGES, len(named).to_bytes(4, "little") + named + raw


def _edge_parts(payload: bytes, wide: bool) -> tuple[bytes, np.ndarray]:
    """Packed documents and places, and the hashes, one row for each kind."""
    size = int.from_bytes(payload[:4], "little")
    raw = np.frombuffer(payload, np.uint64, offset=4 + size)
    return payload[4 : 4 + size], raw.reshape(2 if wide else 1, -1)


def _edges_at(named: bytes, chosen: np.ndarray) -> list[np.ndarray]:
    """(doc, key, place) of the chosen edges of a payload."""
    doc, key, sizes, places = unpack(named)
    places = np.cumsum(places.astype(np.int64))[chosen]
    owner = np.repeat(np.arange(len(sizes)), sizes)[chosen]
    return [np.cumsum(doc)[owner], key[owner], places]


def _twice(hashes: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(hashes), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _repeated_edges(documents: DataFrame, ranges: int, groups: int, wide: bool) -> DataFrame:
    """Marks of all edges that a document with a smaller id holds, by document group."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def rows() -> pa.RecordBatch:
            words, counts = hash_words([data for _, data in held])
            parts = np.split(words, np.cumsum(counts)[:-1])
            docs = [
                (doc_id, text_key(data), part)
                for (doc_id, data), part in zip(held, parts, strict=True)
                if len(part) >= WINDOW
            ]
            return batch_of(
                list(_chunk_rows(docs, ranges, groups, wide)) if docs else [], ROW_ARROW
            )

        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                data = (text.as_py() or "").encode()
                held[(doc_id, data)] = None
                size += len(data) + 1
                if size >= CHUNK_BYTES:
                    yield rows()
                    held, size = {}, 0
        if held:
            yield rows()

    def meet(group: pa.Table) -> pa.Table:
        kinds, payloads = group["kind"].to_numpy(), group["payload"].to_pylist()
        key = group["key"][0].as_py()
        if kinds[0] == LOCAL:
            out = [(key - ranges, LOCAL, payload) for payload in payloads]
            return pa.Table.from_batches([batch_of(out, ROW_ARROW)])
        parts = [_edge_parts(p, wide) for p in payloads]
        ends = np.cumsum([h.shape[1] for _, h in parts])
        # Documents and places are unpacked for edges that occur twice, and for no others.
        twice = np.split(_twice(np.concatenate([h[0] for _, h in parts])), ends[:-1])
        rows = [
            [*_edges_at(named, chosen), *[h[chosen] for h in hashes]]
            for (named, hashes), chosen in zip(parts, twice, strict=True)
            if chosen.any()
        ]
        columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
        columns = columns or [np.zeros(0, dtype=np.int64)] * 4
        order = np.lexsort((columns[2], columns[1], columns[0]))
        doc, key, place, *hashes = [c[order] for c in columns]
        out = []
        if len(order):
            first, repeated = _settle_wide(hashes, doc)
            marks = _marks_of([doc, key, place], hashes[0], first, repeated)
            out = [(g, LOCAL, payload) for g, payload in _pack_marks(marks, groups)]
        return pa.Table.from_batches([batch_of(out, ROW_ARROW)])

    edges = documents.select("doc_id", "text").mapInArrow(scan, ROW)
    return edges.groupBy("key").applyInArrow(meet, ROW)


def _edge_names(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each edge. Edges that share one are cut alike, which parts a path in two
    and changes nothing else."""
    mixed = a.view(np.uint64) * np.uint64(_MULTIPLIERS[0]) + b.view(np.uint64)
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(_MULTIPLIERS[1])


def _branching_edges(marks: DataFrame) -> DataFrame:
    """(key, a, b): edges from node a to node b, per document group that has them, where
    another edge leaves a or enters b."""

    def follow(group: pa.Table) -> pa.Table:
        marks = _unpack_marks(group["payload"].to_pylist())
        after = np.flatnonzero(_follows(marks))
        name = marks[6]
        _, once = np.unique(_edge_names(name[after - 1], name[after]), return_index=True)
        key = np.full(len(once), group["key"][0].as_py())
        return pa.table({"key": key, "a": name[after - 1][once], "b": name[after][once]})

    edges = materialize(
        marks.groupBy("key").applyInArrow(follow, "key bigint, a bigint, b bigint"), "node-edges"
    )
    # An end with more than one other end; no edge has to be counted twice or sent whole for that.
    several = [
        edges.groupBy(end).agg(F.min(other).alias("one"), F.max(other).alias("two"))
        .filter(F.col("one") != F.col("two")).select(end)
        for end, other in (("a", "b"), ("b", "a"))
    ]
    leaving, entering = [materialize(nodes, "branching-nodes") for nodes in several]
    return edges.join(leaving, "a", "left_semi").unionByName(
        edges.join(entering, "b", "left_semi")
    )


def _paths(marks: DataFrame, branching: DataFrame, groups: int) -> DataFrame:
    """Nodes compacted into paths: to the document's group as spans, and to the source's
    group as requests, each once."""

    def compact(group: pa.Table) -> pa.Table:
        payloads = [p for p in group["payload"].to_pylist() if p is not None]
        marks = _unpack_marks(payloads)
        cut = group.filter(group["payload"].is_null())
        follows = _follows(marks)
        if len(cut):
            branches = np.unique(_edge_names(cut["a"].to_numpy(), cut["b"].to_numpy()))
            after = np.flatnonzero(follows)
            own = _edge_names(marks[6][after - 1], marks[6][after])
            at = np.minimum(np.searchsorted(branches, own), len(branches) - 1)
            follows[after[branches[at] == own]] = False
        other = ~_own(marks)
        doc, key, place, source, source_key, source_place, _ = marks
        shift = source_place - place
        opens = ~follows
        for column in (source, source_key, shift, other):
            opens[1:] |= column[1:] != column[:-1]
        at = np.flatnonzero(opens)
        length = np.diff(np.append(at, len(place)))
        at, length = at[other[at]], length[other[at]]
        spans = [c[at] for c in (doc, key, place, source, source_key)]
        spans += [shift[at] + place[at], length]
        if not len(at):
            return pa.Table.from_batches([batch_of([], ROW_ARROW)])
        out = [(group["key"][0].as_py(), SPANS, pack(*spans))]
        wanted = np.unique(np.stack(spans[3:], axis=1), axis=0)
        home = _group_of(wanted[:, 0].copy(), wanted[:, 1].copy(), groups)
        by_home = np.argsort(home, kind="stable")
        for rows in np.split(by_home, np.flatnonzero(np.diff(home[by_home])) + 1):
            out.append((int(home[rows[0]]), REQUESTS, pack(*wanted[rows].T.copy())))
        return pa.Table.from_batches([batch_of(out, ROW_ARROW)])

    rows = marks.select("key", "payload").unionByName(branching, allowMissingColumns=True)
    return rows.groupBy("key").applyInArrow(compact, ROW)


def _packed_texts(documents: DataFrame, groups: int) -> DataFrame:
    """Whole texts by document group, equal rows counted."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        import zstandard

        def rows(held: dict) -> pa.RecordBatch:
            ids = np.array([d for d, _ in held], dtype=np.int64)
            keys = np.array([text_key(data) for _, data in held], dtype=np.int64)
            by_group: dict[int, list] = {}
            for g, key, ((doc_id, data), n) in zip(
                _group_of(ids, keys, groups).tolist(), keys.tolist(), held.items(), strict=True
            ):
                by_group.setdefault(g, []).append((doc_id, key, n, data))
            squeeze = zstandard.ZstdCompressor(level=3).compress
            return batch_of(
                [(g, TEXTS, squeeze(pickle.dumps(docs, protocol=5))) for g, docs in by_group.items()],
                ROW_ARROW,
            )

        held, size = {}, 0
        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                data = (text.as_py() or "").encode()
                held[(doc_id, data)] = held.get((doc_id, data), 0) + 1
                size += len(data)
                if size >= GROUP_BYTES:
                    yield rows(held)
                    held, size = {}, 0
        if held:
            yield rows(held)

    return documents.select("doc_id", "text").mapInArrow(scan, ROW)


def _path_key(source: int, source_key: int, place: int, length: int) -> int:
    import xxhash

    name = b"%d %d %d %d" % (source, source_key, place, length)
    return xxhash.xxh64_intdigest(name) - (1 << 63)


def _digest(words: list[bytes], place: int, edges: int) -> bytes:
    covered = b" ".join(words[place : place + edges + WINDOW - 1])
    return hashlib.blake2b(covered, digest_size=16).digest()


def _runs(keep: np.ndarray) -> list[dict]:
    """Stretches of kept words."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], keep, [False])).astype(np.int8)))
    return [
        {"start": a, "length": b - a}
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
    ]


def _apply(rows: DataFrame) -> DataFrame:
    """Per document what is left of it, and digests of both ends of every path."""

    def finish(group: pa.Table) -> Iterator[pa.RecordBatch]:
        import pickle

        import zstandard

        paths: dict[tuple, list] = {}
        requests: dict[tuple, list] = {}
        texts = []
        for kind, payload in zip(group["kind"].to_pylist(), group["payload"], strict=True):
            if kind == TEXTS:
                texts.append(payload)
                continue
            columns = [c.tolist() for c in unpack(payload.as_py())]
            if kind == SPANS:
                for doc, key, *rest in zip(*columns, strict=True):
                    paths.setdefault((doc, key), []).append(rest)
            else:
                for doc, key, place, length in zip(*columns, strict=True):
                    requests.setdefault((doc, key), []).append((place, length))
        seen = set()
        for payload in texts:
            out = []
            for doc_id, key, n, data in pickle.loads(
                zstandard.ZstdDecompressor().decompress(payload.as_py())
            ):
                words = data.split()
                own = paths.get((doc_id, key), [])
                keep = np.ones(len(words), dtype=bool)
                for place, _, _, _, length in own:
                    keep[place : place + length + WINDOW - 1] = False
                removed = len(words) - int(keep.sum())
                kept = words
                if removed:
                    kept = [words[i] for i in np.flatnonzero(keep).tolist()]
                left = b" ".join(kept)
                spans = _runs(keep) if removed else None
                row = (doc_id, key, len(words), removed, hashlib.sha256(left).hexdigest(), spans)
                again = (doc_id, key) in seen
                out.extend((*row, i + again, None, None, None) for i in range(n))
                if again:
                    continue
                seen.add((doc_id, key))
                blank = (None,) * 7
                out.extend(
                    (*blank, _path_key(*rest), True, _digest(words, place, rest[3]))
                    for place, *rest in own
                )
                out.extend(
                    (*blank, _path_key(doc_id, key, *want), False, _digest(words, *want))
                    for want in requests.get((doc_id, key), [])
                )
            yield batch_of(out, _RESULT_ARROW)

    def whole(group: pa.Table) -> pa.Table:
        batches = list(finish(group))
        return pa.Table.from_batches(batches or [batch_of([], _RESULT_ARROW)])

    return rows.groupBy("key").applyInArrow(whole, _RESULT)


def _settled(known: DataFrame) -> DataFrame:
    """A written row for every row of (doc_id, text), paths verified. Equal rows differ in
    ``copy``, which is zero once; ``kept`` are the stretches of words that are left, where
    any are removed."""
    python_tasks(known.sparkSession)
    size = known.agg(F.sum(F.octet_length("text"))).first()[0]
    ranges, groups = share_of(size, RANGE_BYTES), share_of(size, GROUP_BYTES)
    spark = known.sparkSession
    cleaned = spark.conf.get(CLEAN_SHUFFLES)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        for wide in (False, True):
            marks = materialize(_repeated_edges(known, ranges, groups, wide), "repeated-windows")
            paths = materialize(_paths(marks, _branching_edges(marks), groups), "repeated-paths")
            for folder in {path.rsplit("/", 1)[0] for path in marks.inputFiles()}:
                delete_folder(spark, folder)
            results = materialize(
                _apply(_packed_texts(known, groups).unionByName(paths)), "repeats-removed"
            )
            digests = results.filter(F.col("path").isNotNull()).select("path", "own", "digest")
            sources = digests.filter(~F.col("own")).select("path", "digest")
            false = digests.filter("own").join(sources, ["path", "digest"], "left_anti")
            if false.isEmpty():
                return results.filter(F.col("path").isNull())
    finally:
        spark.conf.set(CLEAN_SHUFFLES, cleaned)
    raise RuntimeError("paths differ from their sources by either hash")


def repeats_removed(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row; the digest is that of the
    kept words joined by one space."""
    chosen = documents.select(F.col("doc_id").cast("bigint"), "text")
    found = _settled(chosen.filter(F.col("doc_id").isNotNull()))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE), "")
    unknown = chosen.filter(F.col("doc_id").isNull()).select(
        "doc_id",
        F.size(words).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"),
    )
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(unknown)


def remove_repeats(documents: DataFrame, chars: str = "n_chars") -> DataFrame:
    """The documents with their columns. One that loses words keeps the others joined by
    one space, which may be none, and their length in ``chars``, if it has that column."""
    known = documents.filter(F.col("doc_id").isNotNull())
    settled = _settled(known.select(F.col("doc_id").cast("bigint"), "text"))
    changed = settled.filter((F.col("n_removed") > 0) & (F.col("copy") == 0)).select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), F.col("kept").alias("_kept")
    )
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    joined = rows.join(
        changed,
        (F.col("row.doc_id") == F.col("_doc"))
        & (
            F.xxhash64(F.coalesce("row.text", F.lit(""))).bitwiseAND(F.lit(KEY_MASK))
            == F.col("_key")
        ),
        "left",
    )
    lost = F.col("_kept").isNotNull()
    words = F.array_remove(F.split("row.text", SPACE), "")
    text = F.array_join(
        bound(
            words,
            lambda w: F.flatten(
                F.transform("_kept", lambda s: F.slice(w, s["start"] + 1, s["length"]))
            ),
        ),
        " ",
    )
    columns = []
    for field in documents.schema.fields:
        column = F.col(f"row.`{field.name}`")
        if field.name == "text":
            column = F.when(lost, text).otherwise(column)
        elif field.name == chars:
            column = F.when(lost, F.char_length(text).cast(field.dataType)).otherwise(column)
        columns.append(column.alias(field.name))
    return joined.select(*columns)
