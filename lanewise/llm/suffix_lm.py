"""Language model scoring with a probabilistic suffix tree.

A context is the last words before a token, up to ``MAX_DEPTH``. It becomes a state of the
tree if it and words that follow it occur ``MIN_COUNT`` times, at any size of the corpus, and
what follows it diverges enough from what follows its own suffix. A token is scored in the
longest suffix of the words before it that is a state. States discount what they have seen
and leave the rest to the shorter suffix, down to single tokens, so that probabilities add
up to one in every state, one unknown word included.

The tree is never in one place. It grows by one word of context at a time: chunks of
documents, learned or not, send the hashes of their grams whose parts are frequent to hash
ranges, which add up the counts and answer. One of the chunks that have a gram then adds its
terms to the sums of the gram's context; the context's range adds these up, tests it, and
tells the chunks that have it. It ends when no gram is frequent, or at ``MAX_DEPTH``; that
no context of some length is a state ends nothing, as longer ones may be.

A context that occurs as often as its suffix of one token less is always that suffix and the
same token before it. The same words follow both, as often, so that it wins nothing: it is
no state and is not tested.

Cases: a NULL text is an empty one, of one end token; a NULL doc_id is a document like
any other; repeated rows count and are scored each; if nothing is learned, a token has
probability one, that of the only (unknown) word; no rows give no rows; other columns
are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.llm.packed import (
    ROW, ROW_ARROW, _mix, batch_of, hash_words, pack, steps, unpack,
)
from lanewise.llm.tables import python_tasks, share_of
from lanewise.session import delete_folder, materialize

MIN_COUNT = 3
MAX_DEPTH = 16  # tokens of a context
DISCOUNT = 0.5
# Log-likelihood that a context must win over its suffix, in nats.
MIN_DIVERGENCE = 12.0
CHUNK_BYTES = 5_500_000
RANGE_BYTES = 32_000_000  # of text, for one hash range
# Chunks and answers that meet in one shuffle: a share of the text, or so many bytes.
MEETING_SHARE, MEETING_BYTES = 4, 100_000_000
END = np.uint64(0x5EED)
NO_ID = -(1 << 63)
# Every length writes its tables; what was shuffled for them is of no more use.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

COUNTS, PART, ASKED, SUMS, COUNTED, RESTS, FOUND = range(7)
_SCORED = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
_SCORED_NAMES = ["doc_id", "n_tokens", "n_known", "base_score", "score"]


def _range_of(values: np.ndarray, ranges: int) -> np.ndarray:
    """By the upper bits, so that values in order are in the order of their ranges."""
    upper = values.view(np.uint64) >> np.uint64(32)
    return ((upper * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values in order, place of each value among them, their first places).

    Sorts the values' upper bits with the places below them, much faster than by argsort.
    Values that differ in the lower bits only are sorted again if they came out of order.
    """
    if not len(values):
        return values, np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64((1 << len(values).bit_length()) - 1)
    keyed = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    keyed.sort()
    order = (keyed & low).astype(np.int64)
    ordered = values[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(values, kind="stable")
        ordered = values[order]
    opens = np.ones(len(values), dtype=bool)
    opens[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(values), dtype=np.int64)
    inverse[order] = np.cumsum(opens) - 1
    return ordered[opens], inverse, order[opens]


def _small(values: np.ndarray) -> np.ndarray:
    """Whole numbers from zero on in as few bytes as hold them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


Chunk = tuple[list[int], list[bytes], list[bool]]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """(doc_ids, texts, whether learned) of documents that together have about CHUNK_BYTES."""
    ids, texts, flags, size = [], [], [], 0
    for batch in batches:
        columns = [batch[0].to_pylist(), batch[1], batch[2].to_pylist()]
        for doc_id, text, flag in zip(*columns, strict=True):
            data = (text.as_py() or "").encode()
            ids.append(NO_ID if doc_id is None else doc_id)
            texts.append(data)
            flags.append(flag)
            size += len(data) + 1
            if size >= CHUNK_BYTES:
                yield ids, texts, flags
                ids, texts, flags, size = [], [], [], 0
    if ids:
        yield ids, texts, flags


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end token after each text, and tokens per text."""
    words, counts = hash_words(texts, lower=True)
    sizes = counts + 1
    out = np.full(len(words) + len(texts), END, dtype=np.uint64)
    is_word = np.ones(len(out), dtype=bool)
    is_word[np.cumsum(sizes) - 1] = False
    out[is_word] = words
    return out, sizes


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=4)
def _powers_upto(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    return _powers_upto(base, max(10, n.bit_length()))[:n]


def _grams(tokens: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the ``length`` tokens that end at each of the places ``ends``."""
    sums = np.zeros(len(tokens) + 1, dtype=np.uint64)
    np.cumsum(tokens * _powers(_BASE, len(tokens)), out=sums[1:])
    starts = ends - length + 1
    return _mix((sums[ends + 1] - sums[starts]) * _powers(_INVERSE, len(tokens))[starts])


def _shifted(values: np.ndarray, first) -> np.ndarray:
    out = np.empty_like(values)
    out[1:], out[:1] = values[:-1], first
    return out


@dataclass
class Part:
    """What a chunk of documents knows after the counts of grams of ``length`` tokens.

    By document: its doc_id, whether it is learned, its tokens and known tokens, its base
    score, and ``done``: what no longer context changes of its score. The rest lies in
    stretches, each a part of a document (``owner``); what no longer gram needs is let go
    by ``close``. By place in the stretches: the token's word, zero if no gram to come has
    it; the count of the gram of ``length`` that ends there (from two tokens on zero if not
    frequent), and whether the gram of one token less has another (``fresh``); ``past``, the
    count of the gram of one token less if it is a context to be tested, else zero; whether
    the place is the one of all chunks that stands for its gram (``owned``); and the place
    in ``levels`` of the token's log10 probability after contexts of ``length`` - 2 tokens at
    most. That is kept of frequent grams only, and is zero elsewhere: to other tokens longer
    contexts only add their rests, and those go to ``done``. ``singles`` has the counts of
    ``words``, and tells levels and shorter counts up to two tokens.
    """

    doc: np.ndarray
    learned: np.ndarray
    n_tokens: np.ndarray
    known: np.ndarray
    base: np.ndarray
    done: np.ndarray
    owner: np.ndarray
    sizes: np.ndarray
    words: np.ndarray
    singles: np.ndarray
    word: np.ndarray
    length: int
    least: int
    norm: float
    now: np.ndarray | None = None
    fresh: np.ndarray | None = None
    past: np.ndarray | None = None
    owned: np.ndarray | None = None
    levels: np.ndarray | None = None
    level: np.ndarray | None = None

    def packed(self) -> bytes:
        columns = [
            self.doc, _small(self.learned), _small(self.n_tokens), _small(self.known), self.base,
            self.done, _small(self.owner), _small(self.sizes), steps(self.words),
            _small(self.singles), _small(self.word),
        ]
        if self.length >= 2:
            columns += [_small(self.now), self.fresh, self.owned]
        if self.length >= 3:
            columns += [_small(self.past), self.levels, _small(self.level)]
        return pack(*columns)

    @classmethod
    def unpacked(cls, payload: bytes, length: int, least: int, norm: float) -> Part:
        columns = [c.astype(np.int64) if c.dtype.kind == "u" else c for c in unpack(payload)]
        columns[8] = np.cumsum(columns[8].view(np.uint64), dtype=np.uint64)
        part = cls(*columns[:11], length, least, norm)
        if length == 1:
            part.one_word()
        elif length >= 2:
            part.now, part.fresh, part.owned, *more = columns[11:]
            if more:
                part.past, part.levels, part.level = more
            else:
                part.past = part.tested(part.singles[part.word])
                part.single_levels()
        return part

    def one_word(self) -> None:
        self.now = self.singles[self.word]
        self.fresh = np.ones(len(self.word), dtype=bool)
        self.past = np.zeros(len(self.word), np.int64)
        self.owned = np.zeros(len(self.word), dtype=bool)
        self.single_levels()

    def single_levels(self) -> None:
        self.levels = np.append(0.0, np.log10(self.singles + 1.0) - self.norm)
        pending, grows = self.waiting()
        self.level = np.where((self.now >= self.least) & (pending | grows), self.word + 1, 0)

    def tested(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts >= self.least, counts, 0)

    @property
    def tokens(self) -> np.ndarray:
        return self.words[self.word]

    @property
    def place(self) -> np.ndarray:
        """Of each token in its stretch."""
        starts = np.cumsum(self.sizes) - self.sizes
        return np.arange(len(self.word)) - np.repeat(starts, self.sizes)

    @property
    def document(self) -> np.ndarray:
        return np.repeat(self.owner, self.sizes)

    def per_document(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.document, values, len(self.doc))

    def waiting(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether the context of ``length`` - 1 tokens is to be tested, by place, and whether
        that of ``length`` tokens is frequent."""
        place = self.place
        pending = (_shifted(self.past, 0) > 0) & (place >= self.length - 1)
        return pending, (_shifted(self.now, 0) >= self.least) & (place >= self.length)

    def close(self) -> None:
        """Keep the levels and words that longer grams need.

        A gram that may grow lies inside a stretch, as all its words are kept, and so does
        a context to be tested with the token after it.
        """
        often = self.now >= self.least
        pending, grows = self.waiting()
        is_open = pending | grows
        levelled = often & is_open
        scores = np.where(levelled, 0.0, self.levels[self.level])
        self.done = self.done + self.per_document(scores)
        self.level = np.where(levelled, self.level, 0)
        edge = np.zeros(len(self.word) + 1, dtype=np.int32)
        ends = ((np.flatnonzero(often), self.length), (np.flatnonzero(pending) - 1, self.length - 1))
        for at, size in ends:
            edge[at - size + 1] += 1
            edge[at + 1] -= 1
        covered = np.cumsum(edge[:-1]) > 0
        kept = np.flatnonzero(covered | is_open)
        stretch = np.repeat(np.arange(len(self.sizes)), self.sizes)[kept]
        opens = np.ones(len(kept), dtype=bool)
        opens[1:] = (np.diff(kept) != 1) | (stretch[1:] != stretch[:-1])
        at = np.flatnonzero(opens)
        self.owner, self.sizes = self.owner[stretch[at]], np.diff(np.append(at, len(kept)))
        self.now, self.past, self.fresh = self.now[kept], self.past[kept], self.fresh[kept]
        self.owned, self.level = self.owned[kept], self.level[kept]
        used = np.zeros(len(self.levels), dtype=bool)
        used[self.level] = True
        used[0] = True
        self.level, self.levels = (np.cumsum(used) - 1)[self.level], self.levels[used]
        # A token that is kept for its score alone is in no gram to come.
        used = np.zeros(len(self.words), dtype=bool)
        used[self.word[covered]] = True
        self.word = np.where(covered, np.cumsum(used)[self.word], 0)[kept]
        self.words = np.append(np.uint64(0), self.words[used])
        self.singles = np.append(0, self.singles[used])

    def asked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Grams of one token more whose parts are frequent: where they end, the distinct
        ones in order, the number of each, and where the distinct ones come first."""
        if not self.length:
            at = np.arange(len(self.word))
            return at, self.words, self.word, at[:0]
        often = self.now >= self.least
        at = np.flatnonzero(often & _shifted(often, False) & (self.place >= self.length))
        distinct, number, first = _distinct(_grams(self.tokens, at, self.length + 1))
        return at, distinct, number, at[first]

    def contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Contexts of ``length`` - 1 tokens to be tested: the places after them, the distinct
        ones in order, the number of each, and the counts of the distinct ones."""
        at = np.flatnonzero(self.waiting()[0])
        if self.length == 2:
            word = self.word[at - 1]
            used = np.zeros(len(self.words), dtype=bool)
            used[word] = True
            return at, self.words[used], (np.cumsum(used) - 1)[word], self.singles[used]
        distinct, number, first = _distinct(_grams(self.tokens, at - 1, self.length - 1))
        return at, distinct, number, self.past[at[first] - 1]

    def requests(self, ranges: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(range, grams, their learned occurrences here)."""
        at, distinct, number, _ = self.asked()
        n = np.bincount(number, self.learned[self.document[at]], len(distinct)).astype(np.int64)
        for part, rows in _split(distinct, ranges):
            yield part, distinct[rows], _small(n[rows])

    def sums(self, ranges: int) -> Iterator[tuple]:
        """(range, contexts, whether they have entries that are owned here, and of those that
        have: their counts, sums over these entries)."""
        at, distinct, number, total = self.contexts()
        entry = self.owned[at] & (self.now[at] >= self.least)
        of, own_at = number[entry], at[entry]
        n = self.now[own_at].astype(np.float64)
        own = (n - DISCOUNT) / self.past[own_at - 1]
        shorter = self.levels[self.level[own_at]]
        gain = n * (np.log(own) - shorter * np.log(10.0))
        columns = [np.bincount(of, v, len(distinct)) for v in (n, own, 10.0**shorter, gain)]
        has = np.zeros(len(distinct), dtype=bool)
        has[of] = True
        for part, rows in _split(distinct, ranges):
            some = has[rows]
            yield part, distinct[rows], some, *[c[rows][some] for c in (total, *columns)]

    def take_rests(self, answers: dict[int, list[np.ndarray]], ranges: int) -> None:
        """Take contexts of ``length`` - 1 tokens into the levels, or into what is done."""
        if self.length < 2:
            return
        at, distinct, number, _ = self.contexts()
        rest = np.full(len(distinct), np.nan)
        for part, rows in _split(distinct, ranges):
            rest[rows] = answers[part][0]
        rest = rest[number]
        at, rest = at[~np.isnan(rest)], rest[~np.isnan(rest)]
        seen = self.now[at] >= self.least
        document = self.document[at[~seen]]
        self.done = self.done + np.bincount(document, rest[~seen], len(self.doc))
        at = at[seen]
        own = np.log10((self.now[at] - DISCOUNT) / self.past[at - 1])
        levels, number, _ = _distinct(own.view(np.uint64))
        self.level[at] = len(self.levels) + number
        self.levels = np.append(self.levels, levels.view(np.float64))

    def take_counts(self, answers: dict[int, list[np.ndarray]], ranges: int) -> None:
        """Grow by one token."""
        at, distinct, number, first = self.asked()
        n, mine = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
        for part, rows in _split(distinct, ranges):
            n[rows], mine[rows] = answers[part]
        self.length += 1
        if self.length == 1:
            self.singles = n
            scores = (np.log10(n + 1.0) - self.norm)[self.word]
            self.known = self.per_document(n[self.word] > 0).astype(np.int64)
            self.base = self.per_document(scores)
            self.one_word()
            self.done = self.per_document(np.where(self.level == 0, scores, 0.0))
            return
        self.owned = np.zeros(len(self.word), dtype=bool)
        self.owned[first] = mine
        now = np.zeros(len(self.word), np.int64)
        now[at] = n[number]
        self.past = np.where(self.fresh, self.tested(self.now), 0)
        self.fresh, self.now = now != self.now, now


def _split(values: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """(range, places of its values) of values in order."""
    part = _range_of(values, ranges)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for start, end in zip(edges, edges[1:], strict=False):
        if end > start:
            yield int(part[start]), slice(start, end)


def _one(value: int) -> np.ndarray:
    return np.array([value], dtype=np.int64)


def _sent(part: Part, chunk: int, ranges: int, depth: int) -> list[tuple]:
    """What the part asks of the ranges."""
    rows = []
    if part.length <= depth:
        for to, *columns in part.requests(ranges):
            rows.append((to, ASKED, pack(_one(chunk), steps(columns[0]), *columns[1:])))
    if part.length >= 2:
        for to, *columns in part.sums(ranges):
            rows.append((to, SUMS, pack(_one(chunk), steps(columns[0]), *columns[1:])))
    return rows


def _by_chunk(payloads: list[bytes]) -> tuple[list[int], list[int], list[np.ndarray]]:
    """(chunks in order, their numbers of values, joined columns)."""
    parts = sorted((unpack(p) for p in payloads), key=lambda p: p[0][0])
    for p in parts:
        p[1] = np.cumsum(p[1], dtype=p[1].dtype)
    joined = [np.concatenate(c) for c in zip(*[p[1:] for p in parts], strict=True)]
    return [int(p[0][0]) for p in parts], [len(p[1]) for p in parts], joined


def _answered(group: pa.Table, length: int, least: int) -> pa.Table:
    """Counts of grams and rests of contexts of one hash range, to the chunks that asked."""
    part = group["key"][0].as_py()
    by_kind: dict[int, list[bytes]] = {ASKED: [], SUMS: []}
    for kind, payload in zip(group["kind"].to_pylist(), group["payload"].to_pylist(), strict=True):
        by_kind[kind].append(payload)
    out, total, distinct, frequent = [], 0, 0, 0
    if by_kind[ASKED]:
        chunks, sizes, (grams, n) = _by_chunk(by_kind[ASKED])
        values, number, first = _distinct(grams)
        counts = np.bincount(number, n, len(values)).astype(np.int64)
        total, distinct = int(counts.sum()), int((counts > 0).sum())
        frequent = int((counts >= least).sum())
        if length:
            counts[counts < least] = 0
        owner = np.zeros(len(grams), bool)
        owner[first] = counts >= least
        ends = np.cumsum(sizes)[:-1]
        columns = zip(np.split(counts[number], ends), np.split(owner, ends), strict=True)
        for chunk, (c, o) in zip(chunks, columns, strict=True):
            out.append((chunk, COUNTED, pack(_one(part), _small(c), o)))
    if by_kind[SUMS]:
        chunks, sizes, (contexts, some, total_of, *sums) = _by_chunk(by_kind[SUMS])
        values, number, _ = _distinct(contexts)
        at = number[some]
        of = np.zeros(len(values))
        of[at] = total_of
        n, own, shorter, gain = [np.bincount(at, v, len(values)) for v in sums]
        rest, shorter_rest = np.maximum(1 - own, 1e-12), np.maximum(1 - shorter, 1e-12)
        unseen = np.maximum(of - n, 0)
        gain = gain + unseen * (np.log(rest) - np.log(shorter_rest))
        chosen = (gain >= MIN_DIVERGENCE) & (n > 0)
        rests = np.where(chosen, np.log10(rest) - np.log10(shorter_rest), np.nan)
        for chunk, r in zip(chunks, np.split(rests[number], np.cumsum(sizes)[:-1]), strict=True):
            out.append((chunk, RESTS, pack(_one(part), r)))
    found = np.array([total, distinct, frequent], dtype=np.int64)
    out.append((part, FOUND, pack(found)))
    return pa.Table.from_batches([batch_of(out, ROW_ARROW)])


def _found(answers: DataFrame) -> tuple[int, int, int]:
    """(sum of counts, grams that occur, frequent grams) over all ranges."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64())]
        for batch in batches:
            yield batch_of([tuple(unpack(p.as_py())[0].tolist()) for p in batch[0]], names)

    rows = answers.filter(F.col("kind") == FOUND).select("payload")
    numbers = rows.mapInArrow(read, "a bigint, b bigint, c bigint")
    return tuple(v or 0 for v in numbers.agg(*[F.sum(c) for c in "abc"]).first())


def _part_of(group: pa.Table, length: int, least: int, norm: float) -> tuple[Part, dict, dict]:
    answers: dict[int, dict[int, list[np.ndarray]]] = {COUNTED: {}, RESTS: {}}
    part = None
    for kind, payload in zip(group["kind"].to_pylist(), group["payload"].to_pylist(), strict=True):
        if kind == PART:
            part = Part.unpacked(payload, length, least, norm)
        else:
            to, *columns = unpack(payload)
            answers[kind][int(to[0])] = columns
    return part, answers[COUNTED], answers[RESTS]


def _written_bytes(table: DataFrame) -> int:
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _drop(table: DataFrame) -> None:
    """Delete a table of an earlier length."""
    for folder in {path.rsplit("/", 1)[0] for path in table.inputFiles()}:
        delete_folder(table.sparkSession, folder)


def score(documents: DataFrame, learned: Column) -> tuple[DataFrame, int]:
    """Scores of all documents by a model of those where ``learned`` holds.

    Gives (doc_id, n_tokens, n_known, base_score, score), a row for every row, and the
    number of learned tokens. Scores are sums of log10 probabilities; the base score
    takes every token alone.
    """
    texts = documents.select(
        F.col("doc_id").cast("bigint"), "text", F.coalesce(learned, F.lit(True)).alias("learned")
    )
    python_tasks(documents.sparkSession)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = share_of(size, RANGE_BYTES)
    least, depth = MIN_COUNT, MAX_DEPTH

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for n, (ids, data, flags) in enumerate(_chunks(batches)):
            tokens, sizes = _tokens(data)
            words, word, _ = _distinct(tokens)
            none = np.zeros(len(data))
            zero = np.zeros(len(data), np.int64)
            part = Part(
                np.array(ids, np.int64), np.array(flags, np.int64), sizes, zero, none, none,
                np.arange(len(data)), sizes, words, np.zeros(0, np.int64), word, 0, least, 0.0,
            )
            yield batch_of([(first + n, PART, part.packed())], ROW_ARROW)

    def ask(length: int, base: float) -> Callable[[Iterator], Iterator[pa.RecordBatch]]:
        """Ask for grams of one token more and for contexts of one token less."""

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, payload in zip(batch[0].to_pylist(), batch[2], strict=True):
                    part = Part.unpacked(payload.as_py(), length, least, base)
                    yield batch_of(_sent(part, chunk, ranges, depth), ROW_ARROW)

        return step

    def longer(length: int, base: float) -> Callable[[pa.Table], pa.Table]:
        """Take the answers for grams of ``length``."""

        def step(group: pa.Table) -> pa.Table:
            part, counted, rests = _part_of(group, length - 1, least, base)
            part.take_rests(rests, ranges)
            part.take_counts(counted, ranges)
            part.close()
            row = (group["key"][0].as_py(), PART, part.packed())
            return pa.Table.from_batches([batch_of([row], ROW_ARROW)])

        return step

    def finish(length: int, base: float) -> Callable[[pa.Table], pa.Table]:
        def step(group: pa.Table) -> pa.Table:
            part, _, rests = _part_of(group, length, least, base)
            part.take_rests(rests, ranges)
            scores = part.done + part.per_document(part.levels[part.level])
            ids = pa.array(part.doc, mask=part.doc == NO_ID)
            columns = [part.n_tokens, part.known.astype(np.int64), part.base, scores]
            return pa.Table.from_arrays([ids, *map(pa.array, columns)], names=_SCORED_NAMES)

        return step

    def answers_to(parts: DataFrame, length: int, base: float) -> DataFrame:
        """What is asked is shuffled, but never written as a table."""
        asked = parts.mapInArrow(ask(length, base), ROW)
        answered = asked.groupBy("key").applyInArrow(
            lambda group: _answered(group, length, least), ROW
        )
        return materialize(answered, f"answers-{length}")

    def meeting(parts: DataFrame, answers: DataFrame):
        return parts.unionByName(answers.filter(F.col("kind") != FOUND)).groupBy("key")

    def grown(parts: DataFrame, answers: DataFrame, length: int, base: float) -> DataFrame:
        """The parts of one token more. Of large tables some chunks meet at a time, so that
        shuffle files never hold both tables once more."""
        both = _written_bytes(parts) + _written_bytes(answers)
        shares = share_of(both, max(size // MEETING_SHARE, MEETING_BYTES))
        share = F.pmod(F.col("key") + F.shiftrightunsigned("key", 32), F.lit(shares))
        tables = []
        for n in range(shares):
            met = meeting(parts.filter(share == n), answers.filter(share == n))
            step = met.applyInArrow(longer(length, base), ROW)
            tables.append(materialize(step, f"parts-{length}-{n}"))
        return functools.reduce(DataFrame.unionByName, tables)

    spark = documents.sparkSession
    cleaned = spark.conf.get(CLEAN_SHUFFLES)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        parts = materialize(texts.mapInArrow(scan, ROW), "parts-0")
        answers = answers_to(parts, 0, 0.0)
        total, distinct, _ = _found(answers)
        base = float(np.log10(total + distinct + 1))
        for length in range(1, depth + 2):
            old = parts, answers
            parts = grown(parts, answers, length, base)
            for table in old:
                _drop(table)
            answers = answers_to(parts, length, base)
            if not _found(answers)[2]:
                break
    finally:
        spark.conf.set(CLEAN_SHUFFLES, cleaned)
    return meeting(parts, answers).applyInArrow(finish(length, base), _SCORED), total
