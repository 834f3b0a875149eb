"""Runs of repeated words (maximal repetitions), with a grammar made by recompression.

A run is a stretch of words with a smallest period q, at least ``max(MIN_WORDS, 2 * q)``
long, that keeps its period with neither neighbour.

1. Texts of a batch become one sequence of word numbers, texts parted by symbols of their
   own. Recompression alternates two steps until every text is one symbol: stretches of one
   symbol become a symbol (block compression), then pairs of neighbours from two halves of
   the alphabet become a symbol (pair compression). The levels are a run-length grammar.
2. Equal stretches are parsed alike but for their edges, so how far two places agree, to the
   right or to the left, is found by climbing the levels while symbols agree, and down again,
   with a bounded number of comparisons a level. A stretch of equal symbols is one step.
3. A run of period p holds two neighbours of the grid 0, p, 2p, ... Neighbours with equal words
   are candidates, and their extensions in both directions give the run exactly. A run found
   with several periods keeps the smallest.

All numbers are exact names, nothing is hashed. Batches are parts of one task's rows, a text
is whole in its batch, and nothing is shuffled.

Cases: a NULL or empty text has no words and no run; a NULL doc_id is a document like any
other; equal rows are all returned; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.tables import python_tasks

MIN_WORDS = 12
BATCH_WORDS = 400_000
LONG_WORDS = 1_500  # longer texts get batches of their own, as their periods may be longer
CANDIDATES = 400_000  # extended at once

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = (
    "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>,"
    " text string"
)


class Level:
    """Symbols of one level and how they are grouped into those of the next.

    ``owner`` is the next level's place of each symbol, ``down`` the first member of each
    place of the next level; ``blocks`` tells whether the groups are stretches of one symbol.
    """

    def __init__(self, symbols: np.ndarray, opens: np.ndarray, blocks: bool):
        self.symbols, self.blocks = symbols, blocks
        self.owner = (np.cumsum(opens) - 1).astype(np.int32)
        self.down = np.append(np.flatnonzero(opens), len(symbols)).astype(np.int32)


class Grammar:
    """Levels over a sequence of word numbers in which each number below zero is unique."""

    def __init__(self, words: np.ndarray, texts: int):
        self.levels: list[Level] = []
        symbols = words.astype(np.int64)
        names = int(words.max(initial=0)) + 1
        turn = 0
        while len(symbols) > 2 * texts + 1:
            symbols, names = self._blocks(symbols, names)
            if len(symbols) > 2 * texts + 1:
                symbols, names = self._pairs(symbols, names, turn)
            turn += 1
        self.top = symbols

    def _add(self, symbols, opens, first, second, grouped, names, blocks):
        """Group symbols; a group named by (first, second) gets one number for each name."""
        self.levels.append(Level(symbols, opens, blocks))
        merged = symbols[opens]
        _, number = np.unique(first * (names + len(symbols) + 1) + second, return_inverse=True)
        merged[grouped] = names + number
        return merged, names + int(number.max()) + 1

    def _blocks(self, symbols, names):
        opens = np.ones(len(symbols), dtype=bool)
        opens[1:] = symbols[1:] != symbols[:-1]
        if opens.all():
            return symbols, names
        at = np.flatnonzero(opens)
        size = np.diff(np.append(at, len(symbols)))
        grouped = np.flatnonzero(size > 1)
        return self._add(symbols, opens, symbols[at[grouped]], size[grouped], grouped, names, True)

    def _pairs(self, symbols, names, turn):
        mixed = (symbols.astype(np.uint64) + np.uint64(turn + 1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        half = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63)).astype(bool)
        inside = symbols >= 0
        left, right = half & inside, ~half & inside
        pairs = left[:-1] & right[1:]
        other = right[:-1] & left[1:]
        if other.sum() > pairs.sum():
            pairs = other
        if not pairs.any():
            return symbols, names
        opens = np.ones(len(symbols), dtype=bool)
        opens[1:] = ~pairs
        at = np.flatnonzero(pairs)
        grouped = (np.cumsum(opens) - 1)[at]
        return self._add(symbols, opens, symbols[at], symbols[at + 1], grouped, names, False)

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
        """How many words agree from places i and j on, or before them if ``back``. The words
        end with a unique number at both ends, so every agreement ends."""
        x, y = i.astype(np.int64), j.astype(np.int64)
        height = np.zeros(len(x), dtype=np.int64)
        rising = np.arange(len(x))
        for at, level in enumerate(self.levels):
            rising = self._walk(level, x, y, rising, back, climb=True)
            if not len(rising):
                break
            x[rising], y[rising] = level.owner[x[rising]], level.owner[y[rising]]
            height[rising] = at + 1
        if len(rising):
            self._step_along(self.top, x, y, rising, back)
        for at in range(len(self.levels) - 1, -1, -1):
            level = self.levels[at]
            falling = np.flatnonzero(height > at)
            if not len(falling):
                continue
            x[falling], y[falling] = level.down[x[falling]], level.down[y[falling]]
            self._walk(level, x, y, falling, back, climb=False)
        return i - x if back else x - i

    @staticmethod
    def _walk(level, x, y, some, back, climb) -> np.ndarray:
        """Move ``some`` places on while symbols agree. With ``climb``, those that agree and
        have a group of the next level open at both places stop there and are returned."""
        climbed = []
        shift = 1 if back else 0
        while len(some):
            here, there = x[some], y[some]
            same = level.symbols[here - shift] == level.symbols[there - shift]
            some, here, there = some[same], here[same], there[same]
            if climb:
                ready = level.down[level.owner[here]] == here
                ready &= level.down[level.owner[there]] == there
                climbed.append(some[ready])
                some, here, there = some[~ready], here[~ready], there[~ready]
            if not len(some):
                break
            if not level.blocks:
                move = 1
            elif back:
                ends = [p - level.down[level.owner[p - 1]] for p in (here, there)]
                move = np.minimum(*ends)
            else:
                ends = [level.down[level.owner[p] + 1] - p for p in (here, there)]
                move = np.minimum(*ends)
            x[some] = here - move if back else here + move
            y[some] = there - move if back else there + move
        return np.concatenate(climbed) if climbed else np.zeros(0, dtype=np.int64)

    @staticmethod
    def _step_along(symbols, x, y, some, back) -> None:
        shift, move = (1, -1) if back else (0, 1)
        while len(some):
            some = some[symbols[x[some] - shift] == symbols[y[some] - shift]]
            x[some] += move
            y[some] += move


def find_runs(texts: list[np.ndarray], least: int = MIN_WORDS) -> list[np.ndarray]:
    """Runs of texts given as arrays of word numbers from zero: one row (start, end,
    period, text) each, by text, start and period."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    words = np.full(int(ends[-1]) + 1, -1, dtype=np.int64)
    starts = np.append(1, ends[:-1] + 1)
    for start, text in zip(starts.tolist(), texts, strict=True):
        words[start : start + len(text)] = text
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    owner = np.concatenate(([-1], owner))
    parted = np.flatnonzero(words < 0)
    words[parted] = -1 - np.arange(len(parted))
    grammar = Grammar(words, len(texts))
    longest = max(map(len, texts))
    found, held, size = [], [], 0

    def extend() -> None:
        i, p = (np.concatenate(c) for c in zip(*held, strict=True))
        right = grammar.extend(i, i + p, back=False)
        # The run starts less than p before its first neighbour on the grid.
        some = right >= np.maximum(least + 1 - 2 * p, 1)
        i, p, right = i[some], p[some], right[some]
        left = grammar.extend(i, i + p, back=True)
        some = (left < p) & (left + right >= np.maximum(least - p, p))
        found.append(np.stack([(i - left)[some], (i + right + p)[some], p[some]]))

    for p in range(1, longest // 2 + 1):
        grid = words[::p]
        i = np.flatnonzero(grid[1:] == grid[:-1]) * p
        i = i[owner[i] == owner[i + p]]
        if len(i):
            held.append((i, np.full(len(i), p)))
            size += len(i)
            if size >= CANDIDATES:
                extend()
                held, size = [], 0
    if held:
        extend()
    start, end, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), dtype=np.int64)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    text = owner[start]
    return [start - starts[text], end - starts[text], period, text]


def _answers(docs: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
    number: dict[bytes, int] = {}
    texts = [
        np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
        for _, words in docs
    ]
    start, end, period, text = find_runs(texts)
    edges = np.searchsorted(text, np.arange(len(docs) + 1))
    out = []
    for n, (doc_id, words) in enumerate(docs):
        mine = slice(edges[n], edges[n + 1])
        runs = np.stack([start[mine], (end - start)[mine], period[mine]], axis=1).tolist()
        if runs:
            depth = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(depth, start[mine] + period[mine], 1)
            np.add.at(depth, end[mine], -1)
            kept = np.flatnonzero(np.cumsum(depth)[:-1] == 0)
            left = [words[i] for i in kept.tolist()]
        else:
            left = words
        named = [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]
        out.append((doc_id, len(words), named, b" ".join(left).decode()))
    kinds = [pa.int64(), pa.int64(), pa.list_(_RUN), pa.string()]
    names = ["doc_id", "n_words", "runs", "text"]
    columns = zip(*out, strict=True)
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def collapse_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, text) for every row: the runs by start and period, and the
    words joined by one space, of each run only the first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Short and long texts apart: a batch is searched up to its longest period.
        held: list[list] = [[], []]
        sizes = [0, 0]
        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                words = (text.as_py() or "").encode().split()
                kind = int(len(words) > LONG_WORDS)
                held[kind].append((doc_id, words))
                sizes[kind] += len(words) + 1
                if sizes[kind] >= BATCH_WORDS:
                    yield _answers(held[kind])
                    held[kind], sizes[kind] = [], 0
        for docs in held:
            if docs:
                yield _answers(docs)

    python_tasks(documents.sparkSession)
    slim = documents.select(F.col("doc_id").cast("bigint"), "text")
    return slim.mapInArrow(run, _FOUND)
