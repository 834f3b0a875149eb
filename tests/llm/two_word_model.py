"""The suffix tree with contexts of one or two words, whole on the driver: what small tests
compare probabilities with."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.packed import ROW, ROW_ARROW, batch_of, pack, steps, unpack
from lanewise.llm.suffix_lm import (
    COUNTS, DISCOUNT, MIN_COUNT, MIN_DIVERGENCE, RANGE_BYTES, _chunks, _range_of, _tokens,
)
from lanewise.llm.tables import python_tasks, share_of
from lanewise.session import materialize

ID_BITS = 20


def _counted(values: np.ndarray, ranges: int) -> Iterator[tuple[int, int, bytes]]:
    """Distinct values and their counts, packed by hash range."""
    distinct, counts = np.unique(values, return_counts=True)
    yield from _by_range(distinct, counts, ranges)


def _by_range(
    distinct: np.ndarray, counts: np.ndarray, ranges: int
) -> Iterator[tuple[int, int, bytes]]:
    part = _range_of(distinct, ranges)
    order = np.argsort(part, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        if len(rows):
            packed = pack(steps(distinct[rows]), counts[rows].astype(np.int64))
            yield int(part[rows[0]]), COUNTS, packed


def _sum_counts(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(p) for p in payloads]
    values = np.concatenate([np.cumsum(v, dtype=v.dtype) for v, _ in parts])
    counts = np.concatenate([n for _, n in parts])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    opens = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[opens], np.add.reduceat(counts, opens)


def _count_over(
    texts: DataFrame,
    values_of: Callable[[np.ndarray, np.ndarray], np.ndarray],
    ranges: int,
    name: str,
) -> DataFrame:
    """Written table of summed counts of what ``values_of`` makes of (tokens, sizes), one
    packed row per hash range."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, _ in _chunks(batches):
            values = values_of(*_tokens(data))
            if len(values):
                yield batch_of(list(_counted(values, ranges)), ROW_ARROW)

    def add(group: pa.Table) -> pa.Table:
        values, counts = _sum_counts(group["payload"].to_pylist())
        row = (group["key"][0].as_py(), COUNTS, pack(steps(values), counts))
        return pa.Table.from_batches([batch_of([row], ROW_ARROW)])

    counted = texts.select(
        "doc_id", "text", F.lit(True).alias("learned")
    ).mapInArrow(scan, ROW)
    return materialize(counted.groupBy("key").applyInArrow(add, ROW), name)


def _totals(counts: DataFrame) -> tuple[int, int]:
    """(sum of counts, number of values)."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch[0]:
                _, n = unpack(payload.as_py())
                yield batch_of([(int(n.sum()), len(n))], [("n", pa.int64()), ("v", pa.int64())])

    sums = counts.select("payload").mapInArrow(total, "n bigint, v bigint")
    row = sums.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    return row.n or 0, row.v or 0


def _frequent(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Values counted ``least`` times or more, in order, with their counts.

    Comes to the driver: no more than the sum of all counts / ``least`` values.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch[0]:
                values, n = unpack(payload.as_py())
                values = np.cumsum(values, dtype=values.dtype).view(np.int64)
                many = n >= least
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[many]), pa.array(n[many])], names=["value", "n"]
                )

    found = counts.select("payload").mapInArrow(choose, "value bigint, n bigint").toArrow()
    values, n = found["value"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(values.view(np.uint64))
    return values[order], n[order]


def _find(ordered: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in an ordered array, or -1."""
    if not len(ordered):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return np.where(ordered[at] == wanted, at, -1)


def _none() -> np.ndarray:
    return np.zeros(0, dtype=np.int64)


@dataclass
class Tree:
    """Frequent tokens, pairs and triples by number, with log10 probabilities.

    A token's number is its place in ``hashes``, a pair's its place in ``pairs``; a pair
    is coded from two tokens' numbers, a triple from a pair's and a token's. The rest of
    a state is what its unseen successors keep of their probability after the shorter
    suffix; a context that is no state has a rest of one and no entries.
    """

    hashes: np.ndarray
    log_single: np.ndarray
    log_unknown: float
    pairs: np.ndarray = field(default_factory=_none)
    pair_log: np.ndarray = field(default_factory=_none)  # NaN: the first word is no state
    word_rest: np.ndarray = field(default_factory=_none)
    pair_rest: np.ndarray = field(default_factory=_none)
    triples: np.ndarray = field(default_factory=_none)
    triple_log: np.ndarray = field(default_factory=_none)

    def numbers(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, number of the pair with the token before or -1) of each token."""
        number = _find(self.hashes, tokens)
        before = _before(number, sizes)
        known = (number >= 0) & (before >= 0)
        pair = np.full(len(number), -1, dtype=np.int64)
        pair[known] = _find(self.pairs, (before[known] << ID_BITS) | number[known])
        return number, pair

    def scores(self, number: np.ndarray, pair: np.ndarray, sizes: np.ndarray):
        """(alone, in the longest state) of each token; rare tokens have zero alone."""
        if not len(self.hashes):
            zero = np.zeros(len(number))
            return zero, zero
        alone = np.where(number >= 0, self.log_single[number], 0.0)
        if not len(self.pairs):
            return alone, alone
        word, context = _before(number, sizes), _before(pair, sizes)
        one = self.after_word(word, pair, alone)
        return alone, self.after_pair(context, number, one)

    def after_word(self, word: np.ndarray, pair: np.ndarray, alone: np.ndarray) -> np.ndarray:
        seen = np.where(pair >= 0, self.pair_log[pair], np.nan)
        rest = np.where(word >= 0, self.word_rest[word], 0.0)
        return np.where(np.isnan(seen), rest + alone, seen)

    def after_pair(self, context: np.ndarray, number: np.ndarray, one: np.ndarray) -> np.ndarray:
        rest = np.where(context >= 0, self.pair_rest[context], 0.0)
        out = rest + one
        known = np.flatnonzero((context >= 0) & (number >= 0))
        at = _find(self.triples, (context[known] << ID_BITS) | number[known])
        out[known[at >= 0]] = self.triple_log[at[at >= 0]]
        return out


def _before(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The value one token earlier in the same document, else -1."""
    out = np.full(len(values), -1, dtype=np.int64)
    out[1:] = values[:-1]
    starts = np.cumsum(sizes) - sizes
    out[starts[starts < len(out)]] = -1
    return out


def _states(
    context: np.ndarray, counts: np.ndarray, totals: np.ndarray, shorter: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Test the contexts of entries given in their order.

    ``shorter`` are the entries' log10 probabilities after the shorter suffix. Gives the
    entries' own log10 probabilities, whether each belongs to a state, the contexts that are
    states, and their log10 rests.
    """
    own = (counts - DISCOUNT) / totals
    opens = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))

    def per_context(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, opens)

    rest = np.maximum(1 - per_context(own), 1e-12)
    shorter_rest = np.maximum(1 - per_context(np.power(10.0, shorter)), 1e-12)
    gain = per_context(counts * (np.log(own) - shorter * np.log(10.0)))
    unseen = np.maximum(totals[opens] - per_context(counts), 0)
    gain += unseen * (np.log(rest) - np.log(shorter_rest))
    chosen = gain >= MIN_DIVERGENCE
    sizes = np.diff(np.append(opens, len(context)))
    log_rest = np.log10(rest) - np.log10(shorter_rest)
    return np.log10(own), np.repeat(chosen, sizes), context[opens][chosen], log_rest[chosen]


def learn(texts: DataFrame) -> tuple[Tree, DataFrame, int, int]:
    """(tree, packed token counts, number of tokens, number of distinct tokens).

    The same model to a depth of two words on the driver, to look at and to compare
    ``score`` with; for small corpora only.
    """
    spark = texts.sparkSession
    python_tasks(spark)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0]
    ranges = share_of(size, RANGE_BYTES)
    counts = _count_over(texts, lambda tokens, _: tokens, ranges, "token-counts")
    total, distinct = _totals(counts)
    base = np.log10(total + distinct + 1)
    hashes, n = _frequent(counts, MIN_COUNT)
    if len(hashes) >= 1 << ID_BITS:
        raise ValueError("the corpus is too large to look at")
    tree = Tree(hashes.view(np.uint64), np.log10(n + 1.0) - base, float(-base))
    if not len(hashes):
        return tree, counts, total, distinct

    known = spark.sparkContext.broadcast(tree)

    def pair_codes(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        number, _ = known.value.numbers(tokens, sizes)
        before = _before(number, sizes)
        both = (number >= 0) & (before >= 0)
        return (before[both] << ID_BITS) | number[both]

    pairs, pair_n = _frequent(_count_over(texts, pair_codes, ranges, "pair-counts"), MIN_COUNT)
    if not len(pairs):
        return tree, counts, total, distinct
    word, following = pairs >> ID_BITS, pairs & ((1 << ID_BITS) - 1)
    own, kept, states, rest = _states(word, pair_n, n[word], tree.log_single[following])
    tree.pairs, tree.pair_log = pairs, np.where(kept, own, np.nan)
    tree.word_rest = np.zeros(len(hashes))
    tree.word_rest[states] = rest
    tree.pair_rest = np.zeros(len(pairs))

    paired = spark.sparkContext.broadcast(tree)

    def triple_codes(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A frequent triple has two frequent pairs."""
        number, pair = paired.value.numbers(tokens, sizes)
        before = _before(pair, sizes)
        both = (pair >= 0) & (before >= 0)
        return (before[both] << ID_BITS) | number[both]

    triples, triple_n = _frequent(
        _count_over(texts, triple_codes, ranges, "triple-counts"), MIN_COUNT
    )
    if len(triples):
        context, following = triples >> ID_BITS, triples & ((1 << ID_BITS) - 1)
        middle = pairs[context] & ((1 << ID_BITS) - 1)
        pair = _find(pairs, (middle << ID_BITS) | following)
        shorter = tree.after_word(middle, pair, tree.log_single[following])
        own, kept, states, rest = _states(context, triple_n, pair_n[context], shorter)
        tree.triples, tree.triple_log = triples[kept], own[kept]
        tree.pair_rest[states] = rest
    return tree, counts, total, distinct
