"""Spelling variants: words within one edit of each other, by a trie of letter counts.

Two words are near if they differ by one inserted, deleted or replaced code point. A word's form
is its near word of largest count if that is ``RATIO`` times its own; its root is where forms
lead.

The letters are cut into ``GROUPS``; a word's path in the trie is the number of its letters in
each group, group after group, in four bits each (15 stands for more). One edit adds at most one
to one count and takes at most one from one count. So a search goes down the trie with a
budget of one surplus and one deficit, and only the words at the leaves it reaches are compared.
Of two near words with different paths the one that comes first searches for the other, so a
surplus is spent before a deficit.

The trie is never in one place. Its upper part is a table of nodes: two levels at a time,
nodes with more than ``NODE_WORDS`` words are opened, and the searches go down by joins, to
nodes that exist. Words of closed nodes and the searches that reached them are dealt to
shards, which go down the rest of the trie depth first, in blocks. A node that is still large at
the last level (words with the same counts throughout) is dealt out by word, and its
searches to each of the parts.

Cases: a NULL text has no words; words of any length and alphabet are taken; equal rows count
each; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.llm.tables import python_tasks, share_of
from lanewise.session import materialize

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2

# Letters that are counted together, in the order of the levels; any other letter counts in
# the group that its code point leaves divided by their number.
GROUPS = "e a i n r t s o l uq dk hz mx cj pvw gbfy".split()
DEPTH = len(GROUPS)
NODE_WORDS = 20_000
SHARD_WORDS = 20_000
COUNTED_WORDS = 400_000  # distinct words that a task adds up before it sends them
BLOCK = 1 << 20  # searches that go down together
WIDTH = 48  # code points of a word that are compared as arrays

_GROUP_OF = {letter: n for n, letters in enumerate(GROUPS) for letter in letters}


def word_counts(
    documents: DataFrame, alter: Callable[[int, str], str] | None = None, least: int = MIN_LETTERS
) -> DataFrame:
    """(word, n) of the runs of letters, A-Z in lower case, of at least ``least`` code points.

    ``alter(doc_id, word)`` may replace a word; it is asked once per document and word,
    for rows with a doc_id. Words are added up in each task before they are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(total: Counter) -> Iterator[pa.RecordBatch]:
            words, n = list(total), list(total.values())
            for at in range(0, len(words), 50_000):
                part = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[part], pa.string()), pa.array(n[part], pa.int64())], names=["word", "n"]
                )

        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                lowered = (text.as_py() or "").encode().lower().decode()
                found = Counter(LETTERS.findall(lowered))
                if alter is None or doc_id is None:
                    changed = found.items()
                else:
                    changed = ((alter(doc_id, w), n) for w, n in found.items())
                for word, n in changed:
                    if len(word) >= least:
                        total[word] += n
                if len(total) >= COUNTED_WORDS:
                    yield from rows(total)
                    total = Counter()
        yield from rows(total)

    python_tasks(documents.sparkSession)
    slim = documents.select(F.col("doc_id").cast("bigint"), "text")
    counted = slim.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def path_of(word: str) -> int:
    """Counts of the letter groups, four bits each, as an unsigned number."""
    counts = [0] * DEPTH
    for letter in word:
        counts[_GROUP_OF.get(letter, ord(letter) % DEPTH)] += 1
    path = 0
    for n in counts:
        path = path << 4 | min(n, 15)
    return path


def with_paths(words: DataFrame) -> DataFrame:
    """(word, n, path) with the path's bits in a bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = np.array([path_of(w) for w in batch[0].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch[0], batch[1], pa.array(paths.view(np.int64))], names=["word", "n", "path"]
            )

    python_tasks(words.sparkSession)
    return words.select("word", "n").mapInArrow(run, "word string, n bigint, path bigint")


def go_down(nodes, paths, surplus, deficit, level, exists=None):
    """One level down from ``nodes``, for searches with the counts of ``paths``.

    Returns (which search, child node, surplus, deficit spent so far). ``exists`` tells
    which of the children there are.
    """
    count = (paths >> np.uint64(4 * (DEPTH - 1 - level))) & np.uint64(15)
    count = count.astype(np.int64)
    parts = []
    for change in (0, 1, -1):
        if change == 0:
            able = np.ones(len(nodes), dtype=bool)
        elif change == 1:
            # At 15 the count stands for more, and the word itself may have more.
            able = ~surplus & (count < 15)
        else:
            able = ~deficit & surplus & (count > 0)
        which = np.flatnonzero(able)
        child = nodes[which] << np.uint64(4) | (count[which] + change).astype(np.uint64)
        if exists is not None:
            there = exists(child)
            which, child = which[there], child[there]
        parts.append((which, child, surplus[which] | (change == 1), deficit[which] | (change == -1)))
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


_SEARCH = "word string, n bigint, path bigint, node bigint, surplus boolean, deficit boolean"


def _searches_down(searches: DataFrame, level: int, levels: int) -> DataFrame:
    """Every search at every node that it may reach ``levels`` levels further down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, node = (batch[c].to_numpy().view(np.uint64) for c in (2, 3))
            surplus, deficit = (batch[c].to_numpy(zero_copy_only=False).astype(bool) for c in (4, 5))
            which = np.arange(len(path))
            for at in range(level, level + levels):
                chosen, node, surplus, deficit = go_down(node, path[which], surplus, deficit, at)
                which = which[chosen]
            place = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c].take(place) for c in range(3)],
                    pa.array(node.view(np.int64)), pa.array(surplus), pa.array(deficit),
                ],
                names=["word", "n", "path", "node", "surplus", "deficit"],
            )

    return searches.mapInArrow(run, _SEARCH)


def _dealt(words: DataFrame, node_words: int) -> DataFrame:
    """Members of closed nodes and the searches that reached them, with the depth of the
    node and the part of it that they belong to."""
    node_of = {0: F.lit(0).cast("bigint")}
    blank = [F.lit(False).alias("surplus"), F.lit(False).alias("deficit")]
    members = words
    searches = words.select("*", node_of[0].alias("node"), *blank)
    done, depth = [], 0
    while True:
        depth += 2
        last = depth == DEPTH
        at = F.shiftrightunsigned("path", 4 * (DEPTH - depth)).alias("node")
        sizes = materialize(
            members.groupBy(at).agg(F.count("*").alias("words")), "trie-nodes"
        )
        parts = F.ceil(F.col("words") / node_words).cast("bigint")
        parts = parts if last else F.lit(1).cast("bigint")
        closed = F.lit(last) | (F.col("words") <= node_words)
        nodes = sizes.select("node", closed.alias("closed"), parts.alias("parts"))
        placed = members.withColumn("node", at).join(nodes, "node")
        searches = materialize(
            _searches_down(searches.select("word", "n", "path", "node", "surplus", "deficit"), depth - 2, 2)
            .join(nodes, "node"),
            "trie-searches",
        )
        part = F.pmod(F.xxhash64("word"), "parts")
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
        for rows, chosen, searching in ((placed, part, False), (searches, every, True)):
            done.append(
                rows.filter("closed").select(
                    "word", "n", "path", "node",
                    F.col("surplus") if searching else blank[0],
                    F.col("deficit") if searching else blank[1],
                    F.lit(searching).alias("searching"), F.lit(depth).alias("depth"),
                    chosen.alias("part"),
                )
            )
        if last or sizes.filter(F.col("words") > node_words).isEmpty():
            break
        members = materialize(
            placed.filter("not closed").select("word", "n", "path"), "trie-members"
        )
        searches = searches.filter("not closed")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


class _Words:
    """Words as rows of code points, cut at ``WIDTH``, and as themselves."""

    def __init__(self, words: pa.ChunkedArray):
        self.words = words
        listed = words.to_pylist()
        self.sizes = np.array([len(w) for w in listed], dtype=np.int64)
        width = max(1, min(int(self.sizes.max(initial=1)), WIDTH))
        cut = np.array([w[:width] for w in listed] or [""], dtype=f"U{width}")
        self.codes = cut.view(np.uint32).reshape(-1, width)[: len(listed)]

    def compared(self, rows: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((len(rows), width), dtype=np.uint32)
        out[:, : self.codes.shape[1]] = self.codes[rows]
        return out


def one_edit(short: str, long: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(short) > len(long):
        short, long = long, short
    if len(long) - len(short) > 1 or short == long:
        return False
    at = 0
    while at < len(short) and short[at] == long[at]:
        at += 1
    return short[at + (len(short) == len(long)) :] == long[at + 1 :]


def _near(a: _Words, i: np.ndarray, b: _Words, j: np.ndarray) -> np.ndarray:
    """Which pairs of words are one edit apart."""
    sizes_a, sizes_b = a.sizes[i], b.sizes[j]
    near = np.abs(sizes_a - sizes_b) <= 1
    long = near & (np.maximum(sizes_a, sizes_b) > WIDTH)
    for at in np.flatnonzero(long).tolist():
        near[at] = one_edit(a.words[i[at]].as_py(), b.words[j[at]].as_py())
    some = np.flatnonzero(near & ~long)
    width = max(a.codes.shape[1], b.codes.shape[1]) + 1
    place = np.arange(width)
    for at in range(0, len(some), 100_000):
        part = some[at : at + 100_000]
        first, second = a.compared(i[part], width), b.compared(j[part], width)
        swap = sizes_a[part] > sizes_b[part]
        short = np.where(swap[:, None], second, first)
        long_ = np.where(swap[:, None], first, second)
        differs = short != long_
        same_size = sizes_a[part] == sizes_b[part]
        prefix = np.argmax(differs, axis=1)
        shifted = short[:, :-1] == long_[:, 1:]
        rest = (shifted | (place[:-1] < prefix[:, None])).all(axis=1)
        near[part] = np.where(same_size, differs.sum(axis=1) == 1, rest)
    return near


def _search(group: pa.Table, depth: int) -> Iterator[tuple[pa.Table, pa.Table]]:
    """Searches and the members that they are near to, row by row, for the nodes of one depth
    in a shard."""
    searching = group["searching"].to_numpy().astype(bool)
    members, searches = group.filter(pa.array(~searching)), group.filter(pa.array(searching))
    if not len(members) or not len(searches):
        return
    path = members["path"].to_numpy().view(np.uint64)
    # Nodes of one depth differ in their paths and share a trie; parts of a node do not.
    order = np.lexsort((path, members["part"].to_numpy()))
    members, path = members.take(pa.array(order)), path[order]
    own_part = members["part"].to_numpy()
    from_part = searches["part"].to_numpy()
    a, b = _Words(searches["word"]), _Words(members["word"])
    from_path = searches["path"].to_numpy().view(np.uint64)
    for part in np.unique(own_part).tolist():
        low, high = np.searchsorted(own_part, [part, part + 1])
        trie = path[low:high]
        nodes = [np.unique(trie >> np.uint64(4 * (DEPTH - 1 - at))) for at in range(DEPTH)]

        def there(level: int):
            known = nodes[level]

            def exists(child: np.ndarray) -> np.ndarray:
                return known[np.minimum(np.searchsorted(known, child), len(known) - 1)] == child

            return exists

        chosen = np.flatnonzero(from_part == part)
        stack = [
            (depth, chosen, searches["node"].to_numpy().view(np.uint64)[chosen],
             searches["surplus"].to_numpy().astype(bool)[chosen],
             searches["deficit"].to_numpy().astype(bool)[chosen])
        ]
        while stack:
            level, which, node, surplus, deficit = stack.pop()
            if len(which) > BLOCK:
                for at in range(0, len(which), BLOCK):
                    cut = slice(at, at + BLOCK)
                    stack.append((level, which[cut], node[cut], surplus[cut], deficit[cut]))
                continue
            if level < DEPTH:
                moved, node, surplus, deficit = go_down(
                    node, from_path[which], surplus, deficit, level, there(level)
                )
                if len(moved):
                    stack.append((level + 1, which[moved], node, surplus, deficit))
                continue
            first = np.searchsorted(trie, node, side="left")
            sizes = np.searchsorted(trie, node, side="right") - first
            # A leaf's words meet a search a block at a time.
            ends = np.cumsum(sizes)
            for begin, end in _blocks(ends, BLOCK):
                n = sizes[begin:end]
                i = np.repeat(which[begin:end], n)
                j = low + np.repeat(first[begin:end] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                near = _near(a, i, b, j)
                yield searches.take(pa.array(i[near])), members.take(pa.array(j[near]))


def _blocks(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Cut a list with running totals into stretches of about ``size``."""
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield begin, end
        begin = end


_PAIR = "word string, near string, near_n bigint"


def near_words(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """(word, near, near_n) for every ordered pair of near words of ``words`` (word, n)."""

    def meet(group: pa.Table) -> pa.Table:
        empty = pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.string()),
                          "near_n": pa.array([], pa.int64())})
        out = [empty]
        depths = group["depth"].to_numpy()
        for depth in np.unique(depths).tolist():
            part = group.filter(pa.array(depths == depth)).combine_chunks()
            for found, met in _search(part, depth):
                out.append(pa.table({"word": found["word"], "near": met["word"], "near_n": met["n"]}))
                # Words with one path search for each other, others in one direction.
                once = pa.array(found["path"].to_numpy() != met["path"].to_numpy())
                found, met = found.filter(once), met.filter(once)
                out.append(pa.table({"word": met["word"], "near": found["word"], "near_n": found["n"]}))
        return pa.concat_tables(out)

    words = materialize(with_paths(words), "word-paths")
    shards = share_of(words.count(), SHARD_WORDS)
    dealt = _dealt(words, node_words).withColumn(
        "shard", F.pmod(F.xxhash64("node", "depth", "part"), F.lit(shards).cast("bigint"))
    )
    return dealt.groupBy("shard").applyInArrow(meet, _PAIR)


def _better(n: Column, word: Column) -> Column:
    """Orders near words by count, then by code points."""
    return F.struct((-n).alias("minus"), word.alias("word"))


def variants(words: DataFrame, ratio: int = RATIO, node_words: int = NODE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n), whose
    words are distinct."""
    words = materialize(words.select("word", "n"), "distinct-words")
    found = (
        near_words(words, node_words)
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(_better(F.col("near_n"), F.col("near"))).alias("best"))
    )
    enough = -F.col("best.minus") >= ratio * F.col("n")
    formed = materialize(
        words.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("best.word")).alias("form"),
            F.when(enough, -F.col("best.minus")).alias("form_n"),
        ),
        "word-forms",
    )
    # Counts at least double along forms; each round doubles the steps taken.
    steps = formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    steps = materialize(steps, "form-steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = steps.join(further, "root", "left")
        after = materialize(
            joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "form-steps",
        )
        steps = after.select("word", "root")
        if after.filter("moved").isEmpty():
            break
    return formed.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
