"""Best-fit packing of tokenized documents with a swap-based local search.

Documents are tokenized and cut in parallel. Only the lengths of their pieces travel
on: full pieces are sequences by themselves, all others are dealt at random into groups
of about ``GROUP_PIECES`` and packed there, best fit first, then by local search. A
group wastes less than one sequence against a packing of all groups together, whatever
the size of the input.

Local search: a document of a bin, the emptiest first, moves to another underfull bin, or
one or two of its documents change places with a shorter one there. A step must leave the
other bin fuller than this one was, so the sum of squared fills grows and bins run empty.
Passes over the bins end when none has a step left or no smaller number of bins is possible.

Cases: a NULL text is an empty one and still has its end token; a NULL doc_id stays
NULL; repeated rows are packed each; no rows give no sequences; other columns are
ignored; texts of any length are cut into as many pieces as they need.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.tables import python_tasks, per_worker, share_of
from lanewise.session import materialize

SEQUENCE_TOKENS = 1024
END_ID = 2
GROUP_PIECES = 50_000
# Longer texts go to the slower of two encoders with equal results; the faster one's
# pattern search has a limit on long runs of white space.
LONG_TEXT = 200_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = f"{PIECES}, sequence_id bigint, offset bigint"


@per_worker
def _encoder(tokenizer_path: str, ranks_path: str | None):
    """text -> ids as the tokenizers library gives them.

    With ``ranks_path``, the same vocabulary as ranks, a faster library does the work;
    special tokens found in a text are taken as such by both.
    """
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer_path)
    slow.no_truncation()
    slow.no_padding()

    def encode_slow(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

    if ranks_path is None:
        return encode_slow
    import public_tokenizers

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    added = {t.content: i for i, t in slow.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding(
        "ranks",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={text: i for text, i in added.items() if text.encode() not in ranks},
    )

    def encode(text: str) -> np.ndarray:
        if len(text) > LONG_TEXT:
            return encode_slow(text)
        return np.array(fast.encode(text, allowed_special="all"), dtype="<u4")

    return encode


def cut(length: int, most: int = SEQUENCE_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than ``most``."""
    first = length % most or most
    return [(0, first)] + [(at, most) for at in range(first, length, most)]


def token_pieces(
    documents: DataFrame, tokenizer_path: str, ranks_path: str | None = None
) -> DataFrame:
    """One row per piece of every document, its ids as a checksum."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path, ranks_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                ids = np.append(encode(text.as_py() or ""), np.array([END_ID], "<u4"))
                rows.extend(
                    (doc_id, n, start, size, zlib.crc32(ids[start : start + size].tobytes()))
                    for n, (start, size) in enumerate(cut(len(ids)))
                )
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    python_tasks(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(pieces, PIECES)


class Bins:
    """Bins of one group and the indexes over their underfull ones.

    ``free`` and ``slots`` hold, by room, what a document of some length can go to: a
    bin with so much space, or a shorter document that would leave so much behind. The
    bits of ``free_rooms`` and ``slot_rooms`` tell which rooms exist.
    """

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.members: list[set[int]] = []
        self.fill: list[int] = []
        self.free: dict[int, set[int]] = {}
        self.slots: dict[int, dict[int, set[tuple[int, int]]]] = {}
        self.free_rooms = self.slot_rooms = 0
        self.indexed: set[int] = set()

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that takes it."""
        for item in sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i]):
            size = self.lengths[item]
            fitting = self.free_rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                at = self.free[room].pop()
                if not self.free[room]:
                    self.free_rooms &= ~(1 << room)
                self.members[at].add(item)
                self.fill[at] += size
            else:
                at = len(self.members)
                self.members.append({item})
                self.fill.append(size)
            left = self.capacity - self.fill[at]
            if left:
                self.free.setdefault(left, set()).add(at)
                self.free_rooms |= 1 << left

    def index(self, at: int) -> None:
        room = self.capacity - self.fill[at]
        if not room or not self.members[at]:
            return
        self.indexed.add(at)
        self.free.setdefault(room, set()).add(at)
        self.free_rooms |= 1 << room
        for item in self.members[at]:
            size = self.lengths[item]
            slot = self.slots.setdefault(room + size, {})
            slot.setdefault(size, set()).add((at, item))
            self.slot_rooms |= 1 << (room + size)

    def drop(self, at: int) -> None:
        if at not in self.indexed:
            return
        self.indexed.discard(at)
        room = self.capacity - self.fill[at]
        self.free[room].discard(at)
        if not self.free[room]:
            self.free_rooms &= ~(1 << room)
        for item in self.members[at]:
            size = self.lengths[item]
            slot = self.slots[room + size]
            slot[size].discard((at, item))
            if not slot[size]:
                del slot[size]
                if not slot:
                    self.slot_rooms &= ~(1 << (room + size))

    def exchange(self, source: int, given: list[int], target: int, taken: int | None) -> None:
        self.drop(target)
        for item in given:
            self.members[source].discard(item)
            self.members[target].add(item)
        gain = sum(self.lengths[i] for i in given)
        if taken is not None:
            self.members[target].discard(taken)
            self.members[source].add(taken)
            gain -= self.lengths[taken]
        self.fill[source] -= gain
        self.fill[target] += gain
        self.index(target)

    def _swap_for(self, size: int, fill: int) -> tuple[int, int] | None:
        """A shorter document elsewhere whose place takes ``size``, filling best, and more
        than ``fill``."""
        rooms = self.slot_rooms >> size
        room = size
        while rooms:
            skip = (rooms & -rooms).bit_length() - 1
            room, rooms = room + skip, rooms >> skip
            if self.capacity - room + size <= fill:
                return None
            shortest = min(self.slots[room])
            if shortest < size:
                return next(iter(self.slots[room][shortest]))
            room, rooms = room + 1, rooms >> 1
        return None

    def improve(self, source: int) -> bool:
        """One step that takes length from ``source``; it must not be indexed."""
        fill = self.fill[source]
        of_size: dict[int, list[int]] = {}
        for item in self.members[source]:
            of_size.setdefault(self.lengths[item], []).append(item)
        sizes = sorted(of_size, reverse=True)
        for size in sizes:
            fitting = self.free_rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                if self.capacity - room + size > fill:
                    self.exchange(source, of_size[size][:1], next(iter(self.free[room])), None)
                    return True
        for size in sizes:
            if found := self._swap_for(size, fill):
                self.exchange(source, of_size[size][:1], *found)
                return True
        tried = set()
        for n, a in enumerate(sizes):
            for b in sizes[n:]:
                if a + b in tried or (a == b and len(of_size[a]) < 2):
                    continue
                tried.add(a + b)
                if found := self._swap_for(a + b, fill):
                    pair = of_size[a][:2] if a == b else [of_size[a][0], of_size[b][0]]
                    self.exchange(source, pair, *found)
                    return True
        return False

    def search(self) -> None:
        """Take steps while there are any and fewer bins are possible."""
        least = -(-sum(self.lengths) // self.capacity)
        used = len(self.members)
        if used <= least:
            return
        self.free, self.free_rooms = {}, 0
        for at in range(len(self.members)):
            self.index(at)
        stepped = True
        while stepped:
            stepped = False
            for at in sorted(self.indexed, key=lambda at: (self.fill[at], at)):
                if used <= least:
                    return
                self.drop(at)
                while self.members[at] and self.improve(at):
                    stepped = True
                used -= not self.members[at]
                self.index(at)


def pack_lengths(lengths: list[int], capacity: int = SEQUENCE_TOKENS) -> list[list[int]]:
    """Bins as lists of positions in ``lengths``."""
    bins = Bins(lengths, capacity)
    bins.best_fit()
    bins.search()
    return [sorted(members) for members in bins.members if members]


def pack_pieces(pieces: DataFrame, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds (sequence_id, offset) to a written table of pieces."""
    numbered = pieces.withColumn("row", F.monotonically_increasing_id())
    whole = F.col("length") == SEQUENCE_TOKENS
    groups = share_of(pieces.filter(~whole).count(), group_pieces)

    def pack(group: pa.Table) -> pa.Table:
        order = np.argsort(group["row"].to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        lengths = group["length"].to_pylist()
        sequence = np.zeros(len(lengths), dtype=np.int64)
        offset = np.zeros(len(lengths), dtype=np.int64)
        first = group["group_id"][0].as_py() << 32
        for n, members in enumerate(pack_lengths(lengths)):
            at = 0
            for item in members:
                sequence[item], offset[item] = first + n, at
                at += lengths[item]
        return group.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column(
            "sequence_id", pa.array(sequence)
        ).append_column("offset", pa.array(offset))

    alone = numbered.filter(whole).select(
        *pieces.columns,
        (-F.col("row") - 1).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    short = numbered.filter(~whole).withColumn(
        "group_id", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("bigint")
    )
    return alone.unionByName(short.groupBy("group_id").applyInArrow(pack, PACKED))


def pack_documents(
    documents: DataFrame, tokenizer_path: str, ranks_path: str | None = None
) -> DataFrame:
    """Tokenize, cut and pack; see ``PACKED`` for the columns."""
    pieces = materialize(token_pieces(documents, tokenizer_path, ranks_path), "token-pieces")
    return pack_pieces(pieces)
