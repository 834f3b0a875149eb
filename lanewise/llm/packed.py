"""Rows that carry many values each, packed into one compressed value.

Operators that look at every word of a corpus would shuffle billions of small rows. A row
here holds what one task has for one key, as arrays, and costs a few bits a value where
values run on.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pyarrow as pa

ROW = "key bigint, kind int, payload binary"
ROW_ARROW = [("key", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, the numbers' bytes of one rank side by side."""
    import zstandard

    planes = [
        (a.dtype.str, a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) for a in arrays
    ]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(planes, protocol=5))


def unpack(payload: bytes) -> list[np.ndarray]:
    import zstandard

    plain = zstandard.ZstdDecompressor().decompress(payload)
    out = []
    for kind, data in pickle.loads(plain):
        dtype = np.dtype(kind)
        planes = np.frombuffer(data, np.uint8).reshape(dtype.itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(dtype).ravel())
    return out


def steps(values: np.ndarray) -> np.ndarray:
    """First value and differences; small numbers where values run on."""
    return np.diff(values, prepend=np.zeros(1, values.dtype))


def batch_of(rows: list[tuple], schema: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in schema])


# Tells apart texts of one doc_id, so 40 bits are plenty.
KEY_MASK = (1 << 40) - 1


def text_key(data: bytes) -> int:
    """``F.xxhash64(text).bitwiseAND(KEY_MASK)``."""
    import xxhash

    return xxhash.xxh64_intdigest(data, 42) & KEY_MASK


# Hashing the words of many texts at once, without making them one by one.
SEGMENT_BYTES = 1 << 20
_PLACES = 4096
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SAME = np.arange(1, 257, dtype=np.uint64)
_LOWER = _SAME.copy()
_LOWER[65:91] = _SAME[97:123]


def _mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_WEIGHTS = _mix(np.arange(1, _PLACES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_WEIGHTS |= np.uint64(1)


def _hash_segment(data: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word: the sum of its bytes, each times its place's weight."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.flatnonzero(~_IS_SPACE[raw])
    if not len(inside):
        return np.zeros(0, dtype=np.uint64), inside
    first = np.flatnonzero(np.diff(inside, prepend=-2) != 1)
    sizes = np.diff(np.append(first, len(inside)))
    place = np.arange(len(inside)) - np.repeat(first, sizes)
    long = np.flatnonzero(sizes > _PLACES)
    if len(long):
        import xxhash

        place %= _PLACES
    values = (_LOWER if lower else _SAME)[raw[inside]]
    sums = _mix(np.add.reduceat(_WEIGHTS[place] * values, first))
    starts = inside[first]
    for at in long.tolist():
        word = data[starts[at] : starts[at] + sizes[at]]
        sums[at] = xxhash.xxh64_intdigest(word.lower() if lower else word)
    return sums, starts


def hash_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words of each text.

    A hash depends on the word alone. ``lower`` takes A-Z as a-z.
    """
    hashes, counts = [], np.zeros(len(texts), dtype=np.int64)
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= SEGMENT_BYTES):
            size += len(texts[to]) + 1
            to += 1
        if to - at > 1:
            found, starts = _hash_segment(b" ".join(texts[at:to]), lower)
            ends = np.cumsum([len(t) + 1 for t in texts[at:to]])
            owners = np.searchsorted(ends, starts, side="right")
            counts[at:to] = np.bincount(owners, minlength=to - at)
            hashes.append(found)
        else:
            begin, text = 0, texts[at]
            while begin < len(text):
                space = _SPACE.search(text, begin + SEGMENT_BYTES)
                end = space.start() if space else len(text)
                found, _ = _hash_segment(text[begin:end], lower)
                hashes.append(found)
                counts[at] += len(found)
                begin = end
        at = to
    return np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64), counts
