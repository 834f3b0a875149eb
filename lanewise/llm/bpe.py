"""BPE encoding and decoding with content-defined chunks.

A rolling hash over the bytes cuts a text where its value says so, so equal passages in
different texts are cut alike. A worker encodes a chunk once and reuses the result for
all documents it sees; white-space separated words inside new chunks are reused the same
way. Where the tokenizer takes ASCII letters in either case and parts them from the marks
after them, a word of letters and marks is put together from both, and letters in lower
case go to the tokenizer's model at once. A cut may fall into a word: the word across each join is put together again, and
the stretch from the last whole word before it to the first one after it is encoded by
the library itself. If that does not agree with the spliced ids, the stretch widens to
the whole text.

Both memories are bounded: when one is full its entries become the older generation,
and the generation before that goes. No shuffle is needed; chunks are shared by the
documents of one worker, not across the cluster, as sending every chunk to the task
that owns it would cost more than encoding it.

Cases: a NULL text is an empty one, with no ids and an empty decoded text; equal rows are
all returned; texts of any length are whole; no rows give no rows; nothing depends on the order
of rows, so there are no ties; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lanewise.llm.tables import Memory, per_worker, python_tasks

HASH_BYTES = 8
CHUNK_BITS = 10  # a chunk has 2 ** CHUNK_BITS bytes on average
WORDS_KEPT, CHUNKS_KEPT = 400_000, 10_000
OUTPUT_BYTES = 4_000_000

_MULTIPLIER, _MIXER = 0x01000193, 0x9E3779B1


def content_cuts(data: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Ends of the chunks: places where the hash of the last bytes has ``bits`` zeros."""
    n = len(data)
    if n <= HASH_BYTES:
        return [n]
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    rolling = raw[HASH_BYTES - 1 :].copy()
    factor = _MULTIPLIER
    for back in range(1, HASH_BYTES):
        rolling += raw[HASH_BYTES - 1 - back : n - back] * np.uint32(factor)
        factor = factor * _MULTIPLIER & 0xFFFFFFFF
    rolling *= np.uint32(_MIXER)
    ends = np.flatnonzero(rolling >> np.uint32(32 - bits) == 0) + HASH_BYTES
    cuts = ends.tolist()
    if not cuts or cuts[-1] != n:
        cuts.append(n)
    return cuts


_SPACED = re.compile(rb"[\x20\x09-\x0d]")
_MARKS = ".,;:!?"


class Coder:
    """Encodes texts through the two memories; results are (count, ids, tokens) with
    ids in decimal and tokens as text, joined by spaces."""

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_path)
        self.library.no_truncation()
        self.library.no_padding()
        if self.library.decoder is not None:
            raise ValueError("only tokenizers that decode by joining tokens are supported")
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.tokens = [(self.library.id_to_token(i) or "").encode() for i in range(size)]
        self.names = [b"%d" % i for i in range(size)]
        self.model = self.library.model
        self.letters_alone = self._takes_letters_alone()
        self.words = Memory(self._word, WORDS_KEPT)
        self.chunks = Memory(self._chunk, CHUNKS_KEPT)

    def _directly(self, data: bytes) -> tuple[int, bytes, bytes]:
        return self._named(self.library.encode(data.decode(), add_special_tokens=False).ids)

    def _named(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        names, tokens = self.names, self.tokens
        return len(ids), b" ".join([names[i] for i in ids]), b" ".join([tokens[i] for i in ids])

    def _takes_letters_alone(self) -> bool:
        """Whether the tokenizer lowers ASCII letters, hands a stretch of them to its model as
        it is, and parts it from marks behind it."""
        library, letters = self.library, string.ascii_lowercase
        if library.normalizer is None or library.pre_tokenizer is None:
            return False
        added = [token.content for token in library.get_added_tokens_decoder().values()]
        if any(not set(a) - set(string.ascii_letters + _MARKS) for a in added):
            return False
        normal, cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        if normal(string.ascii_letters + _MARKS) != letters * 2 + _MARKS:
            return False
        parts = [[part for part, _ in cut(letters + tail)] for tail in ("", *_MARKS, _MARKS)]
        return parts == [[letters], *[[letters, mark] for mark in _MARKS], [letters, _MARKS]]

    def _word(self, data: bytes) -> tuple[int, bytes, bytes]:
        letters = data.rstrip(_MARKS.encode())
        # The letters of bytes are those of ASCII.
        if not (self.letters_alone and letters.isalpha()):
            return self._directly(data)
        lowered = letters.lower()
        if lowered == data:
            return self._named([token.id for token in self.model.tokenize(data.decode())])
        if len(letters) == len(data):
            return self.words[lowered]
        return self._join([self.words[lowered], self.words[data[len(letters) :]]])

    @staticmethod
    def _join(parts: list[tuple]) -> tuple[int, bytes, bytes]:
        parts = [p for p in parts if p[0]]
        return (
            sum([p[0] for p in parts]),
            b" ".join([p[1] for p in parts]),
            b" ".join([p[2] for p in parts]),
        )

    def _chunk(self, chunk: bytes):
        """(head, whole words encoded, tail, end of the first and start of the last word).

        Head and tail are the words that the chunk's edges may have cut; None if the
        chunk has no white space.
        """
        found = _SPACED.search(chunk)
        if found is None:
            return None
        words = chunk.split()
        head = chunk[: found.start()]
        closed = _SPACED.match(chunk, len(chunk) - 1) is not None
        tail = b"" if closed else words[-1]
        body = words[bool(head) : len(words) - bool(tail)]
        first = last = None
        if body:
            first = chunk.index(body[0], len(head)) + len(body[0])
            last = chunk.rindex(body[-1], 0, len(chunk) - len(tail))
        return head, self._join(list(map(self.words.__getitem__, body))), tail, first, last

    def _agrees(self, data: bytes, start: int, end: int) -> bool:
        """Whether the words of a stretch, spliced, are what the library makes of it."""
        stretch = data[start:end]
        spliced = self._join(list(map(self.words.__getitem__, stretch.split())))
        return spliced == self._directly(stretch)

    def encode(self, text: str) -> tuple[int, bytes, bytes]:
        data = text.encode()
        parts, joins = [], []
        carried, begun, before, start = b"", 0, 0, 0
        for end in content_cuts(data):
            chunk = data[start:end]
            record = self.chunks[chunk]
            if record is None:
                carried += chunk
            else:
                head, body, tail, first_end, last_start = record
                word = carried + head
                if word:
                    parts.append(self.words[word])
                if start:
                    stop = first_end if first_end is not None else len(head)
                    joins.append((before, start + stop))
                parts.append(body)
                carried, begun = tail, end - len(tail)
                before = start + last_start if last_start is not None else begun
            start = end
        if carried:
            parts.append(self.words[carried])
            if begun:
                joins.append((before, len(data)))
        if all(self._agrees(data, *join) for join in joins):
            return self._join(parts)
        # Words depend on their neighbours here; only the whole text surely holds all.
        return self._directly(data)


@per_worker
def _coder(tokenizer_path: str) -> Coder:
    return Coder(tokenizer_path)


def encode_documents(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids in decimal joined by spaces, and the text
    that decoding them with special tokens gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer_path)
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        names = ["doc_id", "n_tokens", "ids", "decoded"]

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        rows, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                row = (doc_id, *coder.encode(text.as_py() or ""))
                rows.append(row)
                held += len(row[2]) + len(row[3])
                if held >= OUTPUT_BYTES:
                    yield flush(rows)
                    rows, held = [], 0
        yield flush(rows)

    python_tasks(documents.sparkSession)
    encoded = documents.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary"
    )
    return encoded.selectExpr(
        "doc_id", "n_tokens", "decode(ids, 'UTF-8') as ids", "decode(decoded, 'UTF-8') as decoded"
    )
