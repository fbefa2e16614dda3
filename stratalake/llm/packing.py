"""Token sequences of a fixed length with minimum bin slack.

Documents are turned into token ids, whole windows are cut off, and the remainders of a bounded block of
documents are packed. For each window a bitset over reachable lengths tells which multiset of all remaining lengths
comes closest to its capacity; the bits reached after each length are kept, so the counts are read off backwards.
What a window still lacks is cut from the largest remainder left. At the end of a task the last window is cut
into powers of two, which need no padding.

Blocks lie within one input partition: there is no shuffle, and a retried task packs the same block again.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from stratalake.llm.common import id_and_text

CAPACITY = 1024
BLOCK_DOCUMENTS = 2048
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def closest_multiset(lengths: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts per length whose sum comes closest to ``capacity`` from below, the larger lengths used first.

    Bit ``s`` of a bitset says that the sum ``s`` can be reached. A length with ``c`` copies is added in steps of
    1, 2, 4, ... copies, so any count up to ``c`` can be made. The walk ends as soon as the capacity is reached.
    """
    full = (1 << capacity + 1) - 1
    reached, steps = 1, []
    for length in sorted(lengths, reverse=True):
        left = min(lengths[length], capacity // length)
        part = 1
        while left > 0:
            part = min(part, left)
            after = (reached | reached << part * length) & full
            if after != reached:
                steps.append((reached, length, part))
                reached = after
            left -= part
            part *= 2
        if reached >> capacity & 1:
            break
    total, counts = reached.bit_length() - 1, defaultdict(int)
    for before, length, part in reversed(steps):
        if not before >> total & 1:
            total -= part * length
            counts[length] += part
    return dict(counts)


class Packer:
    """Places pieces ``(document number, start, length)`` of one task in sequences."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self.waiting: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.tokens = 0

    def add(self, document: int, n_ids: int) -> Iterator[tuple[int, int, int, int, int]]:
        """``document, start, length, sequence, offset`` of the whole windows; the remainder waits."""
        whole = n_ids // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            yield document, start, self.capacity, self._next(), 0
        if n_ids > whole:
            self._wait(document, whole, n_ids - whole)

    def _next(self) -> int:
        self.sequences += 1
        return self.sequences - 1

    def _wait(self, document: int, start: int, length: int) -> None:
        self.waiting[length].append((document, start))
        self.tokens += length

    def _take(self, length: int) -> tuple[int, int]:
        place = self.waiting[length].pop()
        if not self.waiting[length]:
            del self.waiting[length]
        self.tokens -= length
        return place

    def windows(self) -> Iterator[tuple[int, int, int, int, int]]:
        """Full windows as long as what waits fills one."""
        while self.tokens >= self.capacity:
            counts = closest_multiset({n: len(places) for n, places in self.waiting.items()}, self.capacity)
            sequence, offset = self._next(), 0
            for length in sorted(counts, reverse=True):
                for _ in range(counts[length]):
                    yield *self._take(length), length, sequence, offset
                    offset += length
            while offset < self.capacity:
                largest = max(self.waiting)
                cut = min(largest, self.capacity - offset)
                document, start = self._take(largest)
                yield document, start, cut, sequence, offset
                offset += cut
                if cut < largest:
                    self._wait(document, start + cut, largest - cut)

    def rest(self) -> Iterator[tuple[int, int, int, int, int]]:
        """What is left, less than a window, in sequences of powers of two."""
        while self.tokens:
            size = 1 << self.tokens.bit_length() - 1
            sequence, offset = self._next(), 0
            while offset < size:
                largest = max(self.waiting)
                cut = min(largest, size - offset)
                document, start = self._take(largest)
                yield document, start, cut, sequence, offset
                offset += cut
                if cut < largest:
                    self._wait(document, start + cut, largest - cut)


class Encoder:
    """Ids of texts by a byte-level BPE file of ``tokenizers``, with a bounded memory of parts seen before.

    A blank after a visible character always begins a new piece of the tokenizer, so a text is cut there and each
    part is encoded once. New parts of a batch are encoded together, by the same vocabulary as ranks where it
    is given and the text is of plain European letters; any other text goes to the file itself.
    """

    REMEMBERED = 400_000
    PLAIN_UNTIL = "\u024f"
    #: White space among the plain letters; before a blank it joins the blank's piece.
    SPACES = tuple(chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160))

    def __init__(self, path: str, ranks_path: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.file = Tokenizer.from_file(path)
        self.special = [t.content for t in self.file.get_added_tokens_decoder().values()]
        self.ranks = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
            self.bytes_of[list(ranks.values())] = [len(b) for b in ranks]
        self._forget()

    def _forget(self) -> None:
        """``rows`` numbers the parts; the ids of part ``n`` are ``flat[ends[n]:ends[n + 1]]``."""
        self.rows: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, new: list[str]) -> None:
        """Encode parts at once, each behind a blank; where one ends is known from the bytes of the ids."""
        ids = np.array(self.ranks.encode_ordinary(" " + " ".join(new)), np.uint32)
        bytes_to = np.cumsum([1 + (len(p) if p.isascii() else len(p.encode())) for p in new])
        ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), bytes_to) + 1
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        self.ends = np.concatenate([self.ends, ends + len(self.flat)])
        self.flat = np.concatenate([self.flat, ids])

    def _plain(self, text: str) -> bool:
        """Every blank stands between visible characters, and the ranks give the file's ids."""
        if self.ranks is None or not text or text[0] in self.SPACES or text[-1] in self.SPACES:
            return False
        if any(s + " " in text for s in self.SPACES) or any(s in text for s in self.special):
            return False
        return text.isascii() or max(text) <= self.PLAIN_UNTIL

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        plain = [n for n, t in enumerate(texts) if self._plain(t)]
        cut = [texts[n].split(" ") for n in plain]
        firsts = [np.array(self.ranks.encode_ordinary(parts.pop(0)), np.uint32) for parts in cut]
        every = set().union(*cut)
        new = [p for p in every if p not in self.rows]
        if len(self.rows) + len(new) > self.REMEMBERED:
            self._forget()
            new = list(every)
        if new:
            self._learn(new)
        find = self.rows.__getitem__
        for n, first, parts in zip(plain, firsts, cut):
            at = np.fromiter(map(find, parts), np.int64, len(parts))
            begin, size = self.ends[at], self.ends[at + 1] - self.ends[at]
            stop = np.cumsum(size)
            places = np.arange(stop[-1] if len(stop) else 0) + np.repeat(begin - stop + size, size)
            out[n] = np.concatenate([first, self.flat[places]])
        for n, ids in enumerate(out):
            if ids is None:
                out[n] = np.array(self.file.encode(texts[n], add_special_tokens=False).ids, np.uint32)
        return out


_at_hand: dict[tuple[str, str | None], Encoder] = {}


def _encoder(path: str, ranks: str | None) -> Encoder:
    """The encoder of the worker process, which meets the same parts in its next task."""
    if (path, ranks) not in _at_hand:
        _at_hand[path, ranks] = Encoder(path, ranks)
    return _at_hand[path, ranks]


def pack(
    df: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    block_documents: int = BLOCK_DOCUMENTS,
) -> DataFrame:
    """One row per piece: :data:`PIECE`.

    ``tokenizer`` is the path of a ``tokenizers`` file on every executor, ``ranks`` that of the same vocabulary as
    ranks. A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Every id lies in one
    piece, the pieces of a sequence follow each other from offset 0, every sequence is full or a power of two
    long. Rows that repeat an id or text are documents of their own; a null id stays null. ``block_documents``
    bounds the documents held at once, not the rows packed: what a block leaves goes on into the next.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = _encoder(tokenizer, ranks), Packer(capacity)
        first = TaskContext.get().partitionId() << 40
        held: dict[int, list] = {}  # document number: id, ids from a start on, that start, tokens

        def rows(placed: Iterator[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
            out = [[] for _ in schema]
            for document, start, length, sequence, offset in placed:
                doc_id, ids, before, size = held[document]
                crc = zlib.crc32(ids[start - before : start - before + length])
                for column, value in zip(out, (doc_id, start, length, crc, size, first + sequence, offset)):
                    column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

        number = 0
        for b in batches:
            ids_of, texts = b.column(0), b.column(1)
            for at in range(0, b.num_rows, 512):
                part = texts.slice(at, 512).to_pylist()
                placed = []
                for doc_id, ids in zip(ids_of.slice(at, 512).to_pylist(), encoder.encode(part)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    held[number] = [doc_id, ids, 0, len(ids)]
                    placed.extend(packer.add(number, len(ids)))
                    number += 1
                if placed:
                    yield rows(iter(placed))
                for held_now in held.values():  # whole windows are out: only remainders are kept
                    whole = held_now[3] // capacity * capacity
                    if held_now[2] < whole:
                        held_now[1], held_now[2] = held_now[1][whole - held_now[2] :].copy(), whole
                if len(held) >= block_documents:
                    yield rows(packer.windows())
                    waiting = {d for places in packer.waiting.values() for d, _ in places}
                    held = {d: h for d, h in held.items() if d in waiting}
        yield rows(packer.windows())
        yield rows(packer.rest())

    return id_and_text(df, id_col, text_col).mapInArrow(run, PIECE)
