"""Alignment of two tokenizers on the same bytes, by divide and conquer at shared cuts.

Both tokenizers see a blank and the text. Byte offsets where a token of each ends are shared cuts. An interval of tokens
is divided at the shared end nearest to its middle, which a bisection in the other tokenizer's ends tells, and both
halves are treated alike; an interval without a shared end inside is a leaf group. The intervals of all texts of
a batch are divided together, level by level.

What ends together is linked. Of two tokens that end at one byte, the shorter is a suffix of the longer, so the number of
different linked ids is bounded by the bytes of both vocabularies (:func:`pair_bound`), whatever the corpus: the
corpus-wide counts of the pairs are small enough for every task.

Defined results: a null or empty text has no tokens, nor has one whose tokens do not give back its bytes; strings of
special tokens are plain text; repeated rows count each; a null id stays null; an empty table gives no rows. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import id_and_text

#: Texts that are encoded and aligned at once.
TEXTS = 256
#: Ends beside the middle that are looked up one by one before an interval's other ends are searched at once.
NEAR = 8
#: Pairs that a task counts at once.
PAIRS = 1 << 22
#: Ids and group sizes as little-endian bytes, which Spark hands on without looking at each; for the sides a and b.
IDS, SIZES = np.dtype("<u2"), np.dtype("<u4")
SIDES = (("a_ids", IDS), ("b_ids", IDS), ("a_sizes", SIZES), ("b_sizes", SIZES))
PACKED = "doc_id long, a_ids binary, b_ids binary, a_sizes binary, b_sizes binary"
ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"


def divide(a_ends: np.ndarray, b_ends: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Places in ``a_ends`` of the shared ends, in order.

    Ends rise strictly. Interval ``i`` holds the tokens ``lo[i]`` to ``hi[i] - 1``, and its last end is shared.
    """
    found = [hi - 1]

    def shared(at: np.ndarray) -> np.ndarray:
        ends = a_ends[at]
        return b_ends[np.minimum(np.searchsorted(b_ends, ends), len(b_ends) - 1)] == ends

    while True:
        inner = hi - lo > 1
        lo, hi = lo[inner], hi[inner]
        if not len(lo):
            return np.sort(np.concatenate(found))
        middle, cut = (lo + hi - 1) // 2, np.full(len(lo), -1, np.int64)
        open_ = np.arange(len(lo))
        for step in range(NEAR + 1):
            for at in (middle[open_] - step, middle[open_] + step):
                inside = (at >= lo[open_]) & (at < hi[open_] - 1) & (cut[open_] < 0)
                hit = np.flatnonzero(inside)[shared(at[inside])]
                cut[open_[hit]] = at[hit]
            more = (middle[open_] - step > lo[open_]) | (middle[open_] + step + 1 < hi[open_] - 1)
            open_ = open_[more & (cut[open_] < 0)]
            if not len(open_):
                break
        for i in open_.tolist():
            all_ends = np.arange(lo[i], hi[i] - 1)
            hits = all_ends[shared(all_ends)]
            if len(hits):
                cut[i] = hits[np.argmin(np.abs(hits - middle[i]))]
        split = cut >= 0
        lo, hi, cut = lo[split], hi[split], cut[split]
        found.append(cut)
        # In order: neighbours are looked up one after the other.
        lo, hi = np.stack([lo, cut + 1], 1).ravel(), np.stack([cut + 1, hi], 1).ravel()


class Vocabulary:
    """Bytes of each id; ids without bytes of their own have none."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def joined(self, ids: list[int] | np.ndarray) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


def byte_level(entries: dict[str, int]) -> Vocabulary:
    """Vocabulary whose entries write each byte as a visible character: bytes that print stand for themselves, the
    others for the characters from 256 on, in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(others)}
    tokens = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        tokens[i] = bytes(byte_of[c] for c in entry)
    return Vocabulary(tokens)


def pieces(model) -> Vocabulary:
    """Vocabulary of a piece model: a lower block is a blank, ``<0xHH>`` a byte; control pieces have no bytes."""
    tokens = []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            tokens.append(b"")
        elif model.is_byte(i):
            tokens.append(bytes([int(model.id_to_piece(i)[3:5], 16)]))
        else:
            tokens.append(model.id_to_piece(i).replace("▁", " ").encode())
    return Vocabulary(tokens)


def pair_bound(a: Vocabulary, b: Vocabulary) -> int:
    """Most pairs of ids that can ever be linked: one of both is a suffix of the other."""

    def below(these: Vocabulary, those: Vocabulary) -> int:
        times = Counter(t for t in those.tokens if t)
        return sum(times[t[k:]] for t in these.tokens for k in range(len(t)))

    return below(a, b) + below(b, a)


class Encoder:
    """Ids of both tokenizers for texts behind a blank, with a bounded memory of parts.

    Before a single blank between visible plain letters both begin a new token: the byte-level pattern cuts there, and
    no piece holds a blank behind another character. So a plain text is cut at these blanks and each part is encoded
    once. All other texts are encoded whole.
    """

    REMEMBERED = 200_000
    AT_ONCE = 64
    PLAIN_UNTIL = "ɏ"
    SPACES = tuple(chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160))

    def __init__(self, tokenizer: str, ranks: str, model: str) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.file = Tokenizer.from_file(tokenizer)
        self.file.encode_special_tokens = True
        special = {t.content for t in self.file.get_added_tokens_decoder().values()}
        self.a = byte_level({t: i for t, i in self.file.get_vocab(with_added_tokens=True).items() if t not in special})
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(x): int(y) for x, y in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.b = pieces(self.model)
        if max(len(self.a.tokens), len(self.b.tokens)) > np.iinfo(IDS).max + 1:
            raise ValueError("ids of these vocabularies do not fit two bytes")
        self.cuts_at_blanks = not any(b" " in t.lstrip(b" ") for t in self.b.tokens)
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.flat = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def _learn(self, new: list[str]) -> None:
        bytes_to = np.cumsum([1 + (len(p) if p.isascii() else len(p.encode())) for p in new])
        pieces_of: list[int] = []
        for at in range(0, len(new), self.AT_ONCE):
            pieces_of += self.model.encode(" ".join(new[at : at + self.AT_ONCE]))
        for side, (ids, words) in enumerate(((self.ranks.encode_ordinary(" " + " ".join(new)), self.a), (pieces_of, self.b))):
            ids = np.array(ids, np.int32)
            ends = np.searchsorted(np.cumsum(words.lengths[ids]), bytes_to) + 1
            self.ends[side] = np.concatenate([self.ends[side], ends + len(self.flat[side])])
            self.flat[side] = np.concatenate([self.flat[side], ids])
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))

    def _plain(self, text: str) -> bool:
        if not self.cuts_at_blanks or text[0] in self.SPACES or text[-1] in self.SPACES or any(s + " " in text for s in self.SPACES):
            return False
        return (text.isascii() or max(text) <= self.PLAIN_UNTIL) and "\0" not in text

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        data = b" " + text.encode()
        a, b = self.file.encode(" " + text, add_special_tokens=False).ids, self.model.encode(text)
        if self.a.joined(a) != data or self.b.joined(b) != data:
            a, b = [], []
        return np.array(a, np.int32), np.array(b, np.int32)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both; none where a text is empty or cannot be given back."""
        nothing = np.zeros(0, np.int32)
        out: list = [(nothing, nothing)] * len(texts)
        cut = {n: t.split(" ") for n, t in enumerate(texts) if t and self._plain(t)}
        every = set().union(*cut.values())
        new = [p for p in every if p not in self.rows]
        if len(self.rows) + len(new) > self.REMEMBERED:
            self._forget()
            new = list(every)
        if new:
            self._learn(new)
        find = self.rows.__getitem__
        for n, text in enumerate(texts):
            if n in cut:
                at = np.fromiter(map(find, cut[n]), np.int64, len(cut[n]))
                sides = []
                for flat, ends in zip(self.flat, self.ends):
                    size = ends[at + 1] - ends[at]
                    stop = np.cumsum(size)
                    sides.append(flat[np.arange(stop[-1]) + np.repeat(ends[at] - stop + size, size)])
                out[n] = tuple(sides)
            elif text:
                out[n] = self._whole(text)
        return out


_at_hand: dict[tuple[str, str, str], Encoder] = {}


def _encoder(*paths: str) -> Encoder:
    if paths not in _at_hand:
        _at_hand[paths] = Encoder(*paths)
    return _at_hand[paths]


def groups(encoded: list[tuple[np.ndarray, np.ndarray]], a: Vocabulary, b: Vocabulary) -> list[tuple[np.ndarray, np.ndarray]]:
    """Tokens of either side in each group, for the texts' ids."""
    full = [n for n, (x, _) in enumerate(encoded) if len(x)]
    out = [(np.zeros(0, np.int32), np.zeros(0, np.int32))] * len(encoded)
    if not full:
        return out
    counts = [np.array([len(encoded[n][side]) for n in full], np.int64) for side in (0, 1)]
    ends = [np.cumsum(v.lengths[np.concatenate([encoded[n][side] for n in full])]) for side, v in enumerate((a, b))]
    if ends[0][-1] < 2**31:
        ends = [e.astype(np.int32) for e in ends]
    hi = np.cumsum(counts[0])
    cuts = divide(ends[0], ends[1], hi - counts[0], hi)  # a text's end is shared by both
    in_b = np.searchsorted(ends[1], ends[0][cuts])
    sizes = [np.diff(np.concatenate([[-1], c])).astype(np.int32) for c in (cuts, in_b)]
    of = np.searchsorted(cuts, hi - 1) + 1
    for n, begin, end in zip(full, [0, *of.tolist()], of.tolist()):
        out[n] = sizes[0][begin:end], sizes[1][begin:end]
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, TEXTS):
            yield b.slice(at, TEXTS)


def align(df: DataFrame, tokenizer: str, ranks: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: :data:`ALIGNED`, the ids of both sides and how many of either each group has."""
    ints = pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), *[(n, ints) for n, _ in SIDES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            flat = [_flat(b, n) for n, _ in SIDES]
            lists = [pa.ListArray.from_arrays(at.astype(np.int32), values.astype(np.int32)) for values, at in flat]
            yield pa.RecordBatch.from_arrays([b.column(0), *lists], schema=schema)

    return pack_groups(df, tokenizer, ranks, model, id_col, text_col).mapInArrow(run, ALIGNED)


def pack_groups(df: DataFrame, tokenizer: str, ranks: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`align` with its arrays as bytes, :data:`PACKED`.

    ``tokenizer``, ``ranks`` (the same vocabulary) and ``model`` are paths on every executor.
    """
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.binary()) for n, _ in SIDES]])

    def binary(parts: list[np.ndarray], kind: np.dtype) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32) * kind.itemsize
        data = np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)
        return pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, ranks, model)
        for part in _slices(batches):
            encoded = encoder.encode(part.column(1).to_pylist())
            sizes = groups(encoded, encoder.a, encoder.b)
            columns = [binary([x[side] for x in of], kind) for of, kind in ((encoded, IDS), (sizes, SIZES)) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema=schema)

    return id_and_text(df, id_col, text_col).mapInArrow(run, PACKED)


def _flat(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a packed column and where each row's begin, with the end at last."""
    column, kind = b.column(b.schema.get_field_index(name)), dict(SIDES)[name]
    _, offsets, data = column.buffers()
    if offsets is None or data is None:
        return np.zeros(0, kind), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, kind, (at[-1] - at[0]) // kind.itemsize, at[0]), (at - at[0]) // kind.itemsize


def _links(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids that end together as one number each, and where each row's begin."""
    (a_ids, _), (b_ids, _), (a_sizes, at), (b_sizes, _) = (_flat(b, n) for n, _ in SIDES)
    return a_ids[np.cumsum(a_sizes, dtype=np.int64) - 1].astype(np.int64) << 32 | b_ids[np.cumsum(b_sizes, dtype=np.int64) - 1].astype(np.int64), at


def pair_counts(packed: DataFrame) -> DataFrame:
    """``a, b, n, best``: how many links hold a pair of ids, and whether no pair of its ``b`` has more."""
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new, times = np.unique(np.concatenate([*waiting, np.zeros(0, np.int64)]), return_counts=True)
            both, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, place, np.concatenate([counts, times]))
            return both, total

        for b in _slices(batches):
            waiting.append(_links(b)[0])
            size += len(waiting[-1])
            if size >= PAIRS:
                keys, counts = merged()
                waiting, size = [], 0
        keys, counts = merged()
        if len(keys):
            columns = [(keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), counts]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    made = packed.select(*[n for n, _ in SIDES]).mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy("b"))  # no more rows than the other vocabulary has ids
    return made.select("a", "b", "n", (F.col("n") == most).alias("best"))


def digests(packed: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document: numbers of tokens, groups and links, how common its links are, and its groups' digest.

    ``counts`` is brought to the tasks whole; see the module's text for its bound.
    """
    table = counts.select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("key"), "n", "best").toArrow().sort_by("key")
    sent = packed.sparkSession.sparkContext.broadcast(tuple(table.column(n).to_numpy() for n in ("key", "n", "best")))
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = pa.schema([*[(n, pa.int64()) for n in names], ("groups_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times, best = sent.value
        for b in _slices(batches):
            links, at = _links(b)
            where = np.searchsorted(keys, links)
            sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times[where], best[where].astype(np.int64))]
            count_sum, n_best = (s[at[1:]] - s[at[:-1]] for s in sums)
            sides = [_flat(b, n) for n in ("a_ids", "b_ids")]
            n_a, n_b = (np.diff(offsets) for _, offsets in sides)
            n_groups = np.diff(at)
            columns = [b.column(b.schema.get_field_index("doc_id")), n_a, n_b, n_groups, n_groups, n_best, count_sum]
            written = _written(b)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns] + [pa.array(written)], schema=schema)

    return packed.mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", groups_sha256 string")


_tails: dict[str, list[str]] = {}


def _tail(mark: str, most: int) -> list[str]:
    """Each id with a mark behind it."""
    known = _tails.setdefault(mark, [])
    known.extend(f"{i}{mark}" for i in range(len(known), most + 1))
    return known


def _written(b: pa.RecordBatch) -> list[str]:
    """sha256 of ``a1,a2|b1;a3|b2,b3`` for each row, nothing where there are no tokens."""
    (a_ids, a_at), (b_ids, b_at), (a_sizes, _), (b_sizes, _) = (_flat(b, n) for n, _ in SIDES)
    if not len(a_ids):
        return [""] * b.num_rows
    a_stop, b_stop = np.cumsum(a_sizes, dtype=np.int64), np.cumsum(b_sizes, dtype=np.int64)
    a_last, b_last = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_last[a_stop - 1], b_last[b_stop - 1] = 1, 1
    # Place of each token in the written row: the other side's tokens of earlier (for b: and of this) groups come before.
    a_place = np.arange(len(a_ids)) + np.repeat(b_stop - b_sizes, a_sizes)
    b_place = np.arange(len(b_ids)) + np.repeat(a_stop, b_sizes)
    most = int(max(a_ids.max(), b_ids.max()))
    marked = [_tail(m, most) for m in (",", "|", ";")]
    width = len(marked[0])
    text = marked[0][:width] + marked[1][:width] + marked[2][:width]
    code = np.empty(len(a_ids) + len(b_ids), np.int64)
    code[a_place] = a_ids + a_last * width
    code[b_place] = b_ids + b_last * 2 * width
    row_at = (a_at + b_at).tolist()
    parts = list(map(text.__getitem__, code.tolist()))
    return [hashlib.sha256("".join(parts[i:j])[:-1].encode()).hexdigest() if j > i else "" for i, j in zip(row_at, row_at[1:])]
