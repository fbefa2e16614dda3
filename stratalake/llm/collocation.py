"""Phrase collocations by prefix-free parsing.

Each text is a sequence of words and breaks. A window of :data:`OVERLAP` tokens whose hash is divisible by a modulus is
a trigger; a text is cut at its triggers into chunks that overlap by that window, so equal passages give equal chunks
wherever they stand. The dictionary holds the distinct chunks of a language with the number of times the parse has
them. Phrases are counted inside the distinct chunks, weighted by that number. A phrase belongs to the chunk in which it
begins before the chunk's last window (in the last chunk of a text: anywhere), so each occurrence counts once; the
window is as long as the longest phrase less one word, so the whole phrase lies in that chunk.

Counting goes by length: words, then pairs by their hash alone, then all phrases. A phrase is counted only if its words
and pairs are frequent, as no phrase is more frequent than its parts. What is frequent is told to the tasks by a Bloom
filter of a bounded size; it, and pairs of one hash, let some rare phrases through, which the exact counts then drop.
Most pairs of a corpus are rare, so their hashes travel packed: five bytes for each pair of a task.

Defined results: a null text is empty and has no words; a null language is ``und``; repeated rows count each; ties go
to the smallest cut and to the phrase that sorts first by its UTF-8 bytes; an empty table gives no rows. Other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.keys import named
from stratalake.llm.common import remove, runs, stage, texts_of, tidy_shuffles

MAX_WORDS = 5
MODULUS = 64
#: Tokens that a task counts at once.
TOKENS = 1 << 21
#: Bits of a filter: the least, the most, and for each phrase that it holds.
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 15, 1 << 27, 16
#: Pairs of all tasks that one task merges, more or less.
PAIRS_IN_BLOCK = 1 << 22
BITMAP = 1 << 15  # bits in a row of bitmap_construct_agg

BREAKS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"."
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else BREAK[0] if b in BREAKS else b for b in range(256))


def tokens_of(text: bytes) -> list[bytes]:
    """Words in lower case, and :data:`BREAK` where a piece ends."""
    return text.translate(_NORMAL).replace(BREAK, b" . ").split()


class _Hashes(dict):
    """Hash of a token, remembered."""

    MOST = 400_000

    def __missing__(self, token: bytes) -> int:
        if len(self) > self.MOST:
            self.clear()
        found = self[token] = xxhash.xxh64_intdigest(token)
        return found


_MIX = np.uint64(0x9E3779B97F4A7C15)


def chunk_ends(hashes: np.ndarray, overlap: int, modulus: int) -> np.ndarray:
    """Where chunks end: behind each trigger, and at the end."""
    n = len(hashes)
    if n <= overlap:
        return np.array([n], np.int64)
    rolled = np.zeros(n - overlap + 1, np.uint64)
    for k in range(overlap):
        rolled = rolled * _MIX + hashes[k : n - overlap + 1 + k]
    rolled ^= rolled >> np.uint64(29)
    rolled *= _MIX
    rolled ^= rolled >> np.uint64(32)
    ends = np.flatnonzero(rolled % np.uint64(modulus) == 0) + overlap
    ends = ends[(ends > overlap) & (ends < n)]  # the first chunk is longer than a window
    return np.append(ends, n)


def parse(df: DataFrame, overlap: int = MAX_WORDS - 1, modulus: int = MODULUS) -> DataFrame:
    """``lang, chunk, last, n``: chunks of the texts (``lang``, ``text``), counted within a batch."""
    schema = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("last", pa.bool_()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for b in batches:
            found: Counter[tuple[str, bytes, bool]] = Counter()
            for lang, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                tokens = tokens_of(text)
                if not tokens:
                    continue
                hashes = np.array([known[t] for t in tokens], np.uint64)
                begin, ends = 0, chunk_ends(hashes, overlap, modulus).tolist()
                for end in ends:
                    found[lang, b" ".join(tokens[begin:end]), end == ends[-1]] += 1
                    begin = end - overlap
            if found:
                langs, chunks, lasts = zip(*found)
                columns = [pa.array(langs, pa.string()), pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(lasts), pa.array(found.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return df.select("lang", "text").mapInArrow(run, "lang string, chunk string, last boolean, n long")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


class Filter:
    """Bloom filter with two bits for each hash, built by Spark and held by the tasks."""

    def __init__(self, bits: int, rows: list[tuple[int, bytes]]) -> None:
        self.bits, self.data = bits, bytearray(bits // 8)
        for number, bitmap in rows:
            self.data[number * BITMAP // 8 : (number + 1) * BITMAP // 8] = bitmap

    @classmethod
    def of(cls, hashes: DataFrame, count: int) -> Filter:
        """Filter of the column ``h``; its size follows ``count`` up to :data:`MOST_BITS`."""
        bits, h = LEAST_BITS, F.col("h")
        while bits < min(count * BITS_EACH, MOST_BITS):
            bits *= 2
        places = hashes.select(F.explode(F.array(h.bitwiseAND(bits - 1), F.shiftrightunsigned(h, 32).bitwiseAND(bits - 1))).alias("at"))
        bitmaps = places.groupBy(F.shiftright("at", 15).alias("number")).agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(BITMAP - 1)).alias("bitmap"))
        return cls(bits, [(r["number"], bytes(r["bitmap"])) for r in bitmaps.collect()])  # MOST_BITS at most

    def has(self, h: np.ndarray) -> np.ndarray:
        """Which hashes the filter may hold."""
        bits, mask = np.frombuffer(self.data, np.uint8), np.uint64(self.bits - 1)
        inside = np.ones(len(h), bool)
        for at in (h & mask, (h >> np.uint64(32)) & mask):
            inside &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return inside


def _word_hash() -> Column:
    """What :func:`_word_hashes` gives, for the columns ``lang`` and ``phrase``."""
    return F.xxhash64(F.concat("lang", F.lit("\n"), "phrase")).alias("h")


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    head = lang.encode() + b"\n"
    return np.fromiter((xxhash.xxh64_intdigest(head + w, 42) for w in words), np.uint64, len(words))


class _Chunks:
    """Chunks of one language as one run of numbers; 0 stands for a break."""

    def __init__(self, lang: str, rows: list[tuple[list[bytes], bool, int]], overlap: int, words: Filter | None) -> None:
        ids: dict[bytes, int] = {BREAK: 0}
        flat: list[int] = []
        for tokens, _, _ in rows:
            flat.extend([ids.setdefault(t, len(ids)) for t in tokens])
            flat.append(0)  # no phrase reaches into the next chunk
        self.s, self.names = np.array(flat, np.int64), list(ids)
        lengths = np.array([len(t) + 1 for t, _, _ in rows], np.int64)
        self.weight = np.repeat(np.array([n for _, _, n in rows], np.float64), lengths)
        own = np.array([len(t) + 1 if last else max(0, len(t) - overlap) for t, last, _ in rows], np.int64)
        begin = np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.weight[np.arange(len(flat)) - begin >= np.repeat(own, lengths)] = 0
        self.hashes = np.zeros(0, np.uint64) if words is None else _word_hashes(lang, self.names)
        fine = np.ones(len(ids), bool) if words is None else words.has(self.hashes)
        fine[0] = False
        #: Where the phrases of one length begin, which of them it is, and for each of them the one before and the last word.
        self.places = np.flatnonzero(fine[self.s])
        self.key = self.s[self.places]
        self.distinct = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def longer(self, size: int) -> None:
        """On to phrases of one word more: such a phrase and the one behind it must both be there."""
        there = np.full(len(self.s) + 1, -1, np.int64)
        there[self.places] = self.key
        self.places = self.places[there[self.places + 1] >= 0]
        both = there[self.places] * len(self.names) + self.s[self.places + size - 1]
        distinct, self.key = np.unique(both, return_inverse=True)
        self.distinct = distinct // len(self.names), distinct % len(self.names)

    def keep(self, fine: np.ndarray) -> None:
        self.places, self.key = self.places[fine[self.key]], self.key[fine[self.key]]

    def counts(self, n: int) -> np.ndarray:
        return np.bincount(self.key, weights=self.weight[self.places], minlength=n).astype(np.int64)

    def pair_hashes(self) -> np.ndarray:
        """Of the distinct pairs, from the hashes of their words, which hold the language."""
        return _mixed(self.hashes[self.distinct[0]] * _MIX + self.hashes[self.distinct[1]])


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Chunks of a bounded number of tokens by language."""
    held: dict[str, list] = {}
    size = 0
    for b in batches:
        for lang, chunk, last, n in zip(b.column(0).to_pylist(), texts_of(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()):
            tokens = chunk.split(b" ")
            held.setdefault(lang, []).append((tokens, last, n))
            size += len(tokens) + 1
            if size >= TOKENS:
                yield held
                held, size = {}, 0
    yield held


def count(dictionary: DataFrame, sizes: range, overlap: int, words: Filter | None = None, pairs: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """``lang, words, phrase, f``: occurrences of the phrases of ``sizes`` words that the filters let through; ``pairs``
    judges the hashes of pairs."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])
    sent = dictionary.sparkSession.sparkContext.broadcast((words, pairs))

    def rows(lang: str, size: int, phrases: list[bytes], counts: np.ndarray) -> pa.RecordBatch:
        met = np.flatnonzero(counts)
        names = pa.array([phrases[i] for i in met.tolist()], pa.binary()).cast(pa.string())
        columns = [pa.array([lang] * len(met), pa.string()), pa.array(np.full(len(met), size, np.int32)), names, pa.array(counts[met])]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = sent.value
        for held in _by_language(batches):
            for lang, of_lang in held.items():
                chunks = _Chunks(lang, of_lang, overlap, words)
                phrases = chunks.names
                if 1 in sizes:
                    yield rows(lang, 1, phrases, chunks.counts(len(phrases)))
                for size in range(2, max(sizes) + 1):
                    chunks.longer(size)
                    if size == 2 and pairs is not None:
                        chunks.keep(pairs(chunks.pair_hashes()))
                    used = np.unique(chunks.key).tolist()
                    before, last = (d.tolist() for d in chunks.distinct)
                    longer = [b""] * len(before)
                    for i in used:
                        longer[i] = phrases[before[i]] + b" " + chunks.names[last[i]]
                    phrases = longer
                    if size in sizes:
                        yield rows(lang, size, phrases, chunks.counts(len(phrases)))

    made = dictionary.select("lang", "chunk", "last", "n").mapInArrow(run, "lang string, words int, phrase string, f long")
    return made.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


class _PairKey:
    """Block and 32 bits of a pair's hash; there are as many blocks as the corpus asks for."""

    def __init__(self, tokens: int) -> None:
        self.bits = max(6, (tokens // PAIRS_IN_BLOCK).bit_length())

    def split(self, h: np.ndarray) -> np.ndarray:
        return h >> np.uint64(32 - self.bits)

    @staticmethod
    def whole(key: np.ndarray) -> np.ndarray:
        return _mixed(key * _MIX)


class _Pairs:
    """Whether a pair's hash is one of a frequent pair."""

    def __init__(self, key: _PairKey, frequent: Filter) -> None:
        self.key, self.frequent = key, frequent

    def __call__(self, h: np.ndarray) -> np.ndarray:
        return self.frequent.has(self.key.whole(self.key.split(h)))


def frequent_pairs(dictionary: DataFrame, min_count: int, overlap: int, words: Filter, key: _PairKey) -> DataFrame:
    """``h``: hashes of the pairs that are frequent, and of those that share one with others and are so together."""
    kind = np.dtype(np.uint8 if min_count <= 255 else np.uint32)
    schema = pa.schema([("block", pa.int32()), ("data", pa.binary())])
    sent = dictionary.sparkSession.sparkContext.broadcast(words)

    def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, place = np.unique(keys, return_inverse=True)
        # A count that is high enough need not be known any better.
        return distinct, np.minimum(np.bincount(place, weights=counts, minlength=len(distinct)), min_count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0)]

        def packed() -> pa.RecordBatch:
            distinct, total = summed(np.concatenate(keys), np.concatenate(counts))
            blocks = (distinct >> np.uint64(32)).astype(np.int64)
            begin = runs(blocks)
            low, total = distinct.astype(np.uint32), total.astype(kind)
            data = [low[i:j].tobytes() + total[i:j].tobytes() for i, j in zip(begin[:-1].tolist(), begin[1:].tolist())]
            return pa.RecordBatch.from_arrays([pa.array(blocks[begin[:-1]], pa.int32()), pa.array(data, pa.binary())], schema=schema)

        for held in _by_language(batches):
            for lang, of_lang in held.items():
                chunks = _Chunks(lang, of_lang, overlap, sent.value)
                chunks.longer(2)
                of_pairs = chunks.counts(len(chunks.distinct[0]))
                keys.append(key.split(chunks.pair_hashes()[of_pairs > 0]))
                counts.append(of_pairs[of_pairs > 0])
            if sum(map(len, keys)) >= 2 * TOKENS:
                yield packed()
                keys, counts = keys[:1], counts[:1]
        yield packed()

    def merge(group: tuple, t: pa.Table) -> pa.Table:
        parts = [(np.frombuffer(d, np.uint32, n), np.frombuffer(d, kind, n, 4 * n)) for d in t.column("data").to_pylist() for n in (len(d) // (4 + kind.itemsize),)]
        low, total = summed(np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts]))
        often = (np.uint64(group[0].as_py()) << np.uint64(32)) | low[total >= min_count].astype(np.uint64)
        return pa.table({"h": pa.array(key.whole(often).view(np.int64))})

    made = dictionary.select("lang", "chunk", "last", "n").mapInArrow(run, "block int, data binary")
    return made.groupBy("block").applyInArrow(merge, "h long")


def lift(a: Column, n: Column, left: Column, right: Column) -> Column:
    """``floor(1000 * a * n / (left * right))`` in whole decimals of 38 digits."""
    up = (a.cast("decimal(16,0)") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(19,0)") * n.cast("decimal(19,0)")
    down = left.cast("decimal(19,0)") * right.cast("decimal(19,0)")
    # Without the remainder the division leaves no fraction to round.
    return ((up - up % down) / down).cast("decimal(38,0)").cast("long")


def mine(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = 100,
    limit: int | None = 2000,
    contained_percent: int = 100,
    max_words: int = MAX_WORDS,
    modulus: int = MODULUS,
) -> DataFrame:
    """The highest-scoring phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is a phrase's count, at least ``min_count``, ``l`` and ``r`` those of its parts at the cut that scores
    lowest, ``n`` the words of the language. A phrase goes if one that has a word more, and holds it, has at least
    ``contained_percent`` of its count: any longer one that has lies around such a one. ``limit`` rows for each
    language are returned, all with ``None``.
    """
    spark, overlap = df.sparkSession, max_words - 1
    texts = df.select(F.coalesce(named(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))
    with tidy_shuffles(spark):
        parsed = parse(texts, overlap, modulus).groupBy("lang", "chunk", "last").agg(F.sum("n").alias("n"))
        dictionary, at = stage(parsed, "phrase-chunks", compression="zstd")
        words, words_at = stage(count(dictionary, range(1, 2), overlap), "phrase-words")
        totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
        often = F.col("f") >= min_count
        frequent_words = words.where(often)
        of_words = Filter.of(frequent_words.select(_word_hash()), frequent_words.count())
        key = _PairKey(totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        hashes, hashes_at = stage(frequent_pairs(dictionary, min_count, overlap, of_words, key), "phrase-pairs")
        of_pairs = _Pairs(key, Filter.of(hashes, hashes.count()))
        longer, longer_at = stage(count(dictionary, range(2, max_words + 1), overlap, of_words, of_pairs).where(often), "phrase-longer")
        remove(spark, at, hashes_at)
        frequent = frequent_words.unionByName(longer)
        result, _ = stage(_scored(frequent, totals, limit, contained_percent), "phrases")
        remove(spark, words_at, longer_at)
    return result


def _part(first: int | Column, size: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " ", -1), first, size), " ")


def _scored(frequent: DataFrame, totals: DataFrame, limit: int | None, contained_percent: int) -> DataFrame:
    several = frequent.where("words > 1")
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"first": _part(1, F.col("k")), "rest": _part(F.col("k") + 1, F.col("words") - F.col("k"))})
    known = frequent.select("lang", "phrase", "f")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang").withColumn("score", lift(F.col("f"), F.col("n"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "phrase", F.col("f").alias("a"), "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    around = several.where("words > 2").select(
        "lang", F.explode(F.array(_part(1, F.col("words") - 1), _part(2, F.col("words") - 1))).alias("phrase"), F.col("f").alias("around")
    )
    around = around.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = best.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * contained_percent))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(order))
    ranked = ranked if limit is None else ranked.where(F.col("rank") <= limit)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
