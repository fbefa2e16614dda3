"""SimHash near-duplicates through an inverted index of byte positions.

Two 64-bit fingerprints that differ in at most three bits differ in at most three of their eight bytes, so they
share at least five bytes at the same place. The index lists every fingerprint under each of its 56 choices of
five positional bytes; a pair is met under a choice it shares, its shared positional bytes are counted, pairs
below the guaranteed five are dropped, and the bits of the rest are compared.

One entry of the index holds fingerprints that differ in three bytes only, so never more than 2**24 however
large the corpus; equal fingerprints are one entry. Within an entry no pair leaves the task: only the links of a
spanning star do.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stratalake.functions.keys import named
from stratalake.llm.common import batch, free_name, id_and_text, runs, stage, text_key, texts_of
from stratalake.llm.components import components

SEED = 42
BYTES = 8
AT_ONCE = 1 << 16
BLOCK = 1 << 20


def fingerprint(text: bytes, shingle_words: int) -> int:
    """Majority of the bits of all shingle hashes, unsigned; zero for a text without words."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    size = min(shingle_words, len(words))
    starts = [0, *ends[: len(words) - size]]
    stops = ends[size - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), AT_ONCE):
        pairs = zip(starts[at : at + AT_ONCE], stops[at : at + AT_ONCE])
        hashes = np.array([xxh64_intdigest(joined[a : b - 1], SEED) for a, b in pairs], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """``doc_id, fp`` for each row, ``fp`` as a signed long. Null texts are empty; null ids stay null."""
    return _fingerprinted(id_and_text(df, id_col, text_col), shingle_words)


def _fingerprinted(rows: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id, fp`` and the further columns of ``rows``, longs behind ``doc_id`` and ``text``."""
    further = rows.columns[2:]
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "fp", *further)])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t, shingle_words) for t in texts_of(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64)), *b.columns[2:]], schema=schema)

    return rows.mapInArrow(compute, ", ".join(f"{c} long" for c in schema.names))


def _rooted(own: DataFrame, least: Column, max_bits: int) -> DataFrame:
    """``fp, least, root`` for each distinct fingerprint of ``own``: an aggregate of its rows, and its component."""
    nodes, _ = stage(own.groupBy("fp").agg(least.alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), max_bits)).select(F.col("node").alias("fp"), "root")
    return nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def _positional_keys(max_bits: int) -> list[int]:
    """Masks of the byte choices that two fingerprints within ``max_bits`` are sure to share one of."""
    if not 0 <= max_bits < BYTES:
        raise ValueError(f"the byte index needs 0 to {BYTES - 1} differing bits, not {max_bits}")
    return [sum(0xFF << (8 * p) for p in kept) for kept in combinations(range(BYTES), BYTES - max_bits)]


def _differing_bytes(x: np.ndarray) -> np.ndarray:
    x = x | (x >> np.uint64(4))
    x = x | (x >> np.uint64(2))
    x = x | (x >> np.uint64(1))
    return np.bitwise_count(x & np.uint64(0x0101010101010101))


def _pairs(fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked fingerprints within one index entry, in blocks of bounded size.

    A large entry is walked by bit flips instead of pairs: its fingerprints share all but ``max_bits`` bytes, so
    there are only so many flips, and the work stays proportional to the entry.
    """
    n = len(fps)
    free = [p for p in range(64) if ((int(np.bitwise_or.reduce(fps)) ^ int(np.bitwise_and.reduce(fps))) >> p) & 1]
    flips = sum(1 for k in range(1, max_bits + 1) for _ in combinations(free, k)) if len(free) <= 8 * max_bits else n
    if flips * 16 < n:
        order = np.argsort(fps)
        ordered = fps[order]
        for k in range(1, max_bits + 1):
            for bits in combinations(free, k):
                mask = np.uint64(sum(1 << b for b in bits))
                at = np.minimum(np.searchsorted(ordered, ordered ^ mask), n - 1)
                hit = np.flatnonzero((ordered[at] == ordered ^ mask) & (at > np.arange(n)))
                if len(hit):
                    yield order[hit], order[at[hit]]
        return
    step = max(1, BLOCK // n)
    for a in range(0, n, step):
        x = fps[a : a + step, None] ^ fps[None, :]
        # Counting filter on shared positional bytes, then the bits.
        i, j = np.nonzero(BYTES - _differing_bytes(x) >= BYTES - max_bits)
        near = (np.bitwise_count(x[i, j]) <= max_bits) & (i + a < j)
        yield i[near] + a, j[near]


def _star(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint linked to the first of its component within the entry."""
    root = np.arange(len(fps))
    for i, j in _pairs(fps, max_bits):
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return fps[root[moved]], fps[moved]


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """``u, v``: links between the distinct fingerprints ``fp`` whose components are those of all links."""
    masks = _positional_keys(max_bits)
    listed = F.array(*[F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))) for n, m in enumerate(masks)])
    index = distinct.select("fp", F.explode(listed).alias("entry")).repartition("entry").sortWithinPartitions("entry")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_fp, rest_entry = [], []

        def solved(fp: np.ndarray, entry: np.ndarray) -> pa.RecordBatch:
            cuts = runs(entry)
            big = np.flatnonzero(np.diff(cuts) > 1)
            u, v = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for k in big:
                group = fp[cuts[k] : cuts[k + 1]]
                if len(group) == 2:
                    x = group[:1] ^ group[1:]
                    if _differing_bytes(x)[0] <= max_bits and np.bitwise_count(x)[0] <= max_bits:
                        u.append(group[:1])
                        v.append(group[1:])
                    continue
                a, b = _star(group, max_bits)
                u.append(a)
                v.append(b)
            return batch({"u": np.concatenate(u).view(np.int64), "v": np.concatenate(v).view(np.int64)}, schema)

        for b in batches:
            fp, entry = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()
            if not len(entry):
                continue
            if rest_entry and entry[-1] == rest_entry[0][0]:  # one entry goes on over whole batches
                rest_fp.append(fp)
                rest_entry.append(entry)
                continue
            fp, entry = np.concatenate([*rest_fp, fp]), np.concatenate([*rest_entry, entry])
            cut = runs(entry)[-2]
            rest_fp, rest_entry = [fp[cut:]], [entry[cut:]]
            yield solved(fp[:cut], entry[:cut])
        if rest_entry:
            yield solved(np.concatenate(rest_fp), np.concatenate(rest_entry))

    return index.select("fp", "entry").mapInArrow(entries, "u long, v long")


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per row of ``df``: ``doc_id, fp, component_id``.

    ``component_id`` is the smallest id among all rows whose fingerprints are reachable over links of at most
    ``max_bits`` differing bits. Null and empty texts have fingerprint zero and are linked like any other; texts
    of any length are read whole. A null id stays null and names a component only if it has no other id; a
    repeated row is repeated. An empty table gives an empty one.
    """
    own, _ = stage(fingerprints(df, id_col, text_col, shingle_words), "fingerprints")
    rooted = _rooted(own, F.min("doc_id"), max_bits)
    named_roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.join(named_roots, "root").select("fp", "component_id")
    return own.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``df``, one per component: that with the smallest id; a row with a null id if none has an id.

    Of several such rows the one of the smallest text hash stays, then that of the smallest hash of all columns, so
    a retried task keeps the same row. Rows equal in all columns are one. Rows of different components never meet,
    also where they share an id or have none.
    """
    every = [named(c) for c in df.columns]
    hashed = [F.to_json(F.struct(c)) if "map<" in kind or kind == "variant" else c for c, (_, kind) in zip(every, df.dtypes)]
    mine = [free_name(df, n) for n in ("id", "text", "row")]
    marked = df.select(
        *every,
        named(id_col).cast("long").alias(mine[0]),
        text_key(F.coalesce(named(text_col).cast("string"), F.lit(""))).alias(mine[1]),
        F.xxhash64(*hashed, *[F.isnull(c) for c in every]).alias(mine[2]),
    )
    rows = marked.select(F.col(mine[0]).alias("doc_id"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"), F.col(mine[1]).alias("text_key"), F.col(mine[2]).alias("row_key"))
    own, _ = stage(_fingerprinted(rows, shingle_words), "fingerprints")
    age = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_key", "row_key")
    stay = _rooted(own, F.min(age), max_bits).groupBy("root").agg(F.min("least").alias("least")).select("least.*")
    theirs = [free_name(df, n) for n in ("stay", "stay_text", "stay_row")]
    stay = stay.select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "text_key", "row_key"), theirs)])
    same = F.col(mine[0]).eqNullSafe(F.col(theirs[0])) & (F.col(mine[1]) == F.col(theirs[1])) & (F.col(mine[2]) == F.col(theirs[2]))
    kept = marked.join(stay, same).dropDuplicates(mine)
    return kept.select(*every)
