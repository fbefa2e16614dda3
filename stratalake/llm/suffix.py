"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

Only suffixes that can share ``length`` bytes need to be sorted together, so the sort is dealt out by content.
Every string of ``length`` bytes belongs to one seed: the smallest hash of its grams of ``GRAM`` bytes, at its
first place. Equal strings have equal seeds at the same distance, hence

1. map tasks list, for each seed place of a document, the run of strings that belong to it (a neighbourhood).
   Equal neighbourhoods of a batch are folded before they move: only the first can be new.
2. By seed, all but the first of equal neighbourhoods are repeats. A seed with one distinct neighbourhood is done.
3. Of seeds with several, the first copies are cut into blocks of at most ``BLOCK`` starts, folded again, and
   dealt by the bytes that all strings of a block share. The inside of a passage that a third of all rows hold
   meets as a few distinct blocks. What straddles its edges does not: with other text around it in each row, one
   seed has a distinct neighbourhood per row. The neighbourhoods of a seed with more than ``MANY`` distinct ones
   are cut into single strings, so only equal strings meet, and what repeats one of its batch does not move.
   Seeds that a sample of the documents shows to be such are dealt by neighbourhood in step 2 already.
4. Blocks that share those bytes but differ are suffix-sorted: sampled triples (places 1 and 2 modulo 3) are
   sorted and named, the names are sorted by recursion, the remaining suffixes are merged in, and adjacent
   suffixes are compared over ``length`` bytes. Of every class of equal strings the earliest stays.

The recursion ends when names stand for ``length`` bytes or more, since later bytes do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stratalake.llm.common import id_and_text, remove, runs, stage, texts_of, tidy_shuffles

LENGTH = 100
GRAM = 32
BLOCK = 16
#: Bytes of text that are suffix-sorted at once; one group of blocks, at most ``MANY``, is never divided.
SORT_BYTES = 1 << 20
#: Distinct neighbourhoods of one seed whose blocks are sorted together; with more, its strings are dealt singly.
MANY = 4096
#: One document of so many is read beforehand for seeds with many neighbourhoods, and the number of them kept.
#: Results do not depend on it: a seed that the sample misses is counted in step 2.
SAMPLE, SAMPLED_SEEDS = 64, 1 << 16
#: Bytes of a document that are hashed at once; what spans a border is read twice.
READ_BYTES = 1 << 22
#: From here on lie the numbers of documents without an id, which come after all others: ids are smaller.
NO_ID = 1 << 62
#: A place is the first start, the number of starts, and some bits of the text's hash, in one number.
STARTS_BITS, KEY_BITS = 7, 22


def _place(start: np.ndarray, starts: np.ndarray, key: int) -> np.ndarray:
    return (start << STARTS_BITS + KEY_BITS) | (starts << KEY_BITS) | key


def _text_key() -> Column:
    """Tells texts of one id apart; rows equal in id and text are one document."""
    return F.xxhash64("text").bitwiseAND(F.lit((1 << KEY_BITS) - 1))


def _number() -> Column:
    """The id, or a number from the text: no two texts without an id share it and the bits of :func:`_text_key`."""
    own = F.xxhash64(F.lit("no id"), "text").bitwiseAND(F.lit(NO_ID - 1)) + F.lit(NO_ID)
    return F.coalesce("doc_id", own)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` bytes from each place on; ``size`` is a power of two."""
    h, step, power = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while step < size:
        h = h[:-step] * np.uint64(power) + h[step:]
        power, step = power * power & (1 << 64) - 1, 2 * step
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def seeds(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Place of the seed of the string at each start, and the seeds' hashes by place."""
    h = gram_hashes(data, GRAM)
    window = length - GRAM + 1
    least, at, reach = h, np.arange(len(h), dtype=np.int32), 1
    while reach < window:
        step = min(reach, window - reach)
        left, right = least[:-step], least[step:]
        later = right < left  # the first of equal ones stays
        at = np.where(later, at[step:], at[:-step])
        least = np.where(later, right, left)
        reach += step
    return at, h


def neighbourhoods(text: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First start, number of starts, seed place and seed hash of each run of strings with one seed, by text part.

    A run at the border of two parts comes in two pieces, which are cut at multiples of the part size.
    """
    for begin in range(0, len(text) - length + 1, READ_BYTES):
        data = np.frombuffer(text, np.uint8, min(READ_BYTES + length - 1, len(text) - begin), begin)
        at, h = seeds(data, length)
        cuts = runs(at)
        places = at[cuts[:-1]].astype(np.int64)
        yield cuts[:-1] + begin, np.diff(cuts), places + begin, h[places].view(np.int64)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols at least, by difference cover modulo 3.

    ``symbols`` are positive; the end of the text counts as zeros.
    """
    ranks = _ranks(symbols.astype(np.int64), depth)
    return np.argsort(ranks, kind="stable")


def _names(columns: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """Dense names, from 1, of rows in order, and how many there are."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new) + 1
    return names, int(new.sum()) + 1


def _ranks(s: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix; suffixes equal over ``depth`` symbols may share one."""
    n = len(s)
    if n < 4 or depth <= 1:
        padded = np.concatenate([s, np.zeros(3, np.int64)])
        return _names([padded[k : k + n] for k in range(3)])[0] if n else np.zeros(0, np.int64)
    padded = np.concatenate([s, np.zeros(5, np.int64)])
    # A suffix of length zero at place n is sampled where n modulo 3 is 1, so that every class ends alike.
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    names, distinct = _names([padded[sample], padded[sample + 1], padded[sample + 2]])
    if distinct < len(sample) and depth > 3:
        # The sampled classes behind each other; a zero ends the first where its last triple does not.
        between = np.zeros(1, np.int64)
        inner = _ranks(np.concatenate([names[: len(one)] + 1, between + 1, names[len(one) :] + 1]), -(-depth // 3))
        names = np.concatenate([inner[: len(one)], inner[len(one) + 1 :]])
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    # Merge: each suffix beside its sampled successors. Two of them are compared by as many symbols as bring both
    # to a sampled place: one if neither is of class 2, else two.
    return _merged(padded, rank, n)


def _merged(s: np.ndarray, rank: np.ndarray, n: int) -> np.ndarray:
    """Ranks of all suffixes from those of the sampled places."""
    zero = np.arange(0, n, 3)
    sampled = np.concatenate([np.arange(1, n, 3), np.arange(2, n, 3)])
    sampled = sampled[np.argsort(rank[sampled], kind="stable")]
    zero = zero[np.lexsort((rank[zero + 1], s[zero]))]
    # Where each remaining suffix goes among the sampled ones: by class 1 and by class 2 apart, each of which
    # compares by columns of its own.
    goes = np.zeros(len(zero), np.int64)
    for cls, keys in ((1, 1), (2, 2)):
        of = sampled[sampled % 3 == cls]
        if not len(of):
            continue
        columns = [np.concatenate([s[of + k], s[zero + k]]) for k in range(keys)]
        columns.append(np.concatenate([rank[of + keys], rank[zero + keys]]))
        names, _ = _names(columns)
        goes += np.searchsorted(np.sort(names[: len(of)]), names[len(of) :], side="left")
    goes = np.maximum.accumulate(goes)  # ties beyond the depth have no order of their own
    order = np.empty(n, np.int64)
    place = goes + np.arange(len(zero))
    free = np.ones(n, bool)
    free[place] = False
    order[place], order[free] = zero, sampled
    out = np.empty(n, np.int64)
    out[order] = np.arange(1, n + 1)
    return out


def repeated_starts(texts: list[bytes], firsts: list[tuple[int, int]], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, which of its starts hold a string that a text or start before it holds as well.

    ``firsts`` has document and start of each text's first byte; that is what "before" compares.
    """
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes + 1) - sizes - 1
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    symbols = data.astype(np.int64) + 2
    symbols[begins + sizes] = 1
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    within = np.arange(len(data)) - begins[owner]
    order = suffix_order(symbols, length)
    order = order[within[order] + length <= sizes[owner[order]]]
    equal = np.zeros(len(order), bool)
    for k in range(1, len(order), 1 << 14):
        a, b = order[k - 1 : k - 1 + (1 << 14)], order[k : k + (1 << 14)]
        a = a[: len(b)]
        same = np.ones(len(b), bool)
        for j in range(0, length, 20):
            left = np.flatnonzero(same)
            steps = np.arange(j, min(j + 20, length))
            same[left] = (data[a[left, None] + steps] == data[b[left, None] + steps]).all(axis=1)
        equal[k : k + len(b)] = same
    group = np.cumsum(~equal)
    documents, starts = np.array([f[0] for f in firsts])[owner[order]], np.array([f[1] for f in firsts])[owner[order]] + within[order]
    by_age = np.lexsort((starts, documents, group))
    first = np.concatenate([[True], group[by_age][1:] != group[by_age][:-1]]) if len(by_age) else np.zeros(0, bool)
    out = [np.zeros(max(0, n - length + 1), bool) for n in sizes]
    flat = np.zeros(len(data), bool)
    flat[order[by_age[~first]]] = True
    for n, t in enumerate(out):
        t[:] = flat[begins[n] : begins[n] + len(t)]
    return out


def _folded(columns: list[np.ndarray], doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by ``columns``, then age, without rows that repeat one, and which rows in it are the first of theirs."""
    order = np.lexsort((place, doc, *columns[::-1]))
    first, same = np.ones(len(order), bool), np.zeros(len(order), bool)
    if len(order):
        first[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
        same[1:] = ~first[1:] & (doc[order][1:] == doc[order][:-1]) & (place[order][1:] == place[order][:-1])
    return order[~same], first[~same]


def _joined(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of blocks, those that follow each other in one text as one; 64 starts begin a new one."""
    key, begin = place & (1 << KEY_BITS) - 1, place >> STARTS_BITS + KEY_BITS
    order = np.lexsort((begin, key, doc))
    doc, key, begin = doc[order], key[order], begin[order]
    end = begin + (place[order] >> KEY_BITS & (1 << STARTS_BITS) - 1)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (begin[1:] != end[:-1]) | (begin[1:] >> 6 != begin[:-1] >> 6)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], _place(begin[first], end[last] - begin[first], key[first])


LISTED = "gone boolean, hot boolean, seed long, body long, doc long, place long"


def _list(length: int, hot_seeds: np.ndarray):
    """Step 1: neighbourhoods of a batch; those that repeat one of the batch are gone at once."""
    schema = pa.schema([("gone", pa.bool_()), ("hot", pa.bool_()), ("seed", pa.int64()), ("body", pa.int64()), ("doc", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seed, body, doc, place = [], [], [], []
            for doc_id, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2))):
                for start, starts, _, hashes in neighbourhoods(text, length):
                    seed.append(hashes)
                    ends = (start + starts + length - 1).tolist()
                    body.append(np.array([xxh64_intdigest(text[x:y]) for x, y in zip(start.tolist(), ends)], np.uint64).view(np.int64))
                    doc.append(np.full(len(start), doc_id, np.int64))
                    place.append(_place(start.astype(np.int64), starts, key))
            if not seed:
                continue
            seed, body, doc, place = (np.concatenate(c) for c in (seed, body, doc, place))
            order, first = _folded([seed, body], doc, place)
            seed = np.where(first, seed[order], 0)
            hot = first & np.isin(seed, hot_seeds)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (~first, hot, seed, body[order], doc[order], place[order])], schema=schema)

    return run


def _hot_seeds(docs: DataFrame, length: int) -> np.ndarray:
    """Seeds with many distinct neighbourhoods in a sample of the documents, the most frequent ones."""
    sample = docs.filter(F.pmod(F.xxhash64("doc", "key"), F.lit(SAMPLE)) == 0).select("doc", "key", "text")
    listed = sample.mapInArrow(_list(length, np.zeros(0, np.int64)), LISTED).filter("NOT gone")
    per_seed = listed.select("seed", "body").distinct().groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    top = per_seed.filter(F.col("n") > MANY // SAMPLE).orderBy(F.desc("n"), "seed").limit(SAMPLED_SEEDS)
    return np.array([r["seed"] for r in top.collect()], np.int64)


FOUND = "again boolean, hot boolean, doc long, place long"


def _by_seed():
    """Step 2, over rows ordered by seed, body and age: what is gone, and what has to be looked at again."""
    schema = pa.schema([("again", pa.bool_()), ("hot", pa.bool_()), ("doc", pa.int64()), ("place", pa.int64())])

    def told(again: bool, hot: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), again)), pa.array(hot), pa.array(doc), pa.array(place)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One seed may go on over batches: its distinct neighbourhoods are put before the next batch. Once they are
        # many they are told, and only the last of them is put there.
        carried, many = [np.zeros(0, bool), *[np.zeros(0, np.int64)] * 4], False
        for b in batches:
            gone, *columns = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            if gone.any():
                yield told(False, np.zeros(gone.sum(), bool), *(c[gone] for c in columns[-2:]))
                columns = [c[~gone] for c in columns]
            if not len(columns[0]):
                continue
            hot, seed, body, doc, place = (np.concatenate(x) for x in zip(carried, columns))
            new_seed = np.concatenate([[True], seed[1:] != seed[:-1]])
            new_body = new_seed | np.concatenate([[True], body[1:] != body[:-1]])
            copy = ~new_body
            copy[1:] &= (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
            yield told(False, np.zeros(copy.sum(), bool), doc[copy], place[copy])
            # A distinct neighbourhood is looked at again if its seed has another one.
            heads = np.flatnonzero(new_body)
            nth = np.cumsum(new_seed[heads]) - 1
            count = np.bincount(nth)
            large = count > MANY
            large[0] |= many
            hot_head = hot[heads] | large[nth]
            tell = hot_head | ((count > 1)[nth] & (nth < nth[-1]))
            if many:
                tell[0] = False
            yield told(True, hot_head[tell], doc[heads[tell]], place[heads[tell]])
            many = bool(hot_head[-1])
            on = heads[-1:] if many else heads[nth == nth[-1]]
            carried = [c[on] for c in (hot, seed, body, doc, place)]
        if not many and len(carried[0]) > 1:
            yield told(True, carried[0], *carried[-2:])

    return run


BLOCKS = "gone boolean, shared long, body long, doc long, place long, bytes binary"


def _cut(length: int):
    """Step 3: blocks of the neighbourhoods of each document, folded within the batch."""
    schema = pa.schema([("gone", pa.bool_()), ("shared", pa.int64()), ("body", pa.int64()), ("doc", pa.int64()), ("place", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shared, body, doc, place, held = [], [], [], [], []
            for doc_id, key, text, places, hot in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2)), b.column(3), b.column(4)):
                wanted = np.unique(places.values.to_numpy() >> STARTS_BITS + KEY_BITS)
                singly = set((hot.values.to_numpy() >> STARTS_BITS + KEY_BITS).tolist())
                for start, starts, seed, _ in neighbourhoods(text, length):
                    chosen = np.isin(start, wanted)
                    for at, n, p in zip(start[chosen].tolist(), starts[chosen].tolist(), seed[chosen].tolist()):
                        if at in singly:
                            for x in range(at, at + n):
                                shared.append(_signed(xxh64_intdigest(text[x : x + length], p - x)))
                                place.append((x << STARTS_BITS + KEY_BITS) | (1 << KEY_BITS) | key)
                            body.extend([0] * n)
                            doc.extend([doc_id] * n)
                            held.extend([None] * n)
                            continue
                        # Cut by distance to the seed, which equal strings share; the strings of a block have all
                        # but the outermost bytes in common.
                        cuts = sorted({0, n, *range((p - at + 1) % BLOCK, n, BLOCK)})
                        for x, y in zip(cuts, cuts[1:]):
                            near = (p - at - x) // BLOCK * BLOCK
                            block = text[at + x : at + y + length - 1]
                            shared.append(_signed(xxh64_intdigest(text[p - near : p - near + length - BLOCK + 1], near)))
                            body.append(_signed(xxh64_intdigest(block)))
                            doc.append(doc_id)
                            place.append((at + x << STARTS_BITS + KEY_BITS) | (y - x << KEY_BITS) | key)
                            held.append(block)
            if not doc:
                continue
            columns = [np.array(c, np.int64) for c in (shared, body, doc, place)]
            order, first = _folded(columns[:2], *columns[2:])
            late_doc, late_place = _joined(columns[2][order[~first]], columns[3][order[~first]])
            gone = np.repeat([True, False], [len(late_doc), first.sum()])
            columns = [np.concatenate([late, c[order[first]]]) for late, c in zip((np.zeros_like(late_doc), np.zeros_like(late_doc), late_doc, late_place), columns)]
            kept = [None] * len(late_doc) + [held[k] for k in order[first].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(gone), *[pa.array(c) for c in columns], pa.array(kept, pa.binary())], schema=schema)

    return run


def _by_block(length: int):
    """Step 4, over blocks ordered by shared bytes, body and age: the starts that are gone."""
    schema = pa.schema([("doc", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone_doc: list[int] = []
        gone_place: list[int] = []
        group: list[tuple[int, int, bytes]] = []  # first copies of the distinct blocks of one group
        batch: list[list[tuple[int, int, bytes]]] = []
        held, last = 0, (None, None)

        def sort() -> None:
            """Suffix-sort the groups that wait; groups cannot match each other, so they share one text."""
            blocks = [x for g in batch for x in g]
            firsts = [(d, p >> STARTS_BITS + KEY_BITS) for d, p, _ in blocks]
            for (d, p, _), found in zip(blocks, repeated_starts([t for *_, t in blocks], firsts, length)):
                begin, key = p >> STARTS_BITS + KEY_BITS, p & (1 << KEY_BITS) - 1
                edges = np.flatnonzero(np.diff(np.concatenate([[False], found, [False]]).astype(np.int8)))
                for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    gone_doc.append(d)
                    gone_place.append((begin + x << STARTS_BITS + KEY_BITS) | (y - x << KEY_BITS) | key)

        def close() -> None:
            nonlocal held
            if len(group) > 1:
                batch.append(list(group))
                held += sum(len(t) for *_, t in group)
            group.clear()

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(gone_doc, pa.int64()), pa.array(gone_place, pa.int64())], schema=schema)
            gone_doc.clear()
            gone_place.clear()
            return out

        for b in batches:
            gone, shared, body, doc, place = (b.column(k).to_pylist() for k in range(5))
            for n in range(b.num_rows):
                if gone[n]:
                    gone_doc.append(doc[n])
                    gone_place.append(place[n])
                    continue
                if (shared[n], body[n]) == last:
                    gone_doc.append(doc[n])
                    gone_place.append(place[n])
                    continue
                if shared[n] != last[0]:
                    close()
                    if held >= SORT_BYTES:
                        sort()
                        batch.clear()
                        held = 0
                last = (shared[n], body[n])
                group.append((doc[n], place[n], b.column(5)[n].as_py()))
            if gone_doc:
                yield told()
        close()
        if batch:
            sort()
        yield told()

    return run


def _apply(length: int):
    """Result row of each document from the places of its repeated strings."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, text, places in zip(b.column(0).to_pylist(), texts_of(b.column(1)), b.column(2)):
                from_to: list[int] = []
                if places.is_valid:
                    found = np.sort(places.values.to_numpy())
                    begin = found >> STARTS_BITS + KEY_BITS
                    end = np.maximum.accumulate(begin + (found >> KEY_BITS & (1 << STARTS_BITS) - 1) + length - 1)
                    cuts = np.flatnonzero(begin[1:] > end[:-1]) + 1
                    lows, highs = begin[np.concatenate([[0], cuts])], end[np.concatenate([cuts - 1, [len(end) - 1]])]
                    from_to = np.stack([lows, highs], axis=1).ravel().tolist()
                sha, at = hashlib.sha256(), 0
                for low, high in zip(from_to[::2], from_to[1::2]):
                    sha.update(text[at:low])
                    at = high
                sha.update(text[at:])
                removed = sum(from_to[1::2]) - sum(from_to[::2])
                out.append((doc_id, len(text), removed, len(from_to) // 2, sha.hexdigest(), from_to))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema)], schema=schema)

    return run


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    Every byte covered by a string of ``length`` bytes that also starts earlier (smaller id, or same document and
    earlier start) is removed; strings are judged on the input and never cross documents. ``spans`` has begin and
    end of the maximal removed runs. A null text is empty; texts shorter than ``length`` lose nothing. Rows with a
    null id come after all others, in an order of their own, and rows that repeat an id, or have none, with the same
    text are one document: both lose the same bytes. Texts that share an id are told apart by 22 bits of their hash.
    Ids are below 2^62. An empty table gives an empty one.
    """
    if not GRAM < length <= GRAM + (1 << STARTS_BITS) - BLOCK:
        raise ValueError(f"strings need more than {GRAM} and at most {GRAM + (1 << STARTS_BITS) - BLOCK} bytes")
    spark = df.sparkSession
    docs = id_and_text(df, id_col, text_col).select(_number().alias("doc"), _text_key().alias("key"), "text", "doc_id")
    with tidy_shuffles(spark):
        listed = docs.select("doc", "key", "text").mapInArrow(_list(length, _hot_seeds(docs, length)), LISTED)
        # Rows that are gone go to any task; the others meet by seed, those of a hot seed by neighbourhood.
        dealt = listed.repartition(F.when(F.col("gone"), F.xxhash64("doc", "place")).when(F.col("hot"), F.col("body")).otherwise(F.col("seed")))
        found, found_path = stage(dealt.sortWithinPartitions("seed", "body", "doc", "place").mapInArrow(_by_seed(), FOUND), "suffix-seeds")
        key = F.col("place").bitwiseAND(F.lit((1 << KEY_BITS) - 1))
        again = found.filter("again").groupBy("doc", key.alias("key")).agg(F.collect_list("place").alias("places"), F.collect_list(F.when(F.col("hot"), F.col("place"))).alias("hot"))
        once = docs.select("doc", "key", "text").join(again, ["doc", "key"]).dropDuplicates(["doc", "key"])
        blocks = once.select("doc", "key", "text", "places", "hot").mapInArrow(_cut(length), BLOCKS)
        met = blocks.repartition(F.when(F.col("gone"), F.xxhash64("doc", "place")).otherwise(F.col("shared")))
        met = met.sortWithinPartitions("shared", "body", "doc", "place").select("gone", "shared", "body", "doc", "place", "bytes")
        late, late_path = stage(met.mapInArrow(_by_block(length), "doc long, place long"), "suffix-blocks")
        gone = found.filter("NOT again").select("doc", "place").union(late)
        per_doc, _ = stage(gone.groupBy("doc", key.alias("key")).agg(F.collect_list("place").alias("places")), "suffix-places")
        remove(spark, found_path, late_path)
    judged = docs.join(per_doc, ["doc", "key"], "left").select("doc_id", "text", "places")
    return judged.mapInArrow(_apply(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
