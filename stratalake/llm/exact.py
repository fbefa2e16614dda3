"""Exact duplicates through an extendible-hash index on shared files.

Map tasks fold the equal texts of each Arrow batch into one local group. The groups are dealt to owner tasks by
ranges of the text hash; an owner meets the groups of one hash together, chains those whose bytes differ, and
puts one index entry per distinct text into buckets of bounded size. A full bucket is split on the next bit of
the hash, and the owner's directory doubles when a bucket needs more bits than it has. The index is a table in
the shared folder, so any later job can look texts up by hash, bucket and place in the chain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stratalake.llm.common import id_and_text, stage, texts_of

BUCKET_ENTRIES = 512
BITS = 64
HALF = 1 << BITS - 1
#: Local groups that one owner holds, about; the number of owners follows.
OWNER_GROUPS = 1 << 14


class Directory:
    """Buckets of one owner. The directory has ``2 ** depth`` slots; several may lead to one bucket."""

    def __init__(self, capacity: int, skip_bits: int = 0) -> None:
        self.capacity, self.skip, self.depth = capacity, skip_bits, 0
        self.slots: list[dict] = [{"depth": 0, "prefix": 0, "keys": []}]

    def _slot(self, key: int, depth: int) -> int:
        """The ``depth`` leading bits of the hash below those that choose the owner."""
        return (key << self.skip & (1 << BITS) - 1) >> (BITS - depth) if depth else 0

    def insert(self, key: int) -> None:
        bucket = self.slots[self._slot(key, self.depth)]
        bucket["keys"].append(key)
        while len(bucket["keys"]) > self.capacity and bucket["depth"] < BITS - self.skip and bucket["keys"].count(key) <= self.capacity:
            bucket = self._split(bucket, key)

    def _split(self, bucket: dict, key: int) -> dict:
        if bucket["depth"] == self.depth:
            self.slots = [b for b in self.slots for _ in (0, 1)]
            self.depth += 1
        depth = bucket["depth"] + 1
        halves = [{"depth": depth, "prefix": 2 * bucket["prefix"] + bit, "keys": []} for bit in (0, 1)]
        for k in bucket["keys"]:
            halves[self._slot(k, depth) & 1]["keys"].append(k)
        width = 1 << (self.depth - depth)
        for bit, half in enumerate(halves):
            first = half["prefix"] * width
            self.slots[first : first + width] = [half] * width
        return halves[self._slot(key, depth) & 1]

    def bucket_of(self, key: int) -> tuple[int, int]:
        b = self.slots[self._slot(key, self.depth)]
        return b["depth"], b["prefix"]


LOCAL = "doc_id long, sha string, group long, key long, body binary, top long, size long"
ENTRY = "group long, owner long, bucket_depth int, bucket long, key long, chain int, entry string, top long, size long"


def _local_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with the local group of their text; the first row of a group also carries the text.

    The number of a group is made of the task's row number, which Spark gives, so that a retried task repeats it.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("sha", pa.string()), ("group", pa.int64()), ("key", pa.int64()), ("body", pa.binary()), ("top", pa.int64()), ("size", pa.int64())])
    for b in batches:
        ids, rows = b.column(0).to_pylist(), b.column(2).to_pylist()
        first: dict[bytes, int] = {}  # compares bytes where hashes meet
        shas, groups, bodies, members = [], [], [], []
        for n, text in enumerate(texts_of(b.column(1))):
            at = first.setdefault(text, n)
            new = at == n
            shas.append(hashlib.sha256(text).hexdigest() if new else shas[at])
            groups.append(rows[at])
            bodies.append(text if new else None)
            members.append([])
            members[at].append(ids[n])
        keys = [None if t is None else xxh64_intdigest(t) - HALF for t in bodies]
        tops = [max((i for i in m if i is not None), default=None) if m else None for m in members]
        sizes = [len(m) if m else None for m in members]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((ids, shas, groups, keys, bodies, tops, sizes), schema)], schema=schema)


def _own(bucket_entries: int, owner_bits: int):
    """Task over the groups of some owners, ordered by hash; one owner is in memory at a time, without texts."""
    schema = pa.schema([("group", pa.int64()), ("owner", pa.int64()), ("bucket_depth", pa.int32()), ("bucket", pa.int64()), ("key", pa.int64()), ("chain", pa.int32()), ("entry", pa.string()), ("top", pa.int64()), ("size", pa.int64())])

    def entries(owner: int, directory: Directory, found: list[tuple]) -> pa.RecordBatch:
        places = [directory.bucket_of(key + HALF) for _, key, *_ in found]
        groups, keys, chains, tops, sizes = zip(*found)
        names = [f"{k}:{c}" for k, c in zip(keys, chains)]
        columns = (groups, [owner] * len(found), [d for d, _ in places], [x for _, x in places], keys, chains, names, tops, sizes)
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, chain, at, directory, found = None, {}, None, None, []
        for b in batches:
            groups, keys, tops, sizes, owners = (b.column(c).to_pylist() for c in ("group", "key", "top", "size", "owner"))
            for n, text in enumerate(texts_of(b.column("body"))):
                key = keys[n]
                if owners[n] != at:
                    if found:
                        yield entries(at, directory, found)
                    at, directory, found = owners[n], Directory(bucket_entries, owner_bits), []
                if key != last:
                    chain, last = {}, key
                if text not in chain:  # another text of the same hash goes behind it
                    chain[text] = len(chain)
                    directory.insert(key + HALF)
                found.append((groups[n], key, chain[text], tops[n], sizes[n]))
        if found:
            yield entries(at, directory, found)

    return own


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_entries: int = BUCKET_ENTRIES) -> tuple[DataFrame, DataFrame]:
    """The rows (``doc_id, sha, group``) and the index (one row per local group of an entry), both written tables."""
    numbered = id_and_text(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    local, _ = stage(numbered.mapInArrow(_local_groups, LOCAL), "local-groups")
    groups = local.filter("body is not null").select("group", "key", "body", "top", "size")
    owner_bits = max(6, (groups.count() // OWNER_GROUPS).bit_length())
    owner = F.shiftright("key", BITS - owner_bits) + F.lit(1 << owner_bits - 1)
    owned = groups.withColumn("owner", owner).repartition("owner").sortWithinPartitions("key", "group")
    index, _ = stage(owned.mapInArrow(_own(bucket_entries, owner_bits), ENTRY), "hash-index")
    return local.select("doc_id", "sha", "group"), index


def duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """One row per row of ``df``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are equal when their texts are identical byte for byte; null counts as empty. ``keep_id`` is the largest
    id of the group, null if no row of it has one. Rows that repeat the kept id with the same text are all kept,
    and counted. Empty and very long texts are texts like any other. An empty table gives an empty one.
    """
    rows, index = build_index(df, id_col, text_col, bucket_entries)
    entries = index.groupBy("entry").agg(F.max("top").alias("keep_id"), F.sum("size").alias("group_size"))
    of_group = index.select("group", "entry").join(entries, "entry").select("group", "keep_id", "group_size")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return rows.join(of_group, "group").select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))
