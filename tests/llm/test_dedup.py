"""Exact, suffix and SimHash dedup against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import exact, simhash, suffix
from stratalake.llm.components import components
from tests.llm import brute


def test_exact_groups(docs):
    made = [(i, t) for i, t in enumerate(["a", "b", "a", "", None, "a ", "b", "é" * 70_000, "é" * 70_000, "x"])]
    found = {r["doc_id"]: r for r in exact.duplicates(docs(*made)).collect()}
    by_text = {}
    for i, t in made:
        by_text.setdefault(t or "", []).append(i)
    for i, t in made:
        group = by_text[t or ""]
        r = found[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(group), len(group), i == max(group))
        assert r["text_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_exact_with_null_and_repeated_ids(docs):
    rows = exact.duplicates(docs((None, "n"), (None, "n"), (None, "a"), (7, "a"), (7, "a"), (7, "b"))).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows) == Counter(
        {(None, None, 2, True): 2, (None, 7, 3, False): 1, (7, 7, 3, True): 2, (7, 7, 1, True): 1}
    )
    assert exact.duplicates(docs()).collect() == []


def test_colliding_hashes_are_chained_and_told_apart(docs, monkeypatch):
    index = exact.build_index(docs(*[(i, f"text {i % 50}") for i in range(200)]), bucket_entries=4)[1]
    rows = index.collect()
    assert len({r["entry"] for r in rows}) == 50 and max(r["bucket_depth"] for r in rows) >= 0
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"group": [1, 2, 3], "key": [5, 5, 5], "body": [b"a", b"b", b"a"], "top": [1, 2, 3], "size": [1, 1, 1], "owner": [0, 0, 0]})
    out = list(exact._own(4, 6)(iter([batch])))[0].to_pylist()
    assert [(r["group"], r["chain"], r["entry"]) for r in out] == [(1, 0, "5:0"), (2, 1, "5:1"), (3, 0, "5:0")]


def test_directory_doubles_and_splits():
    directory, rng = exact.Directory(8), random.Random(1)
    keys = [rng.getrandbits(64) for _ in range(1000)] + [rng.getrandbits(40) for _ in range(100)]
    for k in keys:
        directory.insert(k)
    buckets = {id(b): b for b in directory.slots}.values()
    assert sorted(k for b in buckets for k in b["keys"]) == sorted(keys)
    assert max(len(b["keys"]) for b in buckets) <= 8 and len(directory.slots) == 1 << directory.depth
    for k in keys:
        depth, prefix = directory.bucket_of(k)
        assert (k >> 64 - depth if depth else 0) == prefix


def test_many_entries_of_one_hash_do_not_split_for_ever():
    directory = exact.Directory(2)
    for _ in range(10):
        directory.insert(123)
    assert directory.depth <= 64 and sum(len(b["keys"]) for b in {id(b): b for b in directory.slots}.values()) == 10


def test_suffix_order_is_that_of_sorted_suffixes():
    rng = random.Random(3)
    for _ in range(150):
        s = np.array([rng.randint(1, rng.choice([1, 2, 4, 20])) for _ in range(rng.randint(0, 50))], np.int64)
        assert suffix.suffix_order(s, 10**6).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        depth = rng.randint(1, 20)
        parts = [tuple(s[i : i + depth]) for i in suffix.suffix_order(s, depth)]
        assert parts == sorted(parts)


def repeats(df, **kw):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.dedup(df, **kw).collect()}


def test_suffix_dedup_equals_brute_force(docs, monkeypatch):
    monkeypatch.setattr(suffix, "SORT_BYTES", 5000)
    rng = random.Random(11)
    words = [f"{rng.choice('abcdeé')}{k}" for k in range(400)]
    passages = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(6)]
    made = []
    for i in range(150):
        p = rng.choice(passages)
        a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) + p[a:b] + " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))
        made.append((i, text))
    made += [(200, "ab" * 300), (201, "ab" * 80), (202, "a" * 99), (203, "a" * 100), (204, "a" * 350), (205, ""), (206, None), (207, passages[0]), (208, passages[0])]
    assert repeats(docs(*made)) == brute.without_repeats(made)


@pytest.mark.parametrize("sample", [1, 1 << 40])
def test_suffix_passage_with_other_text_around_it_in_most_rows(docs, monkeypatch, sample):
    plain = suffix.repeated_starts

    def bounded(texts, firsts, length):
        assert len(texts) <= 12, "a task sorts one group of blocks per row"
        return plain(texts, firsts, length)

    monkeypatch.setattr(suffix, "repeated_starts", bounded)
    monkeypatch.setattr(suffix, "SORT_BYTES", 1)
    monkeypatch.setattr(suffix, "MANY", 12, raising=False)
    monkeypatch.setattr(suffix, "SAMPLE", sample, raising=False)
    rng = random.Random(13)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, rare = letters(180), letters(130)
    made = [(i, letters(rng.randint(0, 150)) + (passage if i % 5 else rare if i < 50 else "") + letters(rng.randint(0, 150))) for i in range(140)]
    made += [(None, letters(60) + passage[:140] + letters(60)), (300, passage + passage), (7, made[7][1])]
    want = brute.without_repeats([(10**6 if i is None else i, t) for i, t in made if (i, t) != made[7]] + [made[7]])
    want[None] = want.pop(10**6)
    assert repeats(docs(*made)) == want


def test_suffix_dedup_of_long_texts_read_in_parts(docs, monkeypatch):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdef") for _ in range(9000))
    made = [(1, long), (2, "x" + long[:4100] + "y" + long[4000:]), (3, long[100:300] * 20)]
    assert repeats(docs(*made)) == brute.without_repeats(made)


def test_suffix_dedup_of_odd_rows(docs):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdef") for _ in range(250))
    rows = [(r["doc_id"], r["n_removed"]) for r in suffix.dedup(docs((None, text), (5, text), (5, text), (9, text), (9, "short"))).collect()]
    assert Counter(rows) == Counter({(None, 250): 1, (5, 0): 2, (9, 250): 1, (9, 0): 1})
    assert repeats(docs()) == {}


def near(df):
    return sorted(((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.groups(df).collect()), key=repr)


def test_simhash_equals_brute_force(docs):
    rng = random.Random(6)
    base = [" ".join(f"w{rng.randint(0, 300)}" for _ in range(200)) for _ in range(8)]
    made = []
    for i in range(160):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "NEW"
        made.append((i, " ".join(words)))
    made += [(500, ""), (501, None), (502, "one two"), (503, "ONE\ttwo\n"), (504, "É é x")]
    fps = {i: brute.fingerprint(t) for i, t in made}
    roots = brute.components(fps)
    assert near(docs(*made)) == sorted(((i, fps[i], roots[i]) for i, _ in made), key=repr)


@pytest.mark.parametrize("bits", [1, 3])
def test_links_of_any_fingerprints(spark, bits):
    rng = np.random.default_rng(bits)
    centres = rng.integers(0, 1 << 62, 12)
    made = {int(c ^ sum(1 << int(b) for b in rng.integers(0, 62, rng.integers(0, 5)))) for c in centres for _ in range(25)}
    fps = {v: v for v in made}
    links = simhash.links(spark.createDataFrame([(v,) for v in made], "fp long"), bits)
    roots = {v: v for v in made} | {r["node"]: r["root"] for r in components(links).collect()}
    want = brute.components(fps, bits)
    assert {v: roots[v] for v in made} == want


def test_a_large_entry_is_walked_by_bit_flips():
    rng = np.random.default_rng(5)
    group = np.unique(rng.integers(0, 1 << 24, 60_000).astype(np.uint64))
    got = set()
    for i, j in simhash._pairs(group, 1):
        got |= {(min(a, b), max(a, b)) for a, b in zip(group[i].tolist(), group[j].tolist())}
    there = set(group.tolist())
    assert got == {(x, x ^ 1 << b) if x < x ^ 1 << b else (x ^ 1 << b, x) for x in there for b in range(24) if x ^ 1 << b in there}


def test_one_of_each_group_stays(docs):
    made = docs((3, "a b c d"), (1, "a b c d"), (2, "other words stand here"), (None, "a b c d"), (4, None), (5, ""))
    kept = simhash.keep_one(made)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4] and kept.columns == made.columns
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs((1, "x y z"), (1, "x y z"))).collect()) == [1]
    assert simhash.keep_one(docs()).count() == 0
    assert simhash.keep_one(docs((None, "x"), (None, "x"))).count() == 1


def test_one_of_each_group_stays_where_ids_are_missing_or_repeated(docs):
    rng = random.Random(21)
    texts = [" ".join(f"t{k}w{rng.randint(0, 10**6)}" for _ in range(60)) for k in range(6)]
    # Groups 0 to 2 have no id; 3 and 4 share id 7; a copy of 3 has no id; 5 has ids 7 and 6, so its 7 goes.
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (None, texts[3]), (7, texts[4]), (7, texts[5]), (6, texts[5])]
    want = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (6, texts[5])]
    kept = [(r["doc_id"], r["text"]) for r in simhash.keep_one(docs(*rows)).collect()]
    assert Counter(kept) == Counter(want)
    by_source = docs(*[(1, texts[0], f"s{k}") for k in range(5)]).repartition(5)
    assert len({simhash.keep_one(by_source.repartition(n)).collect()[0]["source"] for n in (1, 3)}) == 1


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 400)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(path + star + [(9, 9)], "u long, v long")).collect()}
    assert found == {i: 100 for i in range(101, 161)} | {i: 7 for i in range(200, 400)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_many_rows_without_an_id_keep_their_own_bytes(docs):
    rng = random.Random(11)
    passage = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(150))
    made = [(None, f"{i:08d} " + (passage if i % 2 else "")) for i in range(20_000)] + [(7, f"only one {passage}")]
    rows = suffix.dedup(docs(*made)).select("n_bytes", "n_removed", F.col("doc_id").isNull().alias("none")).collect()
    assert len(rows) == 20_001
    assert [r["n_removed"] for r in rows if not r["none"]] == [0]
    removed = sorted(r["n_removed"] for r in rows if r["none"])
    # The blank and equal digits before the passage may go with it.
    assert removed[:10_000] == [0] * 10_000 and 150 <= removed[10_000] and removed[-1] < 160
