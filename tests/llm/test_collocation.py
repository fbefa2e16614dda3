"""Phrase counts, scores and ranks against a plain version; chunks give each occurrence once."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import collocation
from tests.llm.brute import lower_ascii


def plain(rows, min_count, limit, percent=100, most=5):
    """``lang, rank, phrase, a, l, r, n, score`` from ``(lang, text)``."""
    f, out = {}, []
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", lower_ascii(text or "")):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for n in range(1, most + 1):
                f.setdefault(lang or "und", Counter()).update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    for lang, of in f.items():
        n = sum(c for p, c in of.items() if len(p) == 1)
        frequent = {p: a for p, a in of.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in frequent.items():
            score, k = min((1000 * a * n // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in frequent.items())
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(t, g, "x") for g, t in rows], "text string, lang string, phrase string")
    return sorted(map(tuple, collocation.mine(df, **more).collect()))


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "Straße", "a", "New", "York", "city", "naïve", "x1", "日本", "it's", "\x1c", "Ünd"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts.append(rng.choice(words) if rng.random() < 0.8 else rng.choice(["New York City hall is", "of the of the of"]))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\r\n"]))
        out.append("".join(parts))
    return out


@pytest.mark.parametrize(("modulus", "percent"), [(1, 100), (3, 100), (64, 60)])
def test_phrases_equal_the_plain_version(spark, modulus, percent):
    made = texts(1, 60)
    rows = [("en", t) for t in made] + [(None, t) for t in made[:20]] + [("de", t) for t in texts(2, 20)] + [("en", made[0])] * 5
    got = mined(spark, rows, min_count=8, limit=40, modulus=modulus, contained_percent=percent)
    assert got == plain(rows, 8, 40, percent)
    assert len(got) >= 40  # the fixture holds phrases of every kind


def test_flushing_and_a_full_filter_change_nothing(spark, monkeypatch):
    rows = [("en", t) for t in texts(3, 40)]
    want = plain(rows, 5, 2000)
    everything = collocation.Filter(collocation.LEAST_BITS, [(0, b"\xff" * (collocation.BITMAP // 8))])
    monkeypatch.setattr(collocation.Filter, "of", classmethod(lambda cls, hashes, count: everything))
    monkeypatch.setattr(collocation, "TOKENS", 50)
    assert mined(spark, rows, min_count=5) == want


def test_a_filter_holds_what_was_put_in(spark):
    phrases = [f"w{i} é{i}" for i in range(3000)]
    df = spark.createDataFrame([("en", p) for p in phrases], "lang string, phrase string").select(collocation._word_hash())
    built = collocation.Filter.of(df, 3000)
    assert built.has(collocation._word_hashes("en", [p.encode() for p in phrases])).all()
    assert built.has(collocation._word_hashes("de", [p.encode() for p in phrases])).mean() < 0.1
    assert not collocation.Filter.of(df.limit(0), 0).has(collocation._word_hashes("en", [b"a"])).any()


@pytest.mark.parametrize("min_count", [7, 300])
def test_hashes_of_pairs_are_those_of_the_frequent_ones(spark, min_count):
    made = texts(6, 300)
    f = Counter()
    for text in made:
        for piece in re.split(r"[.,;:!?\n-\r]", lower_ascii(text)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            f.update(zip(words, words[1:]))
    df = spark.createDataFrame([("en", t) for t in made], "lang string, text string").repartition(5)
    dictionary = collocation.parse(df, 4, 8).groupBy("lang", "chunk", "last").agg(F.sum("n").alias("n"))
    everything = collocation.Filter(collocation.LEAST_BITS, [(0, b"\xff" * (collocation.BITMAP // 8))])
    key = collocation._PairKey(10**9)
    found = {r["h"] for r in collocation.frequent_pairs(dictionary, min_count, 4, everything, key).collect()}
    want = set()
    for (a, b), n in f.items():
        chunks = collocation._Chunks("en", [([a.encode(), b.encode()], True, 1)], 4, everything)
        chunks.longer(2)
        if n >= min_count:
            want.update(key.whole(key.split(chunks.pair_hashes())).view(np.int64).tolist())
    assert found == want and want


def test_chunks_overlap_by_a_window_and_cover_all():
    rng = np.random.default_rng(4)
    for n in [*range(12), 400]:
        ends = collocation.chunk_ends(rng.integers(0, 9, n).astype(np.uint64), 4, 3).tolist()
        assert ends[-1] == n and ends == sorted(set(ends)) and all(e > 4 for e in ends[:-1])


def test_odd_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, None), ("en", ""), ("en", " .,\n"), (None, "word")], min_count=1) == []
    long = " ".join(["very"] * 30_000)
    assert mined(spark, [("en", long)], min_count=2) == plain([("en", long)], 2, 2000)


def test_scores_are_exact_beyond_63_bits(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        a = rng.randint(100, 10 ** rng.randint(3, 13))
        rows.append((a, a * rng.randint(2, 10**4), a * rng.randint(1, 50) + rng.randint(0, 9), a + rng.randint(0, 10**12)))
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    for r in df.select("*", collocation.lift(*map(F.col, "anlr")).alias("score")).collect():
        assert r["score"] == 1000 * r["a"] * r["n"] // (r["l"] * r["r"])
