"""Groups, links and their counts against a plain reading of both tokenizers."""

from __future__ import annotations

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from stratalake.llm import align

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]
ODD = [" ", "  ", "\n", "\t", "a", "don't", "It's", "é", "ß", "ñ12", "...", "漢字", "<|endoftext|>", "<s>", "</s>", "\x1c", "\x85", "▁", "12 34", "𝄞", "'s", "\0", "<0x0A>", "ﬁ"]


@pytest.fixture(scope="module")
def encoder():
    return align.Encoder(*FILES)


def whole(encoder, text):
    """Ids of the files themselves, each with the byte behind its last."""
    data = b" " + (text or "").encode()
    sides = encoder.file.encode(" " + (text or ""), add_special_tokens=False).ids, encoder.model.encode(text or "")
    if not text or any(v.joined(ids) != data for v, ids in zip((encoder.a, encoder.b), sides)):
        return [], []
    return [list(zip(ids, np.cumsum([len(v.tokens[i]) for i in ids]).tolist())) for v, ids in zip((encoder.a, encoder.b), sides)]


def plain(encoder, rows):
    links, out = {}, []
    for n, (_, text) in enumerate(rows):
        a, b = whole(encoder, text)
        token_b = {e: t for t, e in b}
        links[n] = [(x, token_b[e]) for x, e in a if e in token_b]
    counts = Counter(p for ps in links.values() for p in ps)
    most = Counter()
    for (_, y), c in counts.items():
        most[y] = max(most[y], c)
    for n, (doc_id, text) in enumerate(rows):
        a, b = whole(encoder, text)
        shared = sorted({e for _, e in a} & {e for _, e in b})
        sides = []
        for side in (a, b):
            group: dict[int, list[str]] = {}
            for t, e in side:
                group.setdefault(shared[bisect.bisect_left(shared, e)], []).append(str(t))
            sides.append(group)
        parts = ["|".join(",".join(side[e]) for side in sides) for e in shared]
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        out.append((doc_id, len(a), len(b), len(parts), len(links[n]), sum(counts[p] == most[p[1]] for p in links[n]), sum(counts[p] for p in links[n]), digest))
    return sorted(out, key=repr)


def test_ids_are_those_of_the_files(encoder):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    texts += [" ".join(rng.choice(["and", "ünd", "le,", "x.\ny", "a-b", "Ɏ", "12,5"]) for _ in range(50)) for _ in range(50)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert [x.tolist() for x in ids] == [[i for i, _ in side] for side in whole(encoder, text)], text


def test_digests_equal_the_plain_version(spark, docs, encoder):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["Thorough", "naïve", "123456", "New-York,", "ouèan", "a.b"]) for _ in range(rng.randint(1, 80)))) for i in range(60)]
    rows += [(100 + i, "".join(rng.choice(ODD) for _ in range(9))) for i in range(60)]
    rows += [(200, None), (201, ""), (None, "no id"), (5, "same id"), (5, "same id"), (202, "word " * 30_000), (203, "漢字" * 3000), (204, " x")]
    packed = align.pack_groups(docs(*rows), *FILES)
    got = align.digests(packed, align.pair_counts(packed)).collect()
    assert sorted(map(tuple, got), key=repr) == plain(encoder, rows)


def test_no_rows(docs):
    packed = align.pack_groups(docs(), *FILES)
    assert align.digests(packed, align.pair_counts(packed)).collect() == []


def test_aligned_rows_hold_ids_and_group_sizes(docs, encoder):
    rows = [(1, "Thorough naïve work"), (2, None), (3, "12345 a.b")]
    for r in align.align(docs(*rows), *FILES).collect():
        a, b = whole(encoder, dict(rows)[r["doc_id"]])
        assert [r["a_ids"], r["b_ids"]] == [[i for i, _ in side] for side in (a, b)]
        assert sum(r["a_sizes"]) == len(a) and sum(r["b_sizes"]) == len(b) and len(r["a_sizes"]) == len({e for _, e in a} & {e for _, e in b})


def test_division_finds_all_shared_ends():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.02, 0.3, 1.0):
        for n in (1, 2, 3, 50, 3000):
            a = np.cumsum(rng.integers(1, 6, n))
            b = np.union1d(a[rng.random(n) < share], [a[-1], *(rng.integers(1, a[-1] + 1, n))])
            if share == 0.0:
                b = np.union1d(np.setdiff1d(b, a), a[-1:])
            assert align.divide(a, b, np.array([0]), np.array([n])).tolist() == np.flatnonzero(np.isin(a, b)).tolist()


def test_pairs_are_bounded_by_the_vocabularies(encoder):
    assert align.pair_bound(encoder.a, encoder.b) < 1_000_000
