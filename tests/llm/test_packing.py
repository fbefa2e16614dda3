"""Token packing: every id once, no padding but at powers of two, the ids of the tokenizer's file."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from stratalake.llm import packing

TOKENIZER, RANKS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(TOKENIZER, RANKS)


def reference(encoder, text):
    return encoder.file.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_file(encoder):
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "don't", "It's", "é", "ß", "ñ12", "...", "漢字", "<|endoftext|>", "\x1c", " ", "\x85", "12 34", "ſ", "ǅ", "𝄞", "'s", " 's"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    texts += [" ".join(rng.choice(["and", "ünd", "le,", "x.\ny", "a-b"]) for _ in range(50)) for _ in range(50)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == reference(encoder, text), text


def test_forgetting_changes_nothing(monkeypatch):
    small = packing.Encoder(TOKENIZER, RANKS)
    monkeypatch.setattr(packing.Encoder, "REMEMBERED", 20)
    for k in range(5):
        texts = [" ".join(f"w{k}{i}{j}" for j in range(9)) for i in range(6)]
        assert [x.tolist() for x in small.encode(texts)] == [reference(small, t) for t in texts]


def test_closest_multiset_is_the_closest():
    rng = random.Random(2)
    for _ in range(300):
        lengths = Counter(rng.randint(1, 30) for _ in range(rng.randint(0, 8)))
        capacity = rng.randint(1, 40)
        sums = {0}
        for n, c in lengths.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        counts = packing.closest_multiset(lengths, capacity)
        assert all(counts[n] <= lengths[n] for n in counts)
        assert sum(n * c for n, c in counts.items()) == max(s for s in sums if s <= capacity)


def test_every_waiting_length_is_offered_before_a_cut():
    packer = packing.Packer(1024)
    lengths = [*range(600, 1001), 24, 30]
    for document, n in enumerate(lengths):
        assert list(packer.add(document, n)) == []
    windows = packer.windows()
    for _ in range(2):
        placed = [next(windows), next(windows)]
        assert sum(length for _, _, length, _, _ in placed) == 1024
        assert all(start == 0 and length == lengths[document] for document, start, length, _, _ in placed)


def check(rows, made, encoder):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == {i for i, _ in made}
    for i, text in made:
        ids, at = np.array([*reference(encoder, text), 0], "<u4"), 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY and at & (at - 1) == 0
    return Counter(sum(r["length"] for r in p) for p in by_sequence.values())


def test_every_id_lies_in_one_piece(docs, encoder):
    rng = random.Random(3)
    made = [(i, " ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.choice([0, 3, 300, 900, 5000])))) for i in range(120)]
    made += [(200, None), (201, ""), (202, "<|endoftext|> x"), (203, "word " * 60_000)]
    sizes = check(packing.pack(docs(*made), TOKENIZER, RANKS, block_documents=32).collect(), made, encoder)
    assert sum(sizes.values()) - sizes[packing.CAPACITY] <= 8 * 10


def test_packing_without_ranks_gives_the_same_ids(docs, encoder):
    made = [(i, f"some words {i} here") for i in range(20)]
    check(packing.pack(docs(*made), TOKENIZER).collect(), made, encoder)


def test_packing_of_odd_rows(docs):
    assert packing.pack(docs(), TOKENIZER, RANKS).collect() == []
    rows = packing.pack(docs((None, "a"), (1, "b"), (1, "b")), TOKENIZER, RANKS).collect()
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in rows if r["start"] == 0) == [("1", 2), ("1", 2), ("None", 2)]
