"""Plain Python versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import re

from xxhash import xxh64_intdigest

ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text: str | None, size: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    if not words:
        return 0
    hashes = [xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(max(1, len(words) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps: dict[int, int], bits: int = 3) -> dict[int, int]:
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in fps}


def without_repeats(rows: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple[int, int, int, str]]:
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(max(0, len(data) - length + 1)):
            part = data[k : k + length]
            if part in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(part)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def secrets(text: str | None) -> list[tuple[int, int, str, int]]:
    kinds = (("assign", ASSIGN, 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16))
    found = []
    for rank, (kind, pattern, group, least) in enumerate(kinds):
        found += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(found)


def contamination(text: str | None, items: dict, size: int = 10) -> tuple[int, int, list[str]]:
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words, hit, names = word.findall(lower_ascii(text or "")), set(), set()
    for item, of in items.items():
        w = word.findall(lower_ascii(of or ""))
        n = min(size, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                names.add(str(item))
    return len(words), len(hit), sorted(names)
