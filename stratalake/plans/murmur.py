"""Standard SQL for Spark's ``hash``, so that the SQL of a query can recompute keys and masks drawn from it."""

from __future__ import annotations

# Constants of 32-bit Murmur3, and the seed that Spark starts from.
BLOCK_FACTORS = (0xCC9E2D51, 0x1B873593)
ROUND_ADD = 0xE6546B64
FINAL_FACTORS = (0x85EBCA6B, 0xC2B2AE35)
START = 42

WORD = 1 << 32


def _rotated(x: str, bits: int) -> str:
    return f"(({x}) * {1 << bits} % {WORD} + ({x}) // {WORD >> bits})"


def hash_sql(source: str, text: str, name: str, seed: str = str(START)) -> str:
    """SQL for the rows of ``source`` with ``name``: the unsigned hash of an ASCII ``text``.

    Four characters make a block; those left over are blocks of their own, which is where Spark differs from the
    published algorithm. The hash of several columns is that of the last one, seeded with the hash of those before.
    """
    whole = " + ".join(f"ord(_t[4 * i + {b + 1}])::UBIGINT * {256**b}" for b in range(4))
    blocks = f"list_transform(range(len(_t) // 4), lambda i: {whole})"
    rest = "list_transform(range(len(_t) // 4 * 4, len(_t)), lambda i: ord(_t[i + 1])::UBIGINT)"
    first, second = BLOCK_FACTORS
    block = f"{_rotated(f'k * {first} % {WORD}', 15)} * {second} % {WORD}"
    mixed = f"list_transform(list_concat({blocks}, {rest}), lambda k: {block})"
    step = f"({_rotated('xor(h, k)', 13)} * 5 + {ROUND_ADD}) % {WORD}"
    out = f"SELECT *, list_reduce(list_prepend(({seed})::UBIGINT, {mixed}), lambda h, k: {step}) AS _h FROM (SELECT *, {text} AS _t FROM ({source}))"
    out = f"SELECT * REPLACE (xor(_h, len(_t)::UBIGINT) AS _h) FROM ({out})"
    for shift, factor in zip((16, 13, 16), (*FINAL_FACTORS, 1)):
        out = f"SELECT * REPLACE (xor(_h, _h // {1 << shift}) * {factor} % {WORD} AS _h) FROM ({out})"
    return f"SELECT * EXCLUDE (_t, _h), _h AS {name} FROM ({out})"


def magnitude_sql(name: str) -> str:
    """Absolute value of the unsigned hash read as a signed number."""
    return f"(CASE WHEN {name} < {WORD // 2} THEN {name}::BIGINT ELSE {WORD} - {name}::BIGINT END)"
