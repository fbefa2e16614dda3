from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratalake.functions import keys, masks
from stratalake.operators import masking
from tests.conftest import rows


def murmur3(data: bytes, seed: int = 42) -> int:
    """Spark's 32-bit hash of a string: whole words first, then each remaining byte as a signed word."""

    def mix_k(k):
        k = (k * 0xCC9E2D51) & 0xFFFFFFFF
        k = ((k << 15) | (k >> 17)) & 0xFFFFFFFF
        return (k * 0x1B873593) & 0xFFFFFFFF

    def mix_h(h, k):
        h ^= mix_k(k)
        h = ((h << 13) | (h >> 19)) & 0xFFFFFFFF
        return (h * 5 + 0xE6546B64) & 0xFFFFFFFF

    h, whole = seed & 0xFFFFFFFF, len(data) - len(data) % 4
    for i in range(0, whole, 4):
        h = mix_h(h, int.from_bytes(data[i : i + 4], "little"))
    for b in data[whole:]:
        h = mix_h(h, (b - 256 if b > 127 else b) & 0xFFFFFFFF)
    h ^= len(data)
    for shift, mul in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h ^= h >> shift
        h = (h * mul) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def people(spark):
    schema = "id string, firstName string, email string, age int, dob date, address struct<line1: string, postCode: string>"
    return spark.createDataFrame(
        [("1", "Ann", "Ann@X.org", 33, None, ("1 Road", "BS1  6PN")), ("2", None, None, None, None, None)], schema
    )


def test_incremental_key_is_the_absolute_murmur_hash(spark):
    df = spark.createDataFrame([("case-1", "2025-01-01"), ("ü", "x"), ("", "")], "a string, b string")
    got = df.select("a", "b", keys.incremental_key("a", "b").alias("k")).collect()
    for r in got:
        assert r["k"] == abs(murmur3(r["b"].encode(), murmur3(r["a"].encode())))


def test_fake_number_keeps_the_values_of_the_murmur_seed(spark):
    df = spark.createDataFrame([("100", "x"), ("200", None)], "id string, ni string")
    got = masking.mask_columns(df, {"ni": "number"}, "id").collect()

    def part(salt, n):
        return abs(murmur3(("100" + salt).encode())) % n

    letters, finals = masks.NUMBER_LETTERS, masks.NUMBER_FINALS
    want = letters[part("_ni1", 24)] + letters[part("_ni2", 24)] + f"{part('_nid', 10**6):06d}" + finals[part("_nil", 4)]
    assert [r["ni"] for r in got] == [want, None]


def test_masks_keep_nulls_and_are_deterministic(spark):
    rules = {"firstName": "name", "email": "email", "age": "age", "dob": "birth_date", "address": "address"}
    once = masking.mask_columns(people(spark), rules, "id")
    first, second = sorted(once.collect(), key=lambda r: r["id"])
    assert first["firstName"] == "REDACTED" and len(first["email"]) == 64 and 18 <= first["age"] <= 70
    assert tuple(first["address"]) == ("REDACTED", "BS1")
    assert first["dob"] is None, "a missing birth date is not invented"
    assert tuple(second)[1:] == (None,) * 5
    assert rows(masking.mask_columns(people(spark), rules, "id")) == rows(once)


def test_equal_addresses_stay_joinable(spark):
    df = spark.createDataFrame([("A@b.org",), ("a@B.org",)], "email string")
    assert masking.mask_columns(df, {"email": "email"}).distinct().count() == 1


@pytest.mark.parametrize("text, want", [("Ann", "A*n"), ("An", "An"), ("A", "A"), ("", ""), (None, None), ("Anna B", "A****B")])
def test_keep_ends(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(masks.keep_ends(F.col("t"))).first()[0] == want


def test_decisions():
    listed = [
        {"column_name": "First_Name", "classifications": ["First Name"]},
        {"column_name": "value[].email", "classifications": ["Email Address"]},
        {"column_name": "postal adress", "classifications": ["Street Address"]},
        {"column_name": "age", "classifications": ["Something"]},
        {"column_name": "other", "classifications": ["First Name"]},
    ]
    got = masking.decide(["firstName", "email", "postalAddress", "age"], listed)
    assert [(d.column, d.rule, d.reason) for d in got] == [
        ("firstName", "name", None),
        ("email", "email", None),
        ("postalAddress", "address", None),
        ("age", None, "no_matching_strategy"),
        ("other", None, "not_in_dataframe"),
    ]
    none = masking.decide(["firstName"], listed[:1], ["Email Address"])
    assert none[0].reason == "no_allowlisted_classification"


@pytest.mark.parametrize("env, want", [("DEV", True), ("test", True), ("Build", True), ("PROD", False), ("PREPROD", False), ("", False), (None, False)])
def test_unknown_environments_count_as_production(env, want):
    assert masking.masks_apply(env) is want


def test_masking_errors_are_raised(spark):
    """No drop is written unmasked because its masks could not be made."""
    with pytest.raises(Exception):
        masking.mask_for_environment(people(spark), None, "DEV")


def test_old_masks_are_found(spark):
    df = spark.createDataFrame([("A***b", "x"), ("Ann", "-*"), ("Ann", None)], "a string, b string")
    assert masking.masked_in_place(df).count() == 2


def test_policy():
    policy = masking.MaskingPolicy.from_mapping({"seed_column": "id", "entity_seed_columns": {"user": "key"}})
    assert (policy.seed_for("user"), policy.seed_for("case"), policy.allowlist) == ("key", "id", None)
