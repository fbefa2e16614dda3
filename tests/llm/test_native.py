"""Line dedup, secret scan and decontamination: plans without Python, and results against brute force."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from stratalake.llm import boilerplate, decontaminate, queries, secrets, simhash
from tests.conftest import plan
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
PYTHON = ("Python", "MapInArrow", "MapInPandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", ["op7_line_dedup", "op8_secrets", "op9_decontamination"])
def test_no_python_in_the_plan(spark, name):
    text = plan(queries.QUERIES[name](spark, FOLDER))
    assert not [x for x in PYTHON if x in text]


def lines(df, **kw):
    out = boilerplate.remove_boilerplate(df, **kw)
    assert out.columns == [*df.columns, "__n_lines", "__n_removed"]
    return sorted(((r["doc_id"], r["text"], r["__n_lines"], r["__n_removed"]) for r in out.collect()), key=repr)


def test_lines_on_many_sites_keep_their_first_occurrence(docs):
    made = [(i, f"own {i}\n  Cookie notice \nend {i}", f"s{i}") for i in range(12)]
    found = lines(docs(*made, (50, "Cookie notice\nCookie notice", "s1")), min_sites=10)
    assert found[0] == (0, made[0][1], 3, 0)
    assert (5, "own 5\nend 5", 3, 1) in found and (50, "", 2, 2) in found


@pytest.mark.parametrize("sites,removed", [(9, 0), (10, 9), (11, 10)])
def test_the_threshold_is_exact(docs, sites, removed):
    found = lines(docs(*[(i, f"shared line\nown {i}", f"s{i}") for i in range(sites)]), min_sites=10)
    assert sum(f[3] for f in found) == removed


def test_copies_on_one_site_are_not_boilerplate(docs):
    assert sum(f[3] for f in lines(docs(*[(i, "same\nline", "s0") for i in range(40)]))) == 0


def test_wide_spread_is_found_by_its_sketch(docs):
    found = lines(docs(*[(i, f"everywhere\nown {i}", f"site-{i}") for i in range(400)]), min_sites=300)
    assert sum(f[3] for f in found) == 399


def test_lines_of_odd_rows(docs):
    long = "word " * 50_000
    made = [(None, "a\nb", None), (1, None, "s"), (1, None, "s"), (2, "", "s"), (3, long, "s"), (4, "\n\n", None), (4, "\n\n", None)]
    found = lines(docs(*made), min_sites=2)
    assert len(found) == 7 and (1, None, 0, 0) in found and (2, "", 1, 0) in found and (3, long, 1, 0) in found
    assert lines(docs()) == []


def spans_of(df, **kw):
    rows = secrets.scan(df, **kw).select("doc_id", secrets.written(F.col("base")).alias("base"), secrets.written(F.concat("base", "added")).alias("spans")).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_base_spans_equal_brute_force(docs):
    rng = random.Random(5)
    parts = ["password", "Api_Key", "SECRET", "token", "passwd", "=", ":", " ", '"', "'", "AKIA", "AKIAABCDEFGHIJ0123", "0123456789abcdef", "deadbeef", "é𝄞", "x-y/z+w_", "=abc", "\n", "KK", "A1B2"]
    made = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(400)]
    found = dict((i, b) for i, b, _ in spans_of(docs(*made)))
    for i, text in made:
        assert found[i] == ",".join(f"{k}:{a}:{b}" for a, _, k, b in brute.secrets(text)), text


def test_ownership_tells_copied_from_live(docs):
    copied, live = "token=EXAMPLEKEY0123abc", "token=qW3rT9zX1pL8mN5"
    made = [(i, copied, f"owner{i}") for i in range(3)] + [(9, live, "owner1"), (10, "token=aaaaaaaaaaaaaaaa", "owner2")]
    found = {i: s for i, _, s in spans_of(docs(*made))}
    assert "copied:6:23" in found[0] and "live:6:21" in found[9] and found[10] == "assign:0:22,hex:6:22"


def test_secrets_of_odd_rows(docs):
    long = "x" * 300_000 + " secret: 0123456789abcdefXYZ"
    found = spans_of(docs((None, long, None), (1, None), (1, None), (2, ""), (3, "token=short")))
    assert len(found) == 5 and found[0][1] == "" and sum("assign:300001:" in (b or "") for _, b, _ in found) == 1
    assert spans_of(docs()) == []


def test_many_matches_in_one_text_take_time_in_proportion(docs):
    unit = "token=qW3rT9zX1pL8mN5 0123456789abcdef AKIAABCDEFGHIJ0123 "
    text, started = unit * 70_000, time.perf_counter()
    (row,) = secrets.scan(docs((1, text))).select(F.size("base").alias("n"), F.element_at("base", -1).alias("last")).collect()
    assert row["n"] == 210_000 and row["last"]["end"] == len(text) - 1
    assert len(text) > 3_900_000 and time.perf_counter() - started < 60
    some = unit * 300
    assert spans_of(docs((1, some)))[0][1] == ",".join(f"{k}:{a}:{b}" for a, _, k, b in brute.secrets(some))


def test_verdicts_rest_on_owners_repositories_and_entropy(spark):
    made = [("a", f"r{i}", "o1", 3.5) for i in range(9)] + [("b", f"r{i}", "o1", 3.5) for i in range(10)] + [("c", "r", "o1", 2.9), ("d", "r", "o1", 3.5), ("d", "r", "o2", 3.5)]
    made += [("e", "r", f"o{i}", 1.0) for i in range(3)]
    df = spark.createDataFrame(made * 2, "value_hash string, repository string, owner string, bits double")
    assert {r["value_hash"]: r["verdict"] for r in secrets.ownership(df).collect()} == {"a": "live", "b": "copied", "c": "plain", "d": "plain", "e": "copied"}
    values = ["aaaaaaaa", "abababab", "0123456789abcdef", "deadbeefdeadbeef"]
    got = spark.createDataFrame([(v,) for v in values], "v string").select(secrets._bits(F.col("v"))).collect()
    assert [round(r[0], 6) for r in got] == [0.0, 1.0, 4.0, 2.155639]


def hits(df, items):
    rows = decontaminate.contamination(df, items).collect()
    return sorted(((r["doc_id"], r["n_words"], len(r["covered"]), r["items"]) for r in rows), key=repr)


def test_contamination_equals_brute_force(spark, docs):
    rng = random.Random(8)
    vocabulary = ["a", "b", "Ab", "ab", "é", "7", "C-d"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = {i: say(rng.choice([0, 2, 5, 9, 10, 11, 25])) for i in range(14)}
    items[20] = "the the the the the the the the the the the the"
    texts = [say(rng.randint(0, 40)) for _ in range(60)]
    texts += [say(5) + ". " + items[i] + " " + say(5) for i in items] + ["the " * 30, items[20], ""]
    made = list(enumerate(texts))
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items.items()] + [(None, None, "x"), (30, "", "y")], "item_id long, text string, doc_id string")
    want = sorted(((i, *brute.contamination(t, items)) for i, t in made), key=repr)
    assert hits(docs(*made), bench) == want


def test_every_long_enough_span_is_found(spark, docs):
    passage = [f"w{i}" for i in range(40)]
    bench = spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string")
    made = [(i, "x y " + " ".join(passage[i : i + 10]) + " z") for i in range(31)] + [(i + 40, "x " + " ".join(passage[i : i + 9]) + " z") for i in range(31)]
    found = {f[0]: f[2] for f in hits(docs(*made), bench)}
    assert found == {i: 10 for i in range(31)} | {i + 40: 0 for i in range(31)}


def test_contamination_of_odd_rows(spark, docs):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    long = "filler " * 40_000 + "one two three four five six seven eight nine ten"
    found = hits(docs((None, long), (1, None), (2, ""), (3, "One, two; three"), (3, "One, two; three")), bench)
    assert [f[1:3] for f in found] == [(0, 0), (0, 0), (3, 0), (3, 0), (40_010, 10)]
    kept = decontaminate.drop_contaminated(docs((1, None), (2, long), (3, "fine")), bench)
    assert sorted(r[0] for r in kept.collect()) == [1, 3] and "component_id" in kept.columns
    assert hits(docs(), bench) == [] and len(hits(docs((1, "a b")), bench.limit(0))) == 1


def test_a_hot_phrase_meets_once_whatever_the_items(spark, docs):
    phrase = " ".join(f"w{i}" for i in range(9))
    counts = []
    for n in (50, 200):
        bench = spark.createDataFrame([(i, f"{phrase} item{i} end") for i in range(n)], "item_id long, text string")
        found = decontaminate.contamination(docs(*[(i, f"{phrase} doc{i} end") for i in range(n)]), bench)
        assert found.filter(F.size("covered") > 0).isEmpty()
        whole = decontaminate.contamination(docs(*[(i, f"x {phrase} item7 end") for i in range(n)]), bench)
        counts.append(whole.agg(F.sum(F.size("items"))).first()[0])
    assert counts == [50, 200]


def test_slices_of_a_large_benchmark_give_the_same(spark, docs, monkeypatch):
    rng = random.Random(9)
    say = lambda n: " ".join(rng.choice("abcdef") for _ in range(n))
    items = {i: say(rng.choice([3, 10, 14])) for i in range(30)}
    made = [(i, say(60)) for i in range(40)] + [(99, items[0])]
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    monkeypatch.setattr(decontaminate, "SLICE", 20)
    assert hits(docs(*made), bench) == sorted(((i, *brute.contamination(t, items)) for i, t in made), key=repr)


def test_stages_keep_columns_of_any_name(spark):
    names = ["__id", "__ID_", "__key", "__gone", "__text", "__row", "__stay", "__stay_text", "__stay_row", "n", "at", "print", "p", "row", "words", "fp"]
    rows = [(i, f"line {i}\nshared line of all", f"s{i % 12}", *[f"{c}{i}" for c in names]) for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in names))
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    cleaned = boilerplate.remove_boilerplate(df)
    assert cleaned.columns == [*df.columns, "__n_lines", "__n_removed"] and cleaned.filter("__n_removed = 1").count() == 23
    assert boilerplate.remove_boilerplate(cleaned).columns == cleaned.columns
    for out in (cleaned.select(*df.columns), simhash.keep_one(df), decontaminate.drop_contaminated(df, bench)):
        assert out.columns == df.columns
        for r in out.collect():
            assert all(r[c] == f"{c}{r['doc_id']}" for c in names)
