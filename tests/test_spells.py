"""Merged spells, working days, reporting lines and movements against plain versions."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stratalake.operators import spells
from stratalake.plans import views
from tests.conftest import rows

FIRST = date(2024, 1, 1)


def day(n):
    return None if n is None else FIRST + timedelta(n)


def merged(made, gap=1):
    out, far = [], date(9999, 12, 31)
    for key in {k for k, _, _ in made}:
        mine = sorted((s, e or far) for k, s, e in made if k == key and s and (e or far) >= s)
        for s, e in mine:
            last = out[-1] if out and out[-1][0] == key else None
            if last and (s - last[2]).days <= gap:
                last[2], last[3] = max(last[2], e), last[3] + 1
            else:
                out.append([key, s, e, 1])
    return sorted(((k, s, None if e == far else e, n) for k, s, e, n in out), key=repr)


@pytest.mark.parametrize(("hot_rows", "gap"), [(2_000_000, 1), (40, 1), (40, 5)])
def test_spells_of_a_hot_key_merge_across_slices(spark, hot_rows, gap):
    rng = random.Random(hot_rows + gap)
    made = []
    for i in range(900):
        key = "hot" if i % 3 else rng.choice([None, "a", "b"])
        begin = rng.randint(0, 3000)
        made.append((key, day(begin), day(begin + rng.choice([0, 1, 3, 9, 200 if i % 50 == 0 else 2]))))
    made += [("a", day(2900), None), ("b", None, day(3)), ("b", day(9), day(3))] + [("hot", day(5), day(6))] * 5
    df = spark.createDataFrame(made, "k string, s date, e date")
    assert rows(spells.merge_spells(df, ["k"], "s", "e", gap, hot_rows)) == merged(made, gap)


def test_no_spells(spark):
    assert spells.merge_spells(spark.createDataFrame([], "k string, s date, e date"), ["k"], "s", "e").collect() == []


def test_working_days(spark):
    free = {day(0), day(9), day(400)}
    made = [(day(a), day(b)) for a in range(0, 800, 37) for b in range(a - 3, a + 500, 41) if b >= 0] + [(None, day(3)), (day(3), None)]
    df = spark.createDataFrame(made, "s date, e date")
    holidays = spark.createDataFrame([(d,) for d in free] * 2, "date date")
    running = spells.calendar(df.select(F.explode(F.array("s", "e")).alias("date")), holidays)
    out = spells.add_working_days(df, "s", "e", running, "n").collect()
    for r in out:
        if r["s"] is None or r["e"] is None:
            assert r["n"] is None
        else:
            every = [r["s"] + timedelta(i) for i in range((r["e"] - r["s"]).days + 1)]
            assert r["n"] == sum(d.weekday() < 5 and d not in free for d in every), r
    assert spells.calendar(df.limit(0).select(F.col("s").alias("date")), holidays).collect() == []


def test_reporting_lines(spark):
    made = {"boss": None, "gone": "nobody", "a": "b", "b": "c", "c": "a", "under": "a", "self": "self"}
    made |= {f"p{i}": f"p{i - 1}" if i else "boss" for i in range(70)} | {f"hot{i}": "boss" for i in range(300)}
    df = spark.createDataFrame(list(made.items()), "person string, manager string").unionByName(spark.createDataFrame([(None, "boss")], "person string, manager string"))
    found = {r["person"]: r for r in spells.reporting_lines(df, "person", "manager", " > ").collect()}
    assert set(found) == set(made)
    for person in made:
        chain, seen = [person], {person}
        while (up := made[chain[0]]) in made and up not in seen:
            chain.insert(0, up)
            seen.add(up)
        r = found[person]
        if up in seen:
            assert r["cyclic"] and r["level"] is None and r["chain"] is None and r["top"] is None
        else:
            assert (r["cyclic"], r["level"], r["top"], r["chain"]) == (False, len(chain) - 1, chain[0], " > ".join(chain))
    assert spells.reporting_lines(df.limit(0), "person", "manager").collect() == []
    with pytest.raises(Exception, match="more than one row for x"):
        spells.reporting_lines(spark.createDataFrame([("x", "y"), ("x", "z")], "person string, manager string"), "person", "manager").collect()


def test_chains_do_not_grow_round_circles(spark, monkeypatch):
    """People on and under circles need no chain; one that doubles with each step would hold thousands of names."""
    longest, write = [], spells.materialise

    def measured(df, name):
        out = write(df, name)
        texts = [F.max(F.length(c)) for c, kind in out.dtypes if kind == "string"]
        longest.append(out.select(F.greatest(F.lit(0), F.lit(0), *[F.coalesce(t, F.lit(0)) for t in texts])).first()[0])
        return out

    monkeypatch.setattr(spells, "materialise", measured)
    made = {"a": "b", "b": "a", "self": "self", "boss": None} | {f"u{i}": ("a", "self", f"u{i - 1}")[i % 3] for i in range(2000)} | {f"p{i}": f"p{i - 1}" if i else "boss" for i in range(9)}
    out = spells.reporting_lines(spark.createDataFrame(list(made.items()), "person string, manager string"), "person", "manager")
    found = {r["person"]: r for r in out.collect()}
    assert len(found) == len(made) and found["p8"]["chain"] == "/".join(["boss", *[f"p{i}" for i in range(9)]]) and found["p8"]["level"] == 9
    assert {p for p, r in found.items() if r["cyclic"]} == {p for p in made if p[0] in "abu" and p != "boss" or p == "self"}
    assert all(r["chain"] is None and r["level"] is None and r["top"] is None for r in found.values() if r["cyclic"])
    assert max(longest) <= len(found["p8"]["chain"])


def test_movements(spark):
    df = spark.createDataFrame([(day(3), None), (day(40), day(60)), (day(41), day(45)), (None, day(9))], "s date, e date")
    out = rows(spells.staff_movements(df, "s", "e", "2024-04-30"))
    assert out == [(date(2024, 1, 1), 1, 0, 1), (date(2024, 2, 1), 2, 1, 2), (date(2024, 3, 1), 0, 1, 1), (date(2024, 4, 1), 0, 0, 1)]


def test_views_take_active_rows_only(spark):
    entity = {c: c for c in [*views.INFORMATION_ENTITY.values(), "IMSEntityID"]}
    made = [("No Info", "Y"), ("old", "Y"), (None, "Y"), ("x", "N")]
    df = spark.createDataFrame(made, "BDCIDLegacy string, IsActive string").select("*", *[F.lit(v).alias(c) for c, v in entity.items()])
    out = views.information_entities(df)
    assert rows(out, "entity_id") == [("IMSEntityID",), ("old",), (None,)] and out.columns[1:] == list(views.INFORMATION_ENTITY)
    users = spark.range(30).select(F.lit("Y").alias("IsActive"), F.col("id").alias("Migrated"), *[F.lit(1).alias(c) for c in [*views.SERVICE_USER.values(), *views.SERVICE_USER_SOURCE.values()]])
    assert views.source_service_users(users).count() == 10 and views.service_users(users).count() == 1
    assert rows(views.source_service_users(users, None).groupBy("migrated").count()) == [("NO", 1), ("YES", 29)]
