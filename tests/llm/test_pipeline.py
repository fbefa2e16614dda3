"""The pipeline against plain versions of its stages, and the queries that have SQL."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest

import corpus_pipeline
import verify
from stratalake.llm import queries
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    want = verify.connect(FOLDER).execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert verify.normalised(got) == verify.normalised(want)


def test_queries_and_stages_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and {m[1] for n in names if (m := re.match(r"op(\d+)_", n))} >= {str(k) for k in range(1, 11)}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_on_a_small_corpus(spark, docs):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    calm = stages["toxicity"](spark, table, FOLDER)
    assert calm.columns == table.columns and 0 < calm.count() <= table.count()

    rows = [r.asDict() for r in table.collect()]
    sites, first = defaultdict(set), {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        for at, line in enumerate((r["text"] or "").split("\n")):
            if line.strip(" "):
                sites[line.strip(" ")].add(r["source"])
                first.setdefault(line.strip(" "), (r["doc_id"], at))
    cleaned = {}
    for r in rows:
        kept = [x for at, x in enumerate((r["text"] or "").split("\n")) if len(sites[x.strip(" ")]) < 10 or first[x.strip(" ")] == (r["doc_id"], at)]
        cleaned[r["doc_id"]] = "\n".join(kept)
    lined = stages["line_dedup"](spark, table, FOLDER)
    assert lined.columns == table.columns
    assert {r["doc_id"]: r["text"] for r in lined.collect()} == cleaned

    roots = brute.components({r["doc_id"]: brute.fingerprint(r["text"]) for r in rows})
    single = stages["simhash_near_dedup"](spark, table, FOLDER)
    assert single.columns == table.columns and sorted(r["doc_id"] for r in single.collect()) == sorted(set(roots.values()))

    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    clean = stages["benchmark_decontamination"](spark, table, FOLDER)
    assert clean.columns == table.columns
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in rows if not brute.contamination(r["text"], items)[1]}


def test_run_packs_what_the_stages_leave(spark):
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} <= {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert packed.count() > 0
