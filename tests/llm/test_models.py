"""Quality and toxicity: held-out accuracy, slopes of the network, odd rows."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest

from stratalake.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled():
    """Documents and labels of the largest plain scale, by whether a fold may be learned from."""
    rows = duckdb.sql(f"SELECT doc_id, text, quality, toxic FROM '{SF}/documents.parquet' JOIN '{SF}/labels.parquet' USING (doc_id) ORDER BY doc_id").fetchall()
    return rows


def split(rows, column, folds, held):
    fold = lambda r: zlib.crc32(str(r[0]).encode()) % folds == held
    texts = {c: [r[1] for r in rows if not fold(r) and r[column] == c] for c in (0, 1)}
    return texts, [r for r in rows if fold(r)]


def test_quality_on_held_out_rows(labelled):
    texts, held = split(labelled, 2, 3, 1)
    model = quality.fit_texts(texts)
    features = model.features()
    scores = model.score(np.array([features.of(r[1].encode()) for r in held]))
    right = (scores >= 0.5) == np.array([r[2] for r in held])
    assert right.mean() > 0.97


def test_toxicity_on_held_out_rows(labelled):
    texts, held = split(labelled, 3, 5, 0)
    network = toxicity.train({c: [t[: toxicity.MAX_CHARS] for t in v[: toxicity.PER_CLASS]] for c, v in texts.items()})
    scores = toxicity.Scorer(network).scores([r[1].encode() for r in held])
    toxic = np.array([r[3] for r in held]) == 1
    assert (scores[toxic] >= 0.5).mean() > 0.9 and (scores[~toxic] >= 0.5).mean() < 0.02
    # A toxic passage at the end of a very long clean text is found.
    worst = max((r for r in held if r[3] == 1), key=lambda r: scores[held.index(r)])
    clean = max((r[1] for r in held if r[3] == 0 and toxicity.Scorer(network).scores([r[1].encode()])[0] < 0.2), key=len)
    assert toxicity.Scorer(network).scores([((clean + " ") * 20 + worst[1]).encode()])[0] >= 0.5


def test_slopes_equal_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in toxicity._initial(1).items()}
    windows = [rng.integers(0, 9, n) for n in (3, 5, 1)]
    at, there = toxicity._grid(windows)
    x, y, each = rng.normal(0, 1, (9, 2 * toxicity.WIDTH)), np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        logit = toxicity._forward(w, toxicity._tables(w, x), at, there)[0]
        return float(np.mean(np.log1p(np.exp(-logit)) * y + np.log1p(np.exp(logit)) * (1 - y)))

    g, d_x = toxicity._slopes(w, x, at, there, y, each)
    for name in ("rec_f", "rec_b", "in_f", "in_b", "bias_b", "attend", "out"):
        at_ = tuple(rng.integers(0, n) for n in w[name].shape)
        before, step = w[name][at_], 1e-3
        w[name][at_] = before + step
        high = loss()
        w[name][at_] = before - step
        low = loss()
        w[name][at_] = before
        assert abs((high - low) / (2 * step) - g[name][at_]) < 2e-4, name


def test_windows_overlap_and_cover_everything():
    for n in (1, toxicity.WINDOW, toxicity.WINDOW + 1, 500):
        windows = toxicity.cut(list(range(n)))
        assert {x for win in windows for x in win} == set(range(n)) and all(len(x) == min(n, toxicity.WINDOW) for x in windows)
        assert all(a[-1] >= b[0] for a, b in zip(windows, windows[1:]))


def test_both_readings_of_windows_agree():
    w = toxicity._initial(3)
    rng = np.random.default_rng(2)
    tables = toxicity._tables(w, rng.normal(0, 1, (50, 2 * toxicity.WIDTH)).astype(np.float32))
    at = rng.integers(0, 50, (toxicity.WINDOW, 17))
    assert np.allclose(toxicity._forward(w, tables, at, np.ones(at.shape, bool))[0], toxicity._logits(w, tables, at), atol=1e-4)


def test_models_without_both_classes(spark, docs):
    assert quality.fit_texts({0: [], 1: []}).constant == 0.5 and toxicity.train({0: ["a"] * 9, 1: []}).constant == 0.0
    made = docs((1, "a"), (2, None), (None, ""))
    scores = quality.score(made, quality.fit_texts({0: [], 1: ["a"] * 5})).collect()
    assert [r["score"] for r in scores] == [1.0] * 3 and len(toxicity.score(made, toxicity.train({0: [], 1: []})).collect()) == 3


def test_models_on_odd_rows(spark, docs, labelled):
    model = quality.fit_texts(split(labelled[:1500], 2, 3, 1)[0])
    few = {c: [t[:2000] for t in v[:40]] for c, v in split(labelled, 3, 5, 0)[0].items()}
    network = toxicity.train(few, steps=6)
    made = docs((None, "x " * 200_000), (1, None), (2, ""), (2, ""), (3, "y" * 500_000), (4, "\n \t"))
    for found in (quality.score(made, model), toxicity.score(made, network)):
        rows = found.collect()
        assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["score"] for r in toxicity.score(docs((1, None), (2, " ")), network).collect()] == [0.0, 0.0]
    assert quality.score(docs(), model).count() == 0 and toxicity.drop_toxic(docs(), network).count() == 0
    kept = toxicity.drop_toxic(made, network)
    assert kept.columns == made.columns and {1, 2} <= {r["doc_id"] for r in kept.collect()}


def test_labels_come_from_allowed_folds_only(spark, docs):
    from stratalake.llm.labelled import fold, sample

    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (None, 1)], "doc_id long, quality int")
    found = sample(docs(*[(i, f"text {i}") for i in range(60)]), labels, "quality", fold("doc_id", 3) != 1, 100, 100)
    used = {int(t.split()[1]) for texts in found.values() for t in texts}
    assert used == {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1 and i != 3}
    assert set(queries.QUERIES) >= {"op1_quality", "op3_toxicity"}
