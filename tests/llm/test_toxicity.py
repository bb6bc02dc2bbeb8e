import random
import zlib

import numpy as np
import pytest

from tidemark.llm import queries, toxicity
from tidemark.llm.linear import Sparse, fit_logistic, sigmoid


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def tables(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{'abcdefghij'[rng.randrange(10)]}{'klmnopqrst'[rng.randrange(10)]}xy" for _ in range(rng.randrange(1, 60))]
        toxic = i % 6 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["grawlix", "blorpling", "blorpish", "zounder"]))
        rows.append((i, " ".join(words), "s", 0.5))
        if i % 2 == 0:
            labels.append((i, int(toxic), "clash"))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, source string, score double"),
        spark.createDataFrame(labels, "doc_id long, toxic int, text string"),
    )


def test_learns_and_scores_like_plain_python(spark):
    docs, labels = tables(spark)
    model = toxicity.fit(docs, labels)
    more = [(9000, None), (9001, ""), (9002, "wakxy " * 100_000 + "grawlix"), (None, "blorpish"), (3, "wakxy"), (3, "wakxy")]
    every = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    texts = [(r.doc_id, r.text) for r in every.collect()]
    found = toxicity.score_texts(every, model).collect()
    expected = sorted(((i is None, i or 0, model.score(t or "")) for i, t in texts))
    scored = sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in found)
    assert [x[:2] for x in scored] == [x[:2] for x in expected]
    assert [x[2] for x in scored] == pytest.approx([x[2] for x in expected])
    for r in found:
        assert r.held_out == held_out(r.doc_id) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
    by_id = {r.doc_id: r.predicted for r in found}
    assert np.mean([by_id[i] == (i % 6 == 0) for i in range(400) if held_out(i)]) > 0.95
    assert by_id[9000] == by_id[9001] == 0 and by_id[None] == 1


def test_held_out_labels_are_not_used(spark):
    docs, labels = tables(spark)
    turned = spark.createDataFrame(
        [(r.doc_id, 1 - r.toxic if held_out(r.doc_id) else r.toxic) for r in labels.collect()], "doc_id long, toxic int"
    )
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, turned)


def test_no_labels_and_empty(spark):
    docs, labels = tables(spark, 20)
    model = toxicity.fit(docs, labels.limit(0))
    assert model.weights == {}
    assert {r.predicted for r in toxicity.score_texts(docs, model).collect()} == {0}
    assert toxicity.score_texts(docs.limit(0), model).count() == 0
    one_kind = labels.withColumn("toxic", labels.toxic * 0)
    assert toxicity.fit(docs, one_kind).weights == {}
    no_value = labels.withColumn("toxic", labels.toxic.cast("int") + None)
    assert toxicity.fit(docs, no_value).weights == {}


def test_label_model_recovers_rates():
    rng = np.random.default_rng(3)
    truth = (rng.random(6000) < 0.2).astype(int)
    rates = np.array([[0.02, 0.05, 0.01, 0.1, 0.9], [0.6, 0.5, 0.4, 0.55, 0.15]])
    votes = (rng.random((6000, 5)) < rates[truth]).astype(float)
    votes = np.column_stack([votes, votes[:, 0]])  # a voter that repeats another
    known = np.where(np.arange(6000) < 600, truth, -1)
    model = toxicity.LabelModel.fit(votes, known)
    assert np.abs(model.fires[:, :5] - rates).max() < 0.1
    assert model.share[0] == pytest.approx(model.share[5]) and model.share[0] < 0.6 < model.share[1]
    assert np.mean((model.posterior(votes) >= 0.5) == truth) > 0.9


def test_logistic_equals_newton():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    target = sigmoid(x @ np.array([1.0, -2.0, 0.5]) + 0.3)
    w, b = fit_logistic(x, target, penalty=1e-6, rounds=3000)
    assert w == pytest.approx([1.0, -2.0, 0.5], abs=1e-2) and b == pytest.approx(0.3, abs=1e-2)
    rows = [dict(enumerate(r)) for r in x]
    ws, bs = fit_logistic(Sparse(rows, 3), target, penalty=1e-6, rounds=3000)
    assert ws == pytest.approx(w) and bs == pytest.approx(b)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.QUERIES["op6_weak_supervision_toxicity"](spark, sf_dir).collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if held_out(r.doc_id)]
    assert np.mean([rows[r.doc_id].predicted == r.toxic for r in labels]) >= 0.9
