import random
import zlib

import numpy as np

from tidemark.llm import cotrain, queries


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def tables(spark, n=600):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = [rng.choice("the of and cat runs over hill tree stone river".split()) for _ in range(rng.randrange(30, 90))]
        if not good:
            words = [w.upper() + "$$$" for w in words]
        rows.append((i, " ".join(words), "spam" if not good and i % 3 else "press", "en", len(words) * 4, "x"))
        if i % 10 < 3:
            labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, score string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int")


def test_learns(spark):
    docs, labels = tables(spark)
    model = cotrain.fit(docs, labels)
    found = {r.doc_id: r for r in cotrain.score_texts(docs, model).collect()}
    assert np.mean([found[i].kept == (i % 4 != 0) for i in found]) > 0.98
    assert all(r.held_out == held_out(i) for i, r in found.items())


def test_scores_equal_plain_python_and_hard_rows(spark):
    docs, labels = tables(spark)
    model = cotrain.fit(docs, labels)
    rows = [(1, None, None, None, None), (2, "", "s", "en", 0), (2, "", "s", "en", 0), (None, "word " * 200_000, "press", "en", -5)]
    hard = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    found = sorted((r.doc_id or 0, r.score) for r in cotrain.score_texts(hard, model).collect())
    for (i, score), (j, text, source, lang, size) in zip(found, sorted(rows, key=lambda r: r[0] or 0)):
        text = text or ""
        content = np.array([cotrain.content_numbers(text)])
        page = np.array([[np.log1p(max(size or 0, 0)), *cotrain.layout_numbers(text)]])
        assert i == (j or 0)
        assert abs(score - model.score(content, page, [[source or ""], [lang or ""]])[0]) < 1e-9
        assert 0 <= score <= 1
    assert cotrain.score_texts(hard.limit(0), model).count() == 0


def test_no_labels(spark):
    docs, labels = tables(spark, 40)
    assert cotrain.fit(docs, labels.limit(0)) == 1.0
    assert cotrain.fit(docs, labels.selectExpr("doc_id", "0 AS quality")) == 0.0
    assert {r.kept for r in cotrain.score_texts(docs, 1.0).collect()} == {True}


def test_exchange_helps_the_weak_view():
    rng = np.random.default_rng(1)
    truth = (rng.random(4000) < 0.5).astype(int)
    strong = np.eye(2)[truth]
    weak = rng.normal(size=(4000, 20)) + 0.6 * (2 * truth - 1)[:, None] * (np.arange(20) < 10)
    label = np.where(np.arange(4000) < 30, truth, -1)
    alone = cotrain.View()
    alone.fit(weak[:30], truth[:30])
    views = cotrain.View(), cotrain.View()
    given = cotrain.exchange(views, (strong, weak), label, rounds=4, share=0.1)
    right = [np.mean((v.margin(weak) > 0) == truth) for v in (alone, views[1])]
    assert given > 100 and right[1] > right[0]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.QUERIES["op5_cotraining_quality"](spark, sf_dir).collect()}
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if held_out(r.doc_id)]
    assert np.mean([rows[r.doc_id].kept == bool(r.quality) for r in labels]) >= 0.9
