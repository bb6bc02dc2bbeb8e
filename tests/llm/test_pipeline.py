from collections import defaultdict

import public_tokenizers
import pytest
from test_ngram_join import by_hand
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import secrets


@pytest.fixture(scope="module")
def steps(spark):
    from conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stage(spark, found[-1], SF).cache())
        found[-1].count()
    return found


def test_stages(steps):
    raw, ruled, single, clean, mixed, coded = steps
    for frame in (ruled, single, clean, mixed):
        assert frame.columns == raw.columns
    rows = {r.doc_id: r for r in ruled.collect()}
    assert 0 < len(rows) < raw.count()

    ids = sorted(rows)
    _, roots = by_hand([rows[i].text for i in ids])
    least = defaultdict(lambda: 10**9)
    for i, root in zip(ids, roots):
        least[root] = min(least[root], i)
    assert {r.doc_id for r in single.collect()} == set(least.values())

    scan = secrets.Scanner()
    for r in clean.collect():
        assert r.text == secrets.redacted(rows[r.doc_id].text, scan(rows[r.doc_id].text)[0])
        assert r.n_chars == len(r.text)

    taken = defaultdict(int)
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in mixed.collect():
        taken[r.doc_id] += 1
        assert r.text == texts[r.doc_id]
    assert max(taken.values()) <= 3 and set(taken) <= set(texts)
    words = sum(len(t.split()) for t in texts.values())
    assert abs(sum(len(texts[i].split()) * n for i, n in taken.items()) - words) < 0.05 * words

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert coded.count() == mixed.count()
    for r in coded.collect():
        expected = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert list(memoryview(r.ids).cast("I")) == expected and r.n_tokens == len(expected)


def test_run(spark, sf_dir, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, steps[-1].collect()))


def test_hard_rows(spark):
    text = "the cat and the dog of my aunt sat on " + " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text + " x"), (None, text + " y"), (None, None), (3, None), (4, ""), (5, text[::-1])]
    docs = spark.createDataFrame(
        [(i, t, None, "s", len(t or ""), "v", 0) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, verdict string, copies int",
    )
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, "")
            assert frame.columns == docs.columns
            frame.count()
