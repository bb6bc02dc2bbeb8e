import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import components, ngram_join


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[k : k + 5]) for k in range(len(w) - 4)))


def by_hand(texts):
    """Component number of each text, by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [len(s) for s in sets], [find(x) for x in range(len(texts))]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], [f"n{rng.randrange(10**6)}"], [words[k], "extra"]])
    return words


def corpus(seed):
    """Copies, chains of edits whose ends are far apart, and texts that share one passage."""
    rng = random.Random(seed)
    texts = [None, "", " \n ", "one two", "ONE  two", "one two three four five", "\x85a b"]
    passage = [f"p{i}" for i in range(40)]
    for c in range(12):
        words = [f"w{rng.randrange(60 + 900 * (c % 3))}" for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(14):
            texts.append(" ".join(words))
            words = edited(rng, words, rng.choice([0, 1, 1, 2, 3]))
        star = [f"w{rng.randrange(5000)}" for _ in range(60)]
        texts += [" ".join(edited(rng, star, rng.choice([1, 2]))) for _ in range(14)]
        texts += [" ".join([f"u{rng.randrange(10**6)}" for _ in range(10)] + passage) for _ in range(5)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("column_rows", [8192, 4])
def test_equals_all_pairs(spark, monkeypatch, seed, column_rows):
    monkeypatch.setattr(ngram_join, "COLUMN_ROWS", column_rows)
    texts = corpus(seed)
    rows = [(1000 - i, t, "x", None) for i, t in enumerate(texts)] + [(None, "one two", "x", None), (None, None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, n int")
    sizes, roots = by_hand(texts)
    least = defaultdict(lambda: 10**9)
    for i, r in enumerate(roots):
        least[r] = min(least[r], 1000 - i)
    expected = {1000 - i: (sizes[i], least[r]) for i, r in enumerate(roots)}
    two_words = next(i for i, t in enumerate(texts) if t == "one two")
    found = ngram_join.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == expected
    nulls = {(r.n_shingles, r.component_id) for r in found if r.doc_id is None}
    assert nulls == {(1, least[roots[two_words]]), (0, None)}


def test_repeated_ids_and_long_texts(spark):
    long_text = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long_text), (2, long_text + " end"), (3, "a b c"), (3, "a b c"), (3, "d e f"), (4, "d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect())
    assert found == [(1, 59_996, 1), (2, 59_997, 1), (3, 1, 3), (3, 1, 3), (3, 1, 3), (4, 1, 3)]
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


def test_pairs_of_a_group_around_the_threshold_stay_linear(spark, monkeypatch):
    """Copies of one text, three of 200 words changed in each: far and near pairs, all in one group."""
    made = []
    plain = ngram_join._linked
    for count in (60, 120):
        rng = random.Random(9)
        base = [f"w{i}" for i in range(200)]
        texts = []
        for _ in range(count):
            words = list(base)
            for k in rng.sample(range(200), 3):
                words[k] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(words))
        pairs = []
        monkeypatch.setattr(ngram_join, "_linked", lambda p, *a: (pairs.append(p.count()), plain(p, *a))[1])
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
        assert found == dict(enumerate(by_hand(texts)[1]))
        made.append(sum(pairs))
    assert made[1] < 3 * made[0]


def test_shingler_equals_sets():
    cut = ngram_join.Shingler()
    for text in corpus(3):
        assert len(cut(text or "")) == len(shingles(text))
        assert np.all(np.diff(cut(text or "").astype(object)) > 0)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001 + i) for i in range(300)] + [(5, 5), (2000, 1999)]
    edges = spark.createDataFrame(path, "a long, b long").repartition(4)
    found = {r.node: r.root for r in components.components(edges).collect()}
    groups = defaultdict(set)
    for node, root in found.items():
        groups[root].add(node)
    assert sorted(map(len, groups.values())) == [2, 301, 301]
    assert components.components(edges.limit(0)).count() == 0
