import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import near_dedup
from tidemark.llm.ngram_join import Shingler


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if len(w) == 1 else zip(w, w[1:]))


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
    """Copies, chains of edits, stars around the threshold, and texts that share one passage."""
    rng = random.Random(seed)
    texts = [None, "", " \n ", "one", "ONE ", "one two", "One\ttwo", "\x85a b", "a b a b a"]
    passage = [f"p{i}" for i in range(60)]
    for c in range(8):
        words = [f"w{rng.randrange(60 + 900 * (c % 3))}" for _ in range(rng.choice([12, 30, 110, 140, 300]))]
        for _ in range(12):
            texts.append(" ".join(words))
            words = edited(rng, words, rng.choice([0, 1, 1, 2, 3, 8]))
        star = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([60, 120, 200, 400]))]
        texts += [" ".join(edited(rng, star, max(1, len(star) * rng.choice([3, 5, 7, 10]) // 100))) for _ in range(12)]
        texts += [" ".join([f"u{rng.randrange(10**6)}" for _ in range(rng.choice([10, 90, 200]))] + passage) for _ in range(12)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,long", [(1, near_dedup.LONG), (2, 3)])
def test_equals_all_pairs(spark, monkeypatch, seed, long):
    monkeypatch.setattr(near_dedup, "LONG", long)
    texts = corpus(seed)
    rows = [(1000 - i, t, "x", None) for i, t in enumerate(texts)] + [(None, "one", "x", None), (None, None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, n int").repartition(4)
    sizes, roots = by_hand(texts)
    least = defaultdict(lambda: 10**9)
    for i, r in enumerate(roots):
        least[r] = min(least[r], 1000 - i)
    expected = {1000 - i: (sizes[i], least[r], least[r] == 1000 - i) for i, r in enumerate(roots)}
    one = next(i for i, t in enumerate(texts) if t == "one")
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is not None} == expected
    nulls = {(r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is None}
    assert nulls == {(1, least[roots[one]], False), (0, None, True)}
    assert sum(k for *_, k in expected.values()) > 100


def test_repeated_ids_long_texts_and_no_rows(spark):
    long_text = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long_text), (2, long_text + " end"), (3, "a b c"), (3, "a b c"), (3, "d e f"), (4, "d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect())
    assert found == [(1, 59_999, 1), (2, 60_000, 1), (3, 2, 3), (3, 2, 3), (3, 2, 3), (4, 2, 3)]
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_group_of_copies_around_one_text_stays_linear(spark):
    """Copies 6 % of whose words were changed are far from each other; pairs do not grow with their square."""
    rng = random.Random(6)
    made = []
    for count in (60, 120):
        base = [f"w{i}" for i in range(300)]
        texts = [" ".join(base)] + [" ".join(edited(rng, base, 18)) for _ in range(count)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        pairs = []
        plain = near_dedup._estimated
        near_dedup._estimated = lambda p, *a: (pairs.append(p.count()), plain(p, *a))[1]
        try:
            near_dedup.near_duplicates(docs).collect()
        finally:
            near_dedup._estimated = plain
        made.append(sum(pairs))
    assert made[1] < 3 * made[0]


def test_sketches_keep_the_order_of_hashes():
    cut = Shingler(2)
    own = cut(" ".join(f"w{i}" for i in range(500)))
    signed = near_dedup._signed(own[: near_dedup.K])
    assert np.all(np.diff(signed.astype(object)) > 0)
    assert set(near_dedup._bucket(signed)) <= set((own >> np.uint64(46)).astype(int))
    far = near_dedup.cells_of(near_dedup._signed(cut(" ".join(f"x{i}" for i in range(500)))[: near_dedup.K]))
    assert not set(far) & set(near_dedup.cells_of(signed))


def test_equal_cells_of_linked_sets():
    """Sets at the threshold share many cells, also where one holds the other."""
    rng = np.random.default_rng(3)
    fewest = []
    for trial in range(300):
        both = rng.integers(0, 2**64, 800, dtype=np.uint64)
        more = rng.integers(0, 2**64, 200, dtype=np.uint64)
        sides = (both, np.r_[both, more]) if trial % 2 else (np.r_[both, more[:100]], np.r_[both, more[100:]])
        keys = [set(near_dedup.cells_of(near_dedup._signed(np.sort(s)[: near_dedup.K]))) for s in sides]
        fewest.append(len(keys[0] & keys[1]))
    assert min(fewest) >= 3
