import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int"


def ordered(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [r[2:] for r in sorted(own)] for c, own in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


def by_hand(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        turns = tuple(convs[c])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        kids = [totals[k] for k in children[node]]
        totals[node] = (sum(k[0] for k in kids) if kids else 1, own + sum(k[1] for k in kids))
    return sorted(
        (
            members[n][0],
            len(n),
            members[n[:-1]][0] if n else None,
            len(members[n]),
            len(children[n]),
            *totals[n],
            hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest(),
        )
        for n in members
    )


def result(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in frame.select(*names).collect())


def made(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(convs * 2), convs):
        for turn in range(rng.randrange(1, longest)):
            if rng.random() < 0.9:
                text = rng.choice(["hi", "ü" * 3, "", None, f"t{rng.randrange(40)}"])
                rows.append((conv, turn, rng.choice(["user", "assistant", None]), text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], SCHEMA).repartition(6)


@pytest.mark.parametrize("cell", [prefix_trie.CELL, 2])
def test_rebuilt_equals_by_hand(spark, monkeypatch, cell):
    monkeypatch.setattr(prefix_trie, "CELL", cell)
    monkeypatch.setattr(prefix_trie, "PIECE", 20)
    rows = made(1, 120, 14) + [(None, 0, "user", "lost"), (-3, 1, "user", "neg"), (400, None, "user", "x"), (400, 2, "user", "y")]
    # one first turn of a third of all, and identical conversations
    rows += [(c, t, "user", "same") for c in range(1000, 1080) for t in range(3)]
    rows += [(2001, 0, "user", "only one, and its base is absent")]
    found = result(prefix_trie.prefix_trie(frame(spark, rows), rebuild=True))
    assert found == by_hand(rebuilt(ordered(rows)))


def test_deep_chain_and_repeated_rows(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(300)] + [(2, t, "user", f"t{t}") for t in range(250)]
    rows += [(3, t, "user", f"t{t if t < 120 else -t}") for t in range(200)] + [(4, 0, "user", "a")] * 3
    convs = ordered(rows)
    assert result(prefix_trie.prefix_trie(frame(spark, rows))) == by_hand(convs)


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(frame(spark, [(1, 1, "user", "a")]).limit(0), rebuild=True).count() == 0


def test_totals_of_random_trees(spark):
    rng = random.Random(4)
    for shape in (lambda i: rng.randrange(i), lambda i: max(0, i - rng.choice([1, 1, 2]))):
        parent = {0: None} | {i: shape(i) for i in range(1, 100)}
        value = {i: rng.randrange(100) for i in parent}
        total = dict(value)
        for i in range(99, 0, -1):
            total[parent[i]] += total[i]
        rows = [(i, p, value[i]) for i, p in parent.items()]
        tree = spark.createDataFrame(rows, "node long, parent long, v long")
        found = prefix_trie.subtree_totals(tree, ["v"])
        assert {r.node: r.v for r in found.collect()} == total


def test_very_long_text_and_bytes(spark):
    rows = [(c, 0, "user", "é" * 300_000) for c in (5, 6, 7)]
    root, found = sorted(prefix_trie.prefix_trie(frame(spark, rows)).collect(), key=lambda r: r.depth)
    assert (found.conv_id, found.n_convs, found.saved_tokens) == (5, 3, 2 * 600_000)
    assert root.n_children == 1
