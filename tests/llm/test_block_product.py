import random

import numpy as np
import pytest

from tidemark.llm import block_product


@pytest.mark.parametrize("block", [512, 8])
def test_components_equal_all_pairs(spark, monkeypatch, block):
    """Groups around the threshold, some rows already joined; links come out as a forest."""
    monkeypatch.setattr(block_product, "BLOCK", block)
    rng = random.Random(block)
    sets, group, known = {}, {}, {}
    for hub in range(4):
        base = [rng.getrandbits(63) for _ in range(60)]
        for i in range(40):
            own = set(rng.sample(base, 60 - rng.choice([2, 6, 9]))) | {rng.getrandbits(63) for _ in range(rng.choice([0, 3, 5]))}
            name = bytes([hub, i])
            sets[name], group[name] = own, bytes([hub])
            known[name] = bytes([hub, 0]) if hub == 1 and i < 15 else name
    rows = spark.createDataFrame([(group[n], n, known[n]) for n in sets], "hub binary, node binary, root binary")
    held = spark.createDataFrame([(n, [int(x) for x in s]) for n, s in sets.items()], "node binary, shingles array<long>")
    links = [(bytes(r.a), bytes(r.b)) for r in block_product.linked_in_groups(rows, held, 80).collect()]

    def components(pairs):
        up = {n: n for n in sets}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for n, r in known.items():
            up[find(n)] = find(r)
        for a, b in pairs:
            up[find(a)] = find(b)
        return {n: find(n) for n in sets}

    every = [
        (a, b) for a in sets for b in sets
        if a < b and group[a] == group[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    for a, b in links:
        assert 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    found, wanted = components(links), components(every)
    pairs = np.array([[found[a] == found[b], wanted[a] == wanted[b]] for a in sets for b in sets])
    assert (pairs[:, 0] == pairs[:, 1]).all()
    if block == 512:
        assert len(links) < len(sets) < len(every)
