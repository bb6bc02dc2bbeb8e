"""Connected components of an edge table, without bringing any of it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_side, staged


def _roots(parents: DataFrame) -> DataFrame:
    """(node, root) from (node, parent), where a parent is never greater than its node.

    Each pass replaces parents by grandparents, twice, so a path of length d takes log4(d) passes.
    """
    parents = staged(parents, "parents")
    while True:
        up = small_side(parents.select(F.col("node").alias("parent"), F.col("parent").alias("above")))
        once = parents.join(up, "parent", "left")
        once = once.select("node", F.col("parent").alias("was"), F.coalesce("above", "parent").alias("parent"))
        twice = once.join(up, "parent", "left").select("node", "was", F.coalesce("above", "parent").alias("parent"))
        jumped = staged(twice, "parents")
        if jumped.filter(F.col("was") != F.col("parent")).limit(1).count() == 0:
            return jumped.select("node", F.col("parent").alias("root"))
        parents = jumped.select("node", "parent")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is one node of the component.

    Nodes hook on their smallest neighbour, the trees are flattened and the edges carried over to
    the roots, until no edge joins two trees. The number of rounds grows with the logarithm of the
    component's diameter. Edges of a node with very many are reduced before they are shuffled.
    """
    edges = edges.filter(F.col("a") != F.col("b"))
    found = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        roots = _roots(parents.select("node", F.least("node", "near").alias("parent")))
        if found is None:
            found = roots
        else:
            later = small_side(roots.select(F.col("node").alias("root"), F.col("root").alias("top")))
            found = found.join(later, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        left = small_side(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")))
        right = small_side(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")))
        moved = edges.join(left, "a").join(right, "b").filter(F.col("ra") != F.col("rb"))
        edges = staged(moved.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
        if edges.limit(1).count() == 0:
            return found
