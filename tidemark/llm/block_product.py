"""Links inside groups of documents by a blocked sparse product of their sets.

The rows of a group are dealt to blocks. A task gets two blocks and multiplies their document by
shingle incidence: for each row of one block it adds up, column by column, how many shingles every row of
the other shares with it. Pairs below the bound that the two sizes set are dropped, and of the links
found only those leave the task that join two components, so what comes out is linear in the rows
that went in, whatever their number of links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: Rows of a block.
BLOCK = 512


class _Components:
    """Disjoint sets over the names that two blocks hold."""

    def __init__(self) -> None:
        self._up: dict[bytes, bytes] = {}

    def find(self, name: bytes) -> bytes:
        top = name
        while (up := self._up.get(top, top)) != top:
            top = up
        while name != top:
            self._up[name], name = top, self._up.get(name, name)
        return top

    def join(self, a: bytes, b: bytes) -> bool:
        """Whether the two were apart until now."""
        a, b = self.find(a), self.find(b)
        self._up[max(a, b)] = min(a, b)
        return a != b


def _links(left: pa.Table, right: pa.Table, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between rows of two blocks that lie in different components, a forest of them."""
    sizes, columns = [], []
    for side in (left, right):
        sets = side.column("shingles").combine_chunks()
        sizes.append(np.diff(sets.offsets.to_numpy()).astype(np.int64))
        columns.append(sets.flatten().to_numpy())
    # the postings of the right block, by column
    order = np.argsort(columns[1], kind="stable")
    owners = np.repeat(np.arange(right.num_rows), sizes[1])[order]
    sorted_columns = columns[1][order]
    starts = np.searchsorted(sorted_columns, columns[0], "left")
    lengths = np.searchsorted(sorted_columns, columns[0], "right") - starts
    ends = np.concatenate([[0], np.cumsum(sizes[0])])
    names = [side.column("node").to_pylist() for side in (left, right)]
    roots = [side.column("root").to_pylist() for side in (left, right)]
    trees, found = _Components(), []
    for row in range(left.num_rows):
        own = slice(ends[row], ends[row + 1])
        count = lengths[own]
        total = int(count.sum())
        if not total:
            continue
        # all postings of the row's columns, one after the other
        first = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        common = np.bincount(owners[np.arange(total) + first], minlength=right.num_rows)
        union = sizes[0][row] + sizes[1] - common
        for other in np.flatnonzero((common > 0) & (100 * common >= percent * union)):
            if names[0][row] != names[1][other] and trees.join(roots[0][row], roots[1][other]):
                found.append((names[0][row], names[1][other]))
    return found


def linked_in_groups(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between rows of a group, enough of them to join all its linked components.

    ``rows`` is (hub, node, root): the group, the row and the component that it is known to be in;
    ``sets`` is (node, shingles). Rows of the group's largest component are compared with the others
    only, all other rows with every row.
    """
    counts = rows.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("k"))
    groups = counts.groupBy("hub").agg(
        F.max(F.struct("k", "root"))["root"].alias("main"), F.max("k").alias("most"), F.sum("k").alias("all")
    )
    blocks = {
        "lefts": F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int"),
        "rights": F.ceil(F.col("all") / BLOCK).cast("int"),
    }
    groups = groups.filter("all > most").withColumns(blocks).drop("most", "all")
    dealt = rows.join(groups, "hub").withColumn("deal", F.xxhash64("node"))
    left = dealt.filter("root != main").selectExpr(
        "hub", "node", "root", "true as is_left", "cast(pmod(deal, lefts) as int) as i",
        "explode(sequence(0, rights - 1)) as j",
    )
    right = dealt.selectExpr(
        "hub", "node", "root", "false as is_left", "explode(sequence(0, lefts - 1)) as i",
        "cast(pmod(deal, rights) as int) as j",
    )
    both = left.unionByName(right).join(sets, "node")

    def run(table: pa.Table) -> pa.Table:
        side = table.column("is_left")
        found = _links(table.filter(side), table.filter(pa.compute.invert(side)), percent)
        return pa.table({"a": pa.array([min(p) for p in found], pa.binary()), "b": pa.array([max(p) for p in found], pa.binary())})

    return staged(both.groupBy("hub", "i", "j").applyInArrow(run, "a binary, b binary").distinct(), "block-links")
