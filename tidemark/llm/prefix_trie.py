"""Prefix tree of conversations, with totals of every subtree by parallel tree contraction.

Turns get their place from a sort of all rows, so that no task holds a conversation. A prefix is
named by running sums over 128-bit hashes of (place, role, text); sums of cells of ``CELL`` places
are added up first, so a long conversation is split as well. Nodes are groups of equal names.

Totals: rounds of joins over the edges contract the tree. Rake removes the leaves and adds them to
their parents. Compress removes unary chains: every chain node finds the node below the chain by
doubling its jumps. A round at least halves the tree, whatever its depth. Removed chain nodes know
their own sum and the node below; going back round by round, its total completes theirs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.operators.ordinals import BEFORE, store_in_order
from tidemark.session import work_dir

#: Places of a conversation whose hashes are added up in one sort.
CELL = 65_536
#: Bytes of ids that are sent on together.
PIECE = 65_536

LANES = ("l0", "l1", "l2", "l3")
SUMS = ("s0", "s1", "s2", "s3")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, h0, h1, bytes): turns by place from 0, with hashes of role and text.

    Null turns come first, rows of one turn in the order of their hashes; a null role or text is
    empty. Rows without a conv_id belong to no conversation. Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("h0"),
        F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    key = F.struct("conv_id", "turn", "h0", "h1", F.monotonically_increasing_id().alias("rid"))
    placed = store_in_order(
        rows.select(key.alias("key"), "bytes"), work_dir(conversations.sparkSession, "trie-turns"), "key"
    )
    placed = placed.select("key.conv_id", "key.h0", "key.h1", "bytes", "ord")
    starts = placed.groupBy("conv_id").agg(F.min("ord").alias("start"))
    return placed.join(starts, "conv_id").select(
        "conv_id", (F.col("ord") - F.col("start")).alias("pos"), "h0", "h1", "bytes"
    )


def rebuilt(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """((conv_id, length), turns) after each conversation c took the first turns of another.

    c gets the first h = crc32(c) % ``most`` turns of conversation c - c % ``every``, or all if it
    has fewer, none if it is absent, then its own turns after its first h. The remainder of a
    negative c is that of SQL.
    """
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = own.select(
        "conv_id",
        "own",
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"),
    )
    bases = own.select(F.col("conv_id").alias("base"), F.col("own").alias("given"))
    convs = convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("given", F.lit(0))))
    convs = staged(
        convs.withColumn("length", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-conversations"
    )
    heads = turns.filter(F.col("pos") < most - 1).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.select("conv_id", "base", "head"), "base").filter("pos < head")
    tails = turns.join(convs.select("conv_id", "h", "head"), "conv_id").filter("pos >= h")
    columns = ["h0", "h1", "bytes"]
    both = heads.select("conv_id", (F.col("pos") + 1).alias("depth"), *columns).unionByName(
        tails.select("conv_id", (F.col("head") + F.col("pos") - F.col("h") + 1).alias("depth"), *columns)
    )
    return convs.select("conv_id", "length"), both


def _named(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums])))


def _root_name() -> Column:
    return _named(F.lit(0), [F.lit(0)] * len(SUMS))


def steps(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, bytes): the node of each turn, named by all turns up to it."""
    low, high = F.lit(0xFFFFFFFF), 32
    mixed = [F.xxhash64(h, "depth") for h in ("h0", "h1")]
    lanes = [lane for m in mixed for lane in (m.bitwiseAND(low), F.shiftrightunsigned(m, high))]
    rows = turns.select(
        "conv_id", "depth", "bytes", F.expr(f"depth div {CELL}").alias("cell"), *[x.alias(n) for x, n in zip(lanes, LANES)]
    )
    cells = rows.groupBy("conv_id", "cell").agg(*[F.sum(x).alias(x) for x in LANES])
    carried = cells.select(
        "conv_id",
        "cell",
        *[
            F.expr(f"coalesce(sum({x}) over (partition by conv_id order by cell {BEFORE}), 0L)").alias(f"c{x}")
            for x in LANES
        ],
    )
    inside = "over (partition by conv_id, cell order by depth rows between unbounded preceding and current row)"
    summed = rows.join(carried, ["conv_id", "cell"]).withColumns(
        {s: F.expr(f"c{x} + sum({x}) {inside}") for x, s in zip(LANES, SUMS)}
    )
    return summed.select(
        "conv_id",
        "depth",
        _named(F.col("depth"), [F.col(s) for s in SUMS]).alias("node"),
        _named(F.col("depth") - 1, [F.col(s) - F.col(x) for x, s in zip(LANES, SUMS)]).alias("parent"),
        "bytes",
    )


def _ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): a hash over the ids in order.

    Ids of a node are first joined to pieces, in sorted ranges over all tasks; the pieces of a node
    then stream through one hash.
    """

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, first, held, size = None, 0, [], 0
        for batch in batches:
            out = []
            for own, conv in zip(batch["node"].tolist(), batch["conv_id"].tolist()):
                if held and (own != node or size > PIECE):
                    out.append((node, first, ",".join(held)))
                    held, size = [], 0
                if not held:
                    node, first = own, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield pd.DataFrame(out, columns=["node", "first", "ids"])
        if held:
            yield pd.DataFrame([(node, first, ",".join(held))], columns=["node", "first", "ids"])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, sha = None, None
        for batch in batches:
            out = []
            for own, ids in zip(batch["node"].tolist(), batch["ids"].tolist()):
                if own == node:
                    sha.update(b",")
                else:
                    if sha is not None:
                        out.append((node, sha.hexdigest()))
                    node, sha = own, hashlib.sha256()
                sha.update(ids.encode())
            if out:
                yield pd.DataFrame(out, columns=["node", "ends_sha256"])
        if sha is not None:
            yield pd.DataFrame([(node, sha.hexdigest())], columns=["node", "ends_sha256"])

    pieces = (
        ends.repartitionByRange("node", "conv_id")
        .sortWithinPartitions("node", "conv_id")
        .mapInPandas(join, "node binary, first long, ids string")
    )
    return (
        pieces.repartition("node")
        .sortWithinPartitions("node", "first")
        .mapInPandas(digest, "node binary, ends_sha256 string")
    )


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(node, *values) summed over the subtree of each node, itself included.

    ``tree`` is (node, parent, *values); the root's parent is null. Only edge tables are joined, on
    node, which is unique, or on the parent after adding up by parent, so no key is hot.
    """
    sums = [F.sum(v).alias(f"{v}_more") for v in values]
    plus = {v: F.col(v) + F.coalesce(f"{v}_more", F.lit(0)) for v in values}
    live = staged(tree.select("node", "parent", *values), "trie-live")
    raked, spliced = [], []
    while live.limit(2).count() > 1:
        # rake: leaves go, their parents get their sums
        kids = live.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"))
        counted = staged(live.join(kids, "node", "left").fillna(0, ["kids"]), "trie-counted")
        leaf = (F.col("kids") == 0) & F.col("parent").isNotNull()
        leaves = counted.filter(leaf)
        raked.append(leaves.select("node", *values))
        gains = leaves.groupBy(F.col("parent").alias("node")).agg(*sums, F.count(F.lit(1)).alias("gone"))
        rest = counted.filter(~leaf).join(gains, "node", "left").withColumns(plus)
        rest = rest.withColumn("kids", F.col("kids") - F.coalesce("gone", F.lit(0)))
        rest = staged(rest.select("node", "parent", "kids", *values), "trie-raked")
        # compress: each unary node jumps down its chain; both tables of a join are keyed by node
        unary = rest.filter("kids = 1 and parent is not null")
        below = rest.filter("parent is not null").select(F.col("node").alias("next"), F.col("parent").alias("node"))
        jumps = staged(unary.join(below, "node").select("node", "parent", "next", *values), "trie-jumps")
        chain = jumps
        while True:
            ahead = chain.select(F.col("node").alias("next"), F.col("next").alias("after"), *[F.col(v).alias(f"{v}_more") for v in values])
            longer = chain.join(ahead, "next", "left").withColumns(plus)
            longer = longer.select("node", "parent", F.coalesce("after", "next").alias("next"), F.col("after").isNotNull().alias("moved"), *values)
            longer = staged(longer, "trie-jumps")
            chain = longer.drop("moved")
            if longer.filter("moved").limit(1).count() == 0:
                break
        spliced.append(chain.select("node", "next", *values))
        tops = chain.join(unary.select(F.col("node").alias("parent")), "parent", "left_anti")
        tops = staged(tops.select("parent", F.col("next").alias("node"), *values), "trie-tops")
        gains = tops.groupBy(F.col("parent").alias("node")).agg(*sums)
        moved = tops.select("node", F.col("parent").alias("up"))
        live = rest.join(unary.select("node"), "node", "left_anti").join(gains, "node", "left").join(moved, "node", "left")
        live = live.withColumns(plus).select("node", F.coalesce("up", "parent").alias("parent"), *values)
        live = staged(live, "trie-live")
    known = live.select("node", *values)
    # back: the node below a chain was removed in a later round
    for leaves, chain in zip(reversed(raked), reversed(spliced)):
        ends = known.select(F.col("node").alias("next"), *[F.col(v).alias(f"{v}_more") for v in values])
        full = staged(chain.join(ends, "next").withColumns(plus).select("node", *values), "trie-expanded")
        known = known.unionByName(full).unionByName(leaves)
    return known


def trie(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the prefix tree of conversations.

    ``turns`` is (conv_id, depth from 1, h0, h1, bytes), ``lengths`` (conv_id, length) names every
    conversation, also those without turns. Columns: node, parent, conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens of the subtree, and
    ends_sha256 of the members that end here.
    """
    path = staged(steps(turns), "trie-steps")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(
        _root_name().alias("node"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("depth"),
        "conv_id",
        "n_convs",
        F.lit(0).cast("long").alias("bytes"),
    )
    found = path.groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes")
    )
    nodes = root.unionByName(found)
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(nodes.join(children, "node", "left").fillna(0, ["n_children"]), "trie-nodes")
    own = nodes.select(
        "node",
        "parent",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    last = path.join(lengths, "conv_id").filter("depth = length").select("node", "conv_id")
    ends = last.unionByName(lengths.filter("length = 0").select(_root_name().alias("node"), "conv_id"))
    parents = nodes.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(totals, "node")
        .join(_ends(ends), "node", "left")
        .join(parents, "parent", "left")
        .select(
            "node",
            "parent",
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame, rebuild: bool = False) -> DataFrame:
    """``trie`` of (conv_id, turn, role, text); ``rebuild`` gives conversations shared beginnings first.

    Repeated rows are turns of their own. An empty table has no nodes. Texts are hashed whole.
    """
    turns = staged(ordered_turns(conversations), "trie-ordered")
    if rebuild:
        lengths, turns = rebuilt(turns)
        return trie(lengths, turns)
    lengths = staged(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length")), "trie-conversations")
    return trie(lengths, turns.withColumn("depth", F.col("pos") + 1).drop("pos"))
