"""Near-duplicates by bottom-k sketches of two-word shingles.

One hash function orders all shingles; the sketch of a document is its ``K`` least hashes, and all
of them where it has no more. Inverted lists of retained values bring documents together:

- Sets of up to ``K`` shingles are whole in their sketch. Partners at 0.8 share one of the rarest
  n - ceil(0.8 n) + 1 of them, so these are the keys of their lists.
- Retained values of larger sets are dealt to ``CELLS`` cells by their hash, and the values of a
  cell together are the key. Two linked sketches of 128 differ in few values, so many of their
  cells are equal, while unrelated texts seldom agree in two values of one cell.

Lists are not squared. Rows of a list first meet its centre, the row whose lists are longest: in a
group of copies that is the text the others were made from. Components of these links are found,
and only rows that still lie in different components are paired. A list of more than ``LONG`` rows
in several components comes from a passage that unrelated texts share. A row with at least ``FREE``
cells outside such lists meets its partners there; the others meet in lists of their rarest values,
or, in groups where these are long as well, in a blocked product of their full sets.

Pairs are estimated on the bottom k of the union of both sketches, and what passes is confirmed on
full sets. An estimate of ``LEAST``/``K`` lets a true link fail with a probability under 1e-9. Two
linked texts in crowded lists only miss each other if none of their other cells is equal: with
``FREE`` cells under 1e-6 for texts of one size, 1e-4 at the very threshold when one set holds the
other. Everything else is exact up to collisions of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.block_product import linked_in_groups
from tidemark.llm.common import slices, small_side, staged, whole
from tidemark.llm.components import components
from tidemark.llm.ngram_join import Shingler, node_of

K, LEAST = 128, 74
CELLS = 64
LONG, FREE = 64, 32
ORDER_BITS = 18
#: Kinds of lists.
CELL, VALUE = 0, 1

_TOP = np.uint64(1 << 63)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _signed(hashes: np.ndarray) -> np.ndarray:
    """As signed numbers in the same order."""
    return (hashes ^ _TOP).view(np.int64)


def _sketches(texts: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, node, sketch) of each row; node and sketch are null without words."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in slices(batches, "text", 4 << 20):
            n, nodes, held = [], [], []
            for text in batch.column("text").to_pylist():
                own = shingler(text)
                n.append(len(own))
                nodes.append(node_of(own) if len(own) else None)
                held.append(_signed(own[:K]) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.array(held, pa.list_(pa.int64()))],
                ["doc_id", "n", "node", "sketch"],
            )

    return texts.mapInArrow(run, f"doc_id {kind}, n long, node binary, sketch array<long>")


def _bucket(values: np.ndarray) -> np.ndarray:
    return ((values.view(np.uint64) ^ _TOP) >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def _bucket_counts(classes: DataFrame) -> np.ndarray:
    """How often values are retained, by 2^ORDER_BITS buckets, whatever the size of the corpus."""
    flipped = F.col("v").bitwiseXOR(F.lit(-(1 << 63)))
    bucket = F.shiftrightunsigned(flipped, 64 - ORDER_BITS).alias("bucket")
    found = classes.select(F.explode("sketch").alias("v")).groupBy(bucket).agg(F.count(F.lit(1)).alias("k")).toPandas()
    counts = np.zeros(1 << ORDER_BITS, np.int64)
    counts[found["bucket"].to_numpy(np.int64)] = found["k"].to_numpy(np.int64)
    return counts


def needed(n: int, percent: int) -> int:
    """Values that a sketch shares with that of any linked set, for a set of n shingles."""
    return min(LEAST, -(-percent * n // 100))


def cells_of(sketch: np.ndarray) -> np.ndarray:
    """Keys of the cells that hold two values or more."""
    values = sketch.view(np.uint64) ^ _TOP
    cell = (values % np.uint64(CELLS)).astype(np.int64)
    mixed = np.zeros(CELLS, np.uint64)
    np.add.at(mixed, cell, (values >> np.uint64(6)) * _ODD)
    held = np.flatnonzero(np.bincount(cell, minlength=CELLS) > 1)
    return (mixed[held] * np.uint64(CELLS) + held.astype(np.uint64)).view(np.int64)


def _postings(classes: DataFrame, counts: np.ndarray, percent: int, crowded: bool = False) -> DataFrame:
    """(kind, value, node, n, rest, cells): the lists that a set is in.

    ``rest`` is the number of retained values from this one on, in the order from rare to frequent.
    ``crowded`` gives the rarest values of any set instead.
    """
    sent = classes.sparkSession.sparkContext.broadcast(counts)
    names = ["kind", "value", "node", "n", "rest", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sent.value
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in names}
            rows = zip(batch.column("node").to_pylist(), batch.column("n").to_pylist(), batch.column("sketch"))
            for node, n, sketch in rows:
                sketch = sketch.values.to_numpy()
                lists = []
                own = cells_of(sketch) if percent * K <= 100 * n else sketch[:0]
                if len(own) and not crowded:
                    lists.append((CELL, own, np.zeros(len(own), np.int32)))
                if n <= K or crowded:
                    least = needed(n, percent) if crowded else -(-percent * n // 100)
                    first = np.argsort(seen[_bucket(sketch)], kind="stable")[: len(sketch) - least + 1]
                    lists.append((VALUE, sketch[first], len(sketch) - np.arange(len(first))))
                for kind, values, rest in lists:
                    size = len(values)
                    columns["kind"].append(np.full(size, kind, np.int32))
                    columns["value"].append(values)
                    columns["node"] += [node] * size
                    columns["n"].append(np.full(size, n))
                    columns["rest"].append(rest.astype(np.int32))
                    columns["cells"].append(np.full(size, len(own), np.int32))
            if columns["node"]:
                arrays = [pa.array(columns[c], pa.binary()) if c == "node" else pa.array(np.concatenate(columns[c])) for c in names]
                yield pa.RecordBatch.from_arrays(arrays, names)

    light = classes.select("node", "n", "sketch")
    return light.mapInArrow(run, "kind int, value long, node binary, n long, rest int, cells int")


def _met(postings: DataFrame) -> DataFrame:
    """The postings of lists of two rows or more, with the length of the list."""
    lists = postings.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return postings.join(lists, ["kind", "value"])


def _fit(a: str, b: str, percent: int) -> Column:
    """Rows in different components whose sizes, and whose places in a list of values, allow a link."""
    n_a, n_b = F.col(f"n_{a}"), F.col(f"n_{b}")
    rest = F.least(f"rest_{a}", f"rest_{b}")
    both_whole = F.greatest(n_a, n_b) <= K
    follows = F.when(both_whole, (100 + percent) * rest >= percent * (n_a + n_b)).otherwise(rest >= LEAST)
    return (
        (F.col(f"root_{a}") != F.col(f"root_{b}"))
        & (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))
        & ((F.col("kind") == CELL) | follows)
    )


_ROW = ("node", "n", "rest", "root")


def _side(rows: DataFrame, name: str, extra: list[str]) -> DataFrame:
    return rows.select("kind", "value", *[F.col(c).alias(f"{c}_{name}") for c in (*_ROW, *extra)])


def _pairs(left: DataFrame, right: DataFrame, percent: int, apart: str | None = None) -> DataFrame:
    """(a, b) of rows of one list, smaller node first; a pair of several lists comes several times.

    Rows that agree in the column ``apart`` make no pair.
    """
    fit = _fit("a", "b", percent)
    if left is right:
        fit = (F.col("node_a") < F.col("node_b")) & fit
    extra = [] if apart is None else [apart]
    if apart:
        fit = fit & F.coalesce(F.col(f"{apart}_a") != F.col(f"{apart}_b"), F.lit(True))
    both = _side(left, "a", extra).join(_side(right, "b", extra), ["kind", "value"]).filter(fit)
    return both.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def _with_centres(lying: DataFrame, by: Column, percent: int) -> DataFrame:
    """Each row of a list with the row that is greatest ``by``."""
    top = lying.groupBy("kind", "value").agg(F.max(F.struct(by.alias("by"), *_ROW)).alias("top"))
    return _pairs(lying, top.select("kind", "value", "top.*"), percent).distinct()


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches allow a link."""

    def side(x: str) -> DataFrame:
        return classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common, every = F.array_intersect("s_a", "s_b"), F.array_union("s_a", "s_b")
    least = F.slice(F.array_sort(every), 1, K)
    exact = 100 * F.size(common) >= percent * F.size(every)
    estimate = F.size(F.array_intersect(common, least)) >= LEAST
    return both.filter(F.when(F.greatest("n_a", "n_b") <= K, exact).otherwise(estimate)).select("a", "b")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in slices(batches, "text", 2 << 20):
            sets = [shingler(t) for t in batch.column("text").to_pylist()]
            held = [s.view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s) for s in sets], pa.binary()), pa.array(held, pa.list_(pa.int64()))],
                ["node", "shingles"],
            )

    return texts.select("text").mapInArrow(run, "node binary, shingles array<long>")


def _full_sets(nodes: DataFrame, classes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the nodes, made again from their texts."""
    named = classes.join(nodes, "node", "left_semi").select("node", F.col("first_id").alias("fid"))
    ids = small_side(staged(named.select("fid").distinct(), "dedup-ids"))
    involved = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("fid")), "left_semi")
    # rows that share an id may hold one set twice
    return staged(_sets(involved, size), "dedup-sets").join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _full_sets(nodes, classes, texts, size)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b")


def _dense(rare: DataFrame, crowded: DataFrame) -> DataFrame:
    """(hub) of the groups whose rows meet so often in lists of values that comparing all is less work."""
    meetings = rare.groupBy("hub", "value").agg(F.count(F.lit(1)).cast("double").alias("k"))
    meetings = meetings.groupBy("hub").agg(F.sum(F.col("k") * F.col("k")).alias("meetings"))
    sizes = crowded.groupBy("hub").agg(F.count(F.lit(1)).cast("double").alias("rows"))
    return meetings.join(sizes, "hub").filter(F.col("meetings") > F.col("rows") * F.col("rows")).select("hub")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable by links, itself included; ``kept`` says that
    it is the row's own. Words are split by white space after A-Z are lowered; a text with fewer
    than ``size`` words is one shingle; null texts and texts without words have none, are linked
    with nothing and are kept. Repeated rows have equal sets and share a component. Rows with a null
    id are compared like others; their component is the smallest id of its rows, null if there is
    none, and only then are they kept. Columns other than the two named are not read. Texts are read
    whole, whatever their length. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    rows = staged(_sketches(texts, size), "dedup-rows")
    classes = staged(
        rows.filter("n > 0")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.count(F.lit(1)).alias("members"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
        ),
        "dedup-classes",
    )
    counts = _bucket_counts(classes)
    met = staged(_met(_postings(classes, counts, percent)), "dedup-lists")

    def linked(pairs: DataFrame) -> DataFrame:
        close = staged(_estimated(staged(pairs, "dedup-pairs"), classes, percent), "dedup-close")
        return staged(_confirmed(close, classes, texts, size, percent), "dedup-links")

    def split(joined: DataFrame) -> DataFrame:
        """The lists whose rows lie in several components."""
        rooted = met.join(small_side(staged(joined, "dedup-components")), "node", "left")
        rooted = rooted.withColumn("root", F.coalesce("root", "node"))
        spread = rooted.groupBy("kind", "value").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        spread = spread.filter("low != high").select("kind", "value")
        return staged(rooted.join(spread, ["kind", "value"]), "dedup-lying")

    weights = met.groupBy("node").agg(F.sum("rows").alias("weight"))
    weighed = met.join(weights, "node").withColumn("root", F.col("node"))
    links = linked(_with_centres(weighed, F.col("weight"), percent))
    joined = components(links)
    lying = split(joined)
    again = linked(_with_centres(lying, F.xxhash64("node"), percent))
    if again.limit(1).count():
        links = links.union(again)
        joined = components(links)
        lying = split(joined)

    # what is left: pairs of rows in different components
    paired = lying.filter((F.col("kind") == VALUE) | (F.col("rows") <= LONG))
    rest = _pairs(paired, paired, percent)
    in_long = met.filter((F.col("kind") == CELL) & (F.col("rows") > LONG))
    in_long = in_long.groupBy("node").agg(F.count(F.lit(1)).alias("long"), F.first("cells").alias("cells"))
    crowded = lying.filter((F.col("kind") == CELL) & (F.col("rows") > LONG)).select("node", "root").distinct()
    crowded = crowded.join(in_long.filter(F.col("cells") - F.col("long") < FREE), "node", "left_semi")
    # the row whose lists are longest, of those that share a long list with a row
    tops = weighed.filter((F.col("kind") == CELL) & (F.col("rows") > LONG))
    tops = tops.groupBy("value").agg(F.max(F.struct("weight", "node")).alias("top"))
    hubs = weighed.filter(F.col("kind") == CELL).select("node", "value").join(tops, "value")
    hubs = hubs.groupBy("node").agg(F.max("top")["node"].alias("hub"))
    crowded = staged(crowded.join(hubs, "node"), "dedup-crowded")
    own = classes.join(crowded.select("node"), "node", "left_semi")
    rare = staged(_met(_postings(own, counts, percent, crowded=True)).join(crowded, "node"), "dedup-rare")
    dense = staged(_dense(rare, crowded), "dedup-dense")
    rare = rare.join(small_side(dense.withColumn("group", F.col("hub"))), "hub", "left")
    rest = staged(rest.union(_pairs(rare, rare, percent, apart="group")).distinct(), "dedup-rest")
    grouped = crowded.join(small_side(dense), "hub", "left_semi")
    sets = _full_sets(grouped.select("node"), classes, texts, size)
    more = linked(rest).union(linked_in_groups(grouped, sets, percent))
    if more.limit(1).count():
        joined = components(links.union(more))

    reach = classes.select("node", "members", "first_id").join(joined, "node", "left")
    reach = reach.withColumn("root", F.coalesce("root", "node"))
    least = reach.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("members").alias("all"))
    shared = staged(reach.join(least.filter("all > 1"), "root").select("node", "component_id"), "dedup-shared")
    result = rows.select("doc_id", "n", "node").join(small_side(shared), "node", "left")
    return result.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"),
    )
