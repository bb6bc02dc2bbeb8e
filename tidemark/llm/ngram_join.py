"""Documents whose sets of 5-word shingles overlap by a Jaccard similarity of 0.8 or more.

The join is a sparse product of the document by n-gram incidence matrix with its transpose, kept
sparse in three ways. Documents with equal sets are one row. Of each row only the columns that any
partner must share are multiplied: with n shingles, a partner at 0.8 holds at least ceil(0.8 n) of
them, hence one of any n - ceil(0.8 n) + 1; the rarest by corpus counts are taken. And products
that cannot reach the bound that the two sizes set are dropped before overlaps are counted.

The columns are dealt out by shingle; a column with very many rows is dealt to several tasks. Since
components are wanted and not pairs, a column is not squared: first each of its rows meets a few
rows, the column's centres, and the overlaps of these pairs give most links. Columns whose rows
still lie in several components after some rounds are multiplied out: groups whose columns are crowded
as a product of blocks of documents, which adds up overlap counts in the worker and sends on a forest of
links; other columns pair by pair between components. No link between two components is missed, and no
group of copies is paired up.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.llm.block_product import linked_in_groups
from tidemark.llm.common import slices, small_side, staged, whole
from tidemark.llm.components import components

#: Shingles are counted in 2^ORDER_BITS buckets; the counts only order columns from rare to frequent.
ORDER_BITS = 18
#: Columns that may hold more rows than this are dealt to several tasks.
COLUMN_ROWS = 8192
#: Rows that the others of a column meet in one round, and rounds of meeting.
CENTRES, ROUNDS = 4, 2


class _Words(dict):
    """64-bit hashes of words, held up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 150_000:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code


class Shingler:
    def __init__(self, size: int = 5):
        self.size, self._words = size, _Words()
        # odd multipliers of a fixed seed
        self._odd = np.random.default_rng(5).integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, text: str) -> np.ndarray:
        """Sorted 64-bit hashes of the distinct shingles; one for a text with fewer words; none without words."""
        words = text.encode().lower().split()  # bytes: only A-Z are lowered, only the six white spaces split
        if not words:
            return np.empty(0, np.uint64)
        codes = np.fromiter(map(self._words.__getitem__, words), np.uint64, len(words))
        width = min(self.size, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            mixed += codes[k : len(words) - width + 1 + k] * self._odd[k]
        mixed ^= mixed >> np.uint64(33)
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def node_of(shingles: np.ndarray) -> bytes:
    """The name of a set: equal sets have equal names (96 bits)."""
    return blake2b(shingles.tobytes(), digest_size=12).digest()


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))


def _rows(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, node) of each document, null without words, and one row of bucket counts per task."""
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, ids = Shingler(size), np.zeros(1 << ORDER_BITS, np.int64), None
        for batch in slices(batches, "text"):
            n, nodes = [], []
            for text in batch.column("text").to_pylist():
                own = shingler(text)
                n.append(len(own))
                nodes.append(node_of(own) if len(own) else None)
                np.add.at(seen, own >> np.uint64(64 - ORDER_BITS), 1)
            ids = batch.column("doc_id")
            none = pa.nulls(len(n), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), none, none], names)
        if ids is not None:
            columns = [pa.nulls(1, ids.type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
            buckets = np.flatnonzero(seen)
            columns += [pa.array([x], pa.list_(pa.int64())) for x in (buckets, seen[buckets])]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n", "node", "bucket", "seen"]
    return docs.mapInArrow(run, f"doc_id {kind.simpleString()}, n long, node binary, bucket array<long>, seen array<long>")


def _bucket_counts(rows: DataFrame) -> np.ndarray:
    """Counts of all shingles by bucket: 2^ORDER_BITS numbers, whatever the size of the corpus."""
    each = rows.filter(F.col("seen").isNotNull()).select(F.explode(F.arrays_zip("bucket", "seen")).alias("x"))
    found = each.groupBy(F.col("x.bucket").alias("bucket")).agg(F.sum("x.seen").alias("k")).toPandas()
    counts = np.zeros(1 << ORDER_BITS, np.int64)
    counts[found["bucket"].to_numpy()] = found["k"].to_numpy()
    return counts


def _postings(docs: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """(column, salt, salts, node, n, pos): the rarest shingles of a document, as many as a partner must share one of."""
    sent = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(size), sent.value
        usual = int(np.median(seen))
        for batch in slices(batches, "text", 2 << 20):
            parts: list[tuple] = []
            for text in batch.column("text").to_pylist():
                own = shingler(text)
                n = len(own)
                if not n:
                    continue
                take = n - -(-percent * n // 100) + 1
                often = seen[own >> np.uint64(64 - ORDER_BITS)]
                first = np.argsort(often, kind="stable")[:take]
                node = node_of(own)
                salts = 1 + np.maximum(0, often[first] - 2 * usual) // COLUMN_ROWS
                salt = int.from_bytes(node[:4]) % salts
                parts.append((own[first].view(np.int64), salt, salts, [node] * take, n, np.arange(take)))
            if parts:
                lengths = [len(p[0]) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([p[0] for p in parts])),
                        pa.array(np.concatenate([p[1] for p in parts]).astype(np.int32)),
                        pa.array(np.concatenate([p[2] for p in parts]).astype(np.int32)),
                        pa.array([x for p in parts for x in p[3]], pa.binary()),
                        pa.array(np.repeat([p[4] for p in parts], lengths).astype(np.int32)),
                        pa.array(np.concatenate([p[5] for p in parts]).astype(np.int32)),
                    ],
                    ["column", "salt", "salts", "node", "n", "pos"],
                )

    return docs.select("text").mapInArrow(run, "column long, salt int, salts int, node binary, n int, pos int")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in slices(batches, "text", 2 << 20):
            sets = [shingler(t) for t in batch.column("text").to_pylist()]
            held = [s.view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s) for s in sets], pa.binary()), pa.array(held, pa.list_(pa.int64()))],
                ["node", "shingles"],
            )

    return docs.select("text").mapInArrow(run, "node binary, shingles array<long>")


def _sizes_allow(n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def _overlap_allows(a: str, b: str, percent: int) -> Column:
    """If this is the first column that two rows share, enough columns follow in both of them."""
    rest = F.least(F.col(f"n_{a}") - F.col(f"pos_{a}"), F.col(f"n_{b}") - F.col(f"pos_{b}"))
    return (100 + percent) * rest >= percent * (F.col(f"n_{a}") + F.col(f"n_{b}"))


def _met_centres(lying: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): each row of a column with the column's centres, where they lie in different components.

    Centres are the rows with the least hashes under CENTRES seeds; a column that was dealt to
    several tasks has some in each, and those meet in one of them.
    """
    seeds = [F.lit(turn * CENTRES + k) for k in range(CENTRES)]
    least = [F.min(F.struct(F.xxhash64("node", seed).alias("h"), "node", "n", "pos", "root")) for seed in seeds]
    centres = lying.groupBy("column", "salt", "salts").agg(F.array_distinct(F.array(*least)).alias("c"))
    here = lying.select("column", "salt", *[F.col(c).alias(f"{c}_own") for c in ("node", "n", "pos", "root")])
    spread = centres.select("column", "salt", F.explode("c").alias("c"))
    spread = spread.select("column", "salt", *[F.col(f"c.{c}").alias(f"{c}_centre") for c in ("node", "n", "pos", "root")])
    near = here.join(spread, ["column", "salt"]).filter(
        (F.col("root_own") != F.col("root_centre"))
        & _sizes_allow(F.col("n_own"), F.col("n_centre"), percent)
        & _overlap_allows("own", "centre", percent)
    )
    pairs = near.select(F.least("node_own", "node_centre").alias("a"), F.greatest("node_own", "node_centre").alias("b"))
    parts = centres.filter("salts > 1").select("column", F.col("c")[0]["node"].alias("centre"))
    tops = parts.groupBy("column").agg(F.min("centre").alias("top"))
    across = parts.join(tops, "column").filter("top != centre").select(F.col("top").alias("a"), F.col("centre").alias("b"))
    return pairs.union(across).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose overlap is large enough, counted over all their shingles."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def _hubs(lying: DataFrame) -> DataFrame:
    """(hub, node, root): each row's hub is the row of the fullest columns among those it shares a column with."""
    rows = lying.join(lying.groupBy("column").agg(F.count(F.lit(1)).alias("rows")), "column")
    weighed = rows.join(rows.groupBy("node").agg(F.sum("rows").alias("weight")), "node")
    tops = weighed.groupBy("column").agg(F.max(F.struct("weight", "node")).alias("top"))
    met = lying.select("column", "node", "root").join(tops, "column")
    return met.groupBy("node", "root").agg(F.max("top")["node"].alias("hub"))


def _dense(lying: DataFrame, hubs: DataFrame) -> DataFrame:
    """(hub) of the groups whose rows meet so often in columns that comparing all is less work."""
    meetings = lying.groupBy("hub", "column").agg(F.count(F.lit(1)).cast("double").alias("k"))
    meetings = meetings.groupBy("hub").agg(F.sum(F.col("k") * F.col("k")).alias("meetings"))
    sizes = hubs.groupBy("hub").agg(F.count(F.lit(1)).cast("double").alias("rows"))
    return meetings.join(sizes, "hub").filter(F.col("meetings") > F.col("rows") * F.col("rows")).select("hub")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable by links, itself included. Words are split by
    white space after A-Z are lowered; a text with fewer than ``size`` words is one shingle; null
    texts and texts without words have none, are linked with nothing and are their own component.
    Repeated rows have equal sets and share a component. Rows with a null id are compared like
    others; their component is the smallest id of its rows, null if there is none. Columns other
    than the two named are not read. Texts are read whole, whatever their length. An empty table
    gives an empty result.

    Sets are compared by 64-bit hashes of shingles and 96-bit hashes of sets.
    """
    texts = _texts(docs, id_col, text_col)
    rows = staged(_rows(texts, size), "shingle-rows")
    counts = _bucket_counts(rows)
    rows = rows.filter(F.col("seen").isNull()).select("doc_id", "n", "node")
    classes = staged(
        rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("members")),
        "shingle-classes",
    )
    # one document of each set goes on
    firsts = small_side(classes.select(F.col("first_id").alias("fid")))
    chosen = texts.join(firsts, F.col("doc_id").eqNullSafe(F.col("fid")), "left_semi")
    postings = _postings(chosen, counts, size, percent)
    part = W.partitionBy("column", "salt")
    met = postings.withColumn("rows", F.count(F.lit(1)).over(part))
    met = staged(met.filter((F.col("rows") > 1) | (F.col("salts") > 1)).drop("rows"), "shingle-columns")
    held = met.groupBy("node").agg(F.max("n").alias("n"), F.collect_list("column").alias("columns"))
    held = staged(held, "shingle-held")

    def full_sets(nodes: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes, made again from their texts; ids that repeat bring others along."""
        ids = staged(classes.join(nodes, "node", "left_semi").select(F.col("first_id").alias("fid")).distinct(), "shingle-named")
        involved = texts.join(small_side(ids), F.col("doc_id").eqNullSafe(F.col("fid")), "left_semi")
        sets = staged(_sets(involved, size), "shingle-sets")
        # only ids that occur more than once can name a set twice
        if sets.groupBy("node").count().filter("count > 1").limit(1).count():
            sets = sets.dropDuplicates(["node"])
        return sets

    def overlapping(candidates: DataFrame) -> DataFrame:
        """The linked ones of the pairs (a, b).

        Columns that both hold among their rarest bound the overlap: the others follow the rarest
        of one of the two. Only what passes is compared by whole sets, made again from the texts.
        """
        left = held.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("columns").alias("c_a"))
        right = held.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("columns").alias("c_b"))
        others = F.greatest(*[F.ceil(F.col(n) * percent / 100) - 1 for n in ("n_a", "n_b")])
        most = F.size(F.array_intersect("c_a", "c_b")) + others
        both = candidates.join(right, "b").join(left, "a")
        both = both.filter((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")
        both = staged(both, "shingle-candidates")
        named = both.select(F.col("a").alias("node")).union(both.select(F.col("b").alias("node"))).distinct()
        return _linked(both, full_sets(named), percent)

    # each row of a column meets a few rows of it, chosen anew in each round; then only columns
    # whose rows lie in several components go on
    links, lying = None, met.withColumn("root", F.col("node"))
    for turn in range(ROUNDS):
        pairs = staged(_met_centres(lying, turn, percent), "shingle-pairs")
        found = staged(overlapping(pairs), "shingle-links")
        links = found if links is None else links.union(found)
        joined = components(links)
        lying = met.join(small_side(staged(joined, "shingle-components")), "node", "left")
        lying = lying.withColumn("root", F.coalesce("root", "node"))
        per_root = lying.groupBy("column", "root").agg(F.count(F.lit(1)).alias("k"))
        mixed = per_root.groupBy("column").agg(
            F.max(F.struct("k", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("roots")
        )
        mixed = small_side(staged(mixed.filter("roots > 1").select("column", "main"), "shingle-mixed"))
        lying = staged(lying.join(mixed, "column"), "shingle-lying")

    # what is left lies in columns of several components: rows of one hub in blocks where their columns
    # are crowded, other rows column by column
    hubs = staged(_hubs(lying), "shingle-hubs")
    dense = staged(_dense(lying.join(hubs.select("node", "hub"), "node"), hubs), "shingle-dense")
    grouped = staged(hubs.join(small_side(dense), "hub", "left_semi"), "shingle-grouped")
    group = grouped.select("node", F.col("hub").alias("group"))
    lying = lying.join(small_side(group), "node", "left")

    def side(x: str) -> DataFrame:
        own = [F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "pos", "root", "group")]
        return lying.select("column", *own, (F.col("root") == F.col("main")).alias(f"main_{x}"))

    few, every = side("a").filter(~F.col("main_a")), side("b")
    fit = (
        (F.col("root_a") != F.col("root_b"))
        & (F.col("main_b") | (F.col("node_a") < F.col("node_b")))
        & F.coalesce(F.col("group_a") != F.col("group_b"), F.lit(True))
        & _sizes_allow(F.col("n_a"), F.col("n_b"), percent)
        & _overlap_allows("a", "b", percent)
    )
    others = few.join(every, "column").filter(fit)
    others = staged(others.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "shingle-others")
    more = staged(overlapping(others), "shingle-more")
    blocked = linked_in_groups(grouped, full_sets(grouped.select("node")), percent)
    more = more.union(blocked.select("a", "b"))
    if more.limit(1).count():
        joined = components(links.union(more))

    reach = classes.join(joined, "node", "left").select("node", "members", "first_id", F.coalesce("root", "node").alias("root"))
    least = reach.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("members").alias("all"))
    shared = staged(
        reach.join(least.filter("all > 1"), "root").select("node", "component_id"), "shingle-shared"
    )
    result = rows.join(small_side(shared), "node", "left")
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that name their component: one document of each group, columns unchanged.

    Texts without words are groups of their own and stay. Of rows that agree in id and text one
    stays. Rows without an id stay if their component has no id either.
    """
    found = staged(near_duplicates(docs, id_col, text_col, size, percent), "near-duplicates")
    names = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id"))
    repeated = names.groupBy("kept_id").count().filter("count > 1").limit(1).count() > 0
    names = small_side(names.distinct() if repeated else names)
    kept = docs.join(names, docs[id_col].eqNullSafe(names["kept_id"]), "left_semi")
    return kept.dropDuplicates([id_col, text_col]) if repeated else kept
