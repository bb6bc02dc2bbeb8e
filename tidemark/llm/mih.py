"""Nearest neighbours by inner product: multi-index hashing of learned binary codes.

Vectors are scaled to unit length and coded by several rotations learned on a bounded sample
(iterative quantization: rotate so that signs lose least), one bit per rotated dimension. Codes are
cut into substrings of 16 bits and each substring of a block of rows has an index of its own. Two
codes within a Hamming radius r agree within r // m bits in one of the m substrings, so probing
every substring within that many bits finds every code of the ball. The radius of a query grows
until its ball holds ``enough`` codes of the block, found by a scan of the codes once that costs less
than more lookups; these are ranked by inner products of the
original vectors in double precision.

Rows and queries are dealt out in blocks and each pair of blocks is one group of bounded size.
Equal vectors are one row with the smallest of their ids, as many as an answer can need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.llm.common import staged

#: Bits of a substring.
PART = 16
_ONES = np.array([bin(i).count("1") for i in range(1 << PART)], np.uint8)
#: A block is scanned instead of probed once a step needs more lookups than this part of its rows.
SCAN_SHARE = 16
#: The patterns of flipped bits by their number.
_FLIPS = [np.flatnonzero(_ONES == flips) for flips in range(PART + 1)]


@dataclass
class Coder:
    """Mean and rotations; codes are rows of 16-bit substrings."""

    mean: np.ndarray
    rotations: list[np.ndarray]

    @classmethod
    def fit(cls, sample: np.ndarray, bits: int, rounds: int = 25, seed: int = 7) -> Coder:
        rng = np.random.default_rng(seed)
        mean = sample.mean(axis=0)
        centred = sample - mean
        dims = sample.shape[1]
        axes = np.linalg.eigh(centred.T @ centred)[1].T[::-1]
        rotations = []
        for _ in range(-(-bits // dims)):
            turn, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
            flat = centred @ axes.T
            for _ in range(rounds):
                signs = np.where(flat @ turn >= 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(flat.T @ signs)
                turn = left @ right
            rotations.append(axes.T @ turn)
        return cls(mean, rotations)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        bits = np.hstack([(vectors - self.mean) @ r >= 0 for r in self.rotations])
        bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % PART)))
        return np.packbits(bits, axis=1).view(np.uint16)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)


class MultiIndex:
    """One index for each substring over the codes of a block."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.m = codes, codes.shape[1]
        # of each substring the rows by value, where those of a value start, and the values that occur
        self.rows = [np.argsort(codes[:, j], kind="stable") for j in range(self.m)]
        self.starts = [np.searchsorted(codes[r, j], np.arange((1 << PART) + 1)) for j, r in enumerate(self.rows)]
        self.values = [np.flatnonzero(np.diff(s)) for s in self.starts]
        self.columns = np.ascontiguousarray(codes.T)

    def probe(self, code: np.ndarray, flips: int) -> np.ndarray:
        """The rows in the buckets of some substring with so many flipped bits; repeated if in several."""
        found = []
        for rows, starts, values, part in zip(self.rows, self.starts, self.values, code):
            # the patterns of flipped bits, or the occupied buckets if they are fewer
            if len(_FLIPS[flips]) <= len(values):
                wanted = _FLIPS[flips] ^ int(part)
            else:
                wanted = values[_ONES[values ^ int(part)] == flips]
            low = starts[wanted]
            sizes = starts[wanted + 1] - low
            # the places of all postings: each bucket counts on from its start
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            found.append(rows[np.repeat(low - ends + sizes, sizes) + np.arange(total)])
        return np.concatenate(found)

    def ball(self, code: np.ndarray, enough: int) -> np.ndarray:
        """All rows within the smallest radius that holds ``enough`` rows, all rows if there are fewer."""
        if enough >= len(self.codes):
            return np.arange(len(self.codes))
        probed = np.zeros(len(self.codes), bool)
        rows, distance = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for flips in range(PART + 1):
            # beyond that many lookups a scan of the codes costs less
            if self.m * len(_FLIPS[flips]) > len(self.codes) / SCAN_SHARE:
                break
            reached = np.zeros(len(self.codes), bool)
            reached[self.probe(code, flips)] = True
            new = np.flatnonzero(reached & ~probed)
            probed[new] = True
            rows = np.concatenate([rows, new])
            distance = np.concatenate([distance, _ONES[self.codes[new] ^ code].sum(axis=1, dtype=np.int64)])
            # every code within this radius has been probed
            near = distance[distance <= self.m * (flips + 1) - 1]
            if len(near) >= enough:
                return np.sort(rows[distance <= np.partition(near, enough - 1)[enough - 1]])
        distance = np.zeros(len(self.codes), np.uint16)
        for column, part in zip(self.columns, code):
            distance += _ONES[column ^ part]
        return np.flatnonzero(distance <= np.partition(distance, enough - 1)[enough - 1])


def _dense(index: MultiIndex, codes: np.ndarray, vectors: np.ndarray, rows: np.ndarray, enough: int, k: int):
    """For each query the ``k`` best rows of the block, ties to the earlier row."""
    for q, (code, vector) in enumerate(zip(codes, vectors)):
        near = index.ball(code, enough)
        score = inner(rows[near], vector)
        # stable: rows of a block are sorted by their smallest id
        best = np.argsort(-score, kind="stable")[:k]
        yield q, near[best], score[best]


def inner(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added in the order of the components."""
    total = np.zeros(len(rows))
    for d in range(rows.shape[1]):
        total += rows[:, d] * vector[d]
    return total


def clean(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part: finite, not zero, with an id."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), (~bad & F.exists(v, lambda x: x != 0)).alias("ok"))
    return rows.filter("vec_id is not null and ok").select("vec_id", "v")


def nearest(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, bits: int = 256,
    enough: int = 600, sample_rows: int = 20_000, block_rows: int = 16_384, block_queries: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row whose id is a multiple of ``every``.

    Nearest first, ties to the smaller id; a row is not its own neighbour. Vectors that are null,
    zero, or hold null or non-finite components take no part, nor do rows without an id. Vectors
    of another length than the most common one (the shortest, if several are) are searched among
    their like. Of rows that repeat an id and a vector one counts; an id with several vectors is a
    row for each. The codes are learned on at most ``sample_rows`` vectors, chosen by a hash;
    every row is indexed. Other columns are not read; an empty table gives an empty result.
    """
    spark = table.sparkSession
    rows = clean(table, id_col, vector_col).distinct()
    # a class of equal vectors, with as many ids as an answer can need: k, the query's own, and one more
    ranked = rows.withColumn("class", F.xxhash64("v")).withColumn(
        "place", F.row_number().over(W.partitionBy("class", "v").orderBy("vec_id"))
    )
    kept = staged(ranked.filter(F.col("place") <= k + 1).select("class", "v", "vec_id"), "mih-ids")
    classes = kept.groupBy("class", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = staged(classes.select(F.col("ids")[0].alias("first"), "v", "ids", F.size("v").alias("dims")), "mih-classes")
    # every query, also those of classes with more ids than are kept
    asks = staged(rows.filter(F.col("vec_id") % every == 0).withColumn("dims", F.size("v")), "mih-queries")
    result = None
    for row in classes.groupBy("dims").count().orderBy("dims").collect():
        own, queries = classes.filter(F.col("dims") == row["dims"]), asks.filter(F.col("dims") == row["dims"])
        # about 1.2 times the sample by hash, so that the tasks together send little more than it
        part = min(1.0, (1.2 * sample_rows + 1000) / row["count"])
        likely = own.filter(F.pmod(F.xxhash64("v", F.lit(7)), F.lit(1 << 31)) < int(part * (1 << 31)))
        sample = likely.orderBy(F.xxhash64("v"), "first").limit(sample_rows).select("v").toPandas()
        coder = Coder.fit(_unit(np.array(sample["v"].tolist(), float)), bits)
        n_blocks = -(-row["count"] // block_rows)
        found = _search(spark, own, queries, coder, n_blocks, k, enough, block_queries)
        result = found if result is None else result.union(found)
    if result is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = W.partitionBy("query_id", "asked").orderBy(F.col("score").desc(), "vec_id")
    top = result.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")


def _search(spark, own: DataFrame, queries: DataFrame, coder: Coder, n_blocks: int, k: int, enough: int, block_queries: int) -> DataFrame:
    """(query_id, asked, vec_id, score) of the best ``k`` rows of each block for each query."""
    sent = spark.sparkContext.broadcast(coder)
    row_block = F.pmod(F.xxhash64("first"), F.lit(n_blocks)).cast("int")
    n_queries = queries.count()
    q_blocks = max(1, -(-n_queries // block_queries))
    query_block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(q_blocks)).cast("int")
    # a block of rows meets every block of queries: the stated queries against all rows, in blocks
    rows = own.select(
        row_block.alias("row_block"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("query_block"), "first", "v", "ids"
    )
    asked = queries.select(
        query_block.alias("query_block"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("row_block"), "vec_id", "v"
    )

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"query_id": [], "asked": [], "vec_id": [], "score": []})
        coder = sent.value
        rows = rows.sort_values("first", kind="stable")
        vectors, ids = np.array(rows["v"].tolist(), float), rows["ids"].tolist()
        questions = np.array(asked["v"].tolist(), float)
        index = MultiIndex(coder.codes(_unit(vectors)))
        out = []
        codes = coder.codes(_unit(questions))
        names = asked["vec_id"].tolist()
        for q, near, score in _dense(index, codes, questions, vectors, enough, k + 1):
            hits = [(-s, i) for r, s in zip(near, score) for i in ids[r] if i != names[q]]
            out += [(names[q], q, i, -s) for s, i in sorted(hits)[:k]]
        frame = pd.DataFrame(out, columns=["query_id", "asked", "vec_id", "score"])
        # an id with several vectors asks for each of them
        own = {q: xxhash.xxh3_64_intdigest(questions[q].tobytes()) >> 1 for q in range(len(questions))}
        return frame.assign(asked=frame["asked"].map(own).astype("int64")) if len(frame) else frame

    grouped = rows.groupBy("row_block", "query_block").cogroup(asked.groupBy("row_block", "query_block"))
    return grouped.applyInPandas(run, "query_id long, asked long, vec_id long, score double")
