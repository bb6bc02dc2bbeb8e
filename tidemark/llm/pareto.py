"""Mixing sources to target weights: whole copies first, then Pareto order sampling.

A source whose target is m times its size gives every document floor(m) certain copies. The rest
of the target is drawn by Pareto order sampling: each document has an inclusion probability that
grows with the square root of its size, and documents are taken in order of random odds divided by
inclusion odds until the words drawn reach the rest. Probabilities of 1 and more are certain.

The order of a source is never sorted in one task. Ratios are counted in 4096 bins per source, the
bin in which the rest is reached is cut into 4096 again, and only the documents of that last cell
are numbered one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.llm.common import WORD, small_side, staged, whole
from tidemark.operators.ordinals import number_rows

BINS = 4096

#: Equal rows that one task numbers at a time.
RUN = 1 << 16


def n_words(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def chance(doc_id: Column, size: Column, number: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the id, the size, the number among equal rows and the seed alone."""
    named = F.coalesce(doc_id.cast("string"), F.lit("null"))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), named, size.cast("string"), number.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / F.lit(2.0**52)


def one_by_one(groups: DataFrame, run: int = RUN) -> DataFrame:
    """Each row as often as its column ``rows`` says, with ``number`` from 0 in its place.

    Large groups are cut into runs that different tasks number.
    """
    few = groups.filter(F.col("rows") <= run).withColumn("first", F.lit(0).cast("long"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(run).cast("long"))
    many = groups.filter(F.col("rows") > run).withColumn("first", F.explode(starts)).repartition(*groups.columns, "first")
    numbers = F.sequence(F.col("first"), F.least(F.col("first") + run, F.col("rows")) - 1)
    return few.unionByName(many).withColumn("number", F.explode(numbers)).drop("first", "rows")


def targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``sizes`` (source, source_size) with each source's target.

    Sources take the weights in turn, by code point, null last. Together the targets are all
    words; a target stops at ``most`` times its source's size and the excess is shared by weight
    among the others, until none is above. That fixed point is a water level: sources are filled
    in the order of their cap per weight.

    One row per source goes through a window without a key.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (((F.row_number().over(order) - 1) % len(weights)) + 1).cast("int")
    )
    filled = W.orderBy("reach", F.col("source").asc_nulls_last())
    every = W.partitionBy()
    level = (F.col("total") - (F.col("caps") - F.col("cap"))) / (F.col("weights") - (F.col("weights_filled") - F.col("weight")))
    open_ = F.col("level") < F.col("reach")
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", (F.col("source_size") * most).cast("double"))
        .withColumn("reach", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every).cast("double"))
        .withColumn("weights", F.sum("weight").over(every))
        .withColumn("caps", F.sum("cap").over(filled))
        .withColumn("weights_filled", F.sum("weight").over(filled))
        # the level if this source and all after it in this order are not capped
        .withColumn("level", level)
        .withColumn("final", F.min(F.when(open_, F.struct("reach", "source", "level"))).over(every)["level"])
        .select(
            "source",
            "source_size",
            F.coalesce(F.least("cap", F.col("weight") * F.col("final")), F.col("cap")).alias("target"),
        )
    )


def _reached(cells: DataFrame, keys: list[str], cell: str, words: str, goal: str) -> DataFrame:
    """Per key the first cell, in order, in which the running words reach the goal, and the words before it."""
    order = W.partitionBy(*keys).orderBy(cell)
    run = cells.withColumn("upto", F.sum(words).over(order))
    return (
        run.filter(F.col("upto") >= F.col(goal))
        .groupBy(*keys)
        .agg(F.min(F.struct(cell, (F.col("upto") - F.col(words)).alias("before"))).alias("hit"))
        .select(*keys, F.col(f"hit.{cell}").alias(f"cut_{cell}"), F.col("hit.before").alias(f"before_{cell}"))
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: int = 17,
) -> DataFrame:
    """Copies of each row: (doc_id, size, source_size, target, copies, taken, source, number), one row per row of ``docs``.

    ``size`` counts the words of the whole text (null: 0), ``taken`` is ``copies`` times ``size``.
    A null source is a source of its own. Rows without words get the certain copies of their
    source alone. Rows that agree in source, id (null is an id too) and size are numbered from 0 and
    each is a choice of its own, with its own random number. Ties of the ratio are taken by id (null
    first), size, then number. No row gets more than ``most`` copies. The same rows
    and seed give the same copies, however they are spread over files. An empty table gives an
    empty result; columns other than the three named are not read.

    Words drawn in order stop short of the target at the first document that no longer fits; the
    one document outside the draw that fills the gap best is added if that brings the words nearer.
    """
    spark = docs.sparkSession
    picked = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")
    )
    # equal rows are counted before they are moved, and told apart by their number afterwards
    groups = picked.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    groups = staged(groups.withColumn("pull", F.floor(F.sqrt("size")).cast("long")), "mix-sizes")
    words = F.col("size") * F.col("rows")
    per_source = groups.groupBy("source").agg(F.sum(words).alias("source_size"), F.sum(words * F.col("pull")).alias("pulled"))
    sized = one_by_one(groups)
    goals = targets(per_source.select("source", "source_size"), weights, most)
    goals = goals.join(per_source.select("source", "pulled"), goals.source.eqNullSafe(per_source.source)).drop(per_source.source)
    whole_copies = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    goals = staged(
        goals.withColumn("certain", whole_copies.cast("int"))
        .withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size"))
        .select("source", "source_size", "pulled", "target", "certain", "rest"),
        "mix-targets",
    )
    goal_side = small_side(goals.withColumnRenamed("source", "of"))
    # inclusion probabilities, then the ratio of odds, brought to [0, 1)
    joined = sized.join(goal_side, sized.source.eqNullSafe(F.col("of"))).drop("of")
    likely = F.try_divide(F.col("rest") * F.col("pull"), F.col("pulled"))
    luck = chance(F.col("doc_id"), F.col("size"), F.col("number"), seed)
    ratio = F.when(F.col("likely") < 1, (F.col("luck") / (1 - F.col("luck"))) / (F.col("likely") / (1 - F.col("likely")))).otherwise(0.0)
    draws = (F.col("rest") > 0) & (F.col("size") > 0) & (F.col("certain") < most)
    ranked = (
        joined.withColumn("likely", likely)
        .withColumn("luck", luck)
        .withColumn("ratio", F.when(draws, ratio))
        .withColumn("place", F.col("ratio") / (1 + F.col("ratio")) * BINS)
        .withColumn("bin", F.least(F.floor("place"), F.lit(BINS - 1)).cast("int"))
        .withColumn("cell", F.least(F.floor((F.col("place") - F.col("bin")) * BINS), F.lit(BINS - 1)).cast("int"))
        .drop("likely", "luck", "place", "pulled", "pull")
    )
    ranked = staged(ranked, "mix-ranked")
    drawn = ranked.filter(F.col("ratio").isNotNull()).withColumn("source", F.struct("source"))
    key = ["source", "rest"]
    bins = _reached(drawn.groupBy(*key, "bin").agg(F.sum("size").alias("words")), key, "bin", "words", "rest")
    bins = staged(bins, "mix-bins")
    in_bin = drawn.join(small_side(bins), key).filter(F.col("bin") == F.col("cut_bin"))
    in_bin = in_bin.withColumn("left", F.col("rest") - F.col("before_bin"))
    key2 = ["source", "left"]
    cells = _reached(in_bin.groupBy(*key2, "cell").agg(F.sum("size").alias("words")), key2, "cell", "words", "left")
    in_cell = in_bin.join(cells, key2).filter(F.col("cell") == F.col("cut_cell"))
    # number the documents of the last cell; those that still fit are drawn
    order = W.partitionBy("source").orderBy("ratio", F.col("doc_id").asc_nulls_first(), "size", "number")
    last = in_cell.withColumn("gap", F.col("left") - F.col("before_cell")).withColumn(
        "upto", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    best = last.groupBy("source").agg(
        F.max(F.when(F.col("upto") <= F.col("gap"), F.struct("upto", "ratio", "doc_id", "size", "number"))).alias("stop"),
        F.max("gap").alias("gap"), F.max("cut_bin").alias("cut_bin"), F.max("cut_cell").alias("cut_cell"),
    )
    cuts = best.select(
        F.col("source.source").alias("of"), "cut_bin", "cut_cell",
        F.coalesce(F.col("stop.ratio"), F.lit(-1.0)).alias("stop_ratio"),
        F.col("stop.doc_id").alias("stop_id"), F.col("stop.size").alias("stop_size"), F.col("stop.number").alias("stop_number"),
        (F.col("gap") - F.coalesce(F.col("stop.upto"), F.lit(0))).alias("open"),
    )
    cuts = staged(cuts, "mix-cuts")
    placed = ranked.join(small_side(cuts), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    stop = F.col("stop_ratio")
    same_id = F.col("doc_id").eqNullSafe(F.col("stop_id"))
    up_to_stop = (F.col("size") < F.col("stop_size")) | (
        (F.col("size") == F.col("stop_size")) & (F.col("number") <= F.col("stop_number"))
    )
    lower_id = F.when(F.col("doc_id").isNull(), F.col("stop_id").isNotNull()).otherwise(
        F.coalesce(F.col("doc_id") < F.col("stop_id"), F.lit(False))
    )
    at_stop = (F.col("ratio") == stop) & (lower_id | (same_id & up_to_stop))
    before = (F.col("bin") < F.col("cut_bin")) | ((F.col("bin") == F.col("cut_bin")) & (F.col("cell") < F.col("cut_cell")))
    in_last = (F.col("bin") == F.col("cut_bin")) & (F.col("cell") == F.col("cut_cell")) & ((F.col("ratio") < stop) | at_stop)
    # without a cut the probabilities were all certain and every document is taken
    placed = placed.withColumn(
        "taken_once", F.when(F.col("ratio").isNull(), False).when(F.col("cut_bin").isNull(), True).otherwise(before | in_last)
    )
    # the one document that fills what is open best
    fits = F.col("ratio").isNotNull() & ~F.col("taken_once") & (F.abs(F.col("open") - F.col("size")) < F.abs("open"))
    extra = (
        placed.filter(fits)
        .groupBy("source")
        .agg(F.min(F.struct(F.abs(F.col("open") - F.col("size")).alias("miss"), "doc_id", "size", "number")).alias("x"))
        .select(
            F.col("source").alias("of"), F.col("x.doc_id").alias("extra_id"),
            F.col("x.size").alias("extra_size"), F.col("x.number").alias("extra_number"),
        )
    )
    extra = small_side(staged(extra, "mix-extra"))
    done = placed.join(extra, F.col("source").eqNullSafe(F.col("of")), "left")
    chosen = ~F.col("taken_once") & F.col("ratio").isNotNull() & F.col("extra_size").isNotNull()
    chosen = chosen & F.col("doc_id").eqNullSafe(F.col("extra_id")) & (F.col("size") == F.col("extra_size"))
    chosen = chosen & (F.col("number") == F.col("extra_number"))
    copies = (F.col("certain") + F.when(F.col("taken_once") | chosen, 1).otherwise(0)).cast("int")
    return done.withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "source", "number"
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix` takes it, columns unchanged.

    Rows that agree in source, id and size get their numbers in the order of their content (a
    digest of all columns); rows that are equal throughout are interchangeable.
    """
    choices = mix(docs, id_col, text_col, source_col, **options)
    choices = choices.select(
        F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.col("size").alias("mix_size"), "number", "copies"
    )
    choices = staged(choices, "mix-copies")
    taken = small_side(choices.filter("copies > 0"))
    # columns by place, so that no name of the table clashes with one used here
    names = [f"c{i}" for i in range(len(docs.columns))]
    own_id, own_text, own_source = (names[docs.columns.index(c)] for c in (id_col, text_col, source_col))
    own = docs.toDF(*names).withColumn("words", n_words(F.col(own_text)))

    def same(other: DataFrame) -> Column:
        return (
            F.col(own_id).eqNullSafe(other["mix_id"])
            & F.col(own_source).eqNullSafe(other["mix_source"])
            & (F.col("words") == other["mix_size"])
        )

    repeated = choices.filter("number = 1").select("mix_id", "mix_source", "mix_size")
    rows = own.withColumn("ord", F.lit(0).cast("long"))
    if repeated.limit(1).count():
        repeated = small_side(repeated)
        several = own.join(repeated, same(repeated), "left_semi").select(
            *names,
            "words",
            F.struct(own_id, own_source, "words").alias("key"),
            F.md5(F.to_json(F.struct(*names)).cast("binary")).alias("content"),
            F.monotonically_increasing_id().alias("at"),  # spreads rows that are equal throughout
        )
        several = staged(several, "mix-repeated")
        numbered = number_rows(several, ["key"], ["content", "at"]).select(*names, "words", "ord")
        rows = own.join(repeated, same(repeated), "left_anti").withColumn("ord", F.lit(0).cast("long")).unionByName(numbered)
    out = rows.join(taken, same(taken) & (F.col("ord") == taken["number"]))
    return out.select(*names, F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("col").toDF(*docs.columns)
