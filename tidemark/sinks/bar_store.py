"""The bar store: Parquet partitioned by the date and hour in which a bar ended."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.prices import SCALE
from tidemark.session import work_dir
from tidemark.sources.files import read_store_hours, store_hours

PRICES = ("open", "high", "low", "close")


@dataclass(frozen=True)
class PersistResult:
    scanned: int
    written: int
    deduped: int


def store_rows(bar_log: DataFrame, scale: int = SCALE) -> DataFrame:
    """Bars with their prices as doubles and the partition columns."""
    prices = {c: F.col(f"{c}_fixed").cast("double") / F.lit(float(scale)) for c in PRICES}
    return bar_log.withColumns(
        {
            **prices,
            "date": F.to_date("bar_end"),
            "hour": F.hour("bar_end"),
        }
    )


def _stored(spark: SparkSession, path: str, touched: DataFrame) -> DataFrame | None:
    """What the store holds of the touched hours; None if nothing."""
    if not _few(touched):
        known = store_hours(spark, path)
        whole = read_store_hours(spark, path, known)
        if whole is None:
            return None
        return whole.withColumn("date", F.col("date").cast("date")).join(touched, ["date", "hour"], "left_semi")
    wanted = {(r.date.isoformat(), r.hour) for r in touched.collect()}
    present = store_hours(spark, path, sorted({day for day, _ in wanted}))
    found = read_store_hours(spark, path, [h for h in present if h in wanted])
    return None if found is None else found.withColumn("date", F.col("date").cast("date"))


def persist_bars(bar_log: DataFrame, path: str, *, scale: int = SCALE) -> PersistResult:
    """Merge bars into the store: one row per source, symbol and bar end, the new one winning.

    Only the folders of the hours touched are opened, read and rewritten. The merged hours are staged
    in the shared working folder first, since a path cannot be read and
    overwritten at once; running the same bars again changes nothing. Large
    hours are split over several files.
    """
    spark = bar_log.sparkSession
    incoming = store_rows(bar_log, scale)
    stage_new = work_dir(spark, "bars-in")
    incoming.write.parquet(stage_new)
    incoming = spark.read.schema(incoming.schema).parquet(stage_new)
    scanned = incoming.count()
    if scanned == 0:
        return PersistResult(0, 0, 0)

    touched = incoming.select("date", "hour").distinct()
    merged = incoming.withColumn("_rank", F.lit(1))
    kept = _stored(spark, path, touched)
    if kept is not None:
        merged = merged.unionByName(kept.withColumn("_rank", F.lit(0)), allowMissingColumns=True)
    names = [c for c in ("source", "symbol", "bar_end") if c in merged.columns]
    keys = ["date", "hour", *names]
    rest = [c for c in merged.columns if c not in (*keys, "_rank")]
    newest = F.struct("_rank", F.coalesce(F.col("seq"), F.lit(0)) if "seq" in rest else F.lit(0))
    single = (
        merged.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), newest).alias("_bar"))
        .select(*keys, "_bar.*")
    )
    stage_all = work_dir(spark, "bars-out")
    single.write.parquet(stage_all)

    staged = spark.read.schema(single.schema).parquet(stage_all)
    written = incoming.select(*[c for c in names if c in incoming.columns]).distinct().count()
    (
        staged.hint("rebalance", "date", "hour")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "hour")
        .parquet(path)
    )
    return PersistResult(scanned, written, scanned - written)


def _few(touched: DataFrame, most: int = 100_000) -> bool:
    """Whether the touched hours are few enough to be listed one by one."""
    return touched.limit(most + 1).count() <= most
