"""Run tables, reports and the event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import run_stamp
from tidemark.operators.shape import transpose
from tidemark.panel import Panel
from tidemark.schemas import EVENT


EVENT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_run(df: DataFrame, path: str, run_ts) -> None:
    """Store one run of a result. Runs are partitions; older ones stay where they are."""
    (
        df.withColumn("run_ts", run_stamp(F.lit(run_ts).cast("timestamp")))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_ts")
        .parquet(path)
    )


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest run of a result; the filter on the run prunes the read."""
    runs = spark.read.option("mergeSchema", True).parquet(path)
    newest = runs.agg(F.max("run_ts")).scalar()
    return runs.where(F.col("run_ts") == newest)


def write_csv(
    panel: Panel, path: str, pattern: str = "yyyy-MM-dd", stamps: Sequence[str] | None = None
) -> None:
    """Symbols as rows, timestamps as columns, with a header."""
    transpose(panel, stamps, pattern).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def outlier_report(outliers: DataFrame) -> DataFrame:
    """One row (outliers array<struct>, count), lowest correlation first.

    At most one entry per symbol pair, so the array is bounded by the universe.
    """
    entry = F.struct("correlation", "symbol_a", "symbol_b")
    return outliers.agg(
        F.array_sort(F.collect_list(entry)).alias("outliers"),
        F.count(F.lit(1)).alias("count"),
    )


def build_metadata(
    panel: Panel,
    replacements: DataFrame,
    outliers: DataFrame,
    *,
    start,
    end,
    built_at,
) -> DataFrame:
    """One row describing a build: range, symbols, shape, replacements, outlier count."""
    entry = F.struct("pos", "dropped", "replaced_with")
    made = replacements.agg(F.array_sort(F.collect_list(entry)).alias("made"))
    made = made.select(
        F.expr("made.dropped").alias("zombies_dropped"),
        F.expr("transform(made, r -> struct(r.dropped, r.replaced_with))").alias("replacements"),
    )
    return panel.rows.agg(F.count(F.lit(1)).alias("rows_t")).select(
        F.lit(built_at).cast("timestamp").alias("build_timestamp_utc"),
        F.lit(start).cast("date").alias("start_date"),
        F.lit(end).cast("date").alias("end_date"),
        F.array(*[F.lit(s) for s in panel.symbols]).alias("tickers"),
        "rows_t",
        F.lit(panel.width).alias("cols_tickers"),
        made.select("zombies_dropped").scalar().alias("zombies_dropped"),
        made.select("replacements").scalar().alias("replacements"),
        outliers.agg(F.count(F.lit(1))).scalar().alias("correlation_outlier_count"),
    )


def feed_report(scores: DataFrame, winner: DataFrame, *, seconds: int, created_at) -> DataFrame:
    """One row: when, how long, the winner, and the score of every feed."""
    columns = ["source", *[c for c in scores.columns if c != "source"]]
    return scores.agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("scores")).select(
        F.lit(created_at).cast("timestamp").alias("created_at"),
        F.lit(int(seconds)).alias("seconds_per_feed"),
        winner.scalar().alias("winner"),
        "scores",
    )


def event_rows(events: DataFrame, now=None) -> DataFrame:
    """Events in the log's schema; ``logged_at`` defaults to now."""
    present = set(events.columns)
    default = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    columns = []
    for field in EVENT:
        if field.name in present:
            column = F.col(field.name).cast(field.dataType)
        else:
            column = F.lit(None).cast(field.dataType)
        if field.name == "logged_at":
            column = F.coalesce(column, default)
        columns.append(column.alias(field.name))
    return events.select(*columns)


def append_events(events: DataFrame, path: str, now=None) -> None:
    """Append one JSON record per event, leaving out empty fields."""
    event_rows(events, now).write.mode("append").option(
        "timestampFormat", EVENT_TIME
    ).json(path)
