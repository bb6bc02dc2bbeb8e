"""Row-wise panel operators: complete cases, open rows, summaries, shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordinals import block_length, own_block, renumber
from tidemark.panel import Panel


def is_complete(column: str = "values"):
    return F.expr(f"forall({column}, v -> v is not null)")


def is_open(column: str = "values"):
    return F.expr(f"exists({column}, v -> v is not null)")


def complete_case(panel: Panel) -> Panel:
    """Drop every timestamp at which any symbol is missing."""
    length = block_length(panel.width, 1)
    rows = panel.rows.where(is_complete()).withColumn("block", own_block(length))
    return panel.with_rows(renumber(rows.repartition("block"), "block"))


def open_periods(panel: Panel) -> DataFrame:
    """(ts, is_open): whether any symbol has a value at ts."""
    return panel.rows.select("ts", is_open().alias("is_open"))


def panel_stats(panel: Panel) -> DataFrame:
    """One row: row count, first and last day, width, mean share of missing cells."""
    missing = F.expr("size(filter(values, v -> v is null))")
    return panel.rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.date_format(F.min("ts"), "yyyy-MM-dd").alias("start_date"),
        F.date_format(F.max("ts"), "yyyy-MM-dd").alias("end_date"),
        F.lit(panel.width).alias("column_count"),
        (F.avg(missing) / F.lit(panel.width)).alias("missing_frac"),
    )


def heatmap_cells(panel: Panel, limit: float = 3.0) -> DataFrame:
    """(symbol, ts, value, is_tick): values clipped to +-limit, and the labelled rows.

    Up to 15 rows carry a label each; longer panels are labelled every
    max(1, round(rows / 12)) rows from the first one.
    """
    rows = panel.rows.agg(F.count(F.lit(1)).alias("_rows"))
    step = F.when(F.col("_rows") <= 15, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.bround(F.col("_rows") / F.lit(12.0)).cast("int"))
    )
    ticks = rows.select(step.alias("_step")).scalar()
    clipped = F.greatest(F.lit(-limit), F.least(F.lit(limit), F.col("value")))
    return panel.cells().select(
        panel.symbol_at().alias("symbol"),
        "ts",
        F.when(F.col("value").isNotNull(), clipped).alias("value"),
        (F.col("ord") % ticks == 0).alias("is_tick"),
    )


def transpose(
    panel: Panel, stamps: Sequence[str] | None = None, pattern: str = "yyyy-MM-dd"
) -> DataFrame:
    """One row per symbol, one column per timestamp, for reports.

    The columns are the formatted timestamps, so ``pattern`` has to tell them
    apart: two timestamps with one label raise, and so does a timestamp that is not
    among ``stamps``. Without ``stamps`` the columns are read from the panel, which then has to fit ``spark.sql.pivotMaxValues``
    columns; the tidy form has no such bound.
    """
    label = F.date_format("ts", pattern).alias("label")
    repeated = panel.rows.groupBy(label).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"several timestamps are labelled {repeated[0].label}; use a finer pattern")
    labels = list(stamps) if stamps is not None else report_stamps(panel, pattern)
    if stamps is not None:
        unknown = panel.rows.select(label).where(~F.col("label").isin(labels)).limit(1).collect()
        if unknown:
            raise ValueError(f"the timestamp {unknown[0].label} is not among the stated ones")
    cells = panel.cells().withColumn("_label", F.date_format("ts", pattern))
    return (
        cells.groupBy("pos")
        .pivot("_label", labels)
        .agg(F.max_by("value", "ts"))
        .withColumn("symbol", panel.symbol_at())
        .orderBy("pos")
        .select("symbol", *[F.col(f"`{label}`") for label in labels])
    )


def report_stamps(panel: Panel, pattern: str = "yyyy-MM-dd") -> list[str]:
    """Formatted timestamps in order; raises when they exceed the pivot bound."""
    most = int(panel.spark.conf.get("spark.sql.pivotMaxValues", "10000"))
    found = (
        panel.rows.select(F.date_format("ts", pattern).alias("label"))
        .distinct()
        .orderBy("label")
        .limit(most + 1)
        .collect()
    )
    if len(found) > most:
        raise ValueError(f"more than {most} timestamps; write the tidy form instead")
    return [row.label for row in found]


def ordered_distinct(df: DataFrame, column: str, order: str) -> DataFrame:
    """(column, pos): the distinct values, each at the place where it comes first.

    Values are reduced before the shuffle, so a frequent one costs a row per task. NULL
    is a value like others.
    """
    return df.groupBy(column).agg(F.min(order).alias("pos"))
