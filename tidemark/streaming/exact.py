"""Exact bars from a stream, one micro-batch at a time.

Lateness is decided by the arrival order inside a symbol, across micro-batches.
Each micro-batch runs the batch operators, so a symbol with most of the ticks
is spread over tasks as it is there; what is carried from batch to batch is one
open bar per symbol, or the mark of the bar that the clock closed last.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import bar_volume, to_fixed
from tidemark.functions.prices import SCALE
from tidemark.functions.values import lag_ms
from tidemark.operators.bars import flag_late
from tidemark.folders import delete_folder, numbered_folders

_KEYS = ["source", "symbol"]
_PARTIAL = (
    "source string, symbol string, bar_start timestamp, open double, high double, low double,"
    " close double, size double, first_seq bigint, last_seq bigint, late bigint, kept bigint"
)
_NAMES = [part.split()[0] for part in _PARTIAL.split(", ")]


@dataclass(frozen=True)
class ExactBarWriter:
    """A ``foreachBatch`` function that writes finished bars and the open ones.

    Each micro-batch owns the folder ``log/batch=N`` under ``path``, with finished
    bars in ``state=done`` and what is carried on in ``state=open``, and overwrites it
    when it is run again, so a restart neither loses nor repeats a bar. The stream's
    source should bound a micro-batch (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).

    ``clock`` gives the time at the end of a micro-batch by its number. A bar whose
    window that time has left is finished then, also when no tick came; ticks for
    it that come later are late and do not open it again. Rows without a symbol
    are heartbeats: they make a micro-batch happen and are not ticks.
    """

    path: str
    width: str = "1 minute"
    clock: Callable[[int], datetime] | None = None

    def __call__(self, ticks: DataFrame, batch_id: int) -> None:
        spark = ticks.sparkSession
        prior = self._carried(spark, batch_id - 1)
        step = F.expr(f"interval {self.width}")
        bound = prior.select(
            *_KEYS, F.when(F.col("closed"), F.col("bar_start") + step).otherwise(F.col("bar_start")).alias("_bound")
        )
        flagged = (
            flag_late(ticks.where("symbol is not null"), self.width)
            .join(bound, _KEYS, "left")
            .withColumn("is_late", F.expr("is_late or coalesce(bar_start < _bound, false)"))
        )
        fresh = flagged.groupBy(*_KEYS, "bar_start").agg(
            F.expr("min_by(price, seq) filter (where not is_late) as open"),
            F.expr("max(price) filter (where not is_late) as high"),
            F.expr("min(price) filter (where not is_late) as low"),
            F.expr("max_by(price, seq) filter (where not is_late) as close"),
            F.expr("sum(size) filter (where not is_late) as size"),
            F.expr("min(seq) filter (where not is_late) as first_seq"),
            F.expr("max(seq) filter (where not is_late) as last_seq"),
            F.expr("count_if(is_late) as late"),
            F.expr("count_if(not is_late) as kept"),
        )
        # a bar with only late ticks holds nothing but their number
        bars = (
            fresh.withColumn("closed", F.lit(False))
            .unionByName(prior)
            .groupBy(*_KEYS, "bar_start")
            .agg(
                F.expr("min_by(open, first_seq) as open"),
                F.expr("max(high) as high"),
                F.expr("min(low) as low"),
                F.expr("max_by(close, last_seq) as close"),
                F.expr("sum(size) as size"),
                F.expr("min(first_seq) as first_seq"),
                F.expr("max(last_seq) as last_seq"),
                F.expr("sum(late) as late"),
                F.expr("sum(kept) as kept"),
                F.expr("bool_or(closed) as closed"),
            )
            .withColumn(
                "_newest",
                F.expr(
                    "bar_start = max(if(first_seq is not null or closed, bar_start, null))"
                    " over (partition by source, symbol)"
                ),
            )
            .withColumn("_newest", F.coalesce("_newest", F.lit(False)))
        )
        due = F.lit(False)
        if self.clock is not None:
            due = F.col("bar_start") + step <= F.lit(self.clock(batch_id)).cast("timestamp")
        self._write(bars.withColumn("_due", due), batch_id)

    def _write(self, bars: DataFrame, batch_id: int) -> None:
        """One write: a row is finished, carried on, or both (its mark is carried on)."""
        finished = F.expr("(first_seq is not null and (not _newest or _due)) or (late > 0 and first_seq is null)")
        marked = F.col("_newest") & (F.col("closed") | F.col("_due"))
        states = F.concat(
            F.when(finished, F.array(F.lit("done"))).otherwise(F.array().cast("array<string>")),
            F.when(F.col("_newest"), F.array(F.lit("open"))).otherwise(F.array().cast("array<string>")),
        )
        rows = bars.withColumns({"_mark": marked, "state": F.explode(states)})
        mark = F.col("_mark") & (F.col("state") == "open")
        empty = {c: F.when(~mark, F.col(c)) for c in _NAMES if c not in (*_KEYS, "bar_start", "late")}
        rows.select(
            *_KEYS,
            "bar_start",
            *[c.alias(n) for n, c in empty.items()],
            F.when(mark, F.lit(0).cast("bigint")).otherwise(F.col("late")).alias("late"),
            mark.alias("closed"),
            "state",
        ).write.mode("overwrite").partitionBy("state").parquet(f"{self.path}/log/batch={batch_id}")

    def _carried(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Open bars and marks of closed ones after a micro-batch."""
        if batch_id < 0:
            return spark.createDataFrame([], _PARTIAL + ", closed boolean")
        return _batch(spark, self.path, batch_id, "open").drop("state")

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        """Gather the finished bars up to a committed micro-batch and delete what they replace.

        The gathered rows are written first, under ``store/through=N``, and readers take the
        newest complete store and the later micro-batches, so an interruption loses nothing.
        Bars carried on after ``batch_id`` stay, as the next micro-batch needs them.
        """
        through = _store(spark, self.path)
        if through is not None and through >= batch_id:
            return
        rows = _finished(spark, self.path, batch_id)
        rows.repartition("source", "symbol").write.mode("overwrite").parquet(f"{self.path}/store/through={batch_id}")
        for number in numbered_folders(spark, f"{self.path}/store", "through"):
            if number < batch_id:
                delete_folder(spark, f"{self.path}/store/through={number}")
        for number in numbered_folders(spark, f"{self.path}/log", "batch"):
            if number < batch_id:
                delete_folder(spark, f"{self.path}/log/batch={number}")


def _batch(spark: SparkSession, path: str, batch_id: int, state: str) -> DataFrame:
    rows = spark.read.schema(_PARTIAL + ", closed boolean, state string").parquet(f"{path}/log/batch={batch_id}")
    return rows.where(F.col("state") == state)


def _store(spark: SparkSession, path: str) -> int | None:
    """The micro-batch up to which finished bars are gathered."""
    return max(numbered_folders(spark, f"{path}/store", "through", complete=True), default=None)


def _finished(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    through = _store(spark, path)
    try:
        rows = spark.read.schema(_PARTIAL + ", batch int, state string").parquet(f"{path}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # no batch has been written yet
            raise
        rows = spark.createDataFrame([], _PARTIAL + ", batch int, state string")
    rows = rows.where("state = 'done'")
    if through is not None:
        rows = rows.where(F.col("batch") > through)
    if upto is not None:
        rows = rows.where(F.col("batch") <= upto)
    rows = rows.select(*_NAMES)
    if through is not None:
        rows = rows.unionByName(spark.read.schema(_PARTIAL).parquet(f"{path}/store/through={through}"))
    return rows


def _written(spark: SparkSession, path: str, flush_batch: int | None) -> DataFrame:
    """Rows of finished bars and of late ticks; with ``flush_batch`` the open bars too."""
    rows = _finished(spark, path)
    if flush_batch is not None:
        rows = rows.unionByName(_batch(spark, path, flush_batch, "open").select(*_NAMES))
    return rows


def _shown(width: str, scale: int, of: str = "") -> list[Column]:
    fixed = [to_fixed(F.col(f"{of}{c}"), scale).alias(f"{c}_fixed") for c in ("open", "high", "low", "close")]
    return [
        F.col("symbol"),
        F.col("bar_start"),
        (F.col("bar_start") + F.expr(f"interval {width}")).alias("bar_end"),
        *fixed,
        bar_volume(F.col(f"{of}size")).alias("volume"),
        F.col("source"),
    ]


def read_exact_bars(
    spark: SparkSession,
    path: str,
    width: str = "1 minute",
    *,
    scale: int = SCALE,
    flush_batch: int | None = None,
) -> DataFrame:
    """The finished bars; with ``flush_batch`` also the bars open after that batch.

    ``late_ticks`` counts the ticks that came too late for the bar.
    """
    bars = (
        _written(spark, path, flush_batch)
        .groupBy(*_KEYS, "bar_start")
        .agg(
            F.expr("min_by(struct(open, high, low, close, size), first_seq) as b"),
            F.expr("sum(late) as late_ticks"),
        )
    )
    return bars.where("b is not null").select(*_shown(width, scale, "b."), "late_ticks")


def batch_bars(
    spark: SparkSession,
    path: str,
    batch_id: int,
    width: str = "1 minute",
    *,
    scale: int = SCALE,
    still_open: bool = False,
) -> DataFrame:
    """The bars that one micro-batch finished, or those open after it, with ``seq`` of their last tick."""
    rows = _batch(spark, path, batch_id, "open" if still_open else "done")
    return rows.where("first_seq is not null").select(*_shown(width, scale), F.col("last_seq").alias("seq"))


def batch_counters(spark: SparkSession, path: str, batch_id: int, now=None, width: str = "1 minute") -> DataFrame:
    """One row of what a micro-batch did: ticks received and dropped as late, bars finished, the
    end of the newest of them, and how far ``now`` is past it in ms.

    The numbers come from the folder of the micro-batch less what it took over from the one
    before, not from accumulators, so a task that ran twice is not counted twice.
    """
    written = spark.read.schema(_PARTIAL + ", closed boolean, state string").parquet(f"{path}/log/batch={batch_id}")
    done = (F.col("state") == "done") & F.col("first_seq").isNotNull()
    shown = [
        F.lit(1).alias("_sign"), (F.coalesce("kept", F.lit(0)) + F.coalesce("late", F.lit(0))).alias("_ticks"),
        F.coalesce("late", F.lit(0)).alias("_late"), F.when(done, F.col("bar_start")).alias("_bar"),
    ]
    rows = written.select(*shown)
    if batch_id > 0:
        before = _batch(spark, path, batch_id - 1, "open").select(*shown[1:])
        rows = rows.unionByName(before.select(F.lit(-1).alias("_sign"), "_ticks", "_late", F.lit(None).cast("timestamp").alias("_bar")))
    end = F.max("_bar") + F.expr(f"interval {width}")
    counted = rows.agg(
        F.coalesce(F.sum(F.col("_sign") * F.col("_ticks")), F.lit(0)).cast("bigint").alias("ticks_received"),
        F.coalesce(F.sum(F.col("_sign") * F.col("_late")), F.lit(0)).cast("bigint").alias("late_ticks_dropped"),
        F.count("_bar").alias("bars_written"),
        end.alias("last_bar_end"),
    )
    lag = lag_ms(F.lit(now).cast("timestamp"), F.col("last_bar_end"))
    lag = F.when(F.col("last_bar_end").isNotNull() & F.lit(now is not None), lag)
    return counted.select(F.lit(batch_id).cast("bigint").alias("batch"), "*", lag.alias("ingest_lag_ms"))


@dataclass(frozen=True)
class CountingWriter:
    """An :class:`ExactBarWriter` that also keeps one row of counters per micro-batch.

    Rows lie under ``path`` in ``batch=N`` and are overwritten when a micro-batch is run again.
    ``now`` gives the time that lag is measured at by the number of the micro-batch.
    """

    bars: ExactBarWriter
    path: str
    now: Callable[[int], datetime] | None = None

    def __call__(self, ticks: DataFrame, batch_id: int) -> None:
        self.bars(ticks, batch_id)
        now = self.now(batch_id) if self.now is not None else datetime.now(timezone.utc)
        found = batch_counters(ticks.sparkSession, self.bars.path, batch_id, now, self.bars.width)
        found.drop("batch").write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """The counters of all micro-batches, with ``batch``."""
    kinds = "ticks_received bigint, late_ticks_dropped bigint, bars_written bigint, last_bar_end timestamp, ingest_lag_ms double, batch bigint"
    return spark.read.schema(kinds).parquet(path)


def read_late_ticks(spark: SparkSession, path: str, *, flush_batch: int | None = None) -> DataFrame:
    """(source, symbol, late_ticks): all dropped ticks, also those of bars that never were."""
    late = _written(spark, path, flush_batch).groupBy(*_KEYS).agg(F.sum("late").alias("late_ticks"))
    return late
