"""Words, staged tables and size-checked broadcasts shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.folders import delete_folder
from tidemark.session import work_dir

#: The white space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"

#: A side of a join is broadcast up to this many rows of a few bytes, and shuffled beyond.
BROADCAST_ROWS = 1_000_000


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(f"({WORD})"), F.lit(1))


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


#: Shuffle files of a finished query are removed at once if this is set, and else when the driver collects garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """The frame written once to the shared working folder and read again.

    Later steps read files instead of repeating the plan, also after an executor is lost; so the
    shuffle files of the write are removed with its end.
    """
    spark = frame.sparkSession
    path, before = work_dir(spark, label), spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        frame.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEAN, before) if before is not None else spark.conf.unset(_CLEAN)
    return spark.read.schema(frame.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove staged tables that no later step reads."""
    for table in tables:
        for folder in {os.path.dirname(f) for f in table.inputFiles()}:
            delete_folder(table.sparkSession, folder)


def small_side(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``frame`` with a broadcast hint if it has at most ``rows`` rows; else as it is, to be shuffled.

    The frame must be cheap to count: a staged table or an aggregate of one.
    """
    if frame.limit(rows + 1).count() <= rows:
        return F.broadcast(frame)
    return frame


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of one take about ``limit`` bytes; a longer text is alone."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def column_sums(spark: SparkSession, frame: DataFrame, *names: str) -> list:
    """One row of sums, zero for an empty frame."""
    return [x or 0 for x in frame.agg(*[F.sum(n) for n in names]).first()]
