"""What the operators share: bounded slices of text, reliable intermediate tables, folds, words.

Every text operator sees a null text as the empty text and never looks at columns it was not
told about, so extra columns, whatever their names, pass through stages untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lognorm.session import cut_lineage, limit_batches

#: Text that one slice holds at most; a single longer text is a slice of its own.
SLICE_BYTES = 4 << 20

Doc = tuple[int, bytes]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read from there: survives lost executors."""
    return cut_lineage(df)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def fold_of(key: int | None, folds: int) -> int:
    """``fold`` for one key inside a task."""
    import zlib

    return zlib.crc32(b"" if key is None else str(key).encode()) % folds


def text_or_empty(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit("")))


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces whose texts hold at most ``limit`` bytes (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a batch's texts; null as empty."""
    column = batch.column(batch.schema.get_field_index(text))
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased, split at the ASCII white space ``[\\x20\\x09-\\x0D]``; other bytes are kept."""
    return text.lower().split()


def map_slices(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema, text: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``make()`` once a task, its result on every slice; no shuffle, one slice of one bounded batch in memory."""
    limit_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for piece in slices(batches, text, limit):
            yield work(piece)

    return df.mapInArrow(run, schema)


def keep_rows(
    df: DataFrame, make: Callable[[], Callable[[list[bytes]], np.ndarray]], text: str = "text",
) -> DataFrame:
    """Rows whose text ``make()(texts)`` marks true, with all their columns as they are."""

    def masks() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        mark = make()
        return lambda piece: piece.filter(pa.array(np.asarray(mark(texts_of(piece, text)), dtype=bool)))

    return map_slices(df, masks, df.schema, text)


def summed(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(value).alias(value))
