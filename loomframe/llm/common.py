"""What the text operators share: reading columns, Arrow batches, one row per document."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from loomframe.session import ship_package

#: What an Arrow task handles at once: rows, and bytes of text (one longer text stands alone).
ROWS, BYTES = 1024, 1_000_000


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns as one, so that columns beside it may have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def one_per_key(marked: DataFrame, kept: DataFrame) -> DataFrame:
    """The ``row`` of each ``key`` in ``kept``; of several rows that with the smallest hash."""
    found = marked.join(kept, "key", "left_semi")
    return found.groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def unused(columns: list[str], name: str) -> str:
    """``name``, with as many underscores behind it as make it new among the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null counts as the empty string."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def slices(batch: pa.RecordBatch, text: int, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of at most :data:`ROWS` rows and about ``size`` bytes in the column ``text``."""
    length = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    upto, at = np.cumsum(length, dtype=np.int64), 0
    while at < batch.num_rows:
        before = upto[at - 1] if at else 0
        end = min(at + ROWS, max(at + 1, int(np.searchsorted(upto, before + size, "right"))))
        yield batch.slice(at, end - at)
        at = end


def in_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: int,
    size: int = BYTES,
) -> DataFrame:
    """Apply ``function`` to the :func:`slices` of ``df`` by its column number ``text``."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(function, slices(batch, text, size))

    return df.mapInArrow(run, schema)
