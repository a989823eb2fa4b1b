"""What the operators share: written tables, and batches of text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyharbor.sources.scratch import purge, run_dir, shared_dir, written

__all__ = ["BLANKS", "cuts", "parts_for", "pieces", "purge", "run_dir", "shared_dir", "table", "text_or_empty", "whole_row", "written"]

#: ASCII blanks: words are runs of anything else.
BLANKS = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def parts_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_row(df: DataFrame) -> Column:
    """All columns of df as one struct: beside it, names of one's own clash with none."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def cuts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring rows, from and to, of at most so many bytes (one row at least)."""
    ends, begin = np.cumsum(sizes, dtype=np.int64), 0
    while begin < len(ends):
        past = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, past + most, side="right")))
        yield begin, end
        begin = end


def pieces(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many bytes of a binary or string column (one row at least)."""
    import pyarrow.compute as pc

    for batch in batches:
        if batch.num_rows:
            for begin, end in cuts(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), most_bytes):
                yield batch.slice(begin, end - begin)
