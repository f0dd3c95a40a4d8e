"""What the two vector searches share: which rows take part, and Arrow list columns as numpy matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part, repeated ones too: an id and a vector without null or non-finite components."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good).select("vec_id", "embedding")


def one_each(rows: DataFrame) -> DataFrame:
    """Of rows that repeat a vec_id that with the smallest vector."""
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column, kind: str = "float64", width: int | None = None):
    """An Arrow list column as a matrix; shorter rows are padded with zeros."""
    import numpy as np
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype("int64")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    most = max(int(lengths.max()) if len(lengths) else 0, width or 0)
    if len(lengths) and (lengths == most).all():
        return flat.reshape(len(lengths), most)
    out = np.zeros((len(lengths), most), kind)
    out[np.arange(most)[None] < lengths[:, None]] = flat
    return out
