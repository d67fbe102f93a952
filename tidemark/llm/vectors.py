"""Vectors of a table as bytes, with those set apart that take no part in comparisons."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import short_batches

#: Type of the stored components, by that of the table's; nothing is rounded.
DTYPES = {"float": "<f4", "double": "<f8"}


def stored_type(rows: DataFrame, column: str = "embedding") -> str:
    kind = rows.schema[column].dataType
    if not isinstance(kind, T.ArrayType) or kind.elementType.simpleString() not in DTYPES:
        raise TypeError(f"{column} must be an array of float or double")
    return DTYPES[kind.elementType.simpleString()]


def packed_vectors(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """``(vec_id, vec)`` of every row; ``vec`` is null unless the vector takes part.

    Null and zero vectors and those with null or non-finite components take no part.
    Negative zeros are stored as zeros, so equal vectors have equal bytes.
    """
    short_batches(rows.sparkSession, 10_000)
    dtype = stored_type(rows, column)

    def pack(batches):
        for batch in batches:
            lists = batch.column(1)
            values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
            ends = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))])
            ok = np.isfinite(values)
            bad = np.concatenate([[0], np.cumsum(~ok)])
            some = np.concatenate([[0], np.cumsum(ok & (values != 0))])
            raw = (values + 0.0).astype(dtype)
            out = [
                raw[a:b].tobytes() if bad[b] == bad[a] and some[b] > some[a] else None
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "vec"]
            )

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column)).mapInArrow(
        pack, "vec_id long, vec binary"
    )


def matrix(vectors: list[bytes], dtype: str) -> np.ndarray:
    """Rows of stored vectors in double precision."""
    if not vectors:
        return np.zeros((0, 0))
    return np.frombuffer(b"".join(vectors), dtype).reshape(len(vectors), -1).astype(np.float64)
