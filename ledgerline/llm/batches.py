"""Arrow batches in, Arrow batches out: the carrier of the Python operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SLICE_BYTES = 4 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver found it.

    Where it is installed on the executors, or passed with ``--py-files``,
    this changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def slices(batch: pa.RecordBatch, column: str, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of at most ``budget`` bytes of ``column`` (one row at least)."""
    if not batch.num_rows:
        return
    c = batch.column(column)
    long = pc.list_value_length(c) if pa.types.is_list(c.type) or pa.types.is_large_list(c.type) else pc.binary_length(c)
    size = pc.fill_null(long, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // budget
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, pa.Array]], add: str,
                column: str = "text") -> DataFrame:
    """``df`` with the columns that ``fn`` computes from each batch.

    ``add`` is the DDL of the new columns; a column of ``df`` with the same
    name is replaced, all others are passed through.  ``fn`` sees at most
    ``SLICE_BYTES`` of ``column`` at a time (or one longer row), which bounds a
    worker's memory whatever the batch size.
    """
    importable(df.sparkSession)
    new = StructType.fromDDL(add)
    made = {n.lower() for n in new.names}
    keep = [f.name for f in df.schema.fields if f.name.lower() not in made]
    schema = StructType([df.schema[n] for n in keep] + list(new.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                out = fn(part)
                yield pa.RecordBatch.from_arrays([part.column(n) for n in keep] + [out[n] for n in new.names],
                                                 names=keep + new.names)

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return pc.fill_null(batch.column(column), "").to_pylist()


def ragged(values: pa.Array, counts) -> pa.Array:
    """A list array whose rows take ``counts`` of ``values`` in turn."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
