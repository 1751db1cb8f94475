"""Vectors in bounded blocks, as numpy matrices inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a list array as doubles; shorter rows are filled up with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Each row as a mapping from name to its Arrow scalar."""
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i] for j, name in enumerate(names)}


def packer(keys: list[str], size: int):
    """Function for tasks: sorted rows to blocks of at most ``size`` rows with equal ``keys``.

    A block has the keys and, as ``rows``, a list of the values of the column ``row``.
    """

    def blocks(held: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        first = held.take(pa.array(starts[:-1]))
        listed = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), held["row"])
        return pa.RecordBatch.from_arrays([*(first[key] for key in keys), listed], names=[*keys, "rows"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            if left is not None:
                batch = pa.concat_batches([left, batch])
            if not batch.num_rows:
                continue
            columns = [batch[key].to_numpy() for key in keys]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            ends = np.concatenate([[0], changes, [batch.num_rows]])
            starts = np.concatenate([np.arange(a, b, size) for a, b in zip(ends, ends[1:])])
            # The last block may go on in the next batch.
            if len(starts) > 1:
                yield blocks(batch.slice(0, starts[-1]), starts)
            left = batch.slice(starts[-1])
        if left is not None and left.num_rows:
            yield blocks(left, np.array([0, left.num_rows]))

    return run
