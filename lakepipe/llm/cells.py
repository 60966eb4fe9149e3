"""Counts of hashes in a fixed number of cells: a statistic of all rows whose size does not grow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_SLICE = 1 << 15


def cell_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def cell_counts(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """How many hashes fall into each of ``2 ** bits`` cells (by their top bits).

    ``hashes`` gives the hashes of a batch.  Each task adds up its rows, the
    sums are added slice by slice on the executors; the driver gets one array
    of ``2 ** bits`` numbers whatever the input.
    """
    size = 1 << bits
    step = min(size, _SLICE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint32)
        for batch in batches:
            for h in hashes(batch):
                if len(h) > size >> 3:
                    total += np.bincount(cell_of(h, bits), minlength=size).astype(np.uint32)
                else:
                    cell, n = np.unique(cell_of(h, bits), return_counts=True)
                    total[cell] += n.astype(np.uint32)
        if total.any():
            parts = [total[a : a + step] for a in range(0, size, step)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(parts)), pa.int32()),
                    pa.array([p.astype("<u1" if p.max() < 256 else "<u4").tobytes() for p in parts], pa.binary()),
                ],
                ["slice", "counts"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(b, "<u1" if len(b) == step else "<u4").astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.astype("<i8").tobytes() for v in sums.values()], pa.binary())],
                ["slice", "counts"],
            )

    schema = "slice int, counts binary"
    out = np.zeros(size, np.int64)
    summed = rows.mapInArrow(count, schema).repartition(max(1, min(16, size // step)), "slice").mapInArrow(add, schema)
    for r in summed.collect():
        a = r["slice"] * step
        out[a : a + step] += np.frombuffer(bytes(r["counts"]), "<i8")
    return out
