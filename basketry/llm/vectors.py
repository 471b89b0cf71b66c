"""Vectors of a table as packed numbers; what is not a usable vector is left out."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable_vectors(table: DataFrame, id_column: str, vector_column: str, label_column: str | None = None) -> DataFrame:
    """``(vec_id, label, dim, digest, vec)`` of the rows with an id, a label (if
    one is asked for) and a vector of finite numbers that are not all zero.
    ``vec`` holds little-endian doubles; ``digest`` is equal for equal vectors."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, dims, digests, packed = [], [], [], []
            for i, value in enumerate(batch.column(2)):
                if not value.is_valid or not len(value):
                    continue
                numbers = value.values
                if numbers.null_count:
                    continue
                v = numbers.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
                if np.isfinite(v).all() and v.any():
                    keep.append(i)
                    dims.append(len(v))
                    packed.append(v.tobytes())
                    digests.append(hashlib.blake2b(packed[-1], digest_size=16).digest())
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows), batch.column(1).take(rows), pa.array(dims, pa.int32()),
                    pa.array(digests, pa.binary()), pa.array(packed, pa.binary()),
                ],
                ["vec_id", "label", "dim", "digest", "vec"],
            )

    label = F.col(label_column).cast("string") if label_column else F.lit("")
    rows = table.select(
        F.col(id_column).cast("long").alias("vec_id"), label.alias("label"), F.col(vector_column).alias("vec")
    )
    return rows.filter("vec_id is not null and label is not null and vec is not null").mapInArrow(
        read, "vec_id long, label string, dim int, digest binary, vec binary"
    )


def stacked(column: pa.Array, dim: int | None = None, kind: str = "<f8") -> np.ndarray:
    """A binary column of vectors of one length as a matrix."""
    data = b"".join(column.to_pylist() if isinstance(column, (pa.Array, pa.ChunkedArray)) else column)
    flat = np.frombuffer(data, kind)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, dim or 0)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest number first, so nothing overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """At most ``k`` centres of the rows of a bounded sample."""
    centres = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    if len(centres) > k:
        centres = centres[rng.choice(len(centres), k, replace=False)]
    for _ in range(rounds):
        nearest = nearest_centre(x, centres)[0]
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=len(centres))[:, None]
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * x @ centres.T
    return np.maximum(d, 0)


def nearest_centre(x: np.ndarray, centres: np.ndarray, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row and its squared distance."""
    found = [squared_distances(x[i : i + step], centres) for i in range(0, len(x), step)]
    at = np.concatenate([d.argmin(1) for d in found]) if found else np.zeros(0, np.int64)
    return at, np.concatenate([d.min(1) for d in found]) if found else np.zeros(0)
