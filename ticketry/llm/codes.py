"""Binary codes of vectors by iterative quantisation, and what Hamming distances say about angles.

A rotation is learned so that the signs of the rotated coordinates lose as little as possible; it evens out the variance
of the directions, so the bits are balanced. Several rotations, each learned from another start, give as many bits as a
search asks for. Rotations are fitted on a bounded sample; every row is coded.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: not null or zero, without null and non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors(table: DataFrame, vector: str, *columns: str) -> DataFrame:
    """``columns`` and double vector ``_v`` of the usable rows. Only vectors of one length can be compared with each other."""
    return table.select(*columns, F.col(vector).cast("array<double>").alias("_v")).where(usable(F.col("_v")))


def longest(rows: DataFrame) -> int:
    return rows.agg(F.max(F.size("_v"))).first()[0] or 1


def sample_matrix(rows: DataFrame, key: str, size: int, width: int) -> np.ndarray:
    """``size`` rows at most, those with the smallest hash of ``key``, scaled to length 1; shorter vectors end in zeros."""
    got = rows.orderBy(F.xxhash64(key), key, "_v").limit(size).select("_v").toPandas()["_v"]
    x = np.zeros((len(got), width))
    for i, v in enumerate(got):
        x[i, :len(v)] = v
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def learn_rotations(x: np.ndarray, bits: int, rounds: int = 20, seed: int = 7) -> np.ndarray:
    """[d, bits] projections: as many learned rotations side by side as ``bits`` need, the last one cut.

    Vectors of more than 1,024 components get rotations that are not learned.
    """
    d = x.shape[1]
    rounds = rounds if d <= 1024 else 0
    random, parts = np.random.default_rng(seed), []
    while sum(p.shape[1] for p in parts) < bits:
        r = np.linalg.qr(random.standard_normal((d, d)))[0]
        for _ in range(rounds if len(x) else 0):
            u, _, vt = np.linalg.svd(np.where(x @ r >= 0, 1.0, -1.0).T @ x, full_matrices=False)
            r = (u @ vt).T
        parts.append(r)
    return np.concatenate(parts, axis=1)[:, :bits]


def sign_bits(x: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """[n, bits] booleans; a vector shorter than the rotations counts as if it ended in zeros."""
    return x @ rotations[:x.shape[1]] >= 0


def pack(bits: np.ndarray) -> np.ndarray:
    """[n, words] unsigned 64-bit integers; missing bits are 0."""
    raw = np.packbits(bits, axis=1)
    raw = np.pad(raw, ((0, 0), (0, -raw.shape[1] % 8)))
    return np.ascontiguousarray(raw).view(np.uint64)


def substrings(bits: np.ndarray, width: int) -> np.ndarray:
    """[n, tables] integers, ``width`` bits each."""
    n, total = bits.shape
    return bits.reshape(n, total // width, width) @ (1 << np.arange(width, dtype=np.int64))


def bits_apart(cosine: float) -> float:
    """The share of bits in which two vectors of this cosine differ, on average."""
    return float(np.arccos(np.clip(cosine, -1.0, 1.0)) / np.pi)


def exact_cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of the rows of ``x`` with ``q``, summed from the first component to the last, so equal rows get equal values."""
    last = lambda a: np.cumsum(a, axis=-1)[..., -1]
    return np.clip(last(x * q) / np.sqrt(last(x * x) * last(q * q)), -1.0, 1.0)
