"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes are cut into substrings and each substring is indexed. Two codes within radius r agree in some substring up to
r // tables bits, so probing all substrings up to that distance retrieves every code within r; their float vectors are
then compared exactly. The search starts with equal substrings. Vectors of cosine c differ in a share arccos(c) / pi of
the bits, so the k-th best cosine found says how far the codes of anything better can be, ``z`` standard deviations
included: the radius grows to that and the search ends. Where that means more probes than an index has rows, the codes
are compared directly, which retrieves the same rows.

Index rows are dealt to shards and queries to blocks, by hash; each (shard, block, vector length) is one bounded group, whose
best rows meet in a ranking. The query set is searched against all rows; nothing is dropped and no bucket is capped.

Defined cases: vectors null, zero, or with null or non-finite components take no part, nor do rows without id; vectors of
several lengths are compared with those of their own length; ids that repeat are several candidates and one query (with the smallest of its vectors); ties go to
the smaller id; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketry.llm import codes
from ticketry.llm.common import small_batches, written

RESULT = "query_id long, vec_id long, score double"


class MultiIndex:
    """The index of one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rotations: np.ndarray, width: int = 16, z: float = 4.0) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.rotations, self.width, self.z = ids[order], x[order], rotations, width, z
        self.unit = self.x / np.linalg.norm(self.x, axis=1, keepdims=True)
        bits = codes.sign_bits(self.x, rotations)
        self.code, self.bits = codes.pack(bits), rotations.shape[1]
        parts = codes.substrings(bits, width)
        self.order = np.argsort(parts, axis=0, kind="stable")
        self.sorted = np.take_along_axis(parts, self.order, axis=0)
        self.tables = parts.shape[1]

    def within(self, code: np.ndarray, parts: np.ndarray, radius: int) -> np.ndarray:
        """Ascending positions of all rows whose codes are within ``radius``."""
        reach = radius // self.tables
        probes = sum(1 for n in range(reach + 1) for _ in combinations(range(self.width), n)) if reach < 3 else self.width ** 3
        if probes * self.tables < len(self.ids):
            flips = [sum(1 << b for b in c) for n in range(reach + 1) for c in combinations(range(self.width), n)]
            found = [np.zeros(0, np.int64)]
            for t in range(self.tables):
                values = int(parts[t]) ^ np.array(flips, np.int64)
                low, high = (np.searchsorted(self.sorted[:, t], values, side) for side in ("left", "right"))
                found += [self.order[a:b, t] for a, b in zip(low.tolist(), high.tolist(), strict=True) if a < b]
            near = np.unique(np.concatenate(found))
        else:
            near = np.arange(len(self.ids))
        return near[np.bitwise_count(self.code[near] ^ code).sum(axis=1) <= radius]

    def search(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        """(query id, id, cosine) of the k nearest rows with another id."""
        unit = q / np.linalg.norm(q)
        bits = codes.sign_bits(q[None], self.rotations)
        code, parts, radius = codes.pack(bits)[0], codes.substrings(bits, self.width)[0], self.tables - 1
        while True:
            near = self.within(code, parts, radius)
            near = near[self.ids[near] != query_id]
            if radius >= self.bits:
                break
            fast = self.unit[near] @ unit
            if len(near) >= k:
                share = codes.bits_apart(float(np.partition(fast, len(fast) - k)[len(fast) - k]))
                need = int(np.ceil(self.bits * share + self.z * np.sqrt(self.bits * share * (1 - share))))
                if need <= radius:
                    break
                radius = min(need, self.bits)
            else:
                radius = min(2 * radius + 1, self.bits)
        if len(near) > k:  # the exact sums only for rows that can be among the best
            fast = self.unit[near] @ unit
            near = near[fast >= np.partition(fast, len(fast) - k)[len(fast) - k] - 1e-9]
        exact = codes.exact_cosines(self.x[near], q)
        best = np.lexsort((self.ids[near], -exact))[:k]
        return [(query_id, int(self.ids[near[i]]), float(exact[i])) for i in best]


def nearest(table: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", bits: int = 256, width: int = 16,
            z: float = 4.0, sample_rows: int = 4096, shard_rows: int = 16384, block_rows: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows by cosine of each row for which ``is_query`` holds."""
    small_batches(table.sparkSession)
    rows = written(codes.vectors(table.where(F.col(key).isNotNull()), vector, key).withColumn("_query", F.coalesce(is_query, F.lit(False))), "rows")
    n, queries = rows.agg(F.count("*"), F.count(F.when(F.col("_query"), 1))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-queries // block_rows))
    x = codes.sample_matrix(rows, key, sample_rows, codes.longest(rows))
    rotations = codes.learn_rotations(x, bits)
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    shard = lambda salt, count: F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(count)).cast("int")
    index = rows.select(F.col(key).cast("long").alias("id"), "_v", F.size("_v").alias("length"), shard(1, shards).alias("shard"), every(blocks).alias("block"))
    asked = (rows.where("_query").groupBy(key).agg(F.min("_v").alias("_v"))
             .select(F.col(key).cast("long").alias("id"), "_v", F.size("_v").alias("length"), shard(2, blocks).alias("block"), every(shards).alias("shard")))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(left) and len(right):
            index = MultiIndex(left["id"].to_numpy(), np.stack(left["_v"].tolist()), rotations, width, z)
            for i, v in zip(right["id"].tolist(), right["_v"], strict=True):
                found += index.search(i, np.asarray(v), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    best = index.groupBy("shard", "block", "length").cogroup(asked.groupBy("shard", "block", "length")).applyInPandas(search, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.e, v.e) AS score FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5
"""
