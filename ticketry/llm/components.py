"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is two counted joins on a minimum that is pre-aggregated before its shuffle, so a node that a third of all
links share is one row a task in the aggregate and a join key that adaptive execution splits. A round's table goes when its
successor is written. A table of ``FEW`` links or less, at first or after a round, is settled by one task in bounded memory:
rounds over a few thousand links cost only their jobs. Nothing is collected but one checksum a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import dropped, give_back, written

#: The largest link table, 16 bytes a link, that one task settles.
FEW = 1 << 18


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each of ``n`` positions by the links (i, j)."""
    root = np.arange(n)
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != root[root]).any():
            root = root[root]
    return root


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all links (u, v) of the one task."""
    parts = [np.stack([b.column("u").to_numpy(), b.column("v").to_numpy()]) for b in batches if b.num_rows]
    if parts:
        names, at = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
        at = at.reshape(2, -1)
        root = roots(len(names), at[0], at[1])
        yield pa.record_batch([pa.array(names, pa.int64()), pa.array(names[root], pa.int64())], names=["node", "root"])
    give_back()


def components(links: DataFrame, first: str = "a", second: str = "b", most_rounds: int = 60) -> DataFrame:
    """node, root for every node with a link to another; root is the smallest node reachable.

    Direction, repeats, self-links and null ends of links don't matter; an empty table gives no rows.
    """
    a, b = F.col(first).cast("long"), F.col(second).cast("long")
    links = written(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    mark = _mark(links)
    for _ in range(most_rounds):
        if mark[0] <= FEW:
            return links.coalesce(1).mapInArrow(_settled, "node long, root long")
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        old, large = links, written(large, "large")
        dropped(old)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        dropped(large)
        before, mark = mark, _mark(links)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    nodes = links.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(nodes)
