"""Centroid clustering of integer vectors with Spark expressions only.

Each round is one aggregate over the vectors: ``zip_with`` and ``aggregate`` give the squared distance of a vector to each
centroid, which stands in the expression as a literal array; ``array_min`` over structs (distance, number) picks the
cluster; sums of the components by cluster, one plain column each, update the centroids. Only k rows of sums come to the
driver, whatever the number of vectors, and every task adds up its own vectors before the shuffle. A hot cluster is one row
a task.

Vectors are turned to integers once and written as a table in the shared folder, which all rounds read.

Defined cases: vectors that are null, of another length, or with null or non-finite components are left out. Components
beyond +-2^27 after scaling count as +-2^27, so that every squared distance fits a long. Ties in distance go to the smaller
number. Rows with the same id are vectors of their own; ids equal in the seed's order are ordered by their vectors, null
ids come last. With fewer than k vectors there are fewer centroids; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import written

LIMIT = 1 << 27


@dataclass(frozen=True)
class Clustering:
    """``assigned``: vec_id, cluster, distance per vector; ``centroids``: the final ones; ``inertia``: by cluster."""

    assigned: DataFrame
    centroids: list[list[int]]
    inertia: list[int]


def integers(table: DataFrame, key: str, vector: str, width: int, scale: int) -> DataFrame:
    """vec_id and array ``x`` of floor(scale * component) of the vectors that take part."""
    v = F.col("_v")
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v"))
    fine = F.forall(v, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    whole = F.transform(v, lambda a: F.floor(F.least(F.greatest(a * F.lit(float(scale)), F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("long"))
    return rows.where(F.coalesce((F.size(v) == width) & fine, F.lit(False))).select("vec_id", whole.alias("x"))


def nearest(x: Column, centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid; the smaller number on ties."""

    def distance(c: list[int]) -> Column:
        squares = F.zip_with(x, F.lit(c).cast("array<bigint>"), lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, s: total + s)

    return F.array_min(F.array(*[F.struct(distance(c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]))


def cluster(table: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: str = "3", key: str = "vec_id",
            vector: str = "embedding") -> Clustering:
    """``rounds`` updates from the k vectors with the smallest SHA-256 of ``seed:id``, then one more assignment."""
    rows = written(integers(table, key, vector, width, scale), "integers")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    centroids = [list(r["x"]) for r in rows.orderBy(order.asc_nulls_last(), "x").limit(k).select("x").collect()]
    if not centroids:
        none = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clustering(none, [], [])
    for _ in range(rounds):
        placed = rows.select(nearest(F.col("x"), centroids)["cluster"].alias("cluster"), "x")
        parts = placed.select("cluster", *[F.col("x")[i].alias(f"x{i}") for i in range(width)])
        # sums of +-2^27 fit a long up to 2^36 vectors; beyond that ANSI arithmetic fails and gives no wrong sum
        sums = parts.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(width)]).collect()
        for r in sums:
            centroids[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    assigned = written(rows.select("vec_id", nearest(F.col("x"), centroids).alias("_at")).select("vec_id", "_at.cluster", "_at.distance"), "assigned")
    inertia = [0] * len(centroids)
    for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect():
        inertia[r["cluster"]] = r["s"]
    return Clustering(assigned, centroids, inertia)


def clusters(table: DataFrame, **how) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per vector."""
    made = cluster(table, **how)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in made.centroids]
    at = lambda values, kind: F.element_at(F.lit(values).cast(f"array<{kind}>"), F.col("cluster") + 1) if values else F.lit(None).cast(kind)
    return made.assigned.select(
        "vec_id", "cluster", "distance", at(made.inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(made.inertia)).cast("long").alias("inertia"), at(digests, "string").alias("centroid_sha256"))


def oracle(k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: str = "3") -> str:
    """The same rows for rows with different ids."""
    near = f"list_sum(list_transform(range(1, {width + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT"
    steps = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda a: floor({scale} * a::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda a: a IS NULL OR isnan(a) OR isinf(a))) = 0)""",
             f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS cluster, x FROM v ORDER BY cluster LIMIT {k})"]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT v.vec_id, min(struct_pack(distance := {near}, cluster := c.cluster)) AS best FROM v, c{r} c GROUP BY v.vec_id)""")
        if r < rounds:
            steps.append(f"""m{r} AS MATERIALIZED (SELECT a.best.cluster AS cluster, i, sum(v.x[i])::BIGINT AS s, count(*) AS n FROM a{r} a JOIN v USING (vec_id), range(1, {width + 1}) t(i) GROUP BY 1, 2),
c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(n.x, c.x) AS x FROM c{r} c LEFT JOIN (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM m{r} GROUP BY cluster) n USING (cluster))""")
    return f"""WITH {", ".join(steps)},
f AS (SELECT vec_id, best.cluster AS cluster, best.distance AS distance FROM a{rounds})
SELECT f.vec_id, f.cluster::INTEGER AS cluster, f.distance, (sum(f.distance) OVER (PARTITION BY f.cluster))::BIGINT AS cluster_inertia,
  (sum(f.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM f JOIN c{rounds} c USING (cluster)"""


ORACLE = oracle()
