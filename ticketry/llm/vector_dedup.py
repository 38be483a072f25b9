"""Near duplicates among vectors of a label: learned binary codes, multi-index Hamming tables, exact comparison.

Rotations are learned by iterative quantisation. Every code is cut into substrings; codes that agree in one meet in a
bucket of that table, and those within the Hamming radius of the threshold (``z`` standard deviations included) become
candidates. Codes that differ in fewer bits than there are tables always meet, and the number of tables is such that a
pair at the threshold meets with probability ``recall``. Only codes go to the buckets. The original vectors of each group
of candidates are then brought together once and compared exactly, all pairs of the group.

Equal vectors of a label are one node with a number of copies; a node has a number of its own, and the smallest id of a
component is looked up at the end, so ids may repeat, also under several labels. Vectors of several lengths meet those of
their own length. A bucket or group above ``block_rows`` is dealt into
blocks, and each pair of blocks is one piece of work; pieces give out sums and one root a row, never pairs. So a group
that holds a third of all rows costs work, not memory or rows.

Defined cases: null labels and vectors that are null, zero, or with null or non-finite components link with nothing (n_links
0, own component); a null id gets n_links and the component of its group (null where no row of
it has an id), kept false; repeated ids are rows of their own; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm import codes
from ticketry.llm.common import give_back, small_batches, written
from ticketry.llm.components import components

PIECE = ["bucket", "low", "high"]


def table_shape(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """(width, tables): the width of a substring follows the logarithm of the rows, the tables follow the recall asked for."""
    width = max(8, round(np.log2(max(rows, 2))) - 4)
    meet = (1 - codes.bits_apart(threshold)) ** width
    return width, max(2, int(np.ceil(np.log(1 - recall) / np.log(1 - meet))))


def in_pieces(rows: DataFrame, bucket: str, size: str, block_rows: int, *columns: str) -> DataFrame:
    """``columns`` of ``rows`` dealt to the pieces of their buckets, sorted by piece: each block, and each pair of blocks."""
    blocks = F.ceil(F.col(size) / block_rows).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select(F.col(bucket).alias("bucket"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", *columns)
    return rows.repartition(*PIECE).sortWithinPartitions(*PIECE, "rep")


def by_piece(compare: Callable[[pd.DataFrame], np.ndarray], finish: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame]):
    """A function for mapInPandas: the links of each piece as a symmetric matrix, without those that its blocks' own pieces find; then ``finish``."""

    def one(group: pd.DataFrame) -> pd.DataFrame | None:
        linked = compare(group)
        if group["low"].iat[0] != group["high"].iat[0]:
            block = group["block"].to_numpy()
            linked &= block[:, None] != block[None, :]
        np.fill_diagonal(linked, False)
        return finish(group, linked) if linked.any() else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by piece; a piece may go over several batches."""
        rest = None
        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            change = np.nonzero((rest[PIECE].to_numpy()[1:] != rest[PIECE].to_numpy()[:-1]).any(axis=1))[0] + 1
            starts = [0, *change.tolist()]
            made = [one(rest.iloc[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True) if b - a > 1]
            rest = rest.iloc[starts[-1]:]
            if made := [m for m in made if m is not None]:
                yield pd.concat(made, ignore_index=True)
        if rest is not None and len(rest) > 1 and (last := one(rest)) is not None:
            yield last
        give_back()

    return run


def near_codes(radius: int):
    def compare(group: pd.DataFrame) -> np.ndarray:
        code = np.frombuffer(b"".join(group["code"]), np.uint64).reshape(len(group), -1)
        apart = np.zeros((len(code), len(code)), np.uint16)
        for word in code.T:
            apart += np.bitwise_count(word[:, None] ^ word[None, :])
        return apart <= radius

    return compare


def near_vectors(threshold: float):
    def compare(group: pd.DataFrame) -> np.ndarray:
        unit = np.frombuffer(b"".join(group["unit"]), "<f8").reshape(len(group), -1)
        return unit @ unit.T >= threshold

    return compare


def matrix_roots(linked: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each position of a symmetric matrix of links."""
    n = len(linked)
    root = np.arange(n, dtype=np.int32)
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], np.int32(n)).min(axis=1))
        low = low[low]
        if (low == root).all():
            return root
        root = low


def rooted(group: pd.DataFrame, linked: np.ndarray) -> pd.DataFrame:
    rep, root = group["rep"].to_numpy(), matrix_roots(linked)
    some = root != np.arange(len(rep))
    return pd.DataFrame({"rep": rep[some], "root": rep[root[some]]})


def counted(group: pd.DataFrame, linked: np.ndarray) -> pd.DataFrame:
    rep, root = group["rep"].to_numpy(), matrix_roots(linked)
    n = np.where(linked, group["copies"].to_numpy(np.int64)[None, :], 0).sum(axis=1)
    return pd.DataFrame({"rep": rep[n > 0], "n_links": n[n > 0], "root": rep[root[n > 0]]})


def near_duplicates(table: DataFrame, threshold: float = 0.93, recall: float = 0.995, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    z: float = 4.0, sample_rows: int = 4096, block_rows: int = 1024) -> DataFrame:
    """vec_id, n_links, component_id, kept per row."""
    small_batches(table.sparkSession)
    everything = table.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("_v"))
    hashed = lambda df: df.withColumn("h1", F.xxhash64("_v")).withColumn("h2", F.xxhash64(F.lit(1), F.col("_v")))
    rows = hashed(codes.vectors(everything.where("label IS NOT NULL"), "_v", "vec_id", "label"))
    same = rows.groupBy("label", "h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.min("_v").alias("_v"))
    nodes = written(same.withColumn("rep", F.monotonically_increasing_id()), "nodes")
    width, tables = table_shape(nodes.count(), threshold, recall)
    rotations = codes.learn_rotations(codes.sample_matrix(nodes, "h1", sample_rows, codes.longest(nodes)), width * tables)
    share = codes.bits_apart(threshold)
    radius = int(np.ceil(width * tables * share + z * np.sqrt(width * tables * share * (1 - share))))

    def coded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for length, part in frame.groupby("length"):
                x = np.stack(part["_v"].tolist())
                bits = codes.sign_bits(x, rotations)
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                yield pd.DataFrame({"rep": part["rep"], "label": part["label"], "length": length, "copies": part["copies"], "code": [c.tobytes() for c in codes.pack(bits)],
                                    "parts": [p for p in codes.substrings(bits, width)], "unit": [u.astype("<f8").tobytes() for u in unit]})

    kind = nodes.schema["label"].dataType.simpleString()
    code = written(nodes.select("rep", "label", F.size("_v").alias("length"), "copies", "_v").mapInPandas(
        coded, f"rep long, label {kind}, length int, copies long, code binary, parts array<long>, unit binary"), "codes")

    # candidates: codes that meet in a bucket and are near
    slots = code.select("rep", "code", "label", "length", F.posexplode("parts").alias("tab", "value")).select(
        "rep", "code", F.xxhash64("label", "length", "tab", "value").alias("slot"))
    sizes = slots.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1")
    met = in_pieces(slots.join(sizes, "slot"), "slot", "n", block_rows, "code")
    near = written(met.mapInPandas(by_piece(near_codes(radius), rooted), "rep long, root long").distinct(), "near")
    group = written(components(near, "rep", "root").select(F.col("node").alias("rep"), F.col("root").alias("cand")), "groups")

    # links: all pairs of a group, by their vectors
    members = code.select("rep", "copies", "unit").join(group, "rep")
    sizes = group.groupBy("cand").agg(F.count("*").alias("n"))
    pieces = in_pieces(members.join(sizes, "cand"), "cand", "n", block_rows, "copies", "unit")
    found = written(pieces.mapInPandas(by_piece(near_vectors(threshold), counted), "rep long, n_links long, root long"), "found")
    linked = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    group = components(found, "rep", "root")
    named = nodes.select("rep", "label", "h1", "h2", "copies", "least").join(linked, "rep", "left").join(group, F.col("rep") == F.col("node"), "left")
    named = named.withColumn("root", F.coalesce("root", "rep"))
    smallest = named.groupBy("root").agg(F.min("least").alias("smallest"))
    known = named.join(smallest, "root").select(
        F.col("label").alias("_label"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"),
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.lit(True).alias("_node"), "smallest")
    all_rows = hashed(everything.withColumn("_ok", codes.usable(F.col("_v"))))
    joined = all_rows.join(known, F.col("_ok") & (F.col("label") == F.col("_label")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("_node"), F.col("smallest")).otherwise(F.col("vec_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT a, a AS root FROM l UNION SELECT l.a, r.root FROM r JOIN l ON l.b = r.a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.root, e.vec_id) AS component_id, e.vec_id = coalesce(c.root, e.vec_id) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) n ON n.a = e.vec_id
LEFT JOIN (SELECT a, min(root) AS root FROM r GROUP BY a) c ON c.a = e.vec_id
"""
