"""Joins of a large side with a learned table, with the size checked and hot keys spread out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 1_000_000
SALTS = 64


def proven_small(table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``table`` has at most ``max_rows`` rows and ``max_bytes`` of text and numbers.

    A distributed count and sum; no row leaves its task.
    """
    size = F.lit(0)
    for field in table.schema.fields:
        if field.dataType.simpleString() == "string":
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif field.dataType.simpleString() in ("array<double>", "array<bigint>"):
            size = size + 16 + 8 * F.coalesce(F.size(field.name), F.lit(0))
        else:
            size = size + F.lit(16)
    row = table.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def lookup_join(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], spread_by: Sequence[str],
    hot_rows: int = HOT_ROWS, salts: int = SALTS,
    max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join of ``rows`` with ``table`` (unique per key); no row of ``rows`` is lost.

    A table proven small is broadcast. Otherwise both sides shuffle, and a key with at least
    ``hot_rows`` rows is spread over ``salts`` partitions: its table row is repeated once per
    salt and its rows are dealt out by a hash of ``spread_by`` (a row id). There are at most
    rows / hot_rows hot keys, so the list of them is small. Rows with a NULL in their key match
    nothing and are dealt out in the same way. Nothing is cached; the one job at build time is the
    check of the table's size.
    """
    keys = list(keys)
    if proven_small(table, max_rows, max_bytes):
        return rows.join(F.broadcast(table), keys, "left")
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    deal = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    hot = rows.where(~no_key).groupBy(*keys).count().where(F.col("count") >= hot_rows).select(*keys, F.lit(True).alias("_hot"))
    # rows without a key meet the list of hot keys under salted names too
    names = [f"_key_{i}" for i in range(len(keys))]
    spread = {n: F.when(no_key, F.concat(F.lit("null"), deal.cast("string"))).otherwise(F.concat(F.lit("="), F.col(k).cast("string")))
              for n, k in zip(names, keys)}
    named_hot = hot.select(*[F.concat(F.lit("="), F.col(k).cast("string")).alias(n) for n, k in zip(names, keys)], "_hot")
    salted_rows = rows.withColumns(spread).join(named_hot, names, "left").withColumn(
        "_salt", F.when(F.col("_hot"), deal).otherwise(F.lit(0)))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    named_table = table.where(~no_key).withColumns({n: F.concat(F.lit("="), F.col(k).cast("string")) for n, k in zip(names, keys)})
    salted_table = named_table.join(named_hot, names, "left").withColumn("_salt", F.explode(copies)).drop("_hot", *keys)
    return salted_rows.join(salted_table, [*names, "_salt"], "left").drop("_salt", "_hot", *names)


def digested(df: DataFrame, *columns: str) -> DataFrame:
    """Long texts replaced by their SHA-256, so that grouping or joining on them moves 64 bytes
    per row instead of the text. NULL stays NULL."""
    return df.withColumns({c: F.sha2(c, 256) for c in columns})


def known_keys(train: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Distinct keys of ``train`` that are not NULL, with a true flag to join on."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return train.where(present).select(*keys).distinct().withColumn(flag, F.lit(True))
