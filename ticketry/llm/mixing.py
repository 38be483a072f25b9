"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, epoch after epoch. A document's virtual finish time is the
number of source words up to and including it, divided by the source's target. All queues reach 1 at their targets, so
the mix is the front of the global order by finish time, cut off at the total budget.

Running sums are taken in two steps: totals of bins of the shuffle key, then a window inside each bin. A bin holds about
``bin_rows`` rows whatever the size of its source, so a hot source is spread like the others. No text is shuffled.

Defined cases: null text has size 0; a null source is a source (the last); a null doc_id takes part like any other;
rows equal in doc_id, source and size are one unit of several rows while they queue, and come out as rows again; ties in
finish time are broken by source, epoch, shuffle key, doc_id and size; an empty table gives no rows; documents without
words are never taken (taken 0). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketry.llm.common import n_words, written

COLUMNS = "doc_id", "size", "source_size", "target", "taken"


def source_targets(sizes: DataFrame, weights: Sequence[int], repeats: int, share: float) -> DataFrame:
    """source, source_size, src (from 1), target, from rows (source, words).

    ``share`` of all words is dealt by weight; what a source gets beyond ``repeats`` times its size goes to the others by
    weight until none is above. In order of size over weight, the sources that stop at their limit come first, so one
    pass finds the level of the rest. The windows see one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("words").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(int(w)) for w in weights])
    s = per_source.withColumn("src", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(weight, ((F.col("src") - 1) % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "src")
    cap = F.col("source_size") * repeats
    s = (s.withColumn("before", F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("total", F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    level = (F.col("total") * F.lit(float(share)) - F.col("before")) / F.col("rest")
    fits = level * F.col("weight") <= cap
    s = s.withColumn("level", F.min(F.when(fits, F.struct(F.col("before"), level.alias("level")))).over(
        order.rowsBetween(Window.unboundedPreceding, 0)).getField("level"))
    return s.select("source", "source_size", "src", F.coalesce(F.col("level") * F.col("weight"), cap.cast("double")).alias("target"))


def shuffle_key(seed: str):
    """60 bits of a hash of document and epoch: the shuffled order, the same on every run."""
    text = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("epoch").cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), repeats: int = 3, share: float = 1.0, seed: str = "mix",
         bin_rows: int = 4096) -> DataFrame:
    """One row per unit of equal rows: doc_id, source, size, rows, source_size, target, copies (list: rows taken, by epoch)."""
    spark = docs.sparkSession
    units = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
                    .groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "units")
    targets = written(source_targets(units.select("source", (F.col("size") * F.col("rows")).alias("words")), weights, repeats, share),
                      "targets")
    first = units.agg(F.count("*"), F.sum(F.col("size") * F.col("rows"))).first()
    n_units, budget = first[0], int((first[1] or 0) * share)
    bits = max(0, (max(1, n_units) // bin_rows).bit_length())

    last = F.least(F.lit(repeats - 1), F.floor(F.col("target") / F.col("source_size")).cast("int"))
    queued = (units.join(targets, units["source"].eqNullSafe(targets["source"])).drop(targets["source"])
              .where("size > 0 AND target > 0")
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), last)))
              .withColumn("key", shuffle_key(seed)).withColumn("bin", F.shiftright("key", 60 - bits))
              .withColumn("words", F.col("size") * F.col("rows")))
    starts = queued.groupBy("src", "epoch", "bin").agg(F.sum("words").alias("in_bin"))
    starts = starts.withColumn("start", F.sum("in_bin").over(
        Window.partitionBy("src").orderBy("epoch", "bin")) - F.col("in_bin")).drop("in_bin")
    inside = Window.partitionBy("src", "epoch", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    finish = (queued.withColumn("until", F.sum("words").over(inside)).join(starts, ["src", "epoch", "bin"])
              .withColumn("vft", (F.col("start") + F.col("until")) / F.col("target"))
              .withColumn("slot", F.floor(F.least(F.col("vft"), F.lit(4.0)) * (1 << bits)).cast("long")))
    finish = written(finish.select("doc_id", "source", "size", "rows", "source_size", "target", "src", "epoch", "key", "words", "vft",
                                   "slot"), "finish")

    slots = finish.groupBy("slot").agg(F.sum("words").alias("words"))
    slots = slots.withColumn("until", F.sum("words").over(Window.orderBy("slot")))
    crossing = slots.where(F.col("until") > budget).orderBy("slot").limit(1).collect()
    slot, left = (crossing[0]["slot"], budget - (crossing[0]["until"] - crossing[0]["words"])) if crossing else (None, 0)
    if slot is None:
        chosen = finish.withColumn("n", F.col("rows"))
    else:  # the slot in which the budget ends is ordered row by row
        order = Window.orderBy("vft", "src", "epoch", "key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
        room = F.floor((F.lit(left) - F.col("upto") + F.col("words")) / F.col("size")).cast("long")
        edge = (finish.where(F.col("slot") == slot).withColumn("upto", F.sum("words").over(order))
                .withColumn("n", F.greatest(F.lit(0), F.least(F.col("rows"), room))).drop("upto")
                .where(F.col("n") > 0))
        chosen = finish.where(F.col("slot") < slot).withColumn("n", F.col("rows")).unionByName(edge)
    copies = chosen.groupBy("doc_id", "source", "size").agg(F.collect_list("n").alias("copies"))
    same = [units[c].eqNullSafe(copies[c]) for c in ("doc_id", "source", "size")]
    out = units.join(copies, same, "left").select(*[units[c] for c in ("doc_id", "source", "size", "rows")], "copies")
    return (out.join(targets, out["source"].eqNullSafe(targets["source"])).drop(targets["source"])
            .withColumn("copies", F.coalesce("copies", F.array().cast("array<bigint>"))))


def mix(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words that the mix takes, repeats counted)."""
    rows = plan(docs, **how).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    times = F.size(F.filter("copies", lambda n: n >= F.col("i")))
    return rows.select("doc_id", "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"))


def some_rows(rows: DataFrame, n: int) -> DataFrame:
    """``n`` of the rows (fewer than there are), those with the smallest hashes of all columns; equal rows are counted, not ordered."""
    h = F.xxhash64(*[rows[c] for c in rows.columns])
    counts = written(rows.groupBy(h.alias("h")).agg(F.count("*").alias("rows")).withColumn("bin", F.shiftright("h", 52)), "hashes")

    def crossing(of: DataFrame, key: str, most: int):
        until = F.sum("rows").over(Window.orderBy(key))
        return of.withColumn("until", until).where(F.col("until") >= most).orderBy(key).first()

    at = crossing(counts.groupBy("bin").agg(F.sum("rows").alias("rows")), "bin", n)
    n -= at["until"] - at["rows"]
    at = crossing(counts.where(F.col("bin") == at["bin"]), "h", n)
    n -= at["until"] - at["rows"]
    last = rows.where(h == at["h"]).limit(1)
    copies = rows.sparkSession.range(n).crossJoin(F.broadcast(last)).select(*[last[c] for c in rows.columns])
    return rows.where(h < at["h"]).unionByName(copies)


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix with all their columns, one row for each time a document is taken.

    Where the budget ends inside a unit of several rows, as many of them come once more as fit, as in ``mix``.
    """
    planned = written(plan(docs, **how).where(F.size("copies") > 0).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("rows").alias("_rows"),
        F.size(F.filter("copies", lambda n: n >= F.col("rows"))).alias("_times"), F.array_min("copies").alias("_least")), "planned")
    # the plan has a row per document: it is never broadcast, so the join is the same at every size
    taken = docs.join(planned.where("_times > 0").hint("merge"), docs["doc_id"].eqNullSafe(planned["_id"]) & docs["source"].eqNullSafe(planned["_source"])
                      & (n_words(docs["text"]) == planned["_size"]))
    taken = taken.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*[docs[c] for c in docs.columns])
    for unit in planned.where("_least < _rows").collect():  # the budget ends in one unit and epoch at most
        same = docs["doc_id"].eqNullSafe(F.lit(unit["_id"])) & docs["source"].eqNullSafe(F.lit(unit["_source"])) & (n_words(docs["text"]) == unit["_size"])
        taken = taken.unionByName(some_rows(docs.where(same), unit["_least"]))
    return taken


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS src FROM s0),
s2 AS (SELECT *, [5, 2, 1][(src - 1) % 3 + 1] AS weight FROM s1),
s3 AS (SELECT *, coalesce(sum(source_size * 3) OVER (ORDER BY source_size / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(weight) OVER (ORDER BY source_size / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(source_size) OVER () AS total FROM s2),
s4 AS (SELECT *, (total - before)::DOUBLE / rest::DOUBLE AS level FROM s3),
lv AS (SELECT arg_min(level, before) AS level, min(before) AS from_before FROM s4 WHERE level * weight <= source_size * 3),
s AS (SELECT source, source_size, src, CASE WHEN before >= from_before THEN lv.level * weight ELSE source_size * 3 END::DOUBLE AS target FROM s4, lv),
q AS (SELECT d.*, s.src, s.source_size, s.target, e.epoch,
  ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || e.epoch::VARCHAR), 1, 15))::BIGINT AS key
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source, (SELECT unnest([0, 1, 2]) AS epoch) e
  WHERE size > 0 AND e.epoch <= least(2, floor(target / s.source_size))),
f AS (SELECT *, sum(size) OVER (PARTITION BY src ORDER BY epoch, key, doc_id, size ROWS UNBOUNDED PRECEDING)::DOUBLE / target AS vft FROM q),
g AS (SELECT *, sum(size) OVER (ORDER BY vft, src, epoch, key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM f),
t AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM g WHERE upto <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT d.doc_id, d.size, s.source_size, s.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source LEFT JOIN t ON d.doc_id IS NOT DISTINCT FROM t.doc_id
"""
