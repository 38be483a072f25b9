"""What five document filters remove, in every order of the filters, from one pass over the texts.

A table-driven byte transducer reads the UTF-8 bytes of a text once. Its states are "between words" and "in a word"; a
table gives for each state and byte the next state and what the byte counts for (a code point, a capital, a symbol, the
first byte of a word, the first byte after one). The next state does not depend on the state before, so a whole block of
bytes runs through the tables at once. The word spans go into a hash table with open addresses: words of one document meet
in a slot by their hash and count as equal only after their bytes were compared.

Only digests, filter outcomes and ids leave a text's task. Copies are found by SHA-256, pre-aggregated with the outcomes,
so a text that a third of all documents share is a few rows a task. All 120 orders are then read off 32 counts a part.

Defined cases: null text is an empty one (and a copy of it); a null source is part ''; a null doc_id is no copy of
anything and makes no other row one; repeated ids and rows count as often as they come, and the rows of the smallest id
are all no copies; several labels for an id count as 1 if one of them is 1; labels without document are not read; bytes
that are no UTF-8 are counted by their lead bytes. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import give_back, small_batches, written

FILTERS = "ABCDE"
POINT, CAPITAL, SYMBOL, OPENS, CLOSES = 1, 2, 4, 8, 16
OUTSIDE, INSIDE = 0, 1


def tables() -> tuple[np.ndarray, np.ndarray]:
    """next state [256] (the same from both states) and output bits [state, 256]."""
    byte = np.arange(256)
    blank = (byte == 0x20) | ((byte >= 0x09) & (byte <= 0x0D))
    state = np.where(blank, OUTSIDE, INSIDE).astype(np.uint8)
    out = np.where(byte & 0xC0 != 0x80, POINT, 0) | np.where((byte >= 0x41) & (byte <= 0x5A), CAPITAL, 0) | np.where(np.isin(byte, list(b"#$%&*|")), SYMBOL, 0)
    opens, closes = np.where(blank, 0, OPENS), np.where(blank, CLOSES, 0)
    return state, np.stack([out | opens, out | closes]).astype(np.uint8)


NEXT, OUT = tables()
ODD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Mask of the lowest n bytes of eight.
LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class WordTable:
    """Distinct words of documents: open addresses, claimed by hash, settled by comparing bytes.

    ``eight`` holds at each position the eight bytes from there on as one integer. Words of up to ``SHORT`` bytes are hashed
    and compared eight bytes at a time, all words at once; longer ones one by one.
    """

    SHORT = 64

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, doc: np.ndarray) -> None:
        self.data, self.start, self.length, self.doc = data, start, length, doc
        self.eight = np.ndarray(max(0, len(data) - 7), "<u8", data, strides=(1,))
        self.mask = np.uint64((1 << max(3, (2 * len(start)).bit_length())) - 1)
        self.owner = np.full(int(self.mask) + 1, -1, np.int64)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of document, length and bytes."""
        with np.errstate(over="ignore"):
            h = (self.doc.astype(np.uint64) + np.uint64(1)) * ODD ^ self.length.astype(np.uint64)
            rows, done = np.nonzero(self.length <= self.SHORT)[0], 0
            while len(rows):
                h[rows] = (h[rows] ^ (self.eight[self.start[rows] + done] & LOW[np.minimum(self.length[rows] - done, 8)])) * MIX
                h[rows] ^= h[rows] >> np.uint64(31)
                done += 8
                rows = rows[self.length[rows] > done]
            for i in np.nonzero(self.length > self.SHORT)[0].tolist():
                h[i] ^= np.uint64(int.from_bytes(hashlib.blake2b(self._bytes(i), digest_size=8).digest(), "little"))
            return h * MIX ^ h >> np.uint64(32)

    def _bytes(self, i: int) -> memoryview:
        return memoryview(self.data)[self.start[i]:self.start[i] + self.length[i]]

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words ``a`` and ``b``, pairwise of the same length, have the same bytes."""
        same = np.ones(len(a), bool)
        length = self.length[a]
        rows, done = np.nonzero(length <= self.SHORT)[0], 0
        while len(rows):
            apart = self.eight[self.start[a[rows]] + done] ^ self.eight[self.start[b[rows]] + done]
            agree = apart & LOW[np.minimum(length[rows] - done, 8)] == 0
            same[rows[~agree]] = False
            done += 8
            rows = rows[agree & (length[rows] > done)]
        for i in np.nonzero(length > self.SHORT)[0].tolist():
            same[i] = self._bytes(a[i]) == self._bytes(b[i])
        return same

    def first_of_their_kind(self) -> np.ndarray:
        """Insert all words; whether each is the first of its kind in its document."""
        hashes, fresh = self.hashes(), np.zeros(len(self.start), bool)
        slot, left = hashes & self.mask, np.arange(len(self.start))
        while len(left):
            here = slot[left]
            free = self.owner[here] < 0
            self.owner[here[free][::-1]] = left[free][::-1]  # of several words the first claims the slot
            owner = self.owner[here]
            own = owner == left
            fresh[left[own]] = True
            rest, owner = left[~own], owner[~own]
            alike = (hashes[rest] == hashes[owner]) & (self.length[rest] == self.length[owner]) & (self.doc[rest] == self.doc[owner])
            some = np.nonzero(alike)[0]
            alike[some] = self.equal(rest[some], owner[some])
            left = rest[~alike]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask
        return fresh


def measure(data: np.ndarray, offsets: np.ndarray, block: int = 1 << 20) -> dict[str, np.ndarray]:
    """words, distinct, points, capitals, symbols of each document data[offsets[i]:offsets[i + 1]].

    The state starts anew at each document, and the end of a document closes its last word.
    """
    data = np.concatenate([data[offsets[0]:offsets[-1]], np.zeros(8, np.uint8)])
    offsets = offsets - offsets[0]
    docs, size, first = len(offsets) - 1, int(offsets[-1]), offsets[:-1]
    total = {bit: np.zeros(docs, np.int64) for bit in (POINT, CAPITAL, SYMBOL)}
    opens, closes, state = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], OUTSIDE
    for low in range(0, size, block):
        part = data[low:min(low + block, size)]
        after = NEXT[part]
        before = np.empty_like(after)
        before[0], before[1:], state = state, after[:-1], int(after[-1])
        begin = first[(first >= low) & (first < low + len(part))] - low
        cut = begin[before[begin] == INSIDE]
        before[begin] = OUTSIDE
        out = OUT[before, part]
        # the documents that this block touches, and the part of each that lies in it
        a, b = int(np.searchsorted(offsets, low, "right")) - 1, int(np.searchsorted(offsets, low + len(part), "left"))
        edges = np.clip(offsets[a:b + 1], low, low + len(part)) - low
        for bit, sums in total.items():
            run = np.concatenate([[0], np.cumsum(out & bit != 0)])
            sums[a:b] += run[edges[1:]] - run[edges[:-1]]
        opens.append(np.nonzero(out & OPENS)[0] + low)
        closes.append(np.union1d(np.nonzero(out & CLOSES)[0], cut) + low)
    if state == INSIDE:
        closes.append(np.array([size]))
    start, end = np.concatenate(opens), np.concatenate(closes)
    doc = np.searchsorted(offsets, start, "right") - 1
    fresh = WordTable(data, start, end - start, doc).first_of_their_kind()
    return {"words": np.bincount(doc, minlength=docs), "distinct": np.bincount(doc[fresh], minlength=docs), "points": total[POINT],
            "capitals": total[CAPITAL], "symbols": total[SYMBOL]}


def failures(found: dict[str, np.ndarray], least_words: int, distinct_percent: int, capital_percent: int) -> np.ndarray:
    """Bits of the filters A to D that a document fails."""
    return ((found["words"] < least_words) * 1 | (100 * found["distinct"] < distinct_percent * found["words"]) * 2
            | (100 * found["capitals"] > capital_percent * found["points"]) * 4 | (found["symbols"] > 0) * 8).astype(np.int32)


def groups_of(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents of ``most`` bytes together at most; a longer one comes alone."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b
        a = b


def outcomes(docs: DataFrame, least_words: int = 200, distinct_percent: int = 50, capital_percent: int = 2) -> DataFrame:
    """doc_id, part, digest of the text, fails (bits of A to D) and the counts per document."""
    small_batches(docs.sparkSession)
    columns = ["words", "distinct", "points", "capitals", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            made = [measure(data, offsets[a:b + 1]) for a, b in groups_of(offsets, 1 << 20)]
            found = {c: np.concatenate([m[c] for m in made]) if made else np.zeros(0, np.int64) for c in columns}
            raw = memoryview(data)
            digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            fails = failures(found, least_words, distinct_percent, capital_percent)
            yield pa.record_batch([batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(fails), *[pa.array(found[c]) for c in columns]],
                                  names=["doc_id", "part", "digest", "fails", *columns])
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, fails int, " + ", ".join(f"{c} long" for c in columns))


def patterns(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """part, fails (bits of A to E), n, good, toxic: documents by the filters they fail."""
    units = written(outcomes(docs, **limits).groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n")), "units")
    one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
    marks = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality"), one("toxic"))
    known = units.where("doc_id IS NOT NULL").join(marks, "doc_id", "left").fillna(0, ["quality", "toxic"])
    known = known.unionByName(units.where("doc_id IS NULL").withColumns({"quality": F.lit(0), "toxic": F.lit(0)}))
    # of rows alike in all that is counted only the number is kept, and how many of them bear the smallest id
    key = ["digest", "part", "fails", "quality", "toxic"]
    alike = known.groupBy(*key).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
                                    F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("low"))
    alike = written(alike, "alike")
    firsts = alike.groupBy("digest").agg(F.min("low.doc_id").alias("first"), F.count("*").alias("kinds"))
    # a text whose rows are all of one kind needs no join; the others have the first id of their text brought to them
    several = firsts.where("kinds > 1").select("digest", "first")
    placed = alike.join(several, "digest", "left")
    stay = F.col("nameless") + F.when(F.col("low").isNotNull() & (F.col("low.doc_id") == F.coalesce("first", "low.doc_id")), F.col("low.n")).otherwise(0)
    placed = placed.select("part", "fails", "quality", "toxic", F.explode(F.array(
        F.struct(F.lit(0).alias("copy"), stay.alias("n")), F.struct(F.lit(16).alias("copy"), (F.col("n") - stay).alias("n")))).alias("k"))
    n = F.col("k.n")
    return placed.groupBy("part", (F.col("fails").bitwiseOR(F.col("k.copy"))).alias("fails")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("quality")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bits of the filters before, bit of this one) of all orders."""
    return [("".join(p), i + 1, sum(1 << FILTERS.index(x) for x in p[:i]), 1 << FILTERS.index(p[i])) for p in permutations(FILTERS) for i in range(len(p))]


def audit(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """One row per part, filter_order and step with the counts after, at and outside this step."""
    counts = patterns(docs, labels, **limits)
    sums = [F.coalesce(F.sum(F.when(F.col("fails") == p, F.col(c))), F.lit(0)).alias(f"{c}{p}") for c in ("n", "good", "toxic") for p in range(32)]
    parts = counts.groupBy("part").agg(*sums)
    parts = parts.select("part", *[F.array(*[f"{c}{p}" for p in range(32)]).alias(c) for c in ("n", "good", "toxic")])
    every = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("filter_order", "step", "before", "bit"), s, strict=True)]) for s in steps()])
    rows = parts.withColumn("s", F.explode(every)).select("part", "s.*", "n", "good", "toxic")

    def over(of: str, when) -> Column:
        add = lambda total, p: total + F.when(when(p), F.get(F.col(of), p)).otherwise(0)
        return F.aggregate(F.sequence(F.lit(0), F.lit(31)), F.lit(0).cast("long"), add)

    has = lambda p: p.bitwiseAND(F.col("bit")) != 0
    passed = lambda p: p.bitwiseAND(F.col("before")) == 0
    # of the 120 orders a document with m failing filters is removed by each of these in 120 / m
    turns = F.aggregate(F.sequence(F.lit(0), F.lit(31)), F.lit(0).cast("long"), lambda total, p: total + F.when(
        has(p), F.get(F.col("n"), p) * F.floor(F.lit(120) / F.bit_count(p))).otherwise(0))
    return rows.select(
        "part", "filter_order", "step", over("n", lambda p: passed(p) & ~has(p)).alias("kept"), over("n", lambda p: passed(p) & has(p)).alias("removed"),
        over("n", lambda p: ~passed(p) & has(p)).alias("redundant"), over("n", lambda p: p == F.col("bit")).alias("unique_fails"),
        over("good", lambda p: passed(p) & has(p)).alias("good_lost"), over("toxic", lambda p: passed(p) & has(p)).alias("toxic_lost"), turns.alias("shapley"))


ORACLE = r"""
WITH RECURSIVE l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
d AS (SELECT t.doc_id, part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, len(w) < 200 AS A, 100 * len(list_distinct(w)) < 50 * len(w) AS B,
  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS C, regexp_matches(text, '[#$%&*|]') AS D,
  coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) AS E FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
c AS (SELECT part, (A::INT + 2 * B::INT + 4 * C::INT + 8 * D::INT + 16 * E::INT)::INT AS p, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY 1, 2),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit)),
o AS (SELECT '' AS o, 0 AS used UNION ALL SELECT o || f, used + bit FROM o, f WHERE used & bit = 0),
s AS (SELECT o AS filter_order, i AS step, (SELECT bit FROM f WHERE f.f = substr(o, i, 1)) AS bit,
  coalesce((SELECT sum(bit) FROM f WHERE contains(substr(o, 1, i - 1), f.f)), 0)::INT AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5])::INT AS i) WHERE length(o) = 5)
SELECT part, filter_order, step, sum(CASE WHEN p & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN p & before = 0 AND p & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN p & before <> 0 AND p & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN p = bit THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN p & before = 0 AND p & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN p & before = 0 AND p & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
  sum(CASE WHEN p & bit <> 0 THEN n * (120 // bit_count(p)) ELSE 0 END)::BIGINT AS shapley
FROM c, s GROUP BY part, filter_order, step
"""
