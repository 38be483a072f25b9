"""Similarity join of documents on word shingles by vertical partitioning.

The global order of shingles is that of their 64-bit hashes. It is cut into fragments, and a document's set into one
segment per fragment. A pair with Jaccard similarity of ``percent`` / 100 differs in a bounded number of shingles, fewer
than there are fragments for its size, so at least one segment is the same in both: only documents with an equal segment
are compared. There are more fragments per size class than the bound asks for (the larger document decides the class; one
near the next class carries that class's segments too). By that surplus a document may leave out two kinds of segments that
documents share by chance: its thinnest, up to some number of shingles, and of those that others hold too its commonest, down
to some number of holders. Size and holders are the same for both documents of a pair, so what either leaves out is what the
one with the further limit leaves out: fewer segments than they share. No pair above the threshold is missed.

Documents with equal sets are one class. Segments are shuffled once and their holders counted in one pass over their order.
Equal segments join classes into candidate groups (a minimum by segment, then connected components). A group beyond one block is
mostly held together by what short documents share by chance, and grows faster than the corpus. It is parted again, by its rarest
shingles: two documents above the threshold share one of the first n - ceil(n * percent / 100) + 1 of each, ordered by the number of
classes of the group that hold a shingle. The texts of groups
of two and more are brought together once. There the overlaps are counted fragment by fragment and summed per pair. A group beyond one
block is dealt into blocks: each block is compared inside and with a few leaders of its group; what is not yet connected
with the largest part of its group is dealt into blocks of its own, which are compared with all blocks. Nothing lists the
pairs of a group.

The driver holds no table beyond ``BROADCAST_BYTES``. Where more rows are to meet the texts, a table of one bit per hash says which
texts may be asked for, and only those are shuffled.

Defined cases: null text is an empty one; texts without words have no set, n_shingles 0 and their own component; with
fewer words than a shingle the whole sequence is the one shingle; repeated rows and ids come out as often, an id on several
texts with the group of each; a null doc_id
gets the component of its group, or null; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketry.llm.common import dropped, give_back, small_batches, written
from ticketry.llm.components import components, roots

GROWTH = 1.6
#: The largest table of chosen rows that is sent to every task, and held by the driver for that, instead of shuffling texts to it.
BROADCAST_BYTES = 32 << 20
#: Bits of the table that tells beyond it which texts may be chosen.
MARKS = 1 << 25
#: Size classes that a segment's name has room for, and the rows of one segment that wait in a task's memory.
SIZE_CLASSES, HELD = 64, 1 << 20
#: Classes that a task remembers, so that copies of a text don't give its segments again.
MET_CLASSES = 1 << 19
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[3]
    h = (h ^ (h >> np.uint64(29))) * _ODD[0]
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, width: int = 3) -> np.ndarray:
    """The ascending distinct hashes of a text's shingles; A-Z are lower-cased, words end at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    one = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(one, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    total = np.full(n, min(len(h), width), np.uint64)
    for i in range(min(width, len(h))):
        total = _mixed(total * _ODD[1] + h[i:i + n] * _ODD[2])
    return np.unique(total)


def size_classes(most: int, percent: int) -> list[int]:
    """Lower ends of the size classes up to ``most``; sets below the first have no near duplicate but an equal one."""
    ends = [100 // (100 - percent)]
    while ends[-1] <= most:
        ends.append(int(ends[-1] * GROWTH) + 1)
    return ends


def fragments(high: int, percent: int) -> tuple[int, int, int]:
    """(fragments, thin, common) for pairs whose larger set has less than ``high`` shingles: of its segments a document may leave
    out ``thin`` for their size and ``common`` for their frequency."""
    needed = 2 * (high - 1) * (100 - percent) // (100 + percent) + 1
    thin, common = 2 + needed // 3, 1 + needed // 8
    return needed + thin + common, thin, common


def segments(sets: np.ndarray, percent: int, ends: list[int]) -> np.ndarray:
    """Hashes of the segments of a set, for each size class in which a pair with it can fall; the lowest bits are the class."""
    n, made = len(sets), []
    own = np.searchsorted(ends, n, "right") - 1
    largest = np.searchsorted(ends, n * 100 // percent, "right") - 1
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(sets), dtype=np.uint64)])
        for c in range(max(0, own), largest + 1) if n else ():
            count, budget, _ = fragments(ends[c + 1], percent)
            at = np.searchsorted((sets >> np.uint64(32)) * np.uint64(count) >> np.uint64(32), np.arange(count + 1, dtype=np.uint64))
            part = _mixed((sums[at[1:]] - sums[at[:-1]]) + _ODD[0] * (np.arange(count, dtype=np.uint64) + np.uint64(c << 32)))
            held = at[1:] - at[:-1]
            thin = int(np.searchsorted(np.cumsum(np.bincount(held)), budget, "right"))  # sizes below leave out no more than the budget
            made.append((part[held >= thin] & ~np.uint64(SIZE_CLASSES - 1)) | np.uint64(c))
    return np.concatenate(made) if made else np.zeros(0, np.uint64)


def held_by_several(lists: DataFrame) -> DataFrame:
    """(class, segment, holders) of segments that several classes hold, from rows (class, segments); each segment is shuffled once."""
    segment = lists.select("class", F.explode("segments").alias("segment")).repartition("segment").sortWithinPartitions("segment", "class")
    return segment.mapInArrow(shared_segments, "class long, segment long, holders long")


def joined(shared: DataFrame) -> DataFrame:
    """(class, cand) of classes that rows (class, segment) connect."""
    low = shared.groupBy("segment").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high").select("segment", "low")
    met = shared.join(low, "segment").where("class != low").select("class", "low").distinct()
    return components(met, "class", "low").select(F.col("node").alias("class"), F.col("root").alias("cand"))


def class_of(sets: np.ndarray) -> int:
    """The 64-bit name of a set, as a signed integer."""
    return xxhash.xxh3_64_intdigest(sets.tobytes()) - (1 << 63)


def overlaps(left: list[np.ndarray], right: list[np.ndarray], cells: int = 1 << 21) -> np.ndarray:
    """[left, right] sizes of intersections: counted in fragments of the shingle order and summed."""
    total = np.zeros((len(left), len(right)), np.float32)
    ids = np.concatenate([*left, *right])
    doc = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    order = np.argsort(ids, kind="stable")
    ids, doc = ids[order], doc[order]
    new = np.concatenate([[True], ids[1:] != ids[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    ids, doc = ids[shared], doc[shared]
    if not len(ids):
        return total
    column = np.cumsum(np.concatenate([[True], ids[1:] != ids[:-1]])) - 1
    width = max(1, cells // (len(left) + len(right)))
    for start in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, (start, start + width))
        matrix = np.zeros((len(left) + len(right), min(width, int(column[-1]) + 1 - start)), np.float32)
        matrix[doc[a:b], column[a:b] - start] = 1
        total += matrix[:len(left)] @ matrix[len(left):].T
    return total


def links(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs whose similarity reaches ``percent`` / 100."""
    common = overlaps(left, right).astype(np.int64)
    size = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    return np.nonzero(100 * common >= percent * (size - common))


def shared_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, segment, holders) of segments that several classes hold, from rows (segment, class) in their order.

    The rows of a segment wait for its end, 16 bytes each. Where ``HELD`` of them wait they are given out, and all rows of
    that segment get that number of holders.
    """
    def counted(segment: np.ndarray, name: np.ndarray, over: int | None) -> pa.RecordBatch:
        new = np.concatenate([[True], segment[1:] != segment[:-1]])
        first = new | np.concatenate([[True], name[1:] != name[:-1]])  # a class that comes twice is one holder
        segment, name, new = segment[first], name[first], new[first]
        holders = np.diff(np.append(np.flatnonzero(new), len(segment)))
        holders = np.minimum(np.repeat(holders, holders), HELD)
        if over is not None:
            holders[segment == over] = HELD
        some = holders > 1
        return pa.record_batch([pa.array(name[some], pa.int64()), pa.array(segment[some], pa.int64()), pa.array(holders[some], pa.int64())], names=["class", "segment", "holders"])

    waiting, over = [np.zeros(0, np.int64), np.zeros(0, np.int64)], None
    for batch in batches:
        segment, name = (np.concatenate([a, batch.column(c).to_numpy()]) for a, c in zip(waiting, ("segment", "class"), strict=True))
        if not len(segment):
            continue
        end = int(np.searchsorted(segment, segment[-1]))  # rows are sorted: the last segment may go on
        if end:
            yield counted(segment[:end], name[:end], over)
        waiting = [segment[end:], name[end:]]
        if len(waiting[0]) >= HELD or segment[-1] == over:
            over = int(segment[-1])
            yield counted(*waiting, over)
            waiting = [a[:0] for a in waiting]
    if len(waiting[0]):
        yield counted(*waiting, over)


def row_key() -> Column:
    """The name of a row: of its doc_id and text, for an id may stand on rows of several texts."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def sent_whole(rows: DataFrame) -> bool:
    """Whether a table of long columns is small enough to be broadcast."""
    return rows.count() * (8 * len(rows.columns) + 24) <= BROADCAST_BYTES


def marked(keys: DataFrame, name: str, key: Column) -> Column:
    """Whether ``key`` may be among the hashes in column ``name`` of ``keys``: one bit of ``MARKS`` stands for its lowest bits."""
    low = lambda k: k.bitwiseAND(F.lit(MARKS - 1))
    word, bit = lambda k: F.shiftright(low(k), 6), lambda k: k.bitwiseAND(F.lit(63)).cast("int")
    set_ = F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col(name)))
    words = keys.groupBy(word(F.col(name)).alias("id")).agg(F.bit_or(set_).alias("bits"))
    words = keys.sparkSession.range(MARKS // 64).join(words, "id", "left").select(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("x"))
    words = words.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["bits"]))
    return F.call_function("bit_get", F.get(words.scalar(), word(key).cast("int")), bit(key)) == 1


def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (class, side, tag, ...) without those whose three came before in the same task."""
    seen = set()
    for batch in batches:
        new = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("class", "side", "tag")), strict=True):
            new.append(row not in seen)
            seen.add(row)
        yield batch.filter(pa.array(new, pa.bool_()))


def grouped(docs: DataFrame, percent: int = 90, width: int = 3, block_docs: int = 1024, block_shingles: int = 1 << 20, leaders: int = 8) -> DataFrame:
    """doc_id, key, n_shingles, root, component_id per row of ``docs``; root names the group, null without words."""
    if not 50 <= percent < 100:
        raise ValueError("percent must be from 50 to 99")
    small_batches(docs.sparkSession)

    def signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of a class that the task has met lately carry no segments again."""
        met: set[int] = set()
        for frame in frames:
            sets = [shingles(t, width) for t in frame["text"]]
            ends = size_classes(2 * max([len(s) for s in sets], default=0) + 100, percent)
            names, made = [class_of(s) for s in sets], []
            for name, one in zip(names, sets, strict=True):
                made.append(np.zeros(0, "<i8") if name in met else segments(one, percent, ends).view("<i8"))
                if len(met) >= MET_CLASSES:
                    met.clear()
                met.add(name)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "key": frame["key"], "n": [len(s) for s in sets], "class": names, "segments": made})
        give_back()

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", row_key())
    made = keyed.mapInPandas(signed, "doc_id long, key long, n long, class long, segments array<long>")
    made = written(made, "sets")
    rows = written(made.select("doc_id", "key", "n", "class"), "rows")
    # equal sets are one class; its text is that of the row with the smallest key
    classes = rows.where("n > 0").groupBy("class", "n").agg(F.min("key").alias("key"), F.min("doc_id").alias("least"))
    # segments are shuffled once; only those that several classes hold go on, without the commonest ones of each class
    shared = held_by_several(made)
    size_class, ends = F.col("segment").bitwiseAND(F.lit(SIZE_CLASSES - 1)).cast("int"), size_classes(1 << 40, percent)
    common = F.lit([fragments(e, percent)[2] for e in ends[1:SIZE_CLASSES + 1]])
    as_common = Window.partitionBy("class", size_class).orderBy(F.desc("holders")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    shared = shared.withColumn("rank", F.count("*").over(as_common)).where(F.col("rank") > F.get(common, size_class))
    shared = written(shared.select("class", "segment"), "shared")
    dropped(made)
    members = written(joined(shared).join(classes, "class").select("class", "key", "n", "cand"), "candidates")
    dropped(shared)

    def sized(members: DataFrame) -> DataFrame:
        """With the number of blocks of each group."""
        sizes = members.groupBy("cand").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
        blocks = F.greatest(F.ceil(F.col("docs") / block_docs), F.ceil(F.col("shingles") / block_shingles)).cast("int")
        return members.join(sizes.select("cand", blocks.alias("blocks")), "cand")

    def with_texts(wanted: DataFrame) -> DataFrame:
        """``wanted`` (key, ...) with the texts of its keys."""
        texts = keyed.select("key", "text")
        if sent_whole(wanted):
            return texts.join(F.broadcast(wanted), "key")
        return texts.where(marked(wanted, "key", F.col("key"))).join(wanted.hint("merge"), "key")

    def rarest(wide: DataFrame) -> DataFrame:
        """(class, segment) of the rarest shingles of classes (class, key, n, cand), as many as a pair shares one of; only those
        that several classes of the group hold."""
        def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            met: set[int] = set()
            for batch in batches:
                names, made = [], []
                for cand, name, text in zip(*(batch.column(c).to_pylist() for c in ("cand", "class", "text")), strict=True):
                    if name in met:
                        continue
                    one = shingles(text, width)
                    if class_of(one) == name:  # a key is a hash, so texts of two classes may share it
                        names.append(name)
                        made.append(_mixed(one ^ _mixed(np.array([cand]).view(np.uint64))).view("<i8"))
                        if len(met) >= MET_CLASSES:
                            met.clear()
                        met.add(name)
                yield pa.record_batch([pa.array(names, pa.int64()), pa.array(made, pa.list_(pa.int64()))], names=["class", "segments"])
            give_back()

        held = held_by_several(with_texts(wide.select("class", "key", "cand")).select("cand", "class", "text").mapInArrow(named, "class long, segments array<long>"))
        held = held.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("holders", "segment"))).alias("held")).join(wide.select("class", "n"), "class")
        # the shingles that no other class holds come before all others
        first = F.slice("held", 1, F.greatest(F.lit(0), F.size("held") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))
        return held.select("class", F.explode(F.transform(first, lambda x: x["segment"])).alias("segment"))

    members = sized(members)
    wide = written(members.where("blocks > 1").drop("blocks"), "wide")
    if not wide.isEmpty():
        rare = written(rarest(wide), "rare")
        members = members.where("blocks = 1").unionByName(sized(wide.drop("cand").join(joined(rare), "class")).select(*members.columns))
    members = members.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    members = written(members.select("class", "key", "n", "cand", "blocks", "block"), "members")

    def verified(placed: DataFrame) -> DataFrame:
        """(class, root) of linked classes, from rows (class, key, cand, start, stop, step, side): pieces from start to stop, side 1
        is compared with side 0 only."""
        placed = with_texts(written(placed, "placed")).select(
            "cand", "start", "stop", "step", "class", "side", F.hash("text").alias("tag"), "text")
        # a row that comes many times is sent once by each task
        placed = placed.mapInArrow(first_of_each, placed.schema)
        placed = placed.select("cand", F.explode(F.sequence("start", "stop", "step")).alias("piece"), "class", "side", "text").repartition(
            "cand", "piece").sortWithinPartitions("cand", "piece", "class")

        def piece(group: pd.DataFrame) -> pd.DataFrame | None:
            group = group[~group[["class", "side", "text"]].duplicated()]
            sets = [shingles(t, width) for t in group["text"]]
            name, side = group["class"].to_numpy(), group["side"].to_numpy()
            # a key is a hash, so texts of two classes may share it: first those of another class go, then repetitions
            right = np.array([class_of(s) == c for s, c in zip(sets, name, strict=True)])
            right[right] = ~group.loc[right, ["class", "side"]].duplicated().to_numpy()
            a, b = np.nonzero(right & (side == 0))[0], np.nonzero(right & (side == 1))[0]
            if len(b) == 0:
                b = a
            if len(a) == 0 or len(a) + len(b) < 3 and a is b:
                return None
            i, j = links([sets[x] for x in a], [sets[x] for x in b], percent)
            i, j = a[i], b[j]
            root = roots(len(name), i, j)
            some = (root != np.arange(len(name))) & (name != name[root])
            return pd.DataFrame({"class": name[some], "root": name[root[some]]}) if some.any() else None

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rest = None
            for frame in frames:
                rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
                change = np.nonzero((rest["cand"].to_numpy()[1:] != rest["cand"].to_numpy()[:-1])
                                    | (rest["piece"].to_numpy()[1:] != rest["piece"].to_numpy()[:-1]))[0] + 1
                starts = [0, *change.tolist()]
                done = [piece(rest.iloc[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True) if b - a > 1]
                rest = rest.iloc[starts[-1]:]
                if done := [d for d in done if d is not None]:
                    yield pd.concat(done, ignore_index=True)
            if rest is not None and len(rest) > 1 and (last := piece(rest)) is not None:
                yield last
            give_back()

        return placed.mapInPandas(run, "class long, root long")

    # first round: each block inside, and with the leaders of its group, which go to all its blocks
    large = members.where("blocks > 1")
    place = F.row_number().over(Window.partitionBy("cand").orderBy(F.xxhash64("class"), "class"))
    lead = large.withColumn("place", place).where(F.col("place") <= leaders).select("class", F.lit(True).alias("leads"))

    def spots(start: Column, number: Column, step: Column, side: int) -> list:
        """So many pieces from ``start`` on: three numbers, for a list of them would go to the driver with every row."""
        start, number, step = (c.cast("long") for c in (start, number, step))
        return ["class", "key", "cand", start.alias("start"), (start + (number - 1) * step).alias("stop"), step.alias("step"), F.lit(side).cast("long").alias("side")]

    leads, one = F.col("leads").isNotNull(), F.lit(1)
    linked = members.join(lead, "class", "left").select(*spots(F.when(leads, 0).otherwise(F.col("block")), F.when(leads, F.col("blocks")).otherwise(1), one, 0))
    linked = written(verified(linked), "first")
    final = written(components(linked, "class", "root").select(F.col("node").alias("class"), "root"), "round")

    # second round: what is outside the largest part of a large group, in blocks of its own, with all blocks of that group
    large = large.join(final, "class", "left").withColumn("root", F.coalesce("root", "class"))
    main = large.groupBy("cand", "root").agg(F.count("*").alias("docs")).groupBy("cand").agg(F.max(F.struct("docs", "root"))["root"].alias("main"))
    outside = written(large.join(main, "cand").where("root != main").drop("root", "main"), "outside")
    sizes = outside.groupBy("cand").agg(F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("n") / block_shingles)).cast("long").alias("parts"))
    sizes = written(sizes, "outside-sizes")
    if not sizes.isEmpty():
        # piece (b, u): the rows of block b as side 0, part u of those outside as side 1
        left = members.join(sizes, "cand").select(*spots(F.col("block") * F.col("parts"), F.col("parts"), one, 0))
        right = outside.join(sizes, "cand").select(*spots(F.pmod(F.xxhash64("class", F.lit(1)), F.col("parts")), F.col("blocks"), F.col("parts"), 1))
        linked = linked.unionByName(written(verified(left.unionByName(right)), "second"))
        final = components(linked, "class", "root").select(F.col("node").alias("class"), "root")

    named = classes.join(final, "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(least, "root").select(F.col("class").alias("_class"), F.col("n").alias("_n"), "root", "component_id")
    out = rows.join(known, (F.col("class") == F.col("_class")) & (F.col("n") == F.col("_n")), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("root")).alias("root"), component.alias("component_id"))


def groups(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs``; settings as of ``grouped``."""
    return grouped(docs, **how).select("doc_id", "n_shingles", "component_id")


def representatives(docs: DataFrame, **how) -> DataFrame:
    """One row of each group of ``docs``, with its smallest doc_id; a row without an id only where no row of the group has one.

    Rows are told apart by doc_id and text: an id on texts of several groups stays in each of them. Of rows without words
    one stays for each id, and all without an id.
    """
    found = written(grouped(docs, **how), "groups").where("n_shingles > 0 OR doc_id IS NOT NULL")
    # an id may be the smallest of several groups, so they go by root
    best = found.where("doc_id <=> component_id").groupBy(
        F.col("root").isNull().alias("blank"), F.coalesce("root", "doc_id").alias("group")).agg(F.min("key").alias("key"))
    keys = found.groupBy("key").agg(F.count("*").alias("rows")).join(best.select("key", F.lit(True).alias("stays")).distinct(), "key", "left")
    keys = written(keys, "keys")

    def chosen(of: DataFrame, rows: DataFrame, how: str) -> DataFrame:
        """Beyond ``BROADCAST_BYTES`` both sides are shuffled, of the rows those that may be among the keys."""
        right = rows.select(F.col("key").alias("_key"))
        if sent_whole(right):
            return of.join(F.broadcast(right), row_key() == right["_key"], how)
        may = marked(right, "_key", row_key())
        found = of.where(may).join(right.hint("merge"), row_key() == right["_key"], how)
        return found if how == "left_semi" else of.where(~may).unionByName(found)

    left = chosen(docs, keys.where("stays IS NULL"), "left_anti")
    several = keys.where("stays AND rows > 1")
    if several.isEmpty():
        return left
    return chosen(left, several, "left_anti").unionByName(chosen(left, several, "left_semi").dropDuplicates(["doc_id", "text"]))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n, s FROM s),
e AS (SELECT doc_id, n, unnest(s) AS s FROM n),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT a, a AS root FROM l UNION SELECT l.a, r.root FROM r JOIN l ON l.b = r.a)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, coalesce(c.root, n.doc_id) AS component_id FROM n LEFT JOIN (SELECT a, min(root) AS root FROM r GROUP BY a) c ON c.a = n.doc_id
"""
