"""Packing tokenised documents into sequences of a fixed length by patterns of lengths and non-negative least squares.

A document is its token ids and one end mark. One longer than a sequence is cut into full pieces behind a first piece that
takes the rest. Only the histogram of piece lengths, one number per length, comes to the driver. There

1. lengths are rounded to classes, and all patterns of few classes that fill a sequence are enumerated,
2. non-negative least squares fits how often each pattern is used to the histogram of classes, and the counts are rounded
   down, a fifth of them left out so that step 4 has lengths of all kinds to fill up with,
3. patterns are filled with real lengths as often as these fill a sequence exactly, and
4. what is left over is packed by best fit, longest first.

All steps work on runs (a composition of lengths, how many sequences have it), so their cost follows the number of
different lengths and not of documents. The plan is a short table of runs. Pieces find their place in it by their rank
among the pieces of their length: a task numbers its own pieces while it encodes them, and the tasks' counts are summed up
before it, so pieces are neither sorted nor gathered by length; a length that a third of all pieces have is dealt like any other.

Defined cases: null text is an empty one, which is the end mark alone (length 1); repeated ids and rows are documents of
their own; a text that spells a special token has that token's id, as the tokenizers library gives it; very long texts are
encoded part by part, cut between a letter and a blank, where no token reaches over; an empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketry.llm.common import give_back, small_batches, written

# Fixed: how the byte-level tokenizer splits a text before it merges bytes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteCoder:
    """Ids of texts by the tokenizer file of a byte-level BPE, as the tokenizers library gives them without special tokens added.

    Where the file's merges are those of its ids' order, the same ids come from tiktoken in a quarter of the time; for any
    other file the tokenizers library itself does the work.
    """

    PART = 1 << 18
    SAFE = re.compile(r"(?<=[A-Za-z]) ")

    def __init__(self, tokenizer_json: str) -> None:
        spec = json.loads(tokenizer_json)
        self.encode_part = self._ranked(spec) or self._plain(tokenizer_json)

    @staticmethod
    def _ranked(spec: dict):
        import tiktoken

        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        added = {t["content"]: t for t in spec.get("added_tokens", [])}
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in added.values())
        alike = {k: before.get(k) for k in ("type", "add_prefix_space", "use_regex")} == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if spec.get("normalizer") or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or not (alike and plain):
            return None
        # the file writes bytes as printable characters: those that are printable in Latin-1 as they are, the others from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        made = [ranks.get(bytes(byte[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))) for m in model["merges"]]
        if made != sorted(made, key=lambda i: -1 if i is None else i) or len(made) + 256 != len(ranks) or None in made:
            return None
        special = {t: v["id"] for t, v in added.items()}
        coder = tiktoken.Encoding(hashlib.sha256(json.dumps(spec).encode()).hexdigest(), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: coder.encode(text, allowed_special="all")

    @staticmethod
    def _plain(tokenizer_json: str):
        from tokenizers import Tokenizer

        work = Tokenizer.from_str(tokenizer_json)
        work.no_truncation()
        work.no_padding()
        return lambda text: work.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str | None) -> np.ndarray:
        """Ids as unsigned 32-bit integers."""
        text, parts, start = text or "", [], 0
        while len(text) - start > self.PART and (cut := self.SAFE.search(text, start + self.PART)):
            parts.append(np.array(self.encode_part(text[start:cut.start()]), "<u4"))
            start = cut.start()
        parts.append(np.array(self.encode_part(text[start:]), "<u4"))
        return np.concatenate(parts)


_CODERS: dict[str, ByteCoder] = {}


def coder(tokenizer_json: str) -> ByteCoder:
    """The worker's coder for a tokenizer."""
    key = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    if key not in _CODERS:
        _CODERS[key] = ByteCoder(tokenizer_json)
    return _CODERS[key]


def tokenizer_text(path: str | None = None) -> str:
    """The tokenizer's file, read on the driver and sent with the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def cuts(n: int, capacity: int) -> list[int]:
    """Where the pieces of a document of ``n`` ids begin, and ``n``: full pieces, the first one takes the rest."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity), n] if n > capacity else [0, n]


def pieces(docs: DataFrame, capacity: int, tokenizer: str | None = None, end: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, task, nth (its number among the task's pieces of this length), and the ids if asked for."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, met, task = coder(shared.value), [0] * (capacity + 1), TaskContext.get().partitionId()
        for batch in batches:
            rows, ids = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                coded = np.append(work(text.as_py()), np.uint32(end)).astype("<u4")
                at = cuts(len(coded), capacity)
                for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                    rows.append((doc, i, a, b - a, zlib.crc32(coded[a:b].tobytes()), task, met[b - a]))
                    met[b - a] += 1
                    if with_ids:
                        ids.append(coded[a:b].astype(np.int32))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.record_batch(columns, names=names)
        give_back()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


# the plan: on the driver, over lengths and runs

def length_patterns(classes: int, most: int) -> np.ndarray:
    """[patterns, classes + 1] how many documents of each class a pattern holds: up to ``most`` documents that fill a sequence."""
    found = []
    for k in range(most):  # the last document is what the k before it leave
        for some in combinations_with_replacement(range(classes, 0, -1), k):
            last = classes - sum(some)
            if last > 0 and (not some or last <= some[-1]):
                found.append([*some, last])
    counts = np.zeros((len(found), classes + 1))
    for row, pattern in zip(counts, found, strict=True):
        np.add.at(row, pattern, 1)
    return counts


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by the active-set method of Lawson and Hanson."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    limit = tolerance * max(1.0, float(np.abs(b).max(initial=0))) * max(1.0, float(np.abs(a).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        gain = a.T @ (b - a @ x)
        gain[used] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= limit:
            break
        used[best] = True
        while True:
            z = np.zeros_like(x)
            z[used] = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            low = used & (z <= 0)
            if not low.any():
                break
            step = np.min(x[low] / np.where(x[low] - z[low] == 0, 1.0, x[low] - z[low]))
            x += step * (z - x)
            used &= x > limit * 1e-6
            x[~used] = 0
        x = z
    return x


class Runs:
    """Sequences by composition: a composition is a list of (length, times), kept with its room and the number of sequences that have it."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.open: list[list[tuple[tuple, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, composition: tuple, n: int) -> None:
        if n:
            self.open[self.capacity - sum(length * times for length, times in composition)].append((composition, n))

    def best_fit(self, length: int, n: int) -> None:
        """Place ``n`` documents of this length, each where the least room is left; new sequences where none fits."""
        for room in range(length, self.capacity + 1):
            while n and self.open[room]:
                composition, sequences = self.open[room].pop()
                each = room // length
                full = min(sequences, n // each)
                self.add((*composition, (length, each)), full)
                n, sequences = n - full * each, sequences - full
                if sequences and n:  # fewer are left than one sequence takes
                    self.add((*composition, (length, n)), 1)
                    n, sequences = 0, sequences - 1
                self.add(composition, sequences)
        each = self.capacity // length
        self.add(((length, each),), n // each)
        if n % each:
            self.add(((length, n % each),), 1)

    def all(self) -> list[tuple[tuple, int]]:
        return [run for runs in self.open for run in runs]


def plan(histogram: dict[int, int], capacity: int = 2048, classes: int = 64, most: int = 4, share: float = 0.8) -> list[tuple[tuple, int]]:
    """Runs (composition, sequences) that hold all lengths of the histogram; patterns are used for a ``share`` of their counts."""
    grain = max(1, capacity // classes)
    classes = -(-capacity // grain)
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] += n
    of = np.maximum(1, np.round(np.arange(capacity + 1) / grain).astype(int).clip(max=classes))
    patterns = length_patterns(classes, most)
    wanted = np.bincount(of, weights=left, minlength=classes + 1)
    present = np.flatnonzero((patterns @ (wanted == 0)) == 0)
    repeats = np.floor(share * non_negative_least_squares(patterns[present].T, wanted) + 1e-6).astype(np.int64)
    runs = Runs(capacity)
    for i in np.argsort(-repeats, kind="stable"):
        fill(runs, left, of, [c for c in range(classes, 0, -1) for _ in range(int(patterns[present[i]][c]))], int(repeats[i]))
    for length in range(capacity, 0, -1):
        if left[length]:
            runs.best_fit(length, int(left[length]))
    return runs.all()


def fill(runs: Runs, left: np.ndarray, of: np.ndarray, pattern: list[int], repeats: int) -> None:
    """Take up to ``repeats`` sequences of a pattern from the lengths that are left, while they fill their sequence exactly.

    Of each class the commonest length is taken, of the last but one that whose exact complement is commonest too.
    """
    members = {c: np.flatnonzero(of == c) for c in pattern}
    while repeats > 0:
        free, taken, room = left.copy(), {}, runs.capacity

        def take(length: int) -> None:
            free[length] -= 1
            taken[length] = taken.get(length, 0) + 1

        for c in pattern[:-2]:
            length = int(members[c][np.argmax(free[members[c]])])
            if free[length] <= 0:
                return
            take(length)
            room -= length
        if len(pattern) > 1:
            some = members[pattern[-2]]
            some = some[some < room]
            both = np.minimum(free[some], free[room - some] - (some == room - some))
            if not len(some) or both.max() <= 0:
                return
            length = int(some[np.argmax(both)])
            take(length)
            room -= length
        if room <= 0 or free[room] <= 0:
            return
        take(room)
        n = min(repeats, *[int(left[x]) // times for x, times in taken.items()])
        runs.add(tuple(sorted(taken.items(), reverse=True)), n)
        for x, times in taken.items():
            left[x] -= n * times
        repeats -= n


def places(runs: list[tuple[tuple, int]]) -> pd.DataFrame:
    """length, rank (of the first piece), sequence (of the first piece), times (in one sequence), offset: where the pieces of each rank go."""
    rows, sequence, rank = [], 0, {}
    for composition, n in runs:
        offset = 0
        for length, times in composition:
            rows.append((length, rank.get(length, 0), sequence, times, offset))
            rank[length] = rank.get(length, 0) + n * times
            offset += length * times
        sequence += n
    made = pd.DataFrame(rows, columns=["length", "rank", "sequence", "times", "offset"], dtype=np.int64)
    return made.sort_values(["length", "rank"], ignore_index=True)


def pack(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, end: int = 0, with_ids: bool = False, **how) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece, and the ids if asked for."""
    cut = written(pieces(docs, capacity, tokenizer, end, with_ids), "pieces")
    counts = written(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast({c: v.to_numpy() for c, v in places(plan(histogram, capacity, **how)).items()})
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = shared.value
        low = at["length"] << 48 | at["rank"]
        for frame in frames:
            rank = (frame.pop("before") + frame.pop("nth")).to_numpy(np.int64)
            i = np.searchsorted(low, frame["length"].to_numpy(np.int64) << 48 | rank, "right") - 1
            beyond = rank - at["rank"][i]
            frame["sequence_id"] = at["sequence"][i] + beyond // at["times"][i]
            frame["offset"] = at["offset"][i] + beyond % at["times"][i] * frame["length"].to_numpy(np.int64)
            yield frame

    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = ", ".join([*(f"{c} {cut.schema[c].dataType.simpleString()}" for c in keep), "sequence_id long", "offset long"])
    return cut.join(starts, ["length", "task"]).select(*keep, "before", "nth").mapInPandas(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, documents of a packing made with ids: the sequences themselves, at most their capacity long."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(rows.alias("rows")).select(
        "sequence_id", F.flatten("rows.ids").alias("ids"), F.col("rows.doc_id").alias("documents"))
