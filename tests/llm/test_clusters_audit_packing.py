"""Centroid clusters, filter audit and packing against plain versions, with odd rows, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from tokenizers import Tokenizer

from ticketry.llm import centroids, filter_audit, packing
from ticketry.llm.common import table

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, cluster string, x string, distance string"
DOCS = "doc_id long, text string, source string, part string, n string, digest string, length string, task string"
LABELS = "doc_id long, quality int, toxic int, part string"


# centroid clusters

def plain_clusters(rows, k, rounds, width, scale, seed):
    """The definition in Python, over (id, vector)."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(a is not None and np.isfinite(a) for a in v):
            kept.append((i, [int(np.floor(min(max(scale * float(a), -2.0**27), 2.0**27))) for a in v]))
    order = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    middle = [x for _, x in sorted(kept, key=order)[:k]]
    for last in range(rounds + 1):
        at = [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(middle)) for _, x in kept]
        if last == rounds:
            break
        for j in range(len(middle)):
            if mine := [x for (_, x), (_, c) in zip(kept, at, strict=True) if c == j]:
                middle[j] = [sum(a) // len(mine) for a in zip(*mine, strict=True)]
    inertia = defaultdict(int)
    for d, j in at if kept else []:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, middle[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, at, strict=True)) if kept else Counter()


@pytest.mark.parametrize("k, rounds", [(3, 4), (8, 2), (40, 1)])
def test_clusters_equal_a_plain_version(spark, k, rounds):
    draw = random.Random(5)
    rows = [(i, [draw.choice([-1.0, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(30)]
    rows += [(3, rows[3][1]), (3, [9.0] * 4), (None, [0.5] * 4), (None, None), (50, None), (51, []), (52, [1.0] * 5), (53, [1.0, None, 0.0, 0.0]),
             (54, [float("nan")] * 4), (55, [float("inf")] * 4), (56, [1e30, -1e30, 0.0, 0.0]), (57, [0.0] * 4)]
    frame = spark.createDataFrame([(i, v, 0, "a", "b", "c") for i, v in rows], VECTORS)
    got = centroids.clusters(frame, k=k, rounds=rounds, width=4).collect()
    as_float = [(i, None if v is None else [None if a is None else float(np.float32(a)) for a in v]) for i, v in rows]
    assert Counter(map(tuple, got)) == plain_clusters(as_float, k, rounds, 4, 1024, "3")


def test_clusters_of_no_vectors(spark):
    none = spark.createDataFrame([(1, None, 0, "a", "b", "c")], VECTORS)
    out = centroids.clusters(none)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and out.count() == 0
    assert centroids.clusters(none.limit(0)).count() == 0


# filter audit

def plain_counts(text):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    return len(words), len(set(words)), len((text or "")), sum(65 <= b <= 90 for b in data), sum(chr(b) in "#$%&*|" for b in data)


def measured(texts, block):
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"zz" + b"".join(raw), np.uint8), np.cumsum([2, *map(len, raw)])
    made = filter_audit.measure(data, offsets, block)
    return list(zip(*[made[c].tolist() for c in ("words", "distinct", "points", "capitals", "symbols")], strict=True))


TEXTS = ["", " ", "a", "a a", "one two", "two", "", "é É é", "\t\n\x0b\x0c\r x", "A" * 70 + " " + "A" * 70 + " " + "A" * 69 + "B", "a\x00b a\x00b", "x" * 64 + " " + "x" * 64, "$#|  &*%", "日本 語 日本",
         "     ", "12345678 12345679 1234567", "end "]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 1 << 20])
def test_one_pass_counts_at_any_block_size(block):
    assert measured(TEXTS, block) == [plain_counts(t) for t in TEXTS]


def test_random_texts_and_colliding_hashes(monkeypatch):
    draw = random.Random(1)
    texts = ["".join(draw.choice("aabbcA \n#é") for _ in range(draw.randrange(40))) for _ in range(400)]
    want = [plain_counts(t) for t in texts]
    assert measured(texts, 50) == want
    monkeypatch.setattr(filter_audit.WordTable, "hashes", lambda self: (self.start % 3).astype(np.uint64))
    assert [x[0] for x in measured(texts[:40], 50)] == [x[0] for x in want[:40]]
    monkeypatch.setattr(filter_audit.WordTable, "hashes", lambda self: np.zeros(len(self.start), np.uint64))
    assert measured(texts[:40], 50) == want[:40]


def plain_audit(docs, labels, least_words):
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    kinds = Counter()
    for i, text, source in docs:
        words, distinct, points, capitals, symbols = plain_counts(text)
        fails = {"A": words < least_words, "B": 100 * distinct < 50 * words, "C": 100 * capitals > 2 * points, "D": symbols > 0, "E": i is not None and i > first[text or ""]}
        kinds[source or "", "".join(f for f in "ABCDE" if fails[f]), i in good, i in toxic] += 1
    rows = []
    for part in {p for p, *_ in kinds}:
        mine = [(set(f), g, t, n) for (p, f, g, t), n in kinds.items() if p == part]
        orders = ["".join(p) for p in permutations("ABCDE")]
        shapley = Counter(next((x for x in o if x in f), None) for o in orders for f, _, _, n in mine for _ in range(n))
        for o in orders:
            for s, x in enumerate(o):
                before = set(o[:s])
                here = [(f, g, t, n) for f, g, t, n in mine if x in f and not f & before]
                rows.append((part, o, s + 1, sum(n for f, _, _, n in mine if not f & (before | {x})), sum(n for *_, n in here),
                             sum(n for f, _, _, n in mine if x in f and f & before), sum(n for f, _, _, n in mine if f == {x}),
                             sum(n for _, g, _, n in here if g), sum(n for _, _, t, n in here if t), shapley[x]))
    return Counter(rows)


def test_audit_equals_a_plain_version(spark):
    draw = random.Random(2)
    texts = ["", None, "a b c d e", "a a a a b", "A B c", "x # y", "one two three four five six", "One Two $ $ $ $", "b " * 50_000]
    docs = [(draw.choice([None, *range(40)]), draw.choice(texts), draw.choice(["s", "t", None, ""])) for _ in range(150)]
    docs += [(7, "a b c d e", "s")] * 3 + [(900 + i, "copied text of many rows", "hot") for i in range(300)] + [(None, "copied text of many rows", "hot")] * 2
    labels = [(draw.choice([None, *range(45), 901, 902]), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(60)]
    frame = spark.createDataFrame([(i, t, s, "p", "n", "d", "l", "t") for i, t, s in docs], DOCS)
    marks = spark.createDataFrame([(*row, "p") for row in labels], LABELS)
    got = filter_audit.audit(frame, marks, least_words=3)
    assert Counter(map(tuple, got.collect())) == plain_audit(docs, labels, 3)
    assert filter_audit.audit(frame.limit(0), marks).count() == 0
    assert filter_audit.audit(frame, marks.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


# packing

@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_coder_equals_the_library(library):
    code = packing.ByteCoder(packing.tokenizer_text())
    draw = random.Random(4)
    letters = [*" \t\n\r'sltdvemrabz09.,!?é", "ß", "ж", "中", "́", "‍", "\U0001f600", "<|endoftext|>", " ", "　"]
    texts = ["".join(draw.choices(letters, k=draw.randrange(40))) for _ in range(4000)] + ["", "<|endoftext|><|endoftext|", "a" * 5000, " " * 3000 + "x"]
    texts += [f"a{c}b {c}1{c}{c} {c} .{c}  {c}\n{c}'s" for c in map(chr, [*range(0xD800), *range(0xE000, 0x3000 + 0xE000, 7)])]
    for text, made in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert code(text).tolist() == made.ids, text
    assert code.encode_part.__qualname__.startswith("ByteCoder._ranked")
    assert packing.ByteCoder._plain(packing.tokenizer_text())("a b").__len__() == 2


def test_long_texts_are_cut_where_no_token_reaches_over(library):
    code = packing.ByteCoder(packing.tokenizer_text())
    code.PART = 50
    for name in ("word after word, don't stop  \n now ", "x" * 120 + " ", "1 2 3 . . . ", "a <|endoftext|> b"):
        text = name * 60
        assert code(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_cuts_give_full_pieces_behind_the_first():
    assert [packing.cuts(n, 4) for n in (1, 4, 5, 8, 9)] == [[0, 1], [0, 4], [0, 1, 5], [0, 4, 8], [0, 1, 5, 9]]


def test_non_negative_least_squares_meets_its_conditions():
    draw = np.random.default_rng(0)
    for _ in range(40):
        a, b = draw.integers(0, 4, (8, 20)).astype(float), draw.integers(-3, 30, 8).astype(float)
        x = packing.non_negative_least_squares(a, b)
        gain = a.T @ (b - a @ x)
        assert (x >= 0).all() and (gain <= 1e-5).all() and np.abs(gain[x > 0]).max(initial=0) <= 1e-5


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_length_in_few_sequences(seed):
    draw = np.random.default_rng(seed)
    lengths = [draw.integers(1, 2049, 3000), draw.geometric(1 / 300, 4000).clip(1, 2048), np.full(1000, 1), np.full(999, 1025), draw.choice([1, 700, 683, 2048], 2000), np.array([], int)][seed]
    histogram = {int(k): int(v) for k, v in Counter(lengths.tolist()).items()}
    runs = packing.plan(histogram)
    held = Counter()
    for composition, n in runs:
        assert n > 0 and sum(length * times for length, times in composition) <= 2048
        for length, times in composition:
            held[length] += n * times
    assert held == Counter(histogram)
    greedy = packing.Runs(2048)
    for length in sorted(histogram, reverse=True):
        greedy.best_fit(length, histogram[length])
    best = sum(n for _, n in greedy.all())
    assert sum(n for _, n in runs) <= best * 1.002 + 1 and len(runs) <= 2 * 2048 + 2


def test_pattern_counts_come_from_the_fit():
    """Halves and thirds only: the fit alone gives the best packing, greedy or not."""
    runs = packing.plan({1024: 1000, 512: 1000, 256: 2000}, share=1.0)
    assert sum(n for _, n in runs) == (1024 * 1000 + 512 * 1000 + 256 * 2000) // 2048


def check_packing(rows, docs, code, capacity):
    """All pieces of all documents once, gapless in their documents and sequences."""
    want = Counter()
    for i, text in docs:
        ids = np.append(code(text), np.uint32(0)).astype("<u4")
        at = packing.cuts(len(ids), capacity)
        want.update((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def test_packing_of_odd_documents(spark):
    texts = ["", None, "a b c", "one two three four five six seven " * 30, "x", "<|endoftext|>"] + ["same text again"] * 200
    docs = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(1, "a b c"), (1, "a b c")]
    frame = spark.createDataFrame([(i, t, "s", "p", "n", "d", "l", "t") for i, t in docs], DOCS).repartition(5)
    packed = packing.pack(frame, capacity=16, classes=16, with_ids=True).cache()
    rows, code = packed.collect(), packing.ByteCoder(packing.tokenizer_text())
    check_packing(rows, docs, code, 16)
    whole = packing.sequences(packed).collect()
    assert sorted(x for r in whole for x in r.ids) == sorted(x for r in rows for x in r.ids) and max(len(r.ids) for r in whole) <= 16
    packed.unpersist()
    none = packing.pack(frame.limit(0))
    assert none.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and none.count() == 0


def test_packing_of_all_documents(spark):
    docs = table(spark, FOLDER, "documents")
    rows = packing.pack(docs).collect()
    made = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], packing.ByteCoder(packing.tokenizer_text()), 2048)
    assert made <= 1.01 * -(-sum(r.length for r in rows) // 2048) + 1
