"""Quality classification by co-training two views of a document.

One classifier sees the text (hashed byte n-grams and how much its words repeat), the other only what a page record and
its layout say: source, language, length, lines, and the mix of characters. Both are logistic regressions on the same few
labelled rows. Over several rounds each hands its most confident verdicts on an unlabelled pool to the other as
pseudo-labels. Labelled rows that were kept apart then calibrate each view and weigh the two into one score, which every
document gets.

Learning uses bounded samples: ``labelled_rows`` and ``pool_rows`` documents, those with the smallest hash of the id.
Features are computed where the texts are; scoring reads whole texts, row by row, without a shuffle.

Defined cases: null and wordless text scores 0; null quality and null ids in the labels are left out, of labels that
contradict each other for an id the lowest counts; without labels of both kinds nothing is learned, the score is null and
every document is kept; null source, language or n_chars are values like others; repeated rows are scored as often; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import give_back, small_batches
from ticketry.llm.features import gram_counts

GRAMS, NAMES = 1024, 64
#: Characters that the layout counts by kind: letters, capitals, digits, blanks, line ends, full stops, other ASCII.
_KIND = np.array([3 if c == 32 else 4 if c == 10 else 2 if 48 <= c < 58 else 1 if 65 <= c < 91 else 0 if 97 <= c < 123 or c >= 128 else 5 if c in (44, 46) else 6
                  for c in range(256)])


def _bucket(value: float, low: float, high: float, n: int) -> np.ndarray:
    """``n`` soft steps between two values."""
    return 1 / (1 + np.exp(-(value - np.linspace(low, high, n)) * n / (high - low)))


def views(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text view, page view, words) of the rows of a frame with text, source, lang and n_chars, a few rows at a time."""
    texts = [(t or "").encode() for t in frame["text"]]
    at = 0
    for counts in gram_counts(texts, 3, GRAMS):
        part = texts[at:at + len(counts)]
        meta = frame.iloc[at:at + len(counts)][["source", "lang", "n_chars"]].to_numpy(dtype=object)
        at += len(counts)
        text, page, words = [], [], []
        for data, (source, lang, n_chars) in zip(part, meta, strict=True):
            tokens = data.split()
            distinct = len(set(tokens))
            words.append(len(tokens))
            text.append(np.concatenate([_bucket(distinct / max(1, len(tokens)) ** 0.75, 0, 2, 12), _bucket(np.log1p(len(tokens)), 0, 10, 8)]))
            kinds = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=7)
            share = kinds / max(1, len(data))
            lines = 1 + int(kinds[4])
            row = np.zeros(NAMES)
            row[zlib.crc32(f"s:{source}".encode()) % NAMES] = row[zlib.crc32(f"l:{lang}".encode()) % NAMES] = 1
            known = 0.0 if pd.isna(n_chars) else float(n_chars)
            page.append(np.concatenate([row, _bucket(np.log1p(max(0.0, known)), 0, 12, 8), _bucket(np.log1p(lines), 0, 8, 6),
                                        _bucket(np.log1p(len(data) / lines), 0, 9, 8), *[_bucket(s, 0, 0.3, 6) for s in share]]))
        grams = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
        yield (np.concatenate([grams * 4, 2 * np.array(text).reshape(len(part), -1)], axis=1).astype(np.float32),
               np.array(page).reshape(len(part), -1).astype(np.float32), np.array(words))


class Logistic:
    """Logistic regression with classes of equal weight, by accelerated gradient descent."""

    def __init__(self, x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> None:
        x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
        share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
        w = look = np.zeros(x.shape[1], np.float32)
        rate = np.float32(1 / (0.25 * float((share * (x * x).sum(axis=1)).sum()) + penalty))
        for t in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ look, -30, 30)))
            new = look - rate * (x.T @ (share * (p - y)) + np.float32(penalty) * look)
            look, w = new + np.float32(t / (t + 3)) * (new - w), new
        self.w = w

    def margins(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ self.w[:-1] + self.w[-1], -30, 30)


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


class CoTrained:
    """The two views' classifiers and the calibrated combination."""

    def __init__(self, x: list[np.ndarray], y: np.ndarray, apart: np.ndarray, pool: list[np.ndarray], rounds: int = 4, share: float = 0.05,
                 confidence: float = 0.95) -> None:
        """``x`` and ``pool``: text view and page view; ``apart``: labelled rows that only calibrate."""
        known = [(v[~apart], y[~apart]) for v in x]
        self.handed = [0, 0]
        for turn in range(rounds + 1):
            models = [Logistic(v, labels) for v, labels in known]
            if turn == rounds or not len(pool[0]):
                break
            most, taken = max(1, int(share * len(pool[0]))), np.zeros(len(pool[0]), bool)
            for a in (0, 1):
                p = probability(models[a].margins(pool[a]))
                for label, sure in ((1, p), (0, 1 - p)):
                    pick = np.argsort(-sure, kind="stable")[:most]
                    pick = pick[sure[pick] >= confidence]
                    v, labels = known[1 - a]
                    known[1 - a] = np.vstack([v, pool[1 - a][pick]]), np.concatenate([labels, np.full(len(pick), label)])
                    taken[pick] = True
                    self.handed[1 - a] += len(pick)
            pool = [v[~taken] for v in pool]
        self.models = models
        margins = [m.margins(v[apart]) for m, v in zip(models, x, strict=True)]
        self.calibration = [Logistic(m[:, None] / 10, y[apart], 1e-2) for m in margins]
        both = np.stack([c.margins(m[:, None] / 10) for c, m in zip(self.calibration, margins, strict=True)], axis=1)
        self.combined = Logistic(both / 10, y[apart], 1e-2)

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(combined, text view's, page view's) calibrated probabilities of good quality."""
        each = np.stack([c.margins(m.margins(v)[:, None] / 10) for c, m, v in zip(self.calibration, self.models, (text, page), strict=True)], axis=1)
        return probability(self.combined.margins(each / 10)), probability(each[:, 0]), probability(each[:, 1])


def _limit_hash(ids: DataFrame, rows: int) -> int | None:
    """The ``rows``-th smallest hash of the ids; None if there are none."""
    top = ids.select(F.xxhash64("doc_id").alias("h")).orderBy("h").limit(rows)
    return top.agg(F.max("h")).first()[0]


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = 3000, pool_rows: int = 3000, **how) -> CoTrained | None:
    """From documents and rows (doc_id, quality 0 or 1); None without labels of both kinds."""
    small_batches(docs.sparkSession)
    given = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    limit = _limit_hash(given, labelled_rows)
    if limit is None:
        return None
    chosen = given.where(F.xxhash64("doc_id") <= limit)  # at most labelled_rows rows, but for equal hashes
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang", "n_chars").where("doc_id IS NOT NULL")
    edge = _limit_hash(read, pool_rows)
    if edge is None:
        return None
    picked = read.join(F.broadcast(chosen), "doc_id", "left").where(F.col("quality").isNotNull() | (F.xxhash64("doc_id") <= edge))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at = 0
            for text, page, _ in views(frame):
                part = frame.iloc[at:at + len(text)]
                at += len(text)
                yield pd.DataFrame({"doc_id": part["doc_id"], "quality": part["quality"].fillna(-1), "text": [r.tobytes() for r in text], "page": [r.tobytes() for r in page]})

    got = picked.mapInPandas(run, "doc_id long, quality int, text binary, page binary").dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    if not len(got):
        return None
    x = [np.frombuffer(b"".join(got[v]), np.float32).reshape(len(got), -1) for v in ("text", "page")]
    y, known = got["quality"].to_numpy(), got["quality"].to_numpy() >= 0
    apart = np.array([zlib.crc32(str(i).encode()) % 4 == 0 for i in got["doc_id"]])[known]
    y_known = y[known]
    if min((y_known[apart] == 0).sum(), (y_known[apart] == 1).sum(), (y_known[~apart] == 0).sum(), (y_known[~apart] == 1).sum()) == 0:
        apart = np.zeros(len(y_known), bool)
        if len(set(y_known.tolist())) < 2:
            return None
        return CoTrained([np.vstack([v[known]] * 2) for v in x], np.tile(y_known, 2), np.repeat([False, True], len(y_known)), [v[~known] for v in x], **how)
    return CoTrained([v[known] for v in x], y_known, apart, [v[~known] for v in x], **how)


def scored(docs: DataFrame, model: CoTrained | None, threshold: float = 0.4) -> DataFrame:
    """``docs`` with _score, _text_score, _page_score and _keep."""
    if model is None:
        none = F.lit(None).cast("double")
        return docs.withColumns({"_score": none, "_text_score": none, "_page_score": none, "_keep": F.lit(True)})
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("_score double, _text_score double, _page_score double")
    def score(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        frame = pd.DataFrame({"text": text, "source": source, "lang": lang, "n_chars": n_chars})
        made = [np.where((words > 0)[None], np.array(shared.value.scores(t, p)), 0.0) for t, p, words in views(frame)]
        made = np.concatenate(made, axis=1) if made else np.zeros((3, 0))
        give_back()
        return pd.DataFrame({"_score": made[0], "_text_score": made[1], "_page_score": made[2]})

    # the row goes through unchanged beside its scores
    out = docs.withColumn("_made", score("text", F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("double")))
    return out.select(*docs.columns, "_made.*").withColumn("_keep", F.col("_score") >= threshold)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.4, **how) -> DataFrame:
    """doc_id, score, text_score, page_score, keep per document."""
    rows = docs.select("doc_id", "text", "source", "lang", "n_chars")
    out = scored(rows, train(docs, labels, **how), threshold)
    return out.select("doc_id", F.col("_score").alias("score"), F.col("_text_score").alias("text_score"), F.col("_page_score").alias("page_score"), F.col("_keep").alias("keep"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.4, **how) -> DataFrame:
    """The rows of ``docs`` that aren't rejected."""
    return scored(docs, train(docs, labels, **how), threshold).where("_keep").select(*docs.columns)
