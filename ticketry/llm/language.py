"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit a binary classifier over hashed letter n-grams tells the languages with 1 there
from those with 0: the mean log ratio of the n-grams' probabilities in the two groups. All bits come from one table of
n-gram counts by language, summed over all learning rows in one distributed pass, so no sample is drawn. Decoding weighs
each bit by its margin: the codeword with the smallest sum of logistic losses wins, and a second one within
``ambiguous_margin`` flags the row as ambiguous.

Defined cases: text that is null or has no letter gives ``und`` with score 0; null languages and texts without letters
teach nothing; one learned language is always predicted, none gives ``und``; of equally near codewords the smaller name
wins; repeated rows count as often as they come; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import give_back, small_batches
from ticketry.llm.features import gram_counts

UNKNOWN = "und"
WIDTH, SIZE = 3, 4096
#: More learned languages than this are an error: the count table is held on the driver.
MOST_LANGUAGES = 1000
_PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def letters(text: str | None) -> bytes:
    """Lower-cased bytes with ASCII non-letters as blanks; empty without any letter."""
    text = (text or "").lower()
    if not (text.isalpha() or any(map(str.isalpha, text))):
        return b""
    return b" " + b" ".join(text.encode().translate(_PLAIN).split()) + b" "


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text is a multiple of 5; a null id is one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def language_counts(rows: DataFrame) -> dict[str, np.ndarray]:
    """n-gram counts by language of rows (text, lang): partial sums a batch, added up by language and slot."""
    small_batches(rows.sparkSession)
    if rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            names = frame["lang"].tolist()
            at = 0
            for counts in gram_counts([letters(t) for t in frame["text"]], WIDTH, SIZE):
                batch = np.array(names[at:at + len(counts)])
                at += len(counts)
                for name in np.unique(batch).tolist():
                    sums[name] = sums.get(name, 0) + counts[batch == name].sum(axis=0)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "counts": list(sums.values())})

    parts = rows.select("text", "lang").mapInPandas(partial, "lang string, counts array<long>")
    total = parts.select("lang", F.posexplode("counts").alias("slot", "n")).groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    table: dict[str, np.ndarray] = {}
    for name, slots, n in total.groupBy("lang").agg(F.collect_list("slot"), F.collect_list("n")).collect():
        table[name] = np.zeros(SIZE)
        table[name][slots] = n
    return {name: table[name] for name in sorted(table) if table[name].sum() > 0}


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """[n, bits] of 0 and 1: all different splits of up to 6 languages, else random balanced ones, no two rows alike."""
    if n < 2:
        return np.zeros((n, 0), int)
    if n <= 6:
        return np.array([[(c >> i) & 1 for c in range(1, 2 ** (n - 1))] for i in range(n)])
    random = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(n)))
    while True:
        code = np.stack([random.permutation(np.arange(n) % 2) for _ in range(bits)], axis=1)
        if len(np.unique(code, axis=0)) == n:
            return code


class Classifier:
    """Names, codewords and one weight a bit and n-gram."""

    def __init__(self, counts: dict[str, np.ndarray], smoothing: float = 0.5, evidence: float = 64.0) -> None:
        self.names, self.evidence = list(counts), evidence
        self.code = codewords(len(self.names))
        # languages weigh alike whatever their share of the rows
        share = np.array([(c + smoothing) / (c.sum() + smoothing * SIZE) for c in counts.values()]).reshape(len(self.names), SIZE)
        ones, zeros = self.code.T / np.maximum(1, self.code.sum(axis=0))[:, None], (1 - self.code).T / np.maximum(1, (1 - self.code).sum(axis=0))[:, None]
        self.weights = np.log(ones @ share) - np.log(zeros @ share) if self.code.shape[1] else np.zeros((0, SIZE))

    def predict(self, texts: list[str | None], ambiguous_margin: float = 1.0) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Names, scores from 0 to 1 and flags of ambiguity."""
        names: list[str] = []
        scores, flags = np.zeros(len(texts)), np.zeros(len(texts), bool)
        for counts in gram_counts([letters(t) for t in texts], WIDTH, SIZE):
            n, at = counts.sum(axis=1), len(names)
            margins = (counts @ self.weights.T) / (n + self.evidence)[:, None] * self.evidence
            loss = np.logaddexp(0, np.where(self.code == 1, -1, 1)[None] * margins[:, None, :]).sum(axis=2)
            if not self.names:
                names += [UNKNOWN] * len(counts)
                continue
            best = loss.argmin(axis=1)
            rest = np.sort(loss, axis=1)
            some = n > 0
            names += [self.names[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist(), strict=True)]
            near = np.exp(rest[:, :1] - rest).sum(axis=1)
            scores[at:at + len(counts)] = np.where(some, 1 / near, 0)
            flags[at:at + len(counts)] = some & (rest.shape[1] > 1) & (rest[:, min(1, rest.shape[1] - 1)] - rest[:, 0] < ambiguous_margin)
        return names, scores, flags


def train(rows: DataFrame) -> Classifier:
    """From rows (text, lang)."""
    return Classifier(language_counts(rows.where("lang IS NOT NULL")))


def identify(docs: DataFrame, classifier: Classifier, ambiguous_margin: float = 1.0) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous from doc_id and text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names, scores, flags = shared.value.predict(frame.pop("text").tolist(), ambiguous_margin)
            yield frame.assign(lang_pred=names, score=scores, ambiguous=flags)
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous per document, learned from the documents that aren't held out."""
    classifier = train(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    return identify(docs, classifier).withColumn("held_out", held_out(F.col("doc_id")))
