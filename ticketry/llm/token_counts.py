"""Token counts as rollups that deltas maintain.

A store is a folder. A batch of signed changes (inserts, deletes, revised counts) becomes one small table of additive
totals by source, language and tokenizer version, then one commit row. The totals are the sum over committed batches, so
nothing is rewritten and no state per document is kept. A batch whose id is committed is not applied again; a batch that
was lost before its commit row leaves a folder that nobody reads, and is simply applied anew. If two writers commit the
same id, readers take the attempt with the smallest name, so the batch counts once.

Defined cases: null counts are 0; null sources, languages and versions are groups of their own; a null batch id, or a
change of another kind, is an error; repeated changes of a batch count as often as they come; an empty batch commits and
changes nothing; extra columns are not read.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketry.llm.common import WORD, written

KEYS = "source", "lang", "tokenizer"
DELTA = "source string, lang string, tokenizer string, documents long, tokens long"
COMMIT = "batch string, attempt string"
#: Tokenizer versions that Spark counts by itself: a pattern, one token a match.
PATTERNS = {"words-1": WORD, "pieces-2": r"[A-Za-z]+|[0-9]|[^A-Za-z0-9\x20\x09-\x0D]"}


def n_tokens(text: Column, tokenizer: str) -> Column:
    """Tokens of a text by a version's pattern; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(PATTERNS[tokenizer])), F.lit(0)).cast("long")


def changes(rows: DataFrame, kind: str, tokenizer: str, n: str, before: str | None = None) -> DataFrame:
    """Rows with source, lang and a count as changes of a kind: insert, delete, or revise with the count ``before``."""
    old = F.lit(None) if before is None else F.col(before)
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(kind).alias("kind"), F.col(n).cast("long").alias("n_tokens"),
                       old.cast("long").alias("n_before"))


class Rollups:
    """The rollups in a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def commits(self) -> DataFrame:
        """The attempt that counts for each committed batch."""
        return self._read("commits", COMMIT).groupBy("batch").agg(F.min("attempt").alias("attempt"))

    def apply(self, batch: str, rows: DataFrame) -> bool:
        """Commit the changes of a batch; False if it was committed before."""
        if not batch:
            raise ValueError("a batch needs an id")
        if not self.commits().where(F.col("batch") == batch).isEmpty():
            return False
        n, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("n_before", F.lit(0))
        kind = F.col("kind")
        wrong = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null")))).cast("long")
        sign = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(wrong)
        tokens = F.when(kind == "insert", n).when(kind == "delete", -n).when(kind == "revise", n - old).otherwise(wrong)
        delta = rows.groupBy(*KEYS).agg(F.sum(sign).alias("documents"), F.sum(tokens).alias("tokens"))
        attempt = f"{batch}-{uuid.uuid4().hex}"
        delta.withColumn("attempt", F.lit(attempt)).write.mode("append").partitionBy("attempt").parquet(f"{self.folder}/deltas")
        self.spark.createDataFrame([(batch, attempt)], COMMIT).coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens; groups that came to nothing are left out."""
        deltas = self._read("deltas", f"{DELTA}, attempt string")
        live = deltas.join(self.commits(), "attempt", "left_semi")
        sums = live.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents != 0 OR tokens != 0")


def rollup(totals: DataFrame) -> DataFrame:
    """Totals of every combination of source, language and version, and of all: level tells which keys are summed over."""
    return totals.cube(*KEYS).agg(F.grouping_id().alias("level"), F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).select(
        F.col("level").cast("long").alias("level"), *KEYS, "documents", "tokens")


def corpus_counts(docs: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """The rollups of a corpus with a history: all documents inserted under both versions, toxic ones deleted again, and the
    texts of documents of low quality counted anew without their digits, both under both versions. The first batch comes
    twice, as after a lost reply.
    """
    store = Rollups(docs.sparkSession, folder)
    plain = F.regexp_replace("text", "[0-9]+", "")
    counts = written(docs.select("doc_id", "source", "lang", *[n_tokens(F.col("text"), v).alias(v) for v in PATTERNS],
                                 *[n_tokens(plain, v).alias(f"plain_{v}") for v in PATTERNS]), "counts")

    def batch(rows: DataFrame, kind: str, n: str, before: str | None = None) -> DataFrame:
        """Changes of a kind under all versions; ``n`` and ``before`` name the counts of a version."""
        parts = [changes(rows, kind, v, n.format(v), before and before.format(v)) for v in PATTERNS]
        return reduce(DataFrame.unionByName, parts)

    store.apply("load", batch(counts, "insert", "{}"))
    store.apply("load", batch(counts, "insert", "{}"))
    judged = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    marked = counts.join(judged, "doc_id")
    store.apply("toxic", batch(marked.where("toxic = 1"), "delete", "{}"))
    store.apply("revised", batch(marked.where("quality = 0 AND toxic = 0"), "revise", "plain_{}", "{}"))
    return rollup(store.totals())


ORACLE = r"""
WITH j AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
w AS (SELECT d.source, d.lang, j.toxic, j.quality, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS words,
  coalesce(len(regexp_extract_all(text, '[A-Za-z]+|[0-9]|[^A-Za-z0-9\x20\x09-\x0D]')), 0) AS pieces,
  coalesce(len(regexp_extract_all(regexp_replace(text, '[0-9]', '', 'g'), '[^\x20\x09-\x0D]+')), 0) AS plain_words,
  coalesce(len(regexp_extract_all(regexp_replace(text, '[0-9]', '', 'g'), '[A-Za-z]+|[0-9]|[^A-Za-z0-9\x20\x09-\x0D]')), 0) AS plain_pieces
  FROM documents d LEFT JOIN j USING (doc_id)),
v AS (SELECT source, lang, toxic, quality, 'words-1' AS tokenizer, words AS n, plain_words AS plain FROM w UNION ALL SELECT source, lang, toxic, quality, 'pieces-2', pieces, plain_pieces FROM w),
c AS (SELECT source, lang, tokenizer, 1 AS documents, n AS tokens FROM v
  UNION ALL SELECT source, lang, tokenizer, -1, -n FROM v WHERE toxic = 1
  UNION ALL SELECT source, lang, tokenizer, 0, plain - n FROM v WHERE quality = 0 AND toxic = 0),
t AS (SELECT source, lang, tokenizer, sum(documents) AS documents, sum(tokens) AS tokens FROM c GROUP BY ALL HAVING sum(documents) <> 0 OR sum(tokens) <> 0)
SELECT grouping_id(source, lang, tokenizer)::BIGINT AS level, source, lang, tokenizer, sum(documents)::BIGINT AS documents, sum(tokens)::BIGINT AS tokens
FROM t GROUP BY CUBE (source, lang, tokenizer)
"""
