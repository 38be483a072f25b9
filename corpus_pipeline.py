"""Documents to token ids: rejected by quality, one of each group of near duplicates, secrets masked, sources mixed, encoded.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of documents. The classifier of the first stage is no SQL, so there is no SQL for the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketry.llm import bpe, mixing, quality, secrets, shingle_join
from ticketry.llm.common import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group; of rows that share that id one stays. Null ids stay.

    Near duplicates share 80 % of their shingles of five words; the 90 % of three words are op9's own contract.
    """
    return shingle_join.representatives(docs, width=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return secrets.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, digests of ids and decoded text, and the ids."""
    return bpe.encode(docs.select("doc_id", "source", "lang", "text"))


STAGES = [("quality classifier", keep_good), ("near duplicates", keep_one_of_each), ("secrets", mask_secrets), ("source mix", mix_sources), ("encoding", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a table in the shared folder that the next stage reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
