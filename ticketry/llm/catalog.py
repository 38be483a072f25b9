"""One registered query for each operator of the package, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketry.llm import (
    bpe, centroids, filter_audit, html_text, language, mixing, neighbours, packing, quality, secrets, shingle_join, token_counts, vector_dedup,
)
from ticketry.llm.common import scratch, table

QUERIES = {
    "op1_token_counts": lambda spark, d: token_counts.corpus_counts(table(spark, d, "documents"), table(spark, d, "labels"), scratch(spark, "counts")),
    "op2_secret_scans": lambda spark, d: secrets.scan(table(spark, d, "documents")),
    "op3_bpe": lambda spark, d: bpe.digests(table(spark, d, "documents")),
    "op4_nearest_neighbours": lambda spark, d: neighbours.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0),
    "op5_quality_classifier": lambda spark, d: quality.classify(table(spark, d, "documents"), table(spark, d, "labels")),
    "op6_embedding_near_dedup": lambda spark, d: vector_dedup.near_duplicates(table(spark, d, "embeddings")),
    "op7_language_id": lambda spark, d: language.languages(table(spark, d, "documents")),
    "op8_html_extraction": lambda spark, d: html_text.extract(table(spark, d, "pages")),
    "op9_ngram_jaccard_join": lambda spark, d: shingle_join.groups(table(spark, d, "documents")),
    "op10_source_mixing": lambda spark, d: mixing.mix(table(spark, d, "documents")),
    "op11_centroid_clusters": lambda spark, d: centroids.clusters(table(spark, d, "embeddings")),
    "op12_filter_audit": lambda spark, d: filter_audit.audit(table(spark, d, "documents"), table(spark, d, "labels")),
    "op13_best_fit_packing": lambda spark, d: packing.pack(table(spark, d, "documents")),
}

ORACLES = {
    "op1_token_counts": token_counts.ORACLE,
    "op2_secret_scans": secrets.oracle(),
    "op4_nearest_neighbours": neighbours.ORACLE,
    "op6_embedding_near_dedup": vector_dedup.ORACLE,
    "op9_ngram_jaccard_join": shingle_join.ORACLE,
    "op10_source_mixing": mixing.ORACLE,
    "op11_centroid_clusters": centroids.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
}
