"""Vocabularies and TF-IDF rows as tables: no list of terms ever comes to the driver.

Texts are counted first, so a text that a third of all tickets share is one row. Terms are counted by a shuffle on the term,
their places in the vocabulary come from a sort by ranges and the sizes of these ranges, and the rows' weights from a join
with the vocabulary, which spreads terms that stand in very many texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketry.functions import text as T
from ticketry.operators.lookups import lookup_join
from ticketry.session import settled

TEXT_ID = "_text"


def terms_of(text: Column, max_ngram: int = 2) -> Column:
    """Lower-case words of two letters or more, then their n-grams, as one list; empty for NULL."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(T.WORD), F.lit(0))
    lists = [words]
    for n in range(2, max_ngram + 1):
        last = F.size(words) - (n - 1)
        places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        lists.append(F.transform(places, _gram(words, n)))
    return F.concat(*lists)


def _gram(words: Column, n: int):
    return lambda i: F.array_join(F.slice(words, i, n), " ")


def text_id(text: str | Column) -> Column:
    """What stands for a text in joins; NULL counts as an empty text."""
    return F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), 256)


def texts(rows: DataFrame, column: str) -> DataFrame:
    """The different texts of a column: _text (its id), text, n (rows that have it)."""
    return rows.select(text_id(column).alias(TEXT_ID), F.coalesce(column, F.lit("")).alias("text")).groupBy(TEXT_ID).agg(
        F.min("text").alias("text"), F.count(F.lit(1)).alias("n"))


def term_counts(of: DataFrame, max_ngram: int = 2, *columns: str) -> DataFrame:
    """_text, term, tf (how often the text has it) and ``columns``."""
    found = of.select(TEXT_ID, *columns, F.explode(terms_of(F.col("text"), max_ngram)).alias("term"))
    return found.groupBy(TEXT_ID, *columns, "term").agg(F.count(F.lit(1)).alias("tf"))


def numbered(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """``df`` with the place (from 0) of each row in a total order, as column ``out``.

    Rows are dealt out by ranges of the order and sorted inside them; a row's place is its place there and the number of
    rows in the ranges before, of which there is one figure each. No task sees all rows.
    """
    dealt = settled(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    place = dealt.withColumn("_range", F.shiftright("_id", 33)).withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = place.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return place.join(F.broadcast(starts), "_range").withColumn(out, F.col("_start") + F.col("_place")).drop("_id", "_range", "_place", "_start")


def vocabulary(counts: DataFrame, documents: int, min_df: int = 1, max_features: int | None = None) -> DataFrame:
    """term, df, total, idf, index from rows (term, tf, n).

    Terms in fewer than ``min_df`` documents are left out, then all but the ``max_features`` with the highest totals (ties
    by name). Places follow the names. idf is ln((1 + documents) / (1 + df)) + 1.
    """
    found = counts.groupBy("term").agg(F.sum("n").alias("df"), F.sum(F.col("tf") * F.col("n")).alias("total")).where(F.col("df") >= min_df)
    if max_features is not None:
        found = numbered(found, [F.desc("total"), F.asc("term")], "_place").where(F.col("_place") < max_features).drop("_place")
    idf = F.log((F.lit(1.0) + documents) / (F.lit(1.0) + F.col("df"))) + 1.0
    return settled(numbered(found, [F.asc("term")], "index").select("term", "df", "total", idf.alias("idf"), F.col("index").cast("int").alias("index")))


def weights(counts: DataFrame, terms: DataFrame, *columns: str) -> DataFrame:
    """_text, ``columns`` of the terms' table and weight (tf * idf) of all known terms of the texts."""
    known = lookup_join(counts, terms.select("term", "idf", *columns), ["term"], [TEXT_ID]).where("idf IS NOT NULL")
    return known.select(TEXT_ID, *columns, (F.col("tf") * F.col("idf")).alias("weight"))


def sparse_rows(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """_text, indices, values of the texts with a known term: TF-IDF brought to length 1, indices ascending."""
    entries = F.array_sort(F.collect_list(F.struct("index", "weight")))
    rows = weights(counts, terms, "index").groupBy(TEXT_ID).agg(entries.alias("e"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return rows.select(TEXT_ID, F.col("e.index").alias("indices"), F.transform("e.weight", lambda w: w / F.col("norm")).alias("values"))
