"""Reading the raw extract: everything as text, a strict column contract, canonical names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketry.schema import INGEST_SEQ, SOURCE_COLUMNS


def column_differences(found: list[str], expected: list[str]) -> tuple[list[str], list[str]]:
    """(missing, unexpected) names."""
    return sorted(set(expected) - set(found)), sorted(set(found) - set(expected))


def check_columns(found: list[str], expected: list[str]) -> None:
    """Missing and unexpected columns are both errors. Metadata only, no job."""
    missing, extra = column_differences(found, expected)
    if missing or extra:
        raise ValueError(f"source columns differ from the contract: missing {missing}, unexpected {extra}")


def trimmed(df: DataFrame) -> DataFrame:
    """Column names without blanks around them; two that become the same are an error."""
    names = [c.strip() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names differ in blanks only: {sorted(df.columns)}")
    return df.toDF(*names)


def without(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` without the listed columns; one that is not there is an error."""
    require_columns(df, columns)
    return df.drop(*columns)


def require_columns(df: DataFrame, needed: list[str]) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"columns missing: {missing}")


def with_ingest_order(df: DataFrame, exact_rows: bool) -> DataFrame:
    """Stamp the source order that later decides which duplicate came first.

    Parquet knows the row index. Text files do not: there the order is file, start of the
    block, and an id that grows inside each task (blocks are dealt to tasks in any order,
    rows of one block are not).
    """
    row = F.col("_metadata.row_index") if exact_rows else F.monotonically_increasing_id()
    return df.withColumn(
        INGEST_SEQ,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            row.alias("row"),
        ),
    )


def read_source(
    spark: SparkSession, path: str, fmt: str = "csv", columns: dict[str, str] | None = None, multi_line: bool = False,
) -> DataFrame:
    """The raw extract as strings under its canonical names, plus the ingest sequence.

    csv:     header row, no type inference; ``multi_line`` allows line breaks inside quotes, at
             the price of one task per file
    json:    one object per line
    parquet: any types, cast to text
    A missing path raises when the reader resolves it.
    """
    columns = columns or SOURCE_COLUMNS
    if fmt == "csv":
        header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
        check_columns([c.strip() for c in header], list(columns))
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        raw = (
            spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
            .option("escape", '"').option("enforceSchema", False)
            # a row that is too short or too long fails the job, whatever columns its reader selects
            .option("mode", "FAILFAST").option("columnPruning", False).csv(path)
        )
    elif fmt == "json":
        # With an explicit schema an unexpected field would be dropped unseen, so the names
        # are taken from the data first.
        names = spark.read.option("primitivesAsString", True).json(path).columns
        check_columns([c.strip() for c in names], list(columns))
        raw = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).json(path)
    elif fmt == "parquet":
        raw = spark.read.parquet(path)
        check_columns([c.strip() for c in raw.columns], list(columns))
    else:
        raise ValueError(f"unknown source format: {fmt}")
    raw = with_ingest_order(raw, exact_rows=fmt == "parquet")
    by_name = {c.strip(): c for c in raw.columns if c != INGEST_SEQ}
    return raw.select(
        *[F.col(f"`{by_name[src]}`").cast("string").alias(dst) for src, dst in columns.items()], INGEST_SEQ
    )
