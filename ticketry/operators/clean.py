"""Raw text tickets to typed tickets. The only place where data quality is decided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketry.functions import columns as C
from ticketry.operators.quantiles import exact_quantiles
from ticketry.schema import INGEST_SEQ, SILVER_COLUMNS, Rules

DEFECTS = ("sem_data_obrigatoria", "duracao_nao_numerica", "duracao_negativa", "kpi_fora_do_dominio")


def _parsed(raw: DataFrame, date_format: str | None) -> DataFrame:
    return raw.withColumns({
        "aberto": C.lenient_timestamp("aberto", date_format),
        "resolvido": C.lenient_timestamp("resolvido", date_format),
        "encerrado": C.lenient_timestamp("encerrado", date_format),
        "_seconds": C.lenient_number("duracao_segundos"),
        "_kpi": C.yes_no("entrou_kpi"),
    })


def _defect_tests() -> dict[str, Column]:
    """Number of broken mandatory values per row, by kind."""
    return {
        "sem_data_obrigatoria": F.col("aberto").isNull().cast("int") + F.col("encerrado").isNull().cast("int"),
        "duracao_nao_numerica": (F.col("_seconds").isNull() | F.isnan("_seconds")).cast("int"),
        "duracao_negativa": F.coalesce((F.col("_seconds") < 0).cast("int"), F.lit(0)),
        "kpi_fora_do_dominio": F.col("_kpi").isNull().cast("int"),
    }


def defect_report(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """All guards in one pass: one row with the number of broken values of each kind."""
    tests = _defect_tests()
    return _parsed(raw, date_format).agg(*[
        F.coalesce(F.sum(tests[name]), F.lit(0)).cast("long").alias(name) for name in DEFECTS
    ])


def require_clean(raw: DataFrame, date_format: str | None = None) -> None:
    """Raise with the counts when any mandatory value is broken."""
    found = {k: v for k, v in defect_report(raw, date_format).first().asDict().items() if v}
    if found:
        raise ValueError(f"broken values in the raw tickets: {found}")


def outlier_limit(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row: the duration quantile of the whole batch, duplicates included."""
    seconds = raw.select(C.lenient_number("duracao_segundos").cast("long").alias("duracao_segundos"))
    return exact_quantiles(seconds, "duracao_segundos", {"_limit": rules.outlier_quantile})


def first_delivery(df: DataFrame, keys: list[str], order: str = INGEST_SEQ) -> DataFrame:
    """The first row per key in source order.

    ``row_number() = 1`` is pushed below the shuffle, so each task sends on one row per key and
    a key that was delivered over and over does not pile up in one partition.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def clean(raw: DataFrame, rules: Rules = Rules(), strict: bool = True, date_format: str | None = None) -> DataFrame:
    """Typed, deduplicated tickets in contract order.

    With ``strict`` a broken mandatory value fails the job that reads the result, at the row
    where it is found; no extra pass is needed. ``defect_report`` gives the counts.
    """
    df = _parsed(raw, date_format)
    if strict:
        tests = _defect_tests()
        broken = F.concat_ws(", ", *[F.when(t > 0, F.lit(name)) for name, t in tests.items()])
        stop = F.raise_error(F.concat(F.lit("broken ticket "), F.coalesce("numero", F.lit("NULL")), F.lit(": "), broken))
        # a filter, not a column: a reader that selects other columns cannot prune it
        df = df.where(F.when(sum(tests.values(), F.lit(0)) == 0, F.lit(True)).otherwise(stop.cast("boolean")))
    df = df.withColumn("duracao_segundos", F.col("_seconds").cast("long"))
    span = C.seconds_between("aberto", "encerrado") * F.lit(rules.duration_tolerance)
    df = df.crossJoin(F.broadcast(outlier_limit(raw, rules)))
    df = df.withColumns({
        **{c: C.or_default(c, rules.default_label) for c in rules.default_label_columns},
        "foi_resolvido": F.col("resolvido").isNotNull(),
        "duracao_valida": F.col("duracao_segundos") <= span,
        "duracao_dias": F.col("duracao_segundos") / F.lit(86400.0),
        "duracao_outlier_flag": F.col("duracao_segundos") > F.col("_limit"),
        "entrou_kpi": F.col("_kpi"),
        "kpi_violado": C.yes_no("kpi_violado"),
        "data_abertura": F.to_date("aberto"),
        "ano": F.year("aberto"),
        "mes": F.month("aberto"),
        "dia_semana": C.monday_zero("aberto"),
    })
    return first_delivery(df.select(*SILVER_COLUMNS, INGEST_SEQ), ["numero"]).select(*SILVER_COLUMNS)


def dropped_duplicates(raw: DataFrame) -> DataFrame:
    """One row: deliveries beyond the first of their key."""
    return raw.groupBy("numero").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("linhas_descartadas"),
        F.count_if(F.col("n") > 1).alias("chaves_repetidas"),
    )
