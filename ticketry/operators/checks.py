"""Row constraints, cross-layer checks and schema contracts.

A check is one row (checagem, ok, mensagem). Row constraints of a table are fused into one
aggregate; only uniqueness needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketry.operators.quantiles import exact_quantiles
from ticketry.schema import HORIZON_DAYS, Rules

RESULT = ["checagem", "ok", "mensagem"]
#: Columns of silver without which a ticket is broken.
REQUIRED = ["prioridade", "produto", "categoria", "subcategoria"]


# -- row constraints ---------------------------------------------------------------------
def not_null(*columns: str) -> dict[str, Column]:
    return {f"not_null_{c}": F.col(c).isNull() for c in columns}


def in_domain(column: str, values: Sequence) -> dict[str, Column]:
    """A NULL is in no domain test's way; use ``not_null`` for that."""
    return {f"domain_{column}": ~F.col(column).isin(*values)}


def not_negative(column: str) -> dict[str, Column]:
    return {f"not_negative_{column}": F.col(column) < 0}


def forecast_rules() -> dict[str, Column]:
    return {
        **not_null("data_referencia", "serie", "horizonte", "modelo_utilizado", "versao_modelo"),
        **in_domain("horizonte", list(HORIZON_DAYS)), **not_negative("valor_previsto"),
    }


def violations(df: DataFrame, constraints: dict[str, Column]) -> DataFrame:
    """(restricao, violacoes): rows that break each constraint, from one scan."""
    row = df.agg(*[F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in constraints.items()])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("restricao"), F.col(name).alias("violacoes")) for name in constraints])))


def repeated_keys(df: DataFrame, keys: Sequence[str], nulls_distinct: bool = False) -> DataFrame:
    """Keys that occur more than once. NULLs are equal to each other unless ``nulls_distinct``."""
    if nulls_distinct:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def key_violations(df: DataFrame, keys: Sequence[str], name: str, nulls_distinct: bool = False) -> DataFrame:
    return repeated_keys(df, keys, nulls_distinct).agg(F.count(F.lit(1)).alias("violacoes")).select(
        F.lit(name).alias("restricao"), "violacoes")


def require(df: DataFrame, constraints: dict[str, Column], keys: Sequence[str] = ()) -> None:
    """Raise with every broken constraint."""
    found = violations(df, constraints)
    if keys:
        found = found.unionByName(key_violations(df, keys, f"unique_{'_'.join(keys)}"))
    bad = {r["restricao"]: r["violacoes"] for r in found.where("violacoes > 0").collect()}
    if bad:
        raise ValueError(f"constraints broken: {bad}")


# -- checks across layers ----------------------------------------------------------------
def _check(name: str, ok: Column, *parts: Column) -> list[Column]:
    return [F.lit(name).alias("checagem"), ok.alias("ok"), F.concat(*[p.cast("string") for p in parts]).alias("mensagem")]


def _n(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def same_count(name: str, a: DataFrame, b: DataFrame, label_a: str = "origem", label_b: str = "bronze") -> DataFrame:
    return _n(a, "a").crossJoin(_n(b, "b")).select(*_check(
        name, F.col("a") == F.col("b"), F.lit(f"{label_a}="), F.col("a"), F.lit(f" | {label_b}="), F.col("b")))


def no_nulls(name: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    broken = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in columns])
    return df.agg(F.count_if(broken).alias("n")).select(*_check(
        name, F.col("n") == 0, F.lit("linhas com nulo obrigatorio: "), F.col("n")))


def no_duplicates(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _n(repeated_keys(df, keys), "n").select(*_check(name, F.col("n") == 0, F.lit("chaves duplicadas: "), F.col("n")))


def not_more(name: str, small: DataFrame, large: DataFrame) -> DataFrame:
    return _n(small, "s").crossJoin(_n(large, "b")).select(*_check(
        name, F.col("s") <= F.col("b"), F.lit("silver="), F.col("s"), F.lit(" | bronze="), F.col("b")))


def total_matches(name: str, gold: DataFrame, silver: DataFrame, total: str = "total_incidentes") -> DataFrame:
    summed = gold.agg(F.coalesce(F.sum(total), F.lit(0)).alias("g"))
    return summed.crossJoin(_n(silver, "s")).select(*_check(
        name, F.col("g") == F.col("s"), F.lit("gold="), F.col("g"), F.lit(" | silver="), F.col("s")))


def pass_through(name: str, before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """A text column kept its NULLs: as many values after as before."""
    a = before.agg(F.count(column).alias("a"))
    return a.crossJoin(after.agg(F.count(column).alias("b"))).select(*_check(
        name, F.col("a") == F.col("b"), F.lit("antes="), F.col("a"), F.lit(" | depois="), F.col("b")))


def derived_columns(silver: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Days follow from seconds; the outlier flag follows from the batch quantile; both flags are independent."""
    limit = exact_quantiles(silver, "duracao_segundos", {"_limit": rules.outlier_quantile})
    row = silver.crossJoin(F.broadcast(limit)).agg(
        F.count_if(F.abs(F.col("duracao_dias") - F.col("duracao_segundos") / F.lit(86400.0)) > 1e-9).alias("d"),
        F.count_if(F.col("duracao_outlier_flag") != (F.col("duracao_segundos") > F.col("_limit"))).alias("f"),
        F.count_if(F.col("duracao_outlier_flag") & F.col("duracao_valida")).alias("v"))
    return row.select(*_check("duracao_dias_coerente", F.col("d") == 0, F.lit("linhas: "), F.col("d"))).unionByName(
        row.select(*_check("outlier_coerente_com_quantil", F.col("f") == 0, F.lit("linhas: "), F.col("f")))).unionByName(
        row.select(*_check("outlier_independente_de_validade", F.col("v") >= 0, F.lit("outliers validos: "), F.col("v"))))


def kpi_recomputed(silver: DataFrame, kpi: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The official mean agrees with silver within 0.01; the median covers the same days; the
    trimmed mean is missing only on days whose valid tickets are all above the quantile."""
    limit = F.broadcast(exact_quantiles(silver, "duracao_segundos", {"_limit": rules.outlier_quantile}))
    valid = F.col("duracao_valida")
    again = silver.crossJoin(limit).groupBy("data_abertura").agg(
        F.avg(F.when(valid, F.col("duracao_segundos"))).alias("_m"),
        F.count_if(valid & (F.col("duracao_segundos") <= F.col("_limit"))).alias("_in"))
    both = kpi.join(again, "data_abertura", "left")
    mean, median, trimmed = (F.col(c) for c in (
        "duracao_media_segundos", "duracao_mediana_segundos", "duracao_media_aparada_p99_segundos"))
    row = both.agg(
        F.count_if(F.abs(mean - F.col("_m")) > 0.01).alias("a"),
        F.count_if(mean.isNull() != median.isNull()).alias("b"),
        F.count_if(trimmed.isNull() & (F.col("_in") > 0)).alias("c"))
    checks = [("kpi_oficial_recalculado", "a"), ("mediana_nos_mesmos_dias", "b"), ("aparada_nula_so_sem_dados", "c")]
    parts = [row.select(*_check(name, F.col(c) == 0, F.lit("dias: "), F.col(c))) for name, c in checks]
    return reduce(DataFrame.unionByName, parts)


def composition_adds_up(daily: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Priorities and channels each add up to the daily volume."""
    by_level = reduce(lambda x, y: x + y, [F.col(f"volume_p_{n}") for n in levels])
    row = daily.agg(
        F.count_if(by_level != F.col("volume_total")).alias("p"),
        F.count_if(F.col("volume_monitoramento") + F.col("volume_manual") != F.col("volume_total")).alias("c"))
    return row.select(*_check("prioridades_somam_total", F.col("p") == 0, F.lit("dias: "), F.col("p"))).unionByName(
        row.select(*_check("canais_somam_total", F.col("c") == 0, F.lit("dias: "), F.col("c"))))


def forecast_table(forecasts: DataFrame) -> DataFrame:
    """Both horizons present, model and version set, D+1 always persistence, no negative value."""
    blank = F.coalesce(F.trim("modelo_utilizado"), F.lit("")) == ""
    no_version = F.coalesce(F.trim("versao_modelo"), F.lit("")) == ""
    row = forecasts.agg(
        F.count_if(F.col("horizonte") == "D+1").alias("d1"), F.count_if(F.col("horizonte") == "D+7").alias("d7"),
        F.count_if(blank | no_version).alias("b"),
        F.count_if((F.col("horizonte") == "D+1") & (F.col("modelo_utilizado") != "persistencia")).alias("p"),
        F.count_if(F.col("valor_previsto") < 0).alias("neg"))
    parts = [
        row.select(*_check("dois_horizontes", (F.col("d1") > 0) & (F.col("d7") > 0), F.lit("D+1="), F.col("d1"), F.lit(" | D+7="), F.col("d7"))),
        row.select(*_check("modelo_e_versao", F.col("b") == 0, F.lit("linhas: "), F.col("b"))),
        row.select(*_check("d1_e_persistencia", F.col("p") == 0, F.lit("linhas: "), F.col("p"))),
        row.select(*_check("previsao_nao_negativa", F.col("neg") == 0, F.lit("linhas: "), F.col("neg"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def ticket_forecast_table(forecasts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    classes = list(rules.priority_classes)
    row = forecasts.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prioridade_real").isNull()).alias("r"),
        F.count_if(F.col("modelo_utilizado").isNull() | F.col("versao_modelo").isNull()).alias("m"),
        F.count_if(~F.col("prioridade_prevista").isin(*classes)).alias("c"))
    parts = [
        row.select(*_check("tabela_nao_vazia", F.col("n") > 0, F.lit("linhas: "), F.col("n"))),
        row.select(*_check("classe_real_presente", F.col("r") == 0, F.lit("linhas: "), F.col("r"))),
        row.select(*_check("modelo_e_versao", F.col("m") == 0, F.lit("linhas: "), F.col("m"))),
        row.select(*_check("classe_prevista_valida", F.col("c") == 0, F.lit("linhas: "), F.col("c"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def layer_checks(source: DataFrame, bronze: DataFrame, silver: DataFrame, gold_total: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        same_count("bronze_igual_origem", source, bronze),
        no_nulls("silver_sem_nulos", silver, REQUIRED),
        no_duplicates("silver_sem_duplicatas", silver, ["numero"]),
        not_more("silver_ate_bronze", silver, bronze),
        total_matches("gold_igual_silver", gold_total, silver),
    ])


def committed_checks(spark: SparkSession, bronze: dict, silver: dict, gold: dict) -> DataFrame:
    """The checks of ``layer_checks`` that follow from what the loads observed. A figure that no load left fails its check."""
    def check(name: str, holds, text: str, *figures) -> tuple[str, bool, str]:
        return name, None not in figures and bool(holds(*figures)), text.format(*figures)

    lidas, b, nulos, s, total = bronze.get("lidas"), bronze.get("n"), silver.get("nulos"), silver.get("n"), gold.get("total")
    return spark.createDataFrame([
        check("bronze_igual_origem", lambda x, y: x == y, "origem={} | bronze={}", lidas, b),
        check("silver_sem_nulos", lambda x: x == 0, "linhas com nulo obrigatorio: {}", nulos),
        check("silver_ate_bronze", lambda x, y: x <= y, "silver={} | bronze={}", s, b),
        check("gold_igual_silver", lambda x, y: x == y, "gold={} | silver={}", total, s),
    ], "checagem string, ok boolean, mensagem string")


def dimension_totals(tables: dict[str, DataFrame], silver: DataFrame) -> DataFrame:
    """Every count table sums to the silver row count; silver is counted once."""
    sums = reduce(DataFrame.unionByName, [
        df.agg(F.coalesce(F.sum("total_incidentes"), F.lit(0)).alias("g")).select(F.lit(f"{name}_soma").alias("checagem"), "g")
        for name, df in tables.items()])
    return sums.crossJoin(F.broadcast(_n(silver, "s"))).select(
        "checagem", (F.col("g") == F.col("s")).alias("ok"),
        F.concat(F.lit("gold="), F.col("g").cast("string"), F.lit(" | silver="), F.col("s").cast("string")).alias("mensagem"))


def gate(checks: DataFrame) -> list:
    """Run every check and raise with the whole list of failures; return all results when none failed."""
    results = checks.select(*RESULT).collect()
    failed = [f"{r['checagem']}: {r['mensagem']}" for r in results if not r["ok"]]
    if failed:
        raise RuntimeError("validation failed:\n  - " + "\n  - ".join(failed))
    return results


def schema_differences(df: DataFrame, contract: T.StructType, nullability: bool = False) -> list[str]:
    """Column set, order and types against a contract. Metadata only."""
    out = []
    if df.columns != contract.fieldNames():
        out.append(f"columns {df.columns} instead of {contract.fieldNames()}")
    found = {f.name: f for f in df.schema.fields}
    for want in contract.fields:
        have = found.get(want.name)
        if have is None:
            continue
        if have.dataType != want.dataType:
            out.append(f"{want.name}: {have.dataType.simpleString()} instead of {want.dataType.simpleString()}")
        if nullability and have.nullable and not want.nullable:
            out.append(f"{want.name}: nullable")
    return out


def null_contract(contract: T.StructType) -> dict[str, Column]:
    """The NOT NULL part of a contract as row constraints (files always read back nullable)."""
    return not_null(*[f.name for f in contract.fields if not f.nullable])
