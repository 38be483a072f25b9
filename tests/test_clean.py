import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ticketry.functions import columns as C
from ticketry.operators.clean import clean, defect_report, dropped_duplicates, first_delivery, require_clean
from ticketry.operators.checks import schema_differences
from ticketry.schema import BRONZE_COLUMNS, INGEST_SEQ, SILVER_COLUMNS, SILVER_SCHEMA

GOOD = dict(
    numero="INC1", prioridade="2 - Alta", produto="p1", categoria="c1", subcategoria="s1", grupo_designado="Team14",
    item_configuracao="IC1", aberto="2025-09-01 13:05:00", resolvido="2025-09-01 14:05:00", encerrado="2025-09-01 15:05:00",
    duracao_segundos="3600", codigo_fechamento="x", descricao_resumida="d", solucao="s", aberto_por="Manual",
    incidente_pai=None, status="Encerrado", entrou_kpi="SIM", kpi_violado="NAO")


def raw(spark, *changes):
    rows = [({**GOOD, **c}) for c in changes]
    schema = ", ".join(f"{c} string" for c in BRONZE_COLUMNS) + f", {INGEST_SEQ} long"
    return spark.createDataFrame([tuple(r[c] for c in BRONZE_COLUMNS) + (i,) for i, r in enumerate(rows)], schema)


def one(spark, **change):
    return clean(raw(spark, change)).first()


def test_contract_order_and_types(spark):
    out = clean(raw(spark, {}))
    assert out.columns == SILVER_COLUMNS
    assert schema_differences(out, SILVER_SCHEMA) == []


@pytest.mark.parametrize("column", ["produto", "categoria", "subcategoria", "codigo_fechamento"])
def test_null_and_empty_get_the_default_blank_stays(spark, column):
    rows = clean(raw(spark, {"numero": "1", column: None}, {"numero": "2", column: ""}, {"numero": "3", column: "  "}))
    got = {r["numero"]: r[column] for r in rows.collect()}
    assert got == {"1": "Não informado", "2": "Não informado", "3": "  "}


def test_dates_flags_and_derived_columns(spark):
    r = one(spark)
    assert r["aberto"] == dt.datetime(2025, 9, 1, 13, 5) and r["foi_resolvido"] is True
    assert (r["data_abertura"], r["ano"], r["mes"], r["dia_semana"]) == (dt.date(2025, 9, 1), 2025, 9, 0)
    assert r["duracao_dias"] == pytest.approx(3600 / 86400) and r["duracao_valida"] is True
    assert r["entrou_kpi"] is True and r["kpi_violado"] is False


def test_unparseable_resolution_is_unresolved(spark):
    r = one(spark, resolvido="n/d")
    assert r["resolvido"] is None and r["foi_resolvido"] is False


def test_duration_tolerance_is_inclusive(spark):
    seconds = 7200
    rows = clean(raw(spark, {"numero": "1", "duracao_segundos": str(int(seconds * 1.05))},
                     {"numero": "2", "duracao_segundos": str(int(seconds * 1.05) + 1)}))
    assert {r["numero"]: r["duracao_valida"] for r in rows.collect()} == {"1": True, "2": False}


def test_decimal_duration_is_cut(spark):
    assert one(spark, duracao_segundos="12.9")["duracao_segundos"] == 12


@pytest.mark.parametrize("text,value", [("SIM", True), (" nao ", False), ("Sim", True)])
def test_yes_no(spark, text, value):
    assert one(spark, entrou_kpi=text)["entrou_kpi"] is value


def test_unknown_violation_is_null(spark):
    assert one(spark, kpi_violado="NÃO")["kpi_violado"] is None


@pytest.mark.parametrize("change,kind", [
    ({"aberto": "99/99"}, "sem_data_obrigatoria"), ({"encerrado": None}, "sem_data_obrigatoria"),
    ({"duracao_segundos": "abc"}, "duracao_nao_numerica"), ({"duracao_segundos": "-1"}, "duracao_negativa"),
    ({"entrou_kpi": "NÃO"}, "kpi_fora_do_dominio"), ({"entrou_kpi": None}, "kpi_fora_do_dominio"),
])
def test_broken_mandatory_values(spark, change, kind):
    df = raw(spark, {"numero": "1"}, {"numero": "2", **change})
    assert defect_report(df).first()[kind] == 1
    with pytest.raises(ValueError, match=kind):
        require_clean(df)
    with pytest.raises(PySparkException, match=kind):
        clean(df).collect()
    with pytest.raises(PySparkException, match=kind):  # also for a reader of other columns
        clean(df).select("numero", "prioridade").collect()


def test_yes_and_no_with_any_white_space(spark):
    rows = [("SIM\t", True), ("\n nao", False), ("\u00a0Sim\r\n", True), ("S IM", None), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "t string, want boolean")
    assert df.where(~C.yes_no("t").eqNullSafe(F.col("want"))).isEmpty()


def test_broken_duplicate_fails_too(spark):
    with pytest.raises(PySparkException):
        clean(raw(spark, {}, {"duracao_segundos": "abc"})).collect()


def test_first_delivery_wins_whatever_the_partitioning(spark):
    df = raw(spark, {"produto": "first"}, {"produto": "second"}, {"numero": "INC2"}).repartition(4)
    got = {r["numero"]: r["produto"] for r in clean(df).collect()}
    assert got == {"INC1": "first", "INC2": "p1"}
    row = dropped_duplicates(df).first()
    assert (row["linhas_descartadas"], row["chaves_repetidas"]) == (1, 1)


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 3000, 1, 4).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    out = first_delivery(df, ["k"], "id")
    assert out.count() == 2001 and out.where("k = 'hot'").first()["id"] == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_outlier_limit_uses_the_whole_batch(spark):
    rows = [{"numero": str(i), "duracao_segundos": str(i)} for i in range(101)]
    flagged = clean(raw(spark, *rows)).where("duracao_outlier_flag").collect()
    assert [r["numero"] for r in flagged] == ["100"]
