import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ticketry.operators import checks, sketches
from ticketry.plans import etl, registry
from ticketry.schema import BRONZE_COLUMNS, GOLD_SCHEMAS, INGEST_SEQ, SOURCE_COLUMNS, STAND_IN_RULES, SILVER_SCHEMA
from ticketry.sources import raw, stand_ins as SI
from ticketry.sources.lake import Lake, add_columns
from ticketry.sources.raw import read_source


SERIES_COLUMNS = "data_referencia date, serie string, horizonte string, valor_previsto double, modelo_utilizado string, versao_modelo string"


def forecasts(spark, *rows):
    """Rows of (day of March 2031, series, horizon, value, model version)."""
    return spark.createDataFrame([(dt.date(2031, 3, day), serie, f"D+{days}", float(value), "linha de base", version)
                                  for day, serie, days, value, version in rows], SERIES_COLUMNS)


# -- sources -----------------------------------------------------------------------------
def _write_csv(spark, path, headers):
    rows = [tuple(f"{h}-{i}" for h in headers) for i in range(5)]
    spark.createDataFrame(rows, [h.replace(" ", "_") for h in headers]).toDF(*headers).coalesce(1).write.option("header", True).csv(path)


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_source_is_all_text_under_canonical_names(spark, base, fmt):
    headers = list(SOURCE_COLUMNS)
    df = spark.createDataFrame([tuple(f"{h}-{i}" for h in headers) for i in range(5)], headers)
    writer = df.coalesce(1).write
    (writer.option("header", True).csv(base) if fmt == "csv" else getattr(writer, fmt)(base))
    out = read_source(spark, base, fmt)
    assert out.columns == [*BRONZE_COLUMNS, INGEST_SEQ]
    assert all(out.schema[c].dataType.simpleString() == "string" for c in BRONZE_COLUMNS)
    assert [r["numero"] for r in out.orderBy(INGEST_SEQ).collect()] == [f"Número-{i}" for i in range(5)]


@pytest.mark.parametrize("line", ["1,2,3", "1"])
def test_rows_of_another_length_are_an_error(spark, tmp_path, line):
    (tmp_path / "rows.csv").write_text(f"a,b\nx,y\n{line}\n")
    for columns in (["one"], ["one", "two"]):
        with pytest.raises(Exception, match="(?i)malformed"):
            read_source(spark, str(tmp_path / "rows.csv"), columns={"a": "one", "b": "two"}).select(*columns).collect()


@pytest.mark.parametrize("change", ["missing", "extra"])
def test_source_contract(spark, base, change):
    headers = list(SOURCE_COLUMNS)[:-1] if change == "missing" else [*SOURCE_COLUMNS, "Outra"]
    _write_csv(spark, base, headers)
    with pytest.raises(ValueError, match="KPI Violado" if change == "missing" else "Outra"):
        read_source(spark, base)


def test_names_are_trimmed_and_listed_columns_dropped(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" a", "b ", "c"])
    assert raw.trimmed(df).columns == ["a", "b", "c"] and raw.without(raw.trimmed(df), ["b"]).columns == ["a", "c"]
    with pytest.raises(ValueError, match="blanks only"):
        raw.trimmed(spark.createDataFrame([(1, 2)], ["a", " a"]))
    with pytest.raises(ValueError, match="missing"):
        raw.without(df, ["x"])
    assert raw.column_differences(["a", "b"], ["b", "c"]) == (["c"], ["a"])


def test_missing_source_raises(spark, base):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_source(spark, base + "/nothing")


# -- full loads --------------------------------------------------------------------------
def test_full_load_can_be_repeated_and_counted(spark, base):
    lake = Lake(spark, base)
    assert lake.replace("gold", "t", spark.range(10)) == 10
    assert lake.replace("gold", "t", spark.range(4)) == 4
    assert lake.table("gold", "t").count() == 4 and lake.rows_of("gold", "t") == 4
    assert lake.replace("gold", "t", spark.range(0)) == 0 and lake.table("gold", "t").count() == 0


def test_a_failed_load_leaves_the_old_version(spark, base):
    lake = Lake(spark, base)
    lake.replace("gold", "t", spark.range(3))
    with pytest.raises(Exception):
        lake.replace("gold", "t", spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id")))
    assert lake.table("gold", "t").count() == 3


def test_a_table_can_be_replaced_from_itself(spark, base):
    lake = Lake(spark, base)
    lake.replace("gold", "t", spark.range(3))
    lake.replace("gold", "t", lake.table("gold", "t").withColumn("id", F.col("id") + 1))
    assert sorted(r["id"] for r in lake.table("gold", "t").collect()) == [1, 2, 3]


def test_missing_table_raises(spark, base):
    with pytest.raises(FileNotFoundError):
        Lake(spark, base).table("gold", "none")


def test_bronze_turns_empty_text_into_null(spark, base):
    schema = ", ".join(f"{c} string" for c in BRONZE_COLUMNS)
    df = spark.createDataFrame([tuple("" if c == "produto" else " " for c in BRONZE_COLUMNS)], schema)
    lake = Lake(spark, base)
    lake.load_bronze(df)
    row = lake.table("bronze", "incidentes_raw").first()
    assert row["produto"] is None and row["categoria"] == " " and row["carga_timestamp"] is not None
    with pytest.raises(ValueError):
        lake.load_bronze(df.drop("numero"))


def test_columns_are_only_ever_added(spark, base):
    lake = Lake(spark, base)
    lake.append("gold", "log", spark.createDataFrame([(1,)], "a int"))
    lake.append("gold", "log", spark.createDataFrame([(2, "x")], "a int, b string"))
    assert {tuple(r) for r in lake.log("gold", "log").select("a", "b").collect()} == {(1, None), (2, "x")}
    assert add_columns(spark.range(1), {"id": "long", "x": "double"}).dtypes == [("id", "bigint"), ("x", "double")]


# -- merges ------------------------------------------------------------------------------
def test_a_merge_replaces_its_keys_and_no_others(spark, base):
    lake = Lake(spark, base)
    first = forecasts(spark, (30, "norte", 1, 12, "a"), (30, "sul", 1, 5, "a"), (30, "norte", 7, 80, "a"), (2, "sul", 7, 0.5, "a"))
    assert lake.upsert_forecasts(first) == 4
    # a late day, a value that turns to 0, a new series; the rest stays
    second = forecasts(spark, (30, "norte", 1, 0, "b"), (1, "norte", 1, 11, "b"), (30, "leste", 7, 3, "b"))
    for _ in range(2):
        assert lake.upsert_forecasts(second) == 3
    rows = lake.merged("gold", "previsoes").collect()
    assert sorted((r["data_referencia"].day, r["serie"], r["horizonte"], r["valor_previsto"], r["versao_modelo"]) for r in rows) == [
        (1, "norte", "D+1", 11.0, "b"), (2, "sul", "D+7", 0.5, "a"), (30, "leste", "D+7", 3.0, "b"), (30, "norte", "D+1", 0.0, "b"),
        (30, "norte", "D+7", 80.0, "a"), (30, "sul", "D+1", 5.0, "a")]
    # the target day goes over the end of the month
    assert {(r["data_referencia"].day, r["horizonte"]): r["data_alvo"] for r in rows if r["serie"] == "norte"} == {
        (1, "D+1"): dt.date(2031, 3, 2), (30, "D+1"): dt.date(2031, 3, 31), (30, "D+7"): dt.date(2031, 4, 6)}


def test_an_empty_merge_leaves_no_table(spark, base):
    lake = Lake(spark, base)
    assert lake.upsert_forecasts(forecasts(spark).limit(0)) == 0 and not lake.exists("gold", "previsoes")


def test_a_lost_first_merge_does_not_block_the_next(spark, base):
    lake = Lake(spark, base)
    spark.range(3).write.parquet(f"{lake.path('gold', 'previsoes')}/data/_temporary/0")
    rows = forecasts(spark, (9, "norte", 1, 4, "a"))
    assert lake.upsert_forecasts(rows) == 1 and lake.upsert_forecasts(rows) == 1
    assert lake.merged("gold", "previsoes").count() == 1


def test_a_taken_version_is_refused(spark, base, monkeypatch):
    lake = Lake(spark, base)
    lake.replace("gold", "t", spark.range(3))
    current = lake._current("gold", "t")
    monkeypatch.setattr(lake, "_current", lambda *a: None)
    spark.createDataFrame([(1, "a-first", 1)], "version long, folder string, n_rows long").write.mode("append").json(f"{lake.path('gold', 't')}/commits")
    with pytest.raises(RuntimeError, match="another writer"):
        lake.replace("gold", "t", spark.range(4))
    assert current["version"] == 1


def test_the_same_key_twice_in_one_merge_is_an_error(spark, base):
    with pytest.raises(ValueError):
        Lake(spark, base).upsert_forecasts(forecasts(spark, (9, "norte", 1, 4, "a"), (9, "norte", 1, 5, "a")))


def test_a_key_may_move_to_another_partition(spark, base):
    lake = Lake(spark, base)
    row = lambda day, c: spark.createDataFrame([("INC1", day, "2 - Alta", c, 0.5, "m", "v1")],
        "numero string, data_abertura date, prioridade_real string, prioridade_prevista string, score_vencedor double, modelo_utilizado string, versao_modelo string")
    lake.upsert_ticket_forecasts(row(dt.date(2025, 11, 1), "2 - Alta"))
    lake.upsert_ticket_forecasts(row(dt.date(2025, 12, 1), "4 - Baixa"))
    rows = lake.merged("gold", "previsoes_prioridade").collect()
    assert len(rows) == 1 and rows[0]["prioridade_prevista"] == "4 - Baixa" and rows[0]["data_abertura"].month == 12


def test_a_reader_sees_the_table_before_or_after_a_merge(spark, base, monkeypatch):
    lake = Lake(spark, base)
    values = lambda frame: sorted((r["serie"], r["valor_previsto"]) for r in frame.collect())
    lake.upsert_forecasts(forecasts(spark, (9, "norte", 1, 4, "a"), (9, "sul", 1, 5, "a")))
    opened = lake.merged("gold", "previsoes")
    during = []
    real = Lake._commit
    monkeypatch.setattr(Lake, "_commit", lambda self, *a: during.append(values(self.merged("gold", "previsoes"))) or real(self, *a))
    lake.upsert_forecasts(forecasts(spark, (9, "norte", 1, 40, "b"), (9, "leste", 1, 6, "b")))
    before, after = [("norte", 4.0), ("sul", 5.0)], [("leste", 6.0), ("norte", 40.0), ("sul", 5.0)]
    assert during == [before] and values(opened) == before and values(lake.merged("gold", "previsoes")) == after


def test_a_lost_merge_leaves_no_trace(spark, base, monkeypatch):
    lake = Lake(spark, base)
    rows = lambda day: forecasts(spark, (day, "norte", 1, day, "a"))
    lake.upsert_forecasts(rows(1))
    with monkeypatch.context() as patch:
        patch.setattr(Lake, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.upsert_forecasts(rows(2))
    assert lake.merged("gold", "previsoes").count() == 1
    lake.upsert_forecasts(rows(2))
    lake.upsert_forecasts(rows(3))
    assert lake.merged("gold", "previsoes").count() == 3
    assert len(lake.drop_old("gold", "previsoes", versions=1)) == 3 and lake.drop_old("gold", "previsoes", versions=1) == []
    assert lake.merged("gold", "previsoes").count() == 3 and lake._names(f"{lake.path('gold', 'previsoes')}/staging") == []


def test_only_touched_partitions_are_written(spark, base):
    lake = Lake(spark, base)
    ticket = lambda n, month, c: (f"INC{n}", dt.date(2025, month, 1), "2 - Alta", c, 0.5, "m", "v1")
    frame = lambda *rows: spark.createDataFrame(rows, "numero string, data_abertura date, prioridade_real string, prioridade_prevista string, score_vencedor double, modelo_utilizado string, versao_modelo string")
    lake.upsert_ticket_forecasts(frame(*[ticket(i, 1 + i % 3, "a") for i in range(9)]))
    first = lake._current("gold", "previsoes_prioridade")["parts"]
    lake.upsert_ticket_forecasts(frame(ticket(0, 2, "b")))  # from January to February; March stays
    second = lake._current("gold", "previsoes_prioridade")["parts"]
    assert second["_part=2025-03"] == first["_part=2025-03"] and second["_part=2025-01"] == second["_part=2025-02"] != first["_part=2025-01"]
    rows = lake.merged("gold", "previsoes_prioridade").collect()
    assert len(rows) == 9 and [r["data_abertura"].month for r in rows if r["prioridade_prevista"] == "b"] == [2]


def test_bad_forecasts_break_the_constraints(spark):
    bad = forecasts(spark, (9, "norte", 1, -5, "a"), (9, "norte", 99, 5, "a"))
    with pytest.raises(ValueError) as err:
        checks.require(bad, checks.forecast_rules())
    assert "domain_horizonte" in str(err.value) and "not_negative_valor_previsto" in str(err.value)
    checks.require(forecasts(spark, (9, "norte", 1, 4, "a")), checks.forecast_rules(), ["data_referencia", "serie", "horizonte"])


# -- the whole chain ---------------------------------------------------------------------
def test_load_chain_twice_leaves_forecasts_alone(spark, base, folder):
    lake = Lake(spark, base)
    lake.upsert_forecasts(forecasts(spark, (9, "norte", 1, 4, "a")))
    source = SI.bronze(spark, folder)
    first = etl.run(spark, base, source, STAND_IN_RULES)
    second = etl.run(spark, base, source, STAND_IN_RULES)
    assert first == second and first["bronze"] == source.count() and first["silver"] == 1500
    assert set(GOLD_SCHEMAS) <= set(first)
    assert lake.merged("gold", "previsoes").count() == 1
    silver = lake.table("silver", etl.SILVER)
    checks.require(silver, checks.null_contract(SILVER_SCHEMA), ["numero"])
    checks.gate(checks.kpi_recomputed(silver, lake.table("gold", "kpi_resumo"), STAND_IN_RULES))
    for name, schema in GOLD_SCHEMAS.items():
        assert checks.schema_differences(lake.table("gold", name), schema) == []


def test_daily_sketches_give_any_range(spark, base, folder):
    lake = Lake(spark, base)
    silver = SI.tickets(spark, folder)
    lake.replace("silver", etl.SILVER, silver)
    assert etl.load_sketches(lake) == silver.select("data_abertura").distinct().count()
    daily = lake.table("gold", etl.SKETCHES)
    part = F.col("data_abertura").between("1996-03-01", "1998-02-01")
    row = sketches.over(daily.where(part)).select("n", sketches.values_seen("duracao_segundos").alias("v"), sketches.quantile("duracao_segundos", 0.5).alias("q"),
                                                  sketches.distinct("numero").alias("d")).first()
    values = sorted(r[0] for r in silver.where(part & F.col("duracao_segundos").isNotNull()).select("duracao_segundos").collect())
    below = sum(v <= row["q"] for v in values) / len(values)
    assert row["n"] == silver.where(part).count() and row["v"] == len(values) and abs(below - 0.5) <= sketches.RANK_ERROR
    assert abs(row["d"] - row["n"]) <= sketches.DISTINCT_ERROR * row["n"]
    none = sketches.over(sketches.daily(silver.limit(0), ["data_abertura"], ["duracao_segundos"], ["numero"]))
    assert none.select(sketches.quantile("duracao_segundos", 0.5)).first()[0] is None


def test_the_gate_reads_what_the_loads_observed(spark, base, folder):
    lake = Lake(spark, base)
    source = SI.bronze(spark, folder)
    counts = etl.run(spark, base, source, STAND_IN_RULES)
    assert lake.facts_of("bronze", etl.BRONZE) == {"n": counts["bronze"], "lidas": source.count()}
    assert lake.facts_of("silver", etl.SILVER) == {"n": 1500, "nulos": 0} and lake.facts_of("gold", "incidentes_diario_total")["total"] == 1500
    etl.validate(lake, source)  # the scan agrees
    lake._drop(f"{lake.path('bronze', etl.BRONZE)}/{lake._current('bronze', etl.BRONZE)['folder']}")
    assert [r["ok"] for r in etl.validate(lake)] == [True] * 5
    lake.replace("gold", "incidentes_diario_total", lake.table("gold", "incidentes_diario_total").limit(3), facts={"total": F.sum("total_incidentes")})
    lake.replace("silver", etl.SILVER, lake.table("silver", etl.SILVER))
    with pytest.raises(RuntimeError) as err:
        etl.validate(lake)
    assert "gold_igual_silver" in str(err.value) and "silver_sem_nulos: linhas com nulo obrigatorio: None" in str(err.value) and "bronze_igual" not in str(err.value)


# -- registry ----------------------------------------------------------------------------
@pytest.fixture()
def stored(spark, base):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler

    meta = registry.describe("m", "v1", "regressao", "t", ["a"], {}, {}, {}, {})
    registry.save(spark, base, "f", PipelineModel([VectorAssembler(inputCols=["a"], outputCol="x")]), meta)
    return base, meta


def test_registry_round_trip(spark, stored):
    base, meta = stored
    loaded = registry.load(spark, base, "f")
    assert loaded.metadata == meta and len(loaded.model.stages) == 1
    registry.require_features(meta, ["a"])
    for wrong in ([], ["a", "b"], ["b"]):
        with pytest.raises(ValueError):
            registry.require_features(meta, wrong)


def test_registry_failures_are_named(spark, stored):
    base, meta = stored
    with pytest.raises(FileNotFoundError, match="pointer"):
        registry.load(spark, base, "other")
    registry.promote(spark, base, "f", "v9")
    with pytest.raises(FileNotFoundError, match="metadata"):
        registry.load(spark, base, "f")
    registry.promote(spark, base, "f", "")
    with pytest.raises(ValueError, match="no version"):
        registry.load(spark, base, "f")
    spark.createDataFrame([("{bad",)], "value string").write.mode("overwrite").text(f"{base}/f/current")
    with pytest.raises(ValueError, match="JSON"):
        registry.load(spark, base, "f")
    registry.promote(spark, base, "f", "v1")
    for field in ("features", "metricas_val"):
        less = {k: v for k, v in meta.items() if k != field}
        spark.createDataFrame([(json.dumps(less),)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/f/v1/metadata")
        with pytest.raises(ValueError, match=field):
            registry.load(spark, base, "f")
    registry._write_json(spark, f"{base}/f/v2/metadata", {**meta, "versao": "v2"})
    registry.promote(spark, base, "f", "v2")
    with pytest.raises(FileNotFoundError, match="model"):
        registry.load(spark, base, "f")
