"""Plan properties that matter on large inputs."""

import pytest
from pyspark.sql import functions as F

from ticketry.operators import gold, quantiles, series as TS
from ticketry.plans import panels
from ticketry.schema import STAND_IN_RULES as R
from ticketry.sources import stand_ins as SI
from ticketry.sources.lake import Lake


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("plans"))
    lake = Lake(spark, base)
    lake.replace("silver", "incidentes_tratados", SI.tickets(spark, "/root/testdata/sf0.001"))
    return lake.table("silver", "incidentes_tratados")


def test_population_filters_and_columns_reach_the_scan(silver):
    text = plan(TS.daily_volume(silver, R))
    pushed = text[text.index("PushedFilters"):]
    assert "GreaterThanOrEqual(data_abertura" in pushed and "prioridade" in pushed.split("ReadSchema")[0]
    schema = text[text.index("ReadSchema"):].splitlines()[0]
    assert "prioridade" in schema and "data_abertura" in schema and "numero" not in schema and "descricao_resumida" not in schema


def test_panel_range_is_applied_below_the_aggregate(spark, silver):
    read = lambda name: gold.daily_count(silver) if name == panels.TOTAL else silver
    text = plan(panels.daily_trend(7)(read, "1999-01-01", "1999-12-31"))
    scan = text[text.index("PushedFilters"):]
    assert "GreaterThanOrEqual(data_abertura,1999-01-01)" in scan and "LessThanOrEqual(data_abe" in scan


def test_top_lists_do_not_sort_everything(spark, silver):
    read = lambda name: gold.daily_count(silver, gold.DAILY_TABLES[name])
    assert "TakeOrderedAndProject" in plan(panels.totals_by("incidentes_diario_codigo_fechamento", "codigo_fechamento", 12)(read))


def test_quantiles_count_the_values_once(silver):
    out = quantiles.exact_quantiles(silver, "duracao_segundos", {"p99": 0.99})
    out.collect()
    assert "ReusedExchange" in plan(out)


def test_tickets_join_only_what_they_need(spark, folder):
    assert "customer" not in plan(SI.tickets(spark, folder, "prioridade", "data_abertura"))
    text = plan(SI.tickets(spark, folder, "produto"))
    assert "customer" in text and "nation" not in text


def test_no_row_leaves_the_jvm(spark, folder):
    import __spark_entry__ as entry

    queries = entry.queries()
    for name in ("p23_p26_text_columns", "a01_a04_counts_in_one_scan", "p27_novelty_class", "a36_sliced_metrics"):
        text = plan(queries[name](spark, folder))
        assert "EvalPython" not in text and "CartesianProduct" not in text


def test_partitioned_percentile_has_no_global_window_over_rows(silver):
    text = plan(quantiles.exact_quantiles(silver, "duracao_segundos", {"q": 0.5}, ["data_abertura"]))
    assert "SinglePartition" not in text
