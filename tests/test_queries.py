"""Every registered query with comparison SQL gives the rows that SQL gives."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from tests.conftest import FOLDER

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# These train many models or write the whole lake; ``python -m tests.compare`` runs them.
SLOW = {"m12_text_experiment_rows", "m12_text_experiment_optimality", "m17_suggestion_shape", "v14_ticket_forecast_checks", "v11_model_forecast_checks", "s06_load_chain_row_counts", "a11_loaded_kpi_summary"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n not in SLOW))
def test_same_rows(spark, duck, name):
    ok, _, note = compare(spark, duck, FOLDER, QUERIES[name], ORACLES[name])
    assert ok, note


def test_every_panel_is_registered():
    from ticketry.plans.panels import PANELS

    assert sorted(PANELS) == list(range(1, 44))
    assert all(any(q.startswith(f"q{n:02d}_") for q in ORACLES) for n in PANELS)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows_and_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "data_abertura" and df.count() > 0
