"""The two daily forecast jobs, from the loaded tables to the forecast tables and the threshold log."""

from __future__ import annotations

from ticketry.operators import alerts, novelty, series as TS
from ticketry.plans import etl, registry, tickets_ml as ML, volume as V
from ticketry.schema import FORECAST_SCHEMA, THRESHOLD_SCHEMA, TICKET_FORECAST_SCHEMA, Rules
from ticketry.sources.lake import Lake

FORECASTS, TICKET_FORECASTS, THRESHOLDS = "previsoes", "previsoes_prioridade", "alertas_thresholds"


def volume_series(lake: Lake, rules: Rules = Rules(), fill: int | None = None):
    """The modelled daily series of the loaded tickets. A day without tickets is an error unless ``fill`` is given."""
    return TS.dense(TS.daily_volume(lake.table("silver", etl.SILVER), rules), fill)


def forecast_volume(lake: Lake, models: str, rules: Rules = Rules(), fill: int | None = None) -> int:
    """Score with the model in force, upsert the rows, then append both thresholds. Returns the rows.

    A run without any row fails before thresholds are written. Running it again changes no
    forecast and adds one more row per rule to the log, whose newest row counts.
    """
    loaded = registry.load(lake.spark, models, V.FAMILY)
    series = volume_series(lake, rules, fill)
    produced = TS.volume_features(series, rules).columns
    registry.require_features(loaded.metadata, [c for c in produced if c not in (TS.KEY, TS.DAY)])
    made = V.forecast(series, loaded.model, rules, loaded.metadata["modelo"], loaded.metadata["versao"])
    n = lake.upsert_forecasts(made.rows, FORECASTS)
    alerts.require_predictions(n, "volume forecasts")
    lake.append("gold", THRESHOLDS, alerts.volume_threshold(series, rules).unionByName(alerts.error_threshold(made.metrics)))
    return n


def forecast_tickets(lake: Lake, models: str, rules: Rules = Rules()) -> int:
    """Score the tickets that the model in force has not learned from and upsert them. Returns the rows."""
    silver = lake.table("silver", etl.SILVER)
    rows, _ = ML.predict_unseen(silver, ML.load(lake.spark, models), rules)
    learned = ML.with_split(ML.population(silver, rules), rules).where("split = 'TRAIN'")
    novelty.require_disjoint(learned, rows, ["numero"])
    n = lake.upsert_ticket_forecasts(rows, TICKET_FORECASTS)
    alerts.require_predictions(n, "ticket forecasts")
    return n


def forecasts(lake: Lake):
    return lake.merged("gold", FORECASTS, FORECAST_SCHEMA)


def ticket_forecasts(lake: Lake):
    return lake.merged("gold", TICKET_FORECASTS, TICKET_FORECAST_SCHEMA)


def thresholds(lake: Lake):
    return lake.log("gold", THRESHOLDS, THRESHOLD_SCHEMA)
