"""The full load: source -> bronze -> silver -> gold -> checks."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketry.operators import checks, gold, sketches
from ticketry.operators.clean import clean
from ticketry.schema import SILVER_COLUMNS, SILVER_SCHEMA, Rules
from ticketry.sources.lake import Lake

BRONZE, SILVER, SKETCHES = "incidentes_raw", "incidentes_tratados", "incidentes_diario_esbocos"


def load_silver(lake: Lake, rules: Rules = Rules()) -> int:
    """Clean the committed bronze rows. A broken row fails the write, which leaves the old version.

    Rows are ordered by day inside each file, so a day range skips most row groups.
    """
    silver = clean(lake.table("bronze", BRONZE), rules).sortWithinPartitions("data_abertura")
    broken = reduce(or_, [F.col(c).isNull() for c in checks.REQUIRED])
    return lake.replace("silver", SILVER, silver, SILVER_COLUMNS, facts={"nulos": F.count_if(broken)})


def load_gold(lake: Lake, rules: Rules = Rules()) -> dict[str, int]:
    """Rebuild the 11 aggregate tables. The forecast tables are not touched.

    One scan of silver feeds all count tables: the grouped counts are written once and the
    tables are cut out of that small result.
    """
    silver = lake.table("silver", SILVER)
    lake.replace("gold", "_contagens", gold.all_counts(silver, rules))
    tables = gold.split_counts(lake.table("gold", "_contagens"))
    tables["kpi_resumo"] = gold.kpi_summary(silver, rules)
    total = F.coalesce(F.sum("total_incidentes"), F.lit(0))
    return lake.replace_all("gold", tables, {name: {"total": total} for name, df in tables.items() if "total_incidentes" in df.columns})


def load_sketches(lake: Lake) -> int:
    """Rebuild the daily sketches of duration and of the two ids beside the gold tables: quantiles and distinct counts of any range."""
    return lake.replace("gold", SKETCHES, sketches.daily(lake.table("silver", SILVER), ["data_abertura"], ["duracao_segundos"], ["numero", "item_configuracao"]))


def validate(lake: Lake, source: DataFrame | None = None) -> list:
    """The gate between layers; raises with every failed check.

    Counts, missing values and sums were observed while the layers were written and are read from
    the commits; only duplicates need a look at silver. With ``source`` every layer is scanned
    instead, which also finds files changed after their load.
    """
    silver = lake.table("silver", SILVER)
    wrong = checks.schema_differences(silver, SILVER_SCHEMA)
    if wrong:
        raise RuntimeError(f"silver differs from its contract: {wrong}")
    if source is not None:
        return checks.gate(checks.layer_checks(
            source, lake.table("bronze", BRONZE), silver, lake.table("gold", "incidentes_diario_total")))
    facts = {layer: lake.facts_of(layer, name) or {} for layer, name in (("bronze", BRONZE), ("silver", SILVER), ("gold", "incidentes_diario_total"))}
    return checks.gate(checks.committed_checks(lake.spark, **facts).unionByName(checks.no_duplicates("silver_sem_duplicatas", silver, ["numero"])))


def run(spark: SparkSession, base: str, source: DataFrame, rules: Rules = Rules()) -> dict[str, int]:
    """All four steps; running it again gives the same tables."""
    lake = Lake(spark, base)
    counts = {"bronze": lake.load_bronze(source)}
    counts["silver"] = load_silver(lake, rules)
    counts.update(load_gold(lake, rules))
    validate(lake)
    return counts


def modelled_volume(silver: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The logical view behind the forecast and its alerts, also registered as a temp view."""
    view = silver.where(
        (F.col("data_abertura") >= F.lit(rules.start).cast("date")) & ~F.col("prioridade").isin(*rules.excluded_priorities)
    ).groupBy("data_abertura").agg(F.count(F.lit(1)).alias("volume_total"))
    view.createOrReplaceTempView("ml_volume_diario")
    return view
