"""Versioned models: a Spark model folder, its metadata, and a pointer to the version in force.

Everything is written through Spark, so the store can be on any file system the cluster shares.
"""

from __future__ import annotations

import json
import platform
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql.utils import AnalysisException

REQUIRED_FIELDS = (
    "modelo", "versao", "tipo", "target", "features", "hiperparametros", "periodo_treino",
    "metricas_val", "metricas_test", "spark_version", "python_version", "treinado_em",
)


@dataclass(frozen=True)
class LoadedModel:
    model: object
    metadata: dict
    path: str


def _write_json(spark: SparkSession, path: str, content: dict) -> None:
    text = json.dumps(content, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_json(spark: SparkSession, path: str, what: str) -> dict:
    try:
        lines = spark.read.option("wholetext", True).text(path).limit(2).collect()
    except AnalysisException as err:
        raise FileNotFoundError(f"{what} not found at {path}") from err
    if not lines:
        raise FileNotFoundError(f"{what} is empty at {path}")
    try:
        return json.loads(lines[0][0])
    except json.JSONDecodeError as err:
        raise ValueError(f"{what} at {path} is no valid JSON: {err}") from err


def describe(name: str, version: str, kind: str, target: str, features: list[str], params: dict, period: dict,
             val: dict, test: dict, note: str = "") -> dict:
    return {
        "modelo": name, "versao": version, "tipo": kind, "target": target, "features": features,
        "hiperparametros": params, "periodo_treino": period, "metricas_val": val, "metricas_test": test,
        "spark_version": pyspark.__version__, "python_version": platform.python_version(),
        "treinado_em": datetime.now().isoformat(timespec="seconds"), "nota": note,
    }


def save(spark: SparkSession, base: str, family: str, model, metadata: dict) -> str:
    """Save a version and put it in force. The pointer is written last. A model is a pipeline or has ``write_to(spark, folder)``."""
    folder = f"{base}/{family}/{metadata['versao']}"
    if hasattr(model, "write_to"):
        model.write_to(spark, f"{folder}/model")
    else:
        model.write().overwrite().save(f"{folder}/model")
    _write_json(spark, f"{folder}/metadata", metadata)
    promote(spark, base, family, metadata["versao"])
    return folder


def promote(spark: SparkSession, base: str, family: str, version: str) -> None:
    _write_json(spark, f"{base}/{family}/current", {"version": version})


def load(spark: SparkSession, base: str, family: str, reader: Callable[[SparkSession, str], object] | None = None) -> LoadedModel:
    """Pointer -> version -> metadata -> required fields -> model; every missing link is an error. Without ``reader`` it is a pipeline."""
    current = _read_json(spark, f"{base}/{family}/current", f"pointer of model {family}")
    version = current.get("version")
    if not version:
        raise ValueError(f"pointer of model {family} names no version")
    folder = f"{base}/{family}/{version}"
    metadata = _read_json(spark, f"{folder}/metadata", f"metadata of {family} {version}")
    missing = [f for f in REQUIRED_FIELDS if f not in metadata]
    if missing:
        raise ValueError(f"metadata of {family} {version} lacks {missing}")
    try:
        spark.read.text(f"{folder}/model/metadata").limit(1).collect()
    except AnalysisException as err:
        raise FileNotFoundError(f"no model under {folder}") from err
    model = reader(spark, f"{folder}/model") if reader else PipelineModel.load(f"{folder}/model")
    return LoadedModel(model, metadata, f"{folder}/model")


def require_features(metadata: dict, produced: list[str]) -> None:
    """The produced columns must be exactly those the model was trained on."""
    wanted, have = set(metadata["features"]), set(produced)
    if wanted != have:
        raise ValueError(f"features differ from the model: missing {sorted(wanted - have)}, extra {sorted(have - wanted)}")
