"""Layered Parquet tables: full loads and keyed merges that switch over in one step, appends.

A load writes new files and then adds one line to the table's commit list; readers take the newest
committed version. A job that dies half way leaves the old version in force. The line of a full
load names a folder, that of a merge says which folder holds each partition, and both carry what
was counted while the rows were written. Appended tables live in one folder of their own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketry.schema import BRONZE_COLUMNS, HORIZON_DAYS, INGEST_SEQ
from ticketry.sources.raw import require_columns

class Lake:
    """Tables under ``base/<layer>/<name>``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"

    # -- full loads --------------------------------------------------------------------
    def _file_system(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _there(self, path: str) -> bool:
        """Whether a path exists on whatever file system it names."""
        files, where = self._file_system(path)
        return files.exists(where)

    def _drop(self, folder: str) -> None:
        files, where = self._file_system(folder)
        files.delete(where, True)

    def _names(self, folder: str) -> list[str]:
        files, where = self._file_system(folder)
        return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []

    def _commits(self, layer: str, name: str) -> list[dict]:
        """All commit lines. They are small files of a line or two, read without a job."""
        folder, lines = f"{self.path(layer, name)}/commits", []
        for file in self._names(folder):
            if file.endswith(".json"):
                files, where = self._file_system(f"{folder}/{file}")
                stream = files.open(where)
                try:
                    lines += self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
                finally:
                    stream.close()
        return [json.loads(line) for line in lines if line.strip()]

    def _commit(self, layer: str, name: str, commit: dict) -> None:
        """Add one line: written under a hidden name and renamed, so that no reader sees half of it."""
        folder = f"{self.path(layer, name)}/commits"
        hidden, shown = f"{folder}/.{commit['folder']}", f"{folder}/{commit['folder']}.json"
        files, where = self._file_system(hidden)
        stream = files.create(where, True)
        try:
            stream.write(bytearray(json.dumps(commit, ensure_ascii=False).encode()))
        finally:
            stream.close()
        files.rename(where, self._file_system(shown)[1])
        held = min(c["folder"] for c in self._commits(layer, name) if c["version"] == commit["version"])
        if held != commit["folder"]:
            raise RuntimeError(f"another writer has committed version {commit['version']} of {layer}.{name}")

    def _current(self, layer: str, name: str) -> dict | None:
        """The newest commit; of several of one version the one with the smallest folder name stands."""
        commits = self._commits(layer, name)
        return max(commits, key=lambda c: (c["version"], [-ord(x) for x in c["folder"]])) if commits else None

    def _next(self, layer: str, name: str, current: dict | None) -> tuple[int, str]:
        version = (current["version"] if current else 0) + 1
        return version, f"v{version:06d}-{uuid.uuid4().hex[:8]}"

    def replace(self, layer: str, name: str, df: DataFrame, columns: list[str] | None = None,
                partition_by: list[str] | None = None, facts: Mapping[str, Column] | None = None, read: Observation | None = None) -> int:
        """Full load. Running it again gives the same content. Returns the rows written.

        The count and the aggregates ``facts`` are observed on the write itself and go into the
        commit; so does the count ``n`` that ``read`` observes further up, as ``lidas``. An empty frame leaves an empty table. There is one writer at a time; if two commit
        the same version, the one with the smaller folder name stands and the other raises.
        """
        if columns:
            require_columns(df, columns)
            df = df.select(*columns)
        version, folder = self._next(layer, name, self._current(layer, name))
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in (facts or {}).items()]).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path(layer, name)}/{folder}")
        found = {k: int(v or 0) for k, v in seen.get.items()}
        n = found.pop("n", 0)
        if read is not None:
            found["lidas"] = int(read.get.get("n") or 0)
        self._commit(layer, name, {"version": version, "folder": folder, "n_rows": n, "facts": found})
        return n

    def table(self, layer: str, name: str) -> DataFrame:
        """The newest committed version of a full-load table, lazily."""
        current = self._current(layer, name)
        if current is None:
            raise FileNotFoundError(f"no committed version of {layer}.{name} under {self.base}")
        return self.spark.read.option("mergeSchema", False).parquet(f"{self.path(layer, name)}/{current['folder']}")

    def rows_of(self, layer: str, name: str) -> int:
        """Row count as recorded by the load, without a scan."""
        current = self._current(layer, name)
        return int(current["n_rows"]) if current else 0

    def facts_of(self, layer: str, name: str) -> dict[str, int] | None:
        """Rows (n) and the aggregates that the load observed, without a scan; None where nothing is committed."""
        current = self._current(layer, name)
        return {"n": int(current["n_rows"]), **(current.get("facts") or {})} if current else None

    def load_bronze(self, df: DataFrame, name: str = "incidentes_raw") -> int:
        """Raw rows as they are: '' becomes NULL and the load time is added. The rows read are counted beside those written."""
        require_columns(df, BRONZE_COLUMNS)
        extra = [INGEST_SEQ] if INGEST_SEQ in df.columns else []
        read = Observation()
        out = df.observe(read, F.count(F.lit(1)).alias("n")).select(
            *[F.nullif(F.col(c), F.lit("")).alias(c) for c in BRONZE_COLUMNS],
            F.current_timestamp().cast("timestamp_ntz").alias("carga_timestamp"),
            *extra,
        )
        return self.replace("bronze", name, out, read=read)

    def replace_all(self, layer: str, frames: dict[str, DataFrame], facts: Mapping[str, Mapping[str, Column]] | None = None) -> dict[str, int]:
        """Several full loads; the jobs are independent and share the cluster, a few at a time."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            loads = {name: pool.submit(self.replace, layer, name, df, facts=(facts or {}).get(name)) for name, df in frames.items()}
            return {name: load.result() for name, load in loads.items()}

    # -- append-only tables ------------------------------------------------------------
    def append(self, layer: str, name: str, df: DataFrame) -> int:
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(f"{self.path(layer, name)}/data")
        return int(seen.get.get("n") or 0)

    def log(self, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame:
        """An appended table. Columns added by later writes read as NULL before."""
        return self._read([f"{self.path(layer, name)}/data"], schema)

    def _read(self, paths: list[str], schema: T.StructType | None) -> DataFrame:
        reader = self.spark.read.option("mergeSchema", schema is None)
        return (reader.schema(schema) if schema is not None else reader).parquet(*paths)

    def exists(self, layer: str, name: str) -> bool:
        """Whether a write into the table has been committed; a folder that a lost write left does not count."""
        return self._current(layer, name) is not None or self._there(f"{self.path(layer, name)}/data/_SUCCESS")

    # -- keyed merge -------------------------------------------------------------------
    def merge(self, layer: str, name: str, updates: DataFrame, keys: list[str], partition: Column) -> int:
        """Insert new keys, overwrite known ones, never drop another key. Returns the rows of ``updates``.

        The table is partitioned by ``partition`` (a month, say). Only the partitions that hold a
        changed key are written anew: those the updates fall into and those that held the same key
        before. They go to a new folder; one commit line then says which folder holds each partition.
        A reader sees the table before or after the merge, a lost merge leaves no trace, and files
        in force are never touched. Duplicate keys inside the updates are an error, as in a single
        upsert statement; no updates leave the table as it is.
        """
        base, part, seen = self.path(layer, name), "_part", Observation()
        current = self._current(layer, name)
        version, folder = self._next(layer, name, current)
        staging = f"{base}/staging/{folder}"
        updates = updates.withColumn(part, partition.cast("string"))
        updates.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(staging)
        n = int(seen.get.get("n") or 0)
        try:
            if n == 0:
                return 0
            updates = self.spark.read.schema(updates.schema).parquet(staging)
            if not updates.groupBy(*keys).count().where("count > 1").isEmpty():
                raise ValueError(f"the same key appears twice in one merge into {layer}.{name}")
            held, merged, touched = dict(current["parts"]) if current else {}, updates, set()
            if held:
                old = self._read(self._folders(base, held), None).withColumn(part, partition.cast("string"))
                moved = old.join(updates.select(*keys), keys, "left_semi").select(part)
                # as many values as there are partitions at most, and these are in the commit anyway
                touched = {r[part] for r in updates.select(part).unionByName(moved).distinct().collect()}
                kept = {p: f for p, f in held.items() if _value(p) in touched}
                if kept:
                    old = self._read(self._folders(base, kept), None).withColumn(part, partition.cast("string"))
                    merged = old.join(updates.select(*keys), keys, "left_anti").unionByName(updates, allowMissingColumns=True)
            # rebalancing gathers each partition into few files and splits one that is too large
            merged.hint("rebalance", part).write.partitionBy(part).parquet(f"{base}/{folder}")
            written = [p for p in self._names(f"{base}/{folder}") if p.startswith(f"{part}=")]
            parts = {p: f for p, f in held.items() if _value(p) not in touched} | dict.fromkeys(written, folder)
            self._commit(layer, name, {"version": version, "folder": folder, "n_rows": n, "parts": parts})
            return n
        finally:
            self._drop(staging)

    def _folders(self, base: str, parts: Mapping[str, str]) -> list[str]:
        return [f"{base}/{folder}/{p}" for p, folder in sorted(parts.items())]

    def merged(self, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The newest committed state of a merged table, lazily. Columns added by later merges read as NULL before."""
        current = self._current(layer, name)
        if current is None:
            raise FileNotFoundError(f"no committed merge into {layer}.{name} under {self.base}")
        return self._read(self._folders(self.path(layer, name), current["parts"]), schema)

    def drop_old(self, layer: str, name: str, versions: int = 2) -> list[str]:
        """Delete the folders that none of the newest ``versions`` commits names. Returns them.

        For a time without writers: the folder of a load that has not committed yet is named by none.
        """
        commits = sorted(self._commits(layer, name), key=lambda c: c["version"])[-versions:]
        named = {c["folder"] for c in commits} | {f for c in commits for f in (c.get("parts") or {}).values()}
        base = self.path(layer, name)
        old = sorted(f for f in self._names(base) if f.startswith("v") and f not in named) if commits else []
        for folder in old:
            self._drop(f"{base}/{folder}")
        return old

    def upsert_forecasts(self, forecasts: DataFrame, name: str = "previsoes") -> int:
        """One row per (data_referencia, serie, horizonte); the target day is derived here."""
        out = forecasts.select(
            "data_referencia", "serie", "horizonte", F.col("valor_previsto").cast("double").alias("valor_previsto"),
            "modelo_utilizado", "versao_modelo",
            F.current_timestamp().cast("timestamp_ntz").alias("gerado_em"),
            target_day("data_referencia", "horizonte").alias("data_alvo"),
        )
        return self.merge("gold", name, out, ["data_referencia", "serie", "horizonte"],
                          F.date_format("data_referencia", "yyyy"))

    def upsert_ticket_forecasts(self, forecasts: DataFrame, name: str = "previsoes_prioridade") -> int:
        out = forecasts.select(
            "numero", "data_abertura", "prioridade_real", "prioridade_prevista",
            F.col("score_vencedor").cast("double").alias("score_vencedor"), "modelo_utilizado", "versao_modelo",
            F.current_timestamp().cast("timestamp_ntz").alias("gerado_em"),
        )
        return self.merge("gold", name, out, ["numero"], F.date_format("data_abertura", "yyyy-MM"))


def _value(partition: str) -> str | None:
    """The value that a partition's folder stands for."""
    value = unquote(partition.partition("=")[2])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


def target_day(reference: str | Column, horizon: str | Column) -> Column:
    """``reference`` plus the days of the horizon; an unknown horizon gives NULL."""
    reference = F.col(reference) if isinstance(reference, str) else reference
    horizon = F.col(horizon) if isinstance(horizon, str) else horizon
    days = None
    for label, n in HORIZON_DAYS.items():
        days = F.when(horizon == label, F.lit(n)) if days is None else days.when(horizon == label, F.lit(n))
    return F.date_add(reference, days)


def merge_frames(current: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """The merge as a plain DataFrame: updates win, other keys stay."""
    return current.join(updates.select(*keys), keys, "left_anti").unionByName(updates, allowMissingColumns=True)


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the columns that are not there yet, as typed NULLs."""
    for name, sql_type in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(sql_type))
    return df
