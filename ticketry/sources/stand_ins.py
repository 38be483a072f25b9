"""Ticket-shaped frames over the orders / customer / nation / events / documents tables.

Each column is one SQL expression that Spark and the comparison engine read alike, so the
comparison SQL starts from the very same rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketry.schema import BRONZE_COLUMNS, INGEST_SEQ, SILVER_COLUMNS

_PRIORITY = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN '1 - Crítica' WHEN '2-HIGH' THEN '2 - Alta' "
    "WHEN '3-MEDIUM' THEN '3 - Média' WHEN '4-NOT SPECIFIED' THEN '4 - Baixa' ELSE '5 - Muito Baixa' END"
)
_OPENED = (
    "(o_orderdate + INTERVAL '1' HOUR * cast(o_custkey % 24 as int) "
    "+ INTERVAL '1' MINUTE * cast(o_orderkey % 60 as int))"
)
_CLOSED = f"({_OPENED} + INTERVAL '1' DAY * cast(o_orderkey % 10 as int))"
_SECONDS = "cast(floor(o_totalprice) as bigint)"
_ITEM = "('IC' || lpad(cast(o_custkey % 400 as string), 5, '0'))"
_KIND = (
    "(CASE WHEN o_orderkey % 7 < 4 THEN cast(substring(o_orderpriority, 1, 1) as int) "
    "ELSE cast(o_orderkey % 5 as int) + 1 END)"
)
_TEXT = (
    f"CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CASE {_KIND} "
    f"WHEN 1 THEN 'Problem: Disk I/O is overloaded on ' || {_ITEM} "
    "WHEN 2 THEN 'Alert: host srv' || cast(o_custkey % 9 as string) || '.example.com unreachable' "
    "WHEN 3 THEN 'Request: password reset for user' || cast(o_custkey % 30 as string) || '@corp.example.org' "
    f"WHEN 4 THEN 'Job ' || cast(o_orderkey % 50 as string) || ' failed: free disk i/o low on ' || {_ITEM} "
    "ELSE 'Batch' || cast(o_custkey % 60 as string) || ': usuário sem acesso há ' "
    "|| cast(o_orderkey % 8 as string) || ' dias' END END"
)
_PRODUCT = "CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN NULL ELSE c_mktsegment END"
_CATEGORY = "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE n_name END"
_SUBCATEGORY = "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE c_mktsegment || '/' || n_name END"
_CLOSING = (
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN '  ' "
    "ELSE 'C' || lpad(cast(o_orderkey % 17 as string), 2, '0') END"
)
_GROUP = "'Team' || lpad(cast(o_custkey % 17 + 1 as string), 2, '0')"
_CHANNEL = "CASE WHEN o_custkey % 2 = 0 THEN 'Monitoramento' ELSE 'Manual' END"

# The raw extract: all text, with the defects the cleaning rules are about.
BRONZE_SQL = {
    "numero": "cast(o_orderkey as string)",
    "prioridade": _PRIORITY,
    "produto": _PRODUCT,
    "categoria": _CATEGORY,
    "subcategoria": _SUBCATEGORY,
    "grupo_designado": _GROUP,
    "item_configuracao": f"CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {_ITEM} END",
    "aberto": f"cast({_OPENED} as string)",
    "resolvido": f"CASE WHEN o_orderkey % 97 = 0 THEN 'n/d' WHEN o_orderstatus = 'P' THEN NULL ELSE cast({_CLOSED} as string) END",
    "encerrado": f"cast({_CLOSED} as string)",
    "duracao_segundos": f"cast({_SECONDS} as string)",
    "codigo_fechamento": _CLOSING,
    "descricao_resumida": _TEXT,
    "solucao": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'closed by rule ' || cast(o_orderkey % 12 as string) END",
    "aberto_por": _CHANNEL,
    "incidente_pai": "CASE WHEN o_orderkey % 9 = 0 THEN cast(o_orderkey - o_orderkey % 90 as string) ELSE NULL END",
    "status": "o_orderstatus",
    "entrou_kpi": "CASE WHEN o_orderstatus = 'O' THEN ' nao' WHEN o_orderkey % 5 = 0 THEN 'sim ' ELSE 'SIM' END",
    "kpi_violado": "CASE WHEN o_orderkey % 101 = 0 THEN 'NÃO' WHEN o_orderstatus = 'F' THEN 'SIM' WHEN o_orderstatus = 'P' THEN 'NAO' ELSE NULL END",
}

# The same tickets as typed rows (what a clean delivery turns into).
TICKET_SQL = {
    "numero": "cast(o_orderkey as string)",
    "prioridade": _PRIORITY,
    "produto": f"coalesce(nullif({_PRODUCT}, ''), 'Não informado')",
    "categoria": f"coalesce({_CATEGORY}, 'Não informado')",
    "subcategoria": f"coalesce(nullif({_SUBCATEGORY}, ''), 'Não informado')",
    "grupo_designado": _GROUP,
    "item_configuracao": BRONZE_SQL["item_configuracao"],
    "descricao_resumida": _TEXT,
    "codigo_fechamento": f"coalesce({_CLOSING}, 'Não informado')",
    "aberto": _OPENED,
    "resolvido": f"CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {_CLOSED} END",
    "foi_resolvido": "o_orderstatus <> 'P'",
    "encerrado": _CLOSED,
    "duracao_segundos": _SECONDS,
    "duracao_valida": f"{_SECONDS} <= cast(o_orderkey % 10 as double) * 86400.0e0 * 1.05e0",
    "duracao_dias": f"{_SECONDS} / 86400.0e0",
    "aberto_por": _CHANNEL,
    "status": "o_orderstatus",
    "entrou_kpi": "o_orderstatus <> 'O'",
    "kpi_violado": "CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false ELSE NULL END",
    "data_abertura": "cast(o_orderdate as date)",
    "ano": "cast(extract(year from o_orderdate) as int)",
    "mes": "cast(extract(month from o_orderdate) as int)",
    # not part of the silver contract, but needed by some reports
    "incidente_pai": BRONZE_SQL["incidente_pai"],
}

_NEEDS_CUSTOMER = ("c_", "n_")


def _orders_side(spark: SparkSession, folder: str, exprs: Iterable[str]) -> DataFrame:
    """Orders, joined only with the sides the expressions name.

    Nation is a fixed list of 25 countries and is broadcast. Customer grows with the data:
    no hint, so the join is sized at run time and a hot customer is split by adaptive
    skew handling.
    """
    exprs = list(exprs)
    df = spark.read.parquet(f"{folder}/orders.parquet")
    if any(p in e for e in exprs for p in _NEEDS_CUSTOMER):
        customer = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_nationkey", "c_mktsegment")
        df = df.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    if any("n_name" in e for e in exprs):
        nation = spark.read.parquet(f"{folder}/nation.parquet").select("n_nationkey", "n_name")
        df = df.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return df


def tickets(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Typed tickets with the named columns; a side table is joined only when one needs it."""
    wanted = columns or [c for c in SILVER_COLUMNS if c in TICKET_SQL or c == "dia_semana"]
    plain = [c for c in wanted if c != "dia_semana"]
    df = _orders_side(spark, folder, [TICKET_SQL[c] for c in plain])
    out = [F.expr(TICKET_SQL[c]).alias(c) for c in plain]
    if "dia_semana" in wanted:
        out.append(F.weekday("o_orderdate").alias("dia_semana"))
    return df.select(*out)


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    """The raw extract plus a second delivery of every 50th ticket with another solution text.

    The ingest sequence puts the second delivery after the first.
    """
    df = _orders_side(spark, folder, BRONZE_SQL.values())
    cols = [F.expr(BRONZE_SQL[c]).alias(c) for c in BRONZE_COLUMNS]
    first = df.select(*cols, F.col("o_orderkey").alias(INGEST_SEQ))
    again = (
        df.where("o_orderkey % 50 = 0")
        .select(*cols, (F.col("o_orderkey") + F.lit(2**40)).alias(INGEST_SEQ))
        .withColumn("descricao_resumida", F.lit("second delivery"))
        .withColumn("duracao_segundos", F.lit("999999"))
    )
    return first.unionByName(again)


def signals(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream as a second, dense daily series."""
    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("event_id").cast("string").alias("numero"),
        F.col("event_type").alias("tipo"),
        F.col("ts").alias("aberto"),
        F.col("ts").cast("date").alias("data_abertura"),
        F.expr("cast(floor(value * 100) as bigint)").alias("duracao_segundos"),
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a split by id."""
    return spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars",
        F.expr("CASE WHEN doc_id % 10 < 6 THEN 'TRAIN' WHEN doc_id % 10 < 8 THEN 'VAL' ELSE 'TEST' END").alias("split"),
    )


# --- the same frames as comparison SQL ---------------------------------------------------
_FROM = "FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"


def tickets_cte(name: str = "tickets") -> str:
    cols = ", ".join(f"{e} AS {c}" for c, e in TICKET_SQL.items())
    return f"{name} AS (SELECT {cols}, cast(extract(isodow from o_orderdate) - 1 as int) AS dia_semana {_FROM})"


def bronze_cte(name: str = "bronze") -> str:
    cols = ", ".join(f"{e} AS {c}" for c, e in BRONZE_SQL.items())
    again = ", ".join(
        {"descricao_resumida": "'second delivery'", "duracao_segundos": "'999999'"}.get(c, e) + f" AS {c}"
        for c, e in BRONZE_SQL.items()
    )
    return (
        f"{name} AS (SELECT {cols}, o_orderkey AS {INGEST_SEQ} {_FROM} UNION ALL "
        f"SELECT {again}, o_orderkey + {2**40} AS {INGEST_SEQ} {_FROM} WHERE o_orderkey % 50 = 0)"
    )


SIGNALS_CTE = (
    "signals AS (SELECT cast(event_id as string) AS numero, event_type AS tipo, ts AS aberto, "
    "cast(ts as date) AS data_abertura, cast(floor(value * 100) as bigint) AS duracao_segundos FROM events)"
)
TEXTS_CTE = (
    "texts AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, "
    "CASE WHEN d.doc_id % 10 < 6 THEN 'TRAIN' WHEN d.doc_id % 10 < 8 THEN 'VAL' ELSE 'TEST' END AS split "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)
