"""Column contracts and the business constants every job takes as a parameter."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# --- fixed values: source header -> canonical column -------------------------------------
SOURCE_COLUMNS = {
    "Número": "numero",
    "Prioridade": "prioridade",
    "Produto": "produto",
    "Categoria": "categoria",
    "Subcategoria": "subcategoria",
    "Grupo designado": "grupo_designado",
    "Item de configuração": "item_configuracao",
    "Aberto": "aberto",
    "Resolvido": "resolvido",
    "Encerrado": "encerrado",
    "Duração": "duracao_segundos",
    "Código de fechamento": "codigo_fechamento",
    "Descrição resumida": "descricao_resumida",
    "Solução": "solucao",
    "Aberto por": "aberto_por",
    "Incidente Pai": "incidente_pai",
    "Status": "status",
    "Entrou para KPI?": "entrou_kpi",
    "KPI Violado?": "kpi_violado",
}

BRONZE_COLUMNS = list(SOURCE_COLUMNS.values())
INGEST_SEQ = "_ingest_seq"

_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_TS, _DAY = T.TimestampNTZType(), T.DateType()


def _struct(*fields) -> T.StructType:
    """Fields as (name, type) or (name, type, nullable); not nullable unless stated."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else False) for f in fields])


SILVER_SCHEMA = _struct(
    ("numero", _S), ("prioridade", _S), ("produto", _S), ("categoria", _S), ("subcategoria", _S),
    ("grupo_designado", _S), ("item_configuracao", _S, True), ("descricao_resumida", _S, True),
    ("codigo_fechamento", _S), ("aberto", _TS), ("resolvido", _TS, True), ("foi_resolvido", _B),
    ("encerrado", _TS), ("duracao_segundos", _L), ("duracao_valida", _B), ("duracao_dias", _D),
    ("duracao_outlier_flag", _B), ("aberto_por", _S), ("status", _S), ("entrou_kpi", _B),
    ("kpi_violado", _B, True), ("data_abertura", _DAY), ("ano", _I), ("mes", _I), ("dia_semana", _I),
)
SILVER_COLUMNS = SILVER_SCHEMA.fieldNames()


def _daily(dimension: str) -> T.StructType:
    return _struct(("data_abertura", _DAY), (dimension, _S), ("total_incidentes", _L))


GOLD_SCHEMAS = {
    "incidentes_diario_total": _struct(("data_abertura", _DAY), ("total_incidentes", _L)),
    "incidentes_diario_prioridade": _daily("prioridade"),
    "incidentes_diario_grupo": _daily("grupo_categoria"),
    "incidentes_diario_grupo_full": _daily("grupo_designado"),
    "incidentes_diario_aberto_por": _daily("aberto_por"),
    "incidentes_diario_status": _daily("status"),
    "incidentes_diario_categoria": _daily("categoria"),
    "incidentes_diario_codigo_fechamento": _daily("codigo_fechamento"),
    "incidentes_diario_kpi": _struct(
        ("data_abertura", _DAY), ("entrou_kpi", _B), ("kpi_violado", _B, True), ("total_incidentes", _L)),
    "incidentes_horario": _struct(("hora", _I), ("dia_semana", _I), ("total_incidentes", _L)),
    "kpi_resumo": _struct(
        ("data_abertura", _DAY), ("duracao_media_segundos", _D, True),
        ("duracao_mediana_segundos", _D, True), ("duracao_media_aparada_p99_segundos", _D, True),
        ("taxa_resolucao", _D, True), ("taxa_kpi_violado", _D, True)),
}

FORECAST_SCHEMA = _struct(
    ("data_referencia", _DAY), ("serie", _S), ("horizonte", _S), ("valor_previsto", _D, True),
    ("modelo_utilizado", _S), ("versao_modelo", _S), ("gerado_em", _TS, True), ("data_alvo", _DAY, True),
)
TICKET_FORECAST_SCHEMA = _struct(
    ("numero", _S), ("data_abertura", _DAY), ("prioridade_real", _S, True), ("prioridade_prevista", _S),
    ("score_vencedor", _D, True), ("modelo_utilizado", _S), ("versao_modelo", _S), ("gerado_em", _TS, True),
)
THRESHOLD_SCHEMA = _struct(
    ("calculado_em", _TS), ("regra", _S), ("threshold", _D), ("media", _D, True), ("desvio", _D, True),
    ("p90", _D, True), ("p95", _D, True), ("p99", _D, True), ("qtd_dias_historico", _L, True),
    ("qtd_dias_acima_historico", _L, True), ("pct_dias_acima_historico", _D, True),
    ("regime_data_corte", _DAY, True), ("detalhe", _S, True),
)

HORIZON_DAYS = {"D+1": 1, "D+7": 7}
RULE_VOLUME = "volume_acima_do_normal"
RULE_ERROR_D7 = "erro_d7_acima_do_esperado"


@dataclass(frozen=True)
class Rules:
    """Business constants. Defaults are the values used on the real ticket extract."""

    default_label: str = "Não informado"
    default_label_columns: tuple[str, ...] = ("produto", "categoria", "subcategoria", "codigo_fechamento")
    unknown_product: str = "Desconhecido"
    duration_tolerance: float = 1.05
    outlier_quantile: float = 0.99
    special_group: str = "Team14"
    other_groups: str = "Outros"
    start: str = "2025-01-01"
    excluded_priorities: tuple[str, ...] = ("1 - Crítica", "5 - Muito Baixa")
    lags: tuple[int, ...] = (1, 2, 3, 7, 14, 21, 28)
    regime_cut: str = "2025-09-01"
    train_end: str = "2025-11-01"
    val_end: str = "2025-12-01"
    family_train_end: str = "2025-09-01"
    family_val_end: str = "2025-10-01"
    priority_classes: tuple[str, ...] = ("2 - Alta", "3 - Média", "4 - Baixa")
    priority_from: str = "2025-09-01"
    priority_until: str = "2026-01-01"
    priority_train_months: tuple[str, ...] = ("2025-09", "2025-10")
    priority_val_months: tuple[str, ...] = ("2025-11",)
    priority_test_months: tuple[str, ...] = ("2025-12",)
    ridge_alpha: float = 0.001
    svc_c: float = 2.0
    max_ngram: int = 2
    min_df: int = 1
    max_features: int = 20000

    @property
    def lag_columns(self) -> list[str]:
        return [f"lag_{k}" for k in self.lags]

    @property
    def d7_features(self) -> list[str]:
        return [*self.lag_columns, "periodo_pos_set_2025"]

    def but(self, **changes) -> "Rules":
        return replace(self, **changes)


# Cut-offs that fit the date range of the stand-in tickets (1995-01-01 to 2001-08-01).
STAND_IN_RULES = Rules(
    start="1996-01-01",
    regime_cut="1999-01-01",
    train_end="2000-07-01",
    val_end="2001-01-01",
    family_train_end="1999-01-01",
    family_val_end="2000-01-01",
    priority_from="2000-01-01",
    priority_until="2001-01-01",
    priority_train_months=tuple(f"2000-{m:02d}" for m in range(1, 9)),
    priority_val_months=("2000-09", "2000-10"),
    priority_test_months=("2000-11", "2000-12"),
)

# Columns that only exist after a ticket has been handled: never a model input.
# Fixed values, in the order of the source's own list.
LEAKAGE_SOURCE_COLUMNS = (
    "categoria", "subcategoria", "status", "kpi_violado", "entrou_kpi", "duracao_segundos",
    "resolvido", "encerrado", "codigo_fechamento", "solucao", "incidente_pai",
)
# What cleaning derives from them.
LEAKAGE_DERIVED_COLUMNS = ("duracao_valida", "duracao_dias", "duracao_outlier_flag", "foi_resolvido")
LEAKAGE_COLUMNS = (*LEAKAGE_SOURCE_COLUMNS, *LEAKAGE_DERIVED_COLUMNS)
