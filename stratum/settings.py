"""Typed settings: source registry, entity specs and the fixed values of the data model.

One settings object replaces the notebook widgets and the never-read YAML of the
original design.  Run time, batch id and schema version are parameters of each
run, so every transform is deterministic for given inputs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Names and codes that must equal the reference data model.
# ---------------------------------------------------------------------------

# Sources (raw folders / Bronze tables), in processing order.
SOURCE_NAMES = ("clientes", "contas", "cartoes", "transacoes", "eventos_risco", "estornos")

# Lineage columns added to every Bronze row, in this order.
LINEAGE_COLUMNS = (
    "arquivo_origem",
    "nome_arquivo_origem",
    "tamanho_arquivo_origem",
    "data_modificacao_arquivo",
    "data_ingestao",
    "timestamp_ingestao",
    "batch_id",
    "hash_linha",
    "schema_version",
)

# Corrupt-record column of the raw readers.
CORRUPT_COLUMN = "_registro_corrompido"

# Row fingerprint: separator between values and the text standing for NULL.
FINGERPRINT_SEPARATOR = "||"
FINGERPRINT_NULL = "∅"

# SCD2 validity columns of the silver tables.
SCD_START = "data_inicio_vigencia"
SCD_END = "data_fim_vigencia"
SCD_CURRENT = "registro_atual"

# Quarantine reason column and the separator of accumulated reasons.
REASON_COLUMN = "motivo_quarentena"
REASON_SEPARATOR = "; "

# Allowed risk-event severities.
SEVERITIES = ("BAIXA", "MEDIA", "ALTA", "CRITICA")

# Risk classes, checked in this order (first positive count wins).
RISK_CLASSES = (
    ("CRITICA", "CRITICO"),
    ("ALTA", "ALTO"),
    ("MEDIA", "MEDIO"),
    ("BAIXA", "BAIXO"),
)
NO_RISK_CLASS = "SEM_EVENTOS"

# Default date range of dim_data when no dated fact exists.
DEFAULT_DATE_RANGE = ("2025-01-01", "2026-12-31")

# File ledger statuses and the ledger message of each outcome.
LEDGER_STATUSES = ("NAO_CONFIRMADO", "PROCESSADO", "ERRO_MOVIMENTACAO", "ERRO")
LEDGER_MESSAGE_UNCONFIRMED = "O arquivo não foi encontrado na coluna arquivo_origem da tabela Bronze."
LEDGER_MESSAGE_PROCESSED = "Arquivo confirmado na Bronze e movido com sucesso."
# The original names its platform in the third message and shows the exception's
# text in the fourth; these two are ours.
LEDGER_MESSAGE_NOT_MOVED = "O arquivo foi confirmado na Bronze, mas continua na entrada."
LEDGER_MESSAGE_LOST = "O arquivo não está na entrada nem no destino."
LEDGER_MESSAGE_UNKNOWN = "O arquivo está no destino sem confirmação na Bronze."
LEDGER_MESSAGE_IN_PLACE = "Arquivo confirmado na Bronze; permanece na entrada, sem pasta de processados."

# Data-quality result statuses.
CHECK_PASSED = "APROVADO"
CHECK_FAILED = "REPROVADO"

# Raw formats accepted by the Bronze reader.
RAW_FORMATS = ("csv", "json")


@dataclass(frozen=True)
class SourceSpec:
    """One raw source: where its files are, how to read them, which Bronze table."""

    name: str
    path: str
    fmt: str = "csv"
    table: str | None = None


@dataclass(frozen=True)
class EntitySpec:
    """A silver entity loaded with SCD2: keys, change-detection columns, ordering."""

    name: str
    keys: tuple[str, ...]
    compare: tuple[str, ...]
    order_by: str = "data_atualizacao"


# Silver SCD2 entities (keys and compared columns of the data model).
ENTITIES = {
    "clientes": EntitySpec("clientes", ("id_cliente",), ("cpf", "nome", "cidade", "estado", "renda")),
    "contas": EntitySpec("contas", ("id_conta",), ("id_cliente", "tipo_conta", "status_conta")),
    "cartoes": EntitySpec("cartoes", ("id_cartao",), ("id_conta", "tipo_cartao", "limite", "status_cartao")),
}


@dataclass
class Settings:
    """Where the layers live and how a run is identified."""

    raw_root: str
    database_bronze: str = "bronze"
    database_silver: str = "prata"
    database_gold: str = "ouro"
    database_quarantine: str = "quarentena"
    database_control: str = "controle"
    schema_version: str = "v1"
    sources: dict[str, SourceSpec] = field(default_factory=dict)
    # folder below which confirmed files are moved, per source; None = files stay where they are
    archive_root: str | None = None
    # files read and committed to Bronze at a time; bounds what one batch brings to the driver
    max_files_per_batch: int = 10_000
    # bucket the SCD2 tables by key (co-located SCD2 joins); None = not bucketed
    scd_buckets: int | None = None
    # partition the refund table by a hash of its key, so a MERGE rewrites the touched parts only
    merge_key_buckets: int | None = None

    def __post_init__(self) -> None:
        if not self.sources:
            self.sources = {
                name: SourceSpec(name, f"{self.raw_root.rstrip('/')}/{name}", "csv", f"{self.database_bronze}.{name}")
                for name in SOURCE_NAMES
            }

    def table(self, layer: str, name: str) -> str:
        database = {
            "bronze": self.database_bronze,
            "silver": self.database_silver,
            "gold": self.database_gold,
            "quarantine": self.database_quarantine,
            "control": self.database_control,
        }[layer]
        return f"{database}.{name}"
