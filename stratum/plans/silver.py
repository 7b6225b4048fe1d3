"""Silver layer: standardise Bronze text, look up parents, classify, keep the latest.

Each entity is a chain of pure functions; the medallion runner (``plans.medallion``)
adds the reads and writes.  ``ts_type`` selects ``timestamp`` (session time
zone) or ``timestamp_ntz`` for parsed timestamps.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.columns import digits_only, optional_column, parse_decimal, safe_timestamp, timestamp_fallback
from stratum.functions.rules import (
    account_rules,
    card_rules,
    client_rules,
    first_reason,
    own_transaction_rules,
    refund_rules,
    risk_event_rules,
    tag_reasons,
    transaction_rules,
)
from stratum.operators.dedupe import LATEST_BY_LINEAGE, latest_per_key, spread_distinct
from stratum.operators.quality import split_by_null_reason, split_valid_invalid
from stratum.settings import REASON_COLUMN

# Lineage columns carried into silver transactions and risk events, with types.
SILVER_LINEAGE = (
    ("data_hora_ingestao", "timestamp"),
    ("arquivo_origem", "string"),
    ("id_lote", "string"),
    ("nome_arquivo_origem", "string"),
    ("tamanho_arquivo_origem", "bigint"),
    ("data_modificacao_arquivo", "timestamp"),
    ("data_ingestao", "date"),
    ("timestamp_ingestao", "timestamp"),
    ("batch_id", "string"),
    ("hash_linha", "string"),
    ("schema_version", "string"),
)


def _lineage(df: DataFrame, ts_type: str) -> list:
    return [optional_column(df, name, ts_type if dtype == "timestamp" else dtype) for name, dtype in SILVER_LINEAGE]


def _updated_at(df: DataFrame, run_ts: datetime, ts_type: str):
    ingestion = F.col("data_ingestao") if "data_ingestao" in df.columns else F.lit(None).cast("string")
    return timestamp_fallback(F.col("data_atualizacao"), ingestion, run_ts, ts_type)


# ---------------------------------------------------------------------------
# Standardisation
# ---------------------------------------------------------------------------


def standardize_clients(bronze: DataFrame, run_ts: datetime, ts_type: str = "timestamp") -> DataFrame:
    return bronze.withColumns(
        {
            "id_cliente": F.trim("id_cliente"),
            "cpf": digits_only("cpf"),
            "nome": F.initcap(F.trim("nome")),
            "cidade": F.initcap(F.trim("cidade")),
            "estado": F.upper(F.trim("estado")),
            "renda": parse_decimal("renda"),
            "data_atualizacao": _updated_at(bronze, run_ts, ts_type),
        }
    )


def standardize_accounts(bronze: DataFrame, run_ts: datetime, ts_type: str = "timestamp") -> DataFrame:
    return bronze.withColumns(
        {
            "id_conta": F.trim("id_conta"),
            "id_cliente": F.trim("id_cliente"),
            "tipo_conta": F.upper(F.trim("tipo_conta")),
            "status_conta": F.upper(F.trim("status_conta")),
            "data_atualizacao": _updated_at(bronze, run_ts, ts_type),
        }
    )


def standardize_cards(bronze: DataFrame, run_ts: datetime, ts_type: str = "timestamp") -> DataFrame:
    return bronze.withColumns(
        {
            "id_cartao": F.trim("id_cartao"),
            "id_conta": F.trim("id_conta"),
            "tipo_cartao": F.upper(F.trim("tipo_cartao")),
            "status_cartao": F.upper(F.trim("status_cartao")),
            "limite": parse_decimal("limite"),
            "data_atualizacao": _updated_at(bronze, run_ts, ts_type),
        }
    )


def standardize_transactions(bronze: DataFrame, ts_type: str = "timestamp", passthrough: Sequence[str] = ()) -> DataFrame:
    """Fixed transaction projection; ``passthrough`` keeps extra source columns (as text)."""
    return bronze.select(
        F.col("id_transacao").cast("string").alias("id_transacao"),
        F.col("id_cartao").cast("string").alias("id_cartao"),
        safe_timestamp("data_transacao", ts_type).alias("data_transacao"),
        parse_decimal("valor").alias("valor"),
        F.trim("estabelecimento").alias("estabelecimento"),
        F.upper(F.trim("canal")).alias("canal"),
        F.upper(F.trim("pais")).alias("pais"),
        F.upper(F.trim("moeda")).alias("moeda"),
        F.col("mcc").cast("string").alias("mcc"),
        *_lineage(bronze, ts_type),
        *[optional_column(bronze, c, "string") for c in passthrough],
    )


def standardize_risk_events(bronze: DataFrame, ts_type: str = "timestamp") -> DataFrame:
    return bronze.select(
        F.col("id_evento").cast("string").alias("id_evento"),
        F.col("id_transacao").cast("string").alias("id_transacao"),
        F.upper(F.trim("tipo_evento")).alias("tipo_evento"),
        F.upper(F.trim("severidade")).alias("severidade"),
        safe_timestamp("data_evento", ts_type).alias("data_evento"),
        *_lineage(bronze, ts_type),
    )


def standardize_refunds(bronze: DataFrame, ts_type: str = "timestamp") -> DataFrame:
    return bronze.withColumns(
        {
            "id_estorno": F.trim(F.col("id_estorno").cast("string")),
            "id_transacao": F.trim(F.col("id_transacao").cast("string")),
            "valor_estorno": parse_decimal("valor_estorno"),
            "data_estorno": safe_timestamp("data_estorno", ts_type),
        }
    )


# ---------------------------------------------------------------------------
# Parent lookups (left joins against one row per parent key)
# ---------------------------------------------------------------------------


def cards_with_client(cards: DataFrame, accounts: DataFrame) -> DataFrame:
    """``id_cartao, id_conta, id_cliente``: cards with the client of their account (NULL when the account is unknown)."""
    owners = accounts.select(F.col("id_conta").cast("string").alias("id_conta"), F.col("id_cliente").cast("string").alias("id_cliente"))
    return cards.select("id_cartao", F.col("id_conta").cast("string").alias("id_conta")).join(owners, "id_conta", "left")


def lookup_card_account(transactions: DataFrame, cards: DataFrame, carry: Sequence[str] = (), streamed: bool = False) -> DataFrame:
    """Add ``id_conta`` from the card's current version (NULL when the card is unknown).

    ``carry``: further columns of ``cards``, added last.  ``streamed``: the
    cards, narrow and one row a key, are hashed, and the transactions stream
    past them unsorted, so a card that very many rows name (or none) takes no
    memory.  Sorting both sides is faster where rows go on to be sorted by id.
    """
    card_accounts = cards.select(*(F.col(c).cast("string").alias(c) for c in ("id_cartao", "id_conta", *carry)))
    if streamed:
        card_accounts = card_accounts.hint("shuffle_hash")
    cols = transactions.columns
    out = transactions.join(card_accounts, "id_cartao", "left")
    ordered = cols[:2] + ["id_conta"] + cols[2:] + list(carry)
    return out.select(*ordered)


def lookup_transaction(events: DataFrame, transactions: DataFrame) -> DataFrame:
    """Add ``id_cartao`` and ``id_conta`` of the event's transaction (NULL when unknown)."""
    parents = transactions.select(
        F.col("id_transacao").cast("string").alias("id_transacao"),
        F.col("id_cartao").cast("string").alias("id_cartao"),
        F.col("id_conta").cast("string").alias("id_conta"),
    )
    cols = events.columns
    out = events.join(parents, "id_transacao", "left")
    ordered = cols[:2] + ["id_cartao", "id_conta"] + cols[2:]
    return out.select(*ordered)


# ---------------------------------------------------------------------------
# Classification: (valid latest-per-key, quarantine)
# ---------------------------------------------------------------------------


def classify_accumulated(df: DataFrame, rules, keys: Sequence[str], order_by: str) -> tuple[DataFrame, DataFrame]:
    """Accumulated reasons, split, latest valid row per key; quarantine as distinct rows."""
    valid, invalid = split_valid_invalid(tag_reasons(df, rules))
    return latest_per_key(valid, keys, order_by), invalid.distinct()


def latest_known(valid: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """``latest_per_key`` of valid rows, whose keys the rules made sure of.

    The filter tells this to the planner: a join would infer it on its own side
    only, and a plan's uses of the rows would not share their shuffles.
    """
    for key in keys:
        valid = valid.filter(F.col(key).isNotNull())
    return latest_per_key(valid, keys, order_by)


def classify_first_match(df: DataFrame, rules, keys: Sequence[str], order_by: str) -> tuple[DataFrame, DataFrame]:
    """First-match reason code, split, latest valid row per key; quarantine as distinct rows.

    The invalid rows are dealt anew: those of an unknown parent may be very many.
    """
    valid, invalid = split_by_null_reason(df.withColumn(REASON_COLUMN, first_reason(rules)))
    return latest_known(valid, keys, order_by), spread_distinct(invalid)


def silver_clients(bronze: DataFrame, run_ts: datetime, ts_type: str = "timestamp"):
    return classify_accumulated(standardize_clients(bronze, run_ts, ts_type), client_rules(), ["id_cliente"], "data_atualizacao")


def silver_accounts(bronze: DataFrame, run_ts: datetime, ts_type: str = "timestamp"):
    return classify_accumulated(standardize_accounts(bronze, run_ts, ts_type), account_rules(), ["id_conta"], "data_atualizacao")


def silver_cards(bronze: DataFrame, run_ts: datetime, ts_type: str = "timestamp"):
    return classify_accumulated(standardize_cards(bronze, run_ts, ts_type), card_rules(), ["id_cartao"], "data_atualizacao")


def silver_transactions(
    bronze: DataFrame, cards_current: DataFrame, ts_type: str = "timestamp", passthrough: Sequence[str] = (), carry: Sequence[str] = ()
):
    standard = standardize_transactions(bronze, ts_type, passthrough)

    def classified(streamed: bool):
        enriched = lookup_card_account(standard, cards_current, carry, streamed)
        return classify_first_match(enriched, transaction_rules(), ["id_transacao"], "data_transacao")

    return classified(False)[0], classified(True)[1]


def transaction_parents(bronze: DataFrame, cards_current: DataFrame, ts_type: str = "timestamp") -> DataFrame:
    """``id_transacao, id_cartao, id_conta`` of silver's transactions, from rows narrowed before their shuffles.

    The latest row is chosen by ``data_transacao``, lineage, card and account
    before all other columns, so rows that tie on these agree on what is
    returned.  The rules on a transaction's own columns apply before the lookup.
    """
    standard = standardize_transactions(bronze, ts_type)
    kept = ["id_transacao", "id_cartao", "data_transacao", *LATEST_BY_LINEAGE]
    own = standard.filter(first_reason(own_transaction_rules()).isNull()).select(*kept)
    known = lookup_card_account(own, cards_current).filter(F.col("id_conta").isNotNull())
    return latest_known(known, ["id_transacao"], "data_transacao").select("id_transacao", "id_cartao", "id_conta")


def silver_risk_events(bronze: DataFrame, transactions_silver: DataFrame, ts_type: str = "timestamp"):
    enriched = lookup_transaction(standardize_risk_events(bronze, ts_type), transactions_silver)
    return classify_first_match(enriched, risk_event_rules(), ["id_evento"], "data_evento")


def silver_refunds(bronze: DataFrame, ts_type: str = "timestamp"):
    return classify_accumulated(standardize_refunds(bronze, ts_type), refund_rules(), ["id_estorno"], "data_estorno")
