"""Quality rules: a rule is ``(predicate that is TRUE when violated, message)``.

Two ways to turn rules into a reason column:

* ``accumulated_reasons`` -- every violated message, joined with ``"; "``;
  ``""`` when the row is clean (NULL predicates count as not violated).
* ``first_reason`` -- the code of the first violated rule, NULL when clean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.columns import is_blank, not_in_domain
from stratum.settings import REASON_COLUMN, REASON_SEPARATOR, SEVERITIES

Rule = tuple[Column, str]


def accumulated_reasons(rules: Sequence[Rule]) -> Column:
    """All violated messages, in rule order, joined by ``"; "`` (``""`` if none)."""
    return F.concat_ws(REASON_SEPARATOR, *[F.when(pred, F.lit(msg)) for pred, msg in rules])


def first_reason(rules: Sequence[Rule]) -> Column:
    """Message of the first violated rule; NULL when no rule fires."""
    expr = None
    for pred, msg in rules:
        expr = F.when(pred, F.lit(msg)) if expr is None else expr.when(pred, F.lit(msg))
    return expr if expr is not None else F.lit(None).cast("string")


def tag_reasons(df: DataFrame, rules: Sequence[Rule], column: str = REASON_COLUMN) -> DataFrame:
    """Add the accumulated reason column."""
    return df.withColumn(column, accumulated_reasons(rules))


def tag_first_reason(df: DataFrame, rules: Sequence[Rule], column: str = REASON_COLUMN) -> DataFrame:
    """Add the first-match reason code column."""
    return df.withColumn(column, first_reason(rules))


# ---------------------------------------------------------------------------
# Rule sets of the data model.  Messages and codes are fixed values.
# ---------------------------------------------------------------------------


def client_rules() -> list[Rule]:
    # length(NULL) != 11 is NULL, so a NULL cpf is not flagged (same as the original rules)
    return [
        (F.col("id_cliente").isNull(), "id_cliente ausente"),
        (F.length("cpf") != 11, "cpf inválido"),
        (F.col("nome").isNull(), "nome ausente"),
        (F.col("renda").isNull(), "renda inválida"),
    ]


def account_rules() -> list[Rule]:
    return [
        (F.col("id_conta").isNull(), "id_conta ausente"),
        (F.col("id_cliente").isNull(), "id_cliente ausente"),
        (F.col("tipo_conta").isNull(), "tipo_conta ausente"),
    ]


def card_rules() -> list[Rule]:
    return [
        (F.col("id_cartao").isNull(), "id_cartao ausente"),
        (F.col("id_conta").isNull(), "id_conta ausente"),
        (F.col("limite").isNull(), "limite inválido"),
    ]


def refund_rules() -> list[Rule]:
    return [
        (F.col("id_estorno").isNull() | (F.col("id_estorno") == ""), "id_estorno ausente"),
        (F.col("id_transacao").isNull() | (F.col("id_transacao") == ""), "id_transacao ausente"),
        (F.col("valor_estorno").isNull(), "valor_estorno inválido"),
        (F.col("valor_estorno") <= 0, "valor_estorno deve ser maior que zero"),
        (F.col("data_estorno").isNull(), "data_estorno inválida"),
    ]


def transaction_rules() -> list[Rule]:
    """First-match codes for transactions (after the card lookup added ``id_conta``)."""
    return [
        (is_blank("id_transacao"), "ID_TRANSACAO_NULO"),
        (is_blank("id_cartao"), "ID_CARTAO_NULO"),
        (F.col("id_conta").isNull(), "CARTAO_NAO_ENCONTRADO"),
        (F.col("data_transacao").isNull(), "DATA_TRANSACAO_INVALIDA"),
        (F.col("valor").isNull(), "VALOR_INVALIDO"),
        (F.col("valor") <= 0, "VALOR_NAO_POSITIVO"),
        (is_blank("estabelecimento"), "ESTABELECIMENTO_NULO"),
        (is_blank("canal"), "CANAL_NULO"),
    ]


def own_transaction_rules() -> list[Rule]:
    """The transaction rules on its own columns, without that on the looked-up account."""
    return [(condition, code) for condition, code in transaction_rules() if code != "CARTAO_NAO_ENCONTRADO"]


def risk_event_rules() -> list[Rule]:
    """First-match codes for risk events (after the transaction lookup added ``id_cartao``)."""
    return [
        (is_blank("id_evento"), "ID_EVENTO_NULO"),
        (is_blank("id_transacao"), "ID_TRANSACAO_NULO"),
        (F.col("id_cartao").isNull(), "TRANSACAO_NAO_ENCONTRADA"),
        (is_blank("tipo_evento"), "TIPO_EVENTO_NULO"),
        (not_in_domain("severidade", SEVERITIES), "SEVERIDADE_INVALIDA"),
        (F.col("data_evento").isNull(), "DATA_EVENTO_INVALIDA"),
    ]


def strict_client_rules() -> list[Rule]:
    """Documented-but-uncoded client rules: blank name, state of two letters, NULL cpf."""
    return [
        (F.col("id_cliente").isNull(), "id_cliente ausente"),
        (F.coalesce(F.length("cpf") != 11, F.lit(True)), "cpf inválido"),
        (is_blank("nome"), "nome ausente"),
        (F.coalesce(F.length("estado") != 2, F.lit(True)), "estado inválido"),
        (F.col("renda").isNull(), "renda inválida"),
    ]
