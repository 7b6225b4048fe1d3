"""The damaged Bronze rows make every rule of every entity fire."""

import pytest

from conftest import SF_SMALL
from stratum.functions import rules as R
from stratum.plans.damaged_queries import DEFECTS, DamagedModel, q_damaged_reason_counts
from stratum.plans.driver_model import Model

RULES = {
    "clientes": R.client_rules,
    "contas": R.account_rules,
    "cartoes": R.card_rules,
    "transacoes": R.transaction_rules,
    "eventos_risco": R.risk_event_rules,
    "estornos": R.refund_rules,
}


def test_every_rule_rejects_rows(spark):
    found = {}
    for row in q_damaged_reason_counts(spark, SF_SMALL).collect():
        found.setdefault(row["entidade"], set()).update(row["motivo_quarentena"].split("; "))
    assert found == {entity: {message for _, message in rules()} for entity, rules in RULES.items()}


def test_several_messages_in_rule_order(spark):
    reasons = {r["motivo_quarentena"] for r in q_damaged_reason_counts(spark, SF_SMALL).collect()}
    assert "cpf inválido; nome ausente; renda inválida" in reasons
    assert "id_cliente ausente; tipo_conta ausente" in reasons
    assert "id_conta ausente; limite inválido" in reasons


@pytest.mark.parametrize("entity", sorted(DEFECTS))
def test_damage_keeps_every_row_and_column(spark, entity):
    clean, damaged = Model(spark, SF_SMALL).bronze(entity), DamagedModel(spark, SF_SMALL).bronze(entity)
    assert damaged.columns == clean.columns
    assert damaged.count() == clean.count() > 0
