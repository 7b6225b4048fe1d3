"""Rules, quarantines and parent checks on damaged Bronze rows.

The driver tables are nearly clean, so most rules never fire on them.  Here
every row of every table is read and each row whose key has a certain remainder
carries one of the defects below, so each rule of each entity rejects rows, some rows break several
rules at once, and children lose their parents.  The same library functions
then classify them; ``damaged_sql`` builds the DuckDB twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators import consistency
from stratum.plans import driver_oracle as O
from stratum.plans.driver_model import Model
from stratum.plans.operator_queries import tagged
from stratum.plans.registry import register

EVERY = 29  # a defect hits the rows whose key leaves its remainder by this

# per entity: the key in Spark and DuckDB, and remainder -> {column: damaged value}
DEFECTS: dict[str, tuple[str, str, dict[int, dict[str, str | None]]]] = {
    "clientes": (
        "id_cliente",
        "id_cliente",
        {
            0: {"id_cliente": None},
            1: {"cpf": "123"},
            2: {"nome": None},
            3: {"renda": "n/d"},
            4: {"cpf": "1", "nome": None, "renda": ""},
        },
    ),
    "contas": (
        "id_conta",
        "id_conta",
        {
            0: {"id_conta": None},
            1: {"id_cliente": None},
            2: {"tipo_conta": None},
            3: {"id_cliente": None, "tipo_conta": None},
            4: {"id_cliente": "-7"},
            5: {"status_conta": "?"},
        },
    ),
    "cartoes": (
        "id_cartao",
        "id_cartao",
        {
            6: {"id_cartao": None},
            7: {"id_conta": None},
            8: {"limite": "alto"},
            9: {"id_conta": None, "limite": ""},
            10: {"id_conta": "-7"},
            11: {"status_cartao": None},
        },
    ),
    "transacoes": (
        "substring_index(id_transacao, '-', 1)",
        "split_part(id_transacao, '-', 1)",
        {
            12: {"id_transacao": "  "},
            13: {"id_cartao": None},
            14: {"id_cartao": "-7"},
            15: {"data_transacao": "sem data"},
            16: {"valor": "abc"},
            17: {"valor": "0"},
            18: {"estabelecimento": " "},
            19: {"canal": None},
            20: {"id_transacao": None, "valor": "-1", "canal": ""},
            21: {"valor": "-1,50", "canal": ""},
        },
    ),
    "eventos_risco": (
        "id_evento",
        "id_evento",
        {
            0: {"id_evento": " "},
            1: {"id_transacao": None},
            2: {"id_transacao": "nenhuma"},
            3: {"tipo_evento": ""},
            4: {"severidade": "urgente"},
            5: {"data_evento": "ontem"},
            6: {"tipo_evento": None, "severidade": None},
        },
    ),
    "estornos": (
        "substring_index(id_transacao, '-', 1)",
        "split_part(id_transacao, '-', 1)",
        {
            0: {"id_estorno": ""},
            1: {"id_transacao": None},
            2: {"valor_estorno": "x"},
            3: {"valor_estorno": "-5"},
            4: {"data_estorno": "sem data"},
            5: {"id_estorno": None, "valor_estorno": "0", "data_estorno": ""},
        },
    ),
}


def _by_column(entity: str) -> dict[str, dict[int, str | None]]:
    columns: dict[str, dict[int, str | None]] = {}
    for remainder, values in DEFECTS[entity][2].items():
        for column, value in values.items():
            columns.setdefault(column, {})[remainder] = value
    return columns


def damage(bronze: DataFrame, entity: str) -> DataFrame:
    """``bronze`` with the defects of ``entity``; every row stays."""
    remainder = F.expr(f"CAST({DEFECTS[entity][0]} AS BIGINT) % {EVERY}")
    changed = {}
    for column, values in _by_column(entity).items():
        value = F
        for at, text in values.items():
            value = value.when(remainder == at, F.lit(text))
        changed[column] = value.otherwise(F.col(column))
    return bronze.select(*(changed.get(c, F.col(c)).cast("string").alias(c) for c in bronze.columns))


class DamagedModel(Model):
    """The silver layers over damaged Bronze rows."""

    def bronze(self, entity: str) -> DataFrame:
        return damage(super().bronze(entity), entity)


def damaged_sql(needed: list[str], select: str) -> str:
    """``with_ctes`` with each Bronze table replaced by its damaged form."""
    sql = O.with_ctes(needed, select)
    for entity, (_, key, _) in DEFECTS.items():
        name = f"bronze_{entity}"
        if f"{name} AS (" not in sql:
            continue
        changed = []
        for column, values in _by_column(entity).items():
            cases = " ".join(
                f"WHEN {at} THEN " + ("NULL" if text is None else f"'{text}'") for at, text in values.items()
            )
            changed.append(f"CASE CAST({key} AS BIGINT) % {EVERY} {cases} ELSE {column} END AS {column}")
        bronze = O.BRONZE[entity]
        clean = bronze.replace(f"{name} AS (", f"clean_{entity} AS (", 1)
        sql = sql.replace(bronze, f"{clean},\n{name} AS (SELECT * REPLACE ({', '.join(changed)}) FROM clean_{entity})", 1)
    return sql


# entity: name in queries, tagged rows, quarantine, its layer
_ENTITIES = {
    "clientes": ("clients", "tag_clientes", "quarantine_clientes", DamagedModel.clients),
    "contas": ("accounts", "tag_contas", "quarantine_contas", DamagedModel.accounts),
    "cartoes": ("cards", "tag_cartoes", "quarantine_cartoes", DamagedModel.cards),
    "transacoes": ("transactions", "tag_transacoes", "quarantine_transacoes", DamagedModel.transactions),
    "eventos_risco": ("events", "tag_eventos", "quarantine_eventos", DamagedModel.risk_events),
    "estornos": ("refunds", "tag_estornos", "quarantine_estornos", DamagedModel.refunds),
}

for _entity, (_name, _tag, _quarantine, _layer) in _ENTITIES.items():
    register(f"damaged_reasons_{_name}", damaged_sql([_entity], f"SELECT * FROM {_tag}"))(
        lambda spark, sf, _entity=_entity: tagged(DamagedModel(spark, sf), _entity)
    )
    register(f"damaged_quarantine_{_name}", damaged_sql([_entity], f"SELECT * FROM {_quarantine}"))(
        lambda spark, sf, _layer=_layer: _layer(DamagedModel(spark, sf))[1]
    )


@register(
    "damaged_reason_counts",
    damaged_sql(
        list(_ENTITIES),
        "SELECT entidade, motivo_quarentena, count(*) AS quantidade FROM ("
        + " UNION ALL ".join(f"SELECT '{e}' AS entidade, motivo_quarentena FROM {t}" for e, (_, t, _, _) in _ENTITIES.items())
        + ") WHERE motivo_quarentena IS NOT NULL AND motivo_quarentena <> '' GROUP BY ALL",
    ),
)
def q_damaged_reason_counts(spark, sf):
    m, parts = DamagedModel(spark, sf), []
    for entity in _ENTITIES:
        reasons = tagged(m, entity).filter("motivo_quarentena <> ''")
        parts.append(
            reasons.groupBy(F.lit(entity).alias("entidade"), "motivo_quarentena").agg(F.count(F.lit(1)).alias("quantidade"))
        )
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts


def _orphans(child: str, key: str, parent: str) -> str:
    return f"SELECT * FROM {child} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"


@register("damaged_account_client_fk", damaged_sql(["clientes", "contas"], _orphans("silver_contas", "id_cliente", "silver_clientes")))
def q_damaged_account_client_fk(spark, sf):
    m = DamagedModel(spark, sf)
    return consistency.missing_parent(m.accounts()[0], "id_cliente", m.clients()[0], "id_cliente")


@register("damaged_card_account_fk", damaged_sql(["contas", "cartoes"], _orphans("silver_cartoes", "id_conta", "silver_contas")))
def q_damaged_card_account_fk(spark, sf):
    m = DamagedModel(spark, sf)
    return consistency.missing_parent(m.cards()[0], "id_conta", m.accounts()[0], "id_conta")


STATUSES = ("F", "O", "P")  # the domain of a status is a parameter: the documents name none


def _outside(silver: str, column: str) -> str:
    listed = ", ".join(f"'{s}'" for s in STATUSES)
    return f"SELECT * FROM {silver} WHERE {column} IS NULL OR {column} NOT IN ({listed})"


@register("damaged_account_status", damaged_sql(["contas"], _outside("silver_contas", "status_conta")))
def q_damaged_account_status(spark, sf):
    return consistency.outside_domain(DamagedModel(spark, sf).accounts()[0], "status_conta", STATUSES)


@register("damaged_card_status", damaged_sql(["cartoes"], _outside("silver_cartoes", "status_cartao")))
def q_damaged_card_status(spark, sf):
    return consistency.outside_domain(DamagedModel(spark, sf).cards()[0], "status_cartao", STATUSES)
