"""DuckDB SQL twins of ``driver_model``: the same projections, rules and models.

Used only as the correctness oracle.  Each builder returns CTE text; queries
are ``WITH <ctes> SELECT ...``.  Types are cast explicitly so both engines
return the same column types (DuckDB sums to DECIMAL(38,*), Spark to (28,*)).
"""

from __future__ import annotations

from stratum.plans.driver_model import EVENT_SEVERITY, RUN_TS_SQL

# The same decimal formats as stratum.functions.columns
GROUPED = r"^-?[0-9]{1,3}(\.[0-9]{3})+,[0-9]+$"
PLAIN = r"^-?[0-9]+,[0-9]+$"


def parse_decimal(x: str, p: int = 18, s: int = 2) -> str:
    t = f"trim(CAST({x} AS VARCHAR))"
    return (
        f"TRY_CAST(CASE WHEN regexp_matches({t}, '{GROUPED}') THEN replace(replace({t}, '.', ''), ',', '.') "
        f"WHEN regexp_matches({t}, '{PLAIN}') THEN replace({t}, ',', '.') ELSE {t} END AS DECIMAL({p},{s}))"
    )


def initcap_word(x: str) -> str:
    """Spark ``initcap`` for one-word values."""
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


def is_blank(x: str) -> str:
    return f"({x} IS NULL OR trim(CAST({x} AS VARCHAR)) = '')"


def desc_order(cols) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def ts(x: str) -> str:
    return f"TRY_CAST({x} AS TIMESTAMP)"


def date_key(x: str) -> str:
    return f"CAST(year({x}) * 10000 + month({x}) * 100 + day({x}) AS INTEGER)"


def line_id(prefix: str = "") -> str:
    p = f"'{prefix}' || " if prefix else ""
    return f"{p}CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"


# ---------------------------------------------------------------------------
# Bronze adapters
# ---------------------------------------------------------------------------

BRONZE = {
    "clientes": f"""bronze_clientes AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id_cliente,
    substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 1, 3) || '.' || substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 4, 3) || '.'
      || substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 7, 3) || '-' || substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 10, 2) AS cpf,
    c_name AS nome, lower(c_mktsegment) AS cidade, CAST(c_nationkey AS VARCHAR) AS estado,
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN translate(format('{{:,.2f}}', c_acctbal), ',.', '.,')
         WHEN c_mktsegment = 'BUILDING' THEN replace(CAST(c_acctbal AS VARCHAR), '.', ',')
         WHEN c_mktsegment = 'MACHINERY' THEN format('{{:,.2f}}', c_acctbal)
         WHEN c_mktsegment = 'HOUSEHOLD' THEN ' ' || CAST(c_acctbal AS VARCHAR) || ' '
         ELSE CAST(c_acctbal AS VARCHAR) END AS renda,
    CAST(NULL AS VARCHAR) AS data_atualizacao
  FROM customer)""",
    "contas": """bronze_contas AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id_conta, CAST(o_custkey AS VARCHAR) AS id_cliente,
    lower(o_orderpriority) AS tipo_conta, ' ' || o_orderstatus AS status_conta,
    CAST(o_orderdate AS VARCHAR) AS data_atualizacao
  FROM orders)""",
    "cartoes": """bronze_cartoes AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id_cartao, CAST(o_orderkey AS VARCHAR) AS id_conta,
    o_orderpriority AS tipo_cartao, CAST(o_totalprice AS VARCHAR) AS limite, o_orderstatus AS status_cartao,
    CAST(o_orderdate AS VARCHAR) AS data_atualizacao
  FROM orders)""",
    "transacoes": f"""bronze_transacoes AS (
  SELECT {line_id()} AS id_transacao, CAST(l_orderkey AS VARCHAR) AS id_cartao,
    CAST(l_shipdate AS VARCHAR) AS data_transacao, CAST(l_extendedprice AS VARCHAR) AS valor,
    CAST(l_partkey AS VARCHAR) AS mcc, 'S' || CAST(l_suppkey AS VARCHAR) AS estabelecimento,
    lower(l_linestatus) AS canal, 'br' AS pais, 'brl' AS moeda, l_returnflag AS tipo_transacao
  FROM lineitem)""",
    "estornos": f"""bronze_estornos AS (
  SELECT {line_id('E')} AS id_estorno, {line_id()} AS id_transacao,
    CAST(l_shipdate AS VARCHAR) AS data_estorno, 'DEVOLUCAO' AS motivo,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) AS valor_estorno
  FROM lineitem WHERE l_returnflag = 'R')""",
    "eventos_risco": """bronze_eventos_risco AS (
  SELECT CAST(event_id AS VARCHAR) AS id_evento, CAST(event_id AS VARCHAR) || '-1' AS id_transacao,
    event_type AS tipo_evento,
    CASE """
    + " ".join(f"WHEN event_type = '{e}' THEN '{s}'" for e, s in EVENT_SEVERITY)
    + """ END AS severidade,
    CAST(ts AS VARCHAR) AS data_evento
  FROM events)""",
}

NULL_LINEAGE = (
    "CAST(NULL AS TIMESTAMP) AS data_hora_ingestao, CAST(NULL AS VARCHAR) AS arquivo_origem, CAST(NULL AS VARCHAR) AS id_lote, "
    "CAST(NULL AS VARCHAR) AS nome_arquivo_origem, CAST(NULL AS BIGINT) AS tamanho_arquivo_origem, "
    "CAST(NULL AS TIMESTAMP) AS data_modificacao_arquivo, CAST(NULL AS DATE) AS data_ingestao, "
    "CAST(NULL AS TIMESTAMP) AS timestamp_ingestao, CAST(NULL AS VARCHAR) AS batch_id, CAST(NULL AS VARCHAR) AS hash_linha, "
    "CAST(NULL AS VARCHAR) AS schema_version"
)


def _fallback_ts(x: str) -> str:
    return f"COALESCE({ts(x)}, CAST(NULL AS TIMESTAMP), {RUN_TS_SQL})"


def _valid(tagged: str) -> str:
    return f"SELECT * EXCLUDE (motivo_quarentena) FROM {tagged} WHERE length(trim(coalesce(motivo_quarentena, ''))) = 0"


def _invalid(tagged: str) -> str:
    return f"SELECT DISTINCT * FROM {tagged} WHERE length(trim(coalesce(motivo_quarentena, ''))) > 0"


def _reasons(rules) -> str:
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {p} THEN '{m}' END" for p, m in rules) + ") AS motivo_quarentena"


def _first(rules) -> str:
    return "CASE " + " ".join(f"WHEN {p} THEN '{m}'" for p, m in rules) + " END AS motivo_quarentena"


CLIENT_RULES = [
    ("id_cliente IS NULL", "id_cliente ausente"),
    ("length(cpf) <> 11", "cpf inválido"),
    ("nome IS NULL", "nome ausente"),
    ("renda IS NULL", "renda inválida"),
]
ACCOUNT_RULES = [
    ("id_conta IS NULL", "id_conta ausente"),
    ("id_cliente IS NULL", "id_cliente ausente"),
    ("tipo_conta IS NULL", "tipo_conta ausente"),
]
CARD_RULES = [
    ("id_cartao IS NULL", "id_cartao ausente"),
    ("id_conta IS NULL", "id_conta ausente"),
    ("limite IS NULL", "limite inválido"),
]
REFUND_RULES = [
    ("id_estorno IS NULL OR id_estorno = ''", "id_estorno ausente"),
    ("id_transacao IS NULL OR id_transacao = ''", "id_transacao ausente"),
    ("valor_estorno IS NULL", "valor_estorno inválido"),
    ("valor_estorno <= 0", "valor_estorno deve ser maior que zero"),
    ("data_estorno IS NULL", "data_estorno inválida"),
]
TRANSACTION_RULES = [
    (is_blank("id_transacao"), "ID_TRANSACAO_NULO"),
    (is_blank("id_cartao"), "ID_CARTAO_NULO"),
    ("id_conta IS NULL", "CARTAO_NAO_ENCONTRADO"),
    ("data_transacao IS NULL", "DATA_TRANSACAO_INVALIDA"),
    ("valor IS NULL", "VALOR_INVALIDO"),
    ("valor <= 0", "VALOR_NAO_POSITIVO"),
    (is_blank("estabelecimento"), "ESTABELECIMENTO_NULO"),
    (is_blank("canal"), "CANAL_NULO"),
]
EVENT_RULES = [
    (is_blank("id_evento"), "ID_EVENTO_NULO"),
    (is_blank("id_transacao"), "ID_TRANSACAO_NULO"),
    ("id_cartao IS NULL", "TRANSACAO_NAO_ENCONTRADA"),
    (is_blank("tipo_evento"), "TIPO_EVENTO_NULO"),
    ("severidade IS NULL OR severidade NOT IN ('BAIXA', 'MEDIA', 'ALTA', 'CRITICA')", "SEVERIDADE_INVALIDA"),
    ("data_evento IS NULL", "DATA_EVENTO_INVALIDA"),
]

TX_REST = ["id_cartao", "id_conta", "valor", "estabelecimento", "canal", "pais", "moeda", "mcc", "tipo_transacao"]
EV_REST = ["id_transacao", "id_cartao", "id_conta", "tipo_evento", "severidade"]

SILVER = {
    "clientes": f"""std_clientes AS (
  SELECT trim(id_cliente) AS id_cliente, regexp_replace(cpf, '\\D', '', 'g') AS cpf,
    {initcap_word('trim(nome)')} AS nome, {initcap_word('trim(cidade)')} AS cidade, upper(trim(estado)) AS estado,
    {parse_decimal('renda')} AS renda, {_fallback_ts('data_atualizacao')} AS data_atualizacao
  FROM bronze_clientes),
tag_clientes AS (SELECT *, {_reasons(CLIENT_RULES)} FROM std_clientes),
silver_clientes AS ({_valid('tag_clientes')}
  QUALIFY row_number() OVER (PARTITION BY id_cliente ORDER BY {desc_order(['data_atualizacao', 'cpf', 'nome', 'cidade', 'estado', 'renda'])}) = 1),
quarantine_clientes AS ({_invalid('tag_clientes')})""",
    "contas": f"""std_contas AS (
  SELECT trim(id_conta) AS id_conta, trim(id_cliente) AS id_cliente, upper(trim(tipo_conta)) AS tipo_conta,
    upper(trim(status_conta)) AS status_conta, {_fallback_ts('data_atualizacao')} AS data_atualizacao
  FROM bronze_contas),
tag_contas AS (SELECT *, {_reasons(ACCOUNT_RULES)} FROM std_contas),
silver_contas AS ({_valid('tag_contas')}
  QUALIFY row_number() OVER (PARTITION BY id_conta ORDER BY {desc_order(['data_atualizacao', 'id_cliente', 'tipo_conta', 'status_conta'])}) = 1),
quarantine_contas AS ({_invalid('tag_contas')})""",
    "cartoes": f"""std_cartoes AS (
  SELECT trim(id_cartao) AS id_cartao, trim(id_conta) AS id_conta, upper(trim(tipo_cartao)) AS tipo_cartao,
    {parse_decimal('limite')} AS limite, upper(trim(status_cartao)) AS status_cartao,
    {_fallback_ts('data_atualizacao')} AS data_atualizacao
  FROM bronze_cartoes),
tag_cartoes AS (SELECT *, {_reasons(CARD_RULES)} FROM std_cartoes),
silver_cartoes AS ({_valid('tag_cartoes')}
  QUALIFY row_number() OVER (PARTITION BY id_cartao ORDER BY {desc_order(['data_atualizacao', 'id_conta', 'tipo_cartao', 'limite', 'status_cartao'])}) = 1),
quarantine_cartoes AS ({_invalid('tag_cartoes')})""",
    "transacoes": f"""std_transacoes AS (
  SELECT CAST(id_transacao AS VARCHAR) AS id_transacao, CAST(id_cartao AS VARCHAR) AS id_cartao,
    {ts('data_transacao')} AS data_transacao, {parse_decimal('valor')} AS valor, trim(estabelecimento) AS estabelecimento,
    upper(trim(canal)) AS canal, upper(trim(pais)) AS pais, upper(trim(moeda)) AS moeda, CAST(mcc AS VARCHAR) AS mcc,
    {NULL_LINEAGE}, CAST(tipo_transacao AS VARCHAR) AS tipo_transacao
  FROM bronze_transacoes),
enr_transacoes AS (
  SELECT t.id_transacao, t.id_cartao, c.id_conta, t.* EXCLUDE (id_transacao, id_cartao)
  FROM std_transacoes t LEFT JOIN (SELECT id_cartao, id_conta FROM silver_cartoes) c ON t.id_cartao = c.id_cartao),
tag_transacoes AS (SELECT *, {_first(TRANSACTION_RULES)} FROM enr_transacoes),
silver_transacoes AS (SELECT * EXCLUDE (motivo_quarentena) FROM tag_transacoes WHERE motivo_quarentena IS NULL
  QUALIFY row_number() OVER (PARTITION BY id_transacao ORDER BY {desc_order(['data_transacao'] + TX_REST)}) = 1),
quarantine_transacoes AS (SELECT DISTINCT * FROM tag_transacoes WHERE motivo_quarentena IS NOT NULL)""",
    "eventos_risco": f"""std_eventos AS (
  SELECT CAST(id_evento AS VARCHAR) AS id_evento, CAST(id_transacao AS VARCHAR) AS id_transacao,
    upper(trim(tipo_evento)) AS tipo_evento, upper(trim(severidade)) AS severidade, {ts('data_evento')} AS data_evento,
    {NULL_LINEAGE}
  FROM bronze_eventos_risco),
enr_eventos AS (
  SELECT e.id_evento, e.id_transacao, t.id_cartao, t.id_conta, e.* EXCLUDE (id_evento, id_transacao)
  FROM std_eventos e LEFT JOIN (SELECT id_transacao, id_cartao, id_conta FROM silver_transacoes) t ON e.id_transacao = t.id_transacao),
tag_eventos AS (SELECT *, {_first(EVENT_RULES)} FROM enr_eventos),
silver_eventos AS (SELECT * EXCLUDE (motivo_quarentena) FROM tag_eventos WHERE motivo_quarentena IS NULL
  QUALIFY row_number() OVER (PARTITION BY id_evento ORDER BY {desc_order(['data_evento'] + EV_REST)}) = 1),
quarantine_eventos AS (SELECT DISTINCT * FROM tag_eventos WHERE motivo_quarentena IS NOT NULL)""",
    "estornos": f"""std_estornos AS (
  SELECT trim(CAST(id_estorno AS VARCHAR)) AS id_estorno, trim(CAST(id_transacao AS VARCHAR)) AS id_transacao,
    {ts('data_estorno')} AS data_estorno, motivo, {parse_decimal('valor_estorno')} AS valor_estorno
  FROM bronze_estornos),
tag_estornos AS (SELECT *, {_reasons(REFUND_RULES)} FROM std_estornos),
silver_estornos AS ({_valid('tag_estornos')}
  QUALIFY row_number() OVER (PARTITION BY id_estorno ORDER BY {desc_order(['data_estorno', 'id_transacao', 'motivo', 'valor_estorno'])}) = 1),
quarantine_estornos AS ({_invalid('tag_estornos')})""",
}

# dependencies between CTE groups, in definition order
DEPENDS = {
    "clientes": ["clientes"],
    "contas": ["contas"],
    "cartoes": ["cartoes"],
    "transacoes": ["cartoes", "transacoes"],
    "eventos_risco": ["cartoes", "transacoes", "eventos_risco"],
    "estornos": ["estornos"],
}

GOLD = {
    "dim_clientes": ("SELECT id_cliente, cpf, nome, cidade, estado, renda FROM silver_clientes", ["clientes"]),
    "dim_contas": ("SELECT id_conta, id_cliente, tipo_conta, status_conta FROM silver_contas", ["contas"]),
    "dim_cartoes": ("SELECT id_cartao, id_conta, tipo_cartao, status_cartao, limite FROM silver_cartoes", ["cartoes"]),
    "fato_transacoes": (
        f"""SELECT t.id_transacao, a.id_cliente, t.id_conta, t.id_cartao, {date_key('t.data_transacao')} AS id_data,
    t.data_transacao, CAST(t.tipo_transacao AS VARCHAR) AS tipo_transacao, CAST(t.canal AS VARCHAR) AS canal,
    CAST(t.valor AS DECIMAL(18,2)) AS valor, CAST(NULL AS VARCHAR) AS status
  FROM silver_transacoes t JOIN dim_contas a ON t.id_conta = a.id_conta""",
        ["transacoes", "contas", "dim_contas"],
    ),
    "fato_estornos": (
        f"""SELECT r.id_estorno, r.id_transacao, t.id_cliente, {date_key('r.data_estorno')} AS id_data, r.data_estorno,
    CAST(r.valor_estorno AS DECIMAL(18,2)) AS valor_estorno, CAST(r.motivo AS VARCHAR) AS motivo
  FROM silver_estornos r JOIN fato_transacoes t ON r.id_transacao = t.id_transacao""",
        ["estornos", "fato_transacoes"],
    ),
    "fato_eventos_risco": (
        f"""SELECT e.id_evento, e.id_transacao, t.id_cliente, e.id_conta, e.id_cartao, {date_key('e.data_evento')} AS id_data,
    e.data_evento, CAST(e.severidade AS VARCHAR) AS severidade, CAST(e.tipo_evento AS VARCHAR) AS tipo_evento
  FROM silver_eventos e LEFT JOIN fato_transacoes t ON e.id_transacao = t.id_transacao""",
        ["eventos_risco", "fato_transacoes"],
    ),
}

GOLD_ORDER = ["dim_clientes", "dim_contas", "dim_cartoes", "fato_transacoes", "fato_estornos", "fato_eventos_risco"]


def with_ctes(needed: list[str], select: str) -> str:
    """Build ``WITH ... SELECT`` including every bronze/silver/gold CTE the names need."""
    silver_needed: list[str] = []
    gold_needed: list[str] = []

    def add_gold(g: str) -> None:
        if g in gold_needed:
            return
        for dep in GOLD[g][1]:
            if dep in GOLD:
                add_gold(dep)
            else:
                add_silver(dep)
        gold_needed.append(g)

    def add_silver(s: str) -> None:
        for dep in DEPENDS[s]:
            if dep not in silver_needed:
                silver_needed.append(dep)

    for n in needed:
        if n in GOLD:
            add_gold(n)
        else:
            add_silver(n)
    order = ["clientes", "contas", "cartoes", "transacoes", "eventos_risco", "estornos"]
    parts = [BRONZE[s] for s in order if s in silver_needed]
    parts += [SILVER[s] for s in order if s in silver_needed]
    parts += [f"{g} AS ({GOLD[g][0]})" for g in GOLD_ORDER if g in gold_needed]
    return "WITH " + ",\n".join(parts) + "\n" + select
