"""Every registered query against its DuckDB oracle on sf0.001 (same check as the driver)."""

import duckdb
import pytest

import __spark_entry__ as entry
from stratum.plans.registry import QUERIES as REGISTERED
from conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

QUERIES = {name: q for name, q in entry.queries().items() if name in REGISTERED}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTERED}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


ROWS_ONLY: set[str] = set()


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


def test_rejection_records_payload(spark):
    import json

    rows = QUERIES["rejection_records"](spark, SF_SMALL).collect()
    assert rows and all(r["regra"] == "regras_estornos" and r["motivo"] for r in rows)
    payload = json.loads(rows[0]["registro_original"])
    assert {"id_estorno", "id_transacao", "valor_estorno"} <= set(payload)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["id_cliente", "nome"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]
