"""All checks of several tables from one keyed aggregate."""

from datetime import datetime

import pytest

from stratum.operators import checks
from stratum.operators.checks import TableChecks, keyed_checks

RUN_TS = datetime(2026, 1, 1)


@pytest.fixture
def tables(spark):
    clients = [(i, f"c{i}", True) for i in range(50)] + [(3, "old", False), (7, "twice", True), (None, "x", True), (None, "y", True)]
    sales = [(f"{i}", 5, i % 60, float(i - 2), "A") for i in range(200)]  # one client holds most accounts
    sales += [("17", None, None, None, None), (None, 99, 3, 1.0, "B"), (None, 99, 3, 1.0, "C"), (" ", 5, 1, 1.0, "A")]
    parts = [(1, "a"), (1, "b"), (1, "b"), (None, "a"), (None, "a"), (1, None)]
    return {
        "clients": spark.createDataFrame(clients, "id long, name string, registro_atual boolean"),
        "sales": spark.createDataFrame(sales, "sale string, account long, client long, value double, kind string"),
        "parts": spark.createDataFrame(parts, "a long, b string"),
        "nothing": spark.createDataFrame([], "id long, parent long"),
    }


def rows(df):
    return sorted((r.teste, r.status, r.detalhe, r.data_execucao) for r in df.collect())


def test_equal_to_the_single_checks(spark, tables):
    c, s, p, e = (tables[n] for n in ("clients", "sales", "parts", "nothing"))
    got = keyed_checks(
        {
            "clients": TableChecks(c, not_empty=True, unique=["id"]),
            "sales": TableChecks(
                s,
                required=["sale", "client"],
                positive=[("positive", "value")],
                domains=[("kinds", "kind", ["A", "B"])],
                unique=["sale"],
                foreign=[("client", "clients", "id"), ("account", "clients", "id"), ("account", "nothing", "id")],
            ),
            "parts": TableChecks(p, unique=["a", "b"], foreign=[("a", "sales", "sale")]),
            "nothing": TableChecks(e, not_empty=True, required=["id"], unique=["id"], foreign=[("parent", "clients", "id")]),
        },
        RUN_TS,
    )
    want = [
        checks.check_not_empty(c, "clients", RUN_TS),
        checks.check_unique(c, "clients", ["id"], RUN_TS),
        checks.check_required(s, "sales", ["sale", "client"], RUN_TS),
        checks.check_positive(s, "positive", "value", RUN_TS),
        checks.check_domain(s, "kinds", "kind", ["A", "B"], RUN_TS),
        checks.check_unique(s, "sales", ["sale"], RUN_TS),
        checks.check_foreign_key(s, "sales", "client", c, "id", RUN_TS),
        checks.check_foreign_key(s, "sales", "account", c, "id", RUN_TS),
        checks.check_foreign_key(s, "sales", "account", e, "id", RUN_TS),
        checks.check_unique(p, "parts", ["a", "b"], RUN_TS),
        checks.check_foreign_key(p, "parts", "a", s, "sale", RUN_TS),
        checks.check_not_empty(e, "nothing", RUN_TS),
        checks.check_required(e, "nothing", ["id"], RUN_TS),
        checks.check_unique(e, "nothing", ["id"], RUN_TS),
        checks.check_foreign_key(e, "nothing", "parent", c, "id", RUN_TS),
    ]
    found = rows(got)
    assert found == rows(checks.union_results(want))
    details = {(r[0], r[2]) for r in found}
    assert ("Sem duplicidade: clients", "Grupos duplicados: 2") in details  # 7 and NULL; of 3, one row is current
    assert ("Integridade: sales.client", "Chaves órfãs: 10") in details
    assert ("Sem duplicidade: parts", "Grupos duplicados: 2") in details
    assert ("Tabela possui registros: nothing", "Quantidade: 0") in details


def test_one_scan_a_table_and_one_keyed_shuffle(spark, tables, tmp_path):
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    c, s = (spark.read.parquet(str(tmp_path / n)) for n in ("clients", "sales"))
    out = keyed_checks(
        {
            "clients": TableChecks(c, not_empty=True, unique=["id"]),
            "sales": TableChecks(s, required=["sale"], unique=["sale"], foreign=[("client", "clients", "id"), ("account", "clients", "id")]),
        },
        RUN_TS,
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Exchange") == 2  # and the one row of counts
    assert "value" not in plan and "kind" not in plan  # unused columns are not read


def test_parent_must_be_given(spark, tables):
    with pytest.raises(ValueError):
        keyed_checks({"sales": TableChecks(tables["sales"], foreign=[("client", "clients", "id")])}, RUN_TS)
