"""Runner behaviour: run log on failure, JSON-lines sources, empty sources."""

import csv
import json
import uuid
from datetime import datetime

import pytest

from conftest import FIXTURES
from stratum.plans import medallion
from stratum.settings import Settings, SourceSpec


def _settings(raw_root, **sources):
    sfx = uuid.uuid4().hex[:6]
    s = Settings(
        raw_root=str(raw_root),
        database_bronze=f"b_{sfx}",
        database_silver=f"s_{sfx}",
        database_gold=f"g_{sfx}",
        database_quarantine=f"q_{sfx}",
        database_control=f"c_{sfx}",
    )
    s.sources.update(sources)
    return s


def test_run_log_is_written_when_a_step_fails(spark, scratch, monkeypatch):
    s = _settings(FIXTURES / "raw")

    def boom(*a, **k):
        raise RuntimeError("falha simulada")

    monkeypatch.setattr(medallion, "run_gold", boom)
    with pytest.raises(RuntimeError):
        medallion.run_all(spark, s, batch_id="b", run_ts=datetime(2026, 3, 10))
    log = {r["notebook"]: (r["status"], r["erro"]) for r in spark.table(s.table("control", "execucoes_pipeline")).collect()}
    assert log["01_bronze"][0] == "SUCESSO" and log["03_prata"][0] == "SUCESSO"
    assert log["04_ouro"][0] == "ERRO" and "falha simulada" in log["04_ouro"][1]
    assert "05_qualidade" not in log


def test_json_source_and_empty_source(spark, scratch):
    jdir = scratch / "json" / "clientes"
    jdir.mkdir(parents=True)
    with open(FIXTURES / "raw" / "clientes" / "clientes_cdc_20260105.csv") as f:
        rows = list(csv.DictReader(f))
    (jdir / "clientes.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    (scratch / "empty").mkdir()
    s = _settings(scratch)
    s.sources = {
        "clientes": SourceSpec("clientes", str(jdir), "json", s.table("bronze", "clientes")),
        "contas": SourceSpec("contas", str(scratch / "empty"), "csv", s.table("bronze", "contas")),
    }
    result = {r["fonte"]: (r["status"], r["quantidade_registros"]) for r in medallion.run_bronze(spark, s, "b1", datetime(2026, 1, 1)).collect()}
    assert result == {"clientes": ("SUCESSO", 5), "contas": ("SEM_ARQUIVOS", 0)}
    bronze = spark.table(s.table("bronze", "clientes"))
    assert dict(bronze.dtypes)["renda"] == "string" and bronze.count() == 5


def test_bucketed_scd2_pipeline_matches(spark):
    s = _settings(FIXTURES / "raw")
    s.scd_buckets = 4
    run_ts = datetime(2026, 3, 10)
    medallion.run_bronze(spark, s, "b", run_ts)
    medallion.run_silver(spark, s, run_ts)
    for name, n in {"clientes": 5, "contas": 6, "cartoes": 6}.items():
        assert spark.table(s.table("silver", name)).filter("registro_atual").count() == n
    # a second run with the same inputs changes nothing
    before = sorted(map(str, spark.table(s.table("silver", "clientes")).collect()))
    medallion.run_silver(spark, s, datetime(2026, 3, 11))
    assert sorted(map(str, spark.table(s.table("silver", "clientes")).collect())) == before


def test_quality_gate_reports_every_check_when_tables_are_missing(spark):
    s = _settings(FIXTURES / "raw")
    results = medallion.run_checks(spark, s, datetime(2026, 1, 1))
    rows = results.collect()
    assert len(rows) == 38
    assert all(r["status"] == "REPROVADO" for r in rows)
    with pytest.raises(AssertionError):
        medallion.run_checks(spark, s, datetime(2026, 1, 1), raise_on_failure=True)
