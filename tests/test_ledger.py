"""File batches, ledger step and reconciliation: crashes between the writes, moves, all statuses."""

import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratum.operators import ledger
from stratum.plans import medallion
from stratum.settings import Settings, SourceSpec
from stratum.sinks import tables as sink

T0 = datetime(2026, 3, 1, 8)


@pytest.fixture()
def lake(spark, scratch):
    mark = uuid.uuid4().hex[:6]
    source = scratch / "entrada" / "clientes"
    source.mkdir(parents=True)
    settings = Settings(
        raw_root=str(scratch / "entrada"),
        database_bronze=f"lb_{mark}",
        database_control=f"lc_{mark}",
        sources={"clientes": SourceSpec("clientes", str(source), "csv", f"lb_{mark}.clientes")},
        archive_root=str(scratch / "processados"),
        max_files_per_batch=2,
    )
    return settings, source


def bronze(spark, settings):
    return sorted((r["id"], r["v"]) for r in spark.table(f"{settings.database_bronze}.clientes").collect())


def ledger_rows(spark, settings):
    rows = spark.table(settings.table("control", "controle_arquivos_processados")).collect()
    return sorted((r["nome_arquivo"], r["status_processamento"], (r["caminho_destino"] or "").rpartition("/")[2]) for r in rows)


def test_two_runs_leave_all_tables_alike(spark, lake):
    settings, source = lake
    for i in range(5):
        (source / f"parte {i}.csv").write_text(f'"id","v"\n{i},x\n')
    (source / "cabecalho.csv").write_text("id,v\n")  # no row
    result = medallion.ingest_source(spark, settings, "clientes", "lote", T0)
    assert result[1] == "SUCESSO" and result[3] == 5
    medallion.run_ledger(spark, settings, T0)
    state = (bronze(spark, settings), ledger_rows(spark, settings))
    assert state[0] == [(str(i), "x") for i in range(5)]
    moved = [(f"parte {i}.csv", "PROCESSADO", f"parte {i}.csv") for i in range(5)]
    assert state[1] == [("cabecalho.csv", "NAO_CONFIRMADO", ""), *moved]
    assert [p.name for p in source.glob("*.csv")] == ["cabecalho.csv"]
    again = medallion.ingest_source(spark, settings, "clientes", "lote2", T0 + timedelta(days=1))
    assert again[1] == "SEM_ARQUIVOS"
    assert medallion.run_ledger(spark, settings, T0 + timedelta(days=1)).count() == 0
    assert state == (bronze(spark, settings), ledger_rows(spark, settings))
    # the same name with new content is a new file, and its namesake keeps its place
    (source / "parte 1.csv").write_text("id,v\n9,new\n")
    medallion.ingest_source(spark, settings, "clientes", "lote3", T0 + timedelta(days=2))
    medallion.run_ledger(spark, settings, T0 + timedelta(days=2))
    assert ("9", "new") in bronze(spark, settings) and len(bronze(spark, settings)) == 6
    assert ("parte 1.csv", "PROCESSADO", "parte 1_20260303_080000_000000.csv") in ledger_rows(spark, settings)


@pytest.mark.parametrize("step", ["read_raw", "replace_partition", "commit"])
def test_crash_between_the_writes(spark, lake, monkeypatch, step):
    settings, source = lake
    for i in range(3):
        (source / f"{i}.csv").write_text(f"id,v\n{i},x\n")

    def crash(*_args, **_kw):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        if step == "commit":
            m.setattr(ledger, "commit_rows", crash)
        elif step == "read_raw":
            m.setattr(medallion, "read_raw", crash)
        else:
            m.setattr(sink, "replace_partition", crash)
        with pytest.raises(RuntimeError, match="crash"):
            medallion.ingest_source(spark, settings, "clientes", "a", T0)
    medallion.ingest_source(spark, settings, "clientes", "b", T0 + timedelta(hours=1))
    assert bronze(spark, settings) == [("0", "x"), ("1", "x"), ("2", "x")]
    log = spark.table(settings.table("control", "lotes_arquivos"))
    assert ledger.interrupted_batches(log).count() == 0
    assert ledger.log_stage(log, ledger.COMMITTED).count() == 3


def test_moves_interrupted_or_refused(spark, lake, monkeypatch):
    settings, source = lake
    (source / "a.csv").write_text("id,v\n1,x\n")
    (source / "b.csv").write_text("id,v\n2,x\n")
    medallion.ingest_source(spark, settings, "clientes", "a", T0)
    with monkeypatch.context() as m:
        m.setattr(medallion, "move_files", lambda *_: None)
        medallion.run_ledger(spark, settings, T0)
    assert {s for _, s, _ in ledger_rows(spark, settings)} == {"ERRO_MOVIMENTACAO"}
    medallion.run_ledger(spark, settings, T0 + timedelta(hours=1))
    latest = ledger_rows(spark, settings)
    assert [r for r in latest if r[1] == "PROCESSADO"] == [("a.csv", "PROCESSADO", "a.csv"), ("b.csv", "PROCESSADO", "b.csv")]
    # one is taken away, and a stranger laid into the archive
    (source.parents[1] / "processados" / "clientes" / "b.csv").rename(source.parents[1] / "away.csv")
    (source.parents[1] / "processados" / "clientes" / "z.csv").write_text("id,v\n")
    assert medallion.run_ledger(spark, settings, T0 + timedelta(hours=2)).count() == 2
    assert {(n, s) for n, s, _ in ledger_rows(spark, settings)} >= {("b.csv", "ERRO"), ("z.csv", "ERRO")}


def test_interrupted_batch_whose_file_is_gone_is_told(spark, lake, monkeypatch):
    settings, source = lake
    (source / "a.csv").write_text("id,v\n1,x\n")
    with monkeypatch.context() as m:
        m.setattr(sink, "replace_partition", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            medallion.ingest_source(spark, settings, "clientes", "a", T0)
    (source / "a.csv").rename(source.parents[1] / "a.csv")
    with pytest.raises(RuntimeError, match="is gone"):
        medallion.ingest_source(spark, settings, "clientes", "b", T0)


def test_without_archive_files_stay(spark, lake):
    settings, source = lake
    settings.archive_root = None
    (source / "a.csv").write_text("id,v\n1,x\n")
    medallion.ingest_source(spark, settings, "clientes", "a", T0)
    rows = medallion.run_ledger(spark, settings, T0).collect()
    assert [(r["status_processamento"], r["caminho_destino"] == r["caminho_origem"]) for r in rows] == [("PROCESSADO", True)]
    assert (source / "a.csv").exists()


def test_bronze_is_not_scanned_for_pending_files(spark, lake):
    settings, source = lake
    (source / "a.csv").write_text("id,v\n1,x\n")
    medallion.ingest_source(spark, settings, "clientes", "a", T0)
    pending = ledger.pending_files(medallion._listing(spark, str(source)), medallion._file_log(spark, settings, "clientes"))
    assert "clientes" not in pending._jdf.queryExecution().executedPlan().toString().replace("entrada/clientes", "").replace("= clientes", "").replace(",clientes)", "")
    assert pending.filter(F.col("tamanho") > 0).count() == 0
