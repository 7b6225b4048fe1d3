"""Raw readers: per-header union, corrupt records, JSON, lineage; file listing; ledger; stream."""

import uuid

from pyspark.sql import functions as F

from stratum.operators import ledger
from stratum.settings import SourceSpec
from stratum.sources.raw import add_lineage, list_files, read_raw


def write(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)


def test_headers_in_different_order_union_by_name(spark, scratch):
    src = scratch / "src"
    write(src, "a.csv", "id,valor\n1,10\n")
    write(src, "b.csv", "valor,id,extra\n20,2,x\n")
    rows = sorted((r["id"], r["valor"], r["extra"]) for r in read_raw(spark, str(src)).collect())
    assert rows == [("1", "10", None), ("2", "20", "x")]


def test_corrupt_csv_row_is_kept(spark, scratch):
    src = scratch / "bad"
    write(src, "a.csv", 'id,valor\n1,10\n2,"unterminated\n')
    df = read_raw(spark, str(src))
    assert df.count() == 2
    assert "_registro_corrompido" in df.columns


def test_json_lines_with_corrupt_line(spark, scratch):
    src = scratch / "json"
    write(src, "a.json", '{"id": 1, "v": 2.5}\n{broken\n')
    df = read_raw(spark, str(src), "json").cache()
    assert df.count() == 2
    assert df.filter(F.col("_registro_corrompido").isNotNull()).count() == 1
    assert dict(df.dtypes)["id"] == "string"


def test_unknown_format_is_rejected(spark):
    import pytest

    with pytest.raises(ValueError):
        read_raw(spark, "/nowhere", " Parquet ")


def test_lineage_and_listing(spark, scratch):
    src = scratch / "lin"
    write(src, "a.csv", "id\n1\n2\n")
    write(src, "_ignored.csv", "id\n9\n")
    write(src, ".hidden.csv", "id\n9\n")
    files = list_files(spark, str(src)).collect()
    assert [r["name"] for r in files] == ["a.csv"]
    out = add_lineage(read_raw(spark, str(src)), "b1", "v1").collect()
    assert {r["nome_arquivo_origem"] for r in out} == {"a.csv"}
    assert all(r["tamanho_arquivo_origem"] == 7 and len(r["hash_linha"]) == 64 for r in out)


def test_ledger_confirms_loaded_files(spark, scratch):
    pending = spark.createDataFrame([("dbfs:/raw/a.csv",), ("/raw/b.csv",)], "path string")
    bronze = spark.createDataFrame([("/raw/a.csv",), ("/raw/a.csv",), (None,)], "arquivo_origem string")
    loaded = ledger.loaded_files(bronze)
    from datetime import datetime

    rows = {r["caminho_origem"]: r["status_processamento"] for r in ledger.file_status(pending, loaded, "s", "bronze.s", datetime(2026, 1, 1), "/arq").collect()}
    assert rows == {"/raw/a.csv": "PROCESSADO", "/raw/b.csv": "NAO_CONFIRMADO"}


def test_file_stream_ingests_each_file_once_and_archives(spark, scratch):
    from stratum.streaming.file_stream import start_bronze_stream

    src, archive, ckpt = scratch / "in", scratch / "archive", scratch / "ckpt"
    write(src, "a.csv", "id,v\n1,a\n")
    db = f"s_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch / 'db'}'")
    spec = SourceSpec("x", str(src), "csv", f"{db}.x")

    def run():
        start_bronze_stream(spark, spec, spec.table, str(ckpt), archive_dir=str(archive), ledger_table=f"{db}.ledger", run_id="r").awaitTermination()

    run()
    write(src, "b.csv", "id,v,w\n2,b,z\n")
    run()
    run()  # nothing new: no rows added
    rows = sorted((r["id"], r["v"], r["w"]) for r in spark.table(spec.table).collect())
    assert rows == [("1", "a", None), ("2", "b", "z")]
    statuses = {r["nome_arquivo"]: r["status_processamento"] for r in spark.table(f"{db}.ledger").collect()}
    assert statuses == {"a.csv": "PROCESSADO", "b.csv": "PROCESSADO"}
    # the first file was archived once a later batch committed
    assert any(p.name == "a.csv" for p in archive.rglob("*.csv"))


def test_uniform_header_mode_reads_one_header(spark, scratch):
    src = scratch / "uni"
    write(src, "a.csv", "id,valor\n1,10\n")
    write(src, "b.csv", "id,valor\n2,20\n")
    rows = sorted((r["id"], r["valor"]) for r in read_raw(spark, str(src), uniform_header=True).collect())
    assert rows == [("1", "10"), ("2", "20")]
    explicit = read_raw(spark, str(src), header=["id", "valor"])
    assert explicit.count() == 2


def test_quoted_header_and_names_that_need_care(spark, scratch):
    src = scratch / "pasta com espaço +[1]"
    write(src, "a b.csv", '"id","nome, completo"\n1,"Ana, Maria"\n')
    write(src, "c+%2[0]{x}.csv", '\n"nome, completo" ,"id"\nJo,2\n')
    write(src, "vazio.csv", "")
    rows = read_raw(spark, str(src).replace("[", "\\[").replace("]", "\\]")).collect()
    assert sorted((r["id"], r["nome, completo"], r["_meta_name"]) for r in rows) == [
        ("1", "Ana, Maria", "a b.csv"),
        ("2", "Jo", "c+%2[0]{x}.csv"),
    ]
    assert all(r["_registro_corrompido"] is None for r in rows)
    listed = {r["path"] for r in list_files(spark, str(scratch) + "/pasta*").collect()}
    assert {r["_meta_path"] for r in rows} == listed  # Spark lists no empty file


def test_headers_are_cut_as_spark_cuts_them(spark):
    from stratum.sources.raw import header_columns

    assert header_columns(spark, '﻿id; "a;b" ;;id', ";") == ["id0", "a;b", "_c2", "id3"]


def test_rows_with_missing_or_extra_fields_are_kept_whole(spark, scratch):
    src = scratch / "ragged"
    write(src, "a.csv", "id,valor,uf\n1,10,SP\n2,20\n3,30,RJ,x\n")
    rows = {r["id"]: r["_registro_corrompido"] for r in read_raw(spark, str(src)).collect()}
    assert rows == {"1": None, "2": "2,20", "3": "3,30,RJ,x"}


def test_uniform_header_fails_on_another_header(spark, scratch):
    import pytest

    src = scratch / "swapped"
    write(src, "a.csv", "id,v\n10,20\n")
    write(src, "b.csv", "v,id\n20,10\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(src), uniform_header=True).collect()
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(src), header=["id", "v"]).collect()
    assert sorted((r["id"], r["v"]) for r in read_raw(spark, str(src)).collect()) == [("10", "20"), ("10", "20")]


def test_files_are_read_once(spark, scratch):
    src = scratch / "once"
    write(src, "a.csv", "id,v\n1,2\n")
    write(src, "b.csv", "id,v,w\n1,2,3\n")
    plan = read_raw(spark, str(src))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("InMemoryFileIndex(1 paths)") == 2  # one file each, no text scan
    assert "FileScan text" not in plan
