"""Rule accumulation and valid/invalid split (the original unit tests, plus first-match)."""

from pyspark.sql import functions as F

from stratum.functions.rules import accumulated_reasons, first_reason, tag_reasons
from stratum.operators.quality import split_by_null_reason, split_valid_invalid

SCHEMA = "id_cliente bigint not null, cpf string, renda double, estado string"


def rules():
    return [
        (F.col("cpf").isNull(), "CPF obrigatório"),
        (F.col("renda") < 0, "Renda negativa"),
        (F.col("estado").isNull(), "Estado obrigatório"),
    ]


def test_reasons_accumulate_in_rule_order(spark):
    df = spark.createDataFrame([(1, None, -100.0, None)], SCHEMA)
    row = tag_reasons(df, rules()).first()
    assert row["motivo_quarentena"] == "CPF obrigatório; Renda negativa; Estado obrigatório"


def test_clean_row_is_valid(spark):
    df = spark.createDataFrame([(1, "12345678901", 3000.0, "PE")], SCHEMA)
    valid, invalid = split_valid_invalid(tag_reasons(df, rules()))
    assert valid.count() == 1 and invalid.count() == 0
    assert "motivo_quarentena" not in valid.columns


def test_split_keeps_reason_on_invalid_side_only(spark):
    df = spark.createDataFrame([(1, "João", None), (2, "Maria", "CPF inválido")], "id_cliente bigint, nome string, motivo_quarentena string")
    valid, invalid = split_valid_invalid(df)
    assert [r["id_cliente"] for r in valid.collect()] == [1]
    assert "motivo_quarentena" not in valid.columns
    assert [(r["id_cliente"], r["motivo_quarentena"]) for r in invalid.collect()] == [(2, "CPF inválido")]


def test_blank_reason_counts_as_valid(spark):
    df = spark.createDataFrame([(1, "  "), (2, "")], "id bigint, motivo_quarentena string")
    valid, invalid = split_valid_invalid(df)
    assert valid.count() == 2 and invalid.count() == 0


def test_null_predicate_does_not_fire(spark):
    # length(NULL) != 11 is NULL: not a violation (same as the original rule)
    df = spark.createDataFrame([(None,)], "cpf string")
    out = df.select(accumulated_reasons([(F.length("cpf") != 11, "cpf inválido")]).alias("m")).first()
    assert out["m"] == ""


def test_first_reason_takes_first_match(spark):
    df = spark.createDataFrame([(None, -1), (5, -1), (5, 3)], "a int, b int")
    rs = [(F.col("a").isNull(), "A_NULO"), (F.col("b") <= 0, "B_NAO_POSITIVO")]
    got = [r["m"] for r in df.select(first_reason(rs).alias("m")).collect()]
    assert got == ["A_NULO", "B_NAO_POSITIVO", None]
    valid, invalid = split_by_null_reason(df.withColumn("motivo_quarentena", first_reason(rs)))
    assert valid.count() == 1 and invalid.count() == 2


def test_rejected_fields_read_the_record_back(spark):
    from stratum.operators.quality import rejected_fields

    texts = ['{"a b": 5, "v": 1.50}', '{"a b": "x"}', "no json", None]
    records = spark.createDataFrame([("m", t) for t in texts], "motivo string, registro_original string")
    rows = rejected_fields(records, {"a b": "int", "v": "decimal(9,2)"}).collect()
    assert [(r["a b"], r["v"] and str(r["v"])) for r in rows] == [(5, "1.50"), (None, None), (None, None), (None, None)]


def test_volume_alerts_take_the_median_of_earlier_loads(spark):
    from datetime import datetime, timedelta

    from stratum.operators.consistency import monitoring_alerts, volume_baseline

    volumes = [100, 102, 98, 100, 5000, 101, 99, 160, 0]
    loads = spark.createDataFrame(
        [("s", v, 10 if i == 3 else 0, datetime(2026, 1, 1) + timedelta(days=i)) for i, v in enumerate(volumes)],
        "fonte string, quantidade_entrada bigint, quantidade_invalidos bigint, data_processamento timestamp",
    )
    base = volume_baseline(loads).orderBy("data_processamento").collect()
    assert base[0]["referencia"] is None and base[0]["cargas_anteriores"] == 0
    assert (base[5]["referencia"], base[5]["desvio"]) == (100.0, 2.0)  # the outlier moves neither
    assert volume_baseline(loads, days=2).orderBy("data_processamento").collect()[6]["cargas_anteriores"] == 2
    runs = spark.createDataFrame(
        [("a", "SUCESSO", "t", 10.0), ("b", "ERRO", "t", 4000.0), ("c", None, "t", None)],
        "notebook string, status string, inicio string, duracao_segundos double",
    ).withColumn("inicio", F.lit(datetime(2026, 1, 9)))
    gate = spark.createDataFrame(
        [("Integridade: f.k", "REPROVADO"), ("Integridade: f.j", "APROVADO"), ("Campos", "REPROVADO")], "teste string, status string"
    ).withColumn("data_execucao", F.lit(datetime(2026, 1, 9)))
    found = sorted((r["alerta"], r["objeto"], r["valor"]) for r in monitoring_alerts(loads, runs, gate).select("alerta", "objeto", F.coalesce("valor", F.lit(-1.0)).alias("valor")).collect())
    assert found == [
        ("ALTA_TAXA_REJEICAO", "s", 0.1),
        ("CARGA_VAZIA", "s", 0.0),
        ("FALHA_EXECUCAO", "b", -1.0),
        ("FALHA_EXECUCAO", "c", -1.0),
        ("INTEGRIDADE_QUEBRADA", "Integridade: f.k", -1.0),
        ("TEMPO_EXCEDIDO", "b", 4000.0),
        ("VOLUME_ANORMAL", "s", 0.0),
        ("VOLUME_ANORMAL", "s", 160.0),
    ]
