"""Run metrics: per-source quality counts, layer row counts, step run log."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.quality import has_reason
from stratum.functions.columns import ts_literal
from stratum.settings import REASON_COLUMN

METRICS_SCHEMA = "fonte string, quantidade_entrada bigint, quantidade_validos bigint, quantidade_invalidos bigint, data_processamento timestamp"
RUN_LOG_SCHEMA = "notebook string, status string, inicio string, fim string, duracao_segundos double, retorno string, erro string"


# Key of each source: valid rows are counted after latest-per-key dedupe.
SOURCE_KEYS = {
    "clientes": ("id_cliente",),
    "contas": ("id_conta",),
    "cartoes": ("id_cartao",),
    "transacoes": ("id_transacao",),
    "eventos_risco": ("id_evento",),
    "estornos": ("id_estorno",),
}


def quality_metrics(
    source: str,
    classified: DataFrame,
    run_ts: datetime,
    reason: str = REASON_COLUMN,
    ts_type: str = "timestamp",
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Input / valid / invalid counts of a classified frame in one aggregation
    (instead of three separate counts that each recompute the lineage).

    Valid rows are counted as they land in silver, i.e. after keeping the
    latest row per key: the number of distinct keys among unflagged rows
    (valid rows never have a NULL key -- the rules quarantine them).  Invalid
    rows are counted as they are.
    """
    flagged = has_reason(reason)
    keys = list(keys) if keys is not None else list(SOURCE_KEYS.get(source, ()))
    if keys:
        key = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
        valid = F.count_distinct(F.when(~flagged, key))
    else:
        valid = F.count_if(~flagged)
    return classified.agg(
        F.count(F.lit(1)).alias("quantidade_entrada"),
        valid.alias("quantidade_validos"),
        F.count_if(flagged).alias("quantidade_invalidos"),
    ).select(
        F.lit(source).alias("fonte"),
        "quantidade_entrada",
        "quantidade_validos",
        "quantidade_invalidos",
        ts_literal(run_ts, ts_type).alias("data_processamento"),
    )


def layer_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Row count per table; a missing table (None) is reported with NULL count."""
    frames = []
    spark = None
    for name, df in tables.items():
        if df is None:
            continue
        spark = df.sparkSession
        frames.append(df.agg(F.count(F.lit(1)).alias("quantidade")).select(F.lit(name).alias("tabela"), "quantidade", F.lit(True).alias("existe")))
    missing = [n for n, df in tables.items() if df is None]
    out = reduce(lambda a, b: a.unionByName(b), frames) if frames else None
    if missing and spark is not None:
        m = spark.createDataFrame([(n, None, False) for n in missing], "tabela string, quantidade bigint, existe boolean")
        out = m if out is None else out.unionByName(m)
    return out


class RunLog:
    """Step run log: name, status, start, end, seconds, return value, error.

    Rows are control data (one per step); ``frame()`` turns them into a
    DataFrame with an explicit schema, written even when a step fails.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.rows: list[tuple] = []

    @contextmanager
    def step(self, name: str):
        start = datetime.now(timezone.utc)
        t0 = time.monotonic()
        box: dict = {}
        try:
            yield box
            status, error = "SUCESSO", None
        except Exception as e:  # recorded, then re-raised
            status, error = "ERRO", f"{type(e).__name__}: {e}"
            raise
        finally:
            end = datetime.now(timezone.utc)
            self.rows.append((name, status, start.isoformat(), end.isoformat(), time.monotonic() - t0, str(box.get("retorno")) if box.get("retorno") is not None else None, error))

    def run(self, name: str, fn: Callable[[], object]):
        with self.step(name) as box:
            box["retorno"] = fn()
            return box["retorno"]

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, RUN_LOG_SCHEMA)
