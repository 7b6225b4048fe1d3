"""Documented consistency rules: referential, temporal and financial.

Each returns the violating rows (empty = rule holds), so the same frame feeds
a quarantine, a report or a data-quality check.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.columns import not_in_domain

# Violation codes of the consistency rules.
MISSING_TRANSACTION = "TRANSACAO_INEXISTENTE"
REFUND_BEFORE_TRANSACTION = "ESTORNO_ANTES_DA_TRANSACAO"
REFUNDED_ABOVE_VALUE = "ESTORNO_ACIMA_DO_VALOR"
HIGH_REJECT_RATE = "ALTA_TAXA_REJEICAO"
EMPTY_LOAD = "CARGA_VAZIA"


def missing_parent(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose (non-null) parent key has no parent row."""
    parents = parent.select(F.col(parent_key).alias("__pk")).filter(F.col("__pk").isNotNull())
    return child.filter(F.col(child_key).isNotNull()).join(parents, F.col(child_key) == F.col("__pk"), "left_anti")


def outside_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Rows whose ``column`` is NULL or not one of ``domain`` (a status, say)."""
    return df.filter(not_in_domain(column, domain))


def refund_timing(refunds: DataFrame, transactions: DataFrame) -> DataFrame:
    """Refunds of unknown transactions, or dated before their transaction."""
    t = transactions.select(F.col("id_transacao").alias("__tid"), F.col("data_transacao"))
    joined = refunds.join(t, refunds["id_transacao"] == t["__tid"], "left")
    code = (
        F.when(F.col("__tid").isNull(), F.lit(MISSING_TRANSACTION))
        .when(F.col("data_estorno") < F.col("data_transacao"), F.lit(REFUND_BEFORE_TRANSACTION))
    )
    return joined.select("id_estorno", "id_transacao", "data_estorno", "data_transacao", code.alias("violacao")).filter(
        F.col("violacao").isNotNull()
    )


def refunded_above_value(refunds: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transactions whose refunds add up to more than their value.

    Refunds are summed per transaction first (partial aggregation), so the join
    sees one row per refunded transaction.
    """
    per_tx = refunds.groupBy("id_transacao").agg(
        F.sum("valor_estorno").cast("decimal(38,2)").alias("valor_estornado"), F.count(F.lit(1)).alias("quantidade_estornos")
    )
    t = transactions.select("id_transacao", F.col("valor").cast("decimal(38,2)").alias("valor"))
    return per_tx.join(t, "id_transacao", "inner").filter(F.col("valor_estornado") > F.col("valor")).select(
        "id_transacao", "valor", "valor_estornado", "quantidade_estornos", F.lit(REFUNDED_ABOVE_VALUE).alias("violacao")
    )


def reject_rate_alerts(metrics: DataFrame, max_reject_rate: float = 0.05) -> DataFrame:
    """Alerts from the quality metrics: empty loads and reject rates above the threshold."""
    rate = F.col("quantidade_invalidos") / F.col("quantidade_entrada")
    code = (
        F.when(F.col("quantidade_entrada") == 0, F.lit(EMPTY_LOAD))
        .when(rate > F.lit(max_reject_rate), F.lit(HIGH_REJECT_RATE))
    )
    return metrics.select(
        "fonte",
        code.alias("alerta"),
        "quantidade_entrada",
        "quantidade_invalidos",
        "data_processamento",
    ).filter(F.col("alerta").isNotNull())


# Codes of the monitoring alerts, with the two above.
RUN_FAILED = "FALHA_EXECUCAO"
TIME_EXCEEDED = "TEMPO_EXCEDIDO"
ABNORMAL_VOLUME = "VOLUME_ANORMAL"
BROKEN_INTEGRITY = "INTEGRIDADE_QUEBRADA"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _median(values: Column) -> Column:
    """Median of an array of doubles without nulls; NULL for an empty one."""
    low, high = F.floor((F.size(values) - 1) / 2).cast("int"), F.floor(F.size(values) / 2).cast("int")
    return _bound(F.sort_array(values), lambda v: (F.get(v, low) + F.get(v, high)) / 2)


def _robust(values: Column) -> Column:
    """Median and median absolute deviation of an array of doubles."""

    def deviation(middle: Column) -> Column:
        off = F.transform(values, lambda x: F.abs(x - middle))
        return F.struct(middle.alias("referencia"), _median(off).alias("desvio"))

    return _bound(_median(values), deviation)


def volume_baseline(metrics: DataFrame, days: int = 28) -> DataFrame:
    """``metrics`` with the median and the median absolute deviation of the source's earlier loads.

    ``referencia`` and ``desvio`` are of ``quantidade_entrada`` over the loads
    of the ``days`` before (a range frame, so uneven schedules are right), and
    ``cargas_anteriores`` how many these are.  One outlier moves neither.
    """
    seconds = F.unix_seconds(F.col("data_processamento").cast("timestamp"))
    frame = Window.partitionBy("fonte").orderBy("__s").rangeBetween(-days * 86400, -1)
    earlier = metrics.withColumn("__s", seconds).withColumn(
        "__earlier", F.collect_list(F.col("quantidade_entrada").cast("double")).over(frame)
    )
    return (
        earlier.withColumn("__robust", _robust(F.col("__earlier")))
        .withColumns({"referencia": F.col("__robust.referencia"), "desvio": F.col("__robust.desvio")})
        .withColumn("cargas_anteriores", F.size("__earlier"))
        .drop("__s", "__earlier", "__robust")
    )


def monitoring_alerts(
    metrics: DataFrame,
    runs: DataFrame,
    checks: DataFrame,
    *,
    max_reject_rate: float = 0.05,
    max_seconds: float = 3600,
    deviations: float = 5.0,
    least_share: float = 0.1,
    least_loads: int = 5,
    days: int = 28,
) -> DataFrame:
    """``alerta, objeto, momento, valor, referencia``: all alerts over the run history.

    From the quality metrics: an empty load, a reject rate above
    ``max_reject_rate``, and a volume off its baseline by more than
    ``deviations`` times the median deviation, ``least_share`` of the median at
    least, once ``least_loads`` loads precede it.  From the run log: a run that
    failed, and one longer than ``max_seconds``.  From the quality gate: a
    referential check that did not pass.
    """
    base = volume_baseline(metrics, days)
    volume, rate = F.col("quantidade_entrada").cast("double"), F.col("quantidade_invalidos") / F.col("quantidade_entrada")
    allowed = F.greatest(F.lit(deviations) * F.col("desvio"), F.lit(least_share) * F.col("referencia"))
    abnormal = (F.col("cargas_anteriores") >= least_loads) & (F.abs(volume - F.col("referencia")) > allowed)

    def rows(df: DataFrame, code: str, where: Column, thing: str, moment: str, value: Column, reference: Column) -> DataFrame:
        return df.filter(where).select(
            F.lit(code).alias("alerta"),
            F.col(thing).alias("objeto"),
            F.col(moment).alias("momento"),
            value.cast("double").alias("valor"),
            reference.cast("double").alias("referencia"),
        )

    nothing = F.lit(None)
    load = ("fonte", "data_processamento")
    alerts = [
        rows(base, EMPTY_LOAD, F.col("quantidade_entrada") == 0, *load, volume, nothing),
        rows(base, HIGH_REJECT_RATE, (F.col("quantidade_entrada") > 0) & (rate > max_reject_rate), *load, rate, F.lit(max_reject_rate)),
        rows(base, ABNORMAL_VOLUME, abnormal, *load, volume, F.col("referencia")),
        rows(runs, RUN_FAILED, ~F.col("status").eqNullSafe("SUCESSO"), "notebook", "inicio", nothing, nothing),
        rows(runs, TIME_EXCEEDED, F.col("duracao_segundos") > max_seconds, "notebook", "inicio", F.col("duracao_segundos"), F.lit(max_seconds)),
        rows(
            checks,
            BROKEN_INTEGRITY,
            F.col("teste").startswith("Integridade") & (F.col("status") != "APROVADO"),
            "teste",
            "data_execucao",
            nothing,
            nothing,
        ),
    ]
    out = alerts[0]
    for more in alerts[1:]:
        out = out.unionByName(more)
    return out
