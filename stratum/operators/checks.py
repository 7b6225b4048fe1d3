"""Data-quality checks that return result rows instead of printing.

A check is a one-row DataFrame ``(teste, status, detalhe, data_execucao)``.
Checks of one table can be fused into a single aggregation (``fused_checks``,
``table_profile``), so a table is scanned once for all its count-based checks;
``keyed_checks`` does so for all checks of several tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.columns import is_blank, not_in_domain, not_positive
from stratum.operators.dedupe import duplicate_groups
from stratum.operators.upsert import current_rows
from stratum.settings import CHECK_FAILED, CHECK_PASSED, SCD_CURRENT
from stratum.functions.columns import ts_literal

RESULT_SCHEMA = "teste string, status string, detalhe string, data_execucao timestamp"


def _result(counted: DataFrame, name: str, count_col: str, label: str, run_ts: datetime, ts_type: str) -> DataFrame:
    n = F.coalesce(F.col(count_col), F.lit(0))
    return counted.select(
        F.lit(name).alias("teste"),
        F.when(n == 0, F.lit(CHECK_PASSED)).otherwise(F.lit(CHECK_FAILED)).alias("status"),
        F.concat(F.lit(label + ": "), n.cast("string")).alias("detalhe"),
        ts_literal(run_ts, ts_type).alias("data_execucao"),
    )


def check_not_empty(df: DataFrame, table: str, run_ts: datetime, ts_type: str = "timestamp") -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.lit(f"Tabela possui registros: {table}").alias("teste"),
        F.when(F.col("n") > 0, F.lit(CHECK_PASSED)).otherwise(F.lit(CHECK_FAILED)).alias("status"),
        F.concat(F.lit("Quantidade: "), F.col("n").cast("string")).alias("detalhe"),
        ts_literal(run_ts, ts_type).alias("data_execucao"),
    )


def check_unique(df: DataFrame, table: str, keys: Sequence[str], run_ts: datetime, ts_type: str = "timestamp") -> DataFrame:
    """No key repeated among current rows (partial aggregation absorbs hot keys)."""
    dups = duplicate_groups(current_rows(df), keys).agg(F.count(F.lit(1)).alias("n"))
    return _result(dups, f"Sem duplicidade: {table}", "n", "Grupos duplicados", run_ts, ts_type)


def missing_required(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [is_blank(c) for c in columns])


def check_required(df: DataFrame, table: str, columns: Sequence[str], run_ts: datetime, ts_type: str = "timestamp") -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    spark = df.sparkSession
    if absent:
        return spark.createDataFrame(
            [(f"Campos obrigatórios: {table}", CHECK_FAILED, f"Colunas ausentes: {absent}", run_ts)], RESULT_SCHEMA
        ).withColumn("data_execucao", F.col("data_execucao").cast(ts_type))
    counted = df.agg(F.count_if(missing_required(columns)).alias("n"))
    return _result(counted, f"Campos obrigatórios preenchidos: {table}", "n", "Registros inválidos", run_ts, ts_type)


def orphan_keys(fact: DataFrame, fact_col: str, dim: DataFrame, dim_col: str) -> DataFrame:
    """Distinct non-null fact keys (as text) with no dimension row."""
    f = fact.select(F.col(fact_col).cast("string").alias("chave")).filter(F.col("chave").isNotNull()).distinct()
    d = dim.select(F.col(dim_col).cast("string").alias("chave")).filter(F.col("chave").isNotNull())
    return f.join(d, "chave", "left_anti")


def check_foreign_key(
    fact: DataFrame, fact_name: str, fact_col: str, dim: DataFrame, dim_col: str, run_ts: datetime, ts_type: str = "timestamp"
) -> DataFrame:
    counted = orphan_keys(fact, fact_col, dim, dim_col).agg(F.count(F.lit(1)).alias("n"))
    return _result(counted, f"Integridade: {fact_name}.{fact_col}", "n", "Chaves órfãs", run_ts, ts_type)


def check_positive(df: DataFrame, name: str, column: str, run_ts: datetime, ts_type: str = "timestamp") -> DataFrame:
    counted = df.agg(F.count_if(not_positive(column)).alias("n"))
    return _result(counted, name, "n", "Registros inválidos", run_ts, ts_type)


def check_domain(df: DataFrame, name: str, column: str, allowed: Sequence[str], run_ts: datetime, ts_type: str = "timestamp") -> DataFrame:
    counted = df.agg(F.count_if(not_in_domain(column, allowed)).alias("n"))
    return _result(counted, name, "n", "Registros inválidos", run_ts, ts_type)


def table_profile(
    df: DataFrame,
    required: Sequence[str] = (),
    positive: Sequence[str] = (),
    domains: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One scan, every count-based check of a table: rows, rows missing a
    required value, non-positive values per column, out-of-domain values."""
    aggs = [F.count(F.lit(1)).alias("linhas")]
    if required:
        aggs.append(F.count_if(missing_required(required)).alias("obrigatorios_ausentes"))
    aggs += [F.count_if(not_positive(c)).alias(f"nao_positivos_{c}") for c in positive]
    aggs += [F.count_if(not_in_domain(c, v)).alias(f"fora_dominio_{c}") for c, v in (domains or {}).items()]
    return df.agg(*aggs)


def union_results(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), results)


def assert_passed(results: DataFrame) -> None:
    """Raise when any check failed (reads only the small result frame)."""
    failed = [r["teste"] for r in results.filter(F.col("status") == CHECK_FAILED).select("teste").collect()]
    if failed:
        raise AssertionError("Falhas encontradas: " + ", ".join(failed))


def empty_results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT_SCHEMA)


def fused_checks(
    df: DataFrame,
    table: str,
    run_ts: datetime,
    not_empty: bool = False,
    required: Sequence[str] = (),
    positive: Sequence[tuple[str, str]] = (),
    domains: Sequence[tuple[str, str, Sequence[str]]] = (),
    ts_type: str = "timestamp",
) -> DataFrame:
    """Several count-based checks of one table from a single scan.

    One global aggregation computes every counter; ``inline`` turns the one
    result row into one check row each (same names and details as the
    individual checks).  ``positive`` is ``[(check name, column)]``,
    ``domains`` is ``[(check name, column, allowed values)]``.
    """
    counted = _counters(table, TableChecks(df, not_empty, required, positive, domains))
    if not counted:
        return empty_results(df.sparkSession)
    return _result_rows(df, [(check, F.count_if(condition)) for check, condition in counted], run_ts, ts_type)


class TableChecks(NamedTuple):
    """A table and what is to be checked of it."""

    df: DataFrame
    not_empty: bool = False
    required: Sequence[str] = ()
    positive: Sequence[tuple[str, str]] = ()  # (check name, column)
    domains: Sequence[tuple[str, str, Sequence[str]]] = ()  # (check name, column, allowed values)
    unique: Sequence[str] = ()  # key that current rows must not repeat
    foreign: Sequence[tuple[str, str, str]] = ()  # (column, parent table, parent column)


class _Check(NamedTuple):
    test: str
    label: str
    zero_passes: bool = True


def _counters(table: str, t: TableChecks) -> list[tuple[_Check, Column]]:
    """The count-based checks of a table, each with the condition of the rows it counts."""
    missing = [c for c in t.required if c not in t.df.columns]
    if missing:
        raise ValueError(f"{table}: required columns absent {missing}")
    out = []
    if t.not_empty:
        out.append((_Check(f"Tabela possui registros: {table}", "Quantidade", False), F.lit(True)))
    if t.required:
        out.append((_Check(f"Campos obrigatórios preenchidos: {table}", "Registros inválidos"), missing_required(t.required)))
    out += [(_Check(name, "Registros inválidos"), not_positive(c)) for name, c in t.positive]
    out += [(_Check(name, "Registros inválidos"), not_in_domain(c, allowed)) for name, c, allowed in t.domains]
    return out


def _result_rows(df: DataFrame, counted: Sequence[tuple[_Check, Column]], run_ts: datetime, ts_type: str) -> DataFrame:
    """A row per check from one global aggregation of ``df``."""
    rows = []
    for i, (check, _) in enumerate(counted):
        n = F.coalesce(F.col(f"n{i}"), F.lit(0))
        ok = (n == 0) if check.zero_passes else (n > 0)
        rows.append(
            F.struct(
                F.lit(check.test).alias("teste"),
                F.when(ok, F.lit(CHECK_PASSED)).otherwise(F.lit(CHECK_FAILED)).alias("status"),
                F.concat(F.lit(check.label + ": "), n.cast("string")).alias("detalhe"),
                ts_literal(run_ts, ts_type).alias("data_execucao"),
            )
        )
    aggs = [count.alias(f"n{i}") for i, (_, count) in enumerate(counted)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def _key_text(keys: Sequence[str]) -> Column:
    """A key as text; NULL for a NULL key of one column."""
    parts = [F.col(f"`{k}`").cast("string") for k in keys]
    return parts[0] if len(parts) == 1 else F.to_json(F.array(*parts))


def keyed_checks(tables: Mapping[str, TableChecks], run_ts: datetime, ts_type: str = "timestamp") -> DataFrame:
    """All checks of several tables from one scan of each and one keyed aggregate.

    Every row gives its keys, and under no key its table's counters, to one
    union.  Grouped by key, the uses of a key tell whether its table repeats
    it and whether a child refers to it in vain, so a key is sent once for both
    checks.  Repeated keys and all counters are summed before the shuffle: a
    hot key, NULL included, sends one row a task.

    Names and details are those of the single checks.  Keys are compared as
    text.  A NULL key counts for uniqueness and never as an orphan.  Parents
    must be in ``tables``; an empty table has zero counts.
    """
    spaces: dict[tuple[str, tuple[str, ...]], int] = {}  # (table, key) -> number of its key space
    children: dict[int, list[tuple[str, str]]] = {}  # key space -> (table, column) that refer to it
    for name, t in tables.items():
        if t.unique:
            spaces.setdefault((name, tuple(t.unique)), len(spaces))
        for column, parent, parent_column in t.foreign:
            if parent not in tables:
                raise ValueError(f"{name}.{column}: parent table {parent} is not among the tables")
            space = spaces.setdefault((parent, (parent_column,)), len(spaces))
            children.setdefault(space, []).append((name, column))
    counters = {name: _counters(name, t) for name, t in tables.items()}
    width = max([2, *map(len, counters.values())])

    def entry(space: int, use: int, key: Column, conditions: Sequence[Column]) -> Column:
        padded = [*conditions, *[F.lit(False)] * (width - len(conditions))]
        ones = [F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long").alias(f"c{i}") for i, c in enumerate(padded)]
        return F.struct(F.lit(space).alias("space"), F.lit(use).alias("use"), key.alias("key"), *ones)

    frames, results = [], []
    space_col, key_col = F.col("space"), F.col("key")
    for number, (name, t) in enumerate(tables.items(), 1):
        entries = []
        if counters[name]:
            entries.append(entry(-number, 0, F.lit(None).cast("string"), [condition for _, condition in counters[name]]))
            for i, (check, _) in enumerate(counters[name]):
                results.append((check, F.sum(F.when(space_col == -number, F.col(f"c{i}")))))
        current = F.col(SCD_CURRENT) if SCD_CURRENT in t.df.columns else F.lit(True)
        for (parent, keys), space in spaces.items():
            if parent == name:
                entries.append(entry(space, 0, _key_text(keys), [F.lit(True), current]))
        if t.unique:
            repeated = (space_col == spaces[name, tuple(t.unique)]) & (F.col("current_rows") > 1)
            results.append((_Check(f"Sem duplicidade: {name}", "Grupos duplicados"), F.count_if(repeated)))
        for space, referring in children.items():
            for use, (child, column) in enumerate(referring, 1):
                if child == name:
                    entries.append(entry(space, use, _key_text([column]), [F.lit(True)]))
                    orphan = (space_col == space) & key_col.isNotNull() & (F.col(f"use{use}") > 0) & (F.col("use0") == 0)
                    results.append((_Check(f"Integridade: {name}.{column}", "Chaves órfãs"), F.count_if(orphan)))
        if entries:
            frames.append(t.df.select(F.inline(F.array(*entries))))
    if not results:
        raise ValueError("no checks")
    uses = 1 + max(map(len, children.values()), default=0)
    of_use = lambda use, c: F.sum(F.when(F.col("use") == use, F.col(c)).otherwise(F.lit(0)))
    per_key = union_results(frames).groupBy("space", "key").agg(
        *[F.sum(f"c{i}").alias(f"c{i}") for i in range(width)],
        *[of_use(use, "c0").alias(f"use{use}") for use in range(uses)],
        of_use(0, "c1").alias("current_rows"),
    )
    return _result_rows(per_key, results, run_ts, ts_type)
