"""Valid/invalid split and quarantine shaping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.columns import ts_literal
from stratum.settings import REASON_COLUMN


def has_reason(column: str = REASON_COLUMN) -> Column:
    """TRUE when the reason column holds a non-blank text (NULL reason = valid)."""
    return F.length(F.trim(F.coalesce(F.col(column), F.lit("")))) > 0


def split_valid_invalid(df: DataFrame, column: str = REASON_COLUMN) -> tuple[DataFrame, DataFrame]:
    """Two filters over one lineage; the valid side drops the reason column.

    When both sides are written, persist ``df`` first (or write both from one
    job with ``foreachBatch``) so the classification runs once.
    """
    flagged = has_reason(column)
    return df.filter(~flagged).drop(column), df.filter(flagged)


def split_by_null_reason(df: DataFrame, column: str = REASON_COLUMN) -> tuple[DataFrame, DataFrame]:
    """Split on a first-match reason code: NULL = valid."""
    return df.filter(F.col(column).isNull()).drop(column), df.filter(F.col(column).isNotNull())


def with_rejection_record(df: DataFrame, rule_set: str, run_ts, source_file: str = "arquivo_origem") -> DataFrame:
    """Documented rejection record: reason, rule set, date, file and the original payload as JSON."""
    payload_cols = [c for c in df.columns if c != REASON_COLUMN]
    file_col = F.col(source_file) if source_file in df.columns else F.lit(None).cast("string")
    return df.select(
        F.col(REASON_COLUMN).alias("motivo"),
        F.lit(rule_set).alias("regra"),
        ts_literal(run_ts, "timestamp").alias("data_rejeicao"),
        file_col.alias("arquivo"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in payload_cols])).alias("registro_original"),
    )


def rejected_fields(records: DataFrame, fields: Mapping[str, str], payload: str = "registro_original") -> DataFrame:
    """Rejection records with the named fields of the original record, typed, in place of its JSON text.

    ``fields`` maps a name to a type.  A field the record lacks, or that does
    not fit its type, is NULL, as are all fields of a text that is not JSON.
    """
    record = F.try_parse_json(payload)
    kept = [c for c in records.columns if c != payload]
    parsed = records.select(*kept, record.alias("__record"))
    typed = [F.try_variant_get("__record", f"$['{name}']", kind).alias(name) for name, kind in fields.items()]
    return parsed.select(*kept, *typed)
