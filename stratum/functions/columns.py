"""Column expressions: parsing, standardisation and predicates.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen and push down wherever Catalyst can push them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from stratum.settings import FINGERPRINT_NULL, FINGERPRINT_SEPARATOR

ColumnOrName = Column | str

# Number formats accepted by the decimal parser.
# "1.234,56" (dots group thousands, comma marks decimals) and "1234,56".
GROUPED_COMMA_DECIMAL = r"^-?[0-9]{1,3}(\.[0-9]{3})+,[0-9]+$"
PLAIN_COMMA_DECIMAL = r"^-?[0-9]+,[0-9]+$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: datetime, target: str | DataType = "timestamp") -> Column:
    """A run time as a timestamp literal.

    Built from its text, so a naive datetime means the same wall-clock time
    whatever the Python process's time zone (``F.lit(datetime)`` would use it);
    a ``timestamp`` target is read in the session time zone.  Aware datetimes
    are converted to UTC first.
    """
    if value.tzinfo is not None:
        from datetime import timezone

        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(target)


def text(c: ColumnOrName) -> Column:
    """Trimmed string form of any column."""
    return F.trim(_col(c).cast("string"))


def parse_decimal(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    """Locale-aware decimal: ``1.234,56`` and ``1234,56`` read as 1234.56.

    Anything else is cast as is; text that cannot be read or overflows the type
    becomes NULL (``try_cast``), never an error.
    """
    t = text(c)
    normalised = (
        F.when(~t.contains(","), t)  # both patterns hold a comma
        .when(t.rlike(GROUPED_COMMA_DECIMAL), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(t.rlike(PLAIN_COMMA_DECIMAL), F.replace(t, F.lit(","), F.lit(".")))
        .otherwise(t)
    )
    return normalised.try_cast(DecimalType(precision, scale))


def comma_decimal(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    """Simpler parser: every comma becomes a dot, then ``try_cast`` (so ``1.234,56`` is NULL)."""
    return F.replace(_col(c).cast("string"), F.lit(","), F.lit(".")).try_cast(DecimalType(precision, scale))


def safe_timestamp(c: ColumnOrName, target: str = "timestamp") -> Column:
    """Malformed-safe timestamp: unreadable text gives NULL instead of an ANSI error."""
    return _col(c).try_cast(target)


def timestamp_or(c: ColumnOrName, fallback: datetime | Column, target: str = "timestamp") -> Column:
    """Timestamp, or the given run time when the text cannot be read."""
    fb = fallback if isinstance(fallback, Column) else ts_literal(fallback, target)
    return F.coalesce(safe_timestamp(c, target), fb)


def timestamp_fallback(
    primary: ColumnOrName,
    secondary: ColumnOrName,
    run_ts: datetime | Column,
    target: str = "timestamp",
) -> Column:
    """Own timestamp, else the ingestion date, else the run time."""
    return F.coalesce(safe_timestamp(primary, target), safe_timestamp(secondary, target), timestamp_or(F.lit(None), run_ts, target))


def optional_column(df: DataFrame, name: str, dtype: str | DataType, safe: bool = True) -> Column:
    """The column cast to ``dtype`` if the frame has it, else a typed NULL."""
    if name in df.columns:
        c = F.col(f"`{name}`")
        return (c.try_cast(dtype) if safe else c.cast(dtype)).alias(name)
    return F.lit(None).cast(dtype).alias(name)


def is_blank(c: ColumnOrName) -> Column:
    """NULL or only spaces (any type, compared as text)."""
    c = _col(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def not_in_domain(c: ColumnOrName, allowed: Iterable[str]) -> Column:
    """NULL or outside the allowed values (NULL counts as a violation)."""
    c = _col(c)
    return c.isNull() | ~c.isin(list(allowed))


def not_positive(c: ColumnOrName) -> Column:
    """NULL or <= 0."""
    c = _col(c)
    return c.isNull() | (c <= 0)


def digits_only(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), r"\D", "")


def normalize_path(c: ColumnOrName) -> Column:
    """Trimmed path without a leading ``dbfs:`` scheme; NULL becomes ''."""
    return F.coalesce(F.regexp_replace(F.trim(_col(c)), r"^dbfs:", ""), F.lit(""))


def row_fingerprint(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """SHA-256 of the row: columns sorted by name, as text, NULL as a marker, joined."""
    names = sorted(c for c in df.columns if c not in set(exclude))
    parts = [F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(FINGERPRINT_NULL)) for n in names]
    return F.sha2(F.concat_ws(FINGERPRINT_SEPARATOR, *parts), 256)


def half_up_percent(numerator: str, denominator: str, unscale: int = 1) -> Column:
    """``round(numerator / denominator * 100, 2)`` with exact HALF_UP, as DOUBLE.

    Both columns are scaled to integers (``unscale`` = 100 for money with two
    decimals, 1 for counts) and divided with integer ``div``, so the result does
    not depend on floating point or on the scale of decimal division.  Callers
    guard ``denominator > 0``.
    """
    n = f"CAST(`{numerator}` * {unscale} AS DECIMAL(38,0))"
    d = f"CAST(`{denominator}` * {unscale} AS DECIMAL(38,0))"
    hundredths = f"((abs({n}) * 20000 + abs({d})) div (2 * abs({d})))"
    return F.expr(f"CAST(CASE WHEN {n} < 0 THEN -{hundredths} ELSE {hundredths} END AS DOUBLE) / 100")
