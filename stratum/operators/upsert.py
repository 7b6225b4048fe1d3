"""MERGE upsert and SCD type 2 as pure DataFrame transforms.

Both return the full new state of the target (or of its current partition) in
one shuffle join; the sinks decide how to commit it.  Run time is a parameter,
so re-running with the same inputs gives the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.settings import SCD_CURRENT, SCD_END, SCD_START
from stratum.functions.columns import ts_literal

_S = "__src_"
_T = "__tgt_"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _null_safe_keys(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [_q(_S + k).eqNullSafe(_q(_T + k)) for k in keys])


def _prefixed(df: DataFrame, prefix: str, marker: str) -> DataFrame:
    return df.select(*[_q(c).alias(prefix + c) for c in df.columns], F.lit(True).alias(marker))


def merge_upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, Column | str] | Sequence[str] | None = None,
) -> DataFrame:
    """``MERGE INTO target USING source ON keys``: matched rows get ``update``
    (default: every source column), unmatched source rows are inserted (columns
    the source lacks become NULL), unmatched target rows stay.

    Keys match with ``=`` (a NULL key never matches, as in SQL MERGE).  The
    source must have unique keys (see ``sinks.assert_unique_keys``); otherwise
    one target row would be updated twice.
    """
    if target is None:
        return source
    cols = target.columns
    if update is None:
        update = [c for c in source.columns if c in cols]
    if not isinstance(update, Mapping):
        update = {c: _q(_S + c) for c in update}
    else:
        update = {c: (F.expr(v) if isinstance(v, str) else v) for c, v in update.items()}

    # text updates name the sides ``origem.`` and ``destino.``; each side also has
    # its row as a struct of that name, so Spark resolves them, literals included
    s = _prefixed(source, _S, "__in_src").withColumn("origem", F.struct(*[_q(_S + c).alias(c) for c in source.columns]))
    t = _prefixed(target, _T, "__in_tgt").withColumn("destino", F.struct(*[_q(_T + c).alias(c) for c in target.columns]))
    cond = reduce(lambda a, b: a & b, [_q(_S + k) == _q(_T + k) for k in keys])
    joined = t.join(s, cond, "full_outer")
    matched = F.col("__in_src").isNotNull() & F.col("__in_tgt").isNotNull()
    source_only = F.col("__in_tgt").isNull()

    out = []
    for c in cols:
        inserted = _q(_S + c) if c in source.columns else F.lit(None)
        value = F.when(source_only, inserted)
        if c in update:
            value = value.when(matched, update[c])
        out.append(value.otherwise(_q(_T + c)).cast(target.schema[c].dataType).alias(c))
    return joined.select(*out)


def scd2_apply(
    active: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    run_ts: datetime,
    start: str = SCD_START,
    end: str = SCD_END,
    current: str = SCD_CURRENT,
    ts_type: str = "timestamp",
    effective_from: str | None = None,
    delete_when: Column | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """One-pass SCD2 over the *active* versions.

    ``active FULL OUTER JOIN source ON keys (null-safe)``, then per key:

    * changed (any compare column differs, null-safe): the active row closed at
      ``run_ts`` plus the source row opened at ``run_ts``;
    * source only: the source row opened at ``run_ts``;
    * unchanged or target only: the active row as is.

    Options: ``effective_from`` names a source column whose value opens the new
    version and closes the old one (instead of the run time);
    ``delete_when`` is a predicate over source columns marking a delete: the
    active version is closed and no new one is opened.

    ``null_safe=False`` joins with plain equality: use it when keys cannot be
    NULL (silver quarantines NULL ids), so a target bucketed by its keys is
    joined without being shuffled.

    Returns rows with ``current`` TRUE (the new active set) and FALSE (versions
    closed by this run, to append to history).  Source columns named like the
    validity columns are ignored.
    """
    ts = ts_literal(run_ts, ts_type)
    scd = {start, end, current}
    src_cols = [c for c in source.columns if c not in scd]
    extra = []
    if effective_from is not None:
        extra.append(F.coalesce(_q(effective_from).cast(ts_type), ts).alias("__eff"))
    if delete_when is not None:
        extra.append(F.coalesce(delete_when, F.lit(False)).alias("__del"))
    source = source.select(*[_q(c) for c in src_cols], *extra)
    if active is None:
        live = source.filter(~F.col("__del")) if delete_when is not None else source
        opened_at = F.col("__eff") if effective_from is not None else ts
        return live.select(
            *[_q(c) for c in src_cols],
            opened_at.alias(start),
            F.lit(None).cast(ts_type).alias(end),
            F.lit(True).alias(current),
        )

    data_cols = [c for c in active.columns if c not in scd]
    s = _prefixed(source, _S, "__in_src")
    t = _prefixed(active, _T, "__in_tgt")
    cond = _null_safe_keys(keys) if null_safe else reduce(lambda a, b: a & b, [_q(_S + k) == _q(_T + k) for k in keys])
    joined = t.join(s, cond, "full_outer")

    in_src = F.col("__in_src").isNotNull()
    in_tgt = F.col("__in_tgt").isNotNull()
    deleted = _q(_S + "__del") if delete_when is not None else F.lit(False)
    changed = in_src & in_tgt & reduce(lambda a, b: a | b, [~_q(_S + c).eqNullSafe(_q(_T + c)) for c in compare])
    change_ts = _q(_S + "__eff") if effective_from is not None else ts

    def version(prefix: str, start_col: Column, end_col: Column, cur: bool) -> Column:
        fields = [
            (_q(prefix + c) if (prefix == _T or c in src_cols) else F.lit(None))
            .cast(active.schema[c].dataType)
            .alias(c)
            for c in data_cols
        ]
        return F.struct(*fields, start_col.alias(start), end_col.alias(end), F.lit(cur).alias(current))

    null_ts = F.lit(None).cast(ts_type)
    kept = version(_T, _q(_T + start), _q(_T + end), True)
    closed = version(_T, _q(_T + start), change_ts, False)
    opened = version(_S, change_ts, null_ts, True)
    nothing = F.filter(F.array(kept), lambda _: F.lit(False))  # typed empty array
    rows = (
        F.when(in_src & deleted, F.when(in_tgt, F.array(closed)).otherwise(nothing))
        .when(changed, F.array(closed, opened))
        .when(~in_tgt, F.array(opened))
        .otherwise(F.array(kept))
    )
    return joined.select(F.inline(rows))


def scd2_event_time(
    existing: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    at: str,
    run_ts: datetime,
    order_by: Sequence[str] = (),
    deleted: Column | None = None,
    start: str = SCD_START,
    end: str = SCD_END,
    current: str = SCD_CURRENT,
    ts_type: str = "timestamp",
) -> DataFrame:
    """All versions after a load whose rows are told apart by event time, several of a key at once.

    Every version in ``existing`` and every row of ``changes`` is an event at
    its start, respectively at ``at`` (``run_ts`` where that is NULL); a closed
    version also ends at its end, and a row for which ``deleted`` holds ends
    what it meets.  Of a key's events at one time the load's count more than
    the table's, and among them the last by ``order_by``.  Neighbours equal in
    ``compare`` (null-safe) are one version, which keeps the first one's row,
    and each version ends where the next event is.  A late row thus splits the
    version it falls into and history is put right, not only the end of it.

    ``existing`` has the columns of ``changes`` and the validity columns.
    The same load again changes nothing.  NULL keys are one key.  One shuffle
    by key; the result replaces the table (``sinks.commit_state``).
    """
    data = [c for c in changes.columns if c not in {start, end, current}]
    rank = F.struct(*[_q(c) for c in (*order_by, *compare)])  # a total order of what is compared
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    ts = F.coalesce(_q(at).cast(ts_type), ts_literal(run_ts, ts_type))

    def events(df: DataFrame, when: Column, priority: int, ends: Column) -> DataFrame:
        return df.select(*[_q(c) for c in data], when.alias("__at"), F.lit(priority).alias("__prio"), rank.alias("__rank"), ends.alias("__gone"))

    found = events(changes, ts, 2, gone)
    if existing is not None:
        same = existing.select(*[_q(c).cast(changes.schema[c].dataType).alias(c) for c in data], _q(start), _q(end))
        opened = events(same, _q(start), 1, F.lit(False))
        closed = events(same.filter(_q(end).isNotNull()), _q(end), 0, F.lit(True))
        found = found.unionByName(opened).unionByName(closed)
    by_time = Window.partitionBy(*[_q(k) for k in keys]).orderBy("__at", "__prio", "__rank")
    last = found.withColumn("__next", F.lead("__at").over(by_time)).filter(~F.col("__next").eqNullSafe(F.col("__at")))
    said = F.when(~F.col("__gone"), F.struct(*[_q(c) for c in compare]))
    told = last.withColumn("__said", said)
    first = F.row_number().over(by_time) == 1
    heads = told.withColumn("__head", first | ~F.lag("__said").over(by_time).eqNullSafe(F.col("__said"))).filter("__head")
    versions = heads.withColumn(end, F.lead("__at").over(by_time)).filter(~F.col("__gone"))
    return versions.select(
        *[_q(c) for c in data], F.col("__at").alias(start), _q(end), _q(end).isNull().alias(current)
    )


def scd2_first_load(
    source: DataFrame, run_ts: datetime, start: str = SCD_START, end: str = SCD_END, current: str = SCD_CURRENT, ts_type: str = "timestamp"
) -> DataFrame:
    """First load: every row active from ``run_ts``."""
    return scd2_apply(None, source, [], [], run_ts, start, end, current, ts_type)


def current_rows(df: DataFrame, flag: str = SCD_CURRENT) -> DataFrame:
    """Only the current versions, when the frame carries a current flag."""
    return df.filter(F.col(flag)) if flag in df.columns else df
