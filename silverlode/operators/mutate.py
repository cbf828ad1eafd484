"""Table changes as DataFrame → DataFrame functions.

Parquet has no in-place change, so a change is a new snapshot: these functions describe it, ``Layer.write`` publishes
it. Predicates follow SQL: NULL is not true, so a row with an undecided predicate is neither deleted nor updated.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.text import strip
from silverlode.operators.skew import common_type, match, match_keys
from silverlode.session import ensure_checkpoints


def _predicate(where: str | Column | None) -> Column:
    if where is None:
        return F.lit(True)
    return F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))


def _value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def delete_where(df: DataFrame, where: str | Column | None = None) -> DataFrame:
    """M01"""
    return df.filter(~_predicate(where))


def update_where(df: DataFrame, changes: dict[str, object], where: str | Column | None = None) -> DataFrame:
    """All new values are computed from the old row; types are kept."""
    hit = _predicate(where)
    return df.select(
        *[
            F.when(hit, _value(changes[f.name]).cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
            if f.name in changes
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def truncate(df: DataFrame) -> DataFrame:
    """M04"""
    return df.limit(0)


def insert_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows by column name; columns the rows do not have are NULL."""
    typed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name in rows.columns])
    return df.unionByName(typed, allowMissingColumns=True)


def _keys_equal(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str) -> Column:
    return reduce(lambda a, b: a & b, [left[k] == right[f"{k}{suffix}"] for k in keys])


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: dict[str, str | Column] | None = None,
    insert: dict[str, str] | None = None,
) -> DataFrame:
    """Matched rows updated, unmatched source rows inserted, the rest unchanged.

    ``update`` and ``insert`` map target column → source column (in ``update`` also an expression of the old row); by
    default every shared column. A NULL key matches nothing. A target row that matches more than one source row is an error, raised while the job runs.

    Two joins and not one full outer join: the target is the left side of a left join, so a small source is broadcast
    and the target is never shuffled, and with a large source AQE can split a hot key of either side. Which source
    rows are new is decided against the target's keys that occur in the source, which are no more than the source's.
    """
    shared = [c for c in target.columns if c in source.columns]
    update = {c: c for c in shared if c not in keys} if update is None else update
    insert = {c: c for c in shared} if insert is None else insert
    has_key = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])

    one_per_key = (
        source.filter(has_key)
        .groupBy(*[F.col(f"`{k}`").alias(f"{k}__s") for k in keys])
        .agg(F.count("*").alias("n__s"), F.any_value(F.struct(*[F.col(f"`{c}`") for c in source.columns])).alias("row__s"))
    )

    def new_value(change: str | Column) -> Column:
        return change if isinstance(change, Column) else F.col("row__s")[change]

    duplicate = F.when(F.col("n__s") > 1, F.raise_error(F.lit("a target row matches more than one source row")).cast("boolean"))
    updated = (
        target.join(one_per_key, match_keys(target, one_per_key, [(k, f"{k}__s") for k in keys]), "left")
        .filter(F.coalesce(duplicate, F.lit(True)))
        .select(
            *[
                F.when(F.col("n__s").isNotNull(), new_value(update[f.name]).cast(f.dataType))
                .otherwise(F.col(f"`{f.name}`"))
                .alias(f.name)
                if f.name in update
                else F.col(f"`{f.name}`")
                for f in target.schema.fields
            ]
        )
    )
    source_keys = source.filter(has_key).select(*[F.col(f"`{k}`").alias(f"{k}__s") for k in keys])
    target_keys = target.select(*[F.col(f"`{k}`") for k in keys])
    found = (
        target_keys.join(source_keys, _keys_equal(target_keys, source_keys, keys, "__s"), "left_semi")
        .distinct()
        .toDF(*[f"{k}__t" for k in keys])
    )
    new = source.join(found, match_keys(source, found, [(k, f"{k}__t") for k in keys]), "left_anti")
    inserted = new.select(
        *[
            (F.col(f"`{insert[f.name]}`").cast(f.dataType) if f.name in insert else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return updated.unionByName(inserted)


def _folded(column: str) -> Column:
    return F.upper(strip(F.col(f"`{column}`")))


def upsert_by_name(entries: DataFrame, changed: DataFrame, name: str) -> DataFrame:
    """M03 for a metadata snapshot: names compared in any case, the whole entry replaced, nameless entries ignored."""
    named = changed.filter(F.coalesce(strip(F.col(f"`{name}`")), F.lit("")) != "")
    return remove_by_key(entries, named, name).unionByName(named)


def remove_by_key(entries: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """Drop the entries whose name occurs in ``names``, in any case."""
    keys = names.select(_folded(name).alias("gone__")).filter(F.col("gone__").isNotNull()).distinct()
    return entries.join(keys, match([_folded(name)], [F.col("gone__")]), "left_anti")


def replace_snapshot(rows: DataFrame) -> DataFrame:
    """The new rows, stamped with the time of the write."""
    return rows.withColumn("updated_at", F.current_timestamp())


def difference(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a counterpart in ``right``; NULLs count as equal."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"{c}__r") for c in on]).distinct()
    ours, theirs = zip(*[common_type(left, c, renamed, f"{c}__r") for c in on])
    return left.join(renamed, match(ours, theirs, nulls_equal=True), "left_anti")


def union_names(*frames: DataFrame) -> DataFrame:
    """X02"""
    return reduce(lambda a, b: a.unionByName(b), frames)


# -- batches ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Step:
    """One change of a batch. Build it with the functions below."""

    kind: str
    where: str | Column | None = None
    changes: dict[str, object] = field(default_factory=dict)
    rows: DataFrame | None = None
    keys: tuple[str, ...] = ()


def delete_step(where=None) -> Step:
    return Step("DELETE", where)


def update_step(changes: dict[str, object], where=None) -> Step:
    return Step("UPDATE", where, changes)


def insert_step(rows: DataFrame) -> Step:
    return Step("INSERT", rows=rows)


def truncate_step() -> Step:
    return Step("TRUNCATE")


def merge_step(rows: DataFrame, keys: Sequence[str]) -> Step:
    return Step("MERGE", rows=rows, keys=tuple(keys))


HITS, ALIVE = "hits__", "alive__"  # per row: numbers of the steps that affected it; still part of the table

# Words of the batch summary.
DONE, FAILED = "成功", "失敗"
COMMITTED, ROLLED_BACK, NOT_APPLIED = "確定", "ロールバック済み", "未反映"
SUMMARY_SCHEMA = "No int, Type string, Status string, RowsAffected long, Message string, Permanent string, Duration_ms long"


def _marked(df: DataFrame) -> DataFrame:
    return df.withColumn(HITS, F.array().cast("array<int>")).withColumn(ALIVE, F.lit(True))


def _apply(state: DataFrame, number: int, step: Step) -> DataFrame:
    """One step on a table that carries its bookkeeping columns.

    Affected rows are marked, not removed, so one pass over the final state yields the table and every step's count.
    """
    columns = [c for c in state.columns if c not in (HITS, ALIVE)]
    mark = F.array_append(F.col(HITS), F.lit(number))
    if step.kind in {"DELETE", "TRUNCATE"}:
        hit = F.col(ALIVE) & _predicate(step.where)
        return state.select(
            *[F.col(f"`{c}`") for c in columns],
            F.when(hit, mark).otherwise(F.col(HITS)).alias(HITS),
            (F.col(ALIVE) & ~hit).alias(ALIVE),
        )
    if step.kind == "UPDATE":
        _require_columns(state, step.changes)
        return update_where(state, {**step.changes, HITS: mark}, F.col(ALIVE) & _predicate(step.where))
    new = step.rows.withColumn(HITS, F.array(F.lit(number))).withColumn(ALIVE, F.lit(True))
    if step.kind == "INSERT":
        _require_columns(state, step.rows.columns)
        return insert_rows(state, new)
    if step.kind == "MERGE":
        _require_columns(state, step.rows.columns)
        shared = [c for c in columns if c in step.rows.columns and c not in step.keys]
        live = merge(state.filter(ALIVE), new, step.keys, update={**{c: c for c in shared}, HITS: mark})
        return live.unionByName(state.filter(~F.col(ALIVE)))
    raise ValueError(f"unknown step: {step.kind}")


def _require_columns(state: DataFrame, names) -> None:
    unknown = [n for n in names if n not in state.columns]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")


def _chain(df: DataFrame, steps: Sequence[tuple[int, Step]]) -> DataFrame:
    """The steps in order as one plan. A merge reads its input more than once, so the state is written to the
    checkpoint folder before every further merge: the plan grows with the number of steps, not faster."""
    state, merged = _marked(df), False
    for number, step in steps:
        if step.kind == "MERGE":
            if merged:
                ensure_checkpoints(df.sparkSession)
                state = state.checkpoint()
            merged = True
        state = _apply(state, number, step)
    return state


def _table(state: DataFrame) -> DataFrame:
    return state.filter(ALIVE).drop(HITS, ALIVE)


def affected_rows(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """M08 as one lazy plan: a row per step with its affected rows, all counted in one pass over the table."""
    state = _chain(df, list(enumerate(steps, 1)))
    counts = [
        F.struct(
            F.lit(i).alias("No"),
            F.lit(step.kind).alias("Type"),
            F.count_if(F.array_contains(HITS, i)).alias("RowsAffected"),
        )
        for i, step in enumerate(steps, 1)
    ]
    return state.agg(F.array(*counts).alias("steps")).select(F.inline("steps"))


def _written(state: DataFrame) -> DataFrame:
    """The state as a checkpoint: every value is computed, a step whose values cannot be computed fails here, and counts and
    table are read from what was written."""
    ensure_checkpoints(state.sparkSession)
    return state.checkpoint()


def _counts(state: DataFrame, steps: Sequence[tuple[int, Step]]) -> dict[int, int]:
    """Affected rows per step, from one pass over a written state."""
    if not steps:
        return {}
    row = state.agg(*[F.count_if(F.array_contains(HITS, n)).alias(f"s{n}") for n, _ in steps]).first()
    return {n: row[f"s{n}"] for n, _ in steps}


def _ms(started: float) -> int:
    return int((time.perf_counter() - started) * 1000)


@dataclass(frozen=True)
class Batch:
    ok: bool
    table: DataFrame  # the table after the batch; the unchanged table when a strict batch failed
    summary: DataFrame

    def outcome(self) -> DataFrame:
        """Steps that worked, steps that failed, rows affected."""
        return self.summary.agg(
            F.count_if(F.col("Status") == DONE).alias("succeeded"),
            F.count_if(F.col("Status") == FAILED).alias("failed"),
            F.coalesce(F.sum(F.when(F.col("Status") == DONE, F.col("RowsAffected"))), F.lit(0)).alias("rows_affected"),
        )


_STEP_ERRORS = (PySparkException, Py4JError, ValueError)


def _row(n: int, step: Step, status: str, rows: int, message: str, permanent: str, ms: int) -> tuple:
    return (n, step.kind, status, rows, message, permanent, ms)


def _summary(df: DataFrame, rows: list[tuple]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, SUMMARY_SCHEMA)


def _one_by_one(df: DataFrame, numbered: Sequence[tuple[int, Step]], stop: bool) -> tuple[DataFrame, DataFrame, int, dict[int, tuple[int, int]], dict[int, str]]:
    """Each step on the written state before it, once: the state at the end, the state after the last TRUNCATE and that step's
    number, rows and milliseconds of the steps that worked, and the errors."""
    state = kept = _marked(df)
    last, done, errors = 0, {}, {}
    for n, step in numbered:
        started = time.perf_counter()
        try:
            after = _written(_apply(state, n, step))
        except _STEP_ERRORS as error:
            errors[n] = str(error).splitlines()[0]
            if stop:
                break
            continue
        state, done[n] = after, (_counts(after, [(n, step)])[n], _ms(started))
        if step.kind == "TRUNCATE":
            kept, last = after, n
    return state, kept, last, done, errors


class _OneByOne(Exception):
    """The steps are to be run one by one."""


def run_batch(df: DataFrame, steps: Sequence[Step], timed: bool = False) -> Batch:
    """All steps or none. Stops at the first failure; a failed batch leaves the table as it was, or as the last
    TRUNCATE left it: truncating commits what came before and cannot be rolled back.

    The good case computes the whole batch once; its time is that of every row of the summary. Only after a failure are
    the steps run one by one to find the one to report, each once. With ``timed`` they are run one by one at once, and
    each row has its step's own time.
    """
    numbered, started = list(enumerate(steps, 1)), time.perf_counter()
    try:
        if timed:
            raise _OneByOne
        state = _written(_chain(df, numbered))
        counts, ms = _counts(state, numbered), _ms(started)
        rows = [_row(n, s, DONE, counts[n], f"RowsAffected={counts[n]}", COMMITTED, ms) for n, s in numbered]
        return Batch(True, _table(state), _summary(df, rows))
    except (*_STEP_ERRORS, _OneByOne):
        pass
    state, kept, last, done, errors = _one_by_one(df, numbered, stop=True)
    if not errors:
        return Batch(True, _table(state), _summary(df, [_row(n, s, DONE, done[n][0], f"RowsAffected={done[n][0]}", COMMITTED, done[n][1]) for n, s in numbered]))
    rows = []
    for n, step in numbered:
        if n in done:
            rows.append(_row(n, step, DONE, done[n][0], f"RowsAffected={done[n][0]}", COMMITTED if n <= last else ROLLED_BACK, done[n][1]))
        elif n in errors:
            rows.append(_row(n, step, FAILED, -1, errors[n], NOT_APPLIED, 0))
    return Batch(False, _table(kept) if last else df, _summary(df, rows))


def run_lenient(df: DataFrame, steps: Sequence[Step]) -> Batch:
    """Every step on its own; a failed step is skipped and the others still count."""
    numbered = list(enumerate(steps, 1))
    state, _, _, done, errors = _one_by_one(df, numbered, stop=False)
    rows = [
        _row(n, s, FAILED, -1, errors[n], NOT_APPLIED, 0)
        if n in errors
        else _row(n, s, DONE, done[n][0], f"RowsAffected={done[n][0]}", COMMITTED, done[n][1])
        for n, s in numbered
    ]
    return Batch(not errors, _table(state), _summary(df, rows))
