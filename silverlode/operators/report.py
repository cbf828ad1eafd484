"""Execution records from phase timings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.elapsed import format_seconds, status_message
from silverlode.sources.history import REPORT_COLUMNS

GENERATE, RUN = "select_ai", "select"  # the two phases of an execution


def _exact_sum(milliseconds: Column) -> Column:
    """The sum does not depend on the order of the rows."""
    return F.sum(milliseconds.cast("decimal(28,6)")).cast("double")


def phase_times(phases: DataFrame) -> DataFrame:
    """Per execution and phase the time summed over attempts, the first start and the last end.

    ``phases``: execution_id, phase, started_at, finished_at, elapsed_ms. Negative times count as zero.
    """
    return phases.groupBy("execution_id", "phase").agg(
        _exact_sum(F.greatest(F.lit(0.0), F.col("elapsed_ms"))).alias("elapsed_ms"),
        F.min("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
        F.count("*").alias("attempts"),
    )


def _seconds(milliseconds: Column) -> Column:
    return F.coalesce(format_seconds(milliseconds / 1000), F.lit(""))


def _sides() -> list[Column]:
    """Exact milliseconds, first start and last end of both phases."""

    def of(phase: str, column: str) -> Column:
        return F.when(F.col("phase") == phase, F.col(column))

    def side(phase: str, prefix: str) -> list[Column]:
        return [
            F.sum(F.when(F.col("phase") == phase, F.greatest(F.lit(0.0), F.col("elapsed_ms"))).cast("decimal(28,6)")).alias(f"{prefix}_ms"),
            F.min(of(phase, "started_at")).alias(f"{prefix}_start"),
            F.max(of(phase, "finished_at")).alias(f"{prefix}_end"),
        ]

    return [*side(GENERATE, "g"), *side(RUN, "r")]


def execution_records(executions: DataFrame, phases: DataFrame) -> DataFrame:
    """The twenty public columns from executions and their phases.

    ``executions``: execution_id, screen_name, prompt, prompt_used, category, profile, generated_sql, status, attempts,
    started_at, elapsed_ms, result_count, error. Both phases of an execution come from one aggregate, so there is one join.
    """
    timed = phases.groupBy(F.col("execution_id").alias("x__")).agg(*_sides())
    joined = executions.join(timed, F.col("execution_id") == F.col("x__"), "left")
    return public_records(joined.withColumns({c: F.col(c).cast("double") for c in ("g_ms", "r_ms")}))


# -- the same from attempts that keep coming in ---------------------------------------------------------------------------------

DETAILS = ["screen_name", "prompt", "prompt_used", "category", "profile", "generated_sql", "status", "result_count", "error"]
#: An attempt at one phase of an execution; ``record_id`` is unique, ``at`` the time that late records are judged by.
ATTEMPTS = "record_id string, execution_id string, at timestamp, phase string, started_at string, finished_at string, elapsed_ms double, " + ", ".join(f"{c} string" for c in DETAILS)


def partial_state(attempts: DataFrame) -> DataFrame:
    """Per execution what can be merged with more of the same: sums, counts, first and last times, the latest record."""
    latest = F.max(F.struct("at", "record_id", *DETAILS)).alias("latest")
    tries = F.count_if(F.col("phase") == GENERATE).alias("attempts")
    return attempts.groupBy("execution_id").agg(*_sides(), tries, F.min("started_at").alias("started_at"), latest)


def merged_state() -> dict[str, Column]:
    """How a stored state (its columns) takes up a new part (``row__s``): for ``mutate.merge``."""
    new = F.col("row__s")

    def both(name: str, how) -> Column:
        return how(F.col(name), new[name])

    def total(a: Column, b: Column) -> Column:
        return F.coalesce((a + b).cast("decimal(38,6)"), a, b)

    out = {c: both(c, total) for c in ("g_ms", "r_ms")}
    out |= {c: both(c, F.least) for c in ("g_start", "r_start", "started_at")}
    out |= {c: both(c, F.greatest) for c in ("g_end", "r_end", "latest")}
    return out | {"attempts": F.col("attempts") + new["attempts"], "batch": new["batch"]}


def state_records(state: DataFrame) -> DataFrame:
    """The public columns from a state; the whole time is that of both phases."""
    known = state.select("execution_id", "g_start", "g_end", "r_start", "r_end", "attempts", "started_at", *[F.col("latest")[c].alias(c) for c in DETAILS],
                         *[F.col(c).cast("double").alias(c) for c in ("g_ms", "r_ms")], F.coalesce(F.col("g_ms") + F.col("r_ms"), "g_ms", "r_ms").cast("double").alias("elapsed_ms"))
    return public_records(known)


def public_records(joined: DataFrame) -> DataFrame:
    """The twenty columns as text, from executions beside their phases' times."""
    status = F.coalesce("status", F.lit(""))
    failed = status.startswith("❌") | status.startswith("⚠️")
    error = F.coalesce(F.nullif("error", F.lit("")), F.when(failed, status_message(status)), F.lit(""))
    values = [
        F.col("screen_name"),
        F.col("execution_id"),
        F.col("started_at"),
        F.col("prompt"),
        F.col("prompt_used"),
        F.col("category"),
        F.col("profile"),
        F.col("generated_sql"),
        status,
        F.col("attempts"),
        F.col("started_at"),
        F.col("g_start"),
        F.col("g_end"),
        _seconds(F.col("g_ms")),
        F.col("r_start"),
        F.col("r_end"),
        _seconds(F.col("r_ms")),
        _seconds(F.col("elapsed_ms")),
        F.col("result_count"),
        error,
    ]
    return joined.select(*[F.coalesce(v.cast("string"), F.lit("")).alias(name) for name, v in zip(REPORT_COLUMNS, values)])
