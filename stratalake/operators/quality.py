"""Data checks that run as jobs and report rows, and the run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratalake.functions.keys import as_columns, named
from stratalake.operators.latest import latest_per_key
from stratalake.operators.merge import merge_actions


def violations(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break a rule, with the names of all rules they break. A rule that is null counts as broken."""
    reasons = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    )
    return df.withColumn("reasons", reasons).filter(F.size("reasons") > 0).select(*as_columns(keys), "reasons")


def required(col: str) -> Column:
    return named(col).isNotNull()


def optional_timestamp(col: str) -> Column:
    """Null, or text in RFC 3339 form."""
    shape = named(col).rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$")
    return named(col).isNull() | (shape & named(col).try_cast("timestamp").isNotNull())


def same_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: the two row counts and whether they agree. Each side is counted where it lies."""
    one = a.agg(F.count(F.lit(1)).alias("before_rows"))
    return one.withColumn("after_rows", b.agg(F.count(F.lit(1))).scalar()).withColumn(
        "same", F.col("before_rows") == F.col("after_rows")
    )


def observe_actions(df: DataFrame, name: str, action: str) -> tuple[DataFrame, Observation]:
    """Count actions while the frame is written: the counts come with the write and cost no second run."""
    seen = Observation(name)
    counts = [F.count_if(named(action) == a).alias(f"{a}_count") for a in ("create", "update", "delete")]
    return df.observe(seen, *counts), seen


# --- run log -------------------------------------------------------------------------------------

# Columns of the run log and the key of one run of one stage.
RUN_SCHEMA = (
    "run_id string, entity_name string, stage_name string, execution_parameters string, "
    "execution_start_time timestamp, execution_finish_time timestamp, successful boolean, result_text string"
)
RUN_KEYS = ("run_id", "entity_name", "stage_name", "execution_start_time")
RUN_UPDATES = ("execution_finish_time", "successful", "result_text")


def log_runs(log: DataFrame, changes: DataFrame, action: str = "row_action") -> DataFrame:
    """Run log after new and finished runs; a finished run changes its three result columns only."""
    return merge_actions(log, changes, RUN_KEYS, action, RUN_UPDATES)


def runs_of(
    log: DataFrame, run_id: str | None = None, entity: str | None = None, stage: str | None = None
) -> DataFrame:
    out = log
    for col, value in (("run_id", run_id), ("entity_name", entity), ("stage_name", stage)):
        if value is not None:
            out = out.filter(named(col) == value)
    return out


def latest_runs(log: DataFrame) -> DataFrame:
    """The newest row of every run, entity and stage."""
    return latest_per_key(log, RUN_KEYS[:3], ["execution_start_time", "execution_finish_time"])
