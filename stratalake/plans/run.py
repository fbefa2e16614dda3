"""One run of one job: write its outputs, count what was written, keep a row in the run log."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.quality import RUN_KEYS, RUN_SCHEMA, observe_actions
from stratalake.sources.sinks import WriteSpec, write_all, write_files


@dataclass(frozen=True)
class Outcome:
    """What a run did. Counts are those of labelled outputs: created, updated and deleted rows."""

    run_id: str
    entity: str
    stage: str
    started: datetime
    finished: datetime
    successful: bool
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    error: str | None = None

    @property
    def seconds(self) -> float:
        return (self.finished - self.started).total_seconds()


def run(
    spark: SparkSession,
    entity: str,
    stage: str,
    outputs: Callable[[], Sequence[WriteSpec]],
    log_table: str | None = None,
    run_id: str | None = None,
) -> Outcome:
    """Build and write the outputs of a job. A failure is an outcome, with its message in the log, not an exception.

    Counts are taken while the rows are written; the plan does not run a second time for them.
    """
    started = _now()
    opened = Outcome(run_id or uuid.uuid4().hex, entity, stage, started, started, False)
    if log_table:
        _log(spark, log_table, opened, False)
    counts: dict[str, dict[str, int]] = {}
    error = None
    try:
        for spec in outputs():
            watched, seen = (
                observe_actions(spec.data, f"{entity}-{uuid.uuid4().hex}", spec.action)
                if spec.action
                else _observe_rows(spec.data, entity)
            )
            write_all([replace(spec, data=watched)])
            counts[spec.target] = seen.get
    except Exception as e:  # noqa: BLE001
        error = f"{type(e).__name__}: {e}"
    done = replace(opened, finished=_now(), successful=error is None, counts=counts, error=error)
    if log_table:
        _log(spark, log_table, done, True)
    return done


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _observe_rows(df: DataFrame, entity: str):
    from pyspark.sql import Observation

    seen = Observation(f"{entity}-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen


def _log(spark: SparkSession, table: str, o: Outcome, finished: bool) -> None:
    """Append an event to the log; ``table`` is a view of the newest event of every run.

    Every event is a file in a folder of its own below its day, so that runs at the same time neither read, rewrite
    nor clean up what the other writes.
    """
    row = (o.run_id, o.entity, o.stage, "{}", o.started)
    told = json.dumps(o.counts) if o.error is None else o.error
    row += (o.finished, o.successful, told) if finished else (None, None, None)
    database, _, name = table.rpartition(".")
    root = f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{name}_events"
    event = spark.createDataFrame([row], RUN_SCHEMA).coalesce(1)
    write_files(event, f"{root}/day={o.started:%Y-%m-%d}/event=e{uuid.uuid4().hex}")
    cols = ", ".join(event.columns)
    newest = f"row_number() OVER (PARTITION BY {', '.join(RUN_KEYS)} ORDER BY execution_finish_time DESC NULLS LAST)"
    spark.sql(f"CREATE VIEW IF NOT EXISTS {table} AS SELECT {cols} FROM (SELECT *, {newest} AS _newest FROM parquet.`{root}`) WHERE _newest = 1")
