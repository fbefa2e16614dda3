"""Incremental pickup of landed message files as a stream.

The checkpoint of the file source remembers which files were read, and a state store the ids of messages that came within
a time, so neither the landing folder's history nor the target table is read again. The time runs from a message's arrival
in the stream, not from the time it carries: a message may be as old as it likes and is never too late.

A micro-batch that died while it was appended is told by a marker beside the checkpoint. Only such a batch is compared
with the rows that the table has of its time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.keys import json_hash, named
from stratalake.operators.ingest import add_message_columns, lacking_rows, new_messages
from stratalake.operators.joins import within
from stratalake.sources.files import plain_path
from stratalake.sources.sinks import append_or_create, table_exists

#: Messages whose id came before within this time count as repeated.
REPEATS_WITHIN = "7 days"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_landing(
    spark: SparkSession, landing: str, schema: T.StructType, max_files: int = 10_000
) -> DataFrame:
    """Stream of landed messages. ``max_files`` bounds one micro-batch, not the stream."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .json(landing)
        .withColumn("input_file", plain_path("_metadata.file_path"))
    )


def first_deliveries(messages: DataFrame, message_id: str, within_time: str = REPEATS_WITHIN) -> DataFrame:
    """Messages of a stream whose id did not come before; those without an id, unless all they hold came before."""
    content = F.concat(F.lit("no id "), json_hash(messages.columns))
    # Arrival is the time of the micro-batch, so no message lies behind the watermark.
    arrived = messages.withColumns({"_arrived": F.current_timestamp(), "_id": F.coalesce(F.concat(F.lit("id "), named(message_id)), content)})
    return arrived.withWatermark("_arrived", within_time).dropDuplicatesWithinWatermark(["_id"]).drop("_id")


def standardise_batch(
    batch: DataFrame, enqueued: str = "message_enqueued_time_utc", mask: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Load columns, then the masks; ``_arrived`` is the load time."""
    stamped = add_message_columns(batch, F.col("_arrived"), F.col("input_file"), enqueued).drop("_arrived")
    return mask(stamped) if mask else stamped


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """The ids of a week need not fit the executors' memory."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _rest_of_batch(rows: DataFrame, table: DataFrame, message_id: str) -> DataFrame:
    """Rows of a batch that was begun before and did not get into the table; the batch has the same time again."""
    there = within(table, rows.select("expected_from").distinct(), {"expected_from": "expected_from"})
    told = named(message_id).isNotNull()
    return new_messages(rows.filter(told), there, message_id).unionByName(lacking_rows(rows.filter(~told), there.filter(~told)))


class _Marks:
    """Micro-batches whose rows are being appended, as empty files beside the checkpoint."""

    def __init__(self, spark: SparkSession, checkpoint: str) -> None:
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.root = f"{checkpoint.rstrip('/')}/appending"
        self.fs = self.path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def set(self, batch: int) -> bool:
        """Whether the batch was begun before."""
        mark = self.path(f"{self.root}/{batch}")
        if self.fs.exists(mark):
            return True
        self.fs.create(mark).close()
        return False

    def clear_before(self, batch: int) -> None:
        """Batches before one that begins are done for good."""
        if self.fs.exists(self.path(self.root)):
            for file in self.fs.listStatus(self.path(self.root)):
                if int(file.getPath().getName()) < batch:
                    self.fs.delete(file.getPath(), False)


def ingest_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    message_id: str = "message_id",
    mask: Callable[[DataFrame], DataFrame] | None = None,
    repeats_within: str = REPEATS_WITHIN,
    max_files: int = 10_000,
) -> None:
    """Take every file that landed since the last run into a table, each message once, then stop."""
    marks = _Marks(spark, checkpoint)

    def load(batch: DataFrame, number: int) -> None:
        rows = standardise_batch(batch, mask=mask)
        marks.clear_before(number)
        if marks.set(number) and table_exists(batch.sparkSession, table):
            rows = _rest_of_batch(rows, batch.sparkSession.table(table), message_id)
        append_or_create(rows, table)

    with _state_on_disk(spark):
        (
            first_deliveries(read_landing(spark, landing, schema, max_files), message_id, repeats_within)
            .writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
