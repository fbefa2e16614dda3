"""Which landed files a table has: batches of files, begun and done, as small files beside the table.

A batch is written down with its paths and its time before its rows are appended, and once more when they are. A listing
without the files of done batches is what is pending, so a run opens no file that was loaded before. A batch that was
begun and not done died half way: its rows are built again from the same files and the same time, which gives the same
rows, and only those that the table lacks are appended.

One run at a time loads into a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.ingest import lacking_rows
from stratalake.operators.joins import within, without
from stratalake.session import materialise
from stratalake.sources.files import exact
from stratalake.sources.sinks import append_or_create, table_exists, write_files

#: Files of one batch at most; a backlog is taken in as many batches as it needs.
BATCH_FILES = 10_000
SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("batch", T.StringType()), T.StructField("at", T.TimestampType())])

#: Rows of the given files at the given time; nothing where the files are all empty.
Build = Callable[[Sequence[str], Column], "DataFrame | None"]


@dataclass(frozen=True)
class Batch:
    name: str
    at: datetime
    paths: Sequence[str]


@dataclass(frozen=True)
class Landed:
    """What a run opened, batch by batch."""

    batches: Sequence[Batch]

    @property
    def paths(self) -> list[str]:
        return [p for b in self.batches for p in b.paths]


class Manifest:
    """Batches below a folder, each written whole or not at all."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _rows(self, state: str) -> DataFrame:
        path = f"{self.root}/{state}"
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], SCHEMA)
        # A batch folder without its marker died while it was written.
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(*exact([path]))

    def _write(self, batch: Batch, state: str) -> None:
        rows = self.spark.createDataFrame([(p, batch.name, batch.at) for p in batch.paths], SCHEMA).coalesce(1)
        write_files(rows, f"{self.root}/{state}/{batch.name}")

    def done(self) -> DataFrame:
        return self._rows("done")

    def pending(self, listing: DataFrame) -> DataFrame:
        """Listed files of no done batch; both sides stay distributed."""
        return without(listing, self.done().select("path").distinct(), {"path": "path"})

    def begun(self) -> list[Batch]:
        """Batches that died half way, the oldest first; no more than one unless runs met."""
        left = without(self._rows("begun"), self.done().select("batch").distinct(), {"batch": "batch"})
        found = left.groupBy("batch", "at").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("at", "batch")
        return [Batch(r["batch"], r["at"], r["paths"]) for r in found.collect()]

    def begin(self, paths: Sequence[str], at: datetime) -> Batch:
        batch = Batch(f"b{uuid.uuid4().hex}", at, list(paths))
        self._write(batch, "begun")
        return batch

    def finish(self, batch: Batch) -> None:
        self._write(batch, "done")


def _batches(manifest: Manifest, listing: DataFrame, at: datetime, most: int) -> Iterator[tuple[Batch, bool]]:
    """Batches that died, then what is pending, oldest files first; with whether rows may be there."""
    for batch in manifest.begun():
        yield batch, True
    waiting = materialise(manifest.pending(listing).select("path", "modificationTime"), "pending")
    while True:
        paths = [r["path"] for r in manifest.pending(waiting).orderBy("modificationTime", "path").limit(most).collect()]
        if not paths:
            return
        yield manifest.begin(paths, at), False


def land(
    listing: DataFrame, table: str, manifest: Manifest, build: Build, at: datetime, file_col: str = "input_file", most: int = BATCH_FILES
) -> Landed:
    """Append the rows of every listed file that the table has not, each exactly once.

    ``listing`` has ``path`` and ``modificationTime``; ``build`` makes the rows of some files and must give the same ones
    for the same files and time, with the file's path in ``file_col``.
    """
    spark, taken = listing.sparkSession, []
    for batch, again in _batches(manifest, listing, at, most):
        rows = build(batch.paths, F.lit(batch.at))
        if rows is not None:
            if again and table_exists(spark, table):
                of_files = spark.createDataFrame([(p,) for p in batch.paths], f"`{file_col}` string")
                rows = lacking_rows(rows, within(spark.table(table), of_files, {file_col: file_col}))
            append_or_create(rows, table)
        manifest.finish(batch)
        taken.append(batch)
    return Landed(taken)
