"""What the corpus operators share: input columns, written tables that are removed again, Arrow helpers."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.keys import named
from stratalake.session import fresh_path


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark context, by way of the shared folder."""
    context = spark.sparkContext
    if getattr(context, "_stratalake_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, f"{package.name}/{file.relative_to(package)}")
    path = f"{fresh_path(spark, 'package')}.zip"
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(context._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(path)
    context._stratalake_shipped = True


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash; a null text counts as empty."""
    return df.select(named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))


def text_key(text: Column) -> Column:
    """Tells texts of one id apart; rows equal in both are interchangeable."""
    return F.xxhash64(text)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever case its names are in."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name in taken:
        name += "_"
    return name


def stage(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """Written table in the shared folder and its path, for results that are read more than once."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, each job's shuffle files go when the job ends, as its result is a written table."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it an Arrow batch holds so many rows at most, for rows that are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def texts_of(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """UTF-8 of each value without a detour over Python strings; null gives empty bytes."""
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        binary = part.cast(pa.large_binary()) if not pa.types.is_large_binary(part.type) else part
        for value in binary:
            yield value.as_py() or b""


def batch(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the length at the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
