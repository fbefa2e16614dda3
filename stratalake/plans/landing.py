"""Landed files to standardised tables: list, route, read the pending files alone, append, write them down."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.plans import standardise
from stratalake.sources import files
from stratalake.sources.manifest import BATCH_FILES, Landed, Manifest, land
from stratalake.sources.routing import SourceDefinition, route

#: Declared columns of a definition's table.
Declared = Callable[[SourceDefinition], T.StructType]


def land_messages(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    table: str,
    manifest: str,
    at: datetime,
    enqueued: str = "message_enqueued_time_utc",
    mask: standardise.Mask | None = None,
    most: int = BATCH_FILES,
) -> Landed:
    """Message files of a folder that are not in the table yet: one row per message, stamped and masked."""

    def build(paths: Sequence[str], now: Column) -> DataFrame:
        return standardise.messages(files.read_messages(spark, files.exact(paths), schema), None, now, enqueued, mask)

    return land(files.list_files(spark, landing, "*.json"), table, Manifest(spark, manifest), build, at, most=most)


def by_header(spark: SparkSession, paths: Sequence[str]) -> Mapping[str, list[str]]:
    """Files by their first line, which is all that is read of them; a header is one line."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found: dict[str, list[str]] = defaultdict(list)
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        stream = where.getFileSystem(conf).open(where)
        try:
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        if line is not None:  # an empty file has no rows
            found[line].append(path)
    return found


def _read(spark: SparkSession, paths: Sequence[str], multi_line: bool) -> list[DataFrame]:
    """One frame per CSV header, and one for all JSON files."""
    named = lambda ending: [p for p in paths if p.lower().endswith(ending)]
    frames = []
    for group in by_header(spark, named(".csv")).values():
        schema = files.csv_schema(spark, files.exact(group[:1])[0], multi_line=False)
        frames.append(files.read_csv_strict(spark, files.exact(group), schema, multi_line, file_col="input_file"))
    documents = named(".json")
    if documents:
        read = files.read_files(spark, "json", files.exact(documents), {"multiLine": str(multi_line).lower()})
        frames.append(read.withColumn("input_file", files.plain_path("_metadata.file_path")))
    return frames


def land_drops(
    spark: SparkSession,
    root: str,
    day: date,
    definitions: Sequence[SourceDefinition],
    declared: Declared,
    manifest: str,
    at: datetime,
    *,
    process: str,
    endings: Sequence[str] = (".csv",),
    only: str | None = None,
    strict: bool = False,
    multi_line: bool = True,
    mask: Callable[[SourceDefinition], standardise.Mask | None] = lambda d: None,
    most: int = BATCH_FILES,
) -> Mapping[str, Landed]:
    """Files of a dated folder to the tables of their definitions; what was opened, by table.

    A file belongs to the first enabled definition, in list order, whose prefix its name begins with; ``only`` names the
    one prefix that is wanted. Files without a definition stay where they are, with ``only`` they are an error.
    Files with other endings are left out, with ``strict`` one that has a definition is an error. Files of one
    definition are read together, those with another header apart; ``multi_line`` is for line breaks within a CSV
    value or a JSON document, and costs splitting large files.
    """
    wanted = [d for d in definitions if only is None or d.prefix == only]
    listed = files.list_files(spark, f"{root.rstrip('/')}/{day.isoformat()}")
    name = F.element_at(F.split("path", "/"), -1)
    known_type = reduce(lambda a, b: a | b, [F.endswith(F.lower(name), F.lit(e)) for e in endings])
    routed = route(listed.withColumn("_name", name), "_name", wanted)
    if strict and (odd := routed.filter(F.col("target_table").isNotNull() & ~known_type).select("_name").first()):
        raise ValueError(f"neither of {', '.join(endings)}: {odd[0]}")
    if only is not None and (odd := routed.filter(F.col("target_table").isNull() & known_type).select("_name").first()):
        raise ValueError(f"no definition for {odd[0]}")
    taken: dict[str, Landed] = {}
    for definition in (d for d in wanted if d.enabled):

        def build(paths: Sequence[str], now: Column, d: SourceDefinition = definition) -> DataFrame | None:
            typed = [
                standardise.dated_drop(
                    raw, declared(d), now=now, load_date=F.lit(day), lateness_days=d.lateness_days, process=process, entity=d.prefix, file=F.col("input_file"), mask=mask(d)
                )
                for raw in _read(spark, paths, multi_line)
            ]
            if not typed:
                return None
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), typed)

        mine = routed.filter(known_type & (F.col("source_prefix") == definition.prefix) & (F.col("target_table") == definition.table))
        book = Manifest(spark, f"{manifest.rstrip('/')}/{definition.table}/{definition.prefix}")
        landed = land(mine, definition.table, book, build, at, most=most)
        taken[definition.table] = Landed([*taken[definition.table].batches, *landed.batches] if definition.table in taken else landed.batches)
    return taken
