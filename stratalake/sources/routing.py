"""Which source definition a landed file belongs to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.keys import named


@dataclass(frozen=True)
class SourceDefinition:
    prefix: str
    table: str
    lateness_days: int = 1
    folder: str = ""
    enabled: bool = True


def route(files: DataFrame, name: str | Column, definitions: Sequence[SourceDefinition]) -> DataFrame:
    """Add the first enabled definition, in list order, whose prefix starts the file name.

    The definitions are configuration, so they are a literal array that is searched per row; no join, and
    files without a definition get nulls.
    """
    wanted = [d for d in definitions if d.enabled]
    listed = F.array(
        *[
            F.struct(
                F.lit(d.prefix).alias("prefix"),
                F.lit(d.table).alias("table"),
                F.lit(d.lateness_days).alias("lateness_days"),
                F.lit(d.folder).alias("folder"),
            )
            for d in wanted
        ]
    )
    file = named(name) if isinstance(name, str) else name
    first = F.get(F.filter(listed, lambda d: F.startswith(file, d["prefix"])), F.lit(0))
    return files.withColumn("_d", first).select(
        *[named(c) for c in files.columns],
        F.col("_d.table").alias("target_table"),
        F.col("_d.prefix").alias("source_prefix"),
        F.col("_d.lateness_days").alias("lateness_days"),
        F.col("_d.folder").alias("source_folder"),
    )
