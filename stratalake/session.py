"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks join sides and splits hot join keys; wide entities skip constraint propagation.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.broadcastTimeout": "3600",
    "spark.ui.enabled": "false",
}


def build_session(app: str, **settings: str) -> SparkSession:
    """Session with the library's settings. ``settings`` use ``__`` for the dots in a name."""
    builder = SparkSession.builder.appName(app)
    for k, v in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session may go without one; its folder is on the only machine there is.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stratalake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """New path in the shared folder; nothing is ever written twice to one."""
    return f"{shared_folder(spark)}/stratalake/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a written table in the shared folder, so a lost executor reads it again."""
    path = fresh_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
