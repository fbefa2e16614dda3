"""Writers and table upkeep.

A table is replaced by writing the whole new state beside it first, once. Where the columns stay, the table is then
pointed to the folder of the new state by one change of its entry in the catalogue, so a reader finds all old rows or all
new ones. Where they change, the staged table ``<table>_tmp`` takes the table's name. Spark enters a table only when its
rows are written, so a staged table that is there is complete: whoever finds one with the table itself gone, or with
partitions, finishes the swap (:func:`recover_table`), and no copy is lost. Format, path, partitions and properties of
the table stay as they are; the path of a swapped table is the folder that its versions lie in. The version before the
newest is kept for readers that began with it, but for a first one in the folder of the table's name in the warehouse.

Merges and deletes on a partitioned table rewrite the partitions that hold changed rows and leave the files of the
others alone; partitions that come out empty lose their files without a job. A table without partitions of its own can
be laid out in buckets of its keys (:func:`merge_table`), which are partitions to a merge. Every partition is replaced
from a written copy; merges and deletes that died are run again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.keys import named
from stratalake.functions.types import nullable
from stratalake.operators.merge import label_changes, merge_actions, merge_parts
from stratalake.session import materialise
from stratalake.sources.files import plain_path


# Text formats keep microseconds; their defaults cut times to milliseconds.
TEXT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


@dataclass(frozen=True)
class WriteSpec:
    """Where and how one output of a job is written."""

    data: DataFrame
    target: str
    kind: str = "table"  # table | file | merge
    mode: str = "overwrite"
    fmt: str = "parquet"
    path: str | None = None
    partition_by: Sequence[str] = ()
    options: Mapping[str, str] = field(default_factory=dict)
    keys: Sequence[str] = ()
    action: str | None = None
    update_cols: Sequence[str] | None = None


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    options: Mapping[str, str] | None = None,
    partition_by: str | Sequence[str] = (),
) -> None:
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    times = TEXT_TIMES if fmt in ("csv", "json") else {}
    writer = df.write.format(fmt).mode(mode).options(**{**times, **(options or {})})
    (writer.partitionBy(*parts) if parts else writer).save(path)


def write_table(
    df: DataFrame,
    table: str,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: str | Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Catalogue table, at an explicit path where one is given."""
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if path:
        writer = writer.option("path", path)
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(table)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


@dataclass(frozen=True)
class Layout:
    """How a table is stored; ``path`` only where the table does not lie in the warehouse."""

    fmt: str = "parquet"
    path: str | None = None
    partition_by: tuple[str, ...] = ()
    properties: Mapping[str, str] = field(default_factory=dict)
    location: str = ""
    tracked: bool = False


#: Property of a staged table that wins over the table in any case, as the table may be gone half way.
SWAP_PATH = "swap.path"
#: Property of a swapped table with a path of its own: that path. Its versions lie below.
SWAP_ROOT = "swap.root"
VERSIONS = "_versions"


def layout(spark: SparkSession, table: str) -> Layout:
    told = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])
    properties = told.get("table_properties", {})
    own = properties.get(SWAP_ROOT) or (told["location"] if told.get("type") == "EXTERNAL" else None)
    tracked = str(told.get("partition_provider", "")).lower() == "catalog"
    return Layout(told["provider"], own, tuple(told.get("partition_columns", ())), properties, told["location"], tracked)


def _set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    if properties:
        quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({', '.join(f'{quoted(k)} = {quoted(v)}' for k, v in properties.items())})")


@contextmanager
def _untracked(spark: SparkSession) -> Iterator[None]:
    """Tables made within it find their partitions in their folder, so another folder brings its own."""
    key = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _location(spark: SparkSession, table: str) -> str:
    """Path of the table's folder as a writer takes it; the catalogue's own is URL-encoded."""
    at = spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(table)
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark._jsparkSession.sessionState().catalog().getTableMetadata(at).location()).toString()


def _versions(spark: SparkSession, table: str, now: Layout) -> str:
    """Folder of a table's versions: below its own path, or beside it in the warehouse, where a dropped table must not
    leave a folder of its name."""
    if now.path:
        return f"{now.properties.get(SWAP_ROOT) or _location(spark, table)}/{VERSIONS}"
    database, _, name = table.replace("`", "").rpartition(".")
    uri = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    jvm = spark.sparkContext._jvm
    return f"{jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString().rstrip('/')}/{VERSIONS}/{name}"


def _remove_but(spark: SparkSession, folder: str, keep: Sequence[str]) -> None:
    where, fs = _fs(spark, folder)
    if fs.exists(where):
        for status in fs.listStatus(where):
            if status.getPath().getName() not in keep:
                fs.delete(status.getPath(), True)


def _fits(old: DataFrame, new: DataFrame) -> bool:
    return [(f.name, nullable(f.dataType)) for f in old.schema.fields] == [(f.name, nullable(f.dataType)) for f in new.schema.fields]


def _finish_swap(spark: SparkSession, table: str) -> None:
    """Put the staged table in the place of the table; may be run again after a death at any point."""
    staged = f"{table}_tmp"
    new, after = layout(spark, staged), _location(spark, staged)
    old = layout(spark, table) if table_exists(spark, table) else None
    before = _location(spark, table) if old else after
    same = old is not None and not old.tracked and (old.fmt, old.partition_by) == (new.fmt, new.partition_by)
    if same and f"/{VERSIONS}/" in after and _fits(spark.table(table), spark.table(staged)):
        _set_properties(spark, table, {k: v for k, v in new.properties.items() if k == SWAP_ROOT})
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(after)}'")
        spark.sql(f"DROP TABLE {staged}")
        spark.catalog.refreshTable(table)
        if not old.path and f"/{VERSIONS}/" not in before:
            where, fs = _fs(spark, before)
            fs.delete(where, True)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{SWAP_PATH}')")
    if f"/{VERSIONS}/" in after:
        _remove_but(spark, after.rsplit("/", 1)[0], [x.rsplit("/", 1)[1] for x in (before, after)])
    if SWAP_ROOT in new.properties and f"/{VERSIONS}/" in before:  # rows from before the first swap
        _remove_but(spark, new.properties[SWAP_ROOT], [VERSIONS])


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def recover_table(spark: SparkSession, table: str) -> bool:
    """Finish a swap that died after it began to replace the table, undo one that died before; whether rows changed."""
    staged = f"{table}_tmp"
    if not table_exists(spark, staged):
        return False
    begun = not table_exists(spark, table) or SWAP_PATH in layout(spark, staged).properties
    if begun:
        _finish_swap(spark, table)
    else:
        spark.sql(f"DROP TABLE {staged}")
    return begun


def swap_table(df: DataFrame, table: str, fmt: str | None = None, partition_by: Sequence[str] | None = None) -> None:
    """Replace the rows of a table by a frame that may read the table itself; the new rows are written once.

    Path and properties stay, format and partitions too unless others are given. A frame that was made while the
    table was half swapped has the wrong rows; that is an error, after the table is whole again.
    """
    spark = df.sparkSession
    if recover_table(spark, table):
        raise RuntimeError(f"{table} was left half swapped and is whole again; read it anew")
    there = table_exists(spark, table)
    now = layout(spark, table) if there else Layout()
    parts = [c for c in now.partition_by if c in df.columns] if partition_by is None else list(partition_by)
    staged, fmt = f"{table}_tmp", fmt or now.fmt
    ordered = df.select(*[named(c) for c in df.columns if c not in parts], *[named(c) for c in parts])
    switched = there and not now.tracked and fmt == now.fmt and tuple(parts) == now.partition_by and _fits(spark.table(table), ordered)
    path = f"{_versions(spark, table, now)}/v{uuid.uuid4().hex}" if switched or now.path else None
    with _untracked(spark):
        write_table(df, staged, path, fmt, "errorifexists", parts)
    root = {SWAP_ROOT: now.properties.get(SWAP_ROOT) or _location(spark, table)} if now.path else {}
    _set_properties(spark, staged, {**now.properties, **root, **({SWAP_PATH: "-"} if now.path or parts else {})})
    _finish_swap(spark, table)


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])


def _scope(target: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of the touched partitions; others are pruned while planning.

    ``touched`` has one row per partition. The driver lists the partitions of a table for any scan of it, so their
    values are no more than it holds anyway.
    """
    values = touched.agg(*[F.collect_set(named(p)).alias(p) for p in parts], *[F.count_if(named(p).isNull()).alias(f"_n{i}") for i, p in enumerate(parts)]).first()
    for i, p in enumerate(parts):
        here = named(p).isin(*values[p]) if values[p] else F.lit(False)
        target = target.filter(here | named(p).isNull() if values[f"_n{i}"] else here)
    other = touched.select(*[named(p).alias(f"_p{i}") for i, p in enumerate(parts)])
    return target.join(other, _same([named(p) for p in parts], [F.col(f"_p{i}") for i in range(len(parts))]), "left_semi")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _with_folder(rows: DataFrame) -> DataFrame:
    """The folder of each row's file; that of a partition, as all rows of a partition lie in one."""
    return rows.withColumn("_folder", F.regexp_extract(plain_path("_metadata.file_path"), "^(.*)/[^/]*$", 1))


def _empty_folders(spark: SparkSession, table: str, folders: Sequence[str]) -> None:
    """Partitions without rows: their files go, no job runs."""
    for folder in folders:
        _remove_but(spark, folder, [])
    spark.catalog.refreshTable(table)


def _replace_partitions(new: DataFrame, table: str, changed: DataFrame, parts: Sequence[str]) -> None:
    """Overwrite partitions by ``new``, a written frame; ``changed`` partitions, with their ``_folder``, that have no rows
    in it are emptied."""
    spark = new.sparkSession
    cols = spark.table(table).columns
    with _dynamic_overwrite(spark):
        # Rows of a partition go to one task, unless they are too many for it.
        new.select(*[named(c) for c in cols]).hint("rebalance", *[named(p) for p in parts]).write.mode("overwrite").insertInto(table)
    other = new.select(*[named(p).alias(f"_p{i}") for i, p in enumerate(parts)]).distinct()
    empty = changed.join(other, _same([named(p) for p in parts], [F.col(f"_p{i}") for i in range(len(parts))]), "left_anti")
    _empty_folders(spark, table, [r["_folder"] for r in empty.select("_folder").distinct().collect()])


def append_or_create(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Create the table, or append to it by column name; columns new to either side are kept, null elsewhere."""
    spark = df.sparkSession
    if not table_exists(spark, table):
        write_table(df, table, fmt=fmt)
        return
    have = spark.table(table)
    new_cols = [f for f in df.schema.fields if f.name not in have.columns]
    if new_cols:
        add_columns(spark, table, {f.name: f.dataType.simpleString() for f in new_cols})
        have = spark.table(table)
    padded = df.select(
        *[
            (named(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in have.schema.fields
        ]
    )
    padded.write.mode("append").insertInto(table)


#: Column, and properties, of a table that is laid out in buckets of its keys.
BUCKET = "_bucket"
BUCKETS, BUCKET_KEYS = "merge.buckets", "merge.keys"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[named(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, table: str) -> DataFrame:
    """Rows of a table that may be laid out in buckets."""
    return spark.table(table).drop(BUCKET)


def merge_table(
    changes: DataFrame,
    table: str,
    keys: Sequence[str],
    action: str,
    update_cols: Sequence[str] | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    buckets: int | None = None,
) -> None:
    """Apply actions to a table. The first load creates it from the rows to create, with the same checks.

    The changes are written to the shared folder once: the merge reads them several times, and their own lineage
    may be long. Of a partitioned table, only partitions that hold a changed key or take a row are read whole and
    rewritten. ``fmt``, ``partition_by`` and ``buckets`` are for the first load.

    With ``buckets`` a table without partitions is laid out by a hash of its keys, as column :data:`BUCKET` (see
    :func:`read_buckets`). The bucket of a changed key is known beforehand, so a batch reads each bucket that it hits once
    and the others not at all. A bucket should hold some hundred megabytes.
    """
    spark = changes.sparkSession
    recover_table(spark, table)
    if not table_exists(spark, table):
        empty = changes.drop(action).limit(0)
        first = merge_actions(empty, changes, keys, action, update_cols)
        if buckets and not partition_by:
            first = first.withColumn(BUCKET, _bucket(keys, buckets)).hint("rebalance", F.col(BUCKET))
        write_table(first, table, fmt=fmt, partition_by=[BUCKET] if buckets and not partition_by else partition_by)
        if buckets and not partition_by:
            _set_properties(spark, table, {BUCKETS: str(buckets), BUCKET_KEYS: json.dumps(list(keys))})
        return
    now = layout(spark, table)
    if BUCKETS in now.properties and json.loads(now.properties[BUCKET_KEYS]) == list(keys):
        _merge_buckets(changes, table, keys, action, update_cols, int(now.properties[BUCKETS]))
        return
    once = materialise(changes, "changes")
    parts = now.partition_by
    if not parts:
        swap_table(merge_actions(spark.table(table), once, keys, action, update_cols), table)
        return
    _add_missing(spark, table, once, action)
    target = spark.table(table)
    hit = _with_folder(target).join(once.select(*[named(k).alias(f"_k{i}") for i, k in enumerate(keys)]), reduce(lambda a, b: a & b, [named(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]), "left_semi")
    there = materialise(hit.select(*[named(p) for p in parts], "_folder").distinct(), "partitions")
    types = {p: target.schema[p].dataType for p in parts}
    coming = once.select(*[(named(p) if p in once.columns else F.lit(None)).cast(types[p]).alias(p) for p in parts])
    touched = materialise(there.drop("_folder").unionByName(coming).distinct(), "touched")
    merged = materialise(merge_actions(_scope(target, touched, parts), once, keys, action, update_cols), "merged")
    _replace_partitions(merged, table, there, parts)


def _add_missing(spark: SparkSession, table: str, changes: DataFrame, action: str) -> None:
    known = spark.table(table).columns
    new_cols = {f.name: f.dataType.simpleString() for f in changes.schema.fields if f.name not in (*known, action)}
    if new_cols:
        add_columns(spark, table, new_cols)


def _merge_buckets(changes: DataFrame, table: str, keys: Sequence[str], action: str, update_cols: Sequence[str] | None, buckets: int) -> None:
    """The buckets that a batch hits are read once; what the merge makes of their rows is written and tells, with the rows
    that go marked, which creates have a row already."""
    spark = changes.sparkSession
    shape = spark.table(table).schema
    typed = changes.select(*[named(c).cast(nullable(shape[c].dataType)).alias(c) if c in keys else named(c) for c in changes.columns])
    once = materialise(typed.withColumn(BUCKET, _bucket(keys, buckets)), "changes")
    _add_missing(spark, table, once, action)
    numbers = [r[0] for r in once.select(BUCKET).distinct().collect()]  # no more than there are buckets
    hit = _with_folder(spark.table(table)).filter(F.col(BUCKET).isin(numbers))
    kept, added = merge_parts(hit, once, [*keys, BUCKET], action, update_cols, mark="_gone")
    old = materialise(kept, "merged")
    new = old.filter(~F.col("_gone")).drop("_gone", "_folder").unionByName(added(old.select(*[named(k) for k in [*keys, BUCKET]])).drop("_folder"))
    _replace_partitions(materialise(new, "buckets"), table, old.select(BUCKET, "_folder").distinct(), [BUCKET])


def create_from_labelled(df: DataFrame, table: str, action: str, fmt: str = "parquet") -> None:
    """Create a table from labelled rows, without the label."""
    write_table(df.drop(action), table, fmt=fmt)


WRITERS: Mapping[str, Callable[[WriteSpec], None]] = {
    "file": lambda s: write_files(s.data, s.path or s.target, s.fmt, s.mode, s.options, s.partition_by),
    "table": lambda s: write_table(s.data, s.target, s.path, s.fmt, s.mode, s.partition_by, s.options),
    "swap": lambda s: swap_table(s.data, s.target, s.fmt, s.partition_by or None),
    "append": lambda s: append_or_create(s.data, s.target, s.fmt),
    "merge": lambda s: merge_table(s.data, s.target, s.keys, s.action or "", s.update_cols, s.fmt, s.partition_by),
}


def write_all(specs: Sequence[WriteSpec]) -> None:
    """Write every output of a job, in order."""
    for spec in specs:
        if spec.kind not in WRITERS:
            raise ValueError(f"unknown kind of output {spec.kind!r}")
        WRITERS[spec.kind](spec)


def write_by_flag(df: DataFrame, path: str, flag: str = "IsActive", mode: str = "errorifexists") -> None:
    """Files split by the active flag, so that readers of active rows skip the past."""
    write_files(df, path, mode=mode, partition_by=flag)


def drop_table(spark: SparkSession, table: str, purge: bool = True) -> None:
    """Remove a table with its versions; the files of a table with a path of its own stay."""
    if table_exists(spark, table) and not layout(spark, table).path:
        where, fs = _fs(spark, _versions(spark, table, Layout()))
        fs.delete(where, True)
    spark.sql(f"DROP TABLE IF EXISTS {table}{' PURGE' if purge else ''}")


def empty_table(spark: SparkSession, table: str) -> None:
    """Remove the rows, keep the table and its schema."""
    recover_table(spark, table)
    swap_table(spark.table(table).filter(F.lit(False)), table)


def delete_rows(spark: SparkSession, table: str, predicate: Column) -> None:
    """Delete by predicate: rows for which it is true go, rows for which it is null stay.

    Partitions of which all rows go lose their files, however many there are; only those that keep some are rewritten.
    """
    recover_table(spark, table)
    gone, rows, parts = F.coalesce(predicate, F.lit(False)), spark.table(table), layout(spark, table).partition_by
    if not parts:
        swap_table(rows.filter(~gone), table)
        return
    counted = _with_folder(rows).groupBy(*[named(p) for p in parts], "_folder").agg(F.count_if(gone).alias("_gone"), F.count(F.lit(1)).alias("_all"))
    hit = materialise(counted.filter("_gone > 0"), "touched")
    some = hit.filter("_gone < _all").select(*[named(p) for p in parts]).distinct()
    whole = hit.filter("_gone = _all").select("_folder", *[named(p) for p in parts])
    if not some.isEmpty():
        left = materialise(_scope(rows, some, parts).filter(~gone), "left")
        _replace_partitions(left, table, whole.filter(F.lit(False)), parts)
    _empty_folders(spark, table, [r["_folder"] for r in whole.select("_folder").distinct().collect()])


def add_columns(spark: SparkSession, table: str, columns: Mapping[str, str]) -> None:
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c}` {t}' for c, t in columns.items())})")


def create_as_select(spark: SparkSession, table: str, query: DataFrame) -> None:
    swap_table(query, table)


def upsert_table(new: DataFrame, table: str, key: str, buckets: int, fmt: str = "parquet") -> None:
    """Rows that differ from the table's, by the hash of their values, into a table in buckets of the key.

    One scan of the table finds what is new or differs; of the buckets that hold such rows, each is read once more and
    written anew. Null keys are dropped.
    """
    spark, action = new.sparkSession, "_row_action"
    rows = new.filter(named(key).isNotNull())
    if recover_table(spark, table) or table_exists(spark, table):
        changes = label_changes(rows, read_buckets(spark, table), key, action, [c for c in new.columns if c != key])
    else:
        changes = rows.withColumn(action, F.lit("create"))
    merge_table(changes, table, [key], action, fmt=fmt, buckets=buckets)


def upsert_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert new keys and overwrite known ones, whatever differs."""
    known = target.select(*[named(k) for k in keys]).distinct().withColumn("_known", F.lit(True))
    label = F.when(F.col("_known"), F.lit("update")).otherwise(F.lit("create"))
    labelled = incoming.join(known, list(keys), "left").withColumn("_action", label).drop("_known")
    return merge_actions(target, labelled, keys, "_action")


def write_jdbc(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None) -> None:
    """Relational table, written in parallel batches; an upsert is merged first and written whole."""
    df.write.format("jdbc").options(url=url, dbtable=table, **(options or {})).mode("overwrite").save()


def rename_mapped(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Listed columns under the names of the sink, in the order listed."""
    return df.select(*[named(a).alias(b) for a, b in mapping.items()])


def backup(df: DataFrame, root: str, day: str, name: str) -> str:
    """Dated copy of a layer table; a second copy of a day is an error."""
    path = f"{root.rstrip('/')}/date={day}/{name}"
    write_files(df, path)
    return path


def as_messages(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows as messages: a key for the topic partition and the row as JSON, ready for a Kafka or file sink."""
    key = F.concat_ws("|", *[named(k).cast("string") for k in keys])
    return df.select(key.alias("key"), F.to_json(F.struct(*[named(c) for c in df.columns])).alias("value"))
