"""File scans and listings.

Listings come from the ``binaryFile`` source with the content column pruned: the names stay a distributed
table, and no file is opened.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.keys import named
from stratalake.functions.temporal import folder_date

# Options of the CSV drops.
CSV_OPTIONS = {"quote": '"', "escape": "\\", "encoding": "UTF-8", "header": "true", "multiLine": "true"}
# Options of the CSV snapshots.
SNAPSHOT_CSV_OPTIONS = {
    "header": "true",
    "inferSchema": "true",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
CORRUPT = "_corrupt_record"


def read_files(
    spark: SparkSession,
    fmt: str,
    paths: str | Sequence[str],
    options: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Any built-in format, one path or many."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load([paths] if isinstance(paths, str) else list(paths))


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")


def read_snapshot_table(spark: SparkSession, path: str) -> DataFrame:
    """Table addressed by path: Delta where its log is there and the connector is on the class path."""
    if is_delta(spark, path):
        return spark.read.format("delta").load(path)
    return spark.read.parquet(path)


def is_delta(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_delta_log")
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def exact(paths: Sequence[str]) -> list[str]:
    """Paths that a reader takes as they are; it would read ``*?[]{}`` and a backslash as a pattern."""
    return [re.sub(r"([*?\[\]{}\\])", r"\\\1", p) for p in paths]


def read_csv_strict(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, multi_line: bool = True, file_col: str | None = None
) -> DataFrame:
    """CSV that fails the query on the first row that does not fit its header.

    The row is checked while it is read, so there is no extra pass. Files without line breaks inside quotes can
    be read with ``multi_line=False``, which lets Spark split one large file over many tasks. ``file_col`` adds the file
    that each row came from.
    """
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower()}
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = read_files(
        spark, "csv", paths, {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}, full
    )
    # The message names every column, so that no later pruning keeps the parser from checking one.
    seen = F.concat_ws(", ", *[named(f.name).cast("string") for f in schema.fields])
    text = F.concat(F.lit("corrupt CSV record: "), F.col(CORRUPT), F.lit(" read as "), seen)
    fits = F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    if file_col:
        raw = raw.withColumn(file_col, plain_path("_metadata.file_path"))
    return raw.filter(fits).drop(CORRUPT)


def csv_schema(spark: SparkSession, path: str, multi_line: bool = True) -> T.StructType:
    """All-text schema from the header of one CSV file; ``multi_line`` if the header may have line breaks."""
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower(), "inferSchema": "false"}
    names = spark.read.options(**options).csv(path).columns
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_any(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV or JSON by the end of the name; anything else is an error."""
    lower = path.lower()
    if lower.endswith(".csv"):
        return read_csv_strict(spark, path, schema or csv_schema(spark, path), multi_line)
    if lower.endswith(".json"):
        return read_files(spark, "json", path, {"multiLine": str(multi_line).lower()}, schema)
    raise ValueError(f"neither CSV nor JSON: {path}")


def read_messages(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Message files with a declared schema, and the file every message came from."""
    return read_files(spark, "json", paths, {"recursiveFileLookup": "true"}, schema).withColumn(
        "input_file", plain_path("_metadata.file_path")
    )


def read_nested_snapshot(spark: SparkSession, path: str, element: T.StructType, array: str = "value") -> DataFrame:
    """Snapshot documents ``{value: [...]}``: one row per element."""
    schema = T.StructType([T.StructField(array, T.ArrayType(element))])
    docs = read_files(spark, "json", path, {"multiLine": "true", "recursiveFileLookup": "true"}, schema)
    return docs.select(F.explode(named(array)).alias("_e")).select("_e.*")


def read_csv_snapshot(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """CSV of the newest dated folder."""
    return read_files(spark, "csv", newest_dated_folder(spark, root, glob), SNAPSHOT_CSV_OPTIONS)


def read_history(
    spark: SparkSession,
    root: str,
    fmt: str,
    name: str,
    options: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Every file below a folder whose name holds a fragment and has the extension of the format, as one frame."""
    extra = {"recursiveFileLookup": "true", "pathGlobFilter": f"*{name}*.{fmt}"}
    return read_files(spark, fmt, root, {**(options or {}), **extra}, schema)


def local_path(path: str) -> Column:
    """One way to write a local path: ``file:/`` with one slash."""
    return F.regexp_replace(F.col(path), "^file:/+", "file:/")


def plain_path(path: str) -> Column:
    """Path of a file's metadata, which is URL-encoded, as a listing writes it."""
    literal_plus = F.regexp_replace(F.col(path), r"\+", "%2B")
    return F.regexp_replace(F.url_decode(literal_plus), "^file:/+", "file:/")


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Path, size and modification time of every file below a folder."""
    options = {"recursiveFileLookup": "true", **({"pathGlobFilter": glob} if glob else {})}
    found = read_files(spark, "binaryFile", root, options)
    return found.select(local_path("path").alias("path"), "modificationTime", "length")


def newest_folder_by_name(files: DataFrame, path: str = "path") -> DataFrame:
    """One row: the newest ``yyyy-MM-dd`` folder in a listing; other folders are ignored."""
    return files.agg(F.max(folder_date(path)).alias("folder_date"))


def newest_folder_by_time(files: DataFrame, path: str = "path") -> DataFrame:
    """One row: the folder that holds the most recently changed file."""
    folder = F.regexp_extract(named(path), r"^(.*)/[^/]*$", 1)
    return files.agg(F.max_by(folder, F.struct(F.col("modificationTime"), folder)).alias("folder"))


def newest_dated_folder(spark: SparkSession, root: str, glob: str | None = None) -> str:
    """Path of the newest dated folder: one aggregated row reaches the driver, which needs it to open the files."""
    newest = newest_folder_by_name(list_files(spark, root, glob)).first()["folder_date"]
    if newest is None:
        raise FileNotFoundError(f"no yyyy-MM-dd folder below {root}")
    return f"{root.rstrip('/')}/{newest.isoformat()}"


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as one value each, for configuration documents."""
    return spark.read.text(path, wholetext=True)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split: tuple[str, str, str, int] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Relational table. ``split`` (column, low, high, parts) reads it in parallel ranges; the ends are open."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    if split:
        col, low, high, parts = split
        reader = reader.options(partitionColumn=col, lowerBound=low, upperBound=high, numPartitions=str(parts))
    return reader.load()


def read_landed_pages(
    spark: SparkSession, root: str, schema: T.StructType, key: Sequence[str], newest_by: str, multi_line: bool = True
) -> DataFrame:
    """Landed pages of a paged extract as one frame; a record that came with several pages counts once.

    A page is one JSON array over many lines; pages of one record a line are read with ``multi_line=False``, which
    lets Spark split a large one over many tasks.
    """
    from stratalake.operators.latest import latest_per_key

    options = {"multiLine": str(multi_line).lower(), "recursiveFileLookup": "true"}
    return latest_per_key(read_files(spark, "json", root, options, schema), key, [newest_by])


def read_landed_sheet(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Spreadsheet extract, landed as CSV; its cells may hold line breaks unless ``multi_line`` is off."""
    return read_csv_strict(spark, path, schema, multi_line)
