"""Readers of raw files, as batch frames and as incremental streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom import schemas


def _bounded(reader, most_files: int | None):
    """A reader whose micro-batches take at most so many files; None for all that have arrived."""
    return reader if most_files is None else reader.option("maxFilesPerTrigger", most_files)


def stream_json(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = schemas.BRONZE_REPO,
    most_files: int | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """New JSON files of a folder and of the folders of its runs.

    An array of records per file, or with `multi_line=False` one record a line.
    Where the schema has `_corrupt_record` it holds what could not be parsed,
    and `_file`, if asked for, the file a row stands in.
    """
    reader = _bounded(spark.readStream.schema(_without_file(schema)), most_files).option("recursiveFileLookup", True)
    rows = reader.option("multiLine", multi_line).option("columnNameOfCorruptRecord", "_corrupt_record").json(folder)
    return _with_file(rows, schema)


def _without_file(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != "_file"])


def _with_file(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.withColumn("_file", F.col("_metadata.file_path")) if "_file" in schema.names else rows


def stream_binary(
    spark: SparkSession, folder: str, name_glob: str = "*.pdf", most_files: int | None = None
) -> DataFrame:
    """New files of a folder with path, time, length and bytes."""
    return (
        _bounded(spark.readStream, most_files)
        .format("binaryFile")
        .schema(schemas.BRONZE_PDF)
        .option("pathGlobFilter", name_glob)
        .load(folder)
    )


def stream_csv(
    spark: SparkSession, folder: str, schema: T.StructType = schemas.POST_CSV, most_files: int | None = None
) -> DataFrame:
    """New CSV files with a header, one folder level down, and where each row came from.

    Where the schema has `_corrupt_record` it holds rows that do not fit the other columns.
    """
    return (
        _bounded(spark.readStream, most_files)
        .schema(schema)
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("pathGlobFilter", "*.csv")
        .csv(f"{folder.rstrip('/')}/*/")
        .withColumn("filePath", F.col("_metadata.file_path"))
    )


def stream_parquet(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    name_glob: str | None = None,
    most_files: int | None = None,
) -> DataFrame:
    """A table's parquet files as an append-only stream."""
    reader = _bounded(spark.readStream.schema(schema), most_files)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.parquet(folder)


def stream_table(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """The table `name`.parquet of a folder as an append-only stream; it is a file, or a folder of files."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return stream_parquet(spark, path, schema)
    # a stream reads folders, so a single file is picked out of its own
    return stream_parquet(spark, folder, schema, f"{name}.parquet")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path below the folder, name and size of every file, hidden ones too; no content is read."""
    from textloom.sources.repos import list_tree

    return list_tree(spark, folder).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("name"), "size"
    )


def read_html_files(spark: SparkSession, *folders: str) -> DataFrame:
    """Every HTML file below the folders, paths or URIs, as (html_path, html_bytes); absent folders have none."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    there = []
    for folder in folders:
        # reported paths are URIs, with blanks and the like escaped
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder) if ":/" in folder else folder)
        if at.getFileSystem(conf).exists(at):
            there.append(at.toString())
    if not there:
        return spark.createDataFrame([], "html_path string, html_bytes binary")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.html")
        .load(there)
        # the same form of path as stream_csv reports, also with blanks in it
        .select(F.col("_metadata.file_path").alias("html_path"), F.col("content").alias("html_bytes"))
    )


def table_or_path(spark: SparkSession, name: str) -> DataFrame:
    """A parquet folder when the name has a slash, else a catalog table."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def describe(spark: SparkSession, table: str, extended: bool = False) -> DataFrame:
    """Columns and types of a catalog table, with storage details on request."""
    return spark.sql(f"DESCRIBE TABLE {'EXTENDED ' if extended else ''}{table}")
