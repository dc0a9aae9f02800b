"""Table and file writers that can be run again after a failure."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class KeyViolation(ValueError):
    """A key column holds a null or a repeated value."""


def overwrite_snapshot(df: DataFrame, path: str) -> None:
    """Replace a table and its schema. `df` must not read from `path`."""
    df.write.mode("overwrite").parquet(path)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table and its schema."""
    df.write.mode("overwrite").saveAsTable(name)


class ForeignTarget(RuntimeError):
    """A table holds batches of another run of its stream."""


def _folder(spark: SparkSession, path: str):
    """File system and path objects of a folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    system, at = _folder(spark, path)
    if not system.exists(at):
        return []
    return sorted(n for n in (f.getPath().getName() for f in system.listStatus(at)) if n.startswith(prefix))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    system, at = _folder(spark, path)
    system.delete(at, True)


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of a stream's run: made with its checkpoint folder, and lost with it."""
    found = _names(spark, checkpoint, "run-")
    if found:
        return found[0].removeprefix("run-")
    new = uuid.uuid4().hex
    system, at = _folder(spark, f"{checkpoint.rstrip('/')}/run-{new}")
    system.mkdirs(at)
    return new


def other_runs(spark: SparkSession, path: str, run: str) -> list[str]:
    """Folders that other runs than `run` have left in a stream's table."""
    return [name for name in _names(spark, path, "run=") if name != f"run={run}"]


def check_claim(spark: SparkSession, path: str, run: str) -> None:
    """Refuse a table that holds batches of another run.

    Batch numbers mean something only within a run: after a lost checkpoint a
    new run numbers from 0 and reads everything again.
    """
    for other in other_runs(spark, path, run):
        raise ForeignTarget(f"{path} holds batches of {other}")


def claim(spark: SparkSession, path: str, run: str) -> None:
    """Remove what other runs left. For when `run` has written all there is."""
    for other in other_runs(spark, path, run):
        remove(spark, f"{path.rstrip('/')}/{other}")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The columns of `schema` of a table; no rows where nothing has been written yet."""
    system, at = _folder(spark, path)
    if not system.exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def make_folder(spark: SparkSession, path: str) -> None:
    """The folder, so that a stream can wait for files in it."""
    system, at = _folder(spark, path)
    system.mkdirs(at)


def append_batch(df: DataFrame, batch_id: int, path: str, run: str = "0") -> None:
    """Write one micro-batch into its own folder, replacing an earlier try.

    A batch that is replayed after a failure overwrites what it left behind,
    also when it has no rows now, and touches no other batch.
    """
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}/batch_id={batch_id}")


def write_version(df: DataFrame, root: str, keep: int = 2) -> DataFrame:
    """Write a snapshot beside the earlier ones and read it back.

    Readers of the version before are not disturbed, and a failed run leaves
    it whole. The last `keep` whole versions stay.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    numbers = sorted(int(n.split("=")[1]) for n in _names(spark, root, "version="))
    target = f"{root}/version={numbers[-1] + 1 if numbers else 0}"
    df.write.mode("overwrite").parquet(target)
    whole = [n for n in numbers if _names(spark, f"{root}/version={n}", "_SUCCESS")]
    stay = whole[len(whole) - keep + 1 :]
    for number in numbers:
        # an unfinished version after the last whole one may be another writer's
        if number not in stay and (number in whole or whole and number < whole[-1]):
            remove(spark, f"{root}/version={number}")
    return spark.read.schema(df.schema).parquet(target)


def write_raw_json(df: DataFrame, path: str) -> None:
    """Raw records as JSON, one record a line."""
    df.write.mode("overwrite").json(path)


def write_raw_run(df: DataFrame, landing: str, name: str) -> str:
    """Raw records of one collection run, in a folder of its own below `landing`; other runs stay."""
    target = f"{landing.rstrip('/')}/run-{name}"
    write_raw_json(df, target)
    return target


def chat_lines(records: DataFrame, messages_col: str = "messages") -> DataFrame:
    """One JSON text per conversation, in column `value`."""
    return records.select(F.to_json(F.struct(F.col(messages_col).alias("messages"))).alias("value"))


def write_chat_jsonl(records: DataFrame, path: str) -> None:
    """Training conversations as JSON Lines; `jobs.train_eval_split` gives the rows of an evaluation file."""
    chat_lines(records).write.mode("overwrite").text(path)


def check_key(df: DataFrame, *keys: str) -> None:
    """Raise when a key is null or occurs twice. Moves key columns only."""
    null: Column = F.lit(False)
    for key in keys:
        null = null | F.col(key).isNull()
    bad = df.groupBy(*keys).agg(F.count("*").alias("n")).where(null | (F.col("n") > 1)).take(1)
    if bad:
        raise KeyViolation(f"key {keys} is null or repeated: {bad[0].asDict()}")


def write_keyed(df: DataFrame, path: str, *keys: str) -> None:
    """A snapshot whose key is checked before anything is written."""
    check_key(df, *keys)
    overwrite_snapshot(df, path)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a catalog table. Start the next run with a fresh checkpoint folder."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
