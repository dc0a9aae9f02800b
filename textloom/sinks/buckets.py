"""Keyed tables in hash buckets of their key, of which a change rewrites only those it touches.

Rows carry a digest of their columns, so a table is compared by its keys and digests alone. A
bucket is a partition folder; touched ones are replaced by dynamic partition overwrite. What is
written never reads the folder it replaces, and every call can be run again after a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import versions
from textloom.session import materialise
from textloom.sinks import tables

BUCKETS = 256
_BUCKET, _DIGEST, _NUMBER = "_bucket", "_digest", "_buckets-"


def bucket_count(spark: SparkSession, path: str, default: int = BUCKETS) -> int:
    """How many buckets a table has; a new one gets the default and keeps it."""
    found = tables._names(spark, path, _NUMBER)
    if not found:
        tables.make_folder(spark, f"{path.rstrip('/')}/{_NUMBER}{default}")
        return default
    return int(found[0].removeprefix(_NUMBER))


def _bucket(key: str, number: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(number)).cast("int")


def _prepared(df: DataFrame, key: str, number: int) -> DataFrame:
    return df.withColumns({_DIGEST: versions.row_digest(sorted(c for c in df.columns if c != key)), _BUCKET: _bucket(key, number)})


def _there(spark: SparkSession, path: str) -> bool:
    return bool(tables._names(spark, path, f"{_BUCKET}="))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table, without bucket and digest."""
    return spark.read.parquet(path).drop(_BUCKET, _DIGEST)


def _replace(rows: DataFrame, path: str, touched: list[int]) -> None:
    """Write `rows`, all of touched buckets, in the place of these; buckets left without rows go."""
    spark = rows.sparkSession
    held = {r[0] for r in rows.select(_BUCKET).distinct().collect()}  # at most as many as buckets
    rows.repartition(_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)
    for bucket in touched:
        if bucket not in held:
            tables.remove(spark, f"{path.rstrip('/')}/{_BUCKET}={bucket}")


def changes(source: DataFrame, path: str, key: str) -> DataFrame:
    """(key, change) of what turns the table into `source`; reads keys and digests of the table only."""
    spark = source.sparkSession
    tables.check_key(source, key)
    number = bucket_count(spark, path)
    new = _prepared(source, key, number).select(key, F.col(_DIGEST).alias("_new"))
    if not _there(spark, path):
        return new.select(key, F.lit("insert").alias("change"))
    old = spark.read.parquet(path).select(key, F.col(_DIGEST).alias("_old"))
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    return old.join(new, key, "full_outer").select(key, change.alias("change")).where("change is not null")


def sync(source: DataFrame, path: str, key: str, changes_path: str) -> DataFrame:
    """Bring the table to the state of `source`; returns the change rows, kept under `changes_path`.

    Change rows that an earlier try has written whole are applied again and not made anew, so
    they say what the version changed even if that try had changed part of the table.
    """
    spark = source.sparkSession
    if not tables._names(spark, changes_path, "_SUCCESS"):
        tables.overwrite_snapshot(changes(source, path, key), changes_path)
    found = spark.read.parquet(changes_path)
    number = bucket_count(spark, path)
    touched = [r[0] for r in found.select(_bucket(key, number)).distinct().collect()]
    if touched:
        rows = _prepared(source, key, number)
        _replace(rows.where(F.col(_BUCKET).isin(touched)), path, touched)
    return found


def upsert(new: DataFrame, path: str, key: str) -> None:
    """Add rows, replacing those of the same key. Buckets without a new key are neither read nor written."""
    spark = new.sparkSession
    tables.check_key(new, key)
    number = bucket_count(spark, path)
    rows = materialise(_prepared(new, key, number), "upsert")
    touched = [r[0] for r in rows.select(_BUCKET).distinct().collect()]
    if not touched:
        return
    if _there(spark, path):
        stored = spark.read.parquet(path).where(F.col(_BUCKET).isin(touched))
        kept = stored.join(rows.select(key), key, "left_anti").select(*rows.columns)
        rows = materialise(kept.unionByName(rows), "upsert")
    _replace(rows, path, touched)


def delete(keys: DataFrame, path: str, key: str) -> None:
    """Remove the rows of the keys; reads and writes their buckets only."""
    spark = keys.sparkSession
    number = bucket_count(spark, path)
    gone = materialise(keys.select(key, _bucket(key, number).alias(_BUCKET)).distinct(), "delete")
    touched = [r[0] for r in gone.select(_BUCKET).distinct().collect()]
    if touched and _there(spark, path):
        stored = spark.read.parquet(path).where(F.col(_BUCKET).isin(touched))
        _replace(materialise(stored.join(gone.select(key), key, "left_anti"), "delete"), path, touched)
