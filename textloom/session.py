"""Session settings, shared scratch space and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Folders that `materialise` wrote and nobody has dropped.
_SCRATCH: list[str] = []


def spark_session(app: str = "textloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` adds or overrides.

    Shuffle partitions stay at Spark's default on a cluster: AQE merges small
    ones and splits skewed ones. UTC keeps timestamp text stable.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # joins whose partitions turn out small skip the sort
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the cluster's shared checkpoint folder.

    The folder named by `spark.checkpoint.dir` is used. Only a local session
    may fall back to a temporary folder; executors on other machines could not
    read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="textloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to shared storage and read it back.

    Used before a result feeds several actions: it survives the loss of an
    executor and is never computed twice.
    """
    path = shared_dir(df.sparkSession, name)
    _SCRATCH.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    """A place in the list of written intermediate tables, for `drop_scratch`."""
    return len(_SCRATCH)


def drop_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the intermediate tables written since a mark; what was read from them must be done."""
    jvm = spark.sparkContext._jvm
    for path in _SCRATCH[since:]:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    del _SCRATCH[since:]


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when `df` has at most `max_rows` rows; reads no more than it must."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores when the scan of the input makes fewer tasks than the cluster has cores.

    For costly work per row on small inputs. A scan with enough tasks, of many files or of a few
    large ones, is not shuffled. `key` should be unique.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(4 * cores, key)
