"""Bronze and silver streams.

Every stream has its own checkpoint folder, processes all files that have
arrived since the last run and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import drop_scratch, scratch_mark
from textloom.sinks.tables import append_batch, check_claim, claim, run_id


def append_stream(source: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream to a parquet table: each input file once, also after a restart."""
    (
        source.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def append_stream_table(source: DataFrame, table: str, checkpoint: str) -> None:
    """The same into a catalog table."""
    (
        source.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
        .awaitTermination()
    )


def transform_stream(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    replace: bool = False,
    malformed: Column | None = None,
    quarantine: str | None = None,
) -> None:
    """Run `transform` on every micro-batch and keep its result in that batch's folder.

    With a lost checkpoint everything is read again as a new run. A table that
    holds batches of an earlier run is refused, or with `replace` that run is
    removed once the new one has written all that has arrived; a failure in
    between leaves both, and the next run goes on. Rows that are `malformed`
    do not reach `transform`: they go to the table `quarantine`, batch by batch.
    """
    spark = source.sparkSession
    run = run_id(spark, checkpoint)
    targets = [path] if quarantine is None else [path, quarantine]
    if not replace:
        for target in targets:
            check_claim(spark, target, run)

    def write(batch: DataFrame, batch_id: int) -> None:
        since = scratch_mark()
        if quarantine is not None:
            bad = F.coalesce(malformed, F.lit(False))
            append_batch(stamped(batch.where(bad)), batch_id, quarantine, run)
            batch = batch.where(~bad)
        append_batch(transform(batch), batch_id, path, run)
        drop_scratch(batch.sparkSession, since)

    (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    for target in targets:
        claim(spark, target, run)


def stamped(df: DataFrame) -> DataFrame:
    """With the time of ingestion; one value for a whole batch."""
    return df.withColumn("ingestion_time", F.current_timestamp())
