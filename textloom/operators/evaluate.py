"""Retrieval measures, vector-table checks and table profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def judge(ranked: DataFrame, relevant: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mark ranked rows by (query_id, pk) rows of relevant documents, and count those per query."""
    marked = ranked.join(
        relevant.select("query_id", "pk", F.lit(1).alias("hit")), ["query_id", "pk"], "left"
    ).withColumn("hit", F.coalesce("hit", F.lit(0)))
    return marked, relevant.groupBy("query_id").agg(F.count("*").alias("n_relevant"))


def query_measures(marked: DataFrame, relevant_counts: DataFrame, k: int) -> DataFrame:
    """precision, recall, reciprocal rank and nDCG at k of each query with relevant documents.

    `marked` has query_id, rank and hit (0 or 1); `relevant_counts` has
    query_id and n_relevant. A query without results scores 0.
    """
    per_query = (
        marked.where(F.col("rank") <= k)
        .groupBy("query_id")
        .agg(
            F.sum("hit").alias("hits"),
            F.min(F.when(F.col("hit") == 1, F.col("rank"))).alias("first_hit"),
            F.sum(F.col("hit") / F.log2(F.col("rank") + 1)).alias("gain"),
        )
    )
    best = F.least(F.col("n_relevant"), F.lit(k)).cast("int")
    ideal = F.aggregate(
        F.sequence(F.lit(1), best), F.lit(0.0), lambda total, i: total + 1 / F.log2(i + 1)
    )

    def value(col: Column) -> Column:
        return F.coalesce(col, F.lit(0.0))

    return (
        relevant_counts.where(F.col("n_relevant") > 0)
        .join(per_query, "query_id", "left")
        .select(
            "query_id",
            value(F.col("hits") / k).alias("precision"),
            value(F.col("hits") / F.col("n_relevant")).alias("recall"),
            value(1 / F.col("first_hit")).alias("reciprocal_rank"),
            value(F.col("gain") / ideal).alias("ndcg"),
        )
    )


def mean_measures(measures: DataFrame) -> DataFrame:
    """One row: the number of queries and the mean of each measure."""
    return measures.agg(
        F.count("*").alias("queries"),
        *[F.avg(c).alias(c) for c in ("precision", "recall", "reciprocal_rank", "ndcg")],
    )


def check_vectors(table: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """One row: rows, null keys, repeated keys, and null, wrong-length and zero vectors."""
    v = F.col(vector)
    square = F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x)

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    per_key = table.groupBy(key).agg(
        F.count("*").alias("n"),
        count(v.isNull()).alias("null_vectors"),
        count(F.size(v) != dim).alias("wrong_length"),
        count((F.size(v) == dim) & (square == 0)).alias("zero_vectors"),
    )
    return per_key.agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        count(F.col(key).isNotNull() & (F.col("n") > 1)).alias("repeated_keys"),
        F.sum("null_vectors").alias("null_vectors"),
        F.sum("wrong_length").alias("wrong_length"),
        F.sum("zero_vectors").alias("zero_vectors"),
    )


def profile(table: DataFrame, exact: bool = False) -> DataFrame:
    """(column_name, row_count, null_count, distinct_count) for every column.

    Distinct counts are estimates from one pass without a shuffle of values.
    With `exact`, values are reduced to 16-byte digests and counted per
    (column, digest): one shuffle for all columns, and a frequent value is
    added up before it.
    """
    if not exact:
        counted = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.count("*").alias("row_count"),
                F.count_if(F.col(c).isNull()).alias("null_count"),
                F.approx_count_distinct(F.when(F.col(c).isNotNull(), F.md5(F.to_json(F.struct(c))))).alias(
                    "distinct_count"
                ),
            )
            for c in table.columns
        ]
        return table.agg(F.array(*counted).alias("columns")).select(F.inline("columns"))

    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.md5(F.to_json(F.struct(c))).alias("digest"),
                F.col(c).isNull().alias("absent"),
            )
            for c in table.columns
        ]
    )
    counted = (
        table.select(F.explode(cells).alias("cell"))
        .groupBy("cell.column_name", "cell.digest", "cell.absent")
        .agg(F.count("*").alias("n"))
    )
    return counted.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.when(F.col("absent"), F.col("n")).otherwise(0)).alias("null_count"),
        F.sum(F.when(~F.col("absent"), 1).otherwise(0)).alias("distinct_count"),
    )


#: Numeric types of whole numbers that a quantile sketch takes as they are.
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def sketch_batch(batch: DataFrame) -> DataFrame:
    """One row per column that later rows can be merged with: counts and sketches of its values.

    `values` is a HyperLogLog sketch of the different values, `order` a KLL sketch of whole numbers
    (null for columns of other types). Append the rows of each batch to a table: a profile then
    reads a few rows per batch, never the batches again.
    """
    rows = []
    for column, kind in batch.dtypes:
        value = F.col(column)
        whole = kind in _WHOLE
        order = F.kll_sketch_agg_bigint(value.cast("long") if whole else F.lit(None).cast("long"))
        rows.append(
            F.struct(
                F.lit(column).alias("column_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(value.isNull()).alias("null_count"),
                F.hll_sketch_agg(F.when(value.isNotNull(), row_text(column))).alias("values"),
                (order if whole else F.lit(None).cast("binary")).alias("order"),
                (F.min(value).cast("long") if whole else F.lit(None).cast("long")).alias("least"),
                (F.max(value).cast("long") if whole else F.lit(None).cast("long")).alias("most"),
            )
        )
    return batch.agg(F.array(*rows).alias("columns")).select(F.inline("columns"))


def row_text(column: str) -> Column:
    return F.to_json(F.struct(column))


def merged_profile(sketches: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profile of a table from the sketch rows of all its batches.

    Counts, `least` and `most` are exact; `distinct_count` (about 2 % off) and `quantiles` (about
    1 % of the rows off) are estimates. Quantiles are null for columns that are not whole numbers
    and where all values are null.
    """
    merged = sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("distinct_count"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.kll_merge_agg_bigint("order").alias("_order"),
    )
    some = F.col("least").isNotNull()
    quantiles = F.when(some, F.kll_sketch_get_quantile_bigint("_order", F.array(*[F.lit(s) for s in shares])))
    return merged.withColumn("quantiles", quantiles).drop("_order")
