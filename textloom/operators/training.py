"""Training set: question, retrieved context, token budget, features, chat records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as X

# -- fixed values --------------------------------------------------------------
TOKEN_BUDGET = 8000
SCORE_FLOOR = 0.5
RESULTS_PER_SOURCE = 7
# -- end of fixed values -------------------------------------------------------


def with_question(posts: DataFrame) -> DataFrame:
    """Add topic and topic_question."""
    return posts.withColumn("topic", X.topic(F.col("title"), F.col("subtitle"))).withColumn(
        "topic_question", X.topic_question(F.col("topic"))
    )


def with_query(posts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Add query: the question followed by what was retrieved for it."""
    asked = posts.join(contexts.withColumnRenamed("query_id", "post_id"), "post_id", "left")
    return asked.select("*", F.concat("topic_question", "context").alias("query"))


def within_budget(
    rows: DataFrame, target: str = "text", query: str = "query", budget: int = TOKEN_BUDGET
) -> DataFrame:
    """Rows whose texts together stay below the budget; `total_token_count` says how long they are."""
    both = X.token_count(F.col(target)) + X.token_count(F.col(query))
    return rows.select("*", both.alias("total_token_count")).where(F.col("total_token_count") < budget)


def training_set(labels: DataFrame, features: DataFrame, key: str = "post_id") -> DataFrame:
    """Each label row with the features of its key; rows without features stay."""
    return labels.join(features, key, "left")


def chat_records(rows: DataFrame) -> DataFrame:
    """(post_id, messages): one training conversation per row."""
    return rows.select("post_id", X.chat_record(F.col("query"), F.col("text")).alias("messages"))
