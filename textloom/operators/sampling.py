"""Bounded samples that no single task has to gather from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smallest_hashes(df: DataFrame, columns: list[str], most: int, total: int) -> DataFrame:
    """The `most` rows with the smallest hash of the columns, of a table of about `total` rows.

    Rows clearly beyond are dropped where they lie, so the tasks together hand on about twice
    `most` rows however many tasks there are. Should chance or many equal rows leave fewer below
    the limit, the sample is as much smaller.
    """
    place = F.xxhash64(*columns)
    if total > 4 * most:
        df = df.where(place < F.lit(int(-(2**63) + 2 * most / total * 2**64)))
    return df.orderBy(place, *columns).limit(most)
