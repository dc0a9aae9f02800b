"""Keyed and versioned tables: choice of versions, deny-lists, keys, upserts and change rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.filters import not_among
from textloom.session import materialise
from textloom.sinks.tables import check_key


def rows_before(counts: DataFrame, keys: list[str], order: list[str], number: str, out: str) -> DataFrame:
    """Adds the sum of `number` over the rows of the same key that come before in the order.

    `counts` has one row per key and order. No task needs a whole key: ranges over (key, order)
    are written, sums run within a range, and only the first and the last key of a range can
    reach into others. The totals of those, at most two per range, are summed up and sent to all.
    """
    place = F.spark_partition_id().alias("_range")
    placed = materialise(counts.repartitionByRange(*keys, *order).select("*", place), "ranges")
    key = F.struct(*keys)
    ends = placed.groupBy("_range").agg(F.min(key).alias("_low"), F.max(key).alias("_high"))
    ends = materialise(ends, "range-ends")
    reaching = placed.join(F.broadcast(ends), "_range").where((key == F.col("_low")) | (key == F.col("_high")) | key.isNull())
    totals = reaching.groupBy("_range", *keys).agg(F.sum(number).alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_range").alias("_at"), key.alias("_key"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")
    )
    offsets = materialise(offsets, "range-offsets")
    inside = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("_within", F.coalesce(F.sum(number).over(inside), F.lit(0)))
    met = within.join(F.broadcast(offsets), (F.col("_range") == F.col("_at")) & key.eqNullSafe(F.col("_key")), "left")
    before = F.col("_within") + F.coalesce("_offset", F.lit(0))
    return met.select(*counts.columns, before.alias(out))


def rank_versions(df: DataFrame, keys: list[str], order: str, out: str = "rank") -> DataFrame:
    """`rank()` of each row among the versions of its key, oldest first, nulls before all.

    Rows are counted per key and order first, ranks come from `rows_before`, and rows find theirs
    by a join, which AQE splits where one order value holds many rows. For a filter on rank 1 use
    `pick_version`.
    """
    names = [f"_key_{k}" for k in keys]
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(order).alias("_order")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    ranked = materialise(rows_before(counts, names, ["_order"], "_n", "_before"), "ranks")
    match = F.col(order).eqNullSafe(F.col("_order"))
    for key, name in zip(keys, names):
        match = match & F.col(key).eqNullSafe(F.col(name))
    return df.join(ranked, match).select(*df.columns, (F.col("_before") + 1).cast("int").alias(out))


def number_rows(df: DataFrame, keys: list[str], order: str, out: str = "row_number") -> DataFrame:
    """`row_number()` of each row within its key; rows that tie follow their other columns.

    Equal rows are counted as one and unfolded at the end, so neither a large key nor many copies
    of a row meet in one task. Columns must be of types that can be grouped.
    """
    others = [c for c in df.columns if c not in (*keys, order)]
    counts = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    placed = rows_before(counts, keys, [order, *others], "_n", "_before")
    numbers = F.explode(F.sequence(F.col("_before") + 1, F.col("_before") + F.col("_n")))
    return placed.select(*df.columns, numbers.alias(out)).withColumn(out, F.col(out).cast("int"))


def pick_version(
    df: DataFrame,
    keys: list[str],
    order: str,
    keep: str = "first",
    ties: bool = True,
    tie_break: Column | None = None,
) -> DataFrame:
    """Rows of the first or last version of each key. Nulls order first.

    With `ties`, all rows that share the chosen order value stay, as under
    `rank() = 1`. One key may hold a large part of the table, all of it tied;
    so the chosen value comes from an aggregate that shrinks before the
    shuffle, and a join, whose large partitions AQE can split, finds the rows.
    Without `ties` one row per key stays; among rows of the same order value
    `tie_break` decides as the order does, then a digest of the row, so that
    a rerun keeps the same one. Each task
    reduces its rows to one per key before the shuffle; nothing is sorted by
    its texts.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    first = keep == "first"
    if not ties:
        row = F.struct(*df.columns)
        digest = row_digest(df.columns)
        first_break = F.lit(None).cast("string") if tie_break is None else tie_break
        place = F.struct(F.col(order).alias("_order"), first_break.alias("_tie"), digest.alias("_digest"))
        names = [f"_key_{k}" for k in keys]
        marked = df.select(
            *[F.col(k).alias(n) for k, n in zip(keys, names)], place.alias("_place"), row.alias("_row")
        )
        best = F.min_by if first else F.max_by
        return marked.groupBy(*names).agg(best("_row", "_place").alias("_row")).select("_row.*")

    extreme = F.min(order) if first else F.max(order)
    if first:
        extreme = F.when(F.bool_or(F.col(order).isNull()), F.lit(None)).otherwise(extreme)
    chosen = df.groupBy(*keys).agg(extreme.alias("_chosen"))
    chosen = chosen.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_chosen")
    match = F.col(order).eqNullSafe(F.col("_chosen"))
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return df.join(chosen, match, "left_semi")


def exclude_keys(df: DataFrame, denied: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the deny-list; an empty list keeps everything, a null key stays."""
    return not_among(df, denied, key)


def upsert(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """`new` plus the rows of `old` whose key `new` does not have."""
    check_key(new, *keys)
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    return new.unionByName(kept.select(new.columns))


def with_file_id(silver: DataFrame) -> DataFrame:
    """Parse the time and add the file key `file_name-repo-time`; null parts are left out."""
    return silver.withColumn(
        "timestamp", F.try_to_timestamp("timestamp", F.lit("yyyyMMddHHmmss"))
    ).withColumn(
        "gitrepo_file_id",
        F.concat_ws("-", "file_name", "repo", F.col("timestamp").cast("string")),
    )


def with_chunk_id(silver: DataFrame) -> DataFrame:
    """Add the chunk key `path_number`."""
    return silver.withColumn("pdf_chunk_id", F.concat_ws("_", "path", "row_number"))


def with_digest(df: DataFrame, key: str, out: str = "digest") -> DataFrame:
    """A digest of all columns but the key, equal only for equal rows.

    JSON keeps nulls and nested values apart, which `xxhash64` of columns does
    not: it skips nulls.
    """
    return df.withColumn(out, row_digest([c for c in sorted(df.columns) if c not in (key, out)]))


def row_digest(columns: list[str]) -> Column:
    """A digest of the columns that is equal only for equal values."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def change_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """What turns snapshot `old` into `new`: the key and insert, update or delete.

    Only keys and digests are shuffled. Both keys must be unique and not null.
    """
    check_key(old, key)
    check_key(new, key)
    before = with_digest(old, key, "_old").select(key, "_old")
    after = with_digest(new, key, "_new").select(key, "_new")
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    return (
        before.join(after, key, "full_outer")
        .select(key, change.alias("change"))
        .where(F.col("change").isNotNull())
    )


def apply_changes(old: DataFrame, new: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The next snapshot: `old` without changed keys, plus inserted and updated rows of `new`."""
    written = changes.where(F.col("change") != "delete").select(key)
    kept = old.join(changes.select(key), key, "left_anti")
    return kept.unionByName(new.join(written, key, "left_semi"))
