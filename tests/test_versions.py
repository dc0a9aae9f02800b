from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.operators import filters, versions
from textloom.plans import jobs, layers
from textloom.session import shared_dir
from textloom.sinks import buckets, tables

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


@pytest.fixture
def posts(spark):
    rows = [("a", T0, "1"), ("a", T0, "1"), ("a", T1, "2"), ("b", None, "3"), ("b", T0, "4"), (None, T1, "5"), ("c", T1, "6")]
    return spark.createDataFrame(rows, "post_id string, ingestion_time timestamp, text string")


def test_first_with_ties_equals_rank_one(posts):
    ranked = versions.rank_versions(posts, ["post_id"], "ingestion_time").where("rank = 1").drop("rank")
    picked = versions.pick_version(posts, ["post_id"], "ingestion_time")
    assert sorted(map(str, picked.collect())) == sorted(map(str, ranked.collect()))
    assert picked.count() == 5  # both copies of a, the null time of b, the null key, c


def test_last_and_single(posts):
    last = versions.pick_version(posts, ["post_id"], "ingestion_time", keep="last")
    assert sorted(r.text for r in last.collect()) == ["2", "4", "5", "6"]
    single = versions.pick_version(posts, ["post_id"], "ingestion_time", ties=False)
    assert sorted(r.text for r in single.collect()) == ["1", "3", "5", "6"]
    with pytest.raises(ValueError):
        versions.pick_version(posts, ["post_id"], "ingestion_time", keep="any")


def test_one_key_with_most_rows_keeps_all_copies(spark):
    frame = spark.range(3000).select(
        F.when(F.col("id") < 2000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(1).alias("t"), "id")
    assert versions.pick_version(frame, ["k"], "t").count() == 3000


def test_file_id_with_missing_parts(spark):
    frame = spark.createDataFrame([("f", "r", "20240917172131"), ("f", "r", "bad"), ("f", None, None)],
                                  "file_name string, repo string, timestamp string")
    ids = [r.gitrepo_file_id for r in versions.with_file_id(frame).collect()]
    assert ids == ["f-r-2024-09-17 17:21:31", "f-r", "f"]


def test_versions_of_a_file_have_different_keys(spark):
    frame = spark.createDataFrame(
        [("c1", "f", "r", "20240101000000", "t", None), ("c2", "f", "r", "20240201000000", "t", None)],
        "content string, file_name string, repo string, timestamp string, text string, text_vector array<float>")
    assert layers.gold_repo(frame).count() == 2
    assert [r.content for r in layers.gold_repo_latest(frame).collect()] == ["c2"]


def test_exclude_keys(posts, spark):
    none = spark.createDataFrame([], "post_id string")
    assert versions.exclude_keys(posts, none, "post_id").count() == posts.count()
    bad = spark.createDataFrame([("a",), ("a",)], "post_id string")
    assert versions.exclude_keys(posts, bad, "post_id").count() == 4


def test_upsert_replaces_known_keys(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "post_id string, query string")
    new = spark.createDataFrame([("b", "3"), ("c", "4")], "post_id string, query string")
    assert sorted(map(tuple, versions.upsert(old, new, "post_id").collect())) == [("a", "1"), ("b", "3"), ("c", "4")]


def test_key_check(spark):
    for rows in ([("a",), ("a",)], [(None,)]):
        with pytest.raises(tables.KeyViolation):
            tables.check_key(spark.createDataFrame(rows, "k string"), "k")


def test_changes_see_nulls_and_nested_values(spark):
    schema = "k string, a string, b string, v array<float>"
    old = spark.createDataFrame([("same", "x", None, [1.0]), ("moved", "x", None, [1.0]), ("vec", "x", "y", [1.0, None]), ("gone", "", "", [])], schema)
    new = spark.createDataFrame([("same", "x", None, [1.0]), ("moved", None, "x", [1.0]), ("vec", "x", "y", [None, 1.0]), ("new", "", "", [])], schema)
    changes = {r.k: r.change for r in versions.change_rows(old, new, "k").collect()}
    assert changes == {"moved": "update", "vec": "update", "gone": "delete", "new": "insert"}


def test_sync_reaches_the_source_state(spark):
    root = shared_dir(spark, "sync")
    first = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    second = spark.createDataFrame([("a", 1), ("b", 9), ("d", 4)], "k string, v int")
    assert {r.change for r in jobs.sync_vectors(first, "k", root, 0).collect()} == {"insert"}
    changes = {r.k: r.change for r in jobs.sync_vectors(second, "k", root, 1).collect()}
    assert changes == {"b": "update", "c": "delete", "d": "insert"}
    # a second try of the same version gives the same table and the same changes
    assert {r.k for r in jobs.sync_vectors(second, "k", root, 1).collect()} == {"b", "c", "d"}
    assert sorted(map(tuple, buckets.read(spark, f"{root}/table").collect())) == [("a", 1), ("b", 9), ("d", 4)]
    assert jobs.sync_vectors(second, "k", root, 2).count() == 0
    gone = spark.createDataFrame([], "k string, v int")
    assert jobs.sync_vectors(gone, "k", root, 3).count() == 3
    assert not list(Path(root, "table").glob("_bucket=*"))


def times(root):
    return {p.parent.name: p.stat().st_mtime_ns for p in Path(root).glob("_bucket=*/*.parquet")}


def test_a_change_of_one_key_rewrites_one_bucket(spark, tmp_path):
    rows = [(f"k{i}", i, [float(i)]) for i in range(200)]
    schema = "k string, _v int, vector array<float>"
    root = str(tmp_path / "vectors")
    frame = lambda r: spark.createDataFrame(r, schema)
    jobs.sync_vectors(frame(rows), "k", root, 0)
    before = times(f"{root}/table")
    assert len(before) > 50
    jobs.sync_vectors(frame([("k7", -1, [0.5])] + [r for r in rows if r[0] != "k7"]), "k", root, 1)
    after = times(f"{root}/table")
    assert sum(before[b] != after[b] for b in before) == 1 and before.keys() == after.keys()
    buckets.upsert(frame([("k9", 99, None), ("new", 1, [])]), f"{root}/table", "k")
    last = times(f"{root}/table")
    assert sum(after.get(b) != t for b, t in last.items()) <= 2
    got = {r.k: r._v for r in buckets.read(spark, f"{root}/table").collect()}
    assert got == {**{k: i for k, i, _ in rows}, "k7": -1, "k9": 99, "new": 1}
    buckets.delete(spark.createDataFrame([("k9",), ("nobody",)], "k string"), f"{root}/table", "k")
    assert buckets.read(spark, f"{root}/table").count() == 200
    with pytest.raises(tables.KeyViolation):
        buckets.upsert(frame([("a", 1, []), ("a", 2, [])]), f"{root}/table", "k")


def test_changes_of_a_failed_version_are_applied_again(spark, tmp_path):
    root = str(tmp_path / "v")
    jobs.sync_vectors(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), "k", root, 0)
    new = spark.createDataFrame([("a", 5), ("c", 3)], "k string, v int")
    # a try that wrote the changes and nothing else
    tables.overwrite_snapshot(buckets.changes(new, f"{root}/table", "k"), f"{root}/changes=1")
    assert {r.k: r.change for r in jobs.sync_vectors(new, "k", root, 1).collect()} == {"a": "update", "b": "delete", "c": "insert"}
    assert sorted(map(tuple, buckets.read(spark, f"{root}/table").collect())) == [("a", 5), ("c", 3)]


@pytest.fixture
def hot(spark):
    """One key over all ranges, with order values that tie across them, nulls, and small keys beside it."""
    rows = [("hot", 5 if i % 3 else i // 40, f"t{i % 50}") for i in range(900)]
    rows += [(None, None, "n")] * 4 + [(None, 1, "n"), ("a", None, "x"), ("a", None, "x"), ("z", 3, "y"), ("z", 1, "y")]
    return spark.createDataFrame(rows, "k string, o int, t string").repartition(6)


def test_ranks_over_ranges(spark, hot):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = versions.rank_versions(hot, ["k"], "o")
        numbered = versions.number_rows(hot, ["k"], "t", "n")
        parts = versions.rows_before(hot.groupBy("k", "o", "t").count(), ["k"], ["o", "t"], "count", "b")
        got, numbered, parts = (sorted(map(str, f.collect())) for f in (got, numbered, parts))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = Window.partitionBy("k").orderBy("o")
    assert got == sorted(map(str, hot.withColumn("rank", F.rank().over(order)).collect()))
    full = Window.partitionBy("k").orderBy("t", "o")
    assert numbered == sorted(map(str, hot.withColumn("n", F.row_number().over(full)).collect()))
    counted = hot.groupBy("k", "o", "t").count()
    sums = F.coalesce(F.sum("count").over(Window.partitionBy("k").orderBy("o", "t").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    assert parts == sorted(map(str, counted.withColumn("b", sums).collect()))
    empty = hot.where("k = 'nobody'")
    assert versions.rank_versions(empty, ["k"], "o").count() == versions.number_rows(empty, ["k"], "t").count() == 0


def test_bloom_filters_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(filters, "EXACT_KEYS", 10)
    keys = spark.range(0, 30_000, 3).select(F.col("id").cast("string").alias("k"))
    keys = keys.unionByName(spark.createDataFrame([(None,), ("3",)], "k string"))
    rows = spark.range(60_000).select(F.when(F.col("id") != 7, F.col("id").cast("string")).alias("k"), F.lit("x").alias("_maybe2"))
    kept = filters.among(rows, keys, "k")
    assert kept.join(keys, "k", "left_semi").count() == 10_000
    assert kept.count() < 10_000 + 0.02 * 50_000
    out = filters.not_among(rows, keys, "k")
    assert out.count() == 50_000 and out.where("k is null").count() == 1 and out.columns == rows.columns
    monkeypatch.setattr(filters, "FILTER_KEYS", 100)
    assert filters.among(rows, keys, "k").count() == 60_000
    assert filters.not_among(rows, keys, "k").count() == 50_000
