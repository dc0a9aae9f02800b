from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import oracle, queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(oracle.SQL))
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, FOLDER)
    with duckdb.connect() as db:
        for table in ("documents", "embeddings", "conversations"):
            db.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
        found = db.execute(oracle.SQL[name])
        names = [c[0] for c in found.description]
        want = [tuple(dict(zip(names, row))[c] for c in sorted(names)) for row in found.fetchall()]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in got.select(*sorted(names)).collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in oracle.SQL])
def test_query_covers_its_table(spark, name):
    rows = queries.QUERIES[name](spark, FOLDER).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    if "doc_id" in rows[0].asDict():
        assert {r.doc_id for r in rows} == ids
    else:
        assert rows
    if name == "op5_sentencepiece":
        assert all(r.round_trip for r in rows)


def test_pipeline_keeps_columns_and_shrinks(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        ids = {r.doc_id for r in docs.collect()}
        assert ids <= before
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        before = ids
    got = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(got.select(*key).collect()) == sorted(docs.select(*key).collect())


CLASHES = ("__a", "__row", "__text", "__fp", "__key", "__n", "__first", "__in0", "__root", "score", "fp", "y")


def test_pipeline_stages_over_odd_rows(spark, odd, docs):
    odd = odd.drop("ids")
    for name in CLASHES:
        odd = odd.withColumn(name, F.lit(name))
    bad = spark.sql("select 77L as doc_id, cast(X'61FF62206320' as string) as text")
    for column in odd.columns[2:]:
        bad = bad.withColumn(column, F.lit(None).cast(odd.schema[column].dataType))
    for frame in (odd.unionByName(bad), odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, FOLDER)
            assert out.columns == frame.columns
            out.count()
