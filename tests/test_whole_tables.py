"""Queries on tables with a large group: no file, array or task holds all of it."""

from __future__ import annotations

import glob
import os
from collections import Counter

from textloom import session
from textloom.operators import context
from textloom.plans import catalogue, jobs


def test_text_files_of_a_large_source_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "FILE_BYTES", 4000, raising=False)
    sources = ["hot"] * 2000 + ["a", "a", "b"] + [None] * 400
    rows = [(i, f"text of\ndocument {i:5}", s) for i, s in enumerate(sources)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    root = catalogue._text_files(spark, str(tmp_path), "landing")
    sizes = {f: os.path.getsize(f) for f in glob.glob(f"{root}/source=*/*.txt")}
    wanted = Counter()
    for _, text, source in rows:
        wanted[source or "__HIVE_DEFAULT_PARTITION__"] += len(text) + 1
    got = Counter()
    for path, size in sizes.items():
        got[path.split("source=")[1].split("/")[0]] += size
    assert got == wanted
    assert max(sizes.values()) < wanted["hot"] / 2 and len(glob.glob(f"{root}/source=a/*.txt")) == 1
    for query in (catalogue.stream_binary, catalogue.file_listing):
        assert {r.source: r["size"] for r in query(spark, str(tmp_path)).collect()} == wanted


def test_arrays_of_messages_are_bounded(spark, tmp_path, monkeypatch):
    rows = [(1, i, "user", f"text {i}") for i in range(700)] + [(1, 699, "user", "text tied")] * 300
    rows += [(2, None, "user", "no turn"), (2, 0, "user", "first"), (3, 5, "assistant", None), (None, 1, None, "no id")] * 2
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = catalogue.last_message_nested(spark, str(tmp_path)).collect()
    assert {(r.query_id, r.request) for r in found} == {(1, "text tied"), (2, "first"), (3, None), (None, "no id")}
    assert len(found) == 4
    # the sizes of the arrays in place of the messages
    monkeypatch.setattr(catalogue.X, "last_message", lambda messages: catalogue.F.size(messages).cast("string"))
    sizes = catalogue.last_message_nested(spark, str(tmp_path)).collect()
    assert max(int(r.request) for r in sizes) <= 64


def test_restarted_stream_reads_many_files_in_a_batch(spark, tmp_path, monkeypatch):
    rows = [(i, f"<html><body>page {i}</body></html>") for i in range(200)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    pages = spark.read.parquet(f"{tmp_path}/pages.parquet").repartition(4)
    monkeypatch.setattr(catalogue, "table", lambda spark, folder, name: pages)
    source, stream = [], catalogue.files.stream_parquet
    monkeypatch.setattr(
        catalogue.files, "stream_parquet", lambda spark, folder, *a, **b: source.append(folder) or stream(spark, folder, *a, **b)
    )
    found = catalogue.stream_silver_restart(spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.text.strip()) for r in found) == [(i, f"page {i}") for i in range(200)]
    assert len(set(source)) == 1 and len(glob.glob(f"{source[0]}/*.parquet")) >= 4


def test_only_texts_with_a_vector_are_shuffled_to_meet_it(spark, tmp_path):
    vectors = [(i, [float(i)] * 64, i % 10) for i in (3, 7, 8, 8)] + [(None, [1.0] * 64, 1)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    docs = [(i, f"text {i}") for i in range(8)] + [(3, None), (None, "no key")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalogue.two_sources(spark, str(tmp_path))
    rows = {name: sorted((r.pk or 0, r.text) for r in part.collect()) for name, part in found.items()}
    assert rows == {jobs.REPO: [(0, ""), (3, ""), (3, "text 3")], jobs.PDF: [(7, "text 7"), (8, ""), (8, "")]}
    for part in found.values():
        assert "LeftSemi" in part._jdf.queryExecution().optimizedPlan().toString()


def test_texts_of_training_rows_are_moved_once(spark, tmp_path):
    docs = [(i, f"knowledge and best practice for subject {i}\n" * 30, "en", f"src{i % 3}", 900) for i in range(40)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    html = "<html><title>subject {0}</title><h1>on {0}</h1><p>answer {0}</p></html>"
    pages = [(i, f"https://h{i % 2}.net/p{i}", html.format(i)) for i in range(12)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    mark = session.scratch_mark()
    rows = catalogue.training_records(spark, str(tmp_path)).collect()
    assert len(rows) == 12 and all(f"for subject {r.post_id}\n" in r["query"] for r in rows)
    written = {os.path.basename(p)[:-33]: spark.read.parquet(p).columns for p in session._SCRATCH[mark:]}
    # of the tables written on the way only the posts hold texts
    assert {name for name, columns in written.items() if {"text", "context"} & set(columns)} == {"posts"}
    assert written["repo-vectors"] == written["chunk-vectors"] == ["pk", "vector"]


def test_few_results_are_sent_to_the_texts(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([("a", "text a"), ("b", "text b"), ("c", None), (None, "no key"), ("b", "twice")], "pk string, text string")
    docs.write.parquet(f"{tmp_path}/docs")
    rows = [(1, "b", 1), (1, "c", 2), (2, "b", 1), (3, None, 1), (3, "z", 2)]
    found = spark.createDataFrame(rows, "query_id bigint, pk string, rank int")
    docs, limit = spark.read.parquet(f"{tmp_path}/docs"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = context.with_text(found, docs)
        plan = met._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        sent = sorted((r.query_id, r.pk, r["rank"], r.text or "") for r in met.collect())
        monkeypatch.setattr(context, "SENT_RESULTS", 2, raising=False)
        many = sorted((r.query_id, r.pk, r["rank"], r.text or "") for r in context.with_text(found, docs).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sent == many == [(1, "b", 1, "text b"), (1, "b", 1, "twice"), (1, "c", 2, ""), (2, "b", 1, "text b"), (2, "b", 1, "twice")]
