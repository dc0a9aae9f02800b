"""Files in, tables out: streams, layers, training set and prompts on small inputs."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from textloom import schemas, session
from textloom.functions.embed import embed_text
from textloom.operators import training
from textloom.plans import jobs, layers
from textloom.sinks import tables
from textloom.sources import files, repos
from textloom.streaming.jobs import append_stream, append_stream_table, transform_stream


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_checkouts_are_routed_keyed_and_cleaned(spark, tmp_path):
    root = tmp_path / "checkouts"
    book = json.dumps({"cells": [{"source": ["a b\n"]}, {"source": "c d"}]})
    for path, text in {
        "r1/.github/a.py": "x",
        "r1/x/.git/b.py": "kept 1",
        "r1/__init__.py": "_ = 1",
        "r1/c.csv": "x",
        "r1/d.yml": "x",
        "r1/Dockerfile": "FROM x",
        "r1/sub/Dockerfile": "FROM y",
        "r1/e.PY": "x",
        "r1/n.ipynb": book,
        "r1/a/same.py": "first one",
        "r1/b/same.py": "second one",
        "r2/conf/v.yaml": "k: v\tw",
        "r2/.gitignore": "x",
    }.items():
        write(root / path, text)
    read = repos.read_checkouts(spark, str(root))
    from textloom.functions.text import utf8_text

    routed = repos.route_files(read.withColumn("content", utf8_text(F.col("content"))))
    found = {(r.repo, r.file_name): r.content for r in repos.resolve_collisions(routed).collect()}
    assert found == {
        ("r1", "b.py"): "kept1",
        ("r1", "__init__.py"): "_=1",
        ("r1", "Dockerfile"): "FROMx",
        ("r1", "sub/Dockerfile"): "FROMy",
        ("r1", "n.ipynb"): "a b\n\nc d",
        ("r1", "same.py"): "secondone",
        ("r2", "conf/v.yaml"): "k:v\tw",
    }
    deep = repos.route_files(read.withColumn("content", utf8_text(F.col("content"))), any_depth=True)
    assert deep.where("file_name = 'b.py'").count() == 0
    listed = {r.name: r.size for r in files.list_files(spark, str(root)).collect()}
    assert listed["c.csv"] == 1 and listed["__init__.py"] > 0 and ".gitignore" in listed


def test_recent_repositories(spark):
    run = dt.datetime(2024, 9, 17)
    day = dt.timedelta(days=1)
    rows = [
        ("young", "u1", False, run - 30 * day + dt.timedelta(hours=1)),
        ("old", "u2", False, run - 30 * day),
        ("future", "u3", False, run + day),
        ("private", "u4", True, run),
        ("twice", "u5", False, run - 2 * day),
        ("twice", "u6", False, run - day),
    ]
    frame = spark.createDataFrame(rows, schemas.REPOS)
    got = {r.name: r.html_url for r in repos.recent_repos(frame, run).collect()}
    assert got == {"young": "u1", "future": "u3", "twice": "u6"}


def test_repos_from_json_to_gold_in_two_runs(spark, tmp_path):
    landing, root = tmp_path / "raw", str(tmp_path / "lake")
    record = {"file_name": "a.py", "content": "Spark reads files. It writes tables.", "timestamp": "20240917172131", "repo": "r"}
    write(landing / "data_1.json", json.dumps([record, record, {**record, "file_name": "b.py", "extra": 1}], indent=4))
    gold = jobs.ingest_repos(spark, str(landing), root)
    assert sorted(r.gitrepo_file_id for r in gold.collect()) == [
        "a.py-r-2024-09-17 17:21:31", "a.py-r-2024-09-17 17:21:31", "b.py-r-2024-09-17 17:21:31"]
    row = gold.first()
    assert row.text.startswith("Spark reads files.") and len(row.text_vector) == 1024
    write(landing / "data_2.json", json.dumps([{**record, "timestamp": "20240918000000"}]))
    denied = spark.createDataFrame([("b.py-r-2024-09-17 17:21:31",)], "gitrepo_file_id string")
    again = jobs.ingest_repos(spark, str(landing), root, denied)
    assert again.count() == 3 and again.where("file_name = 'b.py'").count() == 0
    silver = spark.read.parquet(f"{root}/silver/repos")
    assert sorted(r.batch_id for r in silver.select("batch_id").distinct().collect()) == [0, 1]
    latest = layers.gold_repo_latest(silver.drop("batch_id"))
    assert latest.where("file_name = 'a.py'").first().gitrepo_file_id == "a.py-r-2024-09-18 00:00:00"


def test_posts_from_csv_and_html_to_gold(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    header = "post_id,post_date,is_published,email_sent_at,inbox_sent_at,type,audience,title,subtitle\n"
    write(landing / "export 1" / "posts.csv", header
          + '1,2024-01-01,true,,,newsletter,everyone,"One, ""quoted""",Sub\n'
          + "2,2024-01-01,false,,,newsletter,everyone,Two,\n3,2024-01-01,,,,newsletter,everyone,Three,\n"
          + "4,2024-01-01,true,,,newsletter,everyone,,\n5,2024-01-01,true,,,newsletter,everyone,Lost,\n")
    for n in (1, 2, 3, 4):
        write(landing / "export 1" / "posts" / f"{n}.html", f"<p>Text &amp; {n}</p>")
    gold = {r.post_id: r.text for r in jobs.ingest_posts(spark, str(landing), root).collect()}
    assert gold == {"1": "Text & 1", "2": "Text & 2", "5": None}
    silver = spark.read.parquet(f"{root}/silver/posts")
    assert [r.post_id for r in layers.posts_without_file(silver).collect()] == ["5"]
    assert silver.where("post_id = '1'").first().title == 'One, "quoted"'
    only = layers.silver_post(spark.read.parquet(f"{root}/bronze/posts"), files.read_html_files(spark, str(landing)), only_true=True)
    assert sorted(r.post_id for r in only.collect()) == ["1", "4", "5"]


def test_documents_to_gold_chunks(spark, tmp_path):
    landing, root = tmp_path / "pdfs", str(tmp_path / "lake")
    write(landing / "a.pdf", "One short line.\nTwo.")
    write(landing / "skipped.txt", "x")
    gold = jobs.ingest_pdfs(spark, str(landing), root, lambda: lambda blobs: [b.decode().split("\n") for b in blobs])
    rows = {r.pdf_chunk_id.rsplit("/", 1)[1]: r.text for r in gold.collect()}
    assert rows == {"a.pdf_1": " One short line.", "a.pdf_2": "Two."}
    assert {len(r.text_vector) for r in gold.collect()} == {1024}


def test_append_stream_takes_each_file_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "n bigint"
    spark.range(3).toDF("n").write.parquet(source)
    for expected in (3, 3, 5):
        if expected == 5:
            spark.range(2).toDF("n").write.mode("append").parquet(source)
        append_stream(files.stream_parquet(spark, source, schema), out, checkpoint)
        assert spark.read.parquet(out).count() == expected
    append_stream_table(files.stream_parquet(spark, source, schema), "streamed", str(tmp_path / "c2"))
    assert files.table_or_path(spark, "streamed").count() == 5
    assert files.describe(spark, "streamed").first().col_name == "n"
    assert files.describe(spark, "streamed", extended=True).count() > 1
    tables.overwrite_table(spark.range(1).toDF("m"), "streamed")
    assert spark.table("streamed").columns == ["m"]
    tables.drop_table(spark, "streamed")
    assert not spark.catalog.tableExists("streamed")


def test_replayed_batch_leaves_one_copy(spark, tmp_path):
    out = str(tmp_path / "silver")
    for batch, n in ((0, 3), (0, 3), (1, 2)):
        tables.append_batch(spark.range(n).toDF("n"), batch, out)
    tables.append_batch(spark.range(0).toDF("n"), 7, out)
    assert spark.read.parquet(out).count() == 5
    source = str(tmp_path / "in")
    spark.range(4).toDF("n").write.parquet(source)
    for run in range(2):
        transform_stream(files.stream_parquet(spark, source, "n bigint"), lambda b: b.withColumn("m", F.col("n") * 2),
                         str(tmp_path / "out"), str(tmp_path / f"check{run}"), replace=True)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_stream_of_a_table_that_is_a_file_or_a_folder(spark, tmp_path):
    for shape in ("folder", "file"):
        root = tmp_path / shape
        made = spark.range(4).toDF("n").coalesce(1)
        made.write.parquet(str(root / "t.parquet" if shape == "folder" else tmp_path / "made"))
        made.write.parquet(str(root / "other.parquet"))
        if shape == "file":
            (part,) = (tmp_path / "made").glob("part-*.parquet")
            (root / "t.parquet").write_bytes(part.read_bytes())
        out = str(tmp_path / f"out-{shape}")
        append_stream(files.stream_table(spark, str(root), "t", "n bigint"), out, f"{out}-checkpoint")
        assert sorted(r.n for r in spark.read.schema("n bigint").parquet(out).collect()) == [0, 1, 2, 3]


@pytest.fixture
def vectors(spark):
    def build(rows):
        return embed_text(spark.createDataFrame(rows, "pk string, text string"), "text", "vector", dim=64)

    return build


def test_training_set(spark, tmp_path, vectors):
    posts = spark.createDataFrame(
        [("1", "long answer \n\\ \"é\"", "graph", "engines"), ("2", "x", "nothing", None), ("3", "w " * 8000, "t", "s")],
        "post_id string, text string, title string, subtitle string")
    repo = vectors([("r1", "best practice for graph engines knowledge and technical"), ("r2", "zzz")])
    pdf = vectors([("p1", "zzz yyy")])
    rows = jobs.training_rows(posts, repo, pdf, k=2, threshold=0.2, dim=64)
    got = {r.post_id: r for r in rows.collect()}
    assert set(got) == {"1", "2"}  # the third is over the budget
    assert '"graph engines"' in got["1"].query and got["1"].query.endswith("technical #")
    assert got["1"].total_token_count == len(got["1"].text.split()) + 1 + len(got["1"].query.split(" "))
    jobs.build_training_set(rows, str(tmp_path / "features"), str(tmp_path / "chat"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "chat")).collect()]
    contents = {tuple(m["content"] for m in line["messages"]) for line in lines}
    assert {c[2] for c in contents} == {"long answer \n\\ \"é\"", "x"}
    assert all([m["role"] for m in line["messages"]] == ["System", "User", "Chatbot"] for line in lines)


def test_budget_is_strict(spark):
    frame = spark.createDataFrame([("a " * 7998 + "a", "q"), ("a " * 7997 + "a", "q")], "text string, query string")
    assert [r.total_token_count for r in training.within_budget(frame).collect()] == [7999]


def test_prompts(spark, vectors):
    turns = spark.createDataFrame(
        [(1, 5, "assistant", "about cats"), (1, 0, "user", "hello"), (2, 0, "user", "about rails")],
        "conv_id int, turn int, role string, text string")
    requests = jobs.requests_of(turns)
    assert {r.query_id: r.request for r in requests.collect()} == {1: "about cats", 2: "about rails"}
    prompts = jobs.chain_prompts(requests, vectors([("r", "cats purr")]), vectors([("p", "about cats")]), dim=64)
    messages = {r.query_id: r.messages for r in prompts.collect()}
    assert messages[1][0].role == "system"
    assert "for about cats and" in messages[1][1].content
    assert "Passage: about cats\n" in messages[1][1].content and "Passage: cats purr\n" in messages[1][1].content


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert one != two and one.startswith(base)
    assert session.fits(spark.range(5), 5) and not session.fits(spark.range(6), 5)


def test_lost_checkpoint_starts_a_new_run(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(check, **options):
        stream = files.stream_parquet(spark, source, "n bigint", most_files=1)
        transform_stream(stream, lambda b: b.select("n"), out, str(tmp_path / check), **options)

    for n in range(3):
        spark.range(n, n + 1).toDF("n").coalesce(1).write.mode("append").parquet(source)
        run("one")
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [0, 1, 2]
    with pytest.raises(Exception, match="holds batches"):
        run("two")
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [0, 1, 2]
    run("three", replace=True)
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [0, 1, 2]


def test_old_run_stays_until_the_new_one_is_whole(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(3):
        spark.range(n, n + 1).toDF("n").coalesce(1).write.mode("append").parquet(source)
    seen = []

    def transform(batch):
        if seen is not None and (tmp_path / "out").exists():
            seen.append({p.name for p in (tmp_path / "out").glob("run=*")})
        return batch.select("n")

    stream = lambda: files.stream_parquet(spark, source, "n bigint", most_files=1)
    transform_stream(stream(), transform, out, str(tmp_path / "one"))
    old = {p.name for p in (tmp_path / "out").glob("run=*")}
    seen.clear()

    def failing(batch):
        if len(seen) == 2:
            raise RuntimeError("stopped")
        return transform(batch)

    with pytest.raises(Exception, match="stopped"):
        transform_stream(stream(), failing, out, str(tmp_path / "two"), replace=True)
    # nothing of the old run is lost while the new one is not whole
    assert all(old <= names for names in seen) and len(seen) == 2
    transform_stream(stream(), transform, out, str(tmp_path / "two"), replace=True)
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [0, 1, 2]
    assert not old & {p.name for p in (tmp_path / "out").glob("run=*")}


@pytest.mark.parametrize("there", [True, False])
def test_empty_landing_folders_give_empty_gold(spark, tmp_path, there):
    if there:
        for name in ("posts", "repos", "pdfs"):
            (tmp_path / name).mkdir()
    root = str(tmp_path / "lake")
    for _ in range(2):
        posts = jobs.ingest_posts(spark, str(tmp_path / "posts"), root)
        repos_ = jobs.ingest_repos(spark, str(tmp_path / "repos"), root)
        pdfs = jobs.ingest_pdfs(spark, str(tmp_path / "pdfs"), root, lambda: lambda blobs: [[""] for _ in blobs])
        assert posts.count() == repos_.count() == pdfs.count() == 0
    assert {"post_id", "text"} <= set(posts.columns) and "gitrepo_file_id" in repos_.columns and "pdf_chunk_id" in pdfs.columns
    record = {"file_name": "a.py", "content": "x", "timestamp": "20240917172131", "repo": "r"}
    write(tmp_path / "repos" / "one.json", json.dumps([record]))
    assert jobs.ingest_repos(spark, str(tmp_path / "repos"), root).count() == 1


def test_malformed_files_go_to_quarantine(spark, tmp_path):
    landing, root = tmp_path / "raw", str(tmp_path / "lake")
    record = {"file_name": "a.py", "content": "x y", "timestamp": "20240917172131", "repo": "r"}
    whole = json.dumps([record])
    write(landing / "good.json", whole)
    write(landing / "cut.json", whole[:-9])
    write(landing / "nameless.json", json.dumps([{"content": "z"}]))
    gold = jobs.ingest_repos(spark, str(landing), root)
    assert [r.gitrepo_file_id for r in gold.collect()] == ["a.py-r-2024-09-17 17:21:31"]
    apart = spark.read.parquet(f"{root}/quarantine/repos")
    assert {r._file.rsplit("/", 1)[1] for r in apart.collect()} == {"cut.json", "nameless.json"}
    assert [r._corrupt_record for r in apart.where("_corrupt_record is not null").collect()] == [whole[:-9]]


def test_late_files_fill_their_posts(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    header = "post_id,post_date,is_published,email_sent_at,inbox_sent_at,type,audience,title,subtitle\n"
    write(landing / "ex 1" / "posts.csv", header + "".join(f"{n},,true,,,,,T{n},\n" for n in (1, 2, 3)))
    write(landing / "ex 1" / "posts" / "1.html", "<p>one</p>")
    ingest = lambda: {r.post_id: r.text for r in jobs.ingest_posts(spark, str(landing), root).collect()}
    assert ingest() == {"1": "one", "2": None, "3": None}
    write(landing / "ex 1" / "posts" / "2.html", "<p>two</p>")
    assert ingest() == {"1": "one", "2": "two", "3": None}
    assert ingest() == {"1": "one", "2": "two", "3": None}
    write(landing / "ex 1" / "posts" / "3.html", "<p>three</p>")
    write(landing / "ex 2" / "posts.csv", header + "4,,true,,,,,T4,\n,,true,,,,,nobody,\n")
    assert ingest() == {"1": "one", "2": "two", "3": "three", "4": None}
    assert [r.title for r in spark.read.parquet(f"{root}/quarantine/posts").collect()] == ["nobody"]
    assert spark.read.parquet(f"{root}/late/posts").count() == 2


def test_jobs_bound_their_batches(spark, tmp_path):
    record = {"file_name": "a.py", "content": "x", "timestamp": "20240917172131", "repo": "r"}
    for n in range(5):
        write(tmp_path / "raw" / f"{n}.json", json.dumps([{**record, "file_name": f"f{n}.py"}]))
    gold = jobs.ingest_repos(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), most_files=2)
    assert gold.count() == 5
    assert spark.read.parquet(str(tmp_path / "lake" / "silver" / "repos")).select("batch_id").distinct().count() >= 3


def test_last_message_of_tied_turns(spark):
    rows = [(1, 0, "user", "b"), (1, 3, "user", "z"), (1, 3, "assistant", "a"), (1, 3, "user", "y")]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "conv_id int, turn int, role string, text string").repartition(3)
        assert jobs.requests_of(frame).first().request == "z"


def test_versions_stay_whole(spark, tmp_path):
    root = str(tmp_path / "gold")
    for n in (1, 2, 3):
        assert tables.write_version(spark.range(n).toDF("n"), root).count() == n
    assert sorted(p.name for p in (tmp_path / "gold").iterdir()) == ["version=1", "version=2"]
    # another writer's unfinished version stays, a failed one from before goes
    (tmp_path / "gold" / "version=7").mkdir()
    (tmp_path / "gold" / "version=0").mkdir()
    tables.write_version(spark.range(4).toDF("n"), root)
    assert sorted(p.name for p in (tmp_path / "gold").iterdir()) == ["version=2", "version=7", "version=8"]


def test_tied_posts_and_lost_files_train_once(spark, tmp_path, vectors):
    posts = spark.createDataFrame(
        [("1", "old", "graph", None, 1), ("1", "answer", "graph", None, 2), ("1", "answer", "graph", None, 2), ("2", None, "t", "s", 1)],
        "post_id string, text string, title string, subtitle string, ingestion_time int")
    rows = jobs.training_rows(posts, vectors([("r1", "graph one"), ("r2", "graph two")]), vectors([("p", "z")]), k=3, threshold=-2.0, dim=64)
    records = jobs.build_training_set(rows, str(tmp_path / "features"), str(tmp_path / "chat"))
    assert [(r.post_id, r.messages[2].content) for r in records.collect()] == [("1", "answer")]
    query = rows.first()["query"]
    assert query.count("graph one") == query.count("graph two") == 1


def test_collection_adds_runs_that_ingest_reads(spark, tmp_path):
    write(tmp_path / "checkouts" / "r1" / "a.py", "x = 1")
    write(tmp_path / "checkouts" / "r2" / "sub" / "deep" / "er" / "__init__.py", "y = 2")
    write(tmp_path / "checkouts" / "old" / "b.py", "z")
    run = dt.datetime(2024, 9, 17)
    listing = spark.createDataFrame(
        [("r1", "u", False, run), ("r2", "u", False, run), ("old", "u", False, run - dt.timedelta(days=99))], schemas.REPOS)
    landing = str(tmp_path / "landing")
    for day in range(2):
        jobs.collect_repos(spark, listing, str(tmp_path / "checkouts"), landing, run + dt.timedelta(days=day))
    gold = jobs.ingest_repos(spark, landing, str(tmp_path / "lake"), multi_line=False)
    assert sorted((r.repo, r.file_name, r.content) for r in gold.collect()) == [
        ("r1", "a.py", "x=1"), ("r1", "a.py", "x=1"), ("r2", "__init__.py", "y=2"), ("r2", "__init__.py", "y=2")]


def test_batch_splits_give_the_same_text(spark, tmp_path):
    names = [f"f{i}.py" for i in range(6)]
    texts = ["alpha beta. gamma alpha gamma. delta", "alpha omega. omega sigma", "beta beta. alpha rho", "tau. tau alpha", "rho", ""]
    found = []
    for split in (1, 3):
        landing = str(tmp_path / f"landing{split}")
        for part in range(split):
            rows = [(n, t, "20240101000000", "r") for i, (n, t) in enumerate(zip(names, texts)) if i % split == part]
            frame = spark.createDataFrame(rows, "file_name string, content string, timestamp string, repo string")
            tables.write_raw_run(frame.coalesce(1), landing, str(part))
            gold = jobs.ingest_repos(spark, landing, str(tmp_path / f"lake{split}"), multi_line=False)
        found.append({r.file_name: (r.text, r.text_vector) for r in gold.collect()})
    assert found[0] == found[1] and len(found[0]) == 6


def test_html_of_a_batch_reads_its_export_only(spark, tmp_path):
    for export in ("ex a", "b"):
        for post in ("1", "2"):
            write(tmp_path / export / "posts" / f"{post}.html", f"<p>{export}{post}</p>")
    place = (tmp_path / "ex a" / "posts.csv").as_uri()
    batch = spark.createDataFrame([("1", place), ("9", place)], "post_id string, filePath string")
    found = jobs.html_of(batch, str(tmp_path))
    assert sorted(r.html_path.rsplit("/", 1)[1] for r in found.collect()) == ["1.html", "2.html"]
    none = jobs.html_of(batch.withColumn("filePath", F.lit(str(tmp_path / "gone" / "posts.csv"))), str(tmp_path))
    assert none.count() == 0 and jobs.html_of(batch, str(tmp_path), most=0).count() == 4


def test_split_is_stable(spark):
    keys = spark.range(2000).select(F.col("id").cast("string").alias("post_id"))
    parts = {r.post_id: r.part for r in jobs.train_eval_split(keys, share=0.25).collect()}
    again = {r.post_id: r.part for r in jobs.train_eval_split(keys.repartition(3).limit(500), share=0.25).collect()}
    assert all(parts[k] == p for k, p in again.items())
    assert 400 < sum(p == "eval" for p in parts.values()) < 600


def test_spread_only_when_files_are_few(spark, tmp_path):
    spark.range(100).repartition(2).write.parquet(str(tmp_path / "few"))
    spark.range(100).repartition(16).write.parquet(str(tmp_path / "many"))
    few = session.spread(spark.read.parquet(str(tmp_path / "few")), "id")
    many = session.spread(spark.read.parquet(str(tmp_path / "many")), "id")
    assert "Exchange" in few._jdf.queryExecution().toString()
    assert "Exchange" not in many._jdf.queryExecution().toString()
