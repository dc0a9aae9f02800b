"""End-to-end jobs: ingest, vector-table sync, retrieval, training set, prompts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom import schemas
from textloom.functions import text as X
from textloom.functions.embed import embed_sparse, embed_text
from textloom.operators import context, retrieve, training, versions
from textloom.plans import layers
from textloom.session import materialise
from textloom.sinks import buckets, tables
from textloom.sources import files, repos
from textloom.streaming.jobs import append_stream, transform_stream

REPO, PDF = "repo", "pdf"
CHAIN_RESULTS = 4
DIM = 1024
#: Files that a micro-batch of a job takes at most; a first run works off its backlog in such batches.
MOST_FILES = 1000


def _at(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def ingest_posts(
    spark: SparkSession,
    landing: str,
    root: str,
    most_files: int | None = MOST_FILES,
    replace: bool = False,
    **options,
) -> DataFrame:
    """CSV lists and HTML files of posts -> bronze -> silver -> gold. Returns gold.

    A post whose HTML file lands in a later run gets its text then. Rows without an id are kept
    apart in `quarantine/posts`. A landing folder that is empty or missing gives an empty gold.
    """
    bronze, silver, gold, late = (_at(root, name, "posts") for name in ("bronze", "silver", "gold", "late"))
    tables.make_folder(spark, landing)
    schema = T.StructType([*schemas.POST_CSV.fields, T.StructField("_corrupt_record", T.StringType())])
    source = files.stream_csv(spark, landing, schema, most_files)
    append_stream(source, bronze, _at(root, "checkpoint/bronze/posts"))
    tables.make_folder(spark, bronze)
    transform_stream(
        files.stream_parquet(spark, bronze, source.schema, most_files=most_files),
        lambda batch: layers.silver_post(batch, html_of(batch, landing), **options),
        silver,
        _at(root, "checkpoint/silver/posts"),
        replace,
        F.col("post_id").isNull(),
        _at(root, "quarantine/posts"),
    )
    stored = tables.read_or_empty(spark, silver, schemas.SILVER_POST)
    earlier = tables.read_or_empty(spark, late, schemas.SILVER_POST)
    waiting = materialise(layers.with_late_posts(stored, earlier).where("text is null and html_path is not null"), "waiting")
    if waiting.take(1):
        # lists lie beside the folder of their HTML files
        lists = waiting.withColumn("filePath", F.concat(F.regexp_replace("html_path", "/posts/[^/]*$", ""), F.lit("/list")))
        found = materialise(layers.late_posts(waiting, html_of(lists, landing)), "late")
        if found.take(1):
            found.write.mode("append").parquet(late)
            earlier = tables.read_or_empty(spark, late, schemas.SILVER_POST)
    return tables.write_version(layers.gold_post(layers.with_late_posts(stored, earlier)), gold)


def html_of(posts: DataFrame, landing: str, most: int = 1000) -> DataFrame:
    """HTML files of the exports that a batch of posts came from; old exports are not read.

    A batch of more than `most` exports reads all of them.
    """
    spark = posts.sparkSession
    parents = posts.select(X.parent_folder(F.col("filePath")).alias("at")).where("at is not null").distinct()
    exports = [r["at"] for r in parents.limit(most + 1).collect()]
    if len(exports) > most:
        return files.read_html_files(spark, landing)
    return files.read_html_files(spark, *[f"{at}/posts" for at in exports])


def ingest_repos(
    spark: SparkSession,
    landing: str,
    root: str,
    denied: DataFrame | None = None,
    multi_line: bool = True,
    most_files: int | None = MOST_FILES,
    replace: bool = False,
    **models,
) -> DataFrame:
    """Raw JSON records of repository files -> bronze -> silver -> gold. Returns gold.

    Files that cannot be parsed, and records without a file name, are kept apart with the name of
    their file in `quarantine/repos`. An empty or missing landing folder gives an empty gold.

    Files hold an array of records each, or with `multi_line=False` a record
    a line, as `collect_repos` writes them. A chat model distils each file as it
    comes. Without one words are weighed over the whole table when gold is
    made, so a file's text does not depend on the batch it came in.
    """
    own = models.get("chat") is None
    bronze, silver, gold = (_at(root, name, "repos") for name in ("bronze", "silver", "gold"))
    tables.make_folder(spark, landing)
    schema = T.StructType([*schemas.BRONZE_REPO.fields, *schemas.CORRUPT.fields])
    source = files.stream_json(spark, landing, schema, most_files, multi_line)
    append_stream(source, bronze, _at(root, "checkpoint/bronze/repos"))
    tables.make_folder(spark, bronze)

    def transform(batch: DataFrame) -> DataFrame:
        records = batch.select(*schemas.BRONZE_REPO.names)
        return records if own else layers.silver_repo(records, **models)

    transform_stream(
        files.stream_parquet(spark, bronze, schema, most_files=most_files),
        transform,
        silver,
        _at(root, "checkpoint/silver/repos"),
        replace,
        F.col("_corrupt_record").isNotNull() | F.col("file_name").isNull(),
        _at(root, "quarantine/repos"),
    )
    stored = tables.read_or_empty(spark, silver, schemas.BRONZE_REPO if own else schemas.SILVER_REPO)
    if own:
        stored = layers.distilled(stored, models.get("embedder"))
    return tables.write_version(layers.gold_repo(stored, denied), gold)


def ingest_pdfs(
    spark: SparkSession,
    landing: str,
    root: str,
    extractor,
    most_files: int | None = MOST_FILES,
    replace: bool = False,
    **models,
) -> DataFrame:
    """Document files -> bronze -> silver chunks -> gold. Returns gold.

    An empty or missing landing folder gives an empty gold.
    """
    bronze, silver, gold = (_at(root, name, "pdfs") for name in ("bronze", "silver", "gold"))
    tables.make_folder(spark, landing)
    append_stream(files.stream_binary(spark, landing, most_files=most_files), bronze, _at(root, "checkpoint/bronze/pdfs"))
    tables.make_folder(spark, bronze)
    transform_stream(
        files.stream_parquet(spark, bronze, schemas.BRONZE_PDF, most_files=most_files),
        lambda batch: layers.silver_pdf(batch, extractor, **models),
        silver,
        _at(root, "checkpoint/silver/pdfs"),
        replace,
    )
    stored = tables.read_or_empty(spark, silver, schemas.SILVER_CHUNK)
    return tables.write_version(layers.gold_pdf(stored, newest_only=True), gold)


def sync_vectors(source: DataFrame, key: str, root: str, version: int) -> DataFrame:
    """Bring the vector table `root`/table to the state of `source`; returns the change rows.

    Only keys and stored digests are compared, and only buckets with a change are written. The
    change rows of each version are kept for whoever follows the table. They are written before
    the table: a run that failed in between is finished by running the version again.
    """
    return buckets.sync(source, _at(root, "table"), key, _at(root, f"changes={version}"))


#: (pk, text, vector), or (pk, vector) and (pk, text) where vectors are written without their texts.
Source = DataFrame | tuple[DataFrame, DataFrame]


def search_sources(
    queries: DataFrame, sources: dict[str, Source], k: int, dim: int = DIM, **options
) -> DataFrame:
    """(query_id, source, rank, pk, text, score): the k best of each source for each query.

    Documents without a key, which leads to their text, take no part.
    """
    found = None
    for name, docs in sources.items():
        vectors, texts = docs if isinstance(docs, tuple) else (docs, docs)
        vectors = vectors.where(F.col("pk").isNotNull())
        part = materialise(retrieve.knn_join(queries, vectors, k, dim, **options), "found")
        part = context.with_text(part, texts).withColumn("source", F.lit(name))
        found = part if found is None else found.unionByName(part)
    return found


def _query_vectors(texts: DataFrame, in_col: str, embedder, dim: int) -> DataFrame:
    """Adds `vector`: that of the model, or a sparse one of the built-in embedder."""
    if embedder is None:
        return embed_sparse(texts, in_col, "vector", dim)
    return embed_text(texts, in_col, "vector", embedder, dim)


def training_rows(
    posts: DataFrame,
    repo: Source,
    pdf: Source,
    k: int = training.RESULTS_PER_SOURCE,
    threshold: float = training.SCORE_FLOOR,
    dim: int = DIM,
    embedder=None,
) -> DataFrame:
    """Posts with question, retrieved context, query and token counts, within the budget.

    One row per post: of versions and copies the newest. Posts without a text
    have no answer to learn and are left out. Posts and query vectors are
    written once: several later steps read them. Contexts, which hold a text
    once per query that finds it, go from their gathering straight into the rows.
    """
    order = "ingestion_time" if "ingestion_time" in posts.columns else "text"
    answered = posts.where(F.col("text").isNotNull())
    newest = versions.pick_version(answered, ["post_id"], order, keep="last", ties=False)
    asked = training.with_question(materialise(newest, "posts"))
    topics = asked.select(F.col("post_id").alias("query_id"), "topic_question")
    vectors = materialise(_query_vectors(topics, "topic_question", embedder, dim), "query-vectors")
    found = search_sources(vectors, {REPO: repo, PDF: pdf}, k, dim)
    contexts = context.two_source_context(vectors, found, REPO, PDF, threshold)
    return training.within_budget(training.with_query(asked, contexts))


def build_training_set(rows: DataFrame, feature_path: str, jsonl_path: str) -> DataFrame:
    """Write the feature table and the chat file; returns the chat records.

    The rows are written once first: the key check, the features and the chat
    file all read them.
    """
    rows = materialise(rows.select("post_id", "query", "text"), "training-rows")
    tables.write_keyed(rows.select("post_id", "query"), feature_path, "post_id")
    features = rows.sparkSession.read.parquet(feature_path)
    records = training.chat_records(
        training.training_set(rows.select("post_id", "text"), features)
    )
    tables.write_chat_jsonl(records, jsonl_path)
    return records


def collect_repos(
    spark: SparkSession,
    listing: DataFrame,
    checkouts: str,
    landing: str,
    run_time: dt.datetime,
    **options,
) -> str:
    """The collection run: recent repositories -> their files -> raw records, in a new folder of `landing`.

    `checkouts` holds a folder per repository. Runs add to what earlier runs
    left; `ingest_repos` then streams what is new. Returns the folder.
    """
    recent = repos.recent_repos(listing, run_time)
    found = repos.read_checkouts(spark, checkouts).join(recent.select(F.col("name").alias("repo")), "repo", "left_semi")
    texts = found.withColumn("content", X.utf8_text(F.col("content")))
    records = repos.raw_records(repos.resolve_collisions(repos.route_files(texts, **options)), run_time)
    return tables.write_raw_run(records, landing, run_time.strftime("%Y%m%d%H%M%S"))


def train_eval_split(records: DataFrame, key: str = "post_id", share: float = 0.1, seed: str = "split") -> DataFrame:
    """Adds `part`, train or eval, by a hash of seed and key: a key is always on the same side.

    Pass each side to `write_chat_jsonl`. A null key counts as an empty one.
    """
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000
    return records.withColumn("part", F.when(place < round(share * 10_000), "eval").otherwise("train"))


def requests_of(conversations: DataFrame) -> DataFrame:
    """(query_id, request): the last message of each conversation, whoever wrote it.

    Of messages with the same turn the one with the greater role, then text, counts as later.
    """
    place = F.struct("turn", "role", "text")
    return conversations.groupBy(F.col("conv_id").alias("query_id")).agg(F.max_by("text", place).alias("request"))


def chain_prompts(
    requests: DataFrame,
    repo: Source,
    pdf: Source,
    k: int = CHAIN_RESULTS,
    dim: int = DIM,
    embedder=None,
) -> DataFrame:
    """(query_id, request, context, messages): the prompt of every request.

    Search both sources, fuse by reciprocal rank, format, fill the template.
    `map_model` on `messages` would be the answer step.
    """
    vectors = materialise(_query_vectors(requests, "request", embedder, dim), "query-vectors")
    found = search_sources(vectors, {REPO: repo, PDF: pdf}, k, dim)
    fused = context.fuse(found, {REPO: context.FUSION_WEIGHT, PDF: context.FUSION_WEIGHT})
    blocks = context.passages(requests, fused)
    return requests.join(blocks, "query_id").withColumn(
        "messages", X.chain_prompt(F.col("request"), F.col("context"))
    )


def sample(table: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The first n rows by key."""
    return table.orderBy(key).limit(n)


def numbered_within_batch(chunks: DataFrame) -> DataFrame:
    """Chunk rows numbered in alphabetical order per (ingestion_time, path).

    For chunks that arrive as rows. `explode_chunks` numbers chunks that are
    still in their document's row, without a window.
    """
    return versions.number_rows(chunks, ["ingestion_time", "path"], "text_chunk")
