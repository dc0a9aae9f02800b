"""Queries over the test tables, one per operator or job. `oracle` has their SQL.

Each takes (spark, folder of parquet tables). Inputs of the operators are
derived from whole tables by their own columns: documents stand for repository
files and PDFs, pages for posts, embeddings for vector tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom import schemas
from textloom.functions import text as X
from textloom.functions.embed import embed_sparse, embed_text
from textloom.operators import chunking, context, distil, evaluate, retrieve, training, versions
from textloom.operators.filters import among
from textloom.plans import jobs, layers
from textloom.session import materialise, shared_dir, spread
from textloom.sinks import buckets, tables
from textloom.sources import files, repos
from textloom.streaming.jobs import append_stream, stamped, transform_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VECTOR_DIM = 64  # of the embeddings table
TEXT_DIM = 1024
CONTEXT_FLOOR = 0.2  # hashed vectors of short questions rarely score above 0.5
FILE_BYTES = 16 * 2**20  # of a text file that is read as one row
MESSAGES = 64  # of a conversation in one array


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def big(*cols: str | Column) -> list[Column]:
    """The columns as bigint, under their own names."""
    return [F.col(c).cast("long").alias(c) if isinstance(c, str) else c for c in cols]


# -- derived inputs ------------------------------------------------------------


def posts_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Post metadata as it would come from a CSV list, from pages."""
    url = F.col("url")
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    heading = F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    published = F.when(url.startswith("https://"), F.when(url.contains(".html"), "false").otherwise("true"))
    absent = F.lit(None).cast("string")
    return table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("post_id"),
        absent.alias("post_date"),
        published.alias("is_published"),
        absent.alias("email_sent_at"),
        absent.alias("inbox_sent_at"),
        F.lit("newsletter").alias("type"),
        F.lit("everyone").alias("audience"),
        F.when(~host.startswith("m."), title).alias("title"),
        F.when(~url.contains("?"), heading).alias("subtitle"),
        F.concat(F.lit("/landing/"), host, F.lit("/posts.csv")).alias("filePath"),
    )


def html_files(spark: SparkSession, folder: str) -> DataFrame:
    """HTML files by path; pages whose url ends in .html have lost theirs."""
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    path = F.concat(F.lit("/landing/"), host, F.lit("/posts/"), F.col("page_id"), F.lit(".html"))
    pages = table(spark, folder, "pages").where(~F.col("url").contains(".html"))
    return pages.select(path.alias("html_path"), "html")


def posts_ingested(spark: SparkSession, folder: str) -> DataFrame:
    """Silver posts of two ingestions: all, some of them twice, and some again later."""
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    base = table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("post_id"),
        "url",
        X.html_to_text(F.col("html")).alias("text"),
        F.when(~host.startswith("m."), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)).alias("title"),
        F.when(~F.col("url").contains("?"), F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)).alias("subtitle"),
    )
    t0, t1 = (F.to_timestamp(F.lit(t)) for t in ("2024-01-01 00:00:00", "2024-02-01 00:00:00"))
    first = base.withColumn("ingestion_time", t0)
    copies = first.where(F.col("url").contains("#"))
    later = base.where(F.col("url").contains("?")).select(
        "post_id", "url", F.concat("text", F.lit(" (updated)")).alias("text"), "title", "subtitle",
        t1.alias("ingestion_time"),
    )
    return first.unionByName(copies).unionByName(later).drop("url")


REL_PATH = """
    case source
      when 'src0' then concat('d', doc_id, '/Dockerfile')
      when 'src1' then concat('docs/', doc_id, '/f', size_class, '.md')
      when 'src2' then concat('nb/', doc_id, '/f', size_class, '.ipynb')
      when 'src3' then concat('conf/', doc_id, '/f', size_class, '.yaml')
      when 'src4' then concat('bin/', doc_id, '/f', size_class, '.sh')
      when 'src5' then concat('data/', doc_id, '/f', size_class, '.csv')
      when 'src6' then concat('.github/', doc_id, '/f', size_class, '.py')
      when 'src7' then concat('x/.git/', doc_id, '/f', size_class, '.py')
      when 'src8' then concat('conf/', doc_id, '/f', size_class, '.yml')
      when 'src9' then concat('t', doc_id, '.PY')
      else concat(source, '/', doc_id, '/f', size_class, '.py') end
"""


def notebook(path: Column, text: Column) -> Column:
    """Notebook JSON with a heading cell and a cell that holds the text."""

    def cell(kind: str, *lines: Column) -> Column:
        return F.struct(F.lit(kind).alias("cell_type"), F.array(*lines).alias("source"))

    cells = F.array(cell("markdown", F.concat(F.lit("# "), path)), cell("code", text))
    return F.to_json(F.struct(cells.alias("cells"), F.lit(4).alias("nbformat")))


def repo_files(spark: SparkSession, folder: str) -> DataFrame:
    """(repo, rel_path, content) of files in checkouts, from documents."""
    docs = table(spark, folder, "documents").withColumn(
        "size_class", F.floor(F.col("n_chars") / 100).cast("long")
    )
    docs = docs.withColumn("rel_path", F.expr(REL_PATH))
    content = F.when(
        F.col("rel_path").endswith(".ipynb"), notebook(F.col("rel_path"), F.col("text"))
    ).otherwise(F.col("text"))
    return docs.select(F.col("lang").alias("repo"), "rel_path", content.alias("content"))


def repo_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Silver repository files with versions, unreadable times and copies, from documents."""
    docs = table(spark, folder, "documents")
    minute = F.make_interval(mins=F.col("n_chars").cast("int"))
    stamp = F.date_format(F.lit("2024-01-01 00:00:00").cast("timestamp") + minute, "yyyyMMddHHmmss")
    files_ = docs.select(
        F.col("text").alias("content"),
        F.concat("source", F.lit("/f"), F.floor(F.col("n_chars") / 100).cast("long"), F.lit(".py")).alias("file_name"),
        F.col("lang").alias("repo"),
        F.when(F.col("source") == "src12", "not a time").otherwise(stamp).alias("timestamp"),
        F.col("text"),
        F.lit(None).cast("array<float>").alias("text_vector"),
        "source",
    )
    copies = files_.where(F.col("source") == "src1")
    return files_.unionByName(copies).drop("source")


def denied_files(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of files that a label calls low quality."""
    bad = table(spark, folder, "labels").where(F.col("quality") == 0).select("doc_id")
    keyed = table(spark, folder, "documents").join(bad, "doc_id", "left_semi").select(
        F.concat("source", F.lit("/f"), F.floor(F.col("n_chars") / 100).cast("long"), F.lit(".py")).alias("file_name"),
        F.col("lang").alias("repo"),
        F.when(F.col("source") == "src12", "not a time").otherwise(
            F.date_format(
                F.lit("2024-01-01 00:00:00").cast("timestamp")
                + F.make_interval(mins=F.col("n_chars").cast("int")),
                "yyyyMMddHHmmss",
            )
        ).alias("timestamp"),
    )
    return versions.with_file_id(keyed).select("gitrepo_file_id")


def pdf_path() -> Column:
    return F.concat("source", F.lit("/"), "doc_id", F.lit(".pdf"))


def pdf_elements(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.lines_as_elements(table(spark, folder, "documents"), pdf_path(), "text")


def merged_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text_chunk, row_number) of documents, small lines merged."""
    lists = spread(table(spark, folder, "documents"), "doc_id").select(
        pdf_path().alias("path"),
        chunking.merge_small_chunks(F.split("text", "\n")).alias("text_chunks"),
    )
    return chunking.explode_chunks(lists)


def repo_vectors(spark: SparkSession, folder: str) -> jobs.Source:
    """Whole documents with sparse vectors. Vectors are written, texts stay in their table."""
    docs = table(spark, folder, "documents")

    def keyed(docs: DataFrame) -> DataFrame:
        return docs.select(F.concat("source", F.lit("/"), "doc_id").alias("pk"), "text")

    vectors = embed_sparse(keyed(spread(docs, "doc_id")), "text", "vector", TEXT_DIM)
    return materialise(vectors.select("pk", "vector"), "repo-vectors"), keyed(docs)


def chunk_vectors(spark: SparkSession, folder: str) -> jobs.Source:
    """Merged chunks with sparse vectors. Vectors are written; the texts of found chunks are cut again."""
    gold = versions.with_chunk_id(merged_chunks(spark, folder))
    keyed = gold.select(F.col("pdf_chunk_id").alias("pk"), F.col("text_chunk").alias("text"))
    vectors = embed_sparse(keyed, "text", "vector", TEXT_DIM)
    return materialise(vectors.select("pk", "vector"), "chunk-vectors"), keyed


def vector_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")
    )


def vector_docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("pk"), F.col("embedding").alias("vector"), "label"
    )


def two_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All vectors, with the text of the document of the same number if there is one, split by label."""
    docs = vector_docs(spark, folder)
    texts = table(spark, folder, "documents").select(F.col("doc_id").alias("pk"), "text")
    # only texts that have a vector are shuffled to meet it
    docs = docs.join(among(texts, docs, "pk"), "pk", "left")
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    return {jobs.REPO: docs.where(F.col("label") < 5), jobs.PDF: docs.where(F.col("label") >= 5)}


def two_source_results(spark: SparkSession, folder: str, k: int) -> DataFrame:
    return jobs.search_sources(
        vector_queries(spark, folder), two_sources(spark, folder), k, VECTOR_DIM, skip_same_key=True
    )


# -- posts ---------------------------------------------------------------------


@query
def html_to_text(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.select("page_id", X.html_to_text(F.col("html")).alias("text"))


@query
def posts_silver(spark, folder):
    silver = layers.silver_post(posts_csv(spark, folder), html_files(spark, folder))
    return silver.select(
        "post_id", "is_published", "title", "subtitle", "html_path", "text",
        X.path_in_store(F.concat(F.lit("https://store.net/"), "html_path")).alias("blob_path"),
    )


@query
def posts_without_file(spark, folder):
    silver = layers.silver_post(posts_csv(spark, folder), html_files(spark, folder))
    return layers.posts_without_file(silver)


@query
def posts_late_file(spark, folder):
    """Posts whose HTML files land after them, some at once and the others one run later; each run fills what it can."""
    pages = html_files(spark, folder)
    early = F.crc32("html_path") % 3 == 0
    silver = materialise(layers.silver_post(posts_csv(spark, folder), pages.where(early)), "silver")
    late = materialise(layers.late_posts(silver, pages), "late")
    filled = layers.with_late_posts(silver, late)
    return filled.select("post_id", "is_published", "title", "subtitle", "html_path", "text")


def _post_columns(gold: DataFrame) -> DataFrame:
    time = F.date_format("ingestion_time", "yyyy-MM-dd").alias("ingested")
    return gold.select("post_id", time, "text", "title", "subtitle")


@query
def posts_gold_first(spark, folder):
    return _post_columns(layers.gold_post(posts_ingested(spark, folder)))


@query
def posts_gold_last(spark, folder):
    return _post_columns(layers.gold_post(posts_ingested(spark, folder), keep="last", ties=False))


@query
def posts_rank(spark, folder):
    ranked = versions.rank_versions(posts_ingested(spark, folder), ["post_id"], "ingestion_time")
    return ranked.select("post_id", "text", *big("rank"))


# -- repository files ----------------------------------------------------------


@query
def repo_recent(spark, folder):
    listing = table(spark, folder, "documents").select(
        F.col("source").alias("name"),
        F.concat(F.lit("https://git.example.com/"), "source", F.lit("/"), "lang").alias("html_url"),
        (F.col("lang") == "de").alias("private"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp")
         + F.make_interval(hours=F.col("n_chars").cast("int"))).alias("updated_at"),
    )
    return repos.recent_repos(listing, dt.datetime(2024, 6, 1))


@query
def repo_files_route(spark, folder):
    return repos.route_files(repo_files(spark, folder))


@query
def repo_files_collision(spark, folder):
    return repos.resolve_collisions(repos.route_files(repo_files(spark, folder)))


@query
def repo_raw_records(spark, folder):
    routed = repos.resolve_collisions(repos.route_files(repo_files(spark, folder)))
    path = shared_dir(spark, "raw-records")
    tables.write_raw_json(repos.raw_records(routed, dt.datetime(2024, 9, 17, 17, 21, 31)), path)
    return spark.read.schema("file_name string, content string, timestamp string, repo string").json(path)


@query
def notebook_flatten(spark, folder):
    made = table(spark, folder, "documents").select(
        "doc_id", notebook(F.col("source"), F.col("text")).alias("content")
    )
    return made.select("doc_id", X.notebook_text(F.col("content")).alias("text"))


def notebook_run(path: Column, text: Column) -> Column:
    """Notebook JSON whose cells have outputs of all shapes: lists, strings, results, errors and pictures."""

    def quoted(value: Column) -> Column:
        return F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", "")

    parts = [
        '{"nbformat":4,"cells":[{"cell_type":"markdown","source":["# ",', quoted(path),
        ']},{"cell_type":"code","source":"run()","outputs":[{"output_type":"stream","name":"stdout","text":["out ",', quoted(path),
        ']},{"output_type":"stream","text":"done"},{"output_type":"display_data","data":{"image/png":"AAAA"}},'
        '{"output_type":"execute_result","data":{"text/plain":[', quoted(text),
        ']}}]},{"cell_type":"code","source":[],"outputs":[{"output_type":"error","ename":"E","evalue":"v","traceback":["\\u001b[0;31mE\\u001b[0m",', quoted(path),
        ']},{"output_type":"error","ename":"KeyError","evalue":"k","traceback":[]}]}]}',
    ]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@query
def notebook_outputs(spark, folder):
    made = table(spark, folder, "documents").select("doc_id", notebook_run(F.col("source"), F.col("text")).alias("content"))
    return made.select("doc_id", X.notebook_with_outputs(F.col("content")).alias("text"))


@query
def repo_gold(spark, folder):
    gold = layers.gold_repo(repo_silver(spark, folder), denied_files(spark, folder))
    return gold.select("gitrepo_file_id", "file_name", "repo", "content")


@query
def repo_gold_latest(spark, folder):
    gold = layers.gold_repo_latest(repo_silver(spark, folder), denied_files(spark, folder))
    return gold.select("gitrepo_file_id", "file_name", "repo", "content")


# -- chunks --------------------------------------------------------------------


@query
def pdf_elements_concat(spark, folder):
    return chunking.concat_elements(pdf_elements(spark, folder))


@query
def pdf_chunks_greedy(spark, folder):
    return merged_chunks(spark, folder).select("path", "text_chunk", *big("row_number"))


@query
def pdf_gold(spark, folder):
    chunks = merged_chunks(spark, folder).withColumn("text_vector", F.lit(None).cast("array<float>"))
    return layers.gold_pdf(chunks).select("pdf_chunk_id", "text")


@query
def pdf_gold_newest(spark, folder):
    """Two ingestions of some files; keys of the newest only."""
    first = merged_chunks(spark, folder).withColumn("ingestion_time", F.lit("2024-01-01").cast("timestamp"))
    again = first.where(F.col("path").startswith("src1")).select(
        "path", F.concat("text_chunk", F.lit(" (again)")).alias("text_chunk"), "row_number",
        F.lit("2024-02-01").cast("timestamp").alias("ingestion_time"),
    )
    both = first.unionByName(again).withColumn("text_vector", F.lit(None).cast("array<float>"))
    return layers.gold_pdf(both, newest_only=True).select("pdf_chunk_id", "text")


@query
def pdf_number_rows(spark, folder):
    lines = pdf_elements(spark, folder).select(
        F.current_timestamp().alias("ingestion_time"), "path", F.col("text").alias("text_chunk")
    )
    return jobs.numbered_within_batch(lines).select("path", "text_chunk", *big("row_number"))


@query
def sentence_split(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id", F.posexplode(X.sentences(F.col("text"))).alias("i", "sentence")
    ).select("doc_id", *big("i"), "sentence")


@query
def semantic_chunks(spark, folder):
    docs = spread(table(spark, folder, "documents"), "doc_id").select("doc_id", "text")
    cut = chunking.semantic_chunks(docs, dim=TEXT_DIM).drop("text")
    chunks = chunking.explode_chunks(cut, alphabetical=False)
    return chunks.select("doc_id", *big("row_number"), "text_chunk")


# -- vectors and summaries -----------------------------------------------------


@query
def hash_embed(spark, folder):
    docs = spread(table(spark, folder, "documents"), "doc_id").select("doc_id", "text")
    vectors = embed_text(docs, "text", "vector", dim=TEXT_DIM, out_type="array<double>")
    cells = vectors.select("doc_id", F.posexplode("vector").alias("bucket", "weight"))
    return cells.where(F.col("weight") != 0).select(
        "doc_id", *big("bucket"), F.round("weight", 6).alias("weight")
    )


@query
def distil_files(spark, folder):
    docs = spread(table(spark, folder, "documents"), "doc_id").select("doc_id", "text")
    return distil.distil(docs, "doc_id", "text", "distilled").select("doc_id", "distilled")


@query
def distil_keywords(spark, folder):
    docs = spread(table(spark, folder, "documents"), "doc_id").select("doc_id", "text")
    places = materialise(distil.word_places(docs, "doc_id", "text"), "word-places")
    return distil.keywords(distil.word_weights(places, docs, "doc_id"), "doc_id")


@query
def vector_check(spark, folder):
    return evaluate.check_vectors(
        table(spark, folder, "embeddings"), "vec_id", "embedding", VECTOR_DIM
    ).select(*big("rows", "null_keys", "repeated_keys", "null_vectors", "wrong_length", "zero_vectors"))


# -- retrieval -----------------------------------------------------------------


def _knn(spark, folder, k, **options):
    docs = vector_docs(spark, folder)
    found = retrieve.knn_join(
        vector_queries(spark, folder), docs, k, VECTOR_DIM, skip_same_key=True, **options
    )
    return found.select("query_id", *big("rank"), "pk", "score")


@query
def knn_top3(spark, folder):
    return _knn(spark, folder, 3)


@query
def knn_top7_two_sources(spark, folder):
    found = two_source_results(spark, folder, 7)
    return found.select("query_id", "source", *big("rank"), "pk", "score")


@query
def knn_top4_two_sources(spark, folder):
    found = two_source_results(spark, folder, 4)
    return found.select("query_id", "source", *big("rank"), "pk", "score")


@query
def knn_threshold(spark, folder):
    return retrieve.above(_knn(spark, folder, 7), 0.3)


@query
def knn_dot(spark, folder):
    return _knn(spark, folder, 7, metric="dot")


@query
def knn_l2(spark, folder):
    return _knn(spark, folder, 7, metric="l2")


@query
def knn_cells(spark, folder):
    return _knn(spark, folder, 7, strategy="cells", cells=32)


@query
def knn_both_large(spark, folder):
    """Queries as rows that travel to cells of documents, as for more queries than can be broadcast."""
    return _knn(spark, folder, 7, strategy="routed")


@query
def knn_lsh(spark, folder):
    """Buckets of random projections; what is not proven complete is searched again exactly."""
    return _knn(spark, folder, 7, strategy="lsh")


@query
def context_two_source(spark, folder):
    queries = vector_queries(spark, folder)
    found = two_source_results(spark, folder, 7)
    return context.two_source_context(queries, found, jobs.REPO, jobs.PDF, 0.25)


@query
def rrf_fusion(spark, folder):
    fused = context.fuse(two_source_results(spark, folder, 4), {jobs.REPO: 0.5, jobs.PDF: 0.5})
    return fused.select("query_id", *big("rank"), "text", "score")


@query
def context_passages(spark, folder):
    fused = context.fuse(two_source_results(spark, folder, 4), {jobs.REPO: 0.5, jobs.PDF: 0.5})
    return context.passages(vector_queries(spark, folder), fused)


def _label_measures(spark, folder):
    labels = vector_docs(spark, folder).select("pk", "label")
    found = _knn(spark, folder, 7)
    marked = (
        found.join(labels, "pk")
        .join(labels.select(F.col("pk").alias("query_id"), F.col("label").alias("wanted")), "query_id")
        .withColumn("hit", (F.col("label") == F.col("wanted")).cast("int"))
    )
    sizes = labels.groupBy("label").agg(F.count("*").alias("n"))
    counts = labels.join(sizes, "label").select(
        F.col("pk").alias("query_id"), (F.col("n") - 1).alias("n_relevant")
    )
    return evaluate.query_measures(marked, counts, 7)


@query
def retrieval_measures(spark, folder):
    names = ("precision", "recall", "reciprocal_rank", "ndcg")
    return _label_measures(spark, folder).select("query_id", *[F.round(n, 6).alias(n) for n in names])


@query
def retrieval_judged(spark, folder):
    """Measures against given rows of relevant documents: the vectors with the next and the seventh next number."""
    ids = vector_docs(spark, folder).select("pk")
    pairs = ids.select("pk", F.explode(F.array(F.col("pk") - 1, F.col("pk") - 7)).alias("query_id"))
    relevant = pairs.join(ids.select(F.col("pk").alias("query_id")), "query_id", "left_semi")
    measures = evaluate.query_measures(*evaluate.judge(_knn(spark, folder, 7), relevant), 7)
    names = ("precision", "recall", "reciprocal_rank", "ndcg")
    return measures.select("query_id", *[F.round(n, 6).alias(n) for n in names])


@query
def retrieval_eval(spark, folder):
    names = ("precision", "recall", "reciprocal_rank", "ndcg")
    mean = evaluate.mean_measures(_label_measures(spark, folder))
    return mean.select(*big("queries"), *[F.round(n, 6).alias(n) for n in names])


# -- prompts and training set --------------------------------------------------


@query
def last_message(spark, folder):
    turns = table(spark, folder, "conversations")
    return jobs.requests_of(turns)


@query
def last_message_nested(spark, folder):
    """The same over conversations held as arrays of messages, each array a block of at most MESSAGES of them."""
    # numbers of the scan make blocks, so that neither a long conversation nor tied turns make a long array
    block = F.floor(F.monotonically_increasing_id() / MESSAGES).alias("block")
    turns = table(spark, folder, "conversations").select("conv_id", block, "turn", "role", F.col("text").alias("content"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "content"))).alias("messages")
    chats = turns.groupBy("conv_id", "block").agg(ordered)
    last = chats.select(
        F.col("conv_id").alias("query_id"), F.element_at("messages", -1).alias("last"), X.last_message(F.col("messages")).alias("request")
    )
    return last.groupBy("query_id").agg(F.max_by("request", "last").alias("request"))


@query
def topic_question(spark, folder):
    asked = training.with_question(posts_csv(spark, folder))
    return asked.select("post_id", "topic", "topic_question")


@query
def token_budget(spark, folder):
    docs = table(spark, folder, "documents").withColumn("query", X.topic_question(F.col("source")))
    kept = training.within_budget(docs)
    counts = [X.token_count(F.col(c)).cast("bigint").alias(f"{n}_token_count") for c, n in (("text", "target"), ("query", "query"))]
    return kept.select("doc_id", *counts, *big("total_token_count"))


@query
def rag_prompts(spark, folder):
    prompts = jobs.chain_prompts(
        jobs.requests_of(table(spark, folder, "conversations")),
        repo_vectors(spark, folder),
        chunk_vectors(spark, folder),
    )
    return prompts.select(
        "query_id",
        F.col("messages")[0]["content"].alias("system"),
        F.col("messages")[1]["content"].alias("user"),
    )


def _training_rows(spark, folder, ties=False):
    posts = layers.gold_post(posts_ingested(spark, folder), keep="last", ties=ties)
    return jobs.training_rows(
        posts, repo_vectors(spark, folder), chunk_vectors(spark, folder), threshold=CONTEXT_FLOOR
    )


@query
def training_records(spark, folder):
    rows = _training_rows(spark, folder)
    return rows.select("post_id", "query", *big("total_token_count"))


@query
def training_records_ties(spark, folder):
    """From posts of which some stand twice: each has one record all the same."""
    rows = _training_rows(spark, folder, ties=True)
    return rows.select("post_id", "query", *big("total_token_count"))


@query
def train_eval_split(spark, folder):
    split = jobs.train_eval_split(posts_csv(spark, folder), share=0.2)
    return split.select("post_id", "part")


@query
def chat_jsonl(spark, folder):
    """Feature table, lookup, chat records and JSON Lines of the whole training set."""
    jsonl = shared_dir(spark, "chat-jsonl")
    jobs.build_training_set(_training_rows(spark, folder), shared_dir(spark, "features"), jsonl)
    return spark.read.text(jsonl)


@query
def feature_table(spark, folder):
    path = shared_dir(spark, "features")
    asked = training.with_question(posts_csv(spark, folder))
    tables.write_keyed(asked.select("post_id", F.col("topic_question").alias("query")), path, "post_id")
    return spark.read.parquet(path)


@query
def feature_upsert(spark, folder):
    asked = training.with_question(posts_csv(spark, folder))
    old = asked.where(F.col("is_published").isNotNull()).select("post_id", F.col("topic_question").alias("query"))
    new = asked.where(F.col("subtitle").isNull()).select("post_id", F.col("topic").alias("query"))
    return versions.upsert(old, new, "post_id")


@query
def feature_merge(spark, folder):
    """The same into a bucketed table, then without the keys of posts that are not published."""
    path = shared_dir(spark, "features")
    asked = training.with_question(posts_csv(spark, folder))
    first = asked.where(F.col("is_published").isNotNull())
    buckets.upsert(first.select("post_id", F.col("topic_question").alias("query")), path, "post_id")
    buckets.upsert(asked.where(F.col("subtitle").isNull()).select("post_id", F.col("topic").alias("query")), path, "post_id")
    buckets.delete(asked.where(F.col("is_published") == "false"), path, "post_id")
    return buckets.read(spark, path)


@query
def feature_lookup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return training.training_set(docs, table(spark, folder, "labels").select("doc_id", "quality"), "doc_id").select(
        "doc_id", *big("quality"), F.length("text").cast("long").alias("length")
    )


# -- tables, predicates and streams --------------------------------------------


@query
def nested_filter(spark, folder):
    events = table(spark, folder, "events").withColumn("usage", F.from_json("props", "k int"))
    kept = events.where("event_type = 'purchase' and usage.k is not null")
    return kept.select("event_id", "user_id", F.col("usage.k").cast("long").alias("k"))


@query
def sample_limit(spark, folder):
    turns = table(spark, folder, "conversations").withColumn("key", F.struct("conv_id", "turn"))
    return jobs.sample(turns, "key").select("conv_id", "turn", "role", "text")


@query
def union_sources(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), X.html_to_text(F.col("html")).alias("text")
    )
    docs = table(spark, folder, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text"
    )
    return docs.unionByName(pages)


@query
def table_profile(spark, folder):
    return evaluate.profile(table(spark, folder, "documents"), exact=True).select(
        "column_name", *big("row_count", "null_count", "distinct_count")
    )


def _snapshots(spark, folder):
    vectors = table(spark, folder, "embeddings")
    relabelled = F.when(F.col("label") == 5, F.col("label") + 1).otherwise(F.col("label"))
    new = vectors.where(F.col("label") != 1).withColumn("label", relabelled)
    return vectors.where(F.col("label") != 0), new


@query
def index_sync_changes(spark, folder):
    old, new = _snapshots(spark, folder)
    return versions.change_rows(old, new, "vec_id")


@query
def index_sync_apply(spark, folder):
    root = shared_dir(spark, "vectors")
    for version, source in enumerate(_snapshots(spark, folder)):
        jobs.sync_vectors(source, "vec_id", root, version)
    state = buckets.read(spark, f"{root}/table")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return state.select("vec_id", *big("label"), F.round(total, 5).alias("total"))


@query
def stream_bronze_append(spark, folder):
    """Two runs of one stream: the second finds nothing new."""
    out, checkpoint = shared_dir(spark, "bronze-events"), shared_dir(spark, "checkpoint")
    schema = table(spark, folder, "events").schema
    for _ in range(2):
        append_stream(files.stream_table(spark, folder, "events", schema), out, checkpoint)
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return spark.read.schema(schema).parquet(out).select(
        "event_id", micros.alias("ts_micros"), "user_id", "event_type", "value", "props"
    )


@query
def stream_silver_replay(spark, folder):
    """The same micro-batch written twice, as after a lost checkpoint: one copy stays."""
    out = shared_dir(spark, "silver-pages")
    schema = table(spark, folder, "pages").schema
    for _ in range(2):
        transform_stream(
            files.stream_table(spark, folder, "pages", schema),
            lambda batch: batch.select("page_id", X.html_to_text(F.col("html")).alias("text")),
            out,
            shared_dir(spark, "checkpoint"),
            replace=True,
        )
    return spark.read.parquet(out).select("page_id", "text")


@query
def stream_silver_restart(spark, folder):
    """Two arrivals of source files, a lost checkpoint, and a batch that is empty when it is replayed: one copy stays."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    source, out = shared_dir(spark, "bronze-pages"), shared_dir(spark, "silver-pages")
    even = F.crc32(F.col("page_id").cast("string")) % 2 == 0
    pages.where(even).write.mode("append").parquet(source)
    text = X.html_to_text(F.col("html")).alias("text")
    first, second = shared_dir(spark, "checkpoint"), shared_dir(spark, "checkpoint")

    def run(checkpoint):
        stream = files.stream_parquet(spark, source, pages.schema)
        transform_stream(stream, lambda batch: batch.select("page_id", text), out, checkpoint, replace=True)

    run(first)
    pages.where(~even).write.mode("append").parquet(source)
    run(first)
    run(second)
    # a batch beyond the last that left rows and is replayed without any
    mark = tables.run_id(spark, second)
    for batch in (pages.select("page_id", text), pages.where("page_id is null").select("page_id", text)):
        tables.append_batch(batch, 99, out, mark)
    return spark.read.parquet(out).select("page_id", "text")


def _raw_files(spark, folder):
    return table(spark, folder, "documents").select(
        F.concat_ws("/", "source", "doc_id").alias("file_name"),
        F.col("text").alias("content"),
        F.lit("20240917172131").alias("timestamp"),
        F.col("source").alias("repo"),
    )


@query
def stream_json(spark, folder):
    """Raw records of two collection runs, each in its folder, streamed into a table."""
    landing, out = shared_dir(spark, "landing"), shared_dir(spark, "bronze-files")
    raw = _raw_files(spark, folder)
    early = F.crc32("file_name") % 2 == 0
    for name, part in (("a", raw.where(early)), ("b", raw.where(~early))):
        tables.write_raw_run(part, landing, name)
        stream = files.stream_json(spark, landing, raw.schema, multi_line=False, most_files=1)
        append_stream(stream, out, f"{out}-checkpoint")
    return spark.read.schema(raw.schema).parquet(out)


@query
def stream_quarantine(spark, folder):
    """JSON files, one record a line, of which some are cut off: whole records go on, the rest is kept apart."""
    landing, out, apart = (shared_dir(spark, n) for n in ("landing", "silver-files", "quarantine"))
    raw = _raw_files(spark, folder)
    lines = raw.select("repo", F.to_json(F.struct(*raw.columns)).alias("line"))
    cut = F.col("repo").isin("src1", "src4")
    broken = F.when(cut, F.expr("left(line, length(line) - 2)")).otherwise(F.col("line"))
    lines.select(broken.alias("value")).write.text(landing)
    schema = T.StructType([*schemas.BRONZE_REPO.fields, *schemas.CORRUPT.fields])
    transform_stream(
        files.stream_json(spark, landing, schema, multi_line=False),
        lambda batch: batch.select(*raw.columns),
        out,
        f"{out}-checkpoint",
        malformed=F.col("_corrupt_record").isNotNull(),
        quarantine=apart,
    )
    kept = spark.read.parquet(out).select("file_name", "repo", F.length("content").cast("long").alias("length"), F.lit(False).alias("malformed"))
    bad = spark.read.parquet(apart).select(
        F.regexp_extract("_corrupt_record", '"file_name":"([^"]*)"', 1).alias("file_name"),
        F.lit(None).cast("string").alias("repo"),
        F.lit(None).cast("long").alias("length"),
        (F.col("_file").contains("/part-")).alias("malformed"),
    )
    return kept.unionByName(bad)


@query
def stream_csv(spark, folder):
    """Post lists as CSV files, one folder per export, streamed with the file each row came from."""
    landing, out = shared_dir(spark, "landing"), shared_dir(spark, "bronze-posts")
    lists = posts_csv(spark, folder).drop("filePath")
    plain = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lists.write.options(**plain).option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{landing}/export")
    append_stream(files.stream_csv(spark, landing), out, f"{out}-checkpoint")
    stored = spark.read.parquet(out)
    where = F.element_at(F.split(X.parent_folder(F.col("filePath")), "/"), -1).alias("export")
    return stored.select("post_id", "is_published", "title", "subtitle", where)


def _text_files(spark, folder, name):
    """Text files of bounded size below a folder for each source: a line per document.

    A source of more than FILE_BYTES is dealt to as many parts as it has such sizes.
    """
    root = shared_dir(spark, name)
    lines = table(spark, folder, "documents").select("doc_id", "source", F.translate("text", "\n", " ").alias("value"))
    size = F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + 1).alias("size")
    sizes = materialise(lines.groupBy("source").agg(size), f"{name}-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    # there are at most total / FILE_BYTES of these
    large = sizes.where(F.col("size") > FILE_BYTES).select(
        F.col("source").alias("large"), F.ceil(F.col("size") / FILE_BYTES).alias("parts")
    )
    dealt = lines.join(F.broadcast(large), F.col("source").eqNullSafe(F.col("large")), "left")
    part = F.pmod(F.xxhash64("doc_id", "value"), F.coalesce("parts", F.lit(1)))
    # a task writes one file for each of its sources, so there are as many tasks as files of this size
    dealt = dealt.repartition(max(1, -(-total // FILE_BYTES)), "source", part)
    dealt.select("source", "value").write.partitionBy("source").text(root)
    return root


@query
def stream_binary(spark, folder):
    """Files as bytes: how many there are for each source."""
    root, out = _text_files(spark, folder, "landing"), shared_dir(spark, "bronze-bytes")
    append_stream(files.stream_binary(spark, f"{root}/source=*", "*.txt"), out, f"{out}-checkpoint")
    source = F.regexp_extract("path", "source=([^/]+)", 1).alias("source")
    size = F.sum(F.octet_length("content")).cast("long").alias("size")
    return spark.read.parquet(out).groupBy(source).agg(size)


@query
def file_listing(spark, folder):
    listed = files.list_files(spark, _text_files(spark, folder, "listed"))
    source = F.regexp_extract("path", "source=([^/]+)", 1).alias("source")
    texts = listed.where(F.col("name").rlike(r"^part-.*\.txt$"))
    return texts.groupBy(source).agg(F.sum("size").cast("long").alias("size"))


@query
def table_profile_sketch(spark, folder):
    """The default profile, by sketches; counts of rows and nulls are exact."""
    found = evaluate.profile(table(spark, folder, "documents"))
    return found.select("column_name", *big("row_count", "null_count"))


@query
def table_profile_merged(spark, folder):
    """A profile from the sketches of three batches; estimates are compared with the exact profile."""
    docs = table(spark, folder, "documents")
    kept = shared_dir(spark, "sketches")
    for number, batch in enumerate((docs.where("lang = 'en'"), docs.where("lang = 'de'"), docs.where("lang not in ('en', 'de')"))):
        tables.append_batch(evaluate.sketch_batch(batch), number, kept)
    found = evaluate.merged_profile(spark.read.parquet(kept))
    exact = evaluate.profile(docs, exact=True).select("column_name", F.col("distinct_count").alias("exact"))
    middle = docs.select(F.percentile("n_chars", 0.47).alias("low"), F.percentile("n_chars", 0.53).alias("high"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.05 * F.col("exact") + 1
    inside = F.when(F.col("column_name") == "n_chars", F.col("quantiles")[1].between(F.floor("low"), F.ceil("high")))
    return found.join(exact, "column_name").crossJoin(F.broadcast(middle)).select(
        "column_name", *big("row_count", "null_count", "least", "most"),
        near.alias("distinct_near"), inside.alias("median_near"),
    )


@query
def ad_hoc_sql(spark, folder):
    """SQL text over registered tables."""
    name = f"docs_{uuid.uuid4().hex}"
    table(spark, folder, "documents").createOrReplaceTempView(name)
    return spark.sql(
        f"select source, lang, count(*) as docs, max(n_chars) as longest from {name} where n_chars > 100 group by source, lang"
    )


@query
def table_drop(spark, folder):
    """A catalog table over written files is dropped; the catalog forgets it and the files stay."""
    path, name = shared_dir(spark, "dropped"), f"labels_{uuid.uuid4().hex}"
    tables.overwrite_snapshot(table(spark, folder, "labels"), path)
    spark.sql(f"create table {name} using parquet location '{path}'")
    before = files.table_or_path(spark, name).count()
    tables.drop_table(spark, name)
    listed = F.lit(spark.catalog.tableExists(name)).alias("listed")
    return files.table_or_path(spark, path).select("doc_id", *big("quality", "toxic"), listed, F.lit(before).cast("long").alias("before"))


@query
def ingestion_stamp(spark, folder):
    """Each micro-batch has one time of ingestion, between the start and the end of its stream."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    source, out = shared_dir(spark, "stamped-in"), shared_dir(spark, "stamped")
    started = spark.range(1).select(F.current_timestamp().alias("t")).first().t
    for part in (pages.where("url like 'https%'"), pages.where("url not like 'https%'")):
        part.write.mode("append").parquet(source)
        stream = files.stream_parquet(spark, source, pages.schema)
        transform_stream(stream, stamped, out, f"{out}-checkpoint")
    kept = spark.read.parquet(out)
    times = kept.groupBy("batch_id").agg(F.count_distinct("ingestion_time").alias("times"))
    since = F.col("ingestion_time").between(F.lit(started), F.current_timestamp())
    return kept.join(F.broadcast(times), "batch_id").select("page_id", *big("batch_id", "times"), since.alias("in_time"))


@query
def file_elements(spark, folder):
    """Elements that an extractor reads out of the bytes of streamed files."""
    root, out = _text_files(spark, folder, "extracted"), shared_dir(spark, "bronze-extracted")
    append_stream(files.stream_binary(spark, f"{root}/source=*", "*.txt"), out, f"{out}-checkpoint")

    def lines():
        return lambda blobs: [blob.decode().split("\n")[:-1] for blob in blobs]

    found = layers.file_elements(spark.read.parquet(out), lines)
    size = F.aggregate("elements", F.lit(0).cast("long"), lambda total, e: total + F.length(e))
    return found.groupBy(F.regexp_extract("path", "source=([^/]+)", 1).alias("source")).agg(
        F.sum(F.size("elements")).cast("long").alias("elements"), F.sum(size).alias("chars")
    )
