"""Silver and gold transformations of repository files, PDFs and posts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom import schemas
from textloom.functions import text as X
from textloom.functions.embed import Model, embed_text, map_model
from textloom.operators import chunking, distil, versions
from textloom.streaming.jobs import stamped

MakeModel = Callable[[], Model]

# -- silver --------------------------------------------------------------------


def silver_repo(
    bronze: DataFrame, chat: MakeModel | None = None, embedder: MakeModel | None = None
) -> DataFrame:
    """Files with their distilled text and its vector.

    With a chat model every file is sent to it, whatever else is in the table.
    Without one see `distilled`.
    """
    if chat is not None:
        return embed_text(distil.distil_with_model(bronze, chat), make_model=embedder)
    return distilled(bronze, embedder)


def distilled(bronze: DataFrame, embedder: MakeModel | None = None) -> DataFrame:
    """Files with their own header, strongest words and sentences, and the vector of these.

    Words are weighed over all of `bronze`, so it should be the whole table and
    not a batch of it. Copies are distilled once.
    """
    keyed = bronze.withColumn("_content", F.sha2("content", 256))
    unique = keyed.select("_content", "content").dropDuplicates(["_content"])
    texts = embed_text(distil.distil(unique, "_content"), make_model=embedder)
    return keyed.join(texts.drop("content"), "_content", "left").drop("_content")


def file_elements(bronze: DataFrame, extractor: MakeModel, error_col: str | None = None) -> DataFrame:
    """Files with the `elements` that `extractor` reads out of their bytes, a few files at a time.

    With `error_col` a file that cannot be read has null elements and says why there.
    """
    return map_model(bronze, "content", "elements", "array<string>", extractor, 8, error_col)


def silver_pdf(
    bronze: DataFrame,
    extractor: MakeModel,
    embedder: MakeModel | None = None,
    chunk_embedder: MakeModel | None = None,
) -> DataFrame:
    """Numbered chunks with vectors, from the elements that `extractor` reads out of file bytes."""
    joined = file_elements(bronze, extractor).select(
        "path", chunking.joined_elements(F.col("elements")).alias("text")
    )
    return silver_chunks(joined, embedder, chunk_embedder)


def silver_chunks(
    texts: DataFrame,
    embedder: MakeModel | None = None,
    chunk_embedder: MakeModel | None = None,
    alphabetical: bool = True,
) -> DataFrame:
    """Chunks with vectors from (path, text), numbered by the alphabet or by their place in the text."""
    cut = chunking.semantic_chunks(texts, make_model=chunk_embedder).select("path", "text_chunks")
    chunks = stamped(chunking.explode_chunks(cut, alphabetical=alphabetical))
    return embed_text(chunks, "text_chunk", make_model=embedder).select(
        "ingestion_time", "path", "text_chunk", "row_number", "text_vector"
    )


def silver_post(bronze: DataFrame, html_files: DataFrame, only_true: bool = False) -> DataFrame:
    """Posts that have a publication flag, with the text of their HTML file.

    All HTML files are read by one scan and joined by path; a post without a
    file gets a null text. The flag is tested for null only, unless
    `only_true`. `html_files` has html_path and html (text) or html_bytes.
    """
    posts = bronze.where(F.col("is_published").isNotNull())
    if only_true:
        posts = posts.where(F.lower("is_published") == "true")
    # files are decoded and parsed after the join: a batch of posts wants few of them
    wanted = posts.withColumn("html_path", X.linked_html_path(F.col("filePath"), F.col("post_id")))
    joined = wanted.join(html_files, "html_path", "left")
    html = X.utf8_text(F.col("html_bytes")) if "html_bytes" in html_files.columns else F.col("html")
    return stamped(joined.withColumn("text", X.html_to_text(html))).select(*schemas.SILVER_POST.names)


def posts_without_file(silver: DataFrame) -> DataFrame:
    """Posts whose HTML file was not found."""
    return silver.where(F.col("text").isNull()).select("post_id", "html_path")


_POST_ROW = ["post_id", "html_path", "ingestion_time"]


def late_posts(silver: DataFrame, html_files: DataFrame) -> DataFrame:
    """Silver rows that had no file when they were written and have one among `html_files` now.

    Only rows without a text are joined, and only files that such a row waits for are parsed.
    """
    pending = silver.where(F.col("text").isNull() & F.col("html_path").isNotNull()).drop("text")
    found = pending.join(html_files, "html_path")
    html = X.utf8_text(F.col("html_bytes")) if "html_bytes" in html_files.columns else F.col("html")
    return found.withColumn("text", X.html_to_text(html)).select(*schemas.SILVER_POST.names)


def with_late_posts(silver: DataFrame, late: DataFrame) -> DataFrame:
    """Silver with the rows of `late` in the place of those that waited for a file."""
    late = late.select(*silver.columns)
    match = F.lit(True)
    filled = late.groupBy(*[F.col(c).alias(f"_{c}") for c in _POST_ROW]).agg(F.count(F.lit(1)).alias("_n"))
    for column in _POST_ROW:
        match = match & F.col(column).eqNullSafe(F.col(f"_{column}"))
    waiting = silver.where(F.col("text").isNull())
    return (
        silver.where(F.col("text").isNotNull())
        .unionByName(waiting.join(filled, match, "left_anti"))
        .unionByName(late)
    )


# -- gold ----------------------------------------------------------------------


def gold_repo(silver: DataFrame, denied: DataFrame | None = None) -> DataFrame:
    """First version per file key (ties stay) without the denied keys.

    The key holds the time, so versions of a file have different keys and
    only copies share one.
    """
    keyed = versions.with_file_id(silver)
    first = versions.pick_version(keyed, ["gitrepo_file_id"], "timestamp")
    if denied is not None:
        first = versions.exclude_keys(first, denied, "gitrepo_file_id")
    return first.select(
        "content", "file_name", "repo", "timestamp", "text", "text_vector", "gitrepo_file_id"
    )


def gold_repo_latest(silver: DataFrame, denied: DataFrame | None = None) -> DataFrame:
    """The newest version of each (file_name, repo) without the denied keys; of equally new ones by content digest."""
    keyed = versions.with_file_id(silver)
    if denied is not None:
        keyed = versions.exclude_keys(keyed, denied, "gitrepo_file_id")
    return versions.pick_version(
        keyed, ["file_name", "repo"], "timestamp", keep="last", ties=False, tie_break=F.md5("content")
    )


def gold_pdf(silver: DataFrame, newest_only: bool = False) -> DataFrame:
    """Chunks with their key; with `newest_only` those of the last ingestion of each path."""
    chunks = chunking.newest_ingestion(silver) if newest_only else silver
    return versions.with_chunk_id(chunks).select(
        "pdf_chunk_id", F.col("text_chunk").alias("text"), "text_vector"
    )


def gold_post(silver: DataFrame, keep: str = "first", ties: bool = True) -> DataFrame:
    """One version per post (copies of the same ingestion stay with `ties`), titled posts only."""
    return (
        versions.pick_version(silver, ["post_id"], "ingestion_time", keep, ties)
        .select("post_id", "ingestion_time", "text", "title", "subtitle")
        .dropna(subset=["title"])
    )


def vector_table(gold: DataFrame, key: str) -> DataFrame:
    """(pk, text, vector) of a gold table, as the search reads it."""
    return gold.select(
        F.col(key).cast(T.StringType()).alias("pk"), "text", F.col("text_vector").alias("vector")
    )
