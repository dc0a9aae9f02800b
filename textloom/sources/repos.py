"""Repository listings and repository files."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as X

# -- fixed values --------------------------------------------------------------
IGNORED = (".git", ".toml", ".lock", ".png", ".jpg", ".csv", ".pyc", ".pdf")
KEYED_BY_NAME = (".ipynb", ".py", ".md")
KEYED_BY_PATH = (".yaml", ".sh")
DOCKERFILE = "Dockerfile"
MAX_AGE_DAYS = 30
# -- end of fixed values -------------------------------------------------------


def recent_repos(repos: DataFrame, run_time: dt.datetime, max_age_days: int = MAX_AGE_DAYS) -> DataFrame:
    """Public repositories updated less than `max_age_days` whole days before `run_time`.

    Less than n whole days old is the same as changed after (run - n * 24 h),
    a plain comparison that the scan can use. One url per name: the one
    updated last. A time without a zone is taken as UTC, whatever the zone of
    the driver is.
    """
    aware = run_time if run_time.tzinfo else run_time.replace(tzinfo=dt.timezone.utc)
    oldest = aware - dt.timedelta(days=max_age_days)
    newest = F.max(F.struct("updated_at", "html_url"))["html_url"]
    return (
        repos.where(~F.col("private") & (F.col("updated_at") > F.lit(oldest)))
        .groupBy("name")
        .agg(newest.alias("html_url"))
    )


def _open(root: str) -> tuple[fs.FileSystem, str]:
    where, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
    return where, base.rstrip("/")


def list_tree(spark: SparkSession, root: str, spread_levels: int = 2) -> DataFrame:
    """(path below `root`, size) of every file, also of names that start with `_` or `.`.

    Folders of the first levels are listed one by one and dealt anew to all
    cores after each level, so neither the driver nor one task lists the
    tree; what lies deeper is listed whole, folder by folder.
    """

    def children(recursive: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            where, base = _open(root)
            for batch in batches:
                for path, size, folder in zip(batch["path"], batch["size"], batch["folder"]):
                    if not folder:
                        yield pd.DataFrame({"path": [path], "size": [size], "folder": [False]})
                        continue
                    found = where.get_file_info(fs.FileSelector(f"{base}/{path}".rstrip("/"), recursive=recursive))
                    found = [i for i in found if i.is_file or not recursive]
                    for start in range(0, len(found), 10_000):
                        part = found[start : start + 10_000]
                        yield pd.DataFrame(
                            {
                                "path": [i.path.removeprefix(f"{base}/") for i in part],
                                "size": [i.size or 0 for i in part],
                                "folder": [not i.is_file for i in part],
                            }
                        )

        return run

    schema = "path string, size long, folder boolean"
    level = spark.createDataFrame([("", 0, True)], schema)
    tasks = 4 * spark.sparkContext.defaultParallelism
    for number in range(spread_levels + 1):
        level = level.mapInPandas(children(number == spread_levels), schema).repartition(tasks, "path")
    return level.where(~F.col("folder")).select("path", "size")


def read_checkouts(spark: SparkSession, root: str) -> DataFrame:
    """Files of all checkouts below `root` as (repo, rel_path, content bytes).

    The first folder below `root` names the repository. Spark's own file
    sources skip names that start with `_` or `.`, such as `__init__.py`, so
    tasks list the folders and, spread anew over all cores, read the files;
    one large repository does not keep one task busy. Files that no rule keeps
    are not read. `root` is a path or a URI that all executors can reach.
    """
    endings = (*KEYED_BY_NAME, *KEYED_BY_PATH, DOCKERFILE)
    tasks = 4 * spark.sparkContext.defaultParallelism
    listed = list_tree(spark, root).where(F.col("path").contains("/"))
    top = F.substring_index("path", "/", 1)
    wanted = listed.select(top.alias("repo"), F.expr("substring(path, length(substring_index(path, '/', 1)) + 2)").alias("rel_path"))
    wanted = wanted.where(F.col("rel_path").rlike(_one_of(endings) + r"\z"))

    def read_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, base = _open(root)
        for batch in batches:
            for row in batch.itertuples(index=False):
                with where.open_input_stream(f"{base}/{row.repo}/{row.rel_path}") as stream:
                    content = stream.read()
                yield pd.DataFrame([(row.repo, row.rel_path, content)], columns=["repo", "rel_path", "content"])

    return wanted.repartition(tasks, "repo", "rel_path").mapInPandas(
        read_files, "repo string, rel_path string, content binary"
    )


def _one_of(texts: tuple[str, ...]) -> str:
    return "(?:" + "|".join(re.escape(text) for text in texts) + ")"


def route_files(
    files: DataFrame, ignored: tuple[str, ...] = IGNORED, any_depth: bool = False
) -> DataFrame:
    """Choose, key and clean repository files: (repo, rel_path, file_name, content).

    `files` has repo, rel_path and content (text). A file is dropped when its
    folder path starts with an ignored string, or its name ends with one. With
    `any_depth` a folder anywhere on the path counts, not only the first.
    Notebooks, Python and Markdown files are keyed by name, YAML and shell
    files and Dockerfiles by path; other files are dropped. Blanks are taken
    out of everything but notebooks, whose cells are joined.
    """
    path = F.col("rel_path")
    start = "(?:^|/)" if any_depth else "^"
    by_name = path.rlike(_one_of(KEYED_BY_NAME) + r"\z")
    by_path = path.rlike(_one_of(KEYED_BY_PATH) + r"\z|(?:^|/)" + re.escape(DOCKERFILE) + r"\z")
    return (
        files.where(~path.rlike(f"(?s){start}{_one_of(ignored)}.*/"))
        .where(~path.rlike(_one_of(ignored) + r"\z"))
        .where(by_name | by_path)
        .select(
            "repo",
            "rel_path",
            F.when(by_name, F.element_at(F.split(path, "/"), -1)).otherwise(path).alias("file_name"),
            F.when(path.endswith(".ipynb"), X.notebook_with_outputs(F.col("content")))
            .otherwise(X.remove_blanks(F.col("content")))
            .alias("content"),
        )
    )


def resolve_collisions(routed: DataFrame) -> DataFrame:
    """One file per (repo, file_name): the one with the largest path.

    `max_by` keeps one candidate per key and task before the shuffle, however
    many files share the key.
    """
    return routed.groupBy("repo", "file_name").agg(F.max_by("content", "rel_path").alias("content"))


def raw_records(files: DataFrame, run_time: dt.datetime) -> DataFrame:
    """Records for the raw layer, stamped with the run's time as text."""
    return files.select(
        "file_name", "content", F.lit(run_time.strftime("%Y%m%d%H%M%S")).alias("timestamp"), "repo"
    )
