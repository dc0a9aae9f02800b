"""Token counts by source, language and tokenizer version, kept by signed deltas.

A batch of changes becomes signed ledger rows: an insert adds a row, a delete takes away the rows
that a document has, a revision does both. The totals of a batch are those of the batch before
plus the sums of its own rows, so a batch costs what changed. A batch is committed when
its totals are written whole; one that is committed already is not applied again, and what a
failed attempt left is ignored and overwritten.

Batches carry rising numbers. Totals are additive: they hold no row of a document, and a hot
source is summed in its tasks before anything is shuffled.

Defined cases: null source, language or tokenizer is a group of its own; a null text counts no
tokens; null ids are one id; a document inserted twice counts twice, and a delete takes
both; deleting or revising what is not there only adds the revision's new row. Empty tables
and batches leave the totals as they are.
"""

from __future__ import annotations

import base64
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import add_columns

GROUP = ("source", "lang", "tokenizer")
LEDGER = "doc_id long, source string, lang string, tokenizer string, sign long, n_tokens long"
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
CHANGES = "op string, doc_id long, source string, lang string, tokenizer string, n_tokens long"

_CODECS: dict = {}


def _codec(path: str, pattern: str):
    if path not in _CODECS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _CODECS[path] = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _CODECS[path]


def _counter(paths: tuple[str, ...], pattern: str):
    codecs = [_codec(p, pattern) for p in paths]
    return lambda texts: [tuple(len(c.encode_ordinary(t)) if t else 0 for c in codecs) for t in texts]


def count_tokens(docs: DataFrame, vocabularies: dict[str, str], pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns and for each entry of `vocabularies` (column -> file of ranks) the number of tokens."""
    added = ", ".join(f"{name} long" for name in vocabularies)
    make = functools.partial(_counter, tuple(vocabularies.values()), pattern)
    return add_columns(docs, [F.col(text)], [F.col(c) for c in keep], added, make)


#: Committed batches after which the ledger is compacted.
COMPACT = 8


class Rollup:
    """Ledger and totals below a shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, kind: str, batch: int) -> str:
        return f"{self.root}/{kind}/batch={batch}"

    def _marked(self, mark: str) -> list[int]:
        """Numbers of the batches that have a mark; marks are folders of our own, made when all is written."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{mark}-*")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(int(f.getPath().getName().rsplit("-", 1)[1]) for f in files or [])

    def _mark(self, mark: str, batch: int) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{mark}-{batch}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)

    def committed(self) -> list[int]:
        """Numbers of the batches whose totals are whole."""
        return self._marked("committed")

    def totals(self) -> DataFrame:
        """n_docs and n_tokens per group after the last committed batch; groups without documents are left out."""
        done = self.committed()
        if not done:
            return self.spark.createDataFrame([], TOTALS)
        return self.spark.read.schema(TOTALS).parquet(self._path("totals", done[-1]))

    def live(self) -> DataFrame:
        """Rows that documents have after the committed batches, `n` times each."""
        return self._summed(self.committed())

    def _summed(self, batches: list[int]) -> DataFrame:
        """The ledger up to the last of the batches: the newest compacted ledger before it, and what came later."""
        before = [b for b in self._marked("compacted") if batches and b <= batches[-1]]
        later = [b for b in batches if not before or b > before[-1]]
        paths = [self._path("compact", b) for b in before[-1:]] + [self._path("ledger", b) for b in later]
        rows = self.spark.read.schema(LEDGER).parquet(*paths) if paths else self.spark.createDataFrame([], LEDGER)
        return rows.groupBy("doc_id", *GROUP, "n_tokens").agg(F.sum("sign").alias("n")).where("n != 0")

    def compact(self) -> None:
        """Write what the ledger of all committed batches comes to, so that later batches read that in its place."""
        done = self.committed()
        if done and done[-1] not in self._marked("compacted"):
            rows = self._summed(done).select("doc_id", *GROUP, F.col("n").alias("sign"), "n_tokens")
            rows.write.mode("overwrite").parquet(self._path("compact", done[-1]))
            self._mark("compacted", done[-1])

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Applies a batch (columns of CHANGES, op insert, delete or revise) once; False if it was committed before.

        A delete or a revision names a document; its rows are found in the ledger. A document that a
        batch names several times loses its rows once.
        """
        done = self.committed()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after batch {done[-1]}, which is committed")
        gone = changes.where(F.col("op").isin("delete", "revise")).select(F.col("doc_id").alias("__id")).distinct()
        old = self.live().join(gone, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
        minus = old.select("doc_id", *GROUP, (-F.col("n")).alias("sign"), "n_tokens")
        plus = changes.where(F.col("op").isin("insert", "revise")).select(
            "doc_id", *GROUP, F.lit(1).cast("long").alias("sign"), "n_tokens"
        )
        plus.unionByName(minus).write.mode("overwrite").parquet(self._path("ledger", batch))
        rows = self.spark.read.schema(LEDGER).parquet(self._path("ledger", batch))
        delta = rows.groupBy(*GROUP).agg(
            F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.coalesce("n_tokens", F.lit(0))).alias("n_tokens")
        )
        summed = self.totals().unionByName(delta).groupBy(*GROUP).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        )
        summed.where("n_docs != 0").write.mode("overwrite").parquet(self._path("totals", batch))
        self._mark("committed", batch)
        if (len(done) + 1) % COMPACT == 0:
            self.compact()
        return True
