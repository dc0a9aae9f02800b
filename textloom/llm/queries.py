"""One query per operator, over whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    chat,
    licenses,
    packing,
    pii,
    quality_rules,
    rule_ensemble,
    simhash,
    spelling,
    token_counts,
    topk,
    toxicity,
    unigram,
    whitening,
)
from textloom.session import materialise, shared_dir


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.ledger(_table(spark, folder, "documents"))
    rows = quality_rules.apply_policy(rows, quality_rules.POLICIES[quality_rules.CURRENT])
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.fails(quality_rules.BASE).alias("base_failed"), "kept",
        "failed", "n_lines", "n_upper", "n_lower",
    )


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"), width=3, reach=3)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    pieces = unigram.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = unigram.encode(_table(spark, folder, "documents"), pieces, ["doc_id", "text"])
    back = unigram.decode(encoded, pieces, ["doc_id", "text"])
    exact = (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip")
    return back.select("doc_id", "n_tokens", "n_byte_tokens", "ids_crc32", exact)


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scored = rule_ensemble.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = pii.with_spans(docs, pii.train(docs), ["doc_id"])
    place = F.create_map(*[F.lit(x) for i, k in enumerate(pii.KINDS) for x in (k, i)])

    def listed(spans):
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(place[s.kind].alias("p"), s.start, s.end, s.kind)))
        return F.array_join(
            F.transform(ordered, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
        )

    def number(kind):
        return F.size(F.filter("base_spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in pii.KINDS],
        F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
        listed(F.concat("base_spans", "added_spans")).alias("spans"),
    )


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents are inserted, recounted with a newer vocabulary, later copies deleted, and batches replayed."""
    files = {"v1": public_tokenizers.path("byte_bpe_50k.tiktoken"), "v2": public_tokenizers.path("byte_bpe_multi_50k.tiktoken")}
    docs = _table(spark, folder, "documents").withColumn("digest", F.md5("text"))
    keep = ["doc_id", "source", "lang", "digest"]
    counted = materialise(token_counts.count_tokens(docs, files, public_tokenizers.PATTERN, keep), "token-counts")

    def changes(rows: DataFrame, op: str, version: str) -> DataFrame:
        return rows.select(
            F.lit(op).alias("op"), "doc_id", "source", "lang", F.lit(f"byte_bpe_{version}").alias("tokenizer"),
            F.col(version).alias("n_tokens"),
        )

    # written, so that the join below is of two plain shuffles, which AQE splits at a large group of copies
    first = materialise(counted.groupBy("digest").agg(F.min("doc_id").alias("first")), "first-copies")
    copies = counted.join(first, "digest").where("doc_id != first")
    batches = [changes(counted, "insert", "v1"), changes(counted, "revise", "v2"), changes(copies, "delete", "v2")]
    rollup = token_counts.Rollup(spark, shared_dir(spark, "token-rollup"))
    for number, batch in enumerate(batches):
        rollup.apply(number, batch)
    for number, batch in enumerate(batches):
        rollup.apply(number, batch)
    return rollup.totals()


def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    given = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    formatted = chat.format_conversations(given.unionByName(extra), ranks, pattern)
    return chat.read_back(formatted, ranks, pattern).drop("n_tokens", "loss_tokens")


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"), components=16)


def op12_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licensed(_table(spark, folder, "documents"), ["doc_id"])


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_quality_rules,
        op3_simhash_near_dedup,
        op4_toxicity,
        op5_sentencepiece,
        op6_quality_classifier,
        op7_exact_top_k,
        op8_pii,
        op9_token_counts,
        op10_chat_formatting,
        op11_embedding_whitening,
        op12_license_scans,
        op13_spelling_variants,
    )
}
