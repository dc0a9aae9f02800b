"""Header, keywords and summary of a text.

`distil_with_model` sends each text to a chat model. `distil` needs no model:
it takes the header, the strongest words and the strongest sentences of the
text itself, by TF-IDF over the whole table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import text as X
from textloom.functions.embed import Model, map_model
from textloom.session import materialise

_SENTENCE_GAP = re.compile(rb"(?<=[.?!])[ \t\n\x0b\f\r]+|\x1f")
#: Words whose weights are sent to every task at most, and the bytes that one of them may have.
COMMON_WORDS, COMMON_BYTES = 500_000, 64
#: Levels of document counts, per factor of two, of which the upper ones are common.
_LEVELS = 8


def distil_with_model(
    df: DataFrame, make_model: Callable[[], Model], in_col: str = "content", out_col: str = "text"
) -> DataFrame:
    """Add the answer of a chat model to the distilling instruction with the text filled in."""
    asked = df.withColumn("_request", X.fill(X.DISTIL_INSTRUCTION, **{"{text}": F.col(in_col)}))
    return map_model(asked, "_request", out_col, "string", make_model).drop("_request")


def header(text: Column) -> Column:
    """The first line that is not blank, without white space at its ends."""
    return X.strip_space(F.regexp_extract(text, r"(?m)^(.*\S.*)$", 1))


def word_places(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, word, places): the numbers of the sentences of a row that hold a word, once per occurrence.

    Words are gathered in the task that reads the row, so that occurrences are
    never shuffled. `key` must not be called word or places.
    """
    lowered = df.select(key, F.lower(text_col).alias("_text"))
    words = T.ArrayType(T.StructType.fromDDL("word string, places array<int>"))
    schema = T.StructType([lowered.schema[key], T.StructField("_words", words)])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = _word_lists(part.column("_text").cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(key), rows], [key, "_words"])

    return lowered.mapInArrow(gather, schema).select(key, F.inline("_words"))


def _word_lists(texts: list[bytes | None]) -> pa.ListArray:
    """Per lower-case text a list of (word, sentence numbers), cut as `X.sentences` and `X.words` do."""
    words, lengths, sentences = [], [], []
    for text in texts:
        cut = _SENTENCE_GAP.split(text or b"")
        sentences.append(len(cut))
        for sentence in cut:
            found = sentence.split()  # of bytes: at ASCII white space alone
            words += found
            lengths.append(len(found))
    coded = pa.array(words, pa.binary()).dictionary_encode()
    names, code = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64)
    number = np.array(sentences, np.int64)
    first = np.repeat(np.cumsum(number) - number, number)
    sentence = np.repeat(np.arange(len(first)) - first, lengths).astype(np.int32)
    row = np.repeat(np.repeat(np.arange(len(number)), number), lengths)
    # occurrences by row and word, in the order of the text
    order = np.argsort(row * len(names) + code, kind="stable")
    row, code = row[order], code[order]
    starts = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(code, prepend=-1) != 0))
    places = pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)).astype(np.int32)), pa.array(sentence[order]))
    pairs = pa.StructArray.from_arrays([names.take(pa.array(code[starts])), places], ["word", "places"])
    ends = np.cumsum(np.bincount(row[starts], minlength=len(number)))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pairs)


def word_weights(places: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """(key, word, places, weight): TF-IDF of each word of each row, from the written result of `word_places`.

    The words of the most documents, at most COMMON_WORDS, are sent to all tasks, so rows with one
    of them, nearly all, get their weights where they lie, next to the other words of their text.
    Only those with a rare word meet its count by key, in a table that is written once.
    """
    counted = places.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    counted = materialise(counted, "word-counts")
    total = rows.agg(F.count("*").alias("n")).first()["n"]
    idf = (F.log((F.lit(total) + 1) / (F.col("df") + 1)) + 1).alias("idf")
    weight = F.round(F.size("places") * F.col("idf"), 6).alias("weight")
    is_common = _is_common(counted)
    common = F.broadcast(counted.where(is_common).select("word", idf))
    weighed = places.join(common, "word").select(key, "word", "places", weight)
    rare = counted.where(~is_common).select("word", idf)
    if not rare.take(1):
        return weighed
    others = places.join(common, "word", "left_anti").join(rare, "word")
    return weighed.unionByName(materialise(others.select(key, "word", "places", weight), "rare-weights"))


def _is_common(counted: DataFrame) -> Column:
    """True for the short words of the most documents, at most COMMON_WORDS."""
    short, level = F.octet_length("word") <= COMMON_BYTES, F.floor(F.log2("df") * _LEVELS)
    # a row per level, at most 64 * _LEVELS
    levels = counted.where(short).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, sent = None, 0
    for row in sorted(levels, key=lambda r: -r.level):
        sent += row.n
        if sent > COMMON_WORDS:
            break
        least = row.level
    return F.lit(False) if least is None else short & (level >= least)


def _best(df: DataFrame, key: str, order: list, count: int, value: str) -> DataFrame:
    """(key, best): array of (place, value) of the first `count` rows of each key."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    top = df.withColumn("place", place).where(F.col("place") <= count)
    return top.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("place", value))).alias("best")
    )


def keywords(weights: DataFrame, key: str, count: int = 10) -> DataFrame:
    """(key, keywords): the heaviest words with ", " between, heaviest first."""
    best = _best(weights, key, [F.desc("weight"), F.col("word")], count, "word")
    return best.select(
        key, F.array_join(F.transform("best", lambda e: e["word"]), ", ").alias("keywords")
    )


def best_sentences(weights: DataFrame, key: str, count: int = 3) -> DataFrame:
    """(key, picked): numbers of the sentences with the largest sums of word weights, ascending."""
    scored = (
        weights.select(key, "weight", F.explode("places").alias("i"))
        .groupBy(key, "i")
        .agg(F.round(F.sum("weight"), 4).alias("score"))
    )
    best = _best(scored, key, [F.desc("score"), F.col("i")], count, "i")
    return best.select(key, F.array_sort(F.transform("best", lambda e: e["i"])).alias("picked"))


def distil(
    df: DataFrame, key: str, text_col: str = "content", out_col: str = "text"
) -> DataFrame:
    """Add `out_col`: header, keywords and summary, a line each; an empty part is left out.

    `key` must be unique. Texts are shuffled once, to meet their keywords and
    sentence numbers; the sentences are cut again from the text itself.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(text_col).alias("_text"))
    # read by several branches, so written once
    places = materialise(word_places(rows, "_key", "_text"), "word-places")
    weights = word_weights(places, rows, "_key")
    picked = (
        keywords(weights, "_key")
        .join(best_sentences(weights, "_key"), "_key")
        .withColumnRenamed("_key", key)
    )
    text = F.col(text_col)
    summary = X.let(
        X.sentences(text),
        lambda all_: F.array_join(F.transform("picked", lambda i: F.get(all_, i)), " "),
    )
    return (
        df.join(picked, key, "left")
        .withColumn(out_col, F.concat_ws("\n", header(text), "keywords", summary))
        .drop("keywords", "picked")
    )
