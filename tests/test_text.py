from __future__ import annotations

import html
import json

import pytest
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from textloom.functions import text as X


def test_html_to_text_keeps_visible_text_only(one):
    pages = {
        "<p>a<b>b</b>\n c</p>": "ab\n c",
        "<!-- <script> -->x<!--y-->": "x",
        "<script>var t='</p>';</script>z<STYLE>p{}</STYLE >": "z",
        "<template><p>t</p></template>z": "z",
        "<!DOCTYPE html><title>T</title>": "T",
        "<a title='x > y'>z</a>": "z",
        "1 < 2 > 0": "1 < 2 > 0",
        "no tags": "no tags",
        "": "",
        None: None,
    }
    assert one(X.html_to_text, list(pages)) == list(pages.values())


@pytest.mark.parametrize(
    "text",
    ["&amp;lt;", "&#39;&#x41;&#x1F600;", "&#128;&#0;&#55296;", "&copy; &copy2024 &notit; &foo; & x &", "&NotEqualTilde;", "&#12a", "&#x0041;&#999999999999999999999;&#xffffffffffffffffffff;&#;&#x;"],
)
def test_entities_match_the_standard_library(one, text):
    assert one(X.decode_entities, [text]) == [html.unescape(text)]


def test_paths(one):
    assert one(X.parent_folder, ["a/b/c.csv", "c.csv", "/c"]) == ["a/b", "c.csv", ""]
    assert one(lambda v: X.linked_html_path(F.lit("in/x.csv"), v), ["7", None]) == ["in/posts/7.html", "in/posts/.html"]
    assert one(X.path_in_store, ["https://s.net/a/b", "none"]) == ["a/b", ""]


def test_blanks_and_bad_bytes(one):
    assert one(X.remove_blanks, ["a b\tc\nd"]) == ["ab\tc\nd"]
    assert one(X.utf8_text, [b"a\xff\xc3\xa9b"], "binary") == ["aéb"]


def test_notebook_text(one):
    book = {"cells": [{"source": ["# a\n", "b"]}, {"source": "[1, 2]"}, {"source": []}], "nbformat": 4}
    assert one(X.notebook_text, [json.dumps(book), "not json", None]) == ["# a\nb\n[1, 2]\n", None, None]


def test_token_count_equals_the_tokenizer(spark, one):
    texts = ["", "   ", " a ", "x  ", "a\t\tb\nc", "A b"]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    tokens = Tokenizer(inputCol="t", outputCol="w").transform(frame).orderBy("n").collect()
    assert one(X.token_count, texts) == [len(r.w) for r in tokens] == [1, 0, 2, 1, 4, 2]
    assert one(X.token_count, [None]) == [0]


def test_sentences(one):
    assert one(X.sentences, ["A b. C?  D!\nE.f"]) == [["A b.", "C?", "D!", "E.f"]]


def test_topic_and_question(spark, one):
    frame = spark.createDataFrame([("a", "b"), ("a", None), (None, "b"), (None, None)], "t string, s string")
    assert [r[0] for r in frame.select(X.topic(F.col("t"), F.col("s"))).collect()] == ["a b", "a", "b", ""]
    question = one(X.topic_question, ["my TOPIC"])[0]
    assert '"my TOPIC"' in question and question.endswith("bellow: ")


def test_fill_leaves_marks_inside_values(spark):
    frame = spark.createDataFrame([("see {context}", "ctx")], "i string, c string")
    filled = frame.select(X.fill("<{input}|{context}>", **{"{input}": F.col("i"), "{context}": F.col("c")}))
    assert filled.collect()[0][0] == "<see {context}|ctx>"


def test_chat_record_and_last_message(spark):
    odd = 'q "x"\n\\ é'
    frame = spark.createDataFrame([(odd, "answer")], "q string, t string")
    record = frame.select(X.chat_record(F.col("q"), F.col("t")).alias("m"))
    line = json.loads(record.select(F.to_json(F.struct("m"))).collect()[0][0])
    assert [(m["role"], m["content"]) for m in line["m"]] == [
        ("System", X.SYSTEM_MESSAGE), ("User", odd), ("Chatbot", "answer")]
    assert record.select(X.last_message(F.col("m"))).collect()[0][0] == "answer"


def test_unclosed_markup_is_read_once(one):
    import time

    from textloom.functions import text as X

    pages = ["<!-- x <p>text</p>" * 60_000, "a<script>var x = 1; </p>" * 40_000, "<p>a</p><!-- b", "a<style>b"]
    start = time.time()
    assert one(X.html_to_text, pages) == ["", "a", "a", "a"]
    assert time.time() - start < 10


def test_real_replacement_characters_stay(one):
    from textloom.functions import text as X

    values = ["a\ufffdb".encode(), b"a\xffb\xc3", b"\x00\x01\x00\x00", "\x00\ufffd\x01".encode() + b"\xe2\x82", b"", None]
    assert one(X.utf8_text, values, "binary") == ["a\ufffdb", "ab", "\x00\x01\x00\x00", "\x00\ufffd\x01", "", None]


def test_notebook_outputs(one):
    book = {"cells": [
        {"source": ["a\n", "b"], "outputs": [
            {"output_type": "stream", "text": ["1\n", "2"]}, {"output_type": "stream", "text": "3"},
            {"output_type": "execute_result", "data": {"text/plain": ["x", "y"], "text/html": "<b>"}},
            {"output_type": "display_data", "data": {"image/png": "AA"}}, {"output_type": "display_data", "data": {"text/plain": "<Figure>"}},
            {"output_type": "error", "ename": "E", "evalue": "v", "traceback": ["\x1b[1;31mE\x1b[0m", "line"]},
            {"output_type": "error", "ename": "E", "evalue": "v"}, {}, "odd", None]},
        {"source": "c"}, {"outputs": "none"}, 7]}
    got = one(X.notebook_outputs, [json.dumps(book), "not json", None, "{}"])
    assert got == [[["1\n2", "3", "xy", "<Figure>", "E\nline", "E: v"], [], [], []], None, None, None]
    book["cells"].pop()
    text = one(X.notebook_with_outputs, [json.dumps(book), "not json"])
    assert text[0].startswith("a\nb\n1\n2\n3\nxy\n<Figure>\nE\nline\nE: v\nc\n") and text[1] is None


def test_prompts_word_for_word(one):
    """The texts as they are sent, written out: a changed template would pass every test that uses it."""
    asked = one(X.topic_question, ["graph engines"])[0]
    assert asked == (
        'Write technical blog that demonstrates knowledge and best practice for "graph engines" and its technical '
        "advantage and describes code snippest from the piece of information in the text bellow: "
    )
    messages = one(lambda c: X.chain_prompt(c, F.lit("Passage: p")), ["graphs"])[0]
    assert [m.role for m in messages] == ["system", "user"]
    assert messages[0].content == (
        "You are a technical blog writer. You will write a blog post about a specific technology."
    )
    assert messages[1].content == (
        "Write technical blog that demonstrates knowledge and best practice for graphs and its technical advantage and "
        "describes code snippest from the piece of information in the text bellow: Passage: p "
    )


def test_slices_of_a_model_are_bounded_in_bytes(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from textloom.functions import embed

    monkeypatch.setattr(embed, "SLICE_BYTES", 10)
    files = pa.array([b"1234", b"12345", None, b"1", b"x" * 30, b"", b"12"], pa.binary())
    known = np.flatnonzero(files.is_valid().to_numpy(zero_copy_only=False))
    assert [s.tolist() for s in embed._slices(files, known, 8)] == [[0, 1, 3], [4], [5, 6]]
    assert [s.tolist() for s in embed._slices(files, known, 2)] == [[0, 1], [3], [4], [5, 6]]
    assert [s.tolist() for s in embed._slices(pa.array([[1], [2]]), np.arange(2), 8)] == [[0, 1]]
