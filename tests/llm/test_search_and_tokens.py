from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from textloom.llm import token_counts, topk, unigram
from textloom.operators import meeting


def brute_top(rows, k, divisor, scale=1024):
    good = []
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        good.append((i, tuple(int(np.floor(float(np.float32(x)) * scale)) for x in v)))
    good = sorted(good)
    queries = {}
    for i, v in good:
        if i % divisor == 0:
            queries.setdefault(i, v)
    out = []
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def as_rows(frame):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in frame.collect())


@pytest.mark.parametrize("seed", range(4))
def test_top_k_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(meeting, "PART_ROWS", 20)
    monkeypatch.setattr(meeting, "CHUNK_ROWS", 7)
    draw = random.Random(seed)
    centers = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + draw.gauss(0, 0.2) for c in draw.choice(centers)]) for i in range(260)]
    hot = [0.5] * 6
    rows += [(i, hot) for i in range(1000, 1120)]  # ties at every place
    rows += [(9000, None), (9001, []), (9002, [1.0, None]), (9003, [float("nan")] * 6), (9004, [float("inf")] * 6)]
    rows += [rows[3], rows[3], (None, hot), (9005, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = topk.top_k(frame, F.col("vec_id") % 20 == 0, k=7)
    assert as_rows(got) == brute_top(rows, 7, 20)


@pytest.mark.parametrize("size", [2**10, 2**17, 2**30])
def test_large_scores_are_exact(spark, size):
    draw = random.Random(size)
    rows = [(i, [draw.uniform(-size, size), draw.uniform(-size, size)]) for i in range(60)]
    rows += [(i, [float(size), float(size - 1 - i % 3)]) for i in range(60, 100)]
    frame = spark.createDataFrame([(i, v, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, pk string, floor int")
    got = topk.top_k(frame, F.col("vec_id") % 10 == 0, k=5, scale=1)
    assert as_rows(got) == brute_top(rows, 5, 10, scale=1)


def test_scores_beyond_64_bits_are_refused(spark):
    frame = spark.createDataFrame([(0, [3e9, 3e9]), (1, [3e9, 3e9])], "vec_id long, embedding array<float>")
    with pytest.raises(OverflowError):
        topk.top_k(frame, F.col("vec_id") == 0)


def test_fewer_than_k_and_empty(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    got = topk.top_k(frame, F.col("vec_id") == 0, k=10).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]
    assert topk.top_k(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert topk.top_k(frame, F.col("vec_id") == 77).count() == 0


def test_cover_tree_covers_and_prunes():
    draw = np.random.default_rng(2)
    rows = np.floor(np.concatenate([draw.normal(c, 1, (400, 8)) for c in (-40, 0, 40)]) * 16)
    tree = topk.CoverTree(rows, 16)
    assert sorted(tree.order.tolist()) == list(range(len(rows)))
    for center, radius, (a, b), children in zip(tree.center, tree.radius, tree.span, tree.children):
        part = rows[tree.order[a:b]]
        assert np.sqrt(((part - center) ** 2).sum(axis=1)).max() <= radius
        assert not children or sum(tree.span[c][1] - tree.span[c][0] for c in children) == b - a
    queries = topk.Queries(np.arange(30), rows[-30:], np.full(30, -np.inf))
    best = topk.Best(queries, 5)
    assert topk.search(queries, np.arange(1000, 2200), rows, best) < 30 * 1200 * 0.7


@pytest.fixture(scope="module")
def pieces():
    return unigram.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


def small_pieces():
    names = ["▁", "a", "b", "ab", "▁a", "▁ab", "abb", "é", "▁▁"]
    scores = [-3.0, -2.0, -2.5, -3.5, -4.0, -6.5, -5.0, -1.0, -3.0]
    every = dict(enumerate(names, 300))
    return unigram.Pieces.build(every, dict(zip(every, scores)), np.arange(256) + 10, 400), dict(zip(names, scores))


def brute_best(text, scores, unknown):
    """Best score of a text by trying every cut."""
    best = [0.0] + [-np.inf] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in scores:
                best[j] = max(best[j], best[i] + scores[text[i:j]])
        if text[i] not in scores:
            best[i + 1] = max(best[i + 1], best[i] + unknown)
    return best[-1]


def test_viterbi_equals_brute_force():
    pieces, scores = small_pieces()
    encoder = unigram.Encoder(pieces)
    by_id = {i: t for i, t in enumerate(pieces.texts)}
    draw = random.Random(1)
    texts = ["".join(draw.choice("aabb é世 \n") for _ in range(draw.randrange(1, 14))) for _ in range(400)]
    for text, raw in zip(texts, encoder(texts)):
        ids = np.frombuffer(raw, "<u4").tolist()
        total, waiting = 0.0, b""
        for i in ids:
            if i < 266:  # bytes of a character without a piece
                waiting += by_id[i]
                try:
                    waiting.decode()
                except UnicodeDecodeError:
                    continue
                total, waiting = total + pieces.unknown, b""
            else:
                total += scores[by_id[i].decode().replace(" ", "▁")]
        assert total == pytest.approx(brute_best("▁" + text.replace(" ", "▁"), scores, pieces.unknown))
        assert unigram.decode_ids(ids, pieces.texts) == text


def test_double_array_holds_just_its_words():
    draw = random.Random(3)
    words = sorted({bytes(draw.randrange(256) for _ in range(draw.randint(1, 5))) for _ in range(3000)})
    trie = unigram.DoubleArray(words)
    assert [trie.find(w) for w in words] == list(range(len(words)))
    for _ in range(2000):
        other = bytes(draw.randrange(256) for _ in range(draw.randint(1, 6)))
        assert trie.find(other) == (words.index(other) if other in set(words) else -1)


def test_best_path_equals_the_library(pieces):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    words = "the quick brown foxes jumped overwhelmingly internationalisation Straßenbahn niño theathst lareonment x".split()
    for word, raw in zip(words, unigram.Encoder(pieces)(words)):
        ids = np.frombuffer(raw, "<u4").tolist()
        best = library.nbest_encode_as_ids(word, 5)[0]
        assert sum(map(library.get_score, ids)) == sum(map(library.get_score, best))


def test_round_trip(pieces):
    encoder = unigram.Encoder(pieces)
    draw = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "▁", "\x00", "\x01", "漢", "é", "😀", "the", "ing", "\t"]
    for _ in range(800):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(12)))
        assert unigram.decode_ids(np.frombuffer(encoder([text])[0], "<u4").tolist(), pieces.texts) == text


def test_unigram_over_odd_rows(spark, odd, docs, pieces):
    back = unigram.decode(unigram.encode(odd, pieces, ["doc_id", "text"]), pieces, ["doc_id", "text"])
    rows = back.collect()
    assert len(rows) == odd.count()
    assert all(r.decoded == (r.text or "") and (r.n_tokens > 0) == bool(r.text) for r in rows)
    assert unigram.encode(docs([]), pieces, ["doc_id"]).count() == 0


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def test_rollup_is_idempotent(spark, tmp_path):
    rollup = token_counts.Rollup(spark, str(tmp_path / "rollup"))

    def change(*rows):
        return spark.createDataFrame(list(rows), token_counts.CHANGES)

    assert totals(rollup) == {}
    first = change(("insert", 1, "a", "en", "t1", 5), ("insert", 2, "a", "en", "t1", 7), ("insert", None, None, "en", "t1", 1))
    assert rollup.apply(1, first) and not rollup.apply(1, first)
    assert totals(rollup) == {("a", "en", "t1"): (2, 12), (None, "en", "t1"): (1, 1)}
    second = change(("revise", 1, "b", "en", "t2", 6), ("delete", None, None, None, None, None), ("delete", 99, None, None, None, None))
    # an attempt that died after the ledger leaves no trace
    second.limit(1).select("doc_id", *token_counts.GROUP, F.lit(1).cast("long").alias("sign"), "n_tokens").write.parquet(
        rollup._path("ledger", 2)
    )
    assert totals(rollup)[None, "en", "t1"] == (1, 1)
    assert rollup.apply(2, second)
    assert totals(rollup) == {("a", "en", "t1"): (1, 7), ("b", "en", "t2"): (1, 6)}
    assert not rollup.apply(1, second)
    assert rollup.apply(3, change()) and totals(rollup) == {("a", "en", "t1"): (1, 7), ("b", "en", "t2"): (1, 6)}
    twice = change(("insert", 5, "c", "de", "t1", 2), ("insert", 5, "c", "de", "t1", 2))
    rollup.apply(4, twice)
    assert totals(rollup)["c", "de", "t1"] == (2, 4)
    rollup.apply(5, change(("delete", 5, None, None, None, None), ("delete", 5, None, None, None, None)))
    assert ("c", "de", "t1") not in totals(rollup)
    with pytest.raises(ValueError):
        token_counts.Rollup(spark, rollup.root).apply(0, first)


def test_compacted_ledger_gives_the_same(spark, tmp_path, monkeypatch):
    draw = random.Random(7)
    rows = "op string, doc_id long, source string, lang string, tokenizer string, n_tokens long"
    batches = []
    for _ in range(7):
        ops = [(draw.choice(["insert", "insert", "delete", "revise"]), draw.randrange(12)) for _ in range(15)]
        seen = {}
        for op, i in ops:
            seen.setdefault(i, (op, i, draw.choice("ab"), draw.choice(["en", None]), "t", draw.randrange(50)))
        batches.append(spark.createDataFrame(list(seen.values()), rows))
    found = []
    for every in (2, 100):
        monkeypatch.setattr(token_counts, "COMPACT", every)
        rollup = token_counts.Rollup(spark, str(tmp_path / str(every)))
        for number, batch in enumerate(batches):
            rollup.apply(number, batch)
        found.append((sorted(map(str, rollup.totals().collect())), sorted(map(str, rollup.live().collect()))))
    assert found[0] == found[1] and found[0][0]
    assert (tmp_path / "2" / "compact" / "batch=5").exists() and not (tmp_path / "100" / "compact").exists()


def test_query_equals_a_recount(spark):
    """op9 inserts all, recounts with a second vocabulary and takes later copies away."""
    import base64
    import collections

    import tiktoken

    from textloom.llm import queries

    folder = "/root/testdata/sf0.001"
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    codec = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want, seen = collections.defaultdict(lambda: [0, 0]), set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect():
        if r.text is None or r.text not in seen:
            seen.add(r.text)
            group = want[r.source, r.lang, "byte_bpe_v2"]
            group[0] += 1
            group[1] += len(codec.encode_ordinary(r.text or ""))
    got = queries.op9_token_counts(spark, folder).collect()
    assert {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in got} == dict(want)


def test_token_numbers(spark, odd):
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    codec = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    short = odd.where(F.length("text") < 10_000)
    rows = token_counts.count_tokens(short, {"n": path}, public_tokenizers.PATTERN, ["doc_id", "text"]).collect()
    assert rows and all(r.n == len(codec.encode_ordinary(r.text)) for r in rows)
