from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.functions import embed
from textloom.operators import context, evaluate, meeting, retrieve, scoring
from textloom.plans import jobs


def frames(spark, queries, docs, key="string"):
    q = spark.createDataFrame(queries, f"query_id {key}, vector array<float>")
    d = spark.createDataFrame(docs, f"pk {key}, vector array<float>").repartition(5)
    return q, d


def brute(queries, docs, k, metric):
    found = {}
    for name, q in queries:
        scored = []
        for pk, d in docs:
            a, b = np.float32(q).astype(float), np.float32(d).astype(float)
            if metric == "cosine":
                if not a.any() or not b.any():
                    continue
                score = a @ b / np.linalg.norm(a) / np.linalg.norm(b)
            else:
                score = a @ b if metric == "dot" else 1 / (1 + ((a - b) ** 2).sum())
            scored.append((-round(score, 6), pk))
        found[name] = [(pk, -s) for s, pk in sorted(scored)[:k]]
    return found


def gathered(result):
    found = {}
    for r in result.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.pk, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


@pytest.mark.parametrize("metric", retrieve.METRICS)
@pytest.mark.parametrize("strategy", ["broadcast", "cells", "routed", "lsh"])
def test_exact_with_clusters_copies_and_zero_vectors(spark, metric, strategy):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(4, 8)) * 3
    docs = [(f"d{i:04}", (centres[i % 4] + rng.normal(size=8) * 0.3).tolist()) for i in range(300)]
    docs += [(f"copy{i:04}", [1.0] * 8) for i in range(150)] + [("zero", [0.0] * 8)]
    queries = [(f"q{i}", (centres[i % 4] + rng.normal(size=8)).tolist()) for i in range(12)]
    queries += [("qcopy", [1.0] * 8)]
    q, d = frames(spark, queries, docs)
    if strategy == "lsh" and metric == "dot":
        with pytest.raises(ValueError):
            retrieve.knn_join(q, d, 5, 8, metric, strategy)
        return
    found = gathered(retrieve.knn_join(q, d, 5, 8, metric, strategy, cells=8))
    expected = brute(queries, docs, 5, metric)
    assert found.keys() == expected.keys()
    for name in expected:
        assert [pk for pk, _ in found[name]] == [pk for pk, _ in expected[name]]
        assert np.allclose([s for _, s in found[name]], [s for _, s in expected[name]], atol=2e-6)


@pytest.mark.parametrize("strategy", ["broadcast", "cells", "routed", "lsh"])
def test_small_and_broken_inputs(spark, strategy):
    docs = [("a", [1.0, 0.0]), ("b", [1.0]), ("c", None), ("d", [0.0, 0.0]), ("e", [1.0, None])]
    queries = [("a", [1.0, 0.0]), ("bad", [0.0, 0.0]), ("null", None)]
    q, d = frames(spark, queries, docs)
    assert gathered(retrieve.knn_join(q, d, 3, 2, strategy=strategy)) == {"a": [("a", 1.0)]}
    assert gathered(retrieve.knn_join(q, d, 3, 2, strategy=strategy, skip_same_key=True)) == {}
    assert retrieve.knn_join(q, d.where("pk = 'c'"), 3, 2, strategy=strategy).count() == 0


def test_cells_split_a_crowded_cell(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "BLOCK_ROWS", 16)
    docs = [(i, [1.0, 0.0, i / 1000]) for i in range(200)] + [(1000 + i, [0.0, 1.0, i / 1000]) for i in range(20)]
    queries = [(i, [1.0, 0.1, i / 10]) for i in range(30)]
    q, d = frames(spark, queries, docs, "bigint")
    fast = gathered(retrieve.knn_join(q, d, 4, 3, strategy="cells", cells=4))
    assert fast == gathered(retrieve.knn_join(q, d, 4, 3, strategy="broadcast"))


@pytest.mark.parametrize("strategy", ["auto", "routed", "lsh"])
def test_many_chunks_of_queries_and_repeated_ids(spark, monkeypatch, strategy):
    monkeypatch.setattr(retrieve, "BROADCAST_BYTES", 8 * 6 * 40)
    monkeypatch.setattr(meeting, "PART_ROWS", 7)
    monkeypatch.setattr(meeting, "CHUNK_ROWS", 9)
    rng = np.random.default_rng(3)
    hashed = np.round(rng.normal(size=(260, 6)) * (rng.random((260, 6)) < 0.3), 1)  # many equal scores
    docs = [(f"d{i:03}", v.tolist()) for i, v in enumerate(hashed)]
    queries = [(f"q{i:03}", v.tolist()) for i, v in enumerate(hashed[:150])]
    q, d = frames(spark, queries + queries[:20], docs)
    found = gathered(retrieve.knn_join(q, d, 5, 6, strategy=strategy))
    want = {name: rows for name, rows in brute(queries, docs, 5, "cosine").items() if dict(queries)[name] != [0.0] * 6}
    assert {n: [pk for pk, _ in r] for n, r in found.items()} == {n: [pk for pk, _ in r] for n, r in want.items()}


@pytest.mark.parametrize("records", [1, 3, 1000])
@pytest.mark.parametrize("metric", retrieve.METRICS)
def test_batch_sizes_change_nothing(spark, records, metric):
    rng = np.random.default_rng(5)
    hashed = rng.integers(-1, 2, (120, 16)) * (rng.random((120, 16)) < 0.4)
    rows = [(f"k{i:03}", v.astype(float).tolist()) for i, v in enumerate(hashed)]
    q, d = frames(spark, rows[:40], rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    try:
        found = [gathered(retrieve.knn_join(q, d, 4, 16, metric, s)) for s in ("broadcast", "cells")]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute(rows[:40], rows, 4, metric)
    assert found[0] == found[1]
    for name, results in found[0].items():
        assert [pk for pk, _ in results] == [pk for pk, _ in want[name]]


def clustered(seed, number, dim, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, dim))
    return (centres[rng.integers(0, 40, number)] + spread * rng.normal(size=(number, dim))).tolist()


def test_plan_does_not_grow_with_the_queries(spark, monkeypatch):
    monkeypatch.setattr(meeting, "CHUNK_ROWS", 5)
    monkeypatch.setattr(retrieve, "BROADCAST_BYTES", 0)
    plans = []
    for number in (10, 400):
        rows = list(enumerate(clustered(4, number, 6, 0.2)))
        q, d = frames(spark, rows, list(enumerate(clustered(5, 200, 6, 0.2))), "bigint")
        collected = []
        real = type(q).toArrow
        monkeypatch.setattr(type(q), "toArrow", lambda self: collected.append(real(self)) or collected[-1])
        found = retrieve.knn_join(q, d, 3, 6)
        plans.append(found._jdf.queryExecution().optimizedPlan().toString().count("\n"))
        # only the sampled pivots pass through the driver
        assert sum(t.num_rows for t in collected) <= 16
        monkeypatch.undo()
        monkeypatch.setattr(retrieve, "BROADCAST_BYTES", 0)
        assert gathered(found) == gathered(retrieve.knn_join(q, d, 3, 6, strategy="routed", cells=3))
    assert plans[0] == plans[1]


def test_routes_leave_out_far_cells(spark):
    rows = list(enumerate(clustered(6, 2000, 8, 0.02)))
    q, d = frames(spark, rows[:300], rows, "bigint")
    placed, cells = meeting.in_cells(d, 8, "cosine", 40)
    unit = np.array([v for _, v in rows[:300]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    assert (cells.reach(unit, "cosine") >= 0.99).sum() < 0.2 * 300 * 40
    assert placed.count() == 2000
    assert gathered(retrieve.knn_join(q, d, 7, 8, strategy="routed")) == gathered(retrieve.knn_join(q, d, 7, 8, strategy="broadcast"))


def test_lsh_recall_without_fallback_and_proofs(spark):
    rows = list(enumerate(clustered(8, 4000, 32, 0.15)))
    q, d = frames(spark, rows[:200], rows, "bigint")
    exact = gathered(retrieve.knn_join(q, d, 7, 32, strategy="broadcast"))
    rough = gathered(retrieve.knn_join(q, d, 7, 32, strategy="lsh", fallback=False))
    hits = sum(len({pk for pk, _ in exact[i]} & {pk for pk, _ in rough.get(i, [])}) for i in exact)
    assert hits / sum(map(len, exact.values())) >= 0.95
    # copies in great number: what no bucket held cannot reach the score of a copy
    copies = [(10_000 + i, rows[0][1]) for i in range(20)] + rows
    q, d = frames(spark, rows[:50], copies, "bigint")
    found, proven = meeting.lsh(q, d, 7, 32)
    proven = {r.query_id for r in proven.collect() if r.proven}
    assert 0 in proven
    best = {}
    for r in found.collect():
        best.setdefault(r.query_id, set()).add((r.pk, r.score))
    exact = gathered(retrieve.knn_join(q, d, 7, 32, strategy="broadcast"))
    assert all(best[i] == set(exact[i]) for i in proven)


def as_sparse(df):
    """The vectors of `df` as sparse ones, from their entries that are not 0."""
    entries = F.transform("vector", lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    kept = F.filter(entries, lambda e: e.x != 0)
    vector = F.struct(F.size("vector").alias("size"), kept["i"].alias("buckets"), kept["x"].alias("weights"))
    return df.withColumn("vector", F.when(F.col("vector").isNotNull(), vector))


@pytest.mark.parametrize("strategy, metric", [("broadcast", "cosine"), ("cells", "l2"), ("routed", "dot"), ("lsh", "cosine")])
def test_sparse_vectors_find_what_dense_ones_do(spark, strategy, metric):
    rng = np.random.default_rng(11)
    rows = rng.integers(-2, 3, (300, 24)) * (rng.random((300, 24)) < 0.25)
    docs = [(f"d{i:03}", [float(x) for x in row]) for i, row in enumerate(rows)]
    q, d = frames(spark, [(f"q{i:02}", v) for i, (_, v) in enumerate(docs[:40])], docs)
    options = {"k": 5, "dim": 24, "metric": metric, "strategy": strategy}
    wanted = gathered(retrieve.knn_join(q, d, **options))
    assert wanted
    assert gathered(retrieve.knn_join(as_sparse(q), as_sparse(d), **options)) == wanted
    if strategy == "broadcast":  # the sides may differ
        assert gathered(retrieve.knn_join(q, as_sparse(d), **options)) == wanted


@pytest.mark.parametrize("strategy", ["broadcast", "cells", "routed", "lsh"])
def test_broken_sparse_vectors_take_no_part(spark, strategy):
    kind = "struct<size: int, buckets: array<int>, weights: array<float>>"
    good = (4, [1, 3], [0.6, 0.8])
    docs = [
        ("good", good), ("twice", (4, [1, 1, 3], [0.2, 0.4, 0.8])), ("null", None), ("longer", (5, [1], [1.0])),
        ("beyond", (4, [4], [1.0])), ("below", (4, [-1], [1.0])), ("no bucket", (4, [1, None], [1.0, 1.0])),
        ("no weight", (4, [1, 3], [1.0, None])), ("uneven", (4, [1, 3], [1.0])), ("empty", (4, [], [])),
        ("no arrays", (4, None, None)),
    ]
    q = spark.createDataFrame([("q", good), ("none", None)], f"query_id string, vector {kind}")
    d = spark.createDataFrame(docs, f"pk string, vector {kind}").repartition(3)
    found = gathered(retrieve.knn_join(q, d, 7, 4, strategy=strategy))
    assert found == {"q": [("good", 1.0), ("twice", 1.0)]}
    nothing = retrieve.knn_join(q.where("false"), d.where("false"), 7, 4, strategy=strategy)
    assert nothing.count() == 0


def test_sparse_embedder_gives_the_same_vectors(spark):
    texts = ["One two two", "", None, " \t", "a b c d e f g h " * 50, "é É ä", "x" * 2000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(2)
    dense = {r.id: r.v for r in embed.embed_text(df, "text", "v", dim=16).collect()}
    sparse = {r.id: r.v for r in embed.embed_sparse(df, "text", "v", 16).collect()}
    for i, vector in dense.items():
        if vector is None:
            assert sparse[i] is None
            continue
        assert sparse[i].size == 16 and sparse[i].buckets == sorted(set(sparse[i].buckets))
        filled = [0.0] * 16
        for bucket, weight in zip(sparse[i].buckets, sparse[i].weights):
            assert weight != 0
            filled[bucket] = weight
        assert filled == vector
    # words that cancel out leave no entry
    one = embed.sparse_hashing_embedder(1)(["a b c d e f g h", "a"]).to_pylist()
    two = embed.hashing_embedder(1)(["a b c d e f g h", "a"])
    assert [dict(zip(v["buckets"], v["weights"])).get(0, 0.0) for v in one] == two[:, 0].tolist()


def test_bounds_hold():
    rng = np.random.default_rng(2)
    q, d = rng.normal(size=(50, 5)), rng.normal(size=(60, 5))
    for metric in retrieve.METRICS:
        _, a = scoring.usable_rows(q, metric)
        _, b = scoring.usable_rows(d, metric)
        most = scoring.ceilings((a * a).sum(axis=1)[:, None], scoring.distances(a, b), (b * b).sum(axis=1)[None, :], metric)
        assert (most >= scoring.rough_scores(a, b, metric)).all()


def results(spark, rows):
    return spark.createDataFrame(rows, "query_id int, source string, rank int, pk string, text string, score double")


def test_two_source_context(spark):
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id int")
    found = results(spark, [
        (1, "repo", 2, "b", "B", 0.6), (1, "repo", 1, "a", "A", 0.9), (1, "pdf", 1, "c", "C", 0.5),
        (2, "pdf", 1, "d", "D", 0.51)])
    got = {r.query_id: r.context for r in context.two_source_context(queries, found, "repo", "pdf", 0.5).collect()}
    assert got == {1: "A B #", 2: " #D", 3: " #"}


def test_fusion(spark):
    found = results(spark, [
        (1, "repo", 1, "a", "A", 0.9), (1, "repo", 2, "b", "B", 0.8), (1, "pdf", 1, "c", "C", 0.9),
        (1, "pdf", 2, "b", "B", 0.1), (2, "pdf", 1, "z", "Z", 0.1)])
    ranked = {(r.query_id, r["rank"]): (r.text, r.score) for r in context.fuse(found, {"repo": 0.5, "pdf": 0.5}).collect()}
    assert [ranked[(1, i)][0] for i in (1, 2, 3)] == ["B", "A", "C"]
    assert ranked[(1, 1)][1] == pytest.approx(1 / 62) and ranked[(2, 1)] == ("Z", pytest.approx(0.5 / 61))
    heavy = context.fuse(found, {"pdf": 0.9, "repo": 0.1}).where("query_id = 1 and rank = 1").first()
    assert heavy.text == "B"
    turned = context.fuse(found.orderBy(F.desc("text")), {"repo": 0.5, "pdf": 0.5})
    assert {(r.query_id, r["rank"]): (r.text, r.score) for r in turned.collect()} == ranked


def test_passages(spark):
    queries = spark.createDataFrame([(1,), (2,)], "query_id int")
    ranked = spark.createDataFrame([(1, 2, "B"), (1, 1, "A")], "query_id int, rank int, text string")
    got = {r.query_id: r.context for r in context.passages(queries, ranked).collect()}
    assert got == {1: "Passage: A\nPassage: B\n", 2: ""}


def test_measures(spark):
    ranked = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "x"), (3, 1, "x")], "query_id int, rank int, pk string")
    relevant = spark.createDataFrame([(1, "y"), (1, "w"), (2, "x"), (4, "x")], "query_id int, pk string")
    got = {r.query_id: r for r in evaluate.query_measures(*evaluate.judge(ranked, relevant), 3).collect()}
    assert set(got) == {1, 2, 4}  # 3 has no relevant document
    assert got[1].precision == pytest.approx(1 / 3) and got[1].recall == 0.5 and got[1].reciprocal_rank == 0.5
    assert got[1].ndcg == pytest.approx((1 / np.log2(3)) / (1 + 1 / np.log2(3)))
    assert got[2].ndcg == 1.0 and got[4].recall == 0.0
    mean = evaluate.mean_measures(evaluate.query_measures(*evaluate.judge(ranked, relevant), 3)).first()
    assert mean.queries == 3 and mean.recall == 0.5


def test_vector_check(spark):
    rows = [("a", [1.0, 0.0]), ("a", [0.0, 0.0]), (None, None), ("b", [1.0]), ("c", [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "k string, v array<float>")
    assert evaluate.check_vectors(frame, "k", "v", 2).first().asDict() == {
        "rows": 5, "null_keys": 1, "repeated_keys": 1, "null_vectors": 1, "wrong_length": 1, "zero_vectors": 1}


def test_profile(spark):
    frame = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "s string, n int")
    for exact in (False, True):
        got = {r.column_name: (r.row_count, r.null_count, r.distinct_count) for r in evaluate.profile(frame, exact).collect()}
        assert got == {"s": (3, 1, 1), "n": (3, 1, 2)}


def test_profile_from_merged_sketches(spark):
    frame = spark.range(20_000).select(
        F.when(F.col("id") % 4 != 0, F.col("id")).alias("n"), (F.col("id") % 300).cast("string").alias("s"), F.lit(None).cast("int").alias("none"))
    batches = [frame.where("n < 500"), frame.where("n >= 500 or n is null"), frame.limit(0)]
    rows = [evaluate.sketch_batch(b) for b in batches]
    got = {r.column_name: r for r in evaluate.merged_profile(rows[0].unionByName(rows[1]).unionByName(rows[2])).collect()}
    assert got["n"].row_count == 20_000 and got["n"].null_count == 5000 and (got["n"].least, got["n"].most) == (1, 19_999)
    assert abs(got["n"].distinct_count - 15_000) < 750 and abs(got["s"].distinct_count - 300) < 15
    assert all(abs(q - s * 20_000) < 400 for q, s in zip(got["n"].quantiles, (0.25, 0.5, 0.75)))
    assert got["none"].null_count == 20_000 and got["none"].quantiles is None and got["s"].quantiles is None


def test_queries_travel_to_blocks_of_cells_once(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(meeting, "PART_ROWS", 64)
    monkeypatch.setattr(meeting, "GROUP_BYTES", 8 * 32 * 150)
    monkeypatch.setattr(meeting, "CHUNK_ROWS", 1)
    written = {}
    real = meeting.materialise

    def kept(df, name):
        out = real(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(meeting, "materialise", kept)
    rng = np.random.default_rng(21)
    rows = [(f"k{i:04}", v) for i, v in enumerate(rng.normal(size=(600, 32)).tolist())]  # no clusters, no bound holds
    q, d = frames(spark, rows[:300], rows)
    for strategy in ("routed", "lsh"):
        found = gathered(retrieve.knn_join(q, d, 4, 32, strategy=strategy))
        want = brute(rows[:300], rows, 4, "cosine")
        assert {n: [pk for pk, _ in r] for n, r in found.items()} == {n: [pk for pk, _ in r] for n, r in want.items()}
    # 600 documents lie in at most 12 blocks, in each of the tables of random projections too
    assert written["visits"] <= 2 * 300 * 12
    assert written["lsh-visits"] <= meeting.TABLES * 300 * 8


def test_many_short_sparse_queries_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "BROADCAST_BYTES", 40 * (16 + 8 * 3))
    monkeypatch.setattr(retrieve, "QUERY_ROWS", 7)
    monkeypatch.setattr(meeting, "routed", None)
    rng = np.random.default_rng(22)
    rows = np.zeros((40, 1024))
    for row in rows:
        row[rng.choice(1024, 3, replace=False)] = rng.integers(1, 9, 3)
    docs = [(f"d{i:02}", row.tolist()) for i, row in enumerate(rows)]
    q, d = frames(spark, docs, docs)
    found = gathered(retrieve.knn_join(as_sparse(q), as_sparse(d), 2, 1024))
    assert {n: r[0] for n, r in found.items()} == {n: (n, 1.0) for n, _ in docs}


def test_copies_of_a_document_take_one_place_in_a_bucket(spark):
    rows = [(i, v) for i, v in enumerate(clustered(31, 200, 8, 0.2))]
    q, d = frames(spark, rows[:20], rows + rows[:150], "bigint")
    found = gathered(retrieve.knn_join(q, d, 7, 8, strategy="lsh", fallback=False))
    once = gathered(retrieve.knn_join(q, frames(spark, [], rows, "bigint")[1], 7, 8, strategy="lsh", fallback=False))
    assert found == once and all(len(r) == 7 for r in once.values())


def sparse_vectors(rng, number, dim, most):
    """Sparse vectors with a common part, buckets out of order and twice, zero vectors, and weights that are no number."""
    common = rng.choice(dim, 6, replace=False)
    out = []
    for i in range(number):
        own = rng.integers(0, dim, rng.integers(0, most))
        buckets = [] if i % 29 == 3 else [*own, *common[: rng.integers(3, 7)], *own[:1]]
        weights = rng.integers(-2, 4, len(buckets)).astype(float)
        if i % 31 == 5 and buckets:
            weights[0] = np.nan
        out.append({"size": dim, "buckets": [int(b) for b in buckets], "weights": weights.tolist()})
    return out


def filled(vectors, dim):
    rows = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        np.add.at(rows[i], v["buckets"], np.float32(v["weights"]).astype(float))
    return rows.tolist()


def sparse_array(vectors):
    kind = pa.struct([("size", pa.int32()), ("buckets", pa.list_(pa.int32())), ("weights", pa.list_(pa.float32()))])
    return pa.array(vectors, kind)


def usable(rows):
    return [(i, row) for i, row in rows if np.isfinite(row).all()]


@pytest.mark.parametrize("near", [False, True])
@pytest.mark.parametrize("strides, k", [(4, 3), (4, 6), (128, 3)])
def test_sparse_search_is_exact_in_any_slabs_and_groups(monkeypatch, near, strides, k):
    monkeypatch.setattr(scoring, "STRIDES", strides)
    monkeypatch.setattr(scoring, "GROUP_ROWS", 8)
    monkeypatch.setattr(scoring, "RARE_ROWS", 2)
    monkeypatch.setattr(scoring, "COMMON_SHARE", 0.3)
    monkeypatch.setattr(scoring, "_ENTRIES", 50)
    rng, dim = np.random.default_rng(11), 40
    queries, docs = sparse_vectors(rng, 70, dim, 8), sparse_vectors(rng, 260, dim, 14)
    docs += docs[:90]  # equal scores, in other slabs
    keys = rng.permutation(len(docs))
    expected = brute(usable(enumerate(filled(queries, dim))), usable(zip(keys.tolist(), filled(docs, dim))), k, "cosine")
    finder = scoring.SparseSearch(sparse_array(queries), dim, k, 20)
    for at in range(0, len(docs), 33):
        some = scoring.Entries(sparse_array(docs[at : at + 33]), dim)
        finder.add(some, keys[at + some.keep], near)
    found = {}
    for query, key, score in zip(*finder.found()):
        found.setdefault(int(query), []).append((-score, int(key)))
    assert {q: [(key, -s) for s, key in sorted(rows)] for q, rows in found.items()} == {q: rows for q, rows in expected.items() if rows}


@pytest.mark.parametrize("strategy", ["broadcast", "routed"])
def test_sparse_strategies_agree_with_brute_force(spark, strategy):
    rng, dim = np.random.default_rng(12), 64
    queries, docs = sparse_vectors(rng, 40, dim, 8), sparse_vectors(rng, 200, dim, 14)
    docs += docs[:70]
    kind = "vector struct<size:int,buckets:array<int>,weights:array<float>>"
    q = spark.createDataFrame([(f"q{i}", tuple(v.values())) for i, v in enumerate(queries)], f"query_id string, {kind}")
    d = spark.createDataFrame([(f"d{i}", tuple(v.values())) for i, v in enumerate(docs)], f"pk string, {kind}")
    found = gathered(retrieve.knn_join(q, d.repartition(3), 5, dim, strategy=strategy))
    named = lambda rows, letter: usable((f"{letter}{i}", row) for i, row in enumerate(rows))
    expected = brute(named(filled(queries, dim), "q"), named(filled(docs, dim), "d"), 5, "cosine")
    assert found == {name: rows for name, rows in expected.items() if rows}


def test_sparse_vectors_are_not_filled_up_to_be_scored(monkeypatch):
    """The work goes with the entries of a query: no matrix of all queries or documents by all buckets is made."""
    rng, dim = np.random.default_rng(13), 1024
    asked, held = sparse_array(sparse_vectors(rng, 30, dim, 8)), sparse_array(sparse_vectors(rng, 90, dim, 14))
    asked = pa.table({"query_id": range(30), "vector": asked, "floor": pa.nulls(30, pa.float64())})
    held = pa.table({"pk": range(90), "vector": held, "home": pa.array([0] * 90)})
    wanted = meeting.matrix_search(3, dim, "cosine")(asked, held).num_rows

    def fill(*_):
        raise AssertionError("filled up")

    for module in (scoring, meeting):
        monkeypatch.setattr(module, "matrix_of", fill)
    assert meeting.matrix_search(3, dim, "cosine")(asked, held).num_rows == wanted > 60


def test_slabs_of_wide_sparse_vectors_stay_small():
    assert scoring.slab_rows(1024) == scoring.SLAB_ROWS
    assert scoring.slab_rows(1 << 17) * (4 << 17) <= 2 * scoring.WIDE_BYTES


def test_documents_without_a_key_are_not_found(spark):
    kind = "vector struct<size:int,buckets:array<int>,weights:array<float>>"
    q = spark.createDataFrame([("q", (8, [1, 2], [1.0, 1.0]))], f"query_id string, {kind}")
    docs = [(None, "no key", (8, [1, 2], [1.0, 1.0])), ("a", "one", (8, [1], [1.0])), ("b", "other", (8, [5], [1.0])), (None, "nor this", (8, [5], [1.0]))]
    d = spark.createDataFrame(docs, f"pk string, text string, {kind}")
    found = jobs.search_sources(q, {"s": d}, 2, 8).orderBy("rank").collect()
    assert [(r["rank"], r.pk, r.text, r.score) for r in found] == [(1, "a", "one", 0.707107), (2, "b", "other", 0.0)]
