from __future__ import annotations

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import licenses, oracle, spelling, whitening

# -- spelling variants ---------------------------------------------------------


def one_edit(a, b):
    """True when a and b differ by exactly one inserted, deleted or replaced letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abÀ", min_size=2, max_size=7), min_size=1, max_size=40), st.booleans())
def test_index_finds_what_keeps_a_half(words, left):
    words = sorted(words)
    index = spelling.BidirectionalIndex(words)
    asked, hit = index.one_edit(words, np.full(len(words), left))
    got = set(zip(asked.tolist(), hit.tolist()))
    want = set()
    for i, a in enumerate(words):
        half = len(a) // 2
        for j, b in enumerate(words):
            kept = b.endswith(a[half:]) if left else b.startswith(a[:half])
            if one_edit(a, b) and kept:
                want.add((i, j))
    # matches that keep the half are all found; others are true neighbours all the same
    assert want <= got
    assert all(one_edit(words[i], words[j]) for i, j in got)


def brute_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in spelling._RUN.findall((text or "").translate(spelling._LOWER)):
            import zlib

            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w) + 1):
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
            holes[w[:i] + "\0" + w[i:]].add(w)
    out = {}
    for w, n in words.items():
        keys = [w[:i] + "\0" + w[i + 1 :] for i in range(len(w))] + [w[:i] + "\0" + w[i:] for i in range(len(w) + 1)]
        near = {v for k in keys for v in holes[k] if one_edit(w, v)}
        best = min(near, key=lambda v: (-words[v], v), default=None)
        formed = best is not None and words[best] >= 5 * n
        out[w] = (best if formed else None, n, len(near), words[best] if formed else None)

    def root(w):
        while out[w][0] is not None:
            w = out[w][0]
        return w

    return sorted((w, f, root(w), n, m, k) for w, (f, n, m, k) in out.items())


def as_rows(frame):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def test_variants_equal_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(spelling, "PART", 3)
    monkeypatch.setattr(spelling, "SHARD", 50)
    draw = random.Random(3)
    stems = ["colour", "harbour", "neighbour", "Straßenbahn", "élève", "organise", "aaaaaa", "aaaaaaa", "abaaaa"]
    rows = []
    for i in range(120):
        words = []
        for _ in range(60):
            w = draw.choice(stems)
            if draw.random() < 0.3:
                at = draw.randrange(len(w))
                w = w[:at] + draw.choice(["", "x", "é" + w[at]]) + w[at + 1 :]
            words.append(w.upper() if draw.random() < 0.1 else w)
        rows.append((i if i % 9 else None, " ".join(words)))
    rows += [(500, None), (501, ""), (3, rows[3][1]), (3, rows[3][1])]
    rows += [(600 + i, "bcdefgh " * 40 + "bcdefgi " * 7 + "bcdefji ") for i in range(6)]
    want = brute_variants(rows)
    assert any(r[1] for r in want) and any(r[2] != r[1] and r[1] for r in want)
    assert as_rows(spelling.variants(docs(rows))) == want


def test_variants_of_the_test_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute_variants([(r.doc_id, r.text) for r in frame.collect()])
    assert as_rows(spelling.variants(frame)) == want


def test_variants_of_odd_rows(docs, odd):
    assert as_rows(spelling.variants(docs([]))) == []
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    rows += [(50 + i, "y" * 3000 + " " + "y" * 2999) for i in range(6)]
    assert as_rows(spelling.variants(docs(rows))) == brute_variants(rows)


def test_chains_have_one_root(spark):
    chain = [(f"w{i}", f"w{i + 1}" if i < 11 else None) for i in range(12)]
    got = spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.word: r.root for r in got} == {f"w{i}": "w11" for i in range(11)}


# -- license scans -------------------------------------------------------------


def by_sql(rows):
    with duckdb.connect() as db:
        db.execute("create table documents(doc_id bigint, text varchar)")
        db.executemany("insert into documents values (?, ?)", rows)
        found = db.execute(oracle.LICENSES).fetchall()
    return sorted(found, key=repr)


def notices():
    draw = random.Random(5)
    filler = [f"word{i}" for i in range(80)] + ["the", "license", "software", "this", "of", "any"]
    rows = []
    for number, (_, text) in enumerate(licenses.TEMPLATES):
        words = text.split()
        for share in (0.0, 0.15, 0.2, 0.25, 0.5):
            kept = [w for w in words if draw.random() >= share]
            text = " ".join(draw.choices(filler, k=draw.randrange(90)) + kept + draw.choices(filler, k=draw.randrange(200)))
            rows.append((number, text.upper() if share == 0.15 else text))
    rows += [(900, "MIT license mit license mit-license, Apache\nLicense cc.by"), (901, "gnu general public"), (902, None), (903, "")]
    rows += [(904, "mit"), (None, "released under the MIT License."), (900, "cc by"), (900, "cc by")]
    return rows + [(905, " ".join(filler * 400) + " " + licenses.TEMPLATES[0][1] + " end")]


NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


@pytest.mark.parametrize("size", [licenses.PASS, 4])
def test_scan_equals_sql(docs, monkeypatch, size):
    monkeypatch.setattr(licenses, "PASS", size)
    rows = notices()
    got = licenses.licensed(docs(rows), ["doc_id"]).select(*NAMES).collect()
    want = by_sql(rows)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert sum(1 for r in want if r[6] and not r[2]) >= 40


def test_scan_of_odd_rows(docs, odd):
    assert licenses.licensed(docs([]), ["doc_id"]).collect() == []
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = licenses.licensed(odd, ["doc_id", "source", "score"])
    assert got.columns.count("score") == 2
    got = licenses.licensed(odd.drop("score"), ["doc_id"]).select(*NAMES).collect()
    assert sorted((tuple(r) for r in got), key=repr) == by_sql(rows)


def test_text_that_is_not_utf8(spark):
    bad = spark.sql("select 1 as doc_id, cast(X'4D4954FF204D4954204C6963656E7365' as string) as text")
    row = licenses.licensed(bad, ["doc_id"]).first()
    assert (row.n_words, row.n_base, row.first_word) == (3, 1, 1)


def test_template_without_words_is_refused(docs):
    with pytest.raises(ValueError):
        licenses.licensed(docs([(1, "a")]), ["doc_id"], templates=[("x", "---")])


# -- whitening -----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, x int, n string, block string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 7, "n", "b") for i, v in rows], VECTORS)


def expected(rows, k):
    """Rows of valid vectors, and mean, eigenvalues, axes, n and sums of the different ones, by numpy."""
    width = max(len(v) for _, v in rows)
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in rows]
    fit = np.array(sorted({tuple(v) for v in x}), dtype=float)
    y = fit - fit.mean(axis=0)
    e, u = np.linalg.eigh(y.T @ y / len(fit))
    return np.array(x), fit, e[::-1][:k], u[:, ::-1][:, :k]


def check_whitened(rows, got, k):
    x, fit, e, u = expected(rows, k)
    n, sums = len(fit), fit.astype(int).sum(axis=0)
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    assert len(got) == len(rows) * len(e)
    total = np.trace(np.cov(fit.T, bias=True)) if fit.shape[1] > 1 else fit.var()
    white = (x - sums / n) @ u / np.sqrt(e)
    for row, (vec_id, _) in enumerate(rows):
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[row], sums))
        mine = found[(vec_id, deviation)]
        for c in range(len(e)):
            one = mine[c + 1][0]
            assert one.n == n and one.identity_error < 1e-9
            assert abs(one.explained - e[c] / total) < 1e-12
            assert abs(abs(one.whitened) - abs(white[row, c])) < 1e-7


def test_whitening_equals_numpy(spark):
    draw = np.random.default_rng(1)
    data = (draw.standard_normal((400, 24)) * np.linspace(0.2, 1, 24)).astype(np.float32).tolist()
    rows = list(enumerate(data)) + [(1000 + i, data[0]) for i in range(300)] + [(5, data[9])]
    bad = [(2000, None), (2001, [None] * 24), (2002, [float("nan")] * 24), (2003, [float("inf")] + [0.0] * 23)]
    frame = vectors(spark, rows + bad).repartition(7)
    check_whitened(rows, whitening.whiten(frame, components=16).collect(), 16)


def test_sums_are_added_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PARTS", 1)
    monkeypatch.setattr(whitening, "BLOCK", 16)
    draw = np.random.default_rng(2)
    rows = list(enumerate(draw.standard_normal((200, 6)).astype(np.float32).tolist()))
    check_whitened(rows, whitening.whiten(vectors(spark, rows).repartition(9), components=4).collect(), 4)


def test_whitening_of_odd_rows(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    rows = [(1, [1.0, 2.0]), (None, [0.5]), (3, []), (3, [4.0, -1.0]), (3, [4.0, -1.0])]
    check_whitened(rows, whitening.whiten(vectors(spark, rows), components=16).collect(), 16)
    with pytest.raises(OverflowError):
        whitening.whiten(vectors(spark, [(1, [1e20]), (2, [0.0])]))


@pytest.mark.parametrize("width, wanted", [(1, 1), (5, 16), (64, 16), (150, 12)])
def test_pairs_reach_double_precision(width, wanted):
    draw = np.random.default_rng(width)
    data = draw.standard_normal((3 * width, width))
    v = data.T @ data / len(data)
    values, axes = whitening.largest_pairs(lambda z: v @ z, width, wanted)
    true = np.linalg.eigvalsh(v)[::-1][:wanted]
    assert np.abs(values - true).max() < 1e-12 * true[0]
    assert np.linalg.norm(v @ axes - axes * values, axis=0).max() < 1e-12 * true[0]
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13


def test_equal_and_missing_eigenvalues():
    v = np.diag([3.0] * 20 + [1.0] * 20 + [0.0] * 60)
    values, axes = whitening.largest_pairs(lambda z: v @ z, 100, 24)
    assert np.abs(values - np.array([3.0] * 20 + [1.0] * 4)).max() < 1e-12
    assert np.abs(axes.T @ axes - np.eye(24)).max() < 1e-13
