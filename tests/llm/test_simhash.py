from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from textloom.llm import simhash
from textloom.llm.components import connected_components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def brute_components(prints, reach=3):
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= reach:
                label[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def clustered(draw, centers, size):
    out = []
    for _ in range(centers):
        value = draw.getrandbits(64)
        for _ in range(draw.randint(1, size)):
            out.append(value)
            value ^= sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4)))
    return [v - (1 << 64) if v >> 63 else v for v in out]


def test_fingerprint():
    draw = random.Random(1)
    texts = [None, "", " \n", "One", "one TWO", "ÄB ab\x0bcd\x1ce f", "a a a a a a a"]
    texts += [" ".join(draw.choice(["a", "B", "ß", "x1"]) for _ in range(n)) for n in range(1, 60)]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("seed", range(12))
def test_shard_forest_keeps_every_link(seed, monkeypatch):
    monkeypatch.setattr(simhash, "_LEAF", 8)
    draw = random.Random(seed)
    points = np.unique(np.array(clustered(draw, 40, 12), np.int64))
    a, b = simhash.shard_forest(points, np.ones(len(points), bool), 3)
    want = brute_components(points.tolist())
    root = dict(zip(a.tolist(), b.tolist()))
    got = [root.get(p, p) for p in points.tolist()]
    assert got == [points[w] for w in want]
    assert len(a) < len(points)


@pytest.mark.parametrize("seed", range(6))
def test_visits_reach_every_linked_pair(seed):
    draw = random.Random(seed)
    points = np.unique(np.array(clustered(draw, 60, 8), np.int64))
    sample = points[:: draw.randint(1, 9)]
    own, rows, shards = simhash.ShardTree(sample, 5).visits(points, 3)
    visits = set(zip(rows.tolist(), shards.tolist()))
    for i in range(len(points)):
        for j in range(i):
            if simhash._distance(points[i : i + 1], points[j])[0] <= 3 and own[i] != own[j]:
                low, high = sorted((i, j), key=lambda k: own[k])
                assert (low, own[high]) in visits


def test_components(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(draw.randrange(100, 200), draw.randrange(100, 200)) for _ in range(70)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    want: dict[int, int] = {}
    for a, b in edges:
        want.setdefault(a, a), want.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(want[a], want[b])
            changed |= want[a] != low or want[b] != low
            want[a] = want[b] = low
    loops = {a for a, b in edges if a == b}
    assert got == {k: v for k, v in want.items() if k in got}
    assert set(want) - set(got) <= loops
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def varied_texts():
    draw = random.Random(5)
    base = [" ".join(draw.choice("alpha beta gamma delta epsilon zeta".split()) + str(draw.randrange(50)) for _ in range(120)) for _ in range(12)]
    texts = []
    for text in base:
        words = text.split()
        for _ in range(6):
            texts.append(" ".join(words))
            words[draw.randrange(len(words))] = "changed"
    return texts


def test_near_duplicates_equal_brute_force(spark, docs):
    texts = [*varied_texts(), None, "", "one", "one", " "]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(docs(rows)).collect()}
    prints = [brute_fingerprint(t) for _, t in rows]
    groups = brute_components(prints)
    least = {g: min(rows[i][0] for i in range(len(rows)) if groups[i] == g) for g in set(groups)}
    assert got == {rows[i][0]: (prints[i], least[groups[i]]) for i in range(len(rows))}
    assert len(set(groups)) < len(set(prints))


def test_keep_one(spark, odd, docs):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    # one of the rows without a word, one of the three copies
    assert sorted((r.doc_id for r in rows if r.doc_id), key=int) == [1, 4, 5, 7]
    assert [r.text for r in rows if r.doc_id is None] == ["no id at all"]
    same = docs([(3, "a b c d"), (3, "a b c d"), (3, "p q r s t"), (1, "p q r s t"), (None, "z"), (None, "z")])
    assert sorted((str(r.doc_id), r.text) for r in simhash.keep_one(same).collect()) == [
        ("1", "p q r s t"), ("3", "a b c d"), ("None", "z"),
    ]
    assert simhash.keep_one(docs([])).count() == 0


def test_odd_rows(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.fp == 0} == {1}


def test_links_are_whole_in_many_shards_and_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 4)
    monkeypatch.setattr(simhash, "MIN_DEPTH", 2)
    monkeypatch.setattr(simhash, "VISITORS", 3)
    draw = np.random.default_rng(4)
    base = draw.integers(-(2**63), 2**63 - 1, 60, dtype=np.int64)
    flips = [int(b) ^ (1 << int(draw.integers(62))) ^ (1 << int(draw.integers(62))) for b in base for _ in range(5)]
    points = sorted({*map(int, base), *flips})
    edges = simhash.near_links(spark.createDataFrame([(p,) for p in points], "fp long"), 3).collect()
    label = {p: p for p in points}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for e in edges:
        label[root(e.src)] = root(e.dst)
    for i, a in enumerate(points):
        for b in points[i + 1 :]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 3:
                assert root(a) == root(b)
