from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def unrolled(plan, counts):
    out = defaultdict(list)
    for length, number in counts.items():
        rows = sorted(r for r in plan.ranges if r[0] == length)
        for rank in range(number):
            row = [r for r in rows if r[1] <= rank][-1]
            inside = rank - row[1]
            out[row[2] + inside // row[3]].append((row[4] + inside % row[3] * length, length))
    return out


def check_plan(counts, capacity):
    plan = packing.make_plan(counts, capacity)
    out = unrolled(plan, counts)
    assert set(out) == set(range(plan.sequences))
    for parts in out.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return plan


def smallest(lengths, capacity):
    """Fewest sequences, by trying all."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for b in sorted(set(bins)):
            if b + lengths[i] <= capacity:
                rest = list(bins)
                rest.remove(b)
                go(i + 1, [*rest, b + lengths[i]])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_gapless_and_near_the_bound(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 17, 64, 2048])
    counts = Counter(draw.randint(1, capacity) for _ in range(draw.randint(1, 400)))
    plan = check_plan(counts, capacity)
    total = sum(k * n for k, n in counts.items())
    assert plan.sequences <= 1.23 * total / capacity + 1 + sum(n for k, n in counts.items() if 2 * k > capacity)


@pytest.mark.parametrize("seed", range(150))
def test_reduction_keeps_an_optimal_packing(seed):
    """What is fixed, with an optimal packing of the rest, is optimal for all."""
    draw = random.Random(seed)
    capacity = draw.choice([10, 13, 20])
    lengths = [draw.randint(2, capacity) for _ in range(draw.randint(1, 9))]
    plan, rest = packing.Plan(capacity), Counter(lengths)
    packing.reduce_dominated(rest, plan)
    assert plan.sequences + smallest(list(rest.elements()), capacity) == smallest(lengths, capacity)


def test_best_fit_equals_one_piece_at_a_time():
    for seed in range(40):
        draw = random.Random(seed)
        capacity = draw.choice([12, 30, 100])
        counts = Counter(draw.randint(1, capacity - 1) for _ in range(120))
        plan = packing.Plan(capacity)
        packing.best_fit(counts, plan)
        bins = []
        for length in sorted(counts.elements(), reverse=True):
            fitting = [b for b in bins if b + length <= capacity]
            if fitting:
                bins.remove(max(fitting))
                bins.append(max(fitting) + length)
            else:
                bins.append(length)
        assert plan.sequences == len(bins)


def test_ids_equal_the_library():
    library = Tokenizer.from_file(PATH)
    draw = random.Random(1)
    texts = ["", " ", "It's I'LL don't", "İx Σας ẞ ŉ ſ", "12²½ x́ é é", "漢字 kana が", "a\xa0b c\x1cd\x85e\x0bf", "<|endoftext|> <|a"]
    texts += ["".join(chr(draw.choice([draw.randrange(32, 384), draw.randrange(32, 0x2FFF)])) for _ in range(60)) for _ in range(150)]
    got = packing.WordTokens(PATH)(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [[*w, 0] for w in want]


def test_pack_documents(spark, odd):
    rows = packing.pack_documents(odd, PATH, 512).collect()
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for r in odd.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 512)):
            part = ids[start : start + 512]
            want[r.doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512


def test_salted_numbering_and_sequences(spark, docs, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 7)
    frame = docs([(i, "same words in every text" if i % 3 else f"other number {i}") for i in range(120)])
    packed = packing.pack_documents(frame, PATH, 32, with_ids=True)
    rows = packed.collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows) == 120
    whole = packing.sequences(packed).collect()
    assert sum(len(s.ids) for s in whole) == sum(r.length for r in rows)
    assert all(len(s.ids) <= 32 and sum(x.length for x in s.spans) == len(s.ids) for s in whole)


def test_empty(spark, docs):
    assert packing.pack_documents(docs([]), PATH).count() == 0
