from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from textloom.llm import chat

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = [*chat.CONTROLS, "\\", "<", "[", "/", "s>", "INST]", "hi ", "ß", "\n", "<\\s>", "[\\\\/INST]", "😀", "é"]


@pytest.fixture(scope="module")
def assembler():
    return chat.Assembler(RANKS, PATTERN)


def test_escape_is_reversible_and_hides_controls():
    draw = random.Random(2)
    for _ in range(5000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randrange(9)))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert not chat._CONTROL.search(hidden)


def test_round_trip_by_ids_and_by_text(assembler):
    draw = random.Random(4)
    for _ in range(400):
        turns = [
            (draw.choice(["user", "assistant", "system", "tool", "", "[INST]"]), "".join(draw.choice(PARTS) for _ in range(draw.randrange(8))))
            for _ in range(draw.randrange(1, 5))
        ]
        ids, mask, size = [assembler.reserved["<s>"]], [False], 3
        for role, text in turns:
            more, loss, length = assembler.turn(role, text)
            ids, mask, size = ids + more, mask + loss, size + length
        assert assembler.parse(ids) == turns
        rendered = assembler.render(ids)
        assert chat.parse_text(rendered) == turns
        assert len(rendered) == size
        lost = "".join(t for r, t in turns if r == "assistant")
        assert assembler.masked_text(ids, mask) == lost
        assert assembler.read(np.array(ids, np.int32), np.array(mask)) == (turns, lost, size)


def test_query_over_odd_rows(spark):
    rows = [
        (1, 2, "assistant", "b</s>", 9), (1, 1, "user", "a", 9), (1, 1, "user", "a", 9), (1, None, "system", None, 9),
        (2, 1, None, "x", 9), (None, 1, "assistant", "", 9), (3, 1, "assistant", "y" * 50_000, 9),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids int")
    formatted = chat.format_conversations(frame, RANKS, PATTERN)
    got = {r.conv_id: r for r in chat.read_back(formatted, RANKS, PATTERN).collect()}
    said = "system\n\nuser\na\nuser\na\nassistant\nb</s>\n"
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert (got[1].n_turns, got[1].loss_chars) == (4, 5)
    assert got[1].loss_sha256 == hashlib.sha256(b"b</s>").hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(b"\nx\n").hexdigest()
    assert got[None].loss_chars == 0 and got[3].loss_chars == 50_000
    starts = [(r.position, r.token_start, r.char_start) for r in formatted.where("conv_id = 1").orderBy("position").collect()]
    sizes = [(len(r.ids), r.n_chars) for r in formatted.where("conv_id = 1").orderBy("position").collect()]
    at = [0, 0]
    for (_, token, char), (n, c) in zip(starts, sizes):
        assert [token, char] == at
        at = [at[0] + n, at[1] + c]
    assert chat.read_back(chat.format_conversations(frame.limit(0), RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_a_conversation_over_many_ranges(spark):
    """One conversation, and the one without an id, are spread over ranges; places and digests stay whole."""
    draw = random.Random(9)
    rows = [(7, i // 3, draw.choice(["user", "assistant"]), f"text {i} " * draw.randrange(5)) for i in range(400)]
    rows += [(None, i, "assistant", f"n{i}") for i in range(150)] + [(i, 0, "user", "x") for i in range(100, 140)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        formatted = chat.format_conversations(frame, RANKS, PATTERN)
        found = formatted.collect()
        digests = {r.conv_id: r for r in chat.read_back(formatted, RANKS, PATTERN).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(digests) == 42 and len(found) == len(rows)
    for conv in (7, None, 101):
        mine = sorted((r for r in found if r.conv_id == conv), key=lambda r: r.position)
        at = [0, 0]
        for place, r in enumerate(mine):
            assert [r.position, r.token_start, r.char_start] == [place + 1, *at]
            at = [at[0] + len(r.ids), at[1] + r.n_chars]
        said = sorted((t, r, x) for c, t, r, x in rows if c == conv)
        want = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in said).encode()).hexdigest()
        lost = "".join(x for _, r, x in said if r == "assistant")
        assert digests[conv].turns_sha256 == want and digests[conv].n_turns == len(said)
        assert digests[conv].loss_sha256 == hashlib.sha256(lost.encode()).hexdigest()
        assert digests[conv].loss_chars == len(lost) and digests[conv].formatted_chars == at[1]
