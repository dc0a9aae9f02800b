"""Statistics of a text for the quality classifier."""

from __future__ import annotations

import numpy as np

from textloom.llm.common import SPACES
from textloom.llm.quality_rules import SYMBOLS, numbered, repeated_words

FEATURES = (
    "n_words",
    "n_lines",
    "mean_word",
    "long_word",
    "symbol_rate",
    "symbol_words",
    "pipe_rate",
    "bang_rate",
    "upper_rate",
    "digit_rate",
    "comma_rate",
    "stop_rate",
    "distinct_rate",
    "repeat_rate",
    "same_next_rate",
    "dup_line_rate",
    "words_per_line",
    "ascii_rate",
)


def _flags(characters: str) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[[ord(c) for c in characters]] = True
    return flags


_SPACE, _TRAILING = _flags(SPACES), _flags("#*$%&")


def statistics(text: str | None) -> tuple[float, ...]:
    """The values of FEATURES; zeros for a text without a word. Lengths are in UTF-8 bytes."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return (0.0,) * len(FEATURES)
    n = len(words)
    data = np.frombuffer(raw, np.uint8)
    code = np.bincount(data, minlength=256)
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = _SPACE[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    chars = int(lengths.sum())
    last = data[ends - 1]
    ids, different = numbered(words)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    upper, lower = int(code[65:91].sum()), int(code[97:123].sum())
    symbols = sum(int(code[ord(c)]) for c in SYMBOLS)
    return (
        float(n),
        float(len(lines)),
        chars / n,
        float(lengths.max()),
        symbols / n,
        int(_TRAILING[last].sum()) / n,
        int(((lengths == 1) & (last == ord("|"))).sum()) / n,
        int(code[33]) / n,
        upper / max(1, upper + lower),
        int(code[48:58].sum()) / chars,
        int(code[44]) / n,
        int(code[46]) / n,
        different / n,
        repeated_words(ids, different) / n,
        int((ids[1:] == ids[:-1]).sum()) / n,
        (len(lines) - len(set(lines))) / len(lines),
        n / len(lines),
        int(code[:128].sum()) / len(raw),
    )
