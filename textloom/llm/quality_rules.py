"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one
integer whose bit b is set when rule b fails. A policy is a versioned set of rules; it is
applied, compared and ablated on the integer alone, without reading a text again.

Defined cases: a null or empty text has zero words and fails `few_words`; other rules
fail only on a strict excess, so they hold for it. Rows are independent: repeated rows give
repeated ledger rows, null ids stay, an empty table gives an empty ledger, and columns beside
the key and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import SPACES, add_columns

SYMBOLS = "#*$%&|<>"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_lower long"
)


def numbered(words: list) -> tuple[np.ndarray, int]:
    """Each word's number by first occurrence, and how many differ."""
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    return ids, len(number)


def repeated_words(ids: np.ndarray, different: int) -> int:
    """Words that lie in a window of three words found at least twice; `ids` as from numbered()."""
    if len(ids) < 4 or different == len(ids):
        return 0
    pairs, base = ids[:-1] * different + ids[1:], different
    if different >= 2_000_000:  # three numbers do not fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * base + ids[2:]
    order = np.argsort(windows, kind="stable")
    equal = windows[order[1:]] == windows[order[:-1]]
    again = np.zeros(len(windows), bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    inside = np.zeros(len(ids), bool)
    inside[:-2] |= again
    inside[1:-1] |= again
    inside[2:] |= again
    return int(inside.sum())


def measure(text: str | None) -> tuple:
    """The measurements of one text, in the order of MEASURES."""
    if not text:
        return (0,) * 8
    raw = text.encode()
    words = raw.split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    letters = np.bincount(np.frombuffer(raw, np.uint8), minlength=128)
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(int(letters[ord(c)]) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(*numbered(words)),
        len(lines),
        int(letters[65:91].sum()),
        int(letters[97:123].sum()),
    )


#: Rule name -> condition of failure over the measurements. The place in the dict is the bit; append only.
RULES: dict[str, Column | str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "capitals": "n_upper > n_lower",
}


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules; a document is kept when none of them fails."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = list(RULES)
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = {
    p.version: p
    for p in (BASE, Policy("v1", (*BASE.rules, "symbols", "duplicate_lines")), Policy("v2", tuple(RULES)))
}
CURRENT = "v2"


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, measurements and `failed`, the bits of the rules that fail."""
    measured = add_columns(
        docs, [F.col(text)], [F.col(key)], MEASURES, lambda: lambda texts: [measure(t) for t in texts]
    )
    bits = [F.when(F.expr(rule), F.lit(1 << b)).otherwise(F.lit(0)) for b, rule in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed.cast("long"))


def fails(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(rows: DataFrame, policy: Policy, name: str = "kept") -> DataFrame:
    """Adds `name`: true where no rule of the policy fails."""
    return rows.withColumn(name, ~fails(policy))


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """One row per rule of the policy: rejected in all, by this rule at all, by this rule alone.

    `kept_without` is what the policy would keep if the rule were taken out. One pass over the
    integer column; the partial sums are one row per task.
    """
    mask = F.col("failed").bitwiseAND(F.lit(policy.mask))
    names = list(RULES)
    sums = [F.count(F.lit(1)).alias("n"), F.count_if(mask != 0).alias("rejected")]
    for rule in policy.rules:
        bit = 1 << names.index(rule)
        sums += [
            F.count_if(mask.bitwiseAND(F.lit(bit)) != 0).alias(f"hit_{rule}"),
            F.count_if(mask == bit).alias(f"only_{rule}"),
        ]
    total = rows.agg(*sums)
    report = F.array(
        *[
            F.struct(
                F.lit(policy.version).alias("policy"),
                F.lit(rule).alias("rule"),
                F.col("n").alias("documents"),
                F.col("rejected"),
                F.col(f"hit_{rule}").alias("failed_rule"),
                F.col(f"only_{rule}").alias("failed_only_rule"),
                (F.col("n") - F.col("rejected") + F.col(f"only_{rule}")).alias("kept_without"),
            )
            for rule in policy.rules
        ]
    )
    return total.select(F.inline(report))
