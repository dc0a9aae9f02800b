"""Spelling variants: words one edit apart, found by search schemes over bidirectional FM-indexes.

Words are counted over whole texts, summed in each task before the shuffle. A word and one that is
one edit away share the word's first half at their beginning or its second half at their end. So
words are dealt to shards by halves: each word is stored under the halves that words of its length
and its neighbours' lengths can ask for, and asks once for each of its halves. A half with many
words is dealt to several parts, all of which are asked. A shard builds one bidirectional FM-index
over its delimited words and answers all its questions together: one half is matched exactly, the
other is extended from it, to the right or to the left, with one error allowed, as intervals of
suffix ranks. A question leaves a shard as a number, the most frequent match and no pairs.

Defined cases: a null or empty text has no words; a null id counts as the text `null`. Rows that
repeat count each time. Equal counts go to the smaller word in code-point order. An empty table, or
one without a frequent word, gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialise

#: Shortest word, fewest occurrences, and how many times more frequent a word's form must be.
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: One run in so many loses a letter.
NOISE = 199
#: Words of a shard on average, and words of one half that one part holds.
SHARD, PART = 16_384, 8192
#: Different words that a task holds before it hands their counts on.
HELD = 400_000
_QUESTIONS = 2048
_STEP = 32

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def noisy_words(doc_id: int | None, text: str | None, noise: int = NOISE) -> Counter[str]:
    """Words of a text and how often they occur, after one run in `noise` has lost a letter."""
    counts: Counter[str] = Counter()
    name = "null" if doc_id is None else str(doc_id)
    for run, n in Counter(_RUN.findall((text or "").translate(_LOWER))).items():
        h = zlib.crc32(f"{name}:{run}".encode())
        if h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= MIN_LENGTH:
            counts[run] += n
    return counts


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`word` and `n` of all frequent words, written once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                held.update(noisy_words(batch.column(0)[i].as_py(), batch.column(1)[i].as_py()))
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    valid = F.make_valid_utf8(F.col(text)).alias("text")
    counted = docs.select(F.col(key).alias("key"), valid).mapInArrow(count, "word string, n long")
    counts = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
    return materialise(counts, "spelling-words")


class Side:
    """FM-index of a cyclic text: suffix order, and counts of each symbol before each place."""

    def __init__(self, text: np.ndarray, symbols: int):
        n = len(text)
        rank, width = text.astype(np.int64), 1
        while True:
            order = np.argsort(rank * (n + symbols) + np.roll(rank, -width), kind="stable")
            key = rank[order] * (n + symbols) + np.roll(rank, -width)[order]
            fresh = np.empty(n, np.int64)
            fresh[order] = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
            rank, width = fresh, 2 * width
            if rank[order[-1]] == n - 1 or width >= n:
                break
        self.order = order
        before = text[(order - 1) % n].astype(np.int16)
        self.n, self.symbols = n, symbols
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))[:symbols]
        # counts at every _STEP-th place, and the symbols themselves for what lies between
        blocks = n // _STEP + 1
        padded = np.full(blocks * _STEP, symbols, np.int16)
        padded[:n] = before
        self.before = padded.reshape(blocks, _STEP)
        cell = np.repeat(np.arange(blocks), _STEP) * (symbols + 1) + padded
        each = np.bincount(cell, minlength=blocks * (symbols + 1)).reshape(blocks, symbols + 1)[:, :symbols]
        self.counts = (np.cumsum(each, axis=0) - each).astype(np.int32)

    def ranks(self, places: np.ndarray) -> np.ndarray:
        """For each place the number of every symbol before it."""
        block, rest = np.divmod(places, _STEP)
        inside = np.where(np.arange(_STEP) < rest[:, None], self.before[block], self.symbols)
        cell = np.arange(len(places))[:, None] * (self.symbols + 1) + inside
        more = np.bincount(cell.ravel(), minlength=len(places) * (self.symbols + 1))
        return self.counts[block] + more.reshape(len(places), -1)[:, : self.symbols]


class BidirectionalIndex:
    """FM-indexes of the words, each behind a delimiter, read forwards and backwards.

    A found pattern is an interval of ranks in both orders, kept in step: `extend` widens the
    pattern by every symbol on the left or on the right.
    """

    def __init__(self, words: list[str]):
        points = np.frombuffer(("\0" + "\0".join(words)).encode("utf-32-le"), "<u4")
        self.alphabet, text = np.unique(points, return_inverse=True)
        self.size, self.symbols = len(text), len(self.alphabet)
        self.forward = Side(text, self.symbols)
        self.backward = Side(text[::-1], self.symbols)
        self.starts = np.flatnonzero(text == 0)

    def extend(self, left: np.ndarray, low: np.ndarray, other: np.ndarray, size: np.ndarray):
        """(own low, other low, size) for every symbol; `low` is in the order read towards the new symbol."""
        own, back, sizes = (np.empty((len(low), self.symbols), np.int64) for _ in range(3))
        for side, rows in ((self.forward, left), (self.backward, ~left)):
            at = np.flatnonzero(rows)
            if not len(at):
                continue
            both = side.ranks(np.concatenate([low[at], low[at] + size[at]]))
            a, b = both[: len(at)], both[len(at) :]
            sizes[at] = b - a
            own[at] = side.first + a
            back[at] = other[at, None] + np.cumsum(b - a, axis=1) - (b - a)
        return own, back, sizes

    def extend_by(self, left: np.ndarray, low: np.ndarray, other: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        """The same by one symbol each; the alphabet's absent symbol -1 gives the empty interval."""
        own, back, sizes = self.extend(left, low, other, size)
        at = np.arange(len(low))
        return own[at, symbol], back[at, symbol], np.where(symbol >= 0, sizes[at, symbol], 0)

    def words_at(self, left: np.ndarray, low: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Number of the word whose leading delimiter stands where the pattern does."""
        rank = np.where(left, low, other)
        return np.searchsorted(self.starts, self.forward.order[rank])

    def one_edit(self, words: list[str], left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(question, word number) of all words one edit from the question.

        With `left` the second half is matched exactly and the first one extended to the left; else
        the first half is matched and the second one extended to the right.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        asked, hits, at = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
        while at < len(order):
            # words of like length go together, so that one long word does not widen the table of all
            end = min(len(order), at + _QUESTIONS)
            end = at + max(1, int((np.arange(1, end - at + 1) * lengths[order[at:end]] <= _QUESTIONS * 64).sum()))
            some = order[at:end]
            q, w = self._search([words[i] for i in some], left[some])
            asked.append(some[q])
            hits.append(w)
            at = end
        pairs = np.unique(np.stack([np.concatenate(asked), np.concatenate(hits)], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def _patterns(self, words: list[str], left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols in the order of extension, delimiters at both ends, with lengths of the exact part."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        place = np.searchsorted(self.alphabet, points)
        place[place == self.symbols] = 0
        symbol = np.where(self.alphabet[place] == points, place, -1)
        row = np.repeat(np.arange(len(words)), lengths)
        at = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.where(left[row], lengths[row] - 1 - at, at)
        out = np.zeros((len(words), int(lengths.max()) + 2), np.int64)
        out[row, at + 1] = symbol
        half = lengths // 2
        return out, np.where(left, lengths - half, half), lengths

    def _search(self, words: list[str], left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pattern, exact, lengths = self._patterns(words, left)
        ask = np.arange(len(words))
        low, other, size = np.zeros(len(ask), np.int64), np.zeros(len(ask), np.int64), np.full(len(ask), self.size)
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        #: states with their one error made: question, next symbol, interval
        open_ = [np.empty(0, np.int64) for _ in range(5)]
        for place in range(pattern.shape[1]):
            own, back, sizes = self.extend(left[ask], low, other, size)
            here = np.arange(len(ask))
            wanted = pattern[ask, place]
            # errors are allowed behind the exact part: places exact + 1 to length, and before the last delimiter
            free = (place > exact[ask]) & (place <= lengths[ask] + 1)
            inner = free & (place <= lengths[ask])
            if free.any():
                row, symbol = np.nonzero((sizes > 0) & free[:, None])
                apart = (symbol != wanted[row]) & (symbol > 0)
                row, symbol = row[apart], symbol[apart]
                child = (own[row, symbol], back[row, symbol], sizes[row, symbol])
                swap = inner[row]
                skip = np.flatnonzero(inner)
                more = [
                    # one symbol more than the question has
                    (ask[row], np.full(len(row), place), *child),
                    # another symbol
                    (ask[row[swap]], np.full(swap.sum(), place + 1), *(c[swap] for c in child)),
                    # one symbol less
                    (ask[skip], np.full(len(skip), place + 1), low[skip], other[skip], size[skip]),
                ]
                open_ = [np.concatenate(parts) for parts in zip(open_, *more)]
            open_ = self._advance(open_, pattern, lengths, left, hits, None if place + 1 < pattern.shape[1] else -1)
            go = (place <= lengths[ask]) & (wanted >= 0)
            go[go] = sizes[here[go], wanted[go]] > 0
            row = here[go]
            ask, low, other, size = ask[row], own[row, wanted[row]], back[row, wanted[row]], sizes[row, wanted[row]]
        return (
            np.concatenate([q for q, _ in hits] or [np.empty(0, np.int64)]),
            np.concatenate([w for _, w in hits] or [np.empty(0, np.int64)]),
        )

    def _advance(self, open_, pattern, lengths, left, hits, until):
        """Moves states without an error to spare one symbol on, or with `until` to their ends."""
        while len(open_[0]):
            ask, at, low, other, size = open_
            low, other, size = self.extend_by(left[ask], low, other, size, pattern[ask, at])
            ended = (size > 0) & (at == lengths[ask] + 1)
            if ended.any():
                hits.append((ask[ended], self.words_at(left[ask[ended]], low[ended], other[ended])))
            stay = np.flatnonzero((size > 0) & ~ended)
            open_ = [ask[stay], at[stay] + 1, low[stay], other[stay], size[stay]]
            if until is None:
                break
        return open_


def _halves(length: int, shortest: int) -> tuple[list[int], list[int]]:
    """Lengths of the first and second halves by which words one edit away may ask for a word."""
    near = [m for m in (length - 1, length, length + 1) if m >= shortest]
    return sorted({m // 2 for m in near}), sorted({m - m // 2 for m in near})


def stored_rows(words: DataFrame, shortest: int = MIN_LENGTH) -> DataFrame:
    """(half, word, n): each word under all halves by which words of `shortest` symbols or more may ask for it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half, at = [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                first, second = _halves(len(word), shortest)
                made = ["<" + word[:h] for h in first] + [">" + word[-h:] for h in second]
                half += made
                at += [i] * len(made)
            place = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(half, pa.string()), batch.column(0).take(place), batch.column(1).take(place)], ["half", "word", "n"]
            )

    return words.select("word", "n").mapInArrow(rows, "half string, word string, n long")


def near_words(words: DataFrame, shortest: int = MIN_LENGTH) -> DataFrame:
    """`word`, `n_near`, `form_n` and `form` (the most frequent near word) of words that have any.

    `words` has different words of `shortest` (2 or more) symbols at least, and `n`.
    """
    stored = materialise(stored_rows(words, shortest), "spelling-stored")
    sizes = stored.groupBy("half").agg(F.count(F.lit(1)).alias("size"))
    total = stored.count()
    shards = max(1, -(-total // SHARD))
    crowded = sizes.where(F.col("size") > PART).select("half", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    # one row per half with more words than a part holds: at most total / PART, joined as a table
    crowded = materialise(crowded, "spelling-crowded")
    length = F.length("word")
    half = F.floor(length / 2).cast("int")
    sides = F.array(
        F.concat(F.lit("<"), F.substring("word", 1, half)), F.concat(F.lit(">"), F.substring("word", half + 1, length - half))
    )
    asked = words.select("word", F.explode(sides).alias("half"), F.lit(None).cast("long").alias("n"))
    both = stored.select("half", "word", "n").unionByName(asked).join(crowded, "half", "left")
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.crc32(F.col("word").cast("binary")), parts).cast("int")
    part = F.explode(F.when(F.col("n").isNotNull(), F.array(own)).otherwise(F.sequence(F.lit(0), parts - 1)))
    dealt = both.select("half", "word", "n", parts.alias("parts"), part.alias("part"))
    shard = F.pmod(F.xxhash64("half", "part"), F.lit(shards)).cast("int")

    result = "word string, n_near long, form_n long, form string"
    found = dealt.withColumn("shard", shard).groupBy("shard").applyInPandas(lambda frame: _answers(frame), result)
    best = F.min_by(F.struct("form_n", "form"), F.struct(-F.col("form_n"), F.col("form")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", "best.form_n", "best.form")


def _answers(frame: pd.DataFrame) -> pd.DataFrame:
    """Number and most frequent of the near words of each question of a shard."""
    kept = frame[frame.n.notna()].drop_duplicates("word")
    asked = frame[frame.n.isna()].reset_index(drop=True)
    none = pd.DataFrame({"word": [], "n_near": [], "form_n": [], "form": []}).astype({"n_near": "int64", "form_n": "int64"})
    if kept.empty or asked.empty:
        return none
    names, counts = kept.word.to_numpy(object), kept.n.to_numpy(np.int64)
    index = BidirectionalIndex(list(names))
    questions = asked.word.to_numpy(object)
    left = asked.half.str[0].to_numpy() == ">"
    ask, hit = index.one_edit(list(questions), left)
    # what begins with the question's first half is found where that half is asked for, and each
    # word in the part it was dealt to
    halves = asked.half.str[1:].to_numpy(object)
    parts, part = asked.parts.to_numpy(np.int64), asked.part.to_numpy(np.int64)
    digest = np.fromiter((zlib.crc32(w.encode()) for w in names), np.int64, len(names))
    keep = digest[hit] % parts[ask] == part[ask]
    for i in np.flatnonzero(keep & left[ask]):
        word = questions[ask[i]]
        keep[i] = not names[hit[i]].startswith(word[: len(word) - len(halves[ask[i]])])
    ask, hit = ask[keep], hit[keep]
    if not len(ask):
        return none
    place = np.argsort(np.argsort(names, kind="stable"), kind="stable")
    order = np.lexsort((place[hit], -counts[hit], ask))
    ask, hit = ask[order], hit[order]
    first = np.flatnonzero(np.concatenate(([True], ask[1:] != ask[:-1])))
    number = np.diff(np.append(first, len(ask)))
    return pd.DataFrame(
        {"word": questions[ask[first]], "n_near": number, "form_n": counts[hit[first]], "form": names[hit[first]]}
    )


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near` and `form_n` of every frequent word of the texts."""
    words = vocabulary(docs, key, text)
    near = materialise(near_words(words), "spelling-near")
    known = words.join(near, "word", "left")
    formed = F.col("form_n") >= RATIO * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n"),
    )
    known = materialise(known, "spelling-forms")
    return known.join(roots(known), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(known: DataFrame) -> DataFrame:
    """(word, root) of words with a form. Counts rise at each step, so chains end; each round doubles the step."""
    step = known.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        step = materialise(step, "spelling-roots")
        after = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = step.join(after, "root", "left")
        if not joined.where(F.col("next").isNotNull()).take(1):
            return step
        step = joined.select("word", F.coalesce("next", "root").alias("root"))
