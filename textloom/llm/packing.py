"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only the lengths matter to the packing, and there are no more than `capacity` of them, so the
plan is made on counts per length: a table of bounded size whatever the corpus is. Dominance
reduction fixes sets of pieces that no other choice can beat, the rest is packed best fit,
largest first, many equal pieces at a time. The plan is a list of ranges over the rank of a
piece among those of its length; ranks are taken in salted groups, so a length that a third of
all pieces share is numbered by many tasks.

Defined cases: a null text is empty and gives the closing id alone; rows with the same id are
pieces of their own; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import add_columns
from textloom.session import materialise

#: Pieces that one group of a numbering holds on average.
GROUP = 2000
#: Parts whose ids a worker remembers.
_CACHE = 600_000


#: Letters and digits below U+0180 as the pre-tokeniser sees them after lower-casing.
_LETTER, _DIGIT = "a-zªµºß-öø-ÿĀ-ſ", "0-9²³¹¼½¾"
#: Texts of these characters are cut here; in others, words with further characters go through the library whole.
_PLAIN = re.compile("[\\t\\n !-~¡-¬®-įı-ſ]*")
_PARTS = re.compile(rf"[{_LETTER}]+|[{_DIGIT}]|'(?:s|t|re|ve|m|ll|d)|[^\s{_LETTER}{_DIGIT}]+")


class WordTokens:
    """Ids of a text by a vocabulary that drops white space, part by part with a bounded cache.

    Normaliser and pre-tokeniser never look across white space, and byte pairs never across the
    parts the pre-tokeniser makes, so the ids of a text are those of its parts in order. New parts
    are encoded many at a time by the library; an id that ends a part tells where the next begins.
    The cache changes no result.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _learn(self, new: list[str]) -> None:
        plain = [p for p in new if _PLAIN.fullmatch(p) and _PARTS.fullmatch(p)]
        for at in range(0, len(plain), 1000):
            some = plain[at : at + 1000]
            ids = self._encode([" ".join(some)])[0]
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(cuts) == len(some):
                raw = ids.tobytes()
                self.parts.update((p, raw[a:b]) for p, a, b in zip(some, [0, *cuts], cuts))
            else:
                self.parts.update((p, i.tobytes()) for p, i in zip(some, self._encode(some)))
        whole = list(set(new).difference(plain))
        for at in range(0, len(whole), 1000):
            some = whole[at : at + 1000]
            self.parts.update((w, i.tobytes()) for w, i in zip(some, self._encode(some)))

    def _cut(self, text: str | None) -> list[str]:
        if not text:
            return []
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return _PARTS.findall(text.lower())
        out: list[str] = []
        for word in text.replace("\n", " ").replace("\t", " ").split(" "):
            if _PLAIN.fullmatch(word) and "<|" not in word:
                out += _PARTS.findall(word.lower())
            else:
                out.append(word)
        return out

    def __call__(self, texts: list[str | None], end: int = 0) -> list[bytes]:
        """Ids of each text, then `end`, as little-endian 32-bit numbers."""
        cut = [self._cut(t) for t in texts]
        used = set(chain.from_iterable(cut))
        new = used.difference(self.parts)
        if len(self.parts) + len(new) > _CACHE:
            self.parts, new = {}, used
        self._learn(list(new))
        get, last = self.parts.__getitem__, np.array([end], "<u4").tobytes()
        return [b"".join(map(get, parts)) + last for parts in cut]


_WORKER: dict[str, WordTokens] = {}


def _pieces(path: str, capacity: int, end: int, with_ids: bool):
    tokens = _WORKER.setdefault(path, None) or WordTokens(path)
    _WORKER[path] = tokens

    def run(texts: list[str | None]) -> list[tuple]:
        out = []
        for ids in tokens(texts, end):
            rows = []
            for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                part = ids[4 * start : 4 * (start + capacity)]
                row = (piece, start, len(part) // 4, zlib.crc32(part))
                rows.append((*row, np.frombuffer(part, "<u4").tolist() if with_ids else None))
            out.append((rows,))
        return out

    return run


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end: int = 0,
    with_ids: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Key, piece, start, length, ids_crc32 and ids (null unless asked for) of every document's pieces."""
    item = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint,ids:array<int>>>"
    cut = add_columns(
        docs, [F.col(text)], [F.col(key)], f"__pieces {item}", lambda: _pieces(tokenizer_path, capacity, end, with_ids)
    )
    return cut.select(key, F.inline("__pieces"))


@dataclass
class Plan:
    """Ranges of ranks: length, first rank, sequence of the first, pieces per sequence, first offset."""

    capacity: int
    ranges: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    reduced: int = 0
    _rank: Counter = field(default_factory=Counter)

    def _put(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        self.ranges.append((length, self._rank[length], sequence, each, offset))
        self._rank[length] += count

    def fix(self, lengths: tuple[int, ...], times: int) -> None:
        """`times` sequences that hold one piece of each of the lengths."""
        offset = 0
        for length in lengths:
            self._put(length, times, self.sequences, 1, offset)
            offset += length
        self.sequences += times
        self.reduced += times


def reduce_dominated(counts: Counter, plan: Plan) -> None:
    """Martello-Toth reduction: fixes sets that dominate every other set with their largest piece.

    For a piece j, largest first: alone if nothing fits beside it; with the largest piece that fits
    if both fill the sequence or no two pieces fit beside j; with the best pair when at most two
    fit and that pair dominates the single piece and all other pairs. Fixed pieces leave `counts`.
    """
    room = plan.capacity

    def smallest(n: int) -> list[int]:
        out: list[int] = []
        for length in sorted(k for k, c in counts.items() if c > 0):
            out += [length] * min(counts[length], n - len(out))
            if len(out) == n:
                break
        return out

    def take(lengths: tuple[int, ...]) -> None:
        need = Counter(lengths)
        times = min(counts[k] // n for k, n in need.items())
        for k, n in need.items():
            counts[k] -= n * times
        plan.fix(lengths, times)

    for j in sorted(counts, reverse=True):
        while counts[j] > 0:
            counts[j] -= 1
            few = smallest(3)
            fit = 0
            while fit < len(few) and j + sum(few[: fit + 1]) <= room:
                fit += 1
            beside = max((k for k, c in counts.items() if c > 0 and j + k <= room), default=0)
            chosen: tuple[int, ...] | None = None
            if fit == 0:
                chosen = (j,)
            elif fit == 1 or j + beside == room:
                chosen = (j, beside)
            elif fit == 2:
                chosen = _pair(counts, j, beside, room)
            counts[j] += 1
            if chosen is None or min(counts[k] // n for k, n in Counter(chosen).items()) == 0:
                break
            take(chosen)


def _pair(counts: Counter, j: int, beside: int, room: int) -> tuple[int, ...] | None:
    """With at most two pieces beside j: the set that dominates, if there is one."""
    lengths = sorted((k for k, c in counts.items() if c > 0), reverse=True)
    best: tuple[int, int] | None = None
    low = len(lengths) - 1
    for high, a in enumerate(lengths):
        # for a falling a, the largest b <= a that still fits rises
        while low > high and j + a + lengths[low - 1] <= room:
            low -= 1
        for b in lengths[max(low, high) : max(low, high) + 2]:
            fits = j + a + b <= room and (a != b or counts[a] > 1)
            if fits and (best is None or a + b > sum(best)):
                best = (a, b)
    if best is None or beside >= sum(best):
        return (j, beside)
    a, b = best
    if a == beside:
        between = [k for k in lengths if b < k < a]
        between_pieces = sum(counts[k] for k in between) + (counts[a] - 1)
        two = sorted(chain.from_iterable([k] * min(2, counts[k]) for k in between + [a]))[:2]
        if between_pieces <= 1 or (len(two) == 2 and j + sum(two) > room):
            return (j, a, b)
    return None


def best_fit(counts: Counter, plan: Plan) -> None:
    """Best fit, largest first, on what the reduction left; equal pieces and equal gaps move together."""
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for length in sorted((k for k, c in counts.items() if c > 0), reverse=True):
        left = counts[length]
        while left:
            gap = next((g for g in range(length, plan.capacity) if open_[g]), None)
            if gap is None:
                gap = plan.capacity
                number = -(-left // (gap // length))
                open_[gap].append((plan.sequences, number))
                plan.sequences += number
            first, number = open_[gap].pop()
            each = gap // length
            full = min(number, left // each)
            if full:
                plan._put(length, full * each, first, each, plan.capacity - gap)
                open_[gap - each * length].append((first, full))
                left -= full * each
            if full < number:
                rest = first + full
                if 0 < left < each:
                    plan._put(length, left, rest, left, plan.capacity - gap)
                    open_[gap - left * length].append((rest, 1))
                    left, rest = 0, rest + 1
                if rest < first + number:
                    open_[gap].append((rest, first + number - rest))


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    plan, rest = Plan(capacity), Counter({k: c for k, c in counts.items() if c > 0})
    reduce_dominated(rest, plan)
    best_fit(rest, plan)
    return plan


def pack(pieces: DataFrame, capacity: int = 2048, key: str = "doc_id") -> DataFrame:
    """Adds `sequence_id` and `offset` to pieces (key, piece, start, length, ids_crc32, ...).

    `pieces` is read several times; hand over a written table. Pieces are taken in the order of
    key, piece, start and checksum within their length and salt; rows equal in all of these
    are alike, so a task that runs again gives the same packing.
    """
    columns = pieces.columns
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    if any(not 0 < k <= capacity for k in counts):
        raise ValueError("every piece must have between 1 and `capacity` ids")
    plan = make_plan(counts, capacity)
    # at most `capacity` rows: a length gets as many groups as its pieces fill
    salts = pieces.sparkSession.createDataFrame(
        [(k, -(-n // GROUP)) for k, n in counts.items()], "__l long, __salts long"
    )
    same = [F.col(c) for c in (key, "piece", "start", "ids_crc32")]
    salted = (
        pieces.join(F.broadcast(salts), F.col("length") == F.col("__l"))
        .withColumn("__salt", F.pmod(F.xxhash64(*same), F.col("__salts")))
        .drop("__l", "__salts")
    )
    groups = salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select(
        F.col("length").alias("__length"), F.col("__salt").alias("__group"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"),
    )
    within = Window.partitionBy("length", "__salt").orderBy(*[c.asc_nulls_first() for c in same])
    numbered = salted.withColumn("__row", F.row_number().over(within)).join(
        offsets, (F.col("length") == F.col("__length")) & (F.col("__salt") == F.col("__group"))
    )
    ranked = numbered.select(*columns, (F.col("__base") + F.col("__row") - 1).alias("__rank"))
    return _place(ranked, plan, columns)


def _place(ranked: DataFrame, plan: Plan, columns: list[str]) -> DataFrame:
    table = np.array(sorted(plan.ranges), np.int64).reshape(-1, 5)
    shift = np.int64(1) << np.int64(48)
    starts = table[:, 0] * shift + table[:, 1]
    places = ranked.sparkSession.sparkContext.broadcast((starts, table))

    @F.pandas_udf("sequence_id long, offset long")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        starts, table = places.value
        for length, rank in batches:
            length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
            row = table[np.searchsorted(starts, length * shift + rank, side="right") - 1]
            inside = rank - row[:, 1]
            yield pd.DataFrame(
                {"sequence_id": row[:, 2] + inside // row[:, 3], "offset": row[:, 4] + inside % row[:, 3] * length}
            )

    return ranked.withColumn("__at", place.asNondeterministic()("length", "__rank")).select(*columns, "__at.*")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, with_ids: bool = False, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    pieces = token_pieces(docs, tokenizer_path, capacity, 0, with_ids, key, text)
    return pack(materialise(pieces if with_ids else pieces.drop("ids"), "packing-pieces"), capacity, key)


def sequences(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per sequence: its ids in order and the spans of its pieces. A sequence is at most `capacity` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", key, "piece", "length")))
    gathered = packed.groupBy("sequence_id").agg(parts.alias("p"))
    return gathered.select(
        "sequence_id", F.flatten("p.ids").alias("ids"),
        F.transform("p", lambda x: F.struct(x[key].alias(key), x.piece.alias("piece"), x.offset.alias("offset"), x.length.alias("length"))).alias("spans"),
    )
