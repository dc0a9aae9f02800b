"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and scores of a model file form a trie of two integer arrays over UTF-8 bytes. A text
gets a leading marker, spaces become markers, and it is cut before each run of markers and around
each newline; the cuts are exact as no piece crosses them (this is checked when the trie is built).
The cuts that a worker has not met yet are looked up and solved together, all places at once.
A character without a piece of its own costs the lowest score less ten and is written as bytes.

Of paths with equal scores the one with the longer last piece wins, as in the reference library.
A marker character that stands in the text itself is written as bytes, so decoding gives back
every text exactly.

Defined cases: a null or empty text has no ids and decodes to the empty text. Rows are
independent: repeated rows are treated alike, null ids stay, an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import add_columns

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Cuts whose ids a worker remembers; bytes of new cuts that are solved together.
_CACHE, _TOGETHER = 400_000, 400_000


class DoubleArray:
    """Trie over bytes: the child of state s by byte b is base[s] + b + 1 if check there is s."""

    def __init__(self, words: list[bytes]):
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for number, word in enumerate(words):
            node = 0
            for byte in word:
                following = children[node].get(byte)
                if following is None:
                    following = children[node][byte] = len(children)
                    children.append({})
                    ends.append(-1)
                node = following
            ends[node] = number
        size = 2 * len(children) + 2048
        base, check, value = (np.full(size, -1, np.int32) for _ in range(3))
        base[0], check[0], value[0] = 0, -2, ends[0]
        used = bytearray(size)
        used[0] = 1
        state_of = {0: 0}
        free = 257
        # where to look next for a place, by the number of children: places before were too crowded for so many
        hint = [0] * 258
        for node in self._breadth_first(children):
            if not children[node]:
                continue
            state = state_of[node]
            wanted = [byte + 1 for byte in sorted(children[node])]
            if len(wanted) == 1:
                while free < size and used[free]:
                    free += 1
                hint[1] = free - wanted[0]
            at = hint[len(wanted)]
            while any(used[at + w] for w in wanted):
                at += 1
                if at + 257 >= size:
                    base, check, value = (np.concatenate([x, np.full(size, -1, np.int32)]) for x in (base, check, value))
                    used += bytearray(size)
                    size *= 2
            hint[len(wanted)] = at
            base[state] = at
            for byte, child in children[node].items():
                place = at + byte + 1
                used[place] = 1
                check[place], value[place] = state, ends[child]
                state_of[child] = place
        self.base, self.check, self.value = base, check, value
        self.longest = max(map(len, words), default=0)

    @staticmethod
    def _breadth_first(children: list[dict[int, int]]):
        layer = [0]
        while layer:
            yield from layer
            layer = sorted((c for n in layer for c in children[n].values()), key=lambda n: -len(children[n]))

    def find(self, word: bytes) -> int:
        """Number of a word, -1 if it is none."""
        state = 0
        for byte in word:
            following = int(self.base[state]) + byte + 1
            if self.base[state] < 0 or following >= len(self.check) or self.check[following] != state:
                return -1
            state = following
        return int(self.value[state])


@dataclass
class Pieces:
    """What encoding needs of a model: trie, ids and scores of its words, ids of bytes, texts of ids."""

    trie: DoubleArray
    ids: np.ndarray
    scores: np.ndarray
    unknown: float
    byte_ids: np.ndarray
    texts: list[bytes]
    prefix: bool = True

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        if not all(model.is_byte(int(i)) for i in byte_ids):
            raise ValueError("the model has no byte fallback")
        return cls.build(
            {i: model.id_to_piece(i) for i in plain}, {i: model.get_score(i) for i in plain}, byte_ids, len(every)
        )

    @classmethod
    def build(cls, pieces: dict[int, str], scores: dict[int, float], byte_ids: np.ndarray, size: int) -> Pieces:
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces.values()):
            raise ValueError("a piece crosses a cut between words or lines")
        order = list(pieces)
        texts = [b""] * size
        for i in order:
            texts[i] = pieces[i].replace(MARK, " ").encode()
        for b, i in enumerate(byte_ids.tolist()):
            texts[i] = bytes([b])
        values = np.array([scores[i] for i in order], float)
        trie = DoubleArray([pieces[i].encode() for i in order])
        return cls(trie, np.array(order, np.int64), values, float(values.min()) - UNKNOWN_PENALTY, byte_ids, texts)


_CUT = re.compile(f"{MARK}+[^{MARK}\n\x00]*|[^{MARK}\n\x00]+|\n|\x00")


class Encoder:
    """Encodes texts with a memory of cuts; the memory changes no result."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        cut = [self._cut(t) for t in texts]
        used = set(chain.from_iterable(cut))
        new = used.difference(self.known)
        if len(self.known) + len(new) > _CACHE:
            self.known, new = {}, used
        group: list[str] = []
        size = 0
        for word in new:
            group.append(word)
            size += len(word)
            if size > _TOGETHER:
                self._solve(group)
                group, size = [], 0
        self._solve(group)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in cut]

    def _cut(self, text: str | None) -> list[str]:
        """Cuts of a text. NUL stands for a marker of the text itself, and two NULs for NUL."""
        if not text:
            return []
        if MARK in text or "\x00" in text:
            text = text.replace("\x00", "\x00\x00").replace(MARK, "\x00\x01")
            parts = _CUT.findall(MARK + text.replace(" ", MARK))
            out, at = [], 0
            while at < len(parts):
                if parts[at] != "\x00":
                    out.append(parts[at])
                elif parts[at + 1] == "\x00":
                    out.append("\x00")
                    at += 1
                else:
                    # what follows begins with the place holder; the rest of it is a cut of its own
                    out += ["\x00\x01", *([parts[at + 1][1:]] if len(parts[at + 1]) > 1 else [])]
                    at += 1
                at += 1
            return out
        return _CUT.findall(MARK + text.replace(" ", MARK))

    def _solve(self, words: list[str]) -> None:
        """Best paths of many cuts at once; each has a slot for every byte and one for its end."""
        if not words:
            return
        p, trie = self.pieces, self.pieces.trie
        raw = [MARK.encode() if w == "\x00\x01" else w.encode() for w in words]
        literal = np.array([w == "\x00\x01" for w in words])
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        slots = lengths + 1
        first = np.cumsum(slots) - slots
        data = np.frombuffer(b"\x00".join(raw) + b"\x00", np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(raw)), slots)
        place = np.arange(len(data)) - first[owner]
        inside = place < lengths[owner]
        begins = inside & ((data & 0xC0) != 0x80)
        width = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))

        start = np.flatnonzero(begins & ~literal[owner])
        state = np.zeros(len(start), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        single = np.zeros(len(data), bool)
        for step in range(trie.longest):
            ok = inside[start + step]
            start, state = start[ok], state[ok]
            base = trie.base[state]
            following = base + data[start + step] + 1
            ok = (base >= 0) & (following < len(trie.check))
            following[~ok] = 0
            ok &= trie.check[following] == state
            start, state = start[ok], following[ok].astype(np.int64)
            if not len(start):
                break
            number = trie.value[state]
            hit = number >= 0
            found.append((start[hit], np.full(hit.sum(), step + 1), number[hit].astype(np.int64)))
            single[start[hit][width[start[hit]] == step + 1]] = True
        bare = np.flatnonzero(begins & ~single)
        found.append((bare, width[bare], np.full(len(bare), -1)))
        edge_from, edge_size, edge_piece = (np.concatenate(x) for x in zip(*found))
        edge_score = np.where(edge_piece >= 0, p.scores[edge_piece], p.unknown)

        best = np.full(len(data), -np.inf)
        best[first] = 0
        back_from, back_piece = np.full(len(data), -1), np.full(len(data), -1)
        order = np.argsort(place[edge_from], kind="stable")
        limits = np.searchsorted(place[edge_from][order], np.arange(int(lengths.max()) + 1))
        limits = np.append(limits, len(order))
        for at in np.flatnonzero(np.diff(limits)):
            some = order[limits[at] : limits[at + 1]]
            source = edge_from[some]
            target = source + edge_size[some]
            score = best[source] + edge_score[some]
            better = score > best[target]
            target = target[better]
            best[target] = score[better]
            back_from[target], back_piece[target] = source[better], edge_piece[some][better]

        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        row, at = np.arange(len(raw)), first + lengths
        going = at > first
        row, at = row[going], at[going]
        while len(row):
            steps.append((row, back_from[at], back_piece[at]))
            at = back_from[at]
            going = at > first[row]
            row, at = row[going], at[going]
        rows, starts, found_pieces = (np.concatenate(x[::-1]) for x in zip(*steps))
        by = np.argsort(rows, kind="stable")
        rows, starts, found_pieces = rows[by], starts[by], found_pieces[by]
        times = np.where(found_pieces >= 0, 1, width[starts])
        ids = np.repeat(np.where(found_pieces >= 0, p.ids[found_pieces], 0), times)
        within = np.arange(len(ids)) - np.repeat(np.cumsum(times) - times, times)
        as_bytes = np.repeat(found_pieces < 0, times)
        ids[as_bytes] = p.byte_ids[data[(np.repeat(starts, times) + within)[as_bytes]]]
        ends = np.cumsum(np.bincount(np.repeat(rows, times), minlength=len(raw))) * 4
        out = ids.astype("<u4").tobytes()
        self.known.update((w, out[a:b]) for w, a, b in zip(words, [0, *ends.tolist()], ends.tolist()))


def decode_ids(ids: list[int], texts: list[bytes]) -> str:
    """Text of the ids: bytes joined, markers as spaces, the leading marker taken away."""
    out = b"".join([texts[i] for i in ids]).decode("utf-8", "replace")
    return out[1:] if out.startswith(" ") else out


def encode(docs: DataFrame, pieces: Pieces, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns and `ids`."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def make():
        encoder = Encoder(shared.value)
        return lambda texts: [(np.frombuffer(x, "<i4"),) for x in encoder(texts)]

    return add_columns(docs, [F.col(text)], [F.col(c) for c in keep], "ids array<int>", make)


def decode(rows: DataFrame, pieces: Pieces, keep: list[str], ids: str = "ids") -> DataFrame:
    """`keep` columns, `decoded`, and of the ids: n_tokens, n_byte_tokens and ids_crc32."""
    shared = rows.sparkSession.sparkContext.broadcast(pieces)

    def make():
        texts = shared.value.texts
        from_bytes = np.zeros(len(texts), bool)
        from_bytes[shared.value.byte_ids] = True

        def run(batch: list[list[int] | None]) -> list[tuple]:
            out = []
            for given in batch:
                got = np.array(given or [], "<u4")
                out.append((decode_ids(given or [], texts), len(got), int(from_bytes[got].sum()), zlib.crc32(got.tobytes())))
            return out

        return run

    added = "decoded string, n_tokens long, n_byte_tokens long, ids_crc32 long"
    return add_columns(rows, [F.col(ids)], [F.col(c) for c in keep], added, make)
