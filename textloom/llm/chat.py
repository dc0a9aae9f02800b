"""Chat formatting by token-level assembly.

Each text is escaped and encoded on its own, reserved ids are spliced around it, and the loss
mask follows from prefix sums over the segment lengths. Reserved ids cannot come out of a text.
In the rendered string a control string that occurs in a text gets a backslash after its first
character (one more, if there are some already), so the string too can be read back.

The result holds one row per turn with its place in the conversation. Rows are dealt by range of
(conversation, turn, role, text), so a conversation of any length is spread over as many tasks as
its size asks for; each task encodes its rows and adds up places, and what the ranges before hold
of its first conversation is one row per range. Reading back decodes every turn where it lies;
only the digests of a conversation need its turns in order in one task, which they stream through
as plain bytes.

Defined cases: null text and null role are empty; turns are ordered by turn (null first), then
role, then text, so repeated and tied rows have a fixed order; a null conv_id is a
conversation of its own. A role other than user, assistant and system is written out. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from textloom.session import materialise

CONTROLS = (
    "<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ANS]", "[TURN]", "[ROLE]", "[/TURN]",
)
#: role -> opening and closing control string
TEMPLATE = {"user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>"), "system": ("[SYS]", "[/SYS]")}
TRAINED = "assistant"

#: What begins a turn, and the role it names; a written-out role follows its mark.
_OPENING = {head: role for role, (head, _) in TEMPLATE.items()} | {"[TURN]": ""}

_TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS)
_ESCAPE = re.compile(rf"([<\[])(\\*(?:{_TAILS}))")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*(?:{_TAILS}))")
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


class Assembler:
    """Encodes segments with a byte-level vocabulary; reserved ids follow after its last one."""

    def __init__(self, ranks_path: str, pattern: str, reserved_from: int = 50_257):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        if max(ranks.values()) >= reserved_from:
            raise ValueError("reserved ids overlap the vocabulary")
        self.codec = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.reserved = {c: reserved_from + i for i, c in enumerate(CONTROLS)}
        self.control = {i: c for c, i in self.reserved.items()}
        self.first = reserved_from

    def turn(self, role: str | None, text: str | None) -> tuple[list[int], list[bool], int]:
        """Ids of one turn, its loss mask, and the length of the rendered string."""
        role, content = role or "", escape(text or "")
        if role in TEMPLATE:
            head, tail = TEMPLATE[role]
            texts = ["", content, ""]
            segments = [[self.reserved[head]], self.codec.encode_ordinary(content), [self.reserved[tail]]]
            rendered = len(head) + len(content) + len(tail)
            loss = 1 if role == TRAINED else -1
        else:
            texts = [escape(role), content]
            named, said = map(self.codec.encode_ordinary, texts)
            reserved = [[self.reserved[c]] for c in ("[TURN]", "[ROLE]", "[/TURN]")]
            segments = [reserved[0], named, reserved[1], said, reserved[2]]
            rendered = sum(map(len, texts)) + len("[TURN][ROLE][/TURN]")
            loss = -1
        ends = np.cumsum([len(s) for s in segments])
        mask = np.zeros(ends[-1], bool)
        if loss >= 0:
            mask[ends[loss - 1] : ends[loss]] = True
        return [i for s in segments for i in s], mask.tolist(), rendered

    def render(self, ids: list[int]) -> str:
        """The string of the ids, control strings written out."""
        out, plain = [], []
        for i in [*ids, None]:
            if i is None or i in self.control:
                if plain:
                    out.append(self.codec.decode_bytes(plain).decode())
                    plain = []
                out.append(self.control.get(i, ""))
            else:
                plain.append(i)
        return "".join(out)

    def parse(self, ids: list[int]) -> list[tuple[str, str]]:
        """Role and text of every turn in the ids."""
        roles = {head: role for role, (head, _) in TEMPLATE.items()}
        turns: list[list[str]] = []
        parts: list[str] = []
        plain: list[int] = []
        opened = ""
        for i in ids:
            control = self.control.get(i)
            if control is None:
                plain.append(i)
                continue
            said = unescape(self.codec.decode_bytes(plain).decode())
            plain = []
            if control in roles or control == "[TURN]":
                opened, parts = control, []
            elif control == "[ROLE]":
                parts = [said]
            elif opened:
                turns.append([roles.get(opened) or parts[0], said])
                opened = ""
        return [tuple(t) for t in turns]

    def masked_text(self, ids: list[int], mask: list[bool]) -> str:
        """The text under the loss mask, unescaped run by run."""
        out, plain = [], []
        for i, on in [*zip(ids, mask), (0, False)]:
            if on:
                plain.append(i)
            elif plain:
                out.append(unescape(self.codec.decode_bytes(plain).decode()))
                plain = []
        return "".join(out)

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[list[tuple[str, str]], str, int]:
        """Turns, text under the mask and length of the rendered string; each segment is decoded once.

        The same as parse, masked_text and the length of render, for masks that cover segments
        whole or not at all; other masks go through masked_text.
        """
        turns, lost, size = [], [], 0
        opened, role, after = "", "", 0
        on = np.concatenate(([0], np.cumsum(mask)))
        for at in [*np.flatnonzero(ids >= self.first).tolist(), len(ids)]:
            text = self.codec.decode_bytes(ids[after:at].tolist()).decode() if at > after else ""
            size += len(text)
            said = unescape(text)
            covered = int(on[at] - on[after])
            if covered:
                whole = covered == at - after
                lost.append(said if whole else self.masked_text(ids[after:at].tolist(), mask[after:at].tolist()))
            if at == len(ids):
                break
            control = self.control[int(ids[at])]
            size += len(control)
            if control in _OPENING:
                opened, role = control, _OPENING[control]
            elif control == "[ROLE]":
                role = said
            elif opened:
                turns.append((role, said))
                opened = ""
            after = at + 1
        return turns, "".join(lost), size


def parse_text(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn in a rendered string; the inverse of the template."""
    roles = {head: role for role, (head, _) in TEMPLATE.items()}
    turns, opened, role, at = [], "", "", 0
    for found in _CONTROL.finditer(text):
        control, said = found.group(), unescape(text[at : found.start()])
        at = found.end()
        if control in roles or control == "[TURN]":
            opened, role = control, roles.get(control, "")
        elif control == "[ROLE]":
            role = said
        elif opened:
            turns.append((role, said))
            opened = ""
    return turns


_KEY = ["conv_id", "turn", "role", "text"]


def format_conversations(conversations: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per turn: conv_id, position (from 1), turn, role, ids, loss_mask, token_start, char_start, n_chars.

    The ids of a conversation are the ids of its rows by position; the first row opens with `<s>`.
    """
    rows = conversations.select(*_KEY)
    fields = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType(
        fields
        + T.StructType.fromDDL(
            "ids array<int>, loss_mask array<boolean>, n_chars long, n_tokens long, "
            "part int, place long, tokens_before long, chars_before long"
        ).fields
    )
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assembler, part = _assembler(ranks_path, pattern), TaskContext.get().partitionId()
        open_, place, tokens, chars = object(), 0, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                out = []
                for conv, role, text in zip(*(some.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                    if conv != open_:
                        open_, place, tokens, chars = conv, 0, 0, 0
                    ids, mask, size = assembler.turn(role, text)
                    out.append((ids, mask, size, len(ids), part, place, tokens, chars))
                    place, tokens, chars = place + 1, tokens + len(ids), chars + size
                new = [pa.array(c, type=f.type) for c, f in zip(zip(*out), list(target)[3:])]
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in ("conv_id", "turn", "role")], *new], schema=target)

    valid = [F.make_valid_utf8(c).alias(c) for c in ("role", "text")]
    dealt = rows.select("conv_id", "turn", *valid).repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
    encoded = materialise(dealt.mapInArrow(run, schema), "chat-turns")
    conv = F.struct("conv_id")
    ends = encoded.groupBy("part").agg(F.min(conv).alias("low"), F.max(conv).alias("high"))
    ends = materialise(ends.withColumnRenamed("part", "of"), "chat-ranges")
    # at most two rows per range: its first and its last conversation
    met = encoded.join(F.broadcast(ends), F.col("part") == F.col("of")).where((conv == F.col("low")) | (conv == F.col("high")))
    totals = met.groupBy("part", "conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"), F.sum("n_chars").alias("chars")
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("n", "tokens", "chars")]
    offsets = materialise(totals.select(F.col("part").alias("at"), F.col("conv_id").alias("of"), *sums), "chat-offsets")
    same = (F.col("part") == F.col("at")) & F.col("conv_id").eqNullSafe(F.col("of"))
    placed = encoded.join(F.broadcast(offsets), same, "left")

    def sum_of(within: str, before: str) -> Column:
        return F.col(within) + F.coalesce(before, F.lit(0))

    position = sum_of("place", "n") + 1
    first = position == 1
    begin, off = F.array(F.lit(50_257 + CONTROLS.index("<s>"))), F.array(F.lit(False))
    return placed.select(
        "conv_id",
        position.alias("position"),
        "turn",
        "role",
        F.when(first, F.concat(begin, "ids")).otherwise(F.col("ids")).alias("ids"),
        F.when(first, F.concat(off, "loss_mask")).otherwise(F.col("loss_mask")).alias("loss_mask"),
        F.when(first, 0).otherwise(sum_of("tokens_before", "tokens") + 1).alias("token_start"),
        F.when(first, 0).otherwise(sum_of("chars_before", "chars") + len("<s>")).alias("char_start"),
        F.when(first, F.col("n_chars") + len("<s>")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


_KNOWN: dict = {}


def _assembler(ranks_path: str, pattern: str) -> Assembler:
    """One assembler per Python worker."""
    if (ranks_path, pattern) not in _KNOWN:
        _KNOWN[ranks_path, pattern] = Assembler(ranks_path, pattern)
    return _KNOWN[ranks_path, pattern]


def decoded(formatted: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per row of formatted conversations what its ids and mask say: turns as bytes, text under the mask, counts.

    `lost` is null where it is the last turn's text whole, which `said` holds from `lost_from` on.
    """
    schema = T.StructType(
        [formatted.schema["conv_id"], formatted.schema["position"]]
        + T.StructType.fromDDL(
            "n_turns int, said binary, lost_from int, lost binary, lost_chars long, chars long, tokens long, masked long"
        ).fields
    )
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assembler = _assembler(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                out = []
                for row in range(some.num_rows):
                    ids = some.column("ids")[row].values.to_numpy()
                    mask = some.column("loss_mask")[row].values.to_numpy(zero_copy_only=False)
                    turns, lost, size = assembler.read(ids, mask)
                    said = "".join(f"{role}\n{text}\n" for role, text in turns).encode()
                    under = lost.encode()
                    start = len(said) - 1 - len(under)
                    whole = start >= 0 and said[start:-1] == under
                    out.append((
                        len(turns), said, start if whole else None, None if whole else under,
                        len(lost), size, len(ids), int(mask.sum()),
                    ))
                new = [pa.array(c, type=f.type) for c, f in zip(zip(*out), list(target)[2:])]
                yield pa.RecordBatch.from_arrays([some.column("conv_id"), some.column("position"), *new], schema=target)

    return formatted.select("conv_id", "position", "ids", "loss_mask").mapInArrow(run, schema)


def read_back(formatted: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digests of each conversation, decoded from ids and mask alone."""
    schema = T.StructType([formatted.schema["conv_id"], *T.StructType.fromDDL("turns_sha256 string, loss_sha256 string").fields])
    target = to_arrow_schema(schema)
    rows = materialise(decoded(formatted, ranks_path, pattern), "chat-decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said = lost = conv = None
        for batch in batches:
            done = []
            for at in range(0, batch.num_rows, 256):
                columns = (batch.column(c).slice(at, 256).to_pylist() for c in ("conv_id", "position", "said", "lost_from", "lost"))
                for name, position, text, start, under in zip(*columns):
                    if position == 1:
                        if said:
                            done.append((conv, said.hexdigest(), lost.hexdigest()))
                        conv, said, lost = name, hashlib.sha256(), hashlib.sha256()
                    said.update(text)
                    lost.update(text[start:-1] if under is None else under)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done), target)], schema=target)
        if said:
            last = (conv, said.hexdigest(), lost.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(last, target)], schema=target)

    ordered = rows.select("conv_id", "position", "said", "lost_from", "lost").repartition("conv_id")
    digests = ordered.sortWithinPartitions("conv_id", "position").mapInArrow(run, schema)
    counts = rows.groupBy(F.col("conv_id").alias("of")).agg(
        F.sum("n_turns").alias("n_turns"), F.sum("lost_chars").alias("loss_chars"), F.sum("chars").alias("formatted_chars"),
        F.sum("tokens").alias("n_tokens"), F.sum("masked").alias("loss_tokens"),
    )
    return digests.join(counts, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "loss_tokens"
    )
