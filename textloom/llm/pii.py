"""Personal data by rules and by a character-level bidirectional LSTM with CRF transitions.

The rules give the base spans. Windows around them, labelled character by character, train the
network in numpy, once as they stand and then with their spans rewritten in forms that the rules
miss: addresses with "(at)" and "dot", numbers of an ip set apart by commas, blanks or brackets,
cards grouped by other marks, phones without their plus. Windows without a span, and some with
numbers that are none of these, teach it what to leave alone.

A text is cut into overlapping windows; the network decodes every window that holds a digit, an @
or an "at" that may stand for one. Every character takes the tag of the window in whose middle it
lies most, and spans are read from the tags of the whole text. Where a span starts and ends is the
network's work; a check of content alone follows (the sum of a card, the range of an ip, the
number of digits of a phone, an address that reads as one). Spans that overlap no base span and
pass it are added; base spans stay as they are.

Defined cases: a null text is empty and has no span. Rows are independent: repeated rows are
treated alike, null ids stay, an empty table gives an empty result. Without a single
labelled window the network adds nothing. Long texts are decoded a bounded number of windows at a
time. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import add_columns, fresh
from textloom.session import materialise

KINDS = ("email", "ip", "card", "phone")
#: Windows of each kind, and of none, on which the network is trained.
PER_KIND = 240
WIDTH, STRIDE = 96, 48
_BATCH = 1024

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive repeats and the look-behind change no match; they keep long digit runs linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What a window must hold to be decoded; the second part stands for an @ written in words.
_TRIGGER = re.compile(r"[0-9@]|[(\[{<] ?at ?[)\]}>]|(?<=\w) at (?=[\w-]+(?: dot |\.| ?[(\[{<] ?dot))", re.IGNORECASE)

#: A window without a base span that shows this may hide one: it teaches nothing, neither way.
_UNSURE = re.compile(
    r"[0-9](?:[^0-9A-Za-z\n]{0,3}[0-9]){7}|[0-9]{1,3}(?:[^0-9A-Za-z\n]{1,3}[0-9]{1,3}){3}|@|[(\[{<] ?at ?[)\]}>]| at \S+ dot ",
    re.IGNORECASE,
)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: the whole run of local characters before an @ that has a domain."""
    after = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at) if at > after and text[at - 1] in _LOCAL else None
        if domain:
            start = at
            while start > after and text[start - 1] in _LOCAL:
                start -= 1
            after = domain.end()
            yield start, after
        at = text.find("@", max(at + 1, after))


def base_spans(text: str | None) -> list[Span]:
    """Spans of the rules, by kind as listed, then by start."""
    if not text or not _TRIGGER.search(text):
        return []
    out: list[Span] = [("email", *s) for s in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# ---- the network ----

_KNOWN = {chr(c): c - 31 for c in range(32, 127)} | {"\n": 96}
_LETTER, _OTHER, _PAD, _VOCABULARY = 97, 98, 0, 99
TAGS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))


def encode(text: str) -> np.ndarray:
    return np.array([_KNOWN.get(c) or (_LETTER if c.isalpha() else _OTHER) for c in text], np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Network:
    """Embedding, two LSTMs, emissions and transitions. All arrays are in `p`."""

    p: dict[str, np.ndarray]
    hidden: int = 20

    @classmethod
    def fresh(cls, hidden: int = 20, width: int = 12, seed: int = 3) -> Network:
        draw = np.random.default_rng(seed)
        tags = len(TAGS)

        def normal(*shape: int) -> np.ndarray:
            return (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        p = {"embed": normal(_VOCABULARY, width) * 3, "out": normal(2 * hidden, tags)}
        for d in ("f", "b"):
            p[f"w{d}"] = normal(width, 4 * hidden)
            p[f"u{d}"] = normal(hidden, 4 * hidden)
            p[f"c{d}"] = np.zeros(4 * hidden, np.float32)
            p[f"c{d}"][hidden : 2 * hidden] = 1
        p["bias"] = np.zeros(tags, np.float32)
        p["move"] = np.zeros((tags, tags), np.float32)
        return cls(p, hidden)

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (time, batch, hidden) of one direction, and what the backward pass needs."""
        t, n, _ = x.shape
        h = self.hidden
        wx = x @ self.p[f"w{d}"] + self.p[f"c{d}"]
        u = self.p[f"u{d}"]
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out = np.empty((t, n, h), np.float32)
        saved = []
        for step in range(t) if d == "f" else range(t - 1, -1, -1):
            z = wx[step] + state @ u
            gates = _sigmoid(z[:, : 3 * h])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            g = np.tanh(z[:, 3 * h :])
            before, entered = cell, state
            cell = f * before + i * g
            squashed = np.tanh(cell)
            state = o * squashed
            out[step] = state
            if keep:
                saved.append((step, i, f, o, g, before, entered, squashed))
        return out, saved

    def _lstm_back(self, x, saved, d: str, grad_out: np.ndarray, grads: dict) -> np.ndarray:
        u = self.p[f"u{d}"]
        n, h = grad_out.shape[1:]
        dz_all = np.zeros((*grad_out.shape[:2], 4 * h), np.float32)
        dh, dc = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        du = np.zeros_like(u)
        for step, i, f, o, g, before, entered, squashed in reversed(saved):
            dh = dh + grad_out[step]
            dc = dc + dh * o * (1 - squashed**2)
            dz = dz_all[step]
            dz[:, :h] = dc * g * i * (1 - i)
            dz[:, h : 2 * h] = dc * before * f * (1 - f)
            dz[:, 2 * h : 3 * h] = dh * squashed * o * (1 - o)
            dz[:, 3 * h :] = dc * i * (1 - g**2)
            du += entered.T @ dz
            dh, dc = dz @ u.T, dc * f
        grads[f"u{d}"] = du
        grads[f"w{d}"] = np.einsum("tne,tnz->ez", x, dz_all, optimize=True)
        grads[f"c{d}"] = dz_all.sum(axis=(0, 1))
        return dz_all @ self.p[f"w{d}"].T

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Scores (time, batch, tag) of windows given as (batch, time)."""
        x = self.p["embed"][codes.T]
        both = np.concatenate([self._lstm(x, "f", False)[0], self._lstm(x, "b", False)[0]], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    def decode(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best tag sequence of each window by Viterbi; places beyond a window's length are O."""
        scores = self.emissions(codes)
        t, n, tags = scores.shape
        best = scores[0].copy()
        back = np.zeros((t, n, tags), np.int8)
        for step in range(1, t):
            moves = best[:, :, None] + self.p["move"][None]
            back[step] = moves.argmax(axis=1)
            stepped = moves.max(axis=1) + scores[step]
            best = np.where((step < lengths)[:, None], stepped, best)
        out = np.zeros((n, t), np.int8)
        tag = best.argmax(axis=1)
        for step in range(t - 1, -1, -1):
            here = step < lengths
            out[here, step] = tag[here]
            tag = np.where(here, back[step][np.arange(n), tag], tag)
        return out

    def loss_and_grads(self, codes: np.ndarray, gold: np.ndarray):
        """Mean negative log likelihood of full windows and its gradient."""
        x = self.p["embed"][codes.T]
        hf, saved_f = self._lstm(x, "f", True)
        hb, saved_b = self._lstm(x, "b", True)
        both = np.concatenate([hf, hb], axis=2)
        e = (both @ self.p["out"] + self.p["bias"]).astype(np.float64)
        move = self.p["move"].astype(np.float64)
        t, n, tags = e.shape
        gold = gold.T
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        jump = np.exp(move)
        alpha[0] = e[0]
        for s in range(1, t):
            top = alpha[s - 1].max(axis=1, keepdims=True)
            alpha[s] = np.log(np.exp(alpha[s - 1] - top) @ jump) + top + e[s]
        for s in range(t - 2, -1, -1):
            after = e[s + 1] + beta[s + 1]
            top = after.max(axis=1, keepdims=True)
            beta[s] = np.log(np.exp(after - top) @ jump.T) + top
        top = alpha[-1].max(axis=1)
        total = np.log(np.exp(alpha[-1] - top[:, None]).sum(axis=1)) + top
        rows = np.arange(n)
        d_e = np.exp(alpha + beta - total[None, :, None])
        d_move = np.zeros_like(move)
        said = e[0, rows, gold[0]].copy()
        for s in range(1, t):
            before, after = alpha[s - 1], e[s] + beta[s]
            m1, m2 = before.max(axis=1, keepdims=True), after.max(axis=1, keepdims=True)
            weight = np.exp(m1[:, 0] + m2[:, 0] - total)[:, None]
            d_move += jump * (np.exp(before - m1).T @ (np.exp(after - m2) * weight))
            np.add.at(d_move, (gold[s - 1], gold[s]), -1)
            said += move[gold[s - 1], gold[s]] + e[s, rows, gold[s]]
        for s in range(t):
            d_e[s, rows, gold[s]] -= 1
        d_e = (d_e / n).astype(np.float32)
        grads = {"move": (d_move / n).astype(np.float32), "bias": d_e.sum(axis=(0, 1))}
        grads["out"] = np.einsum("tnh,tny->hy", both, d_e, optimize=True)
        d_both = d_e @ self.p["out"].T
        h = self.hidden
        dx = self._lstm_back(x, saved_f, "f", d_both[:, :, :h], grads)
        dx += self._lstm_back(x, saved_b, "b", d_both[:, :, h:], grads)
        grads["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(grads["embed"], codes.T, dx)
        return float((total - said).mean()), grads


def fit(windows: list[tuple[str, list[Span]]], epochs: int = 12, batch: int = 64, rate: float = 0.02, seed: int = 3) -> Network | None:
    """Adam on the likelihood of the windows' tags; None without a window that holds a span."""
    if not any(spans for _, spans in windows):
        return None
    codes = np.full((len(windows), WIDTH), _PAD, np.int64)
    gold = np.zeros((len(windows), WIDTH), np.int64)
    for row, (text, spans) in enumerate(windows):
        codes[row, : len(text)] = encode(text[:WIDTH])
        for kind, start, end in spans:
            tag = 1 + 2 * KINDS.index(kind)
            gold[row, start:end] = tag + 1
            gold[row, start] = tag
    network = Network.fresh(seed=seed)
    draw = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in network.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in network.p.items()}
    step, steps = 0, epochs * -(-len(windows) // batch)
    for _ in range(epochs):
        order = draw.permutation(len(windows))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            _, grads = network.loss_and_grads(codes[part], gold[part])
            size = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            step += 1
            now = rate * (1 - step / (steps + 1)) + 1e-4
            for k, g in grads.items():
                g = g * min(1.0, 5 / (size + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.99 * v2[k] + 0.01 * g * g
                network.p[k] = (
                    network.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-6)
                ).astype(np.float32)
    return network


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an @; the windows of a text lie STRIDE apart."""
    last = max(0, -(-(len(text) - WIDTH) // STRIDE))
    wanted: set[int] = set()
    for m in _TRIGGER.finditer(text):
        high = min(last, m.start() // STRIDE)
        wanted.update(range(max(0, -(-(m.start() - WIDTH + 1) // STRIDE)), high + 1))
    return [w * STRIDE for w in sorted(wanted)]


_AT = re.compile(r"\s*[(\[{<]\s*at\s*[)\]}>]\s*|\s+at\s+|\s*@\s*", re.IGNORECASE)
_DOT = re.compile(r"\s*[(\[{<]\s*(?:dot|\.)\s*[)\]}>]\s*|\s+dot\s+|\s*\.\s*", re.IGNORECASE)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")


def _plausible(kind: str, text: str) -> bool:
    """The check of content that a span of the network must pass."""
    digits = _digits(text)
    if kind == "email":
        return bool(_ADDRESS.fullmatch(_DOT.sub(".", _AT.sub("@", text))))
    if re.search(r"[^\W\d_]", text):
        return False
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and digits != text


def reconcile(tags: dict[int, np.ndarray], length: int, size: int) -> list[Span]:
    """Spans of a text from the tags of its windows (start -> tags).

    A character's tag comes from the window that has most context around it; ties go to the
    earlier window.
    """
    spans: list[Span] = []
    starts = sorted(tags)
    at = 0
    while at < len(starts):
        group = [starts[at]]
        while at + 1 < len(starts) and starts[at + 1] < group[-1] + size:
            at += 1
            group.append(starts[at])
        at += 1
        low, high = group[0], min(length, group[-1] + size)
        chosen, margin = np.zeros(high - low, np.int8), np.full(high - low, -1)
        for start in group:
            n = min(size, length - start)
            place = np.arange(n)
            # the ends of the text are no cut, so nothing is missing there
            left = np.where(start == 0, size, place)
            right = np.where(start + n == length, size, n - 1 - place)
            room = np.minimum(left, right)
            part = slice(start - low, start - low + n)
            better = room > margin[part]
            chosen[part][better] = tags[start][:n][better]
            margin[part][better] = room[better]
        kind = (chosen + 1) // 2
        begin = (kind > 0) & ((chosen % 2 == 1) | (np.concatenate(([0], kind[:-1])) != kind))
        for start in np.flatnonzero(begin).tolist():
            end = start + 1
            while end < len(kind) and kind[end] == kind[start] and not begin[end]:
                end += 1
            spans.append((KINDS[kind[start] - 1], low + start, low + end))
    return spans


def find(texts: list[str | None], network: Network | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    base = [base_spans(t) for t in texts]
    if network is None:
        return [(b, []) for b in base]
    places = [(row, start) for row, t in enumerate(texts) if t for start in window_starts(t)]
    tags: list[dict[int, np.ndarray]] = [{} for _ in texts]
    for at in range(0, len(places), _BATCH):
        part = places[at : at + _BATCH]
        codes = np.full((len(part), WIDTH), _PAD, np.int64)
        lengths = np.zeros(len(part), np.int64)
        for i, (row, start) in enumerate(part):
            window = encode(texts[row][start : start + WIDTH])
            codes[i, : len(window)], lengths[i] = window, len(window)
        for (row, start), found in zip(part, network.decode(codes, lengths)):
            tags[row][start] = found
    out = []
    for text, own, seen in zip(texts, base, tags):
        added = []
        if any(found.any() for found in seen.values()):
            taken = sorted((s, e) for _, s, e in own)
            for kind, start, end in reconcile(seen, len(text), WIDTH):
                while end > start and text[end - 1].isspace():
                    end -= 1
                while start < end and text[start].isspace():
                    start += 1
                if _plausible(kind, text[start:end]) and not any(s < end and start < e for s, e in taken):
                    added.append((kind, start, end))
        out.append((own, added))
    return out


# ---- Spark ----


def _label_windows(texts: list[str | None]) -> list[tuple]:
    """For training: windows around each base span and around other triggers, with what they show."""
    out = []
    for text in texts:
        spans = base_spans(text)
        rows = []
        covered = sorted((s, e) for _, s, e in spans)
        for kind, start, end in spans:
            if end - start <= WIDTH // 2:
                low = max(0, start - (start * 7 + end) % (WIDTH - (end - start)))
                inside = [
                    (k, s - low, e - low) for k, s, e in spans if s >= low and e <= min(low + WIDTH, len(text))
                ]
                # a span that the window cuts would be labelled wrongly
                if not any(s < low < e or s < low + WIDTH < e for s, e in covered):
                    rows.append((kind, text[low : low + WIDTH], [f"{k}:{s}:{e}" for k, s, e in inside]))
        for start in window_starts(text or ""):
            window = text[start : start + WIDTH]
            if not any(s < start + WIDTH and start < e for s, e in covered) and not _UNSURE.search(window):
                rows.append(("none", window, []))
        out.append((rows,))
    return out


def _pick(draw: np.random.Generator, *choices: str) -> str:
    return choices[draw.integers(len(choices))]


def rewritten(kind: str, body: str, draw: np.random.Generator) -> str:
    """A span in a form that the rules miss."""
    digits = _digits(body)
    if kind == "email":
        local, _, domain = body.rpartition("@")
        at, dot = [
            ("(at)", "."), (" (at) ", "."), ("[at]", "."), (" [at] ", "."), (" @ ", "."), (" at ", "."), ("{at}", "."),
            (" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"),
        ][draw.integers(12)]
        if draw.random() < 0.2:
            at, dot = at.upper(), dot.upper()
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return _pick(draw, ",", ", ", " . ", ". ", "[.]", "(.)", " ", " .", ":").join(body.split("."))
    if kind == "card":
        mark = _pick(draw, ".", "/", "_", " - ", "  ", ", ", "\u2013")
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    # a phone: the plus goes, the country number may, and other marks stand between the groups
    groups = re.findall(r"[0-9]+", body)
    if len(groups) < 2:
        groups = [digits[:2], digits[2:5], digits[5:]]
    mark = _pick(draw, " ", "-", ".", "/")
    national = len(groups) > 2 and len("".join(groups[1:])) >= 8
    shape = draw.integers(4)
    if shape == 0 and national:
        return f"(0{groups[1]}) " + mark.join(groups[2:])
    if shape == 1 and national:
        return f"0{groups[1]}" + _pick(draw, "/", " ", "-") + mark.join(groups[2:])
    if shape == 2:
        return "00" + mark.join(groups)
    return mark.join(groups)


def decoy(draw: np.random.Generator) -> str:
    """Numbers and words that are no personal data, in forms near to those that are."""
    n = lambda low, high: int(draw.integers(low, high))
    return [
        lambda: f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}",
        lambda: f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2100)}",
        lambda: f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02} {n(0, 24):02}:{n(0, 60):02}:{n(0, 60):02}",
        lambda: f"{n(0, 24)}:{n(0, 60):02}",
        lambda: f"{n(1, 999)},{n(0, 1000):03},{n(0, 1000):03}",
        lambda: f"{n(1, 20)}.{n(0, 20)}.{n(0, 20)}",
        lambda: ", ".join(str(n(1, 400)) for _ in range(n(2, 9))),
        lambda: " ".join(str(n(1, 3000)) for _ in range(n(2, 8))),
        lambda: f"{n(10**8, 10**12)}",
        lambda: f"{n(1, 100)}.{n(0, 10**6)}",
        lambda: f"{n(1900, 2000)}-{n(2000, 2100)}",
        lambda: f"pp. {n(1, 500)}-{n(500, 999)}",
        lambda: f"[{n(1, 60)}]",
        lambda: "looked at the shore. then",
        lambda: "sold at market.example",
        lambda: f"met at {n(1, 12)} at the dot",
        lambda: f"ISBN 978-{n(0, 10)}-{n(100, 1000)}-{n(10000, 100000)}-{n(0, 10)}",
    ][draw.integers(17)]()


def varied(text: str, spans: list[Span], draw: np.random.Generator) -> tuple[str, list[Span]]:
    """A training window with its spans in other forms; as it is, where they would not fit any more."""
    parts, moved, after = [], [], 0
    size = 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        if start < after:
            return text, spans
        body = rewritten(kind, text[start:end], draw)
        between = _sprinkled(text[after:start], draw)
        parts += [between, body]
        size += len(between)
        moved.append((kind, size, size + len(body)))
        size += len(body)
        after = end
    new = "".join(parts) + _sprinkled(text[after:], draw)
    return (new[:WIDTH], moved) if all(e <= WIDTH for _, _, e in moved) else (text, spans)


def _sprinkled(text: str, draw: np.random.Generator) -> str:
    """The text between spans, sometimes with a decoy in the place of a word."""
    words = text.split(" ")
    if len(words) > 2 and draw.random() < 0.4:
        words[draw.integers(1, len(words) - 1)] = decoy(draw)
        new = " ".join(words)
        return text if base_spans(new) else new
    return text


def with_decoys(text: str, draw: np.random.Generator) -> str:
    """A window without a span, with some of its words replaced by decoys."""
    words = text.split(" ")
    for _ in range(draw.integers(1, 4)):
        words[draw.integers(len(words))] = decoy(draw)
    new = " ".join(words)[:WIDTH]
    return text if base_spans(new) else new


def lesson(drawn: list[tuple[str, str, list[Span]]], seed: int = 9) -> list[tuple[str, list[Span]]]:
    """Training windows: those drawn, as (kind, text, spans), and forms of them that the rules do not know."""
    draw = np.random.default_rng(seed)
    windows: list[tuple[str, list[Span]]] = []
    for kind, text, spans in drawn:
        windows.append((text, spans))
        if kind == "none":
            windows += [(with_decoys(text, draw), []) for _ in range(2)]
        else:
            windows += [varied(text, spans, draw) for _ in range(3)]
    return windows


def train(docs: DataFrame, text: str = "text", per_kind: int = PER_KIND) -> Network | None:
    """Fits on at most `per_kind` windows of each kind and of none, drawn by hash from all texts."""
    rows = add_columns(
        docs.where(F.col(text).rlike("[0-9@]")), [F.col(text)], [],
        "__w array<struct<kind:string,window:string,labels:array<string>>>", lambda: _label_windows,
    ).select(F.inline("__w")).withColumn("place", F.xxhash64("window"))
    rows = materialise(rows, "pii-windows")
    # a share of each kind's different windows by hash, so that what meets in a task does not grow with the
    # corpus; copies do not count, as they share one hash
    near = F.lit(False)
    for row in rows.groupBy("kind").agg(F.approx_count_distinct("place").alias("n")).collect():
        limit = -(2**63) + int(min(1.0, 4 * per_kind / max(1, row.n)) * (2**64 - 1))
        near = near | ((F.col("kind") == row.kind) & (F.col("place") <= min(limit, 2**63 - 1)))
    order = Window.partitionBy("kind").orderBy("place", "window")
    ranked = rows.where(near).distinct().withColumn("n", F.row_number().over(order))
    drawn = ranked.where(F.col("n") <= per_kind).orderBy("kind", "n").collect()
    lessons = [
        (row.kind, row.window, [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in row.labels)]) for row in drawn
    ]
    return fit(lesson(lessons))


SPANS = "array<struct<kind:string,start:int,end:int>>"


def with_spans(docs: DataFrame, network: Network | None, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns and the arrays `base_spans` and `added_spans` (code points, end exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    return add_columns(
        docs, [F.col(text)], [F.col(c) for c in keep], f"base_spans {SPANS}, added_spans {SPANS}",
        lambda: lambda texts: find(texts, shared.value),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with every span replaced by its kind in brackets; n_chars, if there is one, follows."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, text))

    def make():
        def run(texts: list[str | None]) -> list[tuple]:
            return [(None if t is None else masked(t, b + a),) for t, (b, a) in zip(texts, find(texts, shared.value))]

        return run

    columns = docs.columns
    row, said = fresh(docs, "__row", "__text")
    done = add_columns(docs, [F.col(text)], [F.struct(*columns).alias(row)], f"{said} string", make)
    out = done.select(f"{row}.*", said).withColumn(text, F.col(said))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length(text).cast(kind)))
    return out.select(*columns)


def masked(text: str, spans: list[Span]) -> str:
    """The text with spans replaced; spans that overlap are replaced together, named by the first."""
    out, after = [], 0
    open_: list | None = None
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if open_ and start < open_[2]:
            open_[2] = max(open_[2], end)
            continue
        if open_:
            out += [text[after : open_[1]], f"[{open_[0].upper()}]"]
            after = open_[2]
        open_ = [kind, start, end]
    if open_:
        out += [text[after : open_[1]], f"[{open_[0].upper()}]"]
        after = open_[2]
    return "".join(out) + text[after:]
