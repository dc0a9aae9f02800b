"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

Folding lowers the text, strips marks, maps look-alike letters of other scripts to Latin and, in
words that hold a letter, digits and signs to the letters they stand for. The lexicon is
learned: whole words and beginnings of words whose share among toxic training texts is surely
above that among others, weighted by the lower bound of their log odds. No word is known
beforehand: what the labels of the training rows do not bear out is not in it. Exception phrases
are learned too: pairs of a lexicon word and a neighbour that are surely no commoner in toxic
texts than elsewhere. A match that lies in one does not count. The sum of the weights and the sum for each word of the
text go through a logistic model fitted on the same sample.

Defined cases: a null or empty text has no match and gets the score of such texts. With one
class or no labels at all the lexicon is empty and the score is the class's share; with too few
toxic texts to learn a pattern from it is empty too, and all texts score alike. Repeated rows
are scored alike, null ids stay, an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import add_columns, held_out, sampled_labels
from textloom.llm.rule_ensemble import lasso_logistic
from textloom.session import materialise

#: Labelled training rows of each class from which lexicon and weights are fitted.
PER_CLASS = 6000
#: Lengths of the beginnings of words that may become patterns.
STEMS = range(4, 9)
#: A pattern must occur in so many toxic training texts, so much oftener there than elsewhere (log odds), and
#: so surely (log likelihood ratio against chance; many patterns are tried).
LEAST_TEXTS = 5
LEAST_ODDS = math.log(3)
LEAST_EVIDENCE = 14.0
#: Size of the lexicon, a parameter of the model.
MOST_PATTERNS = 5000

#: Look-alike letters, by the Latin letter they are taken for.
LOOKALIKES = {
    "a": "аɑα", "b": "Ьʙβ", "c": "сϲᴄ", "d": "ԁɗ", "e": "еєεҽ", "g": "ɡց", "h": "һհ", "i": "іıɩι",
    "j": "јʝ", "k": "κкᴋ", "l": "ӏⅼ|", "m": "мᴍ", "n": "ոп", "o": "оοσօ", "p": "рρ", "q": "ԛ",
    "r": "гᴦ", "s": "ѕꜱ", "t": "тτ", "u": "υսц", "v": "νѵ", "w": "ԝω", "x": "хχ", "y": "уγү", "z": "ᴢ",
}
#: Digits and signs, by the letter they stand for inside a word.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}

#: Word pairs that excuse a word of the lexicon, a parameter of the model; none is known beforehand.
MOST_EXCEPTIONS = 2000

_ALIKE = {c: latin for latin, alike in LOOKALIKES.items() for c in alike + alike.upper() if c != "|"}
_LEET = str.maketrans(LEET)
_RUN = re.compile(r"[\w@$!]+")
_SPECIAL = re.compile(r"[0-9@$!]")
_GAP = re.compile(r"[\W_]+")


class _Letters(dict):
    """Code point -> Latin letters without marks; format characters vanish. Filled as letters occur."""

    def __missing__(self, point: int) -> str:
        char = chr(point)
        bare = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        bare = "".join(_ALIKE.get(c, c) for c in bare)
        self[point] = out = "" if unicodedata.category(char) in ("Cf", "Mn", "Me") else bare
        return out


_LETTERS = _Letters()


def _spelt(run: re.Match) -> str:
    """Digits and signs of a run as letters, if it holds a letter; signs at its end stay."""
    word = run.group()
    body = word.rstrip("!$@")
    if not any(map(str.isalpha, body)):
        return word
    return body.translate(_LEET) + word[len(body) :]


def fold_word(word: str) -> str:
    """A word between white space, folded: its parts, each followed by a space."""
    if not word.isascii():
        word = word.translate(_LETTERS)
    word = word.lower()
    if _SPECIAL.search(word):
        word = _RUN.sub(_spelt, word)
    word = word if word.isalpha() else _GAP.sub(" ", word).strip()
    return f"{word} " if word else ""


class _Folds(dict):
    """Folded words, so far as they fit; what is missing is folded anew."""

    def __missing__(self, word: str) -> str:
        if len(self) > 200_000:
            self.clear()
        self[word] = out = fold_word(word)
        return out


_FOLDS = _Folds()


def fold(text: str | None) -> str:
    """Folded words, one space before, between and after."""
    return " " + "".join(map(_FOLDS.__getitem__, (text or "").split()))


def patterns_of(folded: str) -> set[str]:
    """Words (` word `) and beginnings of words (` stem`) of a folded text."""
    out = set()
    for word in set(folded.split()):
        if len(word) > 2:
            out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in STEMS if n <= len(word))
    return out


@dataclass(frozen=True)
class Lexicon:
    """Pattern -> weight, exception phrases, and the logistic model over the sums."""

    weights: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = ()
    coefficients: tuple[float, ...] = (0.0, 0.0, 0.0)
    intercept: float = 0.0

    def matcher(self) -> Matcher:
        return Matcher(self)

    def score_column(self) -> Column:
        """The score over the columns __a, __b and __c of the features."""
        margin = F.lit(self.intercept)
        for name, weight in zip(("__a", "__b", "__c"), self.coefficients):
            margin = margin + F.col(name) * F.lit(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


class Matcher:
    """Aho-Corasick automaton of a lexicon and its exceptions."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for pattern, weight in lexicon.weights:
            self.automaton.add_word(pattern, (len(pattern), weight))
        for phrase in lexicon.exceptions:
            pattern = fold(phrase)
            self.automaton.add_word(pattern, (len(pattern), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def pairs(self, text: str | None) -> set[str]:
        """Pairs of a matched word and the word before or after it that matches nothing itself."""
        if not len(self.automaton):
            return set()
        folded = fold(text)
        starts = sorted({end - length + 1 for end, (length, weight) in self.automaton.iter(folded) if weight is not None})
        if not starts:
            return set()
        words, places = folded.split(), {}
        at = 0
        for number, word in enumerate(words):
            places[at] = number
            at += len(word) + 1
        hit = {places[s] for s in starts if s in places}
        out = set()
        for number in hit:
            for first in (number - 1, number):
                if 0 <= first and first + 1 < len(words) and not (first in hit and first + 1 in hit):
                    out.add(f"{words[first]} {words[first + 1]}")
        return out

    def features(self, text: str | None) -> tuple[float, float, float, int]:
        """log(1 + sum of weights), log(1 + 100 x sum for each word), largest weight, matches."""
        folded = fold(text)
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        if len(self.automaton):
            for end, (length, weight) in self.automaton.iter(folded):
                start = end - length + 1
                if weight is None:
                    excused.append((start, end))
                elif weight > best.get(start, 0.0):
                    best[start] = weight
        for start, end in excused:
            for at in [b for b in best if start <= b < end]:
                del best[at]
        total = sum(best.values())
        words = max(1, folded.count(" ") - 1)
        return math.log1p(total), math.log1p(100 * total / words), max(best.values(), default=0.0), len(best)


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93], np.uint64)


def likeness(text: str | None) -> tuple[int, int]:
    """Two keys, each of the smallest values of three hashes over the three-word runs of a text.

    Near copies mostly share one of them; texts that have only some lines in common do not, as
    they would have to share the smallest value three times.
    """
    words = (text or "").encode().split()
    runs = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs), np.uint64)
    least = [int((hashes * m ^ (hashes >> np.uint64(29))).min()) for m in _MIX]
    return tuple(xxhash.xxh64_intdigest(repr(least[at : at + 3])) >> 1 for at in (0, 3))


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts with each pattern, by class, summed within the task as far as memory allows."""
    toxic, other = Counter(), Counter()

    def flush() -> pd.DataFrame:
        names = list(toxic.keys() | other.keys())
        out = pd.DataFrame(
            {"pattern": names, "toxic": [toxic[p] for p in names], "other": [other[p] for p in names]}
        ).astype({"pattern": "string", "toxic": "int64", "other": "int64"})
        toxic.clear()
        other.clear()
        return out

    for frame in frames:
        for text, y in zip(frame.text, frame.y):
            (toxic if y else other).update(patterns_of(fold(text)))
            if len(toxic) + len(other) > 600_000:
                yield flush()
    yield flush()


def _odds(n_toxic: int, n_other: int) -> tuple[Column, Column]:
    """Log odds of a count row (t, o) between toxic and other texts, and their standard error."""
    t, o = F.col("t") + 0.5, F.col("o") + 0.5
    return F.log(t / (n_toxic + 1.0)) - F.log(o / (n_other + 1.0)), F.sqrt(1 / t + 1 / o)


def learn_lexicon(sample: DataFrame, n_toxic: int, n_other: int) -> Lexicon:
    """Lexicon and exceptions of a bounded sample with columns text and y."""
    counts = (
        sample.select("text", "y").mapInPandas(_count, "pattern string, toxic long, other long")
        .groupBy("pattern").agg(F.sum("toxic").alias("t"), F.sum("other").alias("o"))
    )
    counts = materialise(counts, "toxicity-counts")
    odds, spread = _odds(n_toxic, n_other)
    chance = n_toxic / (n_toxic + n_other)
    share = F.col("t") / (F.col("t") + F.col("o"))
    evidence = F.col("t") * F.log(share / chance) + F.when(
        F.col("o") > 0, F.col("o") * F.log((1 - share) / (1 - chance))
    ).otherwise(0.0)
    telling = counts.where((F.col("t") >= LEAST_TEXTS) & (odds >= LEAST_ODDS) & (evidence >= LEAST_EVIDENCE))
    weighed = telling.select(
        "pattern", "t", F.greatest(odds - 2 * spread, F.lit(1.0)).alias("w"), evidence.alias("e"),
        F.substring("pattern", 1, 5).alias("stem"),
    )

    def clearest(frame: pd.DataFrame) -> pd.DataFrame:
        kept = _clearest(dict(zip(frame.pattern, zip(frame.t, frame.w))))
        return frame[frame.pattern.isin(kept)][["pattern", "w", "e"]]

    # nested patterns share their stem and are reduced to the clearest before the lexicon is bounded
    reduced = weighed.groupBy("stem").applyInPandas(clearest, "pattern string, w double, e double")
    rows = reduced.orderBy(F.desc("w"), F.desc("e"), "pattern").limit(MOST_PATTERNS).collect()
    lexicon = Lexicon(tuple(sorted((r.pattern, round(float(r.w), 6)) for r in rows)))
    return replace(lexicon, exceptions=learn_exceptions(sample, lexicon, n_toxic, n_other))


def learn_exceptions(sample: DataFrame, lexicon: Lexicon, n_toxic: int, n_other: int) -> tuple[str, ...]:
    """Pairs of a lexicon word and a neighbour that are surely no commoner in toxic texts than elsewhere."""
    if not lexicon.weights:
        return ()
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = shared.value.matcher()
        for frame in frames:
            found = [(p, y) for text, y in zip(frame.text, frame.y) for p in matcher.pairs(text)]
            yield pd.DataFrame({"pair": [p for p, _ in found], "y": [y for _, y in found]}).astype({"pair": "string", "y": "int64"})

    pairs = sample.select("text", "y").mapInPandas(count, "pair string, y long")
    counts = pairs.groupBy("pair").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("o"))
    odds, spread = _odds(n_toxic, n_other)
    sure = counts.where(F.col("o") >= LEAST_TEXTS).where(odds + 2 * spread <= 0)
    rows = sure.orderBy(F.desc("o"), "t", "pair").limit(MOST_EXCEPTIONS).collect()
    return tuple(sorted(r.pair for r in rows))


def _clearest(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Of nested patterns the ones that say most: pattern -> weight.

    A beginning whose texts nearly all hold one longer beginning gives way to that one; a longer
    pattern gives way to a beginning that weighs as much.
    """
    grown = set()
    for pattern, (t, _) in found.items():
        if not pattern.endswith(" "):
            for n in range(len(pattern) - 1, 4, -1):
                if pattern[:n] in found and t >= 0.9 * found[pattern[:n]][0]:
                    grown.add(pattern[:n])
    left = {p: w for p, (_, w) in found.items() if p not in grown}
    return {
        p: w for p, w in left.items() if not any(left.get(p[:n], -1.0) >= w - 0.1 for n in range(5, len(p)))
    }


def train(docs: DataFrame, labels: DataFrame, training: Column, per_class: int = PER_CLASS) -> Lexicon:
    """Lexicon and score model from at most `per_class` labelled training rows of each class."""
    target = labels.select("doc_id", F.col("toxic").alias("target"))
    sample = materialise(sampled_labels(target, "target", training, per_class), "toxicity-sample")
    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    share = labels.where(training & F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0]
    share = min(max(0.5 if share is None else float(share), 0.001), 0.999)
    nothing = Lexicon((), intercept=math.log(share / (1 - share)))
    if len(sizes) < 2:
        return nothing
    # of rows that repeat an id, and of near copies, one text counts, chosen by its hash so that every run learns
    # from the same texts; what copies share would look telling
    smallest = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    drawn = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y").agg(smallest)
    keyed = add_columns(
        drawn, [F.col("text")], [F.col("text"), F.col("y")], "k long, k2 long", lambda: lambda texts: [likeness(t) for t in texts]
    )
    rows = F.struct(F.xxhash64("text"), "text")
    once = keyed.groupBy("k", "y").agg(F.min_by(F.struct("text", "k2"), rows).alias("r")).select("y", "r.*")
    drawn = materialise(once.groupBy("k2", "y").agg(smallest).select("text", "y"), "toxicity-texts")
    sizes = {r.y: r["count"] for r in drawn.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return nothing
    lexicon = learn_lexicon(drawn, sizes[1], sizes[0])
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lexicon)
    rows = add_columns(
        drawn, [F.col("text")], [F.col("y")], "a double, b double, c double, n int", _features(shared)
    ).select("a", "b", "c", "y").toPandas()
    x, y = rows[["a", "b", "c"]].to_numpy(float), rows.y.to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        return replace(lexicon, intercept=nothing.intercept)
    order = np.lexsort((y, *x.T))
    w, b = lasso_logistic(x[order], y[order], 1e-4, 3000)
    drawn_share = y.mean()
    b += math.log(share / (1 - share)) - math.log(drawn_share / (1 - drawn_share))
    return replace(lexicon, coefficients=tuple(map(float, w)), intercept=float(b))


def _features(shared):
    def make():
        matcher = shared.value.matcher()
        return lambda texts: [matcher.features(t) for t in texts]

    return make


def score_texts(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, score, n_matches and density (log of weight for each 100 words) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    found = add_columns(
        docs, [F.col(text)], [F.col(key)], "__a double, __b double, __c double, n_matches int", _features(shared)
    )
    return found.select(key, lexicon.score_column().alias("score"), "n_matches", F.col("__b").alias("density"))


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, n_matches, density of every row of `docs`."""
    out = held_out("doc_id", modulus, remainder)
    scored = score_texts(docs, train(docs, labels, ~out))
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", out.alias("held_out"), "score", predicted, "n_matches", "density")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with their own columns."""
    lexicon = train(docs, labels, ~held_out("doc_id", 5, 0))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    # kept within a struct, where no name of theirs can clash
    marked = add_columns(
        docs, [F.col("text")], [F.struct(*docs.columns).alias("__row")],
        "__a double, __b double, __c double, __n int", _features(shared),
    )
    return marked.where(lexicon.score_column() < threshold).select("__row.*")
