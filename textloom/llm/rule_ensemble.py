"""Quality classifier: a sparse ensemble of rules.

Shallow trees are boosted on a bounded sample of labelled rows; every path from a root is a
conjunctive rule over the statistics of a text. A logistic model with a lasso penalty picks a
few of them, and those are compiled into one Spark column expression over the statistics.

Defined cases: a null or empty text has statistics of zero and is scored by the rules that hold
for them. If the labelled rows hold one class only, or none, the score is that class's share
(0.5 for none). Repeated rows are scored alike, null ids stay, an empty table gives an empty
result. Labels are read by id; a label without 0 or 1 is left out. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import add_columns, held_out, sampled_labels
from textloom.llm.stats import FEATURES, statistics
from textloom.session import materialise

#: Labelled training rows of each class from which the model is fitted.
PER_CLASS = 5000

Condition = tuple[int, bool, float]  # feature, True for "at most", threshold


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return add_columns(
        docs, [F.col(text)], [F.col(key)], ", ".join(f"{f} double" for f in FEATURES),
        lambda: lambda texts: [statistics(t) for t in texts],
    )


def _cuts(x: np.ndarray, most: int = 24) -> list[np.ndarray]:
    """Thresholds to try for each column: middles between neighbouring quantiles."""
    out = []
    for column in x.T:
        values = np.unique(np.quantile(column, np.linspace(0, 1, most + 1)))
        out.append((values[1:] + values[:-1]) / 2)
    return out


def _grow(x, residual, weight, cuts, rows, path: tuple[Condition, ...], depth: int, least: int, rules: set, leaves: list):
    """One regression tree on the residuals; adds every path below the root to `rules`."""
    if path:
        rules.add(tuple(sorted(path)))
    best = None
    if depth and len(rows) >= 2 * least:
        r, w = residual[rows], weight[rows]
        total_r, total_w = r.sum(), w.sum()
        base = total_r * total_r / (total_w + 1)
        for f, tried in enumerate(cuts):
            if not len(tried):
                continue
            place = np.searchsorted(tried, x[rows, f], side="left")  # x <= tried[i] for all i >= place
            size = len(tried) + 1
            n = np.cumsum(np.bincount(place, minlength=size))[:-1]
            left_r = np.cumsum(np.bincount(place, r, size))[:-1]
            left_w = np.cumsum(np.bincount(place, w, size))[:-1]
            gain = left_r**2 / (left_w + 1) + (total_r - left_r) ** 2 / (total_w - left_w + 1) - base
            gain[(n < least) | (len(rows) - n < least)] = -1
            i = int(np.argmax(gain))
            if gain[i] > 1e-6 and (best is None or gain[i] > best[0]):
                best = (gain[i], f, float(tried[i]))
    if best is None:
        leaves.append((rows, residual[rows].sum() / (weight[rows].sum() + 1)))
        return
    _, f, cut = best
    low = x[rows, f] <= cut
    for side, part in ((True, rows[low]), (False, rows[~low])):
        _grow(x, residual, weight, cuts, part, (*path, (f, side, cut)), depth - 1, least, rules, leaves)


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, seed: int = 5):
    """Paths of boosted trees, each grown on half of the rows."""
    draw = np.random.default_rng(seed)
    cuts, rules = _cuts(x), set()
    margin = np.zeros(len(y))
    least = max(5, len(y) // 200)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.sort(draw.permutation(len(y))[: max(2, len(y) // 2)])
        leaves: list = []
        tree: set = set()
        _grow(x, y - p, p * (1 - p), cuts, rows, (), depth, least, tree, leaves)
        rules |= tree
        for part, value in leaves:
            margin[part] += rate * np.clip(value, -4, 4)
    return sorted(rules)


def holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, low, cut in rule:
        out &= (x[:, f] <= cut) if low else (x[:, f] > cut)
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient steps."""
    n = len(y)
    step = 4 * n / max(1e-9, np.linalg.norm(np.c_[z, np.ones(n)], 2) ** 2)
    w = v = np.zeros(z.shape[1])
    b = c = 0.0
    t = 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        moved = v - step * (z.T @ error) / n
        w_next = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        b_next = c - step * error.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
    return w, b


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[tuple[tuple[Condition, ...], float], ...]
    intercept: float

    def score_column(self) -> Column:
        """The score as a Spark expression over the statistics."""
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            held = F.lit(True)
            for f, low, cut in rule:
                held = held & (F.col(FEATURES[f]) <= cut if low else F.col(FEATURES[f]) > cut)
            margin = margin + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            margin += weight * holds(rule, x)
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, share: float, penalty: float = 0.003) -> RuleModel:
    """Rules of boosted trees, chosen by the lasso; `share` of class 1 corrects the balanced sample."""
    share = min(max(share, 0.001), 0.999)
    if len(y) == 0 or y.min() == y.max():
        share = float(y[0]) * 0.98 + 0.01 if len(y) else 0.5
        return RuleModel((), float(np.log(share / (1 - share))))
    rules = tree_rules(x, y)
    z = np.stack([holds(r, x) for r in rules], 1).astype(float)
    # rules that hold for the same rows are one rule
    _, once = np.unique(z, axis=1, return_index=True)
    once = np.sort(once)
    w, b = lasso_logistic(z[:, once], y, penalty)
    drawn = y.mean()
    b += np.log(share / (1 - share)) - np.log(drawn / (1 - drawn))
    chosen = tuple((rules[i], float(v)) for i, v in zip(once, w) if abs(v) > 1e-3)
    return RuleModel(chosen, float(b))


def train(stats: DataFrame, labels: DataFrame, training: Column, per_class: int = PER_CLASS) -> RuleModel:
    """Fits on at most `per_class` labelled training rows of each class; `stats` are rows of with_statistics."""
    sample = sampled_labels(labels.select("doc_id", F.col("quality").alias("target")), "target", training, per_class)
    share = labels.where(training & F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    chosen = materialise(sample, "quality-sample")
    drawn = stats.join(F.broadcast(chosen), "doc_id").select("doc_id", *FEATURES, "y")
    # rows that repeat an id would repeat its label: the one with the smallest statistics stays
    least = drawn.groupBy("doc_id").agg(F.min(F.struct(*FEATURES, "y")).alias("row"))
    rows = least.select("doc_id", "row.*").orderBy("doc_id").toPandas()
    return fit(rows[list(FEATURES)].to_numpy(float), rows.y.to_numpy(float), 0.5 if share is None else float(share))


def classify(
    docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, threshold: float = 0.7
) -> DataFrame:
    """doc_id, held_out, score, predicted and the statistics of every row of `docs`."""
    stats = materialise(with_statistics(docs), "quality-statistics")
    model = train(stats, labels, ~held_out("doc_id", modulus, remainder))
    scored = stats.withColumn("score", model.score_column())
    return scored.select(
        "doc_id",
        held_out("doc_id", modulus, remainder).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *FEATURES,
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of `docs` that score at least `threshold`, with their own columns.

    The statistics of the labelled sample are taken first; the texts are then read once more and
    each row is scored where it lies, so that no text is shuffled.
    """
    training = ~held_out("doc_id", 4, 2)
    sample = sampled_labels(labels.select("doc_id", F.col("quality").alias("target")), "target", training, PER_CLASS)
    ids = F.broadcast(materialise(sample, "quality-sample").select("doc_id"))
    drawn = materialise(with_statistics(docs.join(ids, "doc_id", "left_semi")), "quality-statistics")
    model = train(drawn, labels, training)
    marked = add_columns(
        docs, [F.col("text")], [F.struct(*docs.columns).alias("__row")], ", ".join(f"{f} double" for f in FEATURES),
        lambda: lambda texts: [statistics(t) for t in texts],
    )
    return marked.where(model.score_column() >= threshold).select("__row.*")
