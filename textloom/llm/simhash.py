"""SimHash near-duplicates, joined exactly by vantage-point trees.

Fingerprints are compared by Hamming distance. Copies fall on one fingerprint and take part
once. A tree of vantage points, built from a bounded sample, cuts the space into shards: a
fingerprint lives in one shard and visits every shard that the triangle inequality does not
rule out, so no pair within the distance is missed whatever the sample was. In a shard a
second tree prunes in the same way down to small blocks that are compared bit by bit. A shard
returns a spanning forest of its links, never all pairs; the forests are joined into components.

Defined cases: a null text, or one without a word, has fingerprint zero and is linked like any
other. Rows with the same id are rows of their own; a component's id is its smallest non-null id,
null if it has none. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import add_columns, fresh, smallest_hashes
from textloom.llm.components import connected_components
from textloom.session import materialise

#: Distinct fingerprints from which the shard tree is built, and four for each shard beyond that; the
#: tree only shapes the shards.
SAMPLE = 16_384
#: Fingerprints a shard should hold on average; depth 18 holds 8.6 billion in such shards.
SHARD = 32_768
MIN_DEPTH, MAX_DEPTH = 6, 18
#: Visitors that meet the residents of a shard in one task.
VISITORS = 131_072
_LEAF = 256
_BLOCK = 2_000_000


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        parts = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[: -width])).tolist()
        parts = [joined[a:b] for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, seed) for p in parts], ">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """Key and `fp`, one row per row of `docs`."""
    return add_columns(
        docs, [F.col(text)], [F.col(key)], "fp long",
        lambda: lambda texts: [(fingerprint(t, width),) for t in texts],
    )


def _distance(a: np.ndarray, b: np.ndarray | np.int64) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b).view(np.uint64)).astype(np.int16)


class ShardTree:
    """A binary tree of vantage points; node i has the children 2i + 1 (near) and 2i + 2 (far)."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int = 7):
        size = (1 << depth) - 1
        self.depth = depth
        self.vantage = np.zeros(size, np.int64)
        self.radius = np.full(size, 32, np.int16)
        draw = np.random.default_rng(seed)
        parts = {0: sample}
        for node in range(size):
            part = parts.pop(node)
            self.vantage[node] = (
                draw.choice(part) if len(part) else draw.integers(-(1 << 63), (1 << 63) - 1, dtype=np.int64)
            )
            far = _distance(part, self.vantage[node])
            if len(part):
                self.radius[node] = np.median(far)
            if 2 * node + 1 < size:
                parts[2 * node + 1], parts[2 * node + 2] = part[far <= self.radius[node]], part[far > self.radius[node]]

    def visits(self, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home shard of each point; then (row, shard) of all later shards within `reach`.

        Of two linked points the one in the earlier shard visits the other's, so
        visits to earlier shards are not needed.
        """
        rows, nodes = np.arange(len(points)), np.zeros(len(points), np.int64)
        home = np.ones(len(points), bool)
        for _ in range(self.depth):
            far = _distance(points[rows], self.vantage[nodes])
            bound = self.radius[nodes]
            inside = far <= bound
            near, away = far - reach <= bound, far + reach > bound
            rows, nodes, home = (
                np.concatenate([rows[near], rows[away]]),
                np.concatenate([2 * nodes[near] + 1, 2 * nodes[away] + 2]),
                np.concatenate([(home & inside)[near], (home & ~inside)[away]]),
            )
        shards = nodes - ((1 << self.depth) - 1)
        own = np.zeros(len(points), np.int64)
        own[rows[home]] = shards[home]
        later = shards > own[rows]
        return own, rows[later], shards[later]


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the sets of a[i] and b[i]; every label is the smallest place of its set."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        a, b = a[open_], b[open_]
        np.minimum.at(label, np.maximum(la, lb)[open_], np.minimum(la, lb)[open_])
        while not np.array_equal(jumped := label[label], label):
            label = jumped


def shard_forest(points: np.ndarray, resident: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (point, root) that connect what residents and visitors of a shard link.

    Compares every resident with every resident and visitor within `reach` of it, through a
    local tree. Memory: a block of comparisons and some arrays as long as the shard.
    """
    order = np.argsort(points, kind="stable")
    points, resident = points[order], resident[order]
    label = np.arange(len(points))
    draw = np.random.default_rng(11)
    stack = [(np.flatnonzero(resident), np.arange(len(points)), 0)]
    while stack:
        mine, asking, tries = stack.pop()
        if len(mine) == 0 or len(asking) == 0:
            continue
        if len(mine) > _LEAF and tries < 3:
            center = points[draw.choice(mine)]
            d_mine, d_ask = _distance(points[mine], center), _distance(points[asking], center)
            close = mine[2 * d_mine <= reach]
            label = _union(label, close, np.full(len(close), close[0]))
            cut = int(np.median(d_mine))
            if cut == d_mine.max():
                cut -= 1
            inside = d_mine <= cut
            if inside.any() and not inside.all():
                # a cut that hardly prunes counts as a try; after three the block is compared as it is
                for part, asks in ((mine[inside], asking[d_ask <= cut + reach]), (mine[~inside], asking[d_ask > cut - reach])):
                    stack.append((part, asks, tries + (len(asks) > 0.97 * len(asking))))
                continue
        step = max(1, _BLOCK // len(mine))
        for at in range(0, len(asking), step):
            part = asking[at : at + step]
            apart = np.bitwise_count((points[part][:, None] ^ points[mine][None, :]).view(np.uint64))
            i, j = np.nonzero(apart <= reach)
            label = _union(label, part[i], mine[j])
    linked = np.flatnonzero(label != np.arange(len(points)))
    return points[linked], points[label[linked]]


def near_links(prints: DataFrame, reach: int = 3) -> DataFrame:
    """Edges (`src`, `dst`) of a spanning forest of all links between the distinct values of `fp`."""
    spark = prints.sparkSession
    n = prints.count()
    depth = min(MAX_DEPTH, max(MIN_DEPTH, math.ceil(math.log2(max(1, n / SHARD)))))
    drawn = smallest_hashes(prints.select("fp"), ["fp"], max(SAMPLE, 4 << depth), n)
    sample = drawn.toPandas().fp.to_numpy(np.int64)
    tree = spark.sparkContext.broadcast(ShardTree(sample, depth))

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = frame.fp.to_numpy(np.int64)
            for at in range(0, len(points), 4096):
                part = points[at : at + 4096]
                own, rows, shards = tree.value.visits(part, reach)
                yield pd.DataFrame(
                    {
                        "shard": np.concatenate([own, shards]).astype(np.int32),
                        "fp": np.concatenate([part, part[rows]]),
                        "resident": np.arange(len(own) + len(rows)) < len(own),
                    }
                )

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = shard_forest(frame.fp.to_numpy(np.int64), frame.resident.to_numpy(bool), reach)
        return pd.DataFrame({"src": a, "dst": b})

    routed = prints.select("fp").mapInPandas(route, "shard int, fp long, resident boolean")
    if n > SHARD << MIN_DEPTH:
        # visitors multiply as the tree grows: they come in parts of bounded size, each with all residents
        routed = materialise(routed, "simhash-routed")
        asked = routed.where("not resident").groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("parts"))
        parts = F.coalesce("parts", F.lit(1))
        own = F.array(F.pmod(F.xxhash64("fp"), parts).cast("int"))
        part = F.explode(F.when(F.col("resident"), F.sequence(F.lit(0), parts - 1)).otherwise(own)).alias("part")
        # one row per shard
        routed = routed.join(F.broadcast(asked), "shard", "left").select("shard", "fp", "resident", part)
        return routed.groupBy("shard", "part").applyInPandas(link, "src long, dst long")
    return routed.groupBy("shard").applyInPandas(link, "src long, dst long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, reach: int = 3
) -> DataFrame:
    """Key, `fp`, `root` (smallest fingerprint of the component) and `component_id` per row of `docs`."""
    rows = materialise(fingerprints(docs, key, text, width), "simhash-rows")
    prints = materialise(rows.groupBy("fp").agg(F.min(key).alias("least")), "simhash-distinct")
    labels = connected_components(near_links(prints.select("fp"), reach))
    rooted = prints.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    # written, so that both sides of the next join are plain shuffles, which AQE splits at a large component
    rooted = materialise(rooted, "simhash-rooted")
    ids = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-ids")
    return rows.join(rooted.select("fp", "root").join(ids, "root"), "fp").select(key, "fp", "root", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, reach: int = 3) -> DataFrame:
    """One row of each component: the one with the smallest id (a null id only where there is no other)."""
    found = materialise(near_duplicates(docs, key, text, width, reach), "simhash-components")
    known, number, print_, root, first_, row_ = fresh(docs, "__key", "__n", "__fp", "__root", "__first", "__row")
    counts = found.groupBy(F.col(key).alias(known)).agg(
        F.count(F.lit(1)).alias(number), F.count_if(F.col(key).eqNullSafe(F.col("component_id"))).alias(first_)
    )
    chosen = counts.where(F.col(first_) > 0).select(known, number)
    same = F.col(key).eqNullSafe(F.col(known))
    kept = docs.join(chosen.select(known), same, "left_semi")
    many = chosen.where(F.col(number) > 1).select(known)
    if not many.take(1):
        return kept
    # an id on several rows: its rows carry fingerprints again, and one row per component stays
    marked = add_columns(
        kept.join(many, same, "left_semi"), [F.col(text)], [F.struct(*docs.columns).alias(row_)], f"{print_} long",
        lambda: lambda texts: [(fingerprint(t, width),) for t in texts],
    )
    first = found.where(F.col(key).eqNullSafe(F.col("component_id")))
    first = first.select(F.col(key).alias(known), F.col("fp").alias(first_), F.col("root").alias(root)).distinct()
    mine = F.col(row_)[key].eqNullSafe(F.col(known)) & (F.col(print_) == F.col(first_))
    said = F.col(row_)[text]
    ranked = marked.join(first, mine).groupBy(root).agg(F.min_by(row_, F.struct(F.xxhash64(said), said)).alias(row_))
    return kept.join(many, same, "left_anti").unionByName(ranked.select(f"{row_}.*"))
