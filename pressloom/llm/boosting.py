"""Gradient boosted trees on labelled rows of a few dozen features, in memory (``fit``) or as Spark jobs (``fit_rows``)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import batchwise

# Gradients are added up as whole numbers of this unit, so that sums do not depend on the order of the rows.
UNIT = float(1 << 30)
# Values below this are added up in one array a task.
COMMON = 256
# Thresholds lie on a grid of this many steps from 0 to 1.
STEPS = 10_000


@dataclass
class Boosted:
    """Complete trees of one depth: per tree the split features, split values and leaf scores."""

    depth: int
    base: float
    features: np.ndarray  # trees x (2^depth - 1)
    cuts: np.ndarray
    leaves: np.ndarray    # trees x 2^depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class per row."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def _best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[int, float]:
    """Feature and value with the largest gain; (0, inf) sends all rows left."""
    best, where = 1e-9, (0, np.inf)
    whole = g.sum() ** 2 / (h.sum() + ridge)
    for f in range(x.shape[1]):
        values, at = np.unique(x[:, f], return_inverse=True)
        if len(values) < 2:
            continue
        gs, hs = np.bincount(at, g).cumsum(), np.bincount(at, h).cumsum()
        left = gs[:-1] ** 2 / (hs[:-1] + ridge)
        right = (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + ridge)
        gain = left + right - whole
        k = int(gain.argmax())
        if gain[k] > best:
            best, where = gain[k], (f, float((values[k] + values[k + 1]) / 2))
    return where


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
    """Logistic loss, Newton steps. Rows of one class only give a model without splits that matter."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    total, inner = np.full(len(y), base), 2**depth - 1
    features, cuts, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for k in range(inner):
            here = np.flatnonzero(node == k)
            if len(here):
                feature[k], cut[k] = _best_split(x[here], g[here], h[here], ridge)
                node[here] = 2 * k + 1 + (x[here, feature[k]] > cut[k])
        at = node - inner
        leaf = rate * np.bincount(at, g, 2**depth) / (np.bincount(at, h, 2**depth) + ridge)
        total += leaf[at]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Boosted(depth, base, np.array(features), np.array(cuts), np.array(leaves))


def threshold(scores: np.ndarray, y: np.ndarray, precision: float, least: int = 20) -> float:
    """Lowest score at which the rows at or above it are positive often enough; inf if none."""
    order = np.argsort(-scores, kind="stable")
    scores, hits = scores[order], y[order].cumsum()
    counts = np.arange(1, len(scores) + 1)
    last = np.append(scores[1:] < scores[:-1], True)  # ties are taken together
    good = np.flatnonzero(last & (hits >= precision * counts) & (counts >= least))
    return float(scores[good[-1]]) if len(good) else float("inf")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _margins(grown: list[tuple], base: float, x: np.ndarray) -> np.ndarray:
    """What the trees, given as (splits, leaves), add up to; the splits are (feature, cut) in node order."""
    total = np.full(len(x), base)
    for splits, leaves in grown:
        right = np.take(x, [f for f, _ in splits], axis=1) > np.array([c for _, c in splits])
        total += np.asarray(leaves)[_nodes(right, len(splits).bit_length()) - len(splits)]
    return total


def _nodes(right: np.ndarray, levels: int) -> np.ndarray:
    """The node each row reaches, from its answers at all nodes above."""
    node, each = np.zeros(len(right), np.int64), np.arange(len(right))
    for _ in range(levels):
        node = 2 * node + 1 + right[each, node]
    return node


def _best_splits(rows: DataFrame, grown: list[tuple], base: float, splits: list[tuple], level: int, ridge: float) -> dict[int, tuple]:
    """Per node of a level of the tree that ``splits`` begins: its best split, or None, and the gradients (g, h) left of it
    and of the whole node.

    Each task adds up the gradients of its rows per node, feature and value, and Spark adds up those of the
    tasks; of each node and feature only the best split comes to the driver.
    """
    inner, nodes = 2**level - 1, 2**level

    def run(batches):
        dense = None

        def packed(node, feature, value, n, g, h):
            filled = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays([pa.array(node[filled].astype(np.int32)), pa.array(feature[filled].astype(np.int32)), pa.array(value[filled].astype(np.int32)),
                                               pa.array(g[filled].astype(np.int64)), pa.array(h[filled].astype(np.int64))], ["node", "feature", "value", "g", "h"])

        for batch in batches:
            y, x = np.asarray(batch.column(0)), _matrix(batch.column(1))
            if not len(y):
                continue
            p = 1 / (1 + np.exp(-_margins(grown, base, x)))
            g, h = np.rint((y - p) * UNIT), np.rint(p * (1 - p) * UNIT)
            right = np.take(x, [f for f, _ in splits], axis=1) > np.array([c for _, c in splits]) if splits else None
            node = _nodes(right, level) - inner if splits else np.zeros(len(y), np.int64)
            wide, size = x.shape[1], nodes * x.shape[1] * COMMON
            if dense is None:
                dense = np.zeros((3, size), np.int64)
            place = (node[:, None] * wide + np.arange(wide)) * COMMON + x
            common = x < COMMON
            here, repeat = place[common], common.sum(axis=1)
            # The sums of a batch are whole numbers far below 2 ** 53.
            for total, weights in zip(dense, (None, np.repeat(g, repeat), np.repeat(h, repeat))):
                total += np.bincount(here, weights, size).astype(np.int64)
            if not common.all():  # rare large values go as they are
                r, f = np.nonzero(~common)
                yield packed(node[r] + inner, f, x[r, f], np.ones(len(r)), g[r], h[r])
        if dense is not None:
            at = np.arange(dense.shape[1])
            yield packed(at // (COMMON * wide) + inner, at // COMMON % wide, at % COMMON, *dense)

    parts = batchwise(rows.select("label", "x"), run, "node int, feature int, value int, g bigint, h bigint")
    sums = parts.repartition("node", "feature").groupBy("node", "feature", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    whole = Window.partitionBy("node", "feature")
    upto = whole.orderBy("value")
    placed = sums.select("node", "feature", "value", F.lead("value").over(upto).alias("next"), (F.sum("g").over(upto) / UNIT).alias("gl"), (F.sum("h").over(upto) / UNIT).alias("hl"),
                         (F.sum("g").over(whole) / UNIT).alias("g"), (F.sum("h").over(whole) / UNIT).alias("h"))

    def part(a, b):
        return a * a / (b + ridge)

    gain = part(F.col("gl"), F.col("hl")) + part(F.col("g") - F.col("gl"), F.col("h") - F.col("hl")) - part(F.col("g"), F.col("h"))
    gain = F.when(F.col("next").isNotNull() & (gain > 1e-9), gain)
    split = F.struct("gain", (-F.col("value")).alias("first"), ((F.col("value") + F.col("next")) / 2).alias("cut"), "gl", "hl")
    found = placed.withColumn("gain", gain).groupBy("node", "feature").agg(
        F.max(F.when(F.col("gain").isNotNull(), split)).alias("s"), F.max("g").alias("g"), F.max("h").alias("h")).collect()  # one row a node and feature
    out: dict[int, tuple] = {}
    for r in sorted(found, key=lambda r: (r["node"], -r["s"]["gain"] if r["s"] else 0.0, r["feature"])):
        s = r["s"]
        out.setdefault(r["node"], ((r["feature"], s["cut"]) if s else None, s["gl"] if s else r["g"], s["hl"] if s else r["h"], r["g"], r["h"]))
    return out


def fit_rows(rows: DataFrame, trees: int = 30, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Boosted | None:
    """The trees of ``fit`` for a table of rows (label, x), x being whole numbers from 0 up: all rows count, and one job
    a level of a tree finds its splits. None without positive rows."""
    n, positive = rows.agg(F.count("*"), F.sum("label")).first()
    if not positive:
        return None
    share = (positive + 1) / (n + 2)
    base, inner = float(np.log(share / (1 - share))), 2**depth - 1
    grown: list[tuple] = []
    for _ in range(trees):
        splits: list[tuple] = []
        leaves = np.zeros(2**depth)
        for level in range(depth):
            found = _best_splits(rows, grown, base, splits, level, ridge)
            for node in range(2**level - 1, 2**(level + 1) - 1):
                split, gl, hl, g, h = found.get(node, (None, 0.0, 0.0, 0.0, 0.0))
                splits.append(split or (0, np.inf))
                if level == depth - 1:
                    leaves[2 * (node - 2**level + 1):][:2] = rate * gl / (hl + ridge), rate * (g - gl) / (h - hl + ridge)
        grown.append((splits, leaves))
    return Boosted(depth, base, np.array([[f for f, _ in s] for s, _ in grown]), np.array([[c for _, c in s] for s, _ in grown]), np.array([v for _, v in grown]))


def thresholds(rows: DataFrame, trees: Boosted, precision: float, least: int = 20) -> dict[int, float]:
    """Per kind of rows (kind, label, x) the lowest step of a grid of scores at which all rows at or above it are positive
    often enough; kinds without one are left out."""
    grid = np.arange(STEPS + 1) / STEPS

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                step = np.searchsorted(grid, trees.score(_matrix(batch.column(2))), "right") - 1
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(step.astype(np.int32)), batch.column(1)], ["kind", "step", "label"])

    steps = batchwise(rows.select("kind", "label", "x"), run, "kind int, step int, label double").groupBy("kind", "step").agg(
        F.sum("label").alias("hits"), F.count("*").alias("n"))
    over = Window.partitionBy("kind").orderBy(F.desc("step"))
    good = steps.select("kind", "step", F.sum("hits").over(over).alias("hits"), F.sum("n").over(over).alias("n")).where((F.col("hits") >= precision * F.col("n")) & (F.col("n") >= least))
    return {r["kind"]: float(grid[r["step"]]) for r in good.groupBy("kind").agg(F.min("step").alias("step")).collect()}
