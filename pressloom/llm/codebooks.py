"""Vector codes by product quantisation, fitted with a dual-tree Lloyd iteration.

A vector of finite components becomes integers, floor(4096 * x), and is cut into ``PARTS`` equal
parts. Each part position has a codebook of up to ``ENTRIES`` entries that starts as that part of the
vectors with the smallest ids; a round assigns every part to the nearest entry and moves the entry to
the floored mean of its parts.

* **Trees over the parts.** Rows are packed into blocks of ``BLOCK`` vectors. Per part position a block
  has a balanced tree, split at the middle of the widest component, whose nodes keep their bounding
  box and the cached sum of their parts. Blocks and trees are stored once in the shared folder.
* **Tree over the entries.** A small one of the same kind per codebook, made on the driver in each round.
* **Traversal.** Pairs of a part node and an entry node go down together, all blocks of an Arrow batch
  and a level at a time. The least and the largest squared distance of the two boxes bound all
  distances between them; entry nodes whose least is above the smallest largest of their part node
  are pruned. A part node with one entry left goes to it whole, by its cached sum. What is left at
  the leaves is compared point by point. All of it is integer arithmetic, so bounds are exact, and
  ties go to the lower index.

A round is one pass without a shuffle of vectors: tasks yield sums per part, entry and component, a
few thousand rows at most, which are added up. The driver holds codebooks only, ``PARTS`` times
``ENTRIES`` parts of a vector.

Edge cases: rows whose vector is null or holds a null or a component that is not finite are left out;
of fewer vectors than entries each is an entry; rows with equal ids are ordered by their vectors, and
each is coded; rows without an id come after all others and are coded, too; an empty table gives an
empty result; extra columns are ignored. Vectors have to agree in length, a multiple of ``PARTS``, and
components have to lie within +-``REACH``, so that sums fit 64 bits; otherwise the job ends with an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import batchwise
from pressloom.operators.joins import lookup
from pressloom.session import materialize

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
REACH = 4096
BLOCK = 2048
LEAF = 8


class Tree:
    """A balanced tree over points: all nodes of a level, level by level.

    ``order`` sorts the points by leaf; node i of a level holds ``order[start[i]:end[i]]``, and its
    children are 2i and 2i + 1 of the next level.
    """

    def __init__(self, points: np.ndarray, levels: int):
        n = len(points)
        self.order = np.arange(n)
        start, end = np.zeros(1, np.int64), np.full(1, n)
        self.levels = []
        for level in range(levels + 1):
            sizes = end - start
            held = points[self.order]
            low, high = np.minimum.reduceat(held, start), np.maximum.reduceat(held, start)
            self.levels.append((start, end, low, high, np.add.reduceat(held, start)))
            if level < levels:
                wide = np.repeat((high - low).argmax(1), sizes)
                self.order = self.order[np.lexsort((held[np.arange(n), wide], np.repeat(np.arange(len(start)), sizes)))]
                middle = (start + end) // 2
                start, end = np.stack([start, middle], 1).ravel(), np.stack([middle, end], 1).ravel()


def depth(n: int, leaf: int) -> int:
    """Levels below the root with ``leaf`` points in a leaf; every leaf has one at least."""
    return max(0, (n // leaf).bit_length() - 1)


class Forest:
    """The trees of many blocks for one part position, their nodes numbered through.

    Nodes of one level of one block follow on one another; ``first`` is that of a node's children.
    """

    def __init__(self, blocks: list[tuple[np.ndarray, list[tuple[np.ndarray, ...]]]]):
        points, low, high, sums, start, end, first, roots = [], [], [], [], [], [], [], []
        nodes = total = 0
        for held, levels in blocks:
            points.append(held)
            roots.append(nodes)
            for i, (s, e, a, b, c) in enumerate(levels):
                leaf = i == len(levels) - 1
                first.append(np.full(len(s), -1) if leaf else nodes + len(s) + 2 * np.arange(len(s)))
                nodes += len(s)
                start.append(s + total)
                end.append(e + total)
                low.append(a)
                high.append(b)
                sums.append(c)
            total += len(held)
        self.points, self.low, self.high, self.sums = map(np.concatenate, (points, low, high, sums))
        self.start, self.end, self.first = map(np.concatenate, (start, end, first))
        self.width = (self.high - self.low).max(1, initial=0)
        self.roots = np.array(roots)


def entry_forest(entries: np.ndarray) -> tuple[Forest, np.ndarray]:
    """A tree with one or two entries in a leaf, and the order of the entries in it."""
    tree = Tree(entries, depth(len(entries), 1))
    return Forest([(entries[tree.order], tree.levels)]), tree.order


def spread(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    sizes = end - start
    return np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def squared(low_a, high_a, low_b, high_b) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest squared distance of points of two boxes."""
    gap = np.maximum(np.maximum(low_b - high_a, low_a - high_b), 0)
    far = np.maximum(high_b - low_a, high_a - low_b)
    return (gap * gap).sum(1), (far * far).sum(1)


def traverse(forest: Forest, entries: np.ndarray):
    """Assign all points; yields (entry, node) of whole nodes and (entry, point) of single points, as (whole, entry, index)."""
    tree, entry = entry_forest(entries)
    single = tree.end - tree.start == 1
    parts, others = forest.roots.copy(), np.zeros(len(forest.roots), np.int64)
    while len(parts):
        least, most = squared(forest.low[parts], forest.high[parts], tree.low[others], tree.high[others])
        heads = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
        counts = np.diff(heads, append=len(parts))
        near = least <= np.repeat(np.minimum.reduceat(most, heads), counts)
        parts, others = parts[near], others[near]
        heads = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
        counts = np.diff(heads, append=len(parts))
        inner = tree.first[others] >= 0
        alone = (counts == 1) & single[others[heads]]
        if alone.any():
            yield True, entry[tree.start[others[heads[alone]]]], parts[heads[alone]]
        # The wider side goes down: entry nodes wider than the part node, or else the part node.
        wide = inner & (tree.width[others] >= forest.width[parts])
        leaf = forest.first[parts] < 0
        stuck = np.repeat(np.logical_or.reduceat(wide | inner & leaf, heads), counts)
        open_ = ~np.repeat(alone, counts)
        done = open_ & leaf & ~stuck
        if done.any():
            start, end = tree.start[others[done]], tree.end[others[done]]
            yield from _points(forest, entries, np.repeat(parts[done], end - start), entry[spread(start, end)])
        split = open_ & stuck & (wide | inner & leaf)
        stay = open_ & stuck & ~split
        fall = open_ & ~stuck & ~leaf
        child = tree.first[others[split]]
        below = forest.first[parts[fall]]
        parts, others = (np.concatenate(x) for x in (
            (parts[split], parts[split], parts[stay], below, below + 1),
            (child, child + 1, others[stay], others[fall], others[fall])))
        order = np.argsort(parts, kind="stable")
        parts, others = parts[order], others[order]


def _points(forest: Forest, entries: np.ndarray, parts: np.ndarray, entry: np.ndarray):
    """Compare the points of leaves with the entries that are left for them."""
    sizes = forest.end[parts] - forest.start[parts]
    point = spread(forest.start[parts], forest.end[parts])
    entry = np.repeat(entry, sizes)
    step = max(1, (1 << 22) // max(1, entries.shape[1]))
    away = np.concatenate([((forest.points[point[i:i + step]] - entries[entry[i:i + step]]) ** 2).sum(1) for i in range(0, len(point), step)])
    order = np.lexsort((entry, away, point))
    order = order[np.append(True, np.diff(point[order]) != 0)]
    yield False, entry[order], point[order]


def totals(forest: Forest, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums of the points of each entry."""
    counts, sums = np.zeros(len(entries), np.int64), np.zeros_like(entries)
    for whole, entry, index in traverse(forest, entries):
        np.add.at(counts, entry, forest.end[index] - forest.start[index] if whole else 1)
        np.add.at(sums, entry, forest.sums[index] if whole else forest.points[index])
    return counts, sums


def codes(forest: Forest, entries: np.ndarray) -> np.ndarray:
    """The entry of every point."""
    out = np.zeros(len(forest.points), np.int64)
    for whole, entry, index in traverse(forest, entries):
        if whole:
            sizes = forest.end[index] - forest.start[index]
            entry, index = np.repeat(entry, sizes), spread(forest.start[index], forest.end[index])
        out[index] = entry
    return out


def scaled(table: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label and x, the components as integers, of the rows that are kept."""
    numbers = F.col(vector).cast("array<double>")
    fine = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = table.where(F.col(vector).isNotNull()).select(F.col(key).alias("vec_id"), F.col(label).alias("label"), numbers.alias("x"), fine.alias("fine"))
    return kept.where("fine").select("vec_id", "label", F.transform("x", lambda x: F.floor(x * SCALE)).alias("x"))


def _vectors(column: pa.ListArray, parts: int) -> np.ndarray:
    """The components of a batch as (vector, part, component)."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(sizes):
        return np.empty((0, parts, 0), np.int64)
    if (sizes != sizes[0]).any() or sizes[0] % parts or not sizes[0]:
        raise ValueError(f"vectors must agree in length, a multiple of {parts}")
    if len(flat) and max(int(flat.max()), -int(flat.min())) > REACH * SCALE:
        raise ValueError(f"components must lie within +-{REACH}")
    return flat.reshape(len(sizes), parts, -1)


def _lists(rows: np.ndarray, kind=None) -> pa.Array:
    """Rows of equal length as a list column."""
    n, size = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * size), pa.array(rows.ravel(), kind))


def plant(kept: DataFrame, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """One row per block: its ids and labels and, for each part in turn, tree order, node boxes and node sums."""
    (_, id_type), (_, label_type), _ = kept.dtypes

    def run(batches):
        for batch in batches:
            vectors = _vectors(batch.column(2), parts)
            for at in range(0, len(vectors), block):
                held = vectors[at:at + block]
                n = len(held)
                trees = [Tree(held[:, p], depth(n, LEAF)) for p in range(parts)]
                order = np.concatenate([t.order for t in trees]).astype(np.int32)
                low, high, sums = (np.concatenate([level[i].ravel() for t in trees for level in t.levels]) for i in (2, 3, 4))
                one = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(i).slice(at, n)) for i in range(2)]
                yield pa.RecordBatch.from_arrays(
                    [*one, *[_lists(x[None]) for x in (held.ravel().astype(np.int32), order, low.astype(np.int32), high.astype(np.int32), sums)]],
                    ["vec_ids", "labels", "x", "ordering", "low", "high", "sums"])

    return materialize(batchwise(kept, run, f"vec_ids array<{id_type}>, labels array<{label_type}>, x array<int>, ordering array<int>, low array<int>, "
                                            "high array<int>, sums array<bigint>"), "trees")


def _forests(batch: pa.RecordBatch, names: list[str], parts: int):
    """The forests of a batch of blocks, a part position after the other, and the orders of their points."""
    x, ordering, low, high, sums = ([v.values.to_numpy(zero_copy_only=False).astype(np.int64) for v in batch.column(names.index(name))]
                                    for name in ("x", "ordering", "low", "high", "sums"))
    shapes = []
    for order in ordering:
        n = len(order) // parts
        start, end, levels = np.zeros(1, np.int64), np.full(1, n), []
        for _ in range(depth(n, LEAF) + 1):
            levels.append((start, end))
            middle = (start + end) // 2
            start, end = np.stack([start, middle], 1).ravel(), np.stack([middle, end], 1).ravel()
        shapes.append((n, levels))
    for p in range(parts):
        blocks, orders = [], []
        for (n, levels), x_, ordering_, low_, high_, sums_ in zip(shapes, x, ordering, low, high, sums):
            order = ordering_[p * n:(p + 1) * n]
            nodes = sum(len(s) for s, _ in levels)
            low2, high2, sums2 = (v.reshape(parts, nodes, -1)[p] for v in (low_, high_, sums_))
            cuts = np.cumsum([0, *[len(s) for s, _ in levels]])
            blocks.append((x_.reshape(n, parts, -1)[order, p], [(s, e, low2[a:b], high2[a:b], sums2[a:b]) for (s, e), a, b in zip(levels, cuts, cuts[1:])]))
            orders.append(order)
        yield Forest(blocks), orders


def fit(kept: DataFrame, trees: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks, (part, entry, component), after the given rounds."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    if not first:
        return np.empty((parts, 0, 0), np.int64)
    books = np.array([r.x for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    names = trees.columns
    for _ in range(rounds):
        held = books

        def run(batches, held=held):
            counts, sums = np.zeros(held.shape[:2], np.int64), np.zeros_like(held)
            for batch in batches:
                for p, (forest, _) in enumerate(_forests(batch, names, parts)):
                    more, added = totals(forest, held[p])
                    counts[p] += more
                    sums[p] += added
            part, entry = np.nonzero(counts)
            rows = np.repeat(np.arange(len(part)), held.shape[2])
            place = np.tile(np.arange(held.shape[2], dtype=np.int32), len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[rows].astype(np.int32)), pa.array(entry[rows].astype(np.int32)), pa.array(place),
                 pa.array(counts[part, entry][rows]), pa.array(sums[part, entry].ravel())],
                ["part", "entry", "place", "n", "total"])

        yielded = batchwise(trees, run, "part int, entry int, place int, n bigint, total bigint")
        found = yielded.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        books = books.copy()
        for r in found:  # one row per component of the codebooks
            books[r.part, r.entry, r.place] = r.total // r.n
    return books


def encode(trees: DataFrame, books: np.ndarray, parts: int = PARTS) -> DataFrame:
    """Per vector: vec_id, label, codes (an entry per part) and error, the sum of its parts' squared distances."""
    names = trees.columns
    types = dict(trees.dtypes)

    def run(batches):
        for batch in batches:
            sizes = [len(v) for v in batch.column(names.index("vec_ids"))]
            offsets = np.cumsum([0, *sizes])
            picked, error = np.zeros((offsets[-1], parts), np.int32), np.zeros(offsets[-1], np.int64)
            for p, (forest, orders) in enumerate(_forests(batch, names, parts)):
                found = codes(forest, books[p])
                away = ((forest.points - books[p][found]) ** 2).sum(1)
                row = np.concatenate([a + o for a, o in zip(offsets, orders)])
                picked[row, p] = found
                error[row] += away
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index("vec_ids")).flatten(), batch.column(names.index("labels")).flatten(), _lists(picked), pa.array(error)],
                ["vec_id", "label", "codes", "error"])

    id_type, label_type = (types[c][len("array<"):-1] for c in ("vec_ids", "labels"))
    return batchwise(trees, run, f"vec_id {id_type}, label {label_type}, codes array<int>, error bigint")


def compress(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes, error) of every row that is kept, and the codebooks."""
    kept = scaled(table, key, vector, label)
    trees = plant(kept)
    books = fit(kept, trees)
    return encode(trees, books), books


def report(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per vector its code, its error, the error of its label, and a digest of all codebooks."""
    coded, books = compress(table, key, vector, label)
    coded = materialize(coded, "codes")
    known = coded.withColumns({"no_label": F.col("label").isNull(), "as_label": F.coalesce(F.col("label").cast("string"), F.lit(""))})
    known = known.withColumn("tag", F.struct("no_label", "as_label"))
    per_label = known.groupBy("tag").agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    joined = lookup(known, per_label, "tag", ["vec_id", "codes"])
    return joined.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
