"""Near-duplicate groups: MinHash with banding, verification on full sets, star components.

* One pass hashes each document's shingles and keeps, of ``bands * rows`` universal hash
  functions, the minima; ``rows`` minima of a band make one key. Two documents of similarity s
  miss each other in every band with probability (1 - s^rows)^bands: 3e-6 at 0.8 with the defaults
  and under 1e-8 at 0.85.
* Documents of equal words are one class, of which only the smallest id is compared.
* A bucket (a band key with two classes or more) is not expanded to pairs. All its members are
  first compared with one hub; links become components, and a bucket whose members are all in one
  component is done. What is left are stragglers, members outside of the bucket's largest
  component, and only they are compared with the other members: as pairs in buckets of up to
  ``SMALL`` members, and beyond in blocks of bounded size, of which a task gets one with stragglers
  and one with members and counts their common shingles by a matrix product. It returns no more
  links than connect its components. So in the end all pairs of a bucket are connected or compared.
* Pairs are first compared by their minima (a pair of similarity ``similarity`` fails with a
  probability below 1e-10), then exactly, on the full sets.

Edge cases: null, empty and wordless texts have no shingles and are linked with nothing; fewer
words than a shingle make one shingle of them all; very long texts are hashed in slices; rows that
share an id are one node, and exact copies of a row get equal rows; a row without an id takes the
component of its copies that have one, else its component is null and ``near_groups`` keeps it;
``drop_near_duplicates`` works on rows and keeps one of each group, also of equal rows and of copies
without an id; extra columns are ignored or passed through; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import as_bytes, batchwise, fresh, ship
from pressloom.llm.components import components
from pressloom.llm.shingles import WordHashes, mix, shingle_set, split_lower
from pressloom.session import materialize

SLICE = 2048
SMALL = 32
BLOCK_ROWS, BLOCK_TOKENS = 1024, 1 << 20
SLACK = 0.2  # seven standard deviations of the share of equal minima at 160 minima


class MinHash:
    """Minima of universal hash functions a * x + b over 32-bit numbers."""

    def __init__(self, count: int, seed: int = 7):
        random = np.random.Generator(np.random.PCG64(seed))
        self.a = (random.integers(0, 1 << 32, count, np.uint32) | np.uint32(1))[:, None]
        self.b = random.integers(0, 1 << 32, count, np.uint32)[:, None]
        self.work = np.empty((count, SLICE), np.uint32)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), SLICE):
            part = x[at:at + SLICE]
            work = self.work[:, :len(part)]
            np.multiply(self.a, part, out=work)
            np.add(work, self.b, out=work)
            np.minimum(low, work.min(axis=1), out=low)
        return low


def band_keys(minima: np.ndarray, bands: int) -> np.ndarray:
    """One number per band, different bands kept apart."""
    rows = minima.reshape(bands, -1).astype(np.uint64)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows.shape[1]):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return keys.view(np.int64)


def _text_hashes(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of the text itself; they tell texts apart that differ in case or blanks only."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def sign(docs: DataFrame, key: str, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """Per row: doc_id, n_shingles, 128-bit fingerprints of the words (hi, lo) and of the text (a, b), the band keys."""
    one, two = _text_hashes(F.col(text))
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), one.alias("a"), two.alias("b"))
    schema = f"doc_id {picked.dtypes[0][1]}, n_shingles bigint, hi bigint, lo bigint, a bigint, b bigint, keys array<bigint>"

    def run(batches):
        hashes, minhash = WordHashes(), MinHash(bands * rows)
        for batch in batches:
            counts, prints, keys, ends = [], [], [], [0]
            for raw in as_bytes(batch.column(1)):
                words = split_lower(raw)
                found = shingle_set(words, size, hashes)
                counts.append(len(found))
                prints.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else bytes(16))
                if words:
                    keys.append(band_keys(minhash.minima(found), bands))
                ends.append(ends[-1] + (bands if words else 0))
            pairs = np.frombuffer(b"".join(prints), "<i8").reshape(-1, 2)
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), batch.column(2), batch.column(3), listed],
                ["doc_id", "n_shingles", "hi", "lo", "a", "b", "keys"])

    return batchwise(picked, run, schema)


def full_sets(docs: DataFrame, key: str, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """Per row: rep (its id), the sorted shingles and the minima."""
    picked = docs.select(F.col(key).alias("rep"), F.col(text).alias("text"))
    schema = f"rep {picked.dtypes[0][1]}, shingles array<bigint>, minima array<int>"

    def run(batches):
        hashes, minhash = WordHashes(), MinHash(bands * rows)
        for batch in batches:
            # Short batches: sets are larger than their texts.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(split_lower(raw), size, hashes) for raw in as_bytes(part.column(1))]
                shingles = pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))
                minima = pa.array([minhash.minima(x).view(np.int32) for x in sets], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), shingles, minima], ["rep", "shingles", "minima"])

    return batchwise(picked, run, schema)


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets have 100 * intersection >= percent * union."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("rep").alias(name), F.col("shingles").alias(f"s{name}"), F.col("minima").alias(f"m{name}"))

    joined = pairs.join(side("x"), "x").join(side("y"), "y")
    equal = F.size(F.filter(F.zip_with("mx", "my", lambda a, b: a == b), lambda e: e))
    alike = equal >= (percent / 100 - SLACK) * F.size("mx")
    both = F.size(F.array_intersect("sx", "sy"))
    sizes = F.size("sx") + F.size("sy")
    near = F.least(F.size("sx"), F.size("sy")) * 100 >= percent * F.greatest(F.size("sx"), F.size("sy"))
    return joined.where(near).where(alike).where((100 + percent) * both >= percent * sizes).select(F.col("x").alias("a"), F.col("y").alias("b"))


def _grouped(docs: DataFrame, key: str, text: str, size: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Per row: doc_id, n_shingles, the fingerprints of its words and its text, and component_id."""
    signed = materialize(sign(docs, key, text, size, bands, rows), "signed")
    classes = signed.where("n_shingles > 0").groupBy("hi", "lo").agg(
        F.min("doc_id").alias("rep"), F.first("keys").alias("keys"))
    reps = materialize(classes, "classes")
    roots = _link(docs, reps, key, text, size, percent, bands, rows)
    named = signed.drop("keys").join(reps.select("hi", "lo", "rep"), ["hi", "lo"], "left")
    out = named.join(roots.select(F.col("a").alias("rep"), F.col("b").alias("root")), "rep", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("root", "rep")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", "hi", "lo", "a", "b", component.alias("component_id"))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80,
                bands: int = 32, rows: int = 5) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id of its group) and kept."""
    out = _grouped(docs, key, text, size, percent, bands, rows)
    return out.select("doc_id", "n_shingles", "component_id").withColumn(
        "kept", F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _link(docs: DataFrame, reps: DataFrame, key: str, text: str, size: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Star edges (a, b) between class representatives of one component."""
    all_cells = reps.where("rep IS NOT NULL").select("rep", F.explode("keys").alias("key"))
    shared = all_cells.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    # The place of a member in its buckets is drawn by its id, so that hubs agree between bands.
    cells = materialize(all_cells.join(shared, "key").withColumn("place", F.xxhash64(F.lit(11), "rep")), "cells")
    involved = materialize(cells.select(F.col("rep").alias("_rep")).distinct(), "involved")
    known = docs.join(involved, docs[key] == involved["_rep"], "left_semi")
    sets = materialize(full_sets(known, key, text, size, bands, rows), "sets")
    stars = cells.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)
    for step in (_first_hub, _small_buckets, _large_buckets):
        live = materialize(_open(cells, stars), "open")
        if live.isEmpty():
            break
        links = _large_buckets(live, sets, percent) if step is _large_buckets else verify(materialize(step(live), "pairs"), sets, percent)
        stars = components(materialize(links.unionByName(stars), "links"))
    return stars


def _open(cells: DataFrame, stars: DataFrame) -> DataFrame:
    """Members, with their labels, of the buckets that span components."""
    roots = stars.select(F.col("a").alias("rep"), F.col("b").alias("root"))
    labelled = cells.join(roots, "rep", "left").select("key", "rep", "members", "place", F.coalesce("root", "rep").alias("label"))
    live = labelled.groupBy("key").agg(
        F.min("label").alias("l0"), F.max("label").alias("l1"), F.min(F.struct("place", "rep")).alias("first")).where("l0 != l1")
    # Stored, as an aggregate right below the join would keep a hot bucket in one task.
    return labelled.join(materialize(live.select("key", "first"), "spanning"), "key")


def _distinct_pairs(found: DataFrame) -> DataFrame:
    return found.select(F.greatest("p", "q").alias("x"), F.least("p", "q").alias("y")).distinct()


def _first_hub(live: DataFrame) -> DataFrame:
    """The member of the smallest place with all others."""
    others = live.where(F.struct("place", "rep") != F.col("first"))
    return _distinct_pairs(others.select(F.col("first.rep").alias("p"), F.col("rep").alias("q")))


def _largest(live: DataFrame) -> DataFrame:
    """Per bucket the label of most members."""
    counts = live.groupBy("key", "label").agg(F.count("*").alias("m"))
    # Stored before it is joined: an aggregate right below a join would keep a hot bucket in one task.
    return materialize(counts.groupBy("key").agg(F.max(F.struct("m", "label"))["label"].alias("top")), "largest")


def _small_buckets(live: DataFrame) -> DataFrame:
    """Stragglers of small buckets with the members of other components."""
    small = live.where(F.col("members") <= SMALL)
    outside = small.join(_largest(small), "key").where("label != top").select("key", F.col("rep").alias("p"), F.col("label").alias("of"))
    return _distinct_pairs(outside.join(small, "key").where("label != of").select("p", F.col("rep").alias("q")))


def _large_buckets(live: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the stragglers of large buckets, enough to connect what is linked."""
    large = live.where(F.col("members") > SMALL).select("key", "rep", "label")
    sized = large.join(sets.select("rep", F.size("shingles").alias("n")), "rep").join(_largest(large), "key")
    outside = F.col("label") != F.col("top")

    def blocks(rows, tokens):
        return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(tokens / BLOCK_TOKENS), F.lit(1)).cast("int")

    cut = sized.groupBy("key", "top").agg(
        blocks(F.count("*"), F.sum("n")).alias("nj"), blocks(F.count_if(outside), F.sum(F.when(outside, F.col("n")))).alias("ni"))
    wide = large.join(cut, "key").join(sets.select("rep", "shingles"), "rep")

    def place(count: str, seed: int):
        return F.pmod(F.xxhash64(F.lit(seed), "rep"), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = wide.where(outside).select("key", place("ni", 1).alias("i"), every("nj").alias("j"), F.lit(True).alias("straggler"), "rep", "label", "shingles")
    right = wide.select("key", every("ni").alias("i"), place("nj", 2).alias("j"), F.lit(False).alias("straggler"), "rep", "label", "shingles")
    kind = sets.select("rep").dtypes[0][1]

    def compare(table: pa.Table) -> pa.Table:
        side = np.array(table.column("straggler").to_pylist(), bool)
        reps, labels = table.column("rep").to_pylist(), table.column("label").to_pylist()
        one = table.column("shingles").combine_chunks()
        one = one.chunk(0) if isinstance(one, pa.ChunkedArray) else one
        links = block_links(one.flatten().to_numpy(), np.diff(one.offsets.to_numpy()), side, reps, labels, percent)
        names = table.schema.field("rep").type
        return pa.table([pa.array([x for x, _ in links], names), pa.array([y for _, y in links], names)], ["a", "b"])

    ship(live.sparkSession)
    return left.unionAll(right).groupBy("key", "i", "j").applyInArrow(compare, f"a {kind}, b {kind}")


def block_links(tokens: np.ndarray, sizes: np.ndarray, straggler: np.ndarray, reps: list, labels: list, percent: int) -> list[tuple]:
    """Similar (straggler, member) pairs of different labels, as many as connect these labels."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    _, ids, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    common = counts[ids] > 1
    order = np.argsort(ids[common], kind="stable")
    ids, rows = ids[common][order], rows[common][order]
    left, right = np.flatnonzero(straggler), np.flatnonzero(~straggler)
    at = np.empty(len(sizes), np.int64)
    at[left], at[right] = np.arange(len(left)), np.arange(len(right))
    both = np.zeros((len(left), len(right)), np.float32)
    distinct, first = np.unique(ids, return_index=True)
    column = np.repeat(np.arange(len(distinct)), np.diff(np.append(first, len(ids))))
    for low in range(0, len(distinct), 4096):
        here = slice(first[low], first[low + 4096] if low + 4096 < len(distinct) else len(ids))
        x, y = (np.zeros((len(k), 4096), np.float32) for k in (left, right))
        side = straggler[rows[here]]
        x[at[rows[here][side]], column[here][side] - low] = 1
        y[at[rows[here][~side]], column[here][~side] - low] = 1
        both += x @ y.T
    total = sizes[left][:, None] + sizes[right]
    out = []
    for i, j in np.argwhere((100 + percent) * both.astype(np.int64) >= percent * total):
        i, j = left[i], right[j]
        p, q = root(labels[i]), root(labels[j])
        if p != q:
            parent[p] = q
            out.append((reps[i], reps[j]))
    return out


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80,
                         bands: int = 32, rows: int = 5) -> DataFrame:
    """One row of each group, that of the smallest id (then of the smallest hash of its text), with its own columns.

    A row is told by its id and its text, so another text of the same id is not touched; of rows that
    agree in both, one stays, as of any group. Rows without an id are the last of their group. Rows
    without words all stay.
    """
    grouped = materialize(_grouped(docs, key, text, size, percent, bands, rows).where("n_shingles > 0").select(
        F.struct("component_id", F.when(F.col("component_id").isNull(), F.struct("hi", "lo")).alias("own")).alias("group"),
        F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "a", "b").alias("row")), "grouped")
    first = materialize(grouped.groupBy("group").agg(F.min("row").alias("first")), "first-rows")
    told = grouped.groupBy("group", "row").agg(F.count("*").alias("n")).join(first, "group")
    gone = told.where("row != first").select(F.col("row.doc_id").alias("_id"), F.col("row.a").alias("_a"), F.col("row.b").alias("_b"))
    again = materialize(told.where("row = first AND n > 1").select(F.col("row.doc_id").alias("_id"), F.col("row.a").alias("_a"), F.col("row.b").alias("_b")), "repeated-rows")

    def same(df: DataFrame, other: DataFrame):
        one, two = _text_hashes(df[text])
        return df[key].eqNullSafe(other["_id"]) & (one == other["_a"]) & (two == other["_b"])

    left = docs.join(gone, same(docs, gone), "left_anti")
    if again.isEmpty():
        return left
    a, b = fresh(docs, "a"), fresh(docs, "b")
    one, two = _text_hashes(F.col(text))
    repeated = left.join(again, same(left, again), "left_semi").withColumn(a, one).withColumn(b, two).dropDuplicates([key, a, b])
    return left.join(again, same(left, again), "left_anti").unionByName(repeated.drop(a, b))
