"""Periodic runs of words by grammar compression.

A run is a stretch of consecutive words with smallest period q, at least ``LEAST`` words and two
periods long, that keeps its period with neither neighbour. Texts are worked on in groups of some
200,000 words (a longer text is a group of its own), in these steps:

1. **Re-Pair.** Words become numbers; the most frequent pair of neighbours becomes a new symbol, until
   no pair occurs twice. A round replaces at once every pair that outranks (by count, then by a mixed
   code) the two it overlaps with. Pairs do not reach over the end of a text, but texts share symbols,
   so copies of a text are one symbol. What is left of a text is the root of its derivation, a balanced
   tree over its symbols.
2. **Boundaries.** For every nonterminal and every node of such a tree, the runs inside of it that
   cross the border of its two halves are found once, at one of its places: a run that crosses the
   border holds the q words on one side of it, so one word comparison per q leaves few candidates,
   whose ends are found by binary search over prefix hashes.
3. **Translation.** They are moved to every place where the nonterminal was derived; there,
   intervals of one period that overlap by the period or more are one run. Every run crosses
   the border of the smallest node around it, so none is missed. Every result is compared word by
   word; if a hash was wrong, the group is done again with another one.

Memory is linear in a group. There is no shuffle: each text is a row of its own.

Edge cases: a null text has no words and stays null; an empty or blank one has no words and no
runs; repeated rows and rows without an id are worked on like any other; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import as_bytes, batchwise, int_key, let, words
from pressloom.llm.shingles import mix

LEAST = 12
GROUP_WORDS = 200_000
SLICE = 1 << 19
_PRIME = (1 << 31) - 1

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _rounds(symbols: np.ndarray, begins: np.ndarray):
    """Re-Pair rounds; yields (starts, words of the left half, words of the right half, new symbol) of the pairs replaced.

    Returns (starts, lengths, begins) of the symbols that are left; ``begins`` marks the first one of a text.
    """
    symbols = symbols.copy()
    starts, lengths = np.arange(len(symbols)), np.ones(len(symbols), np.int64)
    known = int(symbols.max(initial=-1)) + 1
    while len(symbols):
        codes = symbols[:-1] * known + symbols[1:]
        codes[begins[1:]] = -1
        same = symbols[:-1] == symbols[1:]
        if same.any():
            # In a stretch of one symbol only every other pair counts.
            place = np.arange(len(same))
            same &= codes >= 0
            codes[same & ((place - np.maximum.accumulate(np.where(same, -1, place))) % 2 == 0)] = -1
        pairs, pair, counts = np.unique(codes, return_inverse=True, return_counts=True)
        often = np.flatnonzero((counts > 1) & (pairs >= 0))
        order = (counts[often] << 36) + (mix(pairs[often].view(np.uint64)) >> np.uint64(28)).view(np.int64)
        rank = np.zeros(len(pairs), np.int64)
        rank[often[np.argsort(order)]] = np.arange(1, len(often) + 1)
        weight = np.zeros(len(codes) + 2, np.int64)
        weight[1:-1] = rank[pair]
        won = np.flatnonzero((weight[1:-1] > weight[:-2]) & (weight[1:-1] > weight[2:]))
        pair = pair[won]
        twice = np.bincount(pair, minlength=len(pairs)) >= 2
        if not twice.any():
            break
        good = twice[pair]
        chosen, new = won[good], (known - 1 + np.cumsum(twice))[pair[good]]
        yield starts[chosen], lengths[chosen], lengths[chosen + 1], new
        known += int(twice.sum())
        symbols[chosen] = new
        lengths[chosen] += lengths[chosen + 1]
        keep = np.ones(len(symbols), bool)
        keep[chosen + 1] = False
        symbols, starts, lengths, begins = symbols[keep], starts[keep], lengths[keep], begins[keep]
    return starts, lengths, begins


def nodes(symbols: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(low, middle, high, node, starts): nodes of the derivations with ``LEAST`` or more words.

    The first three are at one place of each node; ``starts`` are all its places, ``node`` says whose.
    """
    rounds = _rounds(symbols, begins)
    while True:
        try:
            at, left, right, new = next(rounds)
        except StopIteration as end:
            starts, lengths, begins = end.value
            break
        long = left + right >= LEAST
        at, left, right, new = at[long], left[long], right[long], new[long]
        if len(at):
            _, first, node = np.unique(new, return_index=True, return_inverse=True)
            low = at[first]
            yield low, low + left[first], low + left[first] + right[first], node, at
    ends = starts + lengths
    while len(starts) and not begins.all():
        # Neighbours 0 and 1, 2 and 3, ... of each text join.
        number = np.arange(len(starts)) - np.maximum.accumulate(np.where(begins, np.arange(len(starts)), 0))
        even = number % 2 == 0
        left = np.flatnonzero(even & np.append(~begins[1:], False))
        low, middle, high = starts[left], ends[left], ends[left + 1]
        long = high - low >= LEAST
        if long.any():
            yield low[long], middle[long], high[long], np.arange(int(long.sum())), low[long]
        ends[left] = high
        starts, ends, begins = starts[even], ends[even], begins[even]


class Hashes:
    """Prefix hashes of a sequence, to compare stretches of it."""

    def __init__(self, symbols: np.ndarray, seed: int):
        random = np.random.default_rng(seed)
        n = len(symbols)
        base = int(random.integers(1 << 16, _PRIME))
        self.powers = np.ones(1, np.int64)
        while len(self.powers) <= n:
            self.powers = np.concatenate([self.powers, self.powers * pow(base, len(self.powers), _PRIME) % _PRIME])
        values = random.integers(1, _PRIME, int(symbols.max(initial=0)) + 1)
        self.sums = np.concatenate([[0], np.cumsum(values[symbols] * self.powers[:n] % _PRIME) % _PRIME])

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``size`` from ``a`` and from the later ``b`` have one hash."""
        first = (self.sums[a + size] - self.sums[a]) % _PRIME * self.powers[b - a] % _PRIME
        return first == (self.sums[b + size] - self.sums[b]) % _PRIME

    def extent(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words (``most`` at most) agree from ``a`` and ``b`` on, or before them."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            size = (low + high + 1) // 2
            shift = size if back else 0
            good = self.equal(a - shift, b - shift, size)
            low, high = np.where(good, size, low), np.where(good, high, size - 1)
        return low


def crossing(symbols: np.ndarray, hashes: Hashes, low: np.ndarray, middle: np.ndarray, high: np.ndarray):
    """(node, start, end, period) of the runs of each node's words that cross its middle.

    They may go on outside of the node.
    """
    found = []
    half = (high - low) // 2
    for right in (False, True):
        each = np.minimum(high - middle if right else middle - low, half)
        offsets = np.concatenate([[0], each.cumsum()])
        for begin in range(0, int(offsets[-1]), SLICE):
            index = np.arange(begin, min(begin + SLICE, int(offsets[-1])))
            node = np.searchsorted(offsets, index, "right") - 1
            q = index - offsets[node] + 1
            # Words at ``at`` and ``at + q`` have to agree: those on both sides of the border.
            at = middle[node] - (1 if right else q)
            hit = np.flatnonzero(symbols[at] == symbols[at + q])
            at, q, node = at[hit], q[hit], node[hit]
            after, before = high[node] - at - q, at - low[node]
            on, off = after >= 3, before >= 3
            for step in (1, 2):
                on[on] = symbols[at[on] + step] == symbols[at[on] + q[on] + step]
            for step in (1, 2, 3):
                off[off] = symbols[at[off] - step] == symbols[at[off] + q[off] - step]
            hit = np.flatnonzero(on | off)  # LEAST - q or q agree, so six or more
            at, q, node, after, before = at[hit], q[hit], node[hit], after[hit], before[hit]
            after = hashes.extent(at, at + q, after, False)
            before = hashes.extent(at, at + q, before, True)
            good = after + before >= np.maximum(q, LEAST - q)
            found.append(np.stack([node, at - before, at + q + after, q])[:, good])
    node, start, end, q = np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)
    order = np.lexsort((q, end, start, node))
    node, start, end, q = node[order], start[order], end[order], q[order]
    first = np.ones(len(node), bool)
    first[1:] = (np.diff(node) != 0) | (np.diff(start) != 0) | (np.diff(end) != 0)
    return node[first], start[first], end[first], q[first]


def merged(start: np.ndarray, end: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one period that overlap by it joined, by start, then period; of equal ones the least period."""
    if not len(start):
        return start, end, q
    order = np.lexsort((start, q))
    start, end, q = start[order], end[order], q[order]
    number = np.concatenate([[0], np.cumsum(np.diff(q) != 0)])
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + number * span) - number * span
    apart = np.ones(len(start), bool)
    apart[1:] = (np.diff(q) != 0) | (start[1:] > reach[:-1] - q[1:])
    heads = np.flatnonzero(apart)
    start, end, q = start[heads], np.maximum.reduceat(end, heads), q[heads]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
    start, end, q = start[first], end[first], q[first]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _proved(symbols: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray, q: np.ndarray) -> bool:
    """Whether all runs hold, word by word, and no neighbour in the same text goes on with one."""
    n = len(symbols)
    for s, e, p in zip(start.tolist(), end.tolist(), q.tolist()):
        if not np.array_equal(symbols[s:e - p], symbols[s + p:e]):
            return False
        if s and text[s - 1] == text[s] and symbols[s - 1] == symbols[s - 1 + p]:
            return False
        if e < n and text[e] == text[s] and symbols[e] == symbols[e - p]:
            return False
    return True


def group_runs(symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of texts of these sizes that follow on one another."""
    none = np.empty(0, np.int64)
    if not len(symbols):
        return none, none, none
    begins = np.zeros(len(symbols), bool)
    offsets = np.cumsum(sizes) - sizes
    begins[offsets[sizes > 0]] = True
    text = np.cumsum(begins)
    seed = 1
    while True:
        hashes, found = Hashes(symbols, seed), []
        for low, middle, high, node, starts in nodes(symbols, begins):
            whose, start, end, q = crossing(symbols, hashes, low, middle, high)
            if not len(whose):
                continue
            # Every place of a node has all the runs of the node.
            counts = np.bincount(whose, minlength=len(low))
            heads = np.cumsum(counts) - counts
            times = counts[node]
            pick = np.repeat(heads[node], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            shift = np.repeat(starts, times) - low[whose[pick]]
            found.append(np.stack([start[pick] + shift, end[pick] + shift, q[pick]]))
        runs = merged(*np.concatenate(found, axis=1)) if found else (none, none, none)
        if _proved(symbols, text, *runs):
            return runs
        seed += 1


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _solve(texts: list[list[bytes] | None]) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Word counts, runs and collapsed texts of a group."""
    sizes = np.fromiter([len(t or ()) for t in texts], np.int64, len(texts))
    numbers = _Numbers()
    symbols = np.fromiter((numbers[w] for t in texts if t for w in t), np.int64, int(sizes.sum()))
    start, end, q = group_runs(symbols, sizes)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    dropped = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(dropped, start + q, 1)
    np.add.at(dropped, end, -1)
    kept = np.cumsum(dropped)[:-1] == 0
    bounds = np.searchsorted(start, offsets)
    collapsed = []
    for i, t in enumerate(texts):
        if t is None:
            collapsed.append(None)
        elif bounds[i] == bounds[i + 1]:
            collapsed.append(b" ".join(t))
        else:
            collapsed.append(b" ".join(compress(t, kept[offsets[i]:offsets[i + 1]].tolist())))
    text = np.searchsorted(offsets, start, "right") - 1
    structs = pa.StructArray.from_arrays([pa.array(start - offsets[text]), pa.array(end - start), pa.array(q)], ["start", "length", "period"])
    return pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), structs), pa.array(collapsed, pa.binary()).cast(pa.string())


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, runs (by start, then period) and the collapsed text.

    The collapsed text has the words, joined by one blank, that no run holds after its first period.
    """
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            group, total, first = [], 0, 0
            values = as_bytes(batch.column(1))
            for i, value in enumerate(values):
                found = None if value is None else value.split()
                values[i] = None
                if group and total + len(found or ()) > GROUP_WORDS:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(group)), *_solve(group)], ["doc_id", "n_words", "runs", "collapsed"])
                    group, total, first = [], 0, i
                group.append(found)
                total += len(found or ())
            if group:
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(group)), *_solve(group)], ["doc_id", "n_words", "runs", "collapsed"])

    return batchwise(picked, run, f"doc_id {picked.dtypes[0][1]}, n_words bigint, runs {RUNS}, collapsed string")


def planted(key: Column, text: Column) -> Column:
    """The text, in one document of ten with a repeated passage from some word to its end.

    With h the crc32 of the id and g = h div 10: if h mod 10 is 0, each word i >= a is word
    a + (i - a) mod p, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Texts of rows without an
    id stay as they are.
    """
    h = F.crc32(int_key(key).cast("binary"))
    g = F.floor(h / 10)

    def repeat(found: Column) -> Column:
        n = F.size(found).cast("bigint")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        numbers = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)))
        return F.when(n > 0, F.array_join(F.transform(numbers, lambda i: F.get(found, i.cast("int"))), " ")).otherwise(text)

    return F.when(key.isNotNull() & (h % 10 == 0), let(words(text), repeat)).otherwise(text)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its number of runs, its longest run, and digests of all runs and of the collapsed text."""
    changed = docs.select(F.col(key).alias("doc_id"), planted(F.col(key), F.col(text)).alias("text"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = find_runs(changed).withColumn("longest", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(F.array_join(listed, "\n"), F.lit("\n"))).otherwise(F.lit("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"),
    )
