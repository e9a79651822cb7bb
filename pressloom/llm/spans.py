"""Substring dedup by sliding sentence spans.

A text is cut into sentences: at line ends, after a stop (``STOPS``), and before a capital that
follows a lower-case word (where one text was set into another without a stop). Of every ``LONGEST``
borders in a row that are left, the one before the word of the smallest hash (or all such) is a border too, so no
sentence has more than ``LONGEST`` words. All borders depend on the words around them alone, at most
``LONGEST`` to either side, and not on where a text or a line begins: any passage of
``RUN_WORDS + 4 * LONGEST - 1`` = 51 words in a line holds a run that is the same in every text.
In scripts without blanks every character is a word. From every sentence starts a run, the shortest one of at least ``RUN_SENTENCES``
sentences and ``RUN_WORDS`` words. A run that stands in more than one place is repeated; its first
place, by document id and position, stays, and the sentences of every other place are removed.

* Runs are hashed to two 64-bit numbers. A first, map-side combining count finds the hashes that
  occur twice; only their places are joined back, stored, and compared on both numbers. The joins
  are plain equi-joins that may split a hash with very many places.
* A document is told by its id and its text, so rows of one id do not mix.

Edge cases: null stays null and empty stays empty; texts without a whole run are unchanged; rows
that agree in id and text are one document, whose places are not repeats of each other; rows
without an id come after all others; a text may repeat itself; ids must be integers; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import batchwise, merge_spans
from pressloom.llm.shingles import mix
from pressloom.session import materialize

# Full stops, question and exclamation marks of the scripts in use.
STOPS = frozenset(".!?\u2026\u3002\uff01\uff1f\uff0e\uff61\u061f\u06d4\u0964\u0965\u0589\u1362\u1367\u1368\u104b\u17d4\u0f0d")
LONGEST = 8
RUN_SENTENCES = 3
RUN_WORDS = 20

# Scripts without blanks: Thai, Lao, Tibetan, Burmese, Khmer, kana and Han with their punctuation.
_WIDE = "\u0e00-\u109f\u1780-\u17ff\u2e80-\u2fff\u3001-\u312f\u31a0-\u9fff\uf900-\ufaff\uff00-\uff9f\U00020000-\U0003ffff"
_MARKS = "".join(c for c in map(chr, [*range(0x0E00, 0x10A0), *range(0x1780, 0x1800), 0x3099, 0x309A, *range(0xFE00, 0xFE10)]) if unicodedata.category(c)[0] == "M")
WIDE = re.compile(f"[{_WIDE}]")
UNITS = re.compile(rf"[{_WIDE}][{_MARKS}]*|[^\s{_WIDE}]+")

_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)


_random = random.Random(1)
_BYTES = np.array([_random.getrandbits(64) for _ in range(256)], np.uint64)
_STOP_BYTES = np.array([chr(b) in STOPS and b < 128 for b in range(256)])
_STEPS = (1, 2, 4)  # windows of 2, 4 and LONGEST keys


def words(line: str) -> list[str]:
    """Blank-separated words, and the characters of scripts without blanks."""
    return line.split() if line.isascii() or not WIDE.search(line) else UNITS.findall(line)


class Powers:
    """Powers of the multiplier and of its inverse, modulo 2^64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _P, np.uint64)]).cumprod(dtype=np.uint64)
            self.down = np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _INVERSE, np.uint64)]).cumprod(dtype=np.uint64)
        return self.up, self.down


def borders(text: str, powers: Powers) -> tuple[list[str], bytes, np.ndarray, np.ndarray]:
    """All words, their lower-case bytes joined by blanks, where in the bytes each begins, and the first word of each sentence."""
    lines = [words(line) for line in text.split("\n")]
    flat = [w for line in lines for w in line]
    n = len(flat)
    data = " ".join(flat).lower().encode("utf-8", "replace")
    if not n:
        return flat, data, np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer(data, np.uint8)
    at = np.concatenate([[0], np.flatnonzero(codes == 32) + 1])
    sizes = np.diff(at, append=len(data) + 1)
    place = np.arange(len(data)) - np.repeat(at, sizes)[:len(data)]
    hashes = mix(np.add.reduceat(_BYTES[codes] * powers.upto(int(sizes.max()))[0][place], at))
    last = codes[at + sizes - 2]
    stop = _STOP_BYTES[last]
    for i in np.flatnonzero(last > 127):
        stop[i] = flat[i][-1] in STOPS
    capital = np.fromiter([w[0].isupper() for w in flat], bool, n)
    # Key of the border before each word: the hash, or 0 for a border of its own right.
    keys = np.zeros(n + LONGEST, np.uint64)
    keys[1:n] = np.where(stop[:-1] | capital[1:] & ~capital[:-1], 0, hashes[1:] | 1)
    keys[np.fromiter(map(len, lines), np.int64, len(lines)).cumsum()] = 0
    # A border stays if its key is the smallest of some LONGEST in a row; a 0 among them wins.
    least, most = keys, np.zeros(n + LONGEST, np.uint64)
    for step in _STEPS:
        least = np.minimum(least[:-step], least[step:])
    most[LONGEST:] = least[:n]
    most = most[1:]
    for step in _STEPS:
        most = np.maximum(most[:-step], most[step:])
    return flat, data, at, np.flatnonzero(keys[:n] == most[:n])


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence."""
    flat, _, _, begins = borders(text, Powers())
    edges = [*begins.tolist(), len(flat)]
    return [flat[a:b] for a, b in zip(edges, edges[1:])]


def run_ends(counts: np.ndarray) -> np.ndarray:
    """For each sentence the end (exclusive) of its run; past the text if there is no whole run."""
    words = np.concatenate([[0], counts.cumsum()])
    return np.maximum(np.arange(len(counts)) + RUN_SENTENCES, np.searchsorted(words, words[:-1] + RUN_WORDS))


def runs(text: str, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and the two hashes of each run."""
    flat, data, at, begins = borders(text, powers)
    n = len(begins)
    ends = run_ends(np.diff(begins, append=len(flat)))
    starts = np.flatnonzero(ends <= n)
    if not len(starts):
        none = np.empty(0, np.int64)
        return none, none, none
    ends = ends[starts]
    cuts = [*at[begins].tolist(), len(data) + 1]
    digests = b"".join([xxhash.xxh3_128_digest(data[a:b - 1]) for a, b in zip(cuts, cuts[1:])])
    lanes = np.frombuffer(digests, "<u8").reshape(-1, 2)
    up, down = powers.upto(n)
    length = (ends - starts).astype(np.uint64)
    hashes = []
    for lane in range(2):
        total = np.concatenate([np.zeros(1, np.uint64), (lanes[:, lane] * up[:n]).cumsum(dtype=np.uint64)])
        hashes.append(mix((total[ends] - total[starts]) * down[starts] + length).view(np.int64))
    return starts, hashes[0], hashes[1]


def covered(parts: list[list[str]], starts: list[int]) -> list[tuple[int, int]]:
    """Merged spans of the sentences under the runs that begin at ``starts``."""
    ends = run_ends(np.fromiter(map(len, parts), np.int64, len(parts)))
    return merge_spans([(s, int(ends[s])) for s in starts])


def remove(text: str, parts: list[list[str]], gone: list[tuple[int, int]]) -> str:
    """The text without the given spans of its sentences; other characters stay."""
    begins, at = [], 0
    for part in parts:
        for i, w in enumerate(part):
            at = text.index(w, at)
            if i == 0:
                begins.append(at)
            at += len(w)
    begins.append(len(text))
    out, kept_to = [], 0
    for start, end in gone:
        out.append(text[kept_to:begins[start]])
        kept_to = begins[end]
    out.append(text[kept_to:])
    return "".join(out)


def _identity(key: str, text: str) -> list[Column]:
    """(no_id, d, t): the document; in order of the first two."""
    return [F.col(key).isNull().alias("no_id"), F.coalesce(F.col(key).cast("bigint"), F.xxhash64(text)).alias("d"), F.hash(text).alias("t")]


def run_table(docs: DataFrame, key: str, text: str, places: bool) -> DataFrame:
    """All runs: hash h, and with ``places`` also g, the document and the place in it."""
    picked = docs.select(*_identity(key, text), F.col(text).alias("text")).where("text IS NOT NULL")
    if not places:
        picked = picked.select("text")
    names = ["no_id", "d", "t", "start", "h", "g"] if places else ["h"]

    def run(batches):
        powers = Powers()
        for batch in batches:
            found = [runs(x.as_py(), powers) for x in batch.column(batch.num_columns - 1)]
            sizes = [len(f[0]) for f in found]
            joined = [np.concatenate([f[i] for f in found]) for i in range(3)]
            if not places:
                yield pa.RecordBatch.from_arrays([pa.array(joined[1])], names)
                continue
            rows = pa.array(np.repeat(np.arange(len(found)), sizes))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(rows) for i in range(3)], pa.array(joined[0].astype(np.int32)), pa.array(joined[1]), pa.array(joined[2])], names)

    schema = "no_id boolean, d bigint, t int, start int, h bigint, g bigint" if places else "h bigint"
    return batchwise(picked, run, schema)


def repeated_places(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(no_id, d, t, start) of every run that is repeated and not the first of its kind."""
    # Stored before the joins: an aggregate right below one would keep a hot hash in one task.
    twice = materialize(run_table(docs, key, text, False).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated")
    near = materialize(run_table(docs, key, text, True).join(twice, "h"), "near-runs")
    place = F.struct("no_id", "d", "t", "start")
    firsts = near.groupBy("h", "g").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").drop("last")
    firsts = materialize(firsts, "first-runs")
    return near.join(firsts, ["h", "g"]).where(place != F.col("first")).select("no_id", "d", "t", "start")


def dedup_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_removed (sentences) and the text without repeated runs.

    Only documents that hold a place to remove are cut into sentences again.
    """
    places = repeated_places(docs, key, text)
    per_doc = places.groupBy("no_id", "d", "t").agg(F.collect_set("start").alias("starts"))
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *_identity(key, text))
    joined = picked.join(per_doc, ["no_id", "d", "t"], "left").select("doc_id", "text", "starts")

    def run(batches):
        powers = Powers()
        for batch in batches:
            found = batch.column(2)
            texts, gone = batch.column(1), np.zeros(len(found), np.int64)
            if found.null_count < len(found):
                out = texts.to_pylist()
                for i in np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False)):
                    flat, _, _, begins = borders(out[i], powers)
                    edges = [*begins.tolist(), len(flat)]
                    parts = [flat[a:b] for a, b in zip(edges, edges[1:])]
                    spans = covered(parts, found[i].as_py())
                    gone[i] = sum(e - s for s, e in spans)
                    out[i] = remove(out[i], parts, spans)
                texts = pa.array(out, texts.type)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone), texts], ["doc_id", "n_removed", "text"])

    return batchwise(joined, run, f"doc_id {picked.dtypes[0][1]}, n_removed bigint, text string")
