"""Language identification by prediction by partial matching (PPM).

Every language has a byte context tree of variable order, frozen after training. A text is coded
word by word: the contexts of a byte are the bytes before it in its word, up to ``order`` of them
and the blank in front. The byte is coded in the longest known context; where it is new there, an
escape (method C, with exclusion) leads to the next shorter one and at last to equal odds for all
bytes not yet excluded. The code length of a text under a language is the exact sum over all its
bytes; the language of the shortest code is predicted. As the statistics are frozen, a word's code
length is the same wherever it stands, so tasks remember it.

Training reads a sample of at most about ``per_language`` documents of each language, drawn by a
hash of the id and text, and keeps all (context, byte) counts of it, in every language alike;
the size of the sample is a parameter.

Edge cases: a null text or one without a letter is ``und`` with score 0, as is every text when no
language could be learned; texts of any length are coded whole; ties go to the first language by
name; rows without an id belong to the fold of the empty text; repeated rows get equal results;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import batchwise, split_of
from pressloom.operators.joins import lookup
from pressloom.session import materialize

ORDER = 4
WORDS_KEPT = 200_000
STEPS_KEPT = 400_000
LONG_WORD = 64
SLICE = 50_000  # words of a text handled at once


def lowered(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


class Rows(dict):
    """Row by key, -1 for a key it does not hold."""

    def __missing__(self, key: bytes) -> int:
        return -1


def steps(word: bytes, order: int) -> list[bytes]:
    """For each byte of a word and the blank after it: its context and itself, as one string."""
    s = b" " + word + b" "
    return [s[max(0, i - order):i + 1] for i in range(1, len(s))]


class ContextTrees:
    """Frozen counts per language and the code lengths that follow from them."""

    def __init__(self, rows: list[tuple[str, bytes, int]], order: int):
        """``rows``: language, context with its next byte, count."""
        self.order = order
        self.languages = sorted({r[0] for r in rows})
        self.trees: list[dict[bytes, dict[int, int]]] = [defaultdict(dict) for _ in self.languages]
        at = {name: i for i, name in enumerate(self.languages)}
        for name, gram, n in rows:
            self.trees[at[name]][gram[:-1]][gram[-1]] = n
        self.trees = [dict(t) for t in self.trees]
        self._forget()

    def _forget(self) -> None:
        """Nothing is remembered yet. Words: the first ``WORDS_KEPT`` met, which hold the common ones."""
        self.word_rows, self.step_rows = Rows(), Rows()
        self.totals: dict[int, int] = {}
        self.word_bits = np.empty((WORDS_KEPT, len(self.languages)))
        self.step_bits = np.empty((STEPS_KEPT, len(self.languages)))

    def __getstate__(self):
        return {"order": self.order, "languages": self.languages, "trees": self.trees}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def bits(self, tree: dict[bytes, dict[int, int]], gram: bytes) -> float:
        """Code length of the last byte of ``gram`` after the bytes before it."""
        context, byte = gram[:-1], gram[-1]
        odds, excluded = 1.0, frozenset()
        for start in range(len(context) + 1):
            node = tree.get(context[start:])
            if not node:
                continue
            # Counts of bytes that longer contexts have not excluded already.
            total, distinct = self._total(node), len(node)
            if excluded:
                both = excluded & node.keys()
                total -= sum(map(node.__getitem__, both))
                distinct -= len(both)
            if byte in node:
                return -math.log2(odds * node[byte] / (total + distinct))
            if distinct:
                odds *= distinct / (total + distinct)
                excluded = excluded | node.keys()
        return -math.log2(odds / max(1, 256 - len(excluded)))

    def _total(self, node: dict[int, int]) -> int:
        found = self.totals.get(id(node))
        if found is None:
            found = self.totals[id(node)] = sum(node.values())
        return found

    def _steps_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Code lengths of all steps of the words, and where each word begins among them."""
        lists = [steps(w, self.order) for w in words]
        flat = [gram for one in lists for gram in one]
        known = self.step_rows
        rows = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
        new = {flat[i] for i in np.flatnonzero(rows < 0)}
        if new:
            if len(known) + len(new) > STEPS_KEPT:
                known.clear()
                new = set(flat)
            for gram in new:
                self.step_bits[len(known)] = [self.bits(tree, gram) for tree in self.trees]
                known[gram] = len(known)
            rows = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
        return self.step_bits[rows], np.cumsum([0, *map(len, lists[:-1])])

    def words(self, words: list[bytes]) -> np.ndarray:
        """Code length of each word under each language."""
        bits, begins = self._steps_of(words)
        return np.add.reduceat(bits, begins, axis=0)

    def text(self, text: str) -> np.ndarray:
        """Code length of the whole text under each language."""
        words = lowered(text).split()
        out = np.zeros(len(self.languages))
        for at in range(0, len(words), SLICE):
            part = words[at:at + SLICE]
            rows = np.fromiter(map(self.word_rows.__getitem__, part), np.int64, len(part))
            out += self.word_bits[rows[rows >= 0]].sum(axis=0)
            missing = [part[i] for i in np.flatnonzero(rows < 0)]
            # A very long word has more steps than are remembered at once.
            out += sum((self._long(w) for w in missing if len(w) > LONG_WORD), np.zeros(len(self.languages)))
            short = [w for w in missing if len(w) <= LONG_WORD]
            for low in range(0, len(short), 2000):
                out += self._new(short[low:low + 2000])
        return out

    def _new(self, words: list[bytes]) -> np.ndarray:
        costs = self.words(words)
        for w, cost in zip(words, costs):
            if len(self.word_rows) >= WORDS_KEPT:
                break
            if w not in self.word_rows:
                self.word_bits[len(self.word_rows)] = cost
                self.word_rows[w] = len(self.word_rows)
        return costs.sum(axis=0)

    def _long(self, word: bytes) -> np.ndarray:
        """A word that is not remembered, byte by byte."""
        s, out = b" " + word + b" ", np.zeros(len(self.languages))
        for at in range(1, len(s), 10_000):
            grams = Counter(s[max(0, i - self.order):i + 1] for i in range(at, min(at + 10_000, len(s))))
            for gram, n in grams.items():
                out += [n * self.bits(tree, gram) for tree in self.trees]
        return out


def _grams(docs: DataFrame, order: int, limit: int = 100_000) -> DataFrame:
    """(lang, gram, n) of a sample; words are counted first, then their steps once per word."""

    def words(batches):
        found: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update((lang, w) for w in lowered(text).split())
                if len(found) > limit:
                    yield rows(found, "word")
                    found.clear()
        yield rows(found, "word")

    def grams(batches):
        for batch in batches:
            found: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for gram in steps(word, order):
                    for start in range(len(gram)):
                        found[lang, gram[start:]] += n
            yield rows(found, "gram")

    def rows(found: Counter, name: str) -> pa.RecordBatch:
        langs, grams_ = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(grams_, pa.binary()), pa.array(found.values(), pa.int64())], ["lang", name, "n"])

    counted = batchwise(docs, words, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return batchwise(counted, grams, "lang string, gram binary, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text", order: int = ORDER, per_language: int = 1000) -> ContextTrees:
    """Context trees of the languages of labelled documents; all nodes of the sample are kept, which bounds them."""
    draw = F.xxhash64(F.lit(3), F.col(key), F.col(text)).alias("_draw")
    labelled = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), draw).dropna()
    # Stored first: Spark then sees how small it is and need not shuffle the texts for the join.
    sizes = materialize(labelled.groupBy("lang").agg(F.count("*").alias("_size")), "language-sizes")
    drawn = lookup(labelled, sizes, "lang", ["_draw"], "inner")
    sample = drawn.where(F.shiftrightunsigned("_draw", 11).cast("double") * 2.0**-53 * F.col("_size") < per_language)
    counts = _grams(sample.select("lang", "text"), order)
    ordered = counts.orderBy(F.col("n").desc(), "lang", "gram")
    return ContextTrees([(r["lang"], bytes(r["gram"]), r["n"]) for r in ordered.toLocalIterator()], order)


def identify(docs: DataFrame, trees: ContextTrees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred and score, the share of the best language in all likelihoods."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {picked.dtypes[0][1]}, lang_pred string, score double"

    def run(batches):
        model = shared.value
        for batch in batches:
            names, scores = [], []
            for value in batch.column(1):
                one = value.as_py()
                if not model.languages or one is None or not any(map(str.isalpha, one)):
                    names.append("und")
                    scores.append(0.0)
                    continue
                bits = model.text(one)
                best = int(bits.argmin())
                names.append(model.languages[best])
                scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return batchwise(picked, run, schema)


def held_out_report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", parts: int = 3, held: int = 1, **options) -> DataFrame:
    """Learn from the folds that are not held out and predict every document."""
    fold = split_of(F.col(key), parts)
    trees = train(docs.where(fold != held), key, lang, text, **options)
    found = identify(docs, trees, key, text)
    return found.select("doc_id", (split_of(F.col("doc_id"), parts) == held).alias("held_out"), "lang_pred", "score")
