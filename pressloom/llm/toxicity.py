"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

* **Sample.** A bounded number of labelled documents per class (``TOXIC`` and ``CLEAN``, of at most
  ``SAMPLE_WORDS`` words), drawn by a hash of the id, trains the model on the driver. Everything
  else reads whole texts.
* **Labelled tokens.** Labels are given per document. A word of a toxic document is tagged toxic if it, one
  of its beginnings or one of its endings stands in far more toxic documents than clean ones of the sample
  (``RATIO`` times as often, log-likelihood ratio ``CERTAIN`` or more); all other words are tagged
  clean. Half way through training, words of toxic documents that the model itself finds are added.
* **Field.** Two tags; a word's weight is the sum of those of the word, its beginnings, its endings and its two
  neighbours (hashed), plus weights of the tag's changes. Training follows the gradient of the exact
  likelihood: tags minus marginals, from the forward and backward recursions.
* **Recursions.** With two tags a message is one number, the log odds, and a step contracts it. All words are
  computed at once and then again only where the word before has moved, until none moves, which is the
  recursion's own result; for ordinary words that takes two or three rounds.
* **Scores.** The expected number of toxic words, their share of the text and its largest log odds go through a logistic
  function fitted on the third of the sample that the field has not seen, weighted to the shares that the
  classes have among all labelled rows. Spans are the words with marginals of one half or more.

Edge cases: null, empty and blank texts have no words and get the score of a text without any sign of
toxicity; a document's label is the largest of its label rows, null labels and rows without an id count as
unlabelled; without labels of both classes the score is the toxic share (0 if there are none); repeated
rows are scored alike; texts of any length are scored whole; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import WORD, batchwise, split_of

TOXIC, CLEAN, SAMPLE_WORDS = 1500, 4500, 600
RATIO, CERTAIN = 10.0, 25.0
BITS = 20
STEPS = 40
DECAY = 1e-4
THRESHOLD = 0.3
GROUP_WORDS = 200_000
CACHE = 300_000
FLOOR, TOP = -5.0, 3

_EDGES = b"".join(bytes([b]) for b in range(33, 127) if not chr(b).isalnum())
_WORDS = re.compile(WORD)


def features(word: bytes) -> list[int]:
    """Hashed features of a word: itself, its beginnings and its endings; the first is the word."""
    core = word.strip(_EDGES) or word
    mask = (1 << BITS) - 1
    out = [crc32(core, 1) & mask]
    for size in (3, 4, 5, 6, 7, 8):
        if len(core) > size:
            out.append(crc32(core[:size], 100 + size) & mask)
            if size < 6:
                out.append(crc32(core[-size:], 200 + size) & mask)
    return out


def split(text: str | None) -> list[bytes]:
    """Lower-case words."""
    return [] if text is None else text.lower().encode("utf-8", "replace").split()


@dataclass
class Field:
    """Weights of the tag "toxic" per feature, of the words before and after, and of the changes of the tag."""

    own: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    before: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    after: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    # Weights of: any word, the first word, clean to toxic, toxic to clean, toxic to toxic.
    tags: np.ndarray = field(default_factory=lambda: np.array([-4.0, 0.0, 0.0, 0.0, 1.0]))
    # Weights of the evidence of a text, the first of which is one.
    scale: np.ndarray = field(default_factory=lambda: np.array([-30.0] + [0.0] * (2 + TOP)))


def _settle(energy: np.ndarray, fixed: np.ndarray, step) -> np.ndarray:
    """x[i] = energy[i] + step(x[i - 1]), and energy[i] where ``fixed``, to the last bit that matters."""
    x = energy + np.where(fixed, 0.0, step(np.float64(-40.0)))
    at = np.flatnonzero(~fixed)
    while len(at):
        new = energy[at] + step(x[at - 1])
        moved = np.abs(new - x[at]) > 1e-10
        x[at] = new
        at = at[moved] + 1
        at = at[at < len(x)]
        at = at[~fixed[at]]
    return x


def recursions(energy: np.ndarray, begins: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages as log odds of "toxic"; their sum is that of the marginal."""
    _, first, into, out, on = tags
    forward = _settle(energy + np.where(begins, first, 0.0), begins, lambda r: np.logaddexp(into, on + r) - np.logaddexp(0.0, out + r))
    # The backward message with the word's own energy, from the last word to the first.
    ends = np.append(begins[1:], True)[::-1]
    backward = _settle(energy[::-1].copy(), ends, lambda s: np.logaddexp(out, on + s) - np.logaddexp(0.0, into + s))[::-1] - energy
    return forward, backward


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def energies(model: Field, own: np.ndarray, before: np.ndarray, after: np.ndarray, words: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Log weight of "toxic" of every word; ``own``, ``before`` and ``after`` are the weights of each number in ``words``."""
    energy = own[words] + model.tags[0]
    inner = ~begins[1:]
    energy[1:] += np.where(inner, before[words[:-1]], 0.0)
    energy[:-1] += np.where(inner, after[words[1:]], 0.0)
    return energy


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.mean, self.square = rate, 0, {}, {}

    def move(self, name: str, values: np.ndarray, gradient: np.ndarray) -> None:
        mean = self.mean[name] = 0.9 * self.mean.get(name, 0.0) + 0.1 * gradient
        square = self.square[name] = 0.99 * self.square.get(name, 0.0) + 0.01 * gradient * gradient
        rate = self.rate / (1 - 0.9 ** self.step)
        values += (rate * mean / (np.sqrt(square / (1 - 0.99 ** self.step)) + 1e-6)).astype(values.dtype)


class Corpus:
    """Texts as numbered words with their features."""

    def __init__(self, texts: list[list[bytes]]):
        texts = [t for t in texts if t]
        numbers: dict[bytes, int] = defaultdict(lambda: len(numbers))
        self.words = np.fromiter((numbers[w] for t in texts for w in t), np.int64)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text = np.repeat(np.arange(len(texts)), self.sizes)
        self.begins = np.append(True, np.diff(self.text) != 0) if len(self.text) else np.empty(0, bool)
        listed = [features(w) for w in numbers]
        self.counts = np.fromiter(map(len, listed), np.int64, len(listed))
        self.features = np.fromiter((f for one in listed for f in one), np.int64)
        self.heads = np.cumsum(self.counts) - self.counts

    def weights(self, table: np.ndarray, alone: bool = False) -> np.ndarray:
        """The sum of the weights of each word's features, or that of the word alone."""
        return table[self.features[self.heads]].astype(float) if alone else np.add.reduceat(table[self.features].astype(float), self.heads)

    def gradient(self, per_word: np.ndarray, alone: bool = False) -> np.ndarray:
        """The same the other way: sums over words for each feature."""
        if alone:
            return np.bincount(self.features[self.heads], per_word, 1 << BITS)
        return np.bincount(self.features, np.repeat(per_word, self.counts), 1 << BITS)

    def documents(self) -> np.ndarray:
        """In how many texts each feature stands."""
        pairs = np.unique(self.text * len(self.counts) + self.words)
        text, word = pairs // len(self.counts), pairs % len(self.counts)
        total = np.zeros(1 << BITS, np.int64)
        for part in np.array_split(np.arange(len(pairs)), max(1, len(pairs) // 200_000)):
            sizes = self.counts[word[part]]
            at = np.repeat(self.heads[word[part]] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
            # A text on the border of two parts may count twice for a feature.
            total += np.bincount(np.unique(np.repeat(text[part], sizes) << BITS | self.features[at]) & ((1 << BITS) - 1), minlength=1 << BITS)
        return total


def signs(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Features that stand in far more toxic texts than clean ones, as a boolean per feature."""
    share = n_toxic / (n_toxic + n_clean)
    both = toxic + clean
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(toxic > 0, toxic * np.log(toxic / (both * share)), 0) + np.where(clean > 0, clean * np.log(clean / (both * (1 - share))), 0))
    return (ratio >= CERTAIN) & (toxic * n_clean >= RATIO * clean * n_toxic)


def train(toxic: list[list[bytes]], clean: list[list[bytes]], steps: int = STEPS) -> Field:
    """A field from texts of the two classes."""
    model = Field()
    both = Corpus(toxic + clean)
    if not len(both.words):
        return model
    n_toxic = sum(1 for t in toxic if t)
    found = signs(Corpus(toxic).documents() if n_toxic else np.zeros(1 << BITS, np.int64), Corpus(clean).documents() if any(clean) else np.zeros(1 << BITS, np.int64), max(1, n_toxic), max(1, len(clean)))
    from_toxic = both.text < n_toxic
    marked = np.logical_or.reduceat(found[both.features], both.heads)
    tag = from_toxic & marked[both.words]
    inner = np.flatnonzero(~both.begins)
    adam = _Adam(0.15)
    n, kinds = len(both.words), len(both.counts)
    for step in range(steps):
        own, before, after = both.weights(model.own), both.weights(model.before, True), both.weights(model.after, True)
        energy = energies(model, own, before, after, both.words, both.begins)
        forward, backward = recursions(energy, both.begins, model.tags)
        marginal = sigmoid(forward + backward)
        if step == steps // 2:
            tag |= from_toxic & (marginal > 0.5)
        wrong = tag - marginal
        # Expected changes of the tag, from the messages on both sides of each border.
        left, right = forward[inner - 1], energy[inner] + backward[inner]
        _, first, into, out, on = model.tags
        pair = np.stack([np.zeros(len(inner)), into + right, left + out, left + on + right])
        pair = np.exp(pair - pair.max(0, initial=0.0))
        pair /= pair.sum(0)
        was, now = tag[inner - 1], tag[inner]
        changes = [(~was & now).sum() - pair[1].sum(), (was & ~now).sum() - pair[2].sum(), (was & now).sum() - pair[3].sum()]
        scale = 1.0 / max(1, int(tag.sum()))
        adam.step = step + 1
        adam.move("tags", model.tags, scale * np.array([wrong.sum(), wrong[both.begins].sum(), *changes]))
        adam.move("own", model.own, scale * both.gradient(np.bincount(both.words, wrong, kinds)) - DECAY * model.own)
        shifted = np.zeros(n)
        shifted[inner - 1] = wrong[inner]
        adam.move("before", model.before, scale * both.gradient(np.bincount(both.words, shifted, kinds), True) - DECAY * model.before)
        shifted = np.zeros(n)
        shifted[inner] = wrong[inner - 1]
        adam.move("after", model.after, scale * both.gradient(np.bincount(both.words, shifted, kinds), True) - DECAY * model.after)
    return model


class Tagger:
    """A field at work; keeps the weights of up to ``CACHE`` words."""

    def __init__(self, model: Field):
        self.model = model
        self.numbers: dict[bytes, int] = {}
        self.tables = np.zeros((3, 1024))

    def _number(self, word: bytes) -> int:
        number = self.numbers.get(word)
        if number is None:
            number = self.numbers[word] = len(self.numbers)
            if number == self.tables.shape[1]:
                self.tables = np.concatenate([self.tables, np.zeros_like(self.tables)], axis=1)
            listed = features(word)
            own, before, after = self.model.own, self.model.before, self.model.after
            self.tables[:, number] = sum(own[f] for f in listed), before[listed[0]], after[listed[0]]
        return number

    def odds(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of the marginal of every word, and where each text begins (one more at the end)."""
        if len(self.numbers) > CACHE:
            self.numbers.clear()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        words = np.fromiter((self._number(w) for t in texts for w in t), np.int64, int(offsets[-1]))
        if not len(words):
            return np.empty(0), offsets
        begins = np.zeros(len(words), bool)
        begins[offsets[:-1][sizes > 0]] = True
        energy = energies(self.model, *self.tables, words, begins)
        forward, backward = recursions(energy, begins, self.model.tags)
        return forward + backward, offsets

    @staticmethod
    def evidence(odds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: one, logs of the expected toxic words and of their share of all words, the ``TOP`` largest log odds."""
        sizes = np.diff(offsets)
        filled = np.flatnonzero(sizes > 0)
        out = np.full((len(sizes), 3 + TOP), FLOOR)
        out[:, 0] = 1.0
        if len(filled):
            expected = np.add.reduceat(sigmoid(odds), offsets[filled])
            out[filled, 1], out[filled, 2] = np.log(expected + np.exp(FLOOR)), np.log(expected / sizes[filled] + np.exp(FLOOR))
            high = np.flatnonzero(odds > FLOOR)
            text = np.searchsorted(offsets, high, "right") - 1
            order = np.lexsort((-odds[high], text))
            high, text = high[order], text[order]
            heads = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else text
            place = np.arange(len(text)) - np.repeat(heads, np.diff(heads, append=len(text)))
            top = place < TOP
            out[text[top], 3 + place[top]] = np.minimum(odds[high[top]], -FLOOR)
        return out


def calibrate(evidence: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights of a logistic function, by Newton's method with a small penalty."""
    found = np.zeros(evidence.shape[1])
    penalty = 1e-2 * np.eye(len(found))
    for _ in range(50):
        p = sigmoid(evidence @ found)
        gradient = evidence.T @ (weights * (labels - p)) - penalty @ found
        step = np.linalg.solve((evidence * (weights * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ evidence + penalty, gradient)
        found += np.clip(step, -2.0, 2.0)
        if np.abs(step).max() < 1e-8:
            break
    return found


def draw(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
         folds: int = 4, held_out: int = 2, toxic: int = TOXIC, clean: int = CLEAN) -> tuple[list, dict[int, int]]:
    """(label, part, words) of the sample, and how many labelled documents each class has.

    Labels of the fold that is held out are not read. Sampling by the narrow label table leaves a bounded set of
    ids, which finds its texts by a broadcast join.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (split_of(F.col(key), folds) != held_out))
    known = known.groupBy(F.col(key).alias("k")).agg(F.max(F.col(label).cast("int")).alias("y")).where("y IN (0, 1)")
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = {y: min(1.0, most / max(1, counts.get(y, 0))) for y, most in ((0, clean), (1, toxic))}
    spot = F.pmod(F.xxhash64(F.col("k").cast("string")), F.lit(1_000_000))
    picked = known.where(spot < F.when(F.col("y") == 1, share[1]).otherwise(share[0]) * 1_000_000).limit(2 * (toxic + clean))
    fits = F.length(text) <= 12 * SAMPLE_WORDS
    found = docs.where(F.col(text).isNotNull() & fits).select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(picked), "k")
    rows = found.select("y", F.pmod(F.xxhash64(F.lit(5), F.col("k").cast("string")), F.lit(3)).alias("part"), "t", "k").limit(2 * (toxic + clean)).collect()
    rows.sort(key=lambda r: (str(r.k), r.t))
    return [(r.y, r.part, found) for r in rows if len(found := split(r.t)) <= SAMPLE_WORDS], counts


def learn(sample: list, counts: dict[int, int]) -> Field:
    """The field and its calibration from a sample."""
    model = train([w for y, part, w in sample if y and part], [w for y, part, w in sample if not y and part])
    rest = [(y, w) for y, part, w in sample if not part]
    total = sum(counts.values())
    labels = np.array([y for y, _ in rest], float)
    if not counts.get(0) or not counts.get(1) or len(set(labels.tolist())) < 2:
        share = counts.get(1, 0) / total if total else 0.0
        model.scale[0] = np.clip(np.log(share / (1 - share)), -30, 30) if 0 < share < 1 else 30.0 * (share or -1)
        return model
    tagger = Tagger(model)
    evidence = tagger.evidence(*tagger.odds([w for _, w in rest]))
    drawn = {y: (labels == y).mean() for y in (0, 1)}
    model.scale = calibrate(evidence, labels, np.where(labels == 1, counts[1] / total / drawn[1], counts[0] / total / drawn[0]))
    return model


def spans_of(text: str, odds: np.ndarray) -> list[tuple[int, int]]:
    """Code points of the stretches of words with log odds of 0 or more."""
    out, last = [], -2
    for i, found in enumerate(_WORDS.finditer(text)):
        if odds[i] >= 0:
            if last == i - 1:
                out[-1] = (out[-1][0], found.end())
            else:
                out.append(found.span())
            last = i
    return out


def score(docs: DataFrame, model: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, score (0 to 1) and spans, the offending stretches as [start, end) in code points."""
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        tagger = Tagger(model)

        def solve(keys, group):
            odds, offsets = tagger.odds([w for _, w in group])
            scores = sigmoid(tagger.evidence(odds, offsets) @ model.scale)
            spans = []
            for (value, _), a, b in zip(group, offsets, offsets[1:]):
                own = odds[a:b]
                spans.append([{"start": s, "end": e} for s, e in spans_of(value, own)] if (own >= 0).any() else [])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return pa.RecordBatch.from_arrays([keys, pa.array(scores), pa.array(spans, kind)], ["doc_id", "score", "spans"])

        for batch in batches:
            group, total, first = [], 0, 0
            for i, value in enumerate(batch.column(1)):
                value = value.as_py()
                found = split(value)
                if group and total + len(found) > GROUP_WORDS:
                    yield solve(batch.column(0).slice(first, len(group)), group)
                    group, total, first = [], 0, i
                group.append((value, found))
                total += len(found)
            if group:
                yield solve(batch.column(0).slice(first, len(group)), group)

    return batchwise(picked, run, f"doc_id {picked.dtypes[0][1]}, score double, spans array<struct<start: bigint, end: bigint>>")


def held_out_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted and spans (start:end, comma-joined) of every document."""
    model = learn(*draw(docs, labels, key, text, label))
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return score(docs, model, key, text).select(
        "doc_id", (split_of(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), listed.alias("spans"))
