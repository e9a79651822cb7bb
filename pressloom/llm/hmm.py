"""Hidden Markov language model: Baum-Welch over partitions, exact likelihood by forward recursion.

Tokens are the lower-cased words of a text and one end. A hidden state emits a class: each of the
at most ``own_classes`` most frequent words and the end are classes of their own, all other words
share ``GROUPS`` classes by their last three bytes. A word of a group has, whatever the state, the
share (c + 1) / (words of the group + distinct words of the group + 1) of it, where c is its count
in the training texts; so every text has a positive likelihood.

* Counts of all training words are one distributed aggregate. The at most ``head_words`` most
  frequent words travel to the tasks with the model (a fixed bound); a text's other words are
  joined to their counts, so the vocabulary may be of any size.
* Baum-Welch: each partition runs forward and backward over its texts, in pieces of ``PIECE``
  tokens, and returns expected counts; Spark adds them up and the driver divides. The first rounds
  run on a sample of about ``warm_docs`` documents, the last ``rounds`` on all training documents.
* Scoring is the scaled forward recursion over the whole text. Long texts are cut into pieces whose
  transfer matrices are multiplied in order, which is the same sum.

Edge cases: null and wordless texts are the end alone; rows without an id belong to the fold of
the empty text; an empty training side makes all classes equally likely; repeated rows get equal
results; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import as_bytes, batchwise, split_of
from pressloom.session import materialize

END = b""
STATES = 8
GROUPS = 256
PIECE = 256
BLOCK = 400_000  # tokens handled at once in a task
PRIOR = 20.0
SCALE_EVERY = 8


def tokens(text: bytes | None) -> list[bytes]:
    """Blank-separated words with A-Z lower-cased, then the end."""
    return [*(text.lower().split() if text else ()), END]


def group_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % GROUPS


class Head(dict):
    """Index by word, -1 for a word it does not hold."""

    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class Vocabulary:
    """Frequent words with their classes; sizes of the groups; totals of the training tokens."""

    total: int
    distinct: int
    head: Head
    classes: np.ndarray          # of each head word
    log_count: np.ndarray        # log10(c + 1) of each head word
    log_share: np.ndarray        # log10 share within its class of each head word
    group_log: np.ndarray        # log10 of each group's denominator
    class_counts: np.ndarray = field(repr=False)

    @property
    def size(self) -> int:
        return len(self.class_counts)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Class of every token, head index of every token (-1: not in the head), the other words."""
        index = np.fromiter(map(self.head.__getitem__, words), np.int32, len(words))
        ids = self.classes[index]
        rest = np.flatnonzero(index < 0)
        other = [words[i] for i in rest]
        if other:
            ids[rest] = np.fromiter(map(group_of, other), np.int32, len(other)) + (self.size - GROUPS)
        return ids, index, other


@dataclass
class Model:
    start: np.ndarray   # S
    entry: np.ndarray   # S: state shares where a piece begins inside a text
    move: np.ndarray    # S x S
    emit: np.ndarray    # classes x S


def count_words(docs: DataFrame, text: str, limit: int = 200_000) -> DataFrame:
    """(word, n) of all tokens."""

    def run(batches):
        found: Counter = Counter()
        for batch in batches:
            for raw in as_bytes(batch.column(0)):
                found.update(tokens(raw))
                if len(found) > limit:
                    yield rows(found)
                    found.clear()
        yield rows(found)

    def rows(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "n"])

    return batchwise(docs.select(F.col(text).alias("text")), run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_vocabulary(counts: DataFrame, own_classes: int, head_words: int) -> Vocabulary:
    """Cut the head by a count level, found on a histogram of a few hundred rows."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    group = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(GROUPS)).cast("int")
    bars = counts.groupBy(level.alias("level")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect()
    bars = sorted(((r["level"], r["v"], r["n"]) for r in bars), reverse=True)

    def cut(most: int) -> int:
        found, at = 0, 1 << 30
        for one, v, _ in bars:
            found += v
            if found > most:
                break
            at = one
        return at

    own, head_at = cut(own_classes), cut(head_words)
    common = counts.where((level >= head_at) | (F.length("word") == 0)).withColumn("own", level >= own).collect()
    alone = {bytes(r["word"]) for r in common if r["own"]} | {END}
    common = sorted(((bytes(r["word"]), r["n"]) for r in common), key=lambda r: (-r[1], r[0]))
    rare = counts.where((level < own) & (F.length("word") > 0))
    sums = {r["g"]: (r["n"], r["v"]) for r in rare.groupBy(group.alias("g")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    group_n = np.array([sums.get(g, (0, 0))[0] for g in range(GROUPS)], float)
    group_log = np.log10(group_n + [sums.get(g, (0, 0))[1] for g in range(GROUPS)] + 1)
    listed = common if any(w == END for w, _ in common) else [*common, (END, 0)]
    singles = [(w, n) for w, n in listed if w in alone]
    single = {w: i for i, (w, _) in enumerate(singles)}
    classes = np.array([single[w] if w in single else len(single) + group_of(w) for w, _ in listed], np.int32)
    log_count = np.log10(np.array([n for _, n in listed], float) + 1)
    in_group = classes >= len(single)
    log_share = np.where(in_group, log_count - group_log[np.where(in_group, classes - len(single), 0)], 0.0)
    return Vocabulary(
        sum(n for _, _, n in bars), sum(v for _, v, _ in bars), Head((w, i) for i, (w, _) in enumerate(listed)), classes, log_count, log_share,
        group_log, np.concatenate([[n for _, n in singles], group_n]).astype(float))


def first_model(vocabulary: Vocabulary, states: int, seed: int = 5) -> Model:
    """Sticky states whose emissions are seeded noise around the class shares."""
    random = np.random.Generator(np.random.PCG64(seed))
    shares = _prior(vocabulary)
    emit = shares[:, None] * random.gamma(2.0, 1.0, (vocabulary.size, states))
    move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    flat = np.full(states, 1 / states)
    return Model(flat, flat, move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _prior(vocabulary: Vocabulary) -> np.ndarray:
    counts = vocabulary.class_counts + 1
    return counts / counts.sum()


Piece = tuple[np.ndarray, int, int]


def _cut(texts: list[np.ndarray]) -> list[Piece]:
    """Pieces of the texts with text number and number in the text, longest first."""
    cut = [(t[at:at + PIECE], d, at // PIECE) for d, t in enumerate(texts) for at in range(0, len(t), PIECE)]
    cut.sort(key=lambda x: -len(x[0]))
    return cut


def _table(cut: list[Piece]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Padded ids, lengths, text numbers, numbers in the text."""
    lengths = np.array([len(x[0]) for x in cut])
    ids = np.zeros((len(cut), lengths[0]), np.int32)
    ids[np.arange(lengths[0]) < lengths[:, None]] = np.concatenate([x[0] for x in cut])
    return ids, lengths, np.array([x[1] for x in cut]), np.array([x[2] for x in cut])


class Expected:
    """Expected counts of one partition."""

    def __init__(self, model: Model):
        s = len(model.start)
        self.model = model
        self.start, self.entry = np.zeros(s), np.zeros(s)
        self.move, self.emit = np.zeros((s, s)), np.zeros_like(model.emit)

    def add(self, texts: list[np.ndarray]) -> None:
        cut = _cut(texts)
        for at in range(0, len(cut), BLOCK // PIECE):
            self._add(cut[at:at + BLOCK // PIECE])

    def _add(self, cut: list[Piece]) -> None:
        m = self.model
        ids, lengths, _, number = _table(cut)
        steps, s = ids.shape[1], len(m.start)
        active = [int(np.searchsorted(-lengths, -t, "left")) for t in range(steps + 1)]  # pieces longer than t
        emit = m.emit[ids.T]  # steps x pieces x states
        alpha, scale = np.empty((steps, len(ids), s)), np.empty((steps, len(ids)))
        now = np.where((number == 0)[:, None], m.start, m.entry)
        for t in range(steps):
            n = active[t]
            now = (now if t == 0 else now[:n] @ m.move) * emit[t, :n]
            scale[t, :n] = now.sum(1)
            now = now / scale[t, :n, None]
            alpha[t, :n] = now
        beta = np.ones((len(ids), s))
        for t in range(steps - 1, -1, -1):
            n, after = active[t], active[t + 1]
            if after:
                ahead = emit[t + 1, :after] * beta[:after] / scale[t + 1, :after, None]
                self.move += (alpha[t, :after].T @ ahead) * m.move
                beta[:after] = ahead @ m.move.T
            alpha[t, :n] *= beta[:n]
        first = alpha[0]
        self.start += first[number == 0].sum(0)
        self.entry += first[number != 0].sum(0)
        here = np.arange(steps)[:, None] < lengths
        flat = ids.T[here]
        for k in range(s):
            self.emit[:, k] += np.bincount(flat, alpha[:, :, k][here], len(self.emit))

    def rows(self) -> pa.RecordBatch:
        table = np.vstack([self.start, self.entry, self.move, self.emit])
        at = np.flatnonzero(table.any(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *[pa.array(table[at, k].copy()) for k in range(table.shape[1])]],
                                          ["row", *[f"s{k}" for k in range(table.shape[1])]])


def _blocks(batches, column: int, vocabulary: Vocabulary):
    """Encoded texts in blocks of about ``BLOCK`` tokens."""
    texts, size = [], 0
    for batch in batches:
        for raw in as_bytes(batch.column(column)):
            texts.append(vocabulary.encode(tokens(raw))[0])
            size += len(texts[-1])
            if size >= BLOCK:
                yield texts
                texts, size = [], 0
    if texts:
        yield texts


def baum_welch(docs: DataFrame, text: str, vocabulary, model: Model, prior: np.ndarray) -> Model:
    """One round over all rows of ``docs``. ``vocabulary`` is a broadcast."""
    s, context = len(model.start), docs.sparkSession.sparkContext
    shared = context.broadcast(model)

    def run(batches):
        counts = Expected(shared.value)
        for texts in _blocks(batches, 0, vocabulary.value):
            counts.add(texts)
        yield counts.rows()

    names = [f"s{k}" for k in range(s)]
    schema = "row int, " + ", ".join(f"{n} double" for n in names)
    summed = batchwise(docs.select(F.col(text).alias("text")), run, schema).groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    table = np.zeros((2 + s + len(prior), s))
    for r in summed.collect():
        table[r["row"]] = r[1:]
    shared.destroy()
    start, entry, move, emit = table[0] + 1, table[1] + 1, table[2:2 + s] + 1, table[2 + s:] + PRIOR * prior[:, None]
    return Model(start / start.sum(), entry / entry.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def log_likelihoods(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 likelihood of each whole text (class ids), by the scaled forward recursion."""
    ids, lengths, text, number = _table(_cut(texts))
    s, out = len(model.start), np.zeros(len(texts))
    heads = np.flatnonzero(number == 0)
    state = np.zeros((len(texts), s))

    def forward(rows: np.ndarray, now: np.ndarray, first_moves: bool) -> np.ndarray:
        """Run pieces ``rows`` (longest first) on; ``now`` has k vectors per piece. Adds scales."""
        logs = np.zeros(len(rows))
        done = lengths[rows]
        for t in range(int(done[0]) if len(rows) else 0):
            n = int(np.searchsorted(-done, -t, "left"))
            part = now[:n]
            if t or first_moves:
                part = part @ model.move
            part = part * model.emit[ids[rows[:n], t]][:, None, :]
            now[:n] = part
            if t % SCALE_EVERY == SCALE_EVERY - 1:
                size = part.sum((1, 2))
                now[:n] /= size[:, None, None]
                logs[:n] += np.log10(size)
        size = now.sum((1, 2))
        now /= size[:, None, None]
        return logs + np.log10(size)

    begin = np.broadcast_to(model.start, (len(heads), 1, s)).copy()
    out[text[heads]] += forward(heads, begin, False)
    state[text[heads]] = begin[:, 0]
    later = np.flatnonzero(number != 0)
    if len(later):
        moved = np.broadcast_to(np.eye(s), (len(later), s, s)).copy()
        logs = forward(later, moved, True)
        for k in range(1, int(number[later].max()) + 1):
            at = np.flatnonzero(number[later] == k)
            docs_ = text[later[at]]
            now = np.einsum("ds,dsr->dr", state[docs_], moved[at])
            size = now.sum(1)
            state[docs_] = now / size[:, None]
            out[docs_] += logs[at] + np.log10(size)
    return out


def _score(docs: DataFrame, key: str, text: str, vocabulary, model) -> DataFrame:
    """Per row what its frequent words give, and its other words with their number."""
    picked = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = (f"row bigint, doc_id {picked.dtypes[1][1]}, n_tokens bigint, head_known bigint, head_base double, chain double, "
              "shares double, rest array<struct<word:binary,n:int>>")
    rest_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))

    def run(batches):
        words, shared = vocabulary.value, model.value
        known = np.append(words.log_count > 0, False)
        log_count, log_share = np.append(words.log_count, 0.0), np.append(words.log_share, 0.0)
        for batch in batches:
            for part, texts, numbers, rests in blocks(batch, words, known, log_count, log_share):
                n = np.array(numbers, float).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(n[:, 0].astype(np.int64)), pa.array(n[:, 1].astype(np.int64)), pa.array(n[:, 2].copy()),
                    pa.array(log_likelihoods(texts, shared)), pa.array(n[:, 3].copy()), pa.array(rests, rest_type)], schema_names)

    def blocks(batch, words, known, log_count, log_share):
        at, texts, numbers, rests, size = 0, [], [], [], 0
        for i, raw in enumerate(as_bytes(batch.column(2))):
            ids, index, other = words.encode(tokens(raw))
            shares = log_share[index].sum() - words.group_log[ids[index < 0] - (words.size - GROUPS)].sum()
            texts.append(ids)
            numbers.append((len(ids), known[index].sum(), log_count[index].sum(), shares))
            rests.append([{"word": w, "n": c} for w, c in Counter(other).items()])
            size += len(ids)
            if size >= BLOCK:
                yield batch.slice(at, i + 1 - at), texts, numbers, rests
                at, texts, numbers, rests, size = i + 1, [], [], [], 0
        if texts:
            yield batch.slice(at), texts, numbers, rests

    schema_names = ["row", "doc_id", "n_tokens", "head_known", "head_base", "chain", "shares", "rest"]
    return batchwise(picked, run, schema)


def train(docs: DataFrame, key: str, text: str, states: int = STATES, own_classes: int = 4096, head_words: int = 131_072,
          warm_docs: int = 2000, warm_rounds: int = 8, rounds: int = 2):
    """Counts (a stored table), the vocabulary and the model of training documents."""
    context = docs.sparkSession.sparkContext
    counts = materialize(count_words(docs, text), "words")
    vocabulary = build_vocabulary(counts, own_classes, head_words)
    shared, prior = context.broadcast(vocabulary), _prior(vocabulary)
    model = first_model(vocabulary, states)
    total = int(vocabulary.class_counts[vocabulary.classes[vocabulary.head[END]]])
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(9), F.col(key), F.col(text)), 11).cast("double") * 2.0**-53
    sample = materialize(docs.select(F.col(text).alias("text")).where(draw * max(total, 1) < warm_docs).repartition(4, "text"), "warm")
    for _ in range(warm_rounds):
        model = baum_welch(sample, "text", shared, model, prior)
    for _ in range(rounds):
        model = baum_welch(docs, text, shared, model, prior)
    return counts, shared, vocabulary, model


def score(docs: DataFrame, counts: DataFrame, shared, vocabulary: Vocabulary, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    held = materialize(_score(docs, key, text, shared, given), "scored")
    rest = held.select("row", F.explode("rest").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.n").alias("k"))
    joined = rest.join(counts, "word", "left")
    sums = joined.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("known"),
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(1.0))).alias("logs"))
    per_token = float(np.log10(vocabulary.total + vocabulary.distinct + 1))
    logs = F.coalesce("logs", F.lit(0.0))
    return held.drop("rest").join(sums, "row", "left").select(
        "doc_id", "n_tokens", (F.col("head_known") + F.coalesce("known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(vocabulary.total).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + logs - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("chain") + F.col("shares") + logs).alias("score"))


def held_out_report(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int = 7, held: int = 2, **options) -> DataFrame:
    """Learn from the folds that are not held out and score every document."""
    fold = split_of(F.col(key), parts)
    counts, shared, vocabulary, model = train(docs.where(fold != held), key, text, **options)
    scored = score(docs, counts, shared, vocabulary, model, key, text)
    return scored.select("doc_id", (split_of(F.col("doc_id"), parts) == held).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
