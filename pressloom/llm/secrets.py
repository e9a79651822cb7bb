"""Secret scan with character Markov models, in column expressions only.

Three fixed patterns find assignments, access keys and hex runs. Beyond them, every run of
``MIN_RUN`` or more key characters that holds a letter and a digit is a candidate; two character
bigram models, one of random strings and one of ordinary identifiers, are compared by their
log-likelihood ratio per character, and a candidate above the threshold is a secret too.

The models are trained on a labelled sample of about ``sample_docs`` documents: the values that the
fixed patterns find are random strings, the words of texts without any are ordinary, alone and set
together to identifiers; candidates are neither. A token all in capitals is read in lower case. The
ordinary model falls back on how often a character occurs and then on equal odds, so that ratios stay on
one scale however many words were counted. The threshold lies half way between the ratios of
identifiers out of held-out words (their ``quantile``) and those of random strings of the usual
alphabets (the lowest 1 - ``quantile`` of the alphabet that is nearest), and not below ``least`` if that
is given. A model is one number per pair of the alphabet, so its size is fixed.

Positions are code points, ends exclusive: a match starts where the text pieces before it and the
matches before it end, which running sums over both give. Overlaps come from one sort of all positions and
replaced texts out of blocks of ``BLOCK`` code points, so the time for a text grows with its length and spans.

Edge cases: null text is the empty text and has no spans; very long texts are scanned whole;
repeated rows get equal rows; without labelled values the random model is uniform; an empty table
gives an empty result; extra columns are ignored, or kept by ``redact``.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import fresh, let

# The patterns of the base spans. The runs of the last two are as long as possible
# wherever they begin, so asking for the least length is the same as dropping shorter runs.
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
MIN_RUN = 16
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % MIN_RUN
#: Alphabets that random strings are drawn from.
RANDOM = {"base62": ALPHABET[:62], "base64": ALPHABET[:64], "url64": ALPHABET[:62] + "_-", "lower36": ALPHABET[:26] + ALPHABET[52:62], "upper36": ALPHABET[26:62],
          "base32": ALPHABET[26:52] + "234567", "hex": "0123456789abcdef", "upper_hex": "0123456789ABCDEF"}
#: Share of equal odds in the ordinary model.
EQUAL = 0.05
WORD_LIKE = r"(?<![A-Za-z0-9+/_-])[A-Za-z][A-Za-z0-9+/_-]{5,}"


def running(values: Column, join: Callable[[Column, Column], Column], block: int = 256) -> Column:
    """Inclusive running values of an array of numbers from 0 up, such as sums or maxima, block by block: appending
    is only quadratic in a block."""
    none, zero = F.array().cast("array<bigint>"), F.lit(0).cast("bigint")

    def last(a: Column) -> Column:
        return F.coalesce(F.try_element_at(a, F.lit(-1)), zero)

    def one_block(a: Column) -> Column:
        return F.aggregate(a, none, lambda done, x: F.concat(done, F.array(join(last(done), x))))

    def whole(a: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor(F.size(a) / block).cast("int"))
        inner = F.transform(starts, lambda b: one_block(F.slice(a, b * block + 1, block)))
        return let(inner, lambda parts: let(one_block(F.transform(parts, last)), lambda ends: F.flatten(
            F.transform(parts, lambda p, i: F.transform(p, lambda x: join(F.coalesce(F.get(ends, i - 1), zero), x))))))

    return let(values, whole)


def running_totals(values: Column) -> Column:
    return running(values, lambda total, x: total + x)


def matches(text: Column, pattern: str, order: int, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, kind order, value)."""
    kind = "array<struct<start:bigint,end:bigint,kind:int,value:string>>"

    def found(hits: Column) -> Column:
        def place(steps: Column, values: Column) -> Column:
            # steps: lengths of piece, match, piece, match ...
            return let(running_totals(steps), lambda ends: F.transform(hits, lambda h, i: F.struct(
                F.get(ends, 2 * i).alias("start"), F.get(ends, 2 * i + 1).alias("end"), F.lit(order).alias("kind"), F.get(values, i).alias("value"))))

        pieces = F.split(text, pattern, -1)
        steps = F.flatten(F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda p, h: F.array(
            F.length(p).cast("bigint"), F.length(h).cast("bigint"))))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
        return let(values, lambda v: place(steps, v))

    all_hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), let(all_hits, found).cast(kind)).otherwise(F.array().cast(kind))


def base_spans(text: Column) -> Column:
    """The spans of the three fixed patterns."""
    assign = F.filter(matches(text, ASSIGN, 0, 1), lambda s: F.length(s["value"]) >= 6)
    return F.concat(assign, matches(text, ACCESS, 1), matches(text, HEX, 2))


def _pairs(token: Column) -> Column:
    """Index of each pair of neighbouring characters in the model's table."""
    def index(chars: Column) -> Column:
        place = F.transform(chars, lambda c: F.instr(F.lit(ALPHABET), c) - 1)
        known = let(place, lambda p: F.zip_with(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 2, F.size(p)), lambda a, b: F.when(
            (a >= 0) & (b >= 0), a * len(ALPHABET) + b)))
        return F.filter(known, lambda x: x.isNotNull())

    folded = let(token, lambda t: F.when(t == F.upper(t), F.lower(t)).otherwise(t))
    return let(F.filter(F.split(folded, ""), lambda c: c != ""), index)


@dataclass(frozen=True)
class Markov:
    """Log ratio, random over ordinary, of every pair of characters, and the threshold."""

    ratios: tuple[float, ...]
    threshold: float

    def ratio(self, token: Column) -> Column:
        """Mean log-likelihood ratio per pair; null for tokens without a pair."""
        table = F.from_json(F.lit(json.dumps(self.ratios)), "array<double>")
        return let(_pairs(token), lambda p: F.when(F.size(p) > 0, F.aggregate(
            p, F.lit(0.0), lambda total, i: total + F.get(table, i)) / F.size(p)))

    def score(self, token: str) -> float:
        """``ratio`` of one token of the alphabet, on the driver."""
        at = [ALPHABET.index(c) for c in (token.lower() if token == token.upper() else token)]
        return sum(self.ratios[a * len(ALPHABET) + b] for a, b in zip(at, at[1:])) / (len(at) - 1)


def identifiers(words: list[str], rng: random.Random) -> list[str]:
    """Candidates as people name things: words and a number, set together in one of the usual ways."""
    out = []
    for word in words:
        parts = [word]
        while sum(map(len, parts)) < MIN_RUN - 4 or len(parts) < 2:
            parts.append(rng.choice(words))
        number = "".join(rng.choices("0123456789", k=rng.randint(1, 8)))
        style = rng.randrange(5)
        if style == 4:
            one = "".join(p[:1].upper() + p[1:].lower() for p in parts) + number
        else:
            parts.insert(rng.randrange(1, len(parts) + 1), number)
            one = "-_/_"[style].join(parts)
            one = one.upper() if style == 3 else one.lower()
        out.append(one.ljust(MIN_RUN, "0"))
    return out


def random_strings(alphabet: str, n: int, rng: random.Random) -> list[str]:
    """Shortest candidates, drawn evenly from an alphabet."""
    out = []
    while len(out) < n:
        one = "".join(rng.choices(alphabet, k=MIN_RUN))
        if any(c.isdigit() for c in one) and any(c.isalpha() for c in one):
            out.append(one)
    return out


def at_share(values: list[float], share: float) -> float:
    return sorted(values)[min(int(share * len(values)), len(values) - 1)]


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_docs: int = 20_000, quantile: float = 0.999, least: float | None = None) -> Markov:
    """Both models from the labelled tokens of a bounded sample."""
    total = docs.count()
    share = F.shiftrightunsigned(F.xxhash64(F.lit(13), F.col(key), F.col(text)), 11).cast("double") * 2.0**-53
    texts = docs.where(share * total < sample_docs).select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    spans = texts.select("t", base_spans(F.col("t")).alias("spans"))
    secret = spans.select(F.lit(1).alias("label"), F.explode("spans.value").alias("token"))
    # Words of texts without a match: what stands in them is ordinary, but for candidates, which may be secrets.
    plain = spans.where(F.size("spans") == 0).select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all("t", F.lit(WORD_LIKE), F.lit(0))).alias("token"))
    plain = plain.where((F.length("token") < MIN_RUN) | ~F.col("token").rlike("[0-9]"))
    # A token counts once, however often it is copied. One word in ten is held out.
    tokens = secret.unionAll(plain).distinct().withColumn("draw", F.xxhash64(F.lit(17), "token"))
    held = (F.col("label") == 0) & (F.pmod("draw", F.lit(10)) == 0)
    # Every word is also set together with itself or a number, as in identifiers.
    token, number = F.col("token"), F.substring(F.abs(F.col("draw") % 10**8).cast("string"), -6, 6)
    title = F.concat(F.upper(F.substring(token, 1, 1)), F.lower(F.substring("token", 2, 10**6)))
    joined = F.array(F.concat_ws("-", F.lower(token), number, F.lower(token)), F.concat_ws("_", F.lower(token), F.lower(token), number),
                     F.concat_ws("/", F.lower(token), F.lower(token), number), F.concat(title, title, number))
    forms = F.when(F.col("label") == 0, F.array(token, F.get(joined, F.pmod(F.floor(F.col("draw") / 10), F.lit(4)).cast("int")))).otherwise(F.array(token))
    pairs = tokens.where(~held).select("label", F.explode(forms).alias("token")).select("label", F.explode(_pairs(F.col("token"))).alias("pair"))
    size = len(ALPHABET)
    counts = [[0.0] * size * size for _ in range(2)]
    for r in pairs.groupBy("label", "pair").agg(F.count("*").alias("n")).collect():
        counts[r["label"]][r["pair"]] += r["n"]
    ratios = []
    column = [sum(counts[0][b::size]) for b in range(size)]
    for a in range(size):
        plain_row, secret_row = (one[a * size:(a + 1) * size] for one in counts)
        seen = sum(n > 0 for n in plain_row) or 1  # Witten-Bell weight of the fallback
        for b in range(size):
            back = column[b] / sum(column) if any(column) else 1 / size
            ordinary = (1 - EQUAL) * (plain_row[b] + seen * back) / (sum(plain_row) + seen) + EQUAL / size
            # Half of a random string's odds are equal ones: samples hold few of the alphabets in use.
            ratios.append(round(math.log(((secret_row[b] + 1) / (sum(secret_row) + size) + 1 / size) / 2 / ordinary), 6))
    model, rng = Markov(tuple(ratios), 0.0), random.Random(19)
    words = [r["token"] for r in tokens.where(held).orderBy("draw", "token").limit(5000).select("token").collect()]
    high = min(at_share([model.score(t) for t in random_strings(a, 5000, rng)], 1 - quantile) for a in RANDOM.values())
    low = at_share([model.score(t) for t in identifiers(words, rng)], quantile) if words else high
    level = low + max(high - low, 0.0) / 2
    return Markov(model.ratios, level if least is None else max(least, level))


#: Starts and ends are counted in the lower and the upper half of one running total.
HALF = 1 << 32


def apart_from(base: Column, spans: Column) -> Column:
    """The spans that overlap none of ``base``; they are in order and do not overlap each other.

    A span overlaps as many base spans as start before its end and do not end up to its start. All positions are
    sorted once: at one place ends come first, then where a span begins, where one ends, and starts.
    """
    def at(position: Column, order: int) -> Column:
        return F.struct(position.alias("at"), F.lit(order).alias("order"))

    def places(all_spans_: Column, start: int, end: int) -> Column:
        return F.flatten(F.transform(all_spans_, lambda s: F.array(at(s["start"], start), at(s["end"], end))))

    def count(events: Column) -> Column:
        step = F.transform(events, lambda e: F.when(e["order"] == 3, 1).when(e["order"] == 0, HALF).otherwise(0).cast("bigint"))
        return let(running_totals(step), lambda totals: let(F.zip_with(events, totals, lambda e, n: F.struct(e["order"].alias("order"), n.alias("n"))), pick))

    def pick(counted: Column) -> Column:
        ended = F.filter(counted, lambda e: e["order"] == 1)
        started = F.filter(counted, lambda e: e["order"] == 2)
        hits = F.zip_with(started, ended, lambda a, b: a["n"] % HALF - F.shiftright(b["n"], 32))
        return let(hits, lambda n: F.filter(F.transform(spans, lambda s, i: F.struct(s.alias("span"), F.get(n, i).alias("n"))), lambda x: x["n"] == 0)["span"])

    swept = let(F.array_sort(F.concat(places(base, 3, 0), places(spans, 1, 2))), count)
    return F.when((F.size(base) == 0) | (F.size(spans) == 0), spans).otherwise(swept)


def all_spans(text: Column, model: Markov) -> Column:
    """Base spans and, where they overlap none of these, candidates that look random."""
    def more(base: Column) -> Column:
        mixed = F.filter(matches(text, RUN, 3), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
        free = let(mixed, lambda spans: apart_from(base, spans))
        return F.concat(base, F.filter(free, lambda s: F.coalesce(model.ratio(s["value"]) > model.threshold, F.lit(False))))

    return let(base_spans(text), lambda base: F.array_sort(F.transform(more(base), lambda s: F.struct(s["start"], s["kind"], s["end"]))))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, model: Markov, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id and its spans (start, kind, end), by start and kind."""
    filled = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), let(filled, lambda t: all_spans(t, model)).alias("found"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: doc_id, the number of base spans of each kind, the digest of them, and all spans."""
    found = scan(docs, train(docs, key, text, **options), key, text)

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    base = _listed(F.filter("found", lambda s: s["kind"] < 3))
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


#: Code points of a block of a text.
BLOCK = 1024


def piece(blocks: Column, start: Column, end: Column) -> Column:
    """Text from ``start`` to ``end``, out of its blocks: only those it stands in are looked at."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")

    def part(block: Column, i: Column) -> Column:
        skip = F.when(i == 0, start % BLOCK).otherwise(F.lit(0)).cast("int")
        stop = F.when(i == last - first, (end - 1) % BLOCK + 1).otherwise(F.lit(BLOCK)).cast("int")
        return F.substring(block, skip + 1, stop - skip)

    return F.when(end > start, F.array_join(F.transform(F.slice(blocks, first + 1, last - first + 1), part), "")).otherwise(F.lit(""))


def replace_spans(text: Column, spans: Column, mark: str) -> Column:
    """The text with each span replaced by the mark, overlapping ones together. Spans are in order and not empty."""
    zero = F.lit(0).cast("bigint")

    def joined(blocks: Column, ends: Column) -> Column:
        placed = F.transform(spans, lambda s, i: F.struct(F.coalesce(F.get(ends, i - 1), zero).alias("before"), s["start"].alias("start")))
        heads = F.filter(placed, lambda h: h["start"] >= h["before"])
        cut = F.transform(heads, lambda h: F.concat(piece(blocks, h["before"], h["start"]), F.lit(mark)))
        return F.concat(F.array_join(cut, ""), piece(blocks, F.coalesce(F.try_element_at(ends, F.lit(-1)), zero), F.length(text).cast("bigint")))

    blocks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))
    ends = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    return let(blocks, lambda b: let(ends, lambda e: joined(b, e)))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """All rows and columns, each span of the text (overlapping ones together) replaced by ``mark``."""
    model = train(docs, key, text, **options)
    name = fresh(docs, "found")
    found = docs.withColumn(name, let(F.coalesce(F.col(text), F.lit("")), lambda t: all_spans(t, model)))
    new = F.when(F.size(name) > 0, let(F.col(text), lambda t: replace_spans(t, F.col(name), mark))).otherwise(F.col(text))
    return found.withColumn(text, new).select(*docs.columns)
