"""Personal data by candidate gradient boosting.

Exact rules find the base spans of four kinds. Besides, loose generators propose overlapping
candidate spans of each kind (other separators, missing prefixes, written-out signs, failed checks).
Boosted trees score a candidate by its format, its checks and its context. They are trained on all documents: the
labelled candidates are written to the shared folder and their gradients added up by Spark. Positive are personal
data that the exact rules miss: all base spans, written in other ways (``rewritten``) and set in their places. Negative are numbers and signs made to look like them
(``decoys``), wrong parts of the rewritten ones, and the candidates of the texts themselves that overlap no base
span; of these, the ones that pass a kind's checks may be personal data and are left out. Half of the documents train;
on the other half each kind gets the lowest threshold from 0.5 up that keeps ``precision``; above it a candidate that overlaps no base
span is personal data too, the best first. A kind that never reaches the precision adds nothing,
and trees are not trusted outside of what they have seen: the number of digits, letters and digit
groups of a candidate must lie in the range of the positive ones of its kind.

Edge cases: null is the empty text and has no spans; texts are scanned whole and in linear time;
repeated rows get equal rows; a table without base spans adds nothing to the base spans; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.boosting import Boosted, fit_rows, thresholds
from pressloom.llm.common import batchwise, merge_spans
from pressloom.session import materialize

# Kinds in their order, and the base patterns. A digit run fails as a whole, so the
# look-behind of the address pattern changes no match.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT = re.compile(r"[0-9]")
LOOSE = {
    "email": re.compile(r"(?<![^\s@,;<>()\[\]])[^\s@,;<>()\[\]]{1,64}(?:@|\s?(?:\(at\)|\[at\])\s?)[^\s@,;<>()\[\]]{1,64}(?:\s?(?:\(dot\)|\[dot\])\s?[A-Za-z]{2,24})*"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,5}(?:(?:[.:,]|\s?\[\.\]\s?|\s?\(\.\)\s?|\s\.\s|\sdot\s)[0-9]{1,5}){2,7}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,21}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,15}(?![0-9])"),
}
CUES = {
    "email": re.compile(r"mail|contact|write", re.I),
    "ip": re.compile(r"\bip\b|host|server|address", re.I),
    "card": re.compile(r"card|visa|credit|payment", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobile|cell", re.I),
}

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each at sign: as far left as the local part goes, then the domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans the exact rules find, by kind and start."""
    out = [(0, s, e) for s, e in _emails(text)]
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in m[0].split("."))):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


def candidates(text: str) -> list[Span]:
    """Overlapping spans of all generators, by kind, start and end."""
    digits = bool(DIGIT.search(text))
    found = set()
    low = "@" in text or "(at)" in text or "[at]" in text
    for k, kind in enumerate(KINDS):
        if low if kind == "email" else digits:
            found.update((k, *m.span()) for m in LOOSE[kind].finditer(text))
    if digits:
        found.update((1, *m.span()) for m in IP.finditer(text))
        found.update((2, *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 12)
        found.update((3, *m.span()) for m in PHONE.finditer(text))
    found.update((0, s, e) for s, e in _emails(text))
    return sorted(found)


def name(rng: random.Random) -> str:
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 11)))


def rewritten(kind: int, value: str, rng: random.Random) -> tuple[str, list[str]]:
    """A base span as people write it to be read by people, and the parts of it that are personal data. Every other
    one gets names or numbers of its own, since the addresses of one corpus may all be made alike."""
    numbers, own = re.findall(r"[0-9]+", value), rng.random() < 0.5
    if own and kind == 1:
        numbers = [str(rng.randrange(256)) for _ in range(4)]
    elif own and kind == 2:
        numbers = [with_check(str(rng.randrange(10**14, 10**15)))]
    elif own and kind == 3:
        numbers = [str(rng.randrange(2 * 10**9, 10**10))]
    if kind == 0:
        local, _, domain = value.rpartition("@")
        host, _, top = domain.rpartition(".")
        if own:
            local = name(rng) + rng.choice(["", "." + name(rng), "_" + name(rng), "-" + name(rng), str(rng.randrange(1000))])
            host, top = rng.choice(["", name(rng) + "."]) + name(rng), rng.choice(["com", "org", "net", "info", "de", "fr", "io"])
            domain = f"{host}.{top}"
        out = rng.choice([f"{local} (at) {domain}", f"{local}[at]{domain}", f"{local} (at) {host} (dot) {top}", f"{local}@{host} [dot] {top}"])
    elif kind == 1:
        out = rng.choice(["[.]", " . ", " dot ", "(.)"]).join(numbers)
    elif kind == 2:
        digits = "".join(numbers)
        if rng.random() < 0.4:  # next to another one, where the base pattern takes both for one number
            other = with_check(str(rng.randrange(10**14, 10**15)))
            return f"{digits} {other}", [digits, other]
        out = rng.choice("./").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    else:
        tail = "".join(numbers)[-10:]
        area, middle, last = tail[:-7], tail[-7:-4], tail[-4:]
        out = rng.choice([f"({area}) {middle}-{last}", f"{area}.{middle}.{last}", f"{area}-{middle}-{last}", f"1-{area}-{middle}-{last}", f"{area}/{middle}-{last}", f"1 ({area}) {middle}-{last}"])
    return out, [out]


def decoys(kind: int, rng: random.Random) -> str:
    """What looks like a kind and is none."""
    n = rng.randrange
    if kind == 0:
        return rng.choice([f"{n(100)}@{n(1000)}", f"room (at) {n(100)}", f"we met (at) noon{n(10)}", f"{n(10)} items [at] {n(100)}"])
    if kind == 1:
        return rng.choice([f"{n(1, 30)}.{n(1, 13)}.{n(1950, 2050)}", f"{n(24)}:{n(10, 60)}:{n(10, 60)}", f"{n(300)}[.]{n(256, 1000)}[.]{n(256)}[.]{n(256)}", f"{n(20)}.{n(20)}.{n(20)}",
                           f"{n(1, 1000)},{n(100, 1000)},{n(100, 1000)},{n(100, 1000)}", f"{n(9)} . {n(9)} . {n(9)}", f"{n(99)} dot {n(300, 9999)} dot {n(99)} dot {n(99)}"])
    if kind == 2:
        right = with_check(str(n(10**14, 10**15)))
        wrong = right[:-1] + str((int(right[-1]) + n(1, 10)) % 10)
        return rng.choice([wrong, rng.choice("./- ").join(wrong[i:i + 4] for i in range(0, 16, 4)), str(n(10**12, 10**14)), f"{wrong} {wrong[::-1]}"])
    year, month, day = n(1950, 2050), f"{n(1, 13):02d}", f"{n(1, 29):02d}"
    return rng.choice([str(n(10**6, 10**15)), f"{year}-{month}-{day} {n(10, 24)}", f"{day}.{month}.{year}", f"{year}{month}{day}", f"{year}-{n(1950, 2050)}", f"{n(10)}.{n(10**6, 10**9)}",
                       f"{n(10, 99)}/{n(10, 99)}/{year}", f"{n(1000, 10000)}-{n(1000, 10000)}", f"{n(10)}-{n(10**4, 10**5)}-{n(10**3, 10**4)}-{n(10)}", f"{n(10, 100)} {n(10, 100)} {n(10, 100)} {n(10, 100)}"])


def with_check(digits: str) -> str:
    """The digits and the one that makes their check sum right."""
    return next(digits + str(d) for d in range(10) if luhn(digits + str(d)))


def passes(text: str, span: Span) -> bool:
    """Whether a candidate passes the checks of its kind, however it is written."""
    kind, start, end = span
    numbers = re.findall(r"[0-9]+", text[start:end])
    digits = "".join(numbers)
    if kind == 1:
        return len(numbers) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in numbers)
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 8 <= len(digits) <= 15


def examples(text: str, rng: random.Random, copies: int = 8) -> Iterator[tuple[Span, bool, list[float]]]:
    """Labelled candidates of one text: its own, and those of what is set in the places of its base spans."""
    base = base_spans(text)
    covered = merge_spans([(s, e) for _, s, e in base])
    for c in candidates(text):
        at = bisect.bisect_left(covered, (c[1], c[2]))
        apart = (at == 0 or covered[at - 1][1] <= c[1]) and (at == len(covered) or covered[at][0] >= c[2])
        if apart and not passes(text, c):
            yield c, False, features(text, c)
    for kind, start, end in base:
        before, after = text[max(0, start - 40):start], text[end:end + 40]
        for i in range(2 * copies):
            new, parts = (decoys(kind, rng), []) if i % 2 else rewritten(kind, text[start:end], rng)
            whole, lo, hi = before + new + after, len(before), len(before) + len(new)
            right, known, found = set(), merge_spans([(s, e) for _, s, e in base_spans(whole)]), lo
            for part in parts:
                found = whole.index(part, found)
                right.add((kind, found, found + len(part)))
                found += len(part)
            for c in candidates(whole):
                # A number of the right length and check sum cannot be told from a card by anybody.
                chance = kind == 2 == c[0] and c not in right and passes(whole, c)
                if c[1] < hi and lo < c[2] and not chance and not any(s < c[2] and c[1] < e for s, e in known):
                    yield c, c in right, features(whole, c)


def _char_class(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def features(text: str, span: Span) -> list[float]:
    """Format, checks and context."""
    kind, start, end = span
    s, before = text[start:end], text[max(0, start - 24):start]
    groups = re.findall(r"[0-9]+", s)
    sizes = [len(g) for g in groups] or [0]
    counts = [s.count(c) for c in " -.()@:+"]
    letters = sum(c.isalpha() for c in s)
    domain, digits = s.rpartition("@")[2], "".join(groups)
    signs = re.sub(r"[0-9]+", "", s)
    return [
        *(float(kind == k) for k in range(len(KINDS))), len(s), sum(sizes), letters, len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        *counts, domain.count("."), len(domain.rpartition(".")[2]), float(s[0] == "+"), float(s[-1].isalnum()), float(s[0].isalnum()),
        len(set(s)), _char_class(text[start - 1:start]), _char_class(text[end:end + 1]), float(before.rstrip().endswith((":", "="))),
        *(float(bool(CUES[k].search(before))) for k in KINDS),
        float(12 <= len(digits) <= 19 and luhn(digits)), sum(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or "0") <= 255 for g in groups), sum(n == 4 for n in sizes),
        float(sizes[0] == 4 and groups[0][:2] in ("19", "20")) if groups else 0.0, float(sizes[-1] == 4 and groups[-1][:2] in ("19", "20")) if groups else 0.0,
        len(set(signs)), signs.count("["), signs.count("/"), signs.count(","), float("at" in signs), float("dot" in signs), sizes[-2] if len(sizes) > 1 else 0,
    ]


#: Features are whole numbers; larger ones count as this.
LARGEST = 2**31 - 1
#: Places of digits, letters, digit groups and the longest group among the features.
SHAPE = [len(KINDS) + i for i in (1, 2, 3, 4)]


@dataclass
class Finder:
    """Trees with a threshold and the seen shapes (lowest, highest) per kind."""

    trees: Boosted | None
    thresholds: tuple[float, ...]
    shapes: np.ndarray | None = None  # kinds x 2 x shape features

    def seen(self, kinds: np.ndarray, x: np.ndarray) -> np.ndarray:
        shape, low, high = x[:, SHAPE], self.shapes[kinds, 0], self.shapes[kinds, 1]
        # Mail addresses need no digits.
        return ((shape <= high) & ((shape >= low) | (kinds == 0)[:, None])).all(axis=1)

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans, each by kind and start."""
        base = base_spans(text)
        if self.trees is None or min(self.thresholds) == float("inf"):
            return base, base
        known = set(base)
        near = [c for c in candidates(text) if c not in known]
        if not near:
            return base, base
        x, kinds = np.array([features(text, c) for c in near]), np.array([c[0] for c in near])
        scores = np.where(self.seen(kinds, x), self.trees.score(x), -1.0)
        taken = merge_spans([(s, e) for _, s, e in base])
        more = []
        for i in np.argsort(-scores, kind="stable"):
            kind, start, end = near[i]
            if scores[i] < self.thresholds[kind]:
                continue
            at = bisect.bisect_left(taken, (start, end))
            if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
                taken.insert(at, (start, end))
                more.append(near[i])
        return base, sorted(base + more)


#: Examples that a task holds before it hands them on.
ROWS_AT_ONCE = 2000


def _labelled(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(half, kind, label, x) of the examples of all documents."""
    drawn = docs.where(F.length(text) > 0).select(F.xxhash64(F.lit(23), F.col(key), F.col(text)).alias("draw"), F.col(text).alias("text"))

    def packed(rows):
        half, kind, label, x = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(half, pa.int32()), pa.array(kind, pa.int32()), pa.array(label, pa.float64()), pa.array(x, pa.list_(pa.int32()))],
                                          ["half", "kind", "label", "x"])

    def run(batches):
        out = []
        for batch in batches:
            for draw, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                for c, right, x in examples(value.as_py(), random.Random(draw)):
                    out.append((draw & 1, c[0], float(right), [min(int(v), LARGEST) for v in x]))
                    if len(out) == ROWS_AT_ONCE:
                        yield packed(out)
                        out = []
        if out:
            yield packed(out)

    return batchwise(drawn, run, "half int, kind int, label double, x array<int>")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", precision: float = 0.98) -> Finder:
    """Trees from all documents: half of them train, half set the thresholds."""
    none = Finder(None, (float("inf"),) * len(KINDS))
    rows = materialize(_labelled(docs, key, text), "examples")
    trees = fit_rows(rows.where("half = 0"))
    if trees is None:
        return none
    limits = thresholds(rows.where("half = 1"), trees, precision)
    ends = [f(F.col("x")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in SHAPE]
    shapes = np.zeros((len(KINDS), 2, len(SHAPE)))
    for r in rows.where("label = 1").groupBy("kind").agg(*ends).collect():  # one row a kind
        shapes[r["kind"]] = [[r[f"{name}{i}"] for i in SHAPE] for name in ("low", "high")]
    return Finder(trees, tuple(max(limits.get(k, float("inf")), 0.5) for k in range(len(KINDS))), shapes)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, finder: Finder, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, the number of base spans per kind, their list and the list of all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(finder)
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    names = [f"n_{k}" for k in KINDS]

    def run(batches):
        model = shared.value
        for batch in batches:
            counts, base, spans = [], [], []
            for value in batch.column(1):
                found, whole = model.spans(value.as_py() or "")
                counts.append([sum(s[0] == k for s in found) for k in range(len(KINDS))])
                base.append(listed(found))
                spans.append(listed(whole))
            table = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(table[:, k].copy()) for k in range(len(KINDS))], pa.array(base, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *names, "base", "spans"])

    return batchwise(picked, run, f"doc_id {picked.dtypes[0][1]}, " + ", ".join(f"{n} bigint" for n in names) + ", base string, spans string")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The scan with a digest of the base spans."""
    found = scan(docs, train(docs, key, text, **options), key, text)
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
