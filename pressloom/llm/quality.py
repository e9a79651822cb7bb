"""Quality rules as a short-circuit cascade.

Each rule is a condition over metrics of the text. On a small sample, drawn by hash, the cascade measures what
every rule costs and how many documents it rejects, and then tries the rules in the order of
rejections per second: most documents leave at a cheap rule and never reach the dear ones. The
order changes the time only: a document is rejected when any rule holds.

Edge cases: a null or blank text has no words and fails ``few_words``; very long texts are read
whole; equal rows get equal verdicts; an empty table gives an empty result; columns of the input
keep their names, and an added column whose name is taken gets underscores.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import BLANKS, fresh, let, words

SYMBOLS = "#*$%&|<>"
SAMPLE, LONGEST = 400, 1 << 16

Get = Callable[[str], Column]


def _removed(text: Column, chars: str) -> Column:
    """Characters of the text that are in ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("bigint")


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)


def _window_hashes(w: Column) -> Column:
    """One hash per three-word window."""
    n = F.greatest(F.size(w) - 2, F.lit(0))
    pairs = F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.zip_with(pairs, F.slice(w, 3, n), lambda p, c: F.xxhash64(p["a"], p["b"], c))


def _repeated_at(w: Column, hashes: Column) -> Column:
    """Ascending positions of the windows that occur twice or more.

    Hashes are packed with their position into one long, as many low bits as the positions
    need, and sorted as plain longs. Neighbours with equal high bits are candidates; their
    words are compared, so a collision of hashes counts nothing.
    """
    def shift(name: str, x: Column, k: Column) -> Column:
        return F.call_function(name, x, k)

    def repeats(s: Column, k: Column) -> Column:
        def place(x: Column) -> Column:
            return x.bitwiseAND(shift("shiftleft", F.lit(1).cast("bigint"), k) - 1).cast("int")

        def equal(x: Column, y: Column) -> Column:
            def word(z: Column, more: int) -> Column:
                return F.get(w, place(z) + more)
            same = [word(x, i) == word(y, i) for i in range(3)]
            return F.coalesce((shift("shiftright", x, k) == shift("shiftright", y, k)) & same[0] & same[1] & same[2], F.lit(False))

        found = F.filter(s, lambda x, j: equal(x, F.get(s, j - 1)) | equal(x, F.get(s, j + 1)))
        return F.sort_array(F.transform(found, place))

    bits = F.ceil(F.log2(F.size(hashes) + F.lit(1.0))).cast("int")
    return let(bits, lambda k: let(
        F.sort_array(F.transform(hashes, lambda h, i: shift("shiftleft", h, k).bitwiseOR(i.cast("bigint")))),
        lambda s: repeats(s, k)))


def _covered(at: Column) -> Column:
    """Words under the three-word windows that start at the ascending positions ``at``."""
    steps = F.zip_with(F.slice(at, 2, F.size(at)), at, lambda nxt, cur: F.coalesce(F.least(nxt - cur, F.lit(3)), F.lit(3)))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)


def _repeat_words(w: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more."""
    return let(_window_hashes(w), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint"),
    ).otherwise(let(_repeated_at(w, h), _covered)))


# Metrics: a function of the text and its words.
METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda t, w: F.size(w).cast("bigint"),
    "word_chars": lambda t, w: F.length(F.translate(t, BLANKS, "")).cast("bigint"),
    "n_symbols": lambda t, w: _removed(t, SYMBOLS),
    "n_lines": lambda t, w: F.size(_lines(t)).cast("bigint"),
    "n_dup_lines": lambda t, w: let(_lines(t), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")),
    "n_repeat_words": lambda t, w: _repeat_words(w),
    "n_marks": lambda t, w: _removed(t, "!"),
    "n_changed_case": lambda t, w: F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("bigint"),
}


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Get], Column]


#: The first two are the base rules. The limits of the others lie well outside of prose: a mean
#: word of 2 to 12 characters, one symbol in ten words, half of the lines repeated, one
#: exclamation mark in five words, three capitals in ten word characters.
BASE_RULES = [
    Rule("few_words", lambda m: m("n_words") < 50),
    Rule("repeated_words", lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
]
MORE_RULES = [
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 12 * m("n_words"))),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("repeated_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    Rule("exclamation", lambda m: 5 * m("n_marks") > m("n_words")),
    Rule("capitals", lambda m: 10 * m("n_changed_case") > 3 * m("word_chars")),
]


def metrics(text: Column, names: list[str]) -> Column:
    """Struct of the named metrics; the text is split once."""
    filled = F.coalesce(text, F.lit(""))
    return let(filled, lambda t: let(words(t), lambda w: F.struct(*[METRICS[n](t, w).alias(n) for n in names])))


def verdict(text: Column, rules: list[Rule]) -> Column:
    """Name of the first rule that holds, null if none. Later rules are not computed then."""

    def cascade(t: Column, w: Column) -> Column:
        out = F.lit(None).cast("string")
        for rule in reversed(rules):
            out = F.when(rule.fails(lambda name: METRICS[name](t, w)), F.lit(rule.name)).otherwise(out)
        return out

    return let(F.coalesce(text, F.lit("")), lambda t: let(words(t), lambda w: cascade(t, w)))


def draw_sample(docs: DataFrame, text: str = "text", sample: int = SAMPLE, longest: int = LONGEST) -> list[str | None]:
    """Up to ``sample`` texts of at most ``longest`` bytes: of all rows those with the smallest hashes.

    Equal texts in one row each hash alike, so a text that many rows hold counts once.
    """
    fits = docs.select(F.col(text).alias("text")).where(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
    hashed = fits.select(F.xxhash64(F.lit(23), "text").alias("h"), "text")
    few = hashed.groupBy("h").agg(F.lit(1).alias("one")).orderBy("h").limit(sample).select("h").collect()
    if not few:
        return []
    return [r["text"] for r in hashed.where(F.col("h").isin([r["h"] for r in few])).dropDuplicates(["h"]).orderBy("h").limit(sample).select("text").collect()]


def order_rules(docs: DataFrame, rules: list[Rule], text: str = "text", sample: int = SAMPLE, longest: int = LONGEST) -> list[Rule]:
    """Rules by rejections per second, measured on a sample of the texts; ties keep the order."""
    rows = draw_sample(docs, text, sample, longest)
    if not rows:
        return rules
    held = docs.sparkSession.createDataFrame([(r,) for r in rows], "text string").coalesce(1)

    def measured(rule: Rule) -> float:
        test = held.agg(F.count_if(verdict(F.col("text"), [rule]).isNotNull()).alias("n"))
        began = time.perf_counter()
        rejected = test.collect()[0]["n"]
        return rejected / max(time.perf_counter() - began, 1e-6)

    held.count()
    return [r for _, r in sorted(((measured(r), r) for r in rules), key=lambda x: -x[0])]


def judge(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None, sample: int = SAMPLE) -> tuple[DataFrame, str]:
    """All rows with the rule that rejects each (null: kept); also the name of that column."""
    ordered = order_rules(docs, rules or BASE_RULES + MORE_RULES, text, sample)
    name = fresh(docs, "rejected_by")
    return docs.withColumn(name, verdict(F.col(text), ordered)), name


def keep_good(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None, sample: int = SAMPLE) -> DataFrame:
    """The rows that no rule rejects, with their own columns."""
    judged, name = judge(docs, text, rules, sample)
    return judged.where(F.col(name).isNull()).drop(name)


def profile(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Per row the counts, the verdict of the base rules and that of the whole cascade.

    The cascade runs all rules in the measured order. It takes the counts that are reported anyway as they
    are, and computes any other only for the rows that reach its rule.
    """
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    ordered = order_rules(docs, BASE_RULES + MORE_RULES, text, sample)
    m = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"), metrics(F.col(text), shown).alias("m"))

    def get(name: str) -> Column:
        return F.col("m")[name] if name in shown else METRICS[name](F.col("t"), words(F.col("t")))

    rejected = F.lit(False)
    for rule in reversed(ordered):
        rejected = F.when(rule.fails(get), True).otherwise(rejected)
    base = BASE_RULES[0].fails(get) | BASE_RULES[1].fails(get)
    judged = m.withColumns({"base_failed": base, "kept": ~rejected})
    return judged.select("doc_id", *[F.col("m")[n].alias(n) for n in shown], "base_failed", "kept")
