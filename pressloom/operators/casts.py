"""Staged text rows to typed rows, and row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.contracts import ARTICLES, EVENTS, HEADLINES, RUN_KEY, Contract
from pressloom.functions import jsonx, text
from pressloom.functions.text import blank_to_null
from pressloom.functions.times import instant
from pressloom.functions.vectors import cosine


def blanks_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = df.columns if cols is None else cols
    return df.withColumns({c: blank_to_null(c) for c in cols})


def _clock(value: Column, strict: bool) -> Column:
    """Validated time of day as text; trailing zeros of the fraction are dropped."""
    stamped = F.concat(F.lit("1970-01-01 "), value)
    parsed = stamped.cast("timestamp") if strict else stamped.try_cast("timestamp")
    digits = F.rtrim(F.date_format(parsed, "SSSSSS"), F.lit("0"))
    whole = F.date_format(parsed, "HH:mm:ss")
    return F.when(digits == "", whole).when(digits != "", F.concat(whole, F.lit("."), digits))


def _cast(name: str, kind: str, strict: bool) -> Column:
    c = blank_to_null(name)
    if kind == "json":
        return jsonx.canonical_json(name) if strict else jsonx.try_canonical_json(name)
    if kind == "flag":
        return text.parse_flag(c)
    if kind == "time":
        return _clock(c, strict)
    return c.cast(kind) if strict else c.try_cast(kind)


def cast_staged(staged: DataFrame, contract: Contract, mode: str = "fail") -> DataFrame:
    """Typed projection of a staged text table, rows without a key dropped.

    ``mode='fail'`` fails on the first malformed value. ``mode='quarantine'`` keeps every
    row, sets malformed values to NULL and lists their columns in ``_rejects``.
    """
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"unknown mode {mode}")
    casts = dict(contract.casts)
    strict = mode == "fail"
    typed = {c: _cast(c, casts[c], strict) if c in casts else blank_to_null(c) for c in contract.columns}
    out = [typed[c].alias(c) for c in contract.columns]
    if not strict:
        bad = [
            F.when(blank_to_null(c).isNotNull() & typed[c].isNull(), F.lit(c))
            for c, kind in casts.items() if kind != "flag"
        ]
        out.append(F.array_compact(F.array(*bad)).alias("_rejects"))
    return valid_key(staged, contract.key).select(*out)


def _with_lineage(df: DataFrame, run: dict | None, keep_row_run: bool) -> DataFrame:
    """Add lineage: row values of run_type and nth_run win over the manifest's."""
    if run is None:
        return df
    value = {k: v if isinstance(v, Column) else F.lit(v) for k, v in run.items()}
    new = {
        "ingestion_source": value["ingestion_source"],
        "run_id": value["run_id"].cast("timestamp"),
        "collected_at": value["collected_at"].cast("timestamp"),
    }
    if keep_row_run:
        new["run_type"] = F.coalesce(blank_to_null("run_type"), value["run_type"])
        new["nth_run"] = F.coalesce(blank_to_null("nth_run").cast("int"), value["nth_run"].cast("int"))
    return df.withColumns(new)


def cast_articles(staged: DataFrame, run: dict | None = None, mode: str = "fail") -> DataFrame:
    return _with_lineage(cast_staged(staged, ARTICLES, mode), run, True)


def cast_events(staged: DataFrame, mode: str = "fail") -> DataFrame:
    return cast_staged(staged, EVENTS, mode).drop("run_type", "nth_run")


def cast_headlines(staged: DataFrame, run: dict | None = None, mode: str = "fail") -> DataFrame:
    return _with_lineage(cast_staged(staged, HEADLINES, mode), run, False)


def valid_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(blank_to_null(key).isNotNull())


def by_run(df: DataFrame, run: dict) -> DataFrame:
    """Rows of one run; a plain conjunction, so run partitions are pruned."""
    conds = [F.col(k) == F.lit(run[k]) for k in RUN_KEY if k in run]
    return df.where(reduce(lambda a, b: a & b, conds))


def in_window(df: DataFrame, start, end, columns: list[str], keep_undated: bool = True) -> DataFrame:
    """Half-open ``[start, end)`` on the first filled column; undated rows pass if kept."""
    ts = F.coalesce(*[F.col(c) for c in columns])
    inside = (ts >= instant(start)) & (ts < instant(end))
    return df.where(ts.isNull() | inside if keep_undated else inside)


def has_tag(df: DataFrame, column: str, tag: str) -> DataFrame:
    return df.where(F.array_contains(column, tag))


def tags_overlap(df: DataFrame, column: str, tags: list[str]) -> DataFrame:
    return df.where(F.arrays_overlap(F.col(column), F.array(*[F.lit(t) for t in tags])))


def category_tier(df: DataFrame, column: str = "category_uri") -> DataFrame:
    """``news`` roots are usable, ``dmoz`` roots noisy, any other root unknown."""
    root = F.split(F.col(column), "/")[0]
    tier = F.when(root == "news", "usable").when(root == "dmoz", "noisy").otherwise("unknown")
    return df.withColumns({"root": root, "tier": tier})


def recent_by_source(articles: DataFrame, source_uri: str, k: int = 50) -> DataFrame:
    return (
        articles.where(F.col("source_uri") == source_uri)
        .orderBy(F.col("date_time_published").desc_nulls_last(), F.col("uri"))
        .limit(k)
    )


def body_gate(df: DataFrame, threshold: float = 0.3, headline: str = "headline_embedding",
              body: str = "body_embedding", clean: str = "body_clean") -> DataFrame:
    """``body_valid`` needs clean text and a headline/body cosine of at least ``threshold``."""
    similarity = cosine(headline, body)
    return df.withColumns({
        "body_headline_similarity": similarity,
        "body_valid": F.col(clean) & F.coalesce(similarity >= threshold, F.lit(False)),
    })
