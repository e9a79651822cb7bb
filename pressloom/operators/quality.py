"""Constraint audits and the audit of landed result pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom import contracts as C
from pressloom.functions.times import instant


def _one_of(column: str, values: list[str]) -> Column:
    return F.col(column).isin(values)


def rules_for(table: str) -> dict[str, Column]:
    """Domain rules of a table: name -> condition that must not be false."""
    run = {
        "run_type": _one_of("run_type", C.RUN_TYPES),
        "nth_run": F.col("nth_run") >= 1,
    }
    tables = {
        "runs": {
            **run,
            "status": _one_of("status", C.RUN_STATUSES),
            "window": F.col("window_from") < F.col("window_to"),
            "rows_consistency": F.col("rows_loaded") == F.col("db_rows_inserted") + F.col("db_rows_updated"),
        },
        "articles": {
            **run,
            "data_type": _one_of("data_type", C.DATA_TYPES),
            "ingestion_source": _one_of("ingestion_source", [C.ARTICLE_INGESTION_SOURCE]),
        },
        "headlines": {"ingestion_source": _one_of("ingestion_source", C.HEADLINE_INGESTION_SOURCES)},
        "metrics": {**run, "stage": _one_of("stage", C.RUN_STAGES)},
        "concepts": {"type": _one_of("type", C.CONCEPT_TYPES)},
        "outlets": {
            "api_access": _one_of("api_access", C.API_ACCESS_TYPES),
            "paywall": _one_of("paywall", C.PAYWALL_TYPES),
        },
        "anomalies": {
            "severity": _one_of("severity", C.ANOMALY_SEVERITIES),
            "category": _one_of("category", C.ANOMALY_CATEGORIES),
            "resolution_status": _one_of("resolution_status", C.ANOMALY_STATUSES),
        },
        "comment_counts": {"entity_type": _one_of("entity_type", C.COMMENT_ENTITY_TYPES)},
    }
    return tables[table]


def check_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Each row once per rule it breaks; a NULL condition passes, as a CHECK does.

    All rules are tested in one pass over the rows.
    """
    broken = F.array_compact(F.array(*[F.when(~cond, F.lit(name)) for name, cond in rules.items()]))
    return df.withColumn("_broken", broken).where(F.size("_broken") > 0).select(
        *df.columns, F.explode("_broken").alias("rule")
    )


def key_violations(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once, among the rows of ``where`` for a conditional key.
    Rows with a NULL key part never collide."""
    rows = df if where is None else df.where(where)
    filled = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return rows.where(filled).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose filled foreign key has no parent.

    Distinct keys are looked up, not rows: a key that most children share is one row in
    the lookup, and only the (few) orphaned keys go back to the children.
    """
    keys = child.select(fk).where(F.col(fk).isNotNull()).distinct()
    lost = keys.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
    return child.join(lost, fk, "left_semi")


def page_audit(articles: DataFrame, early_stop_from, run: list[str], page: str = "page", pos: str = "pos",
               uri: str = "uri", ts: str = "ts", window_from=None, window_to=None, page_size: int = C.PAGE_SIZE) -> DataFrame:
    """Facts and verdict per landed result page of a run, from its article rows (page, position).

    Per page: how many rows it has, the uris first accepted on it, its oldest date, whether
    the same uris in the same order were on an earlier page, and whether it is trusted to lie beyond the
    boundary (all older, not seen before, with new uris); of both flags also how many pages in a row
    they have held up to here (0 where they do not). The verdict is ``abort`` (MAX_REPEATED_PAGES seen
    pages in a row), ``last_page`` (fewer than ``page_size`` rows), ``early_stop`` (TRUSTED_STOP_PAGES trusted
    pages in a row) or ``continue``; pages after the first that does not continue are ``not_reached``.
    A run has at most MAX_PAGES pages, so its pages fit one window partition; article rows are reduced to pages first.
    """
    rows = articles.withColumn("_uri", F.trim(F.col(uri).cast("string")))
    filled = F.coalesce(F.col("_uri") != "", F.lit(False))
    seq = F.struct(F.col(page), F.col(pos))
    lo = instant(window_from) if window_from is not None else None
    inside = F.lit(True) if lo is None else (
        F.col(ts).isNull() | ((F.col(ts) >= lo) & (F.col(ts) < instant(window_to)))
    )
    accepted = rows.where(filled & inside)
    first_seen = accepted.groupBy(*run, "_uri").agg(F.min(seq).alias("_first"))
    new_uris = first_seen.groupBy(*run, F.col(f"_first.{page}").alias(page)).agg(F.count("*").alias("new_uris"))
    # A page holds at most ``page_size`` uris.
    in_order = F.transform(F.sort_array(F.collect_list(F.struct(pos, "_uri"))), lambda x: x["_uri"])
    prints = rows.where(filled).groupBy(*run, page).agg(F.concat_ws("|", in_order).alias("fingerprint"))
    pages = rows.groupBy(*run, page).agg(
        F.count("*").alias("articles"), F.min(F.when(filled, F.col(ts))).alias("oldest")
    )
    pages = (
        pages.join(prints, [*run, page], "left").join(new_uris, [*run, page], "left")
        .na.fill({"fingerprint": "", "new_uris": 0})
    )
    same = Window.partitionBy(*run, "fingerprint").orderBy(page)
    order = Window.partitionBy(*run).orderBy(page)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)

    def streak(flag: str) -> Column:
        """Length of the run of true flags that ends here; ``_g`` numbers the false ones."""
        return F.sum(F.col(flag).cast("int")).over(
            Window.partitionBy(*run, f"_g{flag}").orderBy(page).rowsBetween(Window.unboundedPreceding, 0)
        )

    marked = pages.withColumn("seen_before", F.row_number().over(same) > 1)
    crossed = F.coalesce(F.col("oldest") < instant(early_stop_from), F.lit(False))
    marked = marked.withColumn("trusted_stop", crossed & ~F.col("seen_before") & (F.col("new_uris") > 0))
    for flag in ("seen_before", "trusted_stop"):
        marked = marked.withColumn(f"_g{flag}", F.sum((~F.col(flag)).cast("int")).over(upto))
        marked = marked.withColumn(f"{flag}_streak", streak(flag))
    streaks = [F.when(F.col(flag), F.col(f"{flag}_streak")).otherwise(F.lit(0)).cast("bigint").alias(f"{flag}_streak") for flag in ("seen_before", "trusted_stop")]
    marked = marked.select(*run, page, "articles", "new_uris", "oldest", "seen_before", "trusted_stop", *streaks)
    verdict = (
        F.when(F.col("seen_before_streak") >= C.MAX_REPEATED_PAGES, "abort")
        .when(F.col("articles") < page_size, "last_page")
        .when(F.col("trusted_stop_streak") >= C.TRUSTED_STOP_PAGES, "early_stop")
        .otherwise("continue")
    )
    marked = marked.withColumn("verdict", verdict)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stopped = F.coalesce(F.max(F.col("verdict") != "continue").over(before), F.lit(False))
    return marked.withColumn("verdict", F.when(stopped, "not_reached").otherwise(F.col("verdict")))
