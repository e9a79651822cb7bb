"""Writing run artifacts, manifests and reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.contracts import ARTICLES, EVENTS, RUN_KEY, STALE_AFTER_HOURS, Contract
from pressloom.functions.text import one_line, path_safe


def _csv_writer(df: DataFrame, mode: str):
    return (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def run_dir(root: str, run: dict) -> str:
    """``key=value`` directory of one run; colons of the run id become dashes."""
    parts = [f"{k}={str(run[k]).replace(':', '-')}" for k in ("ingestion_source", "run_id", "run_type", "nth_run")]
    return "/".join([root.rstrip("/"), *parts])


def write_run_artifact(rows: DataFrame, root: str, run: dict, contract: Contract = ARTICLES,
                       records: DataFrame | None = None) -> str:
    """Write one run's rows (and JSONL records) once; an existing run directory fails.

    The manifest is not written here: it goes last, as the sign that the rest is whole.
    """
    target = run_dir(root, run)
    if contract.name == "headlines":
        rows = rows.select(*[one_line(c).alias(c) for c in contract.columns])
    _csv_writer(rows.select(*contract.columns), "errorifexists").csv(f"{target}/{contract.data_file}")
    if records is not None:
        records.write.mode("errorifexists").text(f"{target}/{contract.name}.jsonl")
    return target


def write_runs_partitioned(rows: DataFrame, root: str, fmt: str = "json") -> str:
    """Write the rows of many runs below ``root`` as ``key=value`` directories.

    The rebalance hint gathers each run's rows into few files and lets adaptive
    execution split a run that holds most of the rows.
    """
    keyed = rows.withColumn("run_id", path_safe(F.col("run_id").cast("string")))
    placed = keyed.hint("rebalance", *[F.col(c) for c in RUN_KEY])
    if fmt == "csv":
        _csv_writer(placed, "errorifexists").partitionBy(*RUN_KEY).csv(root)
    else:
        placed.write.mode("errorifexists").partitionBy(*RUN_KEY).format(fmt).save(root)
    return root


def write_text_file(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """One small text file with an exact name, on whatever file system ``path`` is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(target, overwrite)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def write_row_json(row: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write a one-row DataFrame (a manifest or report) as one JSON document."""
    found = row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"expected one row for {path}, got {len(found)}")
    text = json.dumps(json.loads(found[0]["j"]), indent=2)
    write_text_file(row.sparkSession, path, text, overwrite)


def build_manifest(fetched: DataFrame, contract: Contract = ARTICLES, by: list[str] | None = None,
                   **fields) -> DataFrame:
    """One manifest row per run: counts of fetched rows and distinct keys, plus literals."""
    by = by or []
    counts = fetched.groupBy(*by).agg(
        F.count("*").alias("articles_fetched"),
        F.count_distinct(F.col(contract.key)).alias("articles_deduped"),
    )
    literals = {"artifact_contract_version": contract.version, **fields}
    return counts.select(
        *[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in literals.items()],
        *by, "articles_fetched", "articles_deduped",
    )


def build_event_manifest(fetched: DataFrame, measured: DataFrame, run: dict, collected_at: str,
                         parent: dict | None = None, scope: str = "parent_run", **options) -> DataFrame:
    """One manifest row of an event artifact: run and parent keys, discovery options, and
    the counts of the event_collect metrics (``measured``) and of the fetched events."""
    counted = ["candidate_articles_scanned", "distinct_event_uris_discovered", "distinct_event_uris_selected"]
    counts = measured.agg(*[
        F.max(F.when(F.col("metric_name") == name, F.col("metric_value"))).alias(name) for name in counted
    ])
    parent = parent or {}
    given = {
        "artifact_contract_version": EVENTS.version, **{k: run[k] for k in RUN_KEY}, "collected_at": collected_at,
        **{f"parent_{k}": parent.get(k) for k in RUN_KEY}, "discovery_scope": scope,
        "discovery_time_column": None, "discovery_start": None, "discovery_end": None,
        "only_missing": False, "include_stale": True, "stale_after_hours": STALE_AFTER_HOURS, **options,
    }
    if not given["include_stale"]:
        given["stale_after_hours"] = None
    return counts.select(
        *[F.lit(v).alias(k) for k, v in given.items()], *counted,
        fetched.agg(F.count_distinct(EVENTS.key)).scalar().alias("events_fetched"),
        F.lit(EVENTS.data_file).alias("csv_file"),
    )


def refresh_table(df: DataFrame, path: str) -> None:
    """Full truncate-and-insert of a denormalised table."""
    df.write.mode("overwrite").parquet(path)
