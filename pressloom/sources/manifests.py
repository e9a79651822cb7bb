"""Run metadata: manifests, load reports and run directories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.contracts import (
    ARTICLES, EVENT_MANIFEST_SCHEMA, EVENTS, MANIFEST_SCHEMA, REPORT_SCHEMA, RUN_KEY, Contract,
)
from pressloom.functions.text import blank_to_null


def manifest_schema(contract: Contract):
    return EVENT_MANIFEST_SCHEMA if contract.name == EVENTS.name else MANIFEST_SCHEMA


def _with_file(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )


def scan_manifests(spark: SparkSession, root: str, contract: Contract = ARTICLES) -> DataFrame:
    """All manifests below ``root``; the file name is matched whole, not by suffix."""
    return _with_file(
        spark.read.schema(manifest_schema(contract))
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", contract.manifest_file)
        .option("mode", "FAILFAST")
        .json(root)
    )


def scan_reports(spark: SparkSession, root: str, contract: Contract = ARTICLES) -> DataFrame:
    return _with_file(
        spark.read.schema(REPORT_SCHEMA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", contract.report_file)
        .json(root)
    )


def manifest_problem(contract: Contract) -> Column:
    """Text of the first broken rule of a manifest row, NULL for a good one."""
    rules = []
    if contract.version:
        version = F.col("artifact_contract_version")
        rules.append((~version.eqNullSafe(F.lit(contract.version)),
                      F.concat(F.lit(f"expected contract {contract.version}, got "),
                               F.coalesce(version, F.lit("none")))))
    if "csv_file" in contract.required:
        rules.append((~F.col("csv_file").eqNullSafe(F.lit(contract.data_file)),
                      F.concat(F.lit(f"expected data file {contract.data_file}, got "),
                               F.coalesce(F.col("csv_file"), F.lit("none")))))
    for field in contract.required:
        rules.append((blank_to_null(field).isNull(), F.lit(f"manifest lacks {field}")))
    return F.coalesce(*[F.when(broken, text) for broken, text in rules])


def validate_manifest(manifests: DataFrame, contract: Contract = ARTICLES) -> DataFrame:
    """The same rows; the first bad manifest fails the job with the rule it breaks."""
    problem = manifest_problem(contract)
    ok = F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.lit(True))
    return manifests.where(ok)


def latest_run(manifests: DataFrame, by: str = "modified_at") -> DataFrame:
    """Newest artifact set: by file time, or by ``run_id`` for the headline layout."""
    order = [F.col(by).desc_nulls_last()]
    if by != "run_id":
        order.append(F.col("run_id").desc_nulls_last())
    order += [F.col(c).desc_nulls_last() for c in ("ingestion_source", "run_type", "nth_run")]
    return manifests.orderBy(*order).limit(1)


def latest_loaded_report(reports: DataFrame) -> DataFrame:
    """Newest load report; it must be a loaded one and carry the whole run key."""
    newest = reports.orderBy(
        F.col("modified_at").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in RUN_KEY]
    ).limit(1)
    incomplete = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in RUN_KEY])
    ok = (
        F.when(incomplete, F.raise_error(F.lit("load report lacks a run key field")).cast("boolean"))
        .when(~F.col("pipeline_status").eqNullSafe(F.lit("loaded")),
              F.raise_error(F.lit("latest load report is not loaded")).cast("boolean"))
        .otherwise(F.lit(True))
    )
    return newest.where(ok)


def resolve_parent_run(reports: DataFrame, override: dict | None = None) -> DataFrame:
    """Run key of the parent run: a complete override wins over the latest report."""
    override = override or {}
    if all(override.get(k) not in (None, "") for k in RUN_KEY):
        nth = int(override["nth_run"])
        if nth < 1:
            raise ValueError(f"nth_run must be at least 1, got {nth}")
        values = {**override, "nth_run": nth}
        return reports.sparkSession.range(1).select(*[F.lit(values[k]).alias(k) for k in RUN_KEY])
    return latest_loaded_report(reports).select(*RUN_KEY)


def landing_partitions(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Run directories below ``root``: their ``key=value`` columns, file count and bytes.

    Only file listings are read, never file contents.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root)
    keys = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    return files.groupBy(*[F.col(k).cast("string").alias(k) for k in keys]).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )
