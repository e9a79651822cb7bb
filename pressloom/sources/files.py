"""Strict scans of artifact data files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.contracts import ARTICLES, EVENTS, HEADLINES, Contract
from pressloom.operators.merge import insert_if_absent


class ContractError(ValueError):
    """An artifact does not match its contract."""


def scan_csv(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """All-text scan that fails on a renamed, reordered, short or long header.

    The reader checks every file against the schema while it reads. That check can
    ignore case, so the first header line is also compared literally. Cells may hold
    line breaks; such files cannot be split, which is why the JSONL twin is the
    format for very large runs.
    """
    expected = ",".join(contract.columns)
    first = spark.read.text(path).first()
    actual = first[0].rstrip("\r") if first else None
    if actual != expected:
        raise ContractError(f"unexpected CSV header\nexpected: {expected}\nactual:   {actual}")
    return (
        spark.read.schema(contract.csv_schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def scan_article_csv(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, ARTICLES)


def scan_event_csv(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, EVENTS)


def scan_headline_csv(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, HEADLINES)


def scan_articles_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line, read as text columns; nested values stay JSON text."""
    lineage = "ingestion_source string, run_id string, collected_at string, window_from string, window_to string"
    columns = ", ".join(f"`{c}` string" for c in ARTICLES.columns)
    return spark.read.schema(f"{lineage}, {columns}").option("mode", "FAILFAST").json(path)


def seed_headlines(headlines: DataFrame, seed: DataFrame) -> DataFrame:
    """Insert seed rows whose url is not there yet; the seed's ``id`` is the source id."""
    rows = seed.withColumnRenamed("id", "source_id").withColumn(
        "published_at", F.col("published_at").cast("timestamp")
    )
    return insert_if_absent(headlines, rows, ["url"])
