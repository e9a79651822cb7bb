"""Artifact arrival as a stream: a load starts when its manifest appears."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from pressloom import contracts as C
from pressloom.operators.merge import dedupe_last
from pressloom.plans import loads
from pressloom.plans.store import TableStore
from pressloom.sources.manifests import manifest_schema, validate_manifest


def stream_files(spark: SparkSession, root: str, schema, file_name: str, max_files: int = 100) -> DataFrame:
    """Stream of JSON documents with exactly this file name; other files are ignored."""
    return (
        spark.readStream.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_name)
        .option("maxFilesPerTrigger", max_files)
        .format("json").load(root)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
    )


def stream_manifests(spark: SparkSession, root: str, contract: C.Contract = C.ARTICLES, max_files: int = 100) -> DataFrame:
    return validate_manifest(
        stream_files(spark, root, manifest_schema(contract), contract.manifest_file, max_files), contract
    )


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what has arrived, batch by batch, and stop; a restart continues."""
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def append_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the rows that are final by now to the Parquet folder ``out`` and stop; a restart continues."""
    query = (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def _each(batch: DataFrame, action: Callable[[str, dict], None]) -> None:
    """Run an action per document in run order. A batch holds run metadata only, at most
    ``max_files`` rows; the data itself is read by each load as a Spark job."""
    order = [F.col(c) for c in ("run_id", "nth_run") if c in batch.columns]
    for row in batch.orderBy(*order, "file_path").collect():
        values = row.asDict(recursive=True)
        action(values["file_path"].rsplit("/", 1)[0], values)


def stream_load(store: TableStore, root: str, checkpoint: str, as_of, contract: C.Contract = C.ARTICLES) -> StreamingQuery:
    """Load every new artifact. Replays change nothing: loaded runs are skipped and merges
    are idempotent."""
    load = {"articles": loads.load_articles, "events": loads.load_events, "headlines": loads.load_headlines}[contract.name]
    return run_available(
        stream_manifests(store.spark, root, contract), checkpoint,
        lambda batch, _: _each(batch, lambda folder, m: load(store, folder, m, as_of)),
    )


def stream_chain(store: TableStore, article_root: str, event_root: str, checkpoint: str, as_of,
                 fetch: Callable[[DataFrame, dict], None] | None = None) -> None:
    """Article manifests -> article load -> load reports -> event discovery -> (fetch outside)
    -> event manifests -> event load. Each stage has its own checkpoint and reads what the
    stage before it published."""
    stream_load(store, article_root, f"{checkpoint}/articles", as_of)
    reports = stream_files(store.spark, article_root, _report_schema(), C.ARTICLES.report_file)

    def discover(folder: str, report: dict) -> None:
        if report["pipeline_status"] == "loaded":
            wanted = loads.collect_events(store, report, as_of)
            if fetch is not None:
                fetch(wanted, report)

    run_available(reports, f"{checkpoint}/discover", lambda batch, _: _each(batch, discover))
    stream_load(store, event_root, f"{checkpoint}/events", as_of, C.EVENTS)


def _report_schema():
    return C.REPORT_SCHEMA


def first_arrivals(spark: SparkSession, out: str, schema: StructType, key: list[str], ts: str, delay: str) -> Callable[[DataFrame, int], None]:
    """Batch step for ``foreachBatch``: append the rows whose key is not yet in ``out``.

    ``out`` is a table by batch and day of ``ts``. A batch is held against the keys of its own days
    and those within ``delay`` of its rows, so however late a first sighting comes, it stays, and
    however late an exact repeat comes, it goes. A batch that is run again replaces its own rows.
    """
    day = f"{ts}_day"
    written = StructType([*schema.fields, StructField("batch", LongType()), StructField(day, DateType())])
    spark.createDataFrame([], schema).withColumn(day, F.to_date(ts)).write.mode("ignore").partitionBy(day).parquet(out)

    def step(batch: DataFrame, i: int) -> None:
        margin = F.expr(f"INTERVAL {delay}")
        near = F.sequence(F.to_date(F.col(ts) - margin), F.to_date(F.col(ts) + margin))
        days = [r[day] for r in batch.select(F.explode(near).alias(day)).distinct().collect()]
        known = batch.sparkSession.read.schema(written).parquet(out).where(F.col("batch") < i)
        known = known.where(F.col(day).isin(days) | F.col(day).isNull()).select(*[F.col(k).alias(f"known_{n}") for n, k in enumerate(key)])
        same = [F.col(k).eqNullSafe(F.col(f"known_{n}")) for n, k in enumerate(key)]
        new = batch.dropDuplicates(key).join(known, same, "left_anti")
        new.withColumn(day, F.to_date(ts)).write.mode("overwrite").partitionBy(day).parquet(f"{out}/batch={i}")

    return step


def dedupe_stream(stream: DataFrame, key: list[str], ts: str, delay: str, out: str, checkpoint: str) -> StreamingQuery:
    """Write what has arrived to ``out`` without repeats. It keeps the first arrival, so use it for
    exact repeats only and let the merge decide between versions."""
    return run_available(stream, checkpoint, first_arrivals(stream.sparkSession, out, stream.schema, key, ts, delay))


def merge_last(key: list[str], order: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Batch step for ``foreachBatch``: the last version per key, as the collectors keep it."""
    return lambda batch: dedupe_last(batch, key, order)
