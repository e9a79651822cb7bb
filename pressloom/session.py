"""Session settings and the one shared folder that every eager step writes to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings the operators rely on for right results.
SEMANTIC_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that only matter for speed; a cluster may override them.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Call sites are recorded per column expression; plans here have thousands.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; on ``local[...]`` masters the tuning is for one JVM."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_SETTINGS, **SPEED_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Set the semantic settings on a session somebody else created."""
    for key, value in SEMANTIC_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a temporary folder; on a cluster a
    missing setting is an error, since a machine-local folder would be lost with
    its executor.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    current = context.getCheckpointDir()
    if not root:
        if current:
            root = current
        elif context.master.startswith("local"):
            root = "file:" + tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        else:
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    if not current:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write the rows once to the shared folder and read them back.

    One pass and columnar, where ``checkpoint()`` computes its last stage twice.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
