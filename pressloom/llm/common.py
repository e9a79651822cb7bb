"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.session import prepare

# Java and Python agree on this class: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "pressloom_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(top, "pressloom")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, top))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def batchwise(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with the package at hand and batches bounded in bytes.

    The bound holds unless the session sets its own, so that long texts need no more memory than
    short ones.
    """
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, 16 << 20)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark so that any store Spark knows will do."""
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Blank-separated words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def int_key(key: Column) -> Column:
    """A document id as text, null as the empty text."""
    return F.coalesce(key.cast("string"), F.lit(""))


def split_of(key: Column, parts: int) -> Column:
    """Remainder of crc32 of the id's text; the fold a document belongs to."""
    return F.pmod(F.crc32(int_key(key).cast("binary")), F.lit(parts))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """A text column of an Arrow batch as UTF-8 bytes, without decoding it."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, touching ones joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out
