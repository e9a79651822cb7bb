"""Numbering, ordering and top-k."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.session import materialize, work_path


def number_rows(df: DataFrame, by: list[str], order: list[Column], out: str = "rn") -> DataFrame:
    """ROW_NUMBER over (PARTITION BY by ORDER BY order) for groups of any size.

    A plain window would sort a group that holds a third of all rows in one task. Here
    rows are range partitioned on (group, order), so such a group spans many tasks; each
    row is numbered inside its partition and the counts of the group's earlier partitions
    are added. Only groups crossing a partition border need an offset, and each partition
    continues at most one group, so the offset table has fewer rows than there are
    partitions and is safe to broadcast. ``order`` must end in a unique column.

    The range borders come from a sample, so the partitioned rows are written before they
    are read twice.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in by], *order)
    placed = materialize(ranged.withColumn("_pid", F.spark_partition_id()), "ranged")
    local = Window.partitionBy("_pid", *by).orderBy(*order)
    numbered = placed.withColumn("_local", F.row_number().over(local))
    runs = placed.groupBy("_pid", *by).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("_offset", F.sum("_n").over(earlier)).where("_offset IS NOT NULL").drop("_n")
    on = [F.col("r._pid") == F.col("o._pid")] + [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in by]
    return (
        numbered.alias("r")
        .join(F.broadcast(offsets).alias("o"), reduce(lambda a, b: a & b, on), "left")
        .select(*[F.col(f"r.{c}") for c in df.columns],
                (F.col("r._local") + F.coalesce(F.col("o._offset"), F.lit(0))).cast("bigint").alias(out))
    )


def worklist(df: DataFrame, key: str = "uri") -> DataFrame:
    """Global numbering of the distinct keys in key order."""
    return number_rows(df.select(key).distinct(), [], [F.col(key).asc()])


def worklist_batches(df: DataFrame, size: int = 5000, key: str = "uri") -> DataFrame:
    """The work list with its batch number; all batches come from one pass."""
    return worklist(df, key).withColumn("batch", F.floor((F.col("rn") - 1) / size).cast("bigint"))


def hash_batches(df: DataFrame, batches: int, key: str = "uri") -> DataFrame:
    """Batch number by key hash: needs no numbering and no shuffle."""
    return df.withColumn("batch", F.pmod(F.xxhash64(key), F.lit(batches)))


def order_articles(df: DataFrame, tie: str = "uri") -> DataFrame:
    """Newest first by publication, else index time; undated rows count as the epoch."""
    ts = F.coalesce(F.col("date_time_published"), F.col("date_time"), F.timestamp_seconds(F.lit(0)))
    return df.orderBy(ts.desc(), F.col(tie))


def top_k(df: DataFrame, by: str, key: list[str], k: int) -> DataFrame:
    """Largest ``by`` first, ties by key, so that the cut is the same on every run."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in key]).limit(k)


def sample_uris(df: DataFrame, k: int = 3, key: str = "uri") -> DataFrame:
    return df.where((F.col(key) != "")).select(key).orderBy(key).limit(k)


def order_nulls_last(df: DataFrame, cols: list[str], descending: bool = False) -> DataFrame:
    return df.orderBy(*[F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in cols])


def capped_distinct(df: DataFrame, column: str, cap: int | None = None) -> DataFrame:
    """Distinct filled values; with ``cap`` only that many, the smallest, so that the cut is repeatable."""
    found = df.select(column).where(F.col(column).isNotNull() & (F.col(column) != "")).distinct()
    return found if cap is None else found.orderBy(column).limit(cap)


def written_places(df: DataFrame, out: str = "place") -> DataFrame:
    """Write an ordered DataFrame and number its rows from 1 where they lie in the files."""
    spark, path = df.sparkSession, work_path(df.sparkSession, "ordered")
    df.write.parquet(path)
    name, row = (fresh_name(df, n) for n in ("_file", "_row"))
    lying = spark.read.schema(df.schema).parquet(path).select("*", F.col("_metadata.file_name").alias(name), F.col("_metadata.row_index").alias(row))
    return number_rows(lying, [], [F.col(name).asc(), F.col(row).asc()], out).drop(name, row)


def fresh_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def latest(df: DataFrame, column: str, key: str, k: int) -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last(), F.col(key)).limit(k)
