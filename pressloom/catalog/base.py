"""Query registry and access to the input tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.catalog.fixtures import PROJECTIONS
from pressloom.session import prepare


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[["Tables"], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the equivalent text, or None where SQL is too slow."""

    def register(build):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return register


class Tables:
    """Input tables of one folder, and the news projections of them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        naive = [c for c, t in df.dtypes if t == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df

    def stream(self, name: str) -> DataFrame:
        """The input table as a file stream."""
        schema = self.spark.read.parquet(f"{self.folder}/{name}.parquet").schema
        df = self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)
        naive = [c for c, t in df.dtypes if t == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df

    def fx(self, name: str) -> DataFrame:
        """A projection; its SQL text is the one the oracle uses."""
        text = PROJECTIONS[name]
        # Views of their own names, gone once the statement is analysed.
        views = {one: f"src_{one}_{uuid.uuid4().hex}" for one in set(re.findall(r"\$(\w+)", text))}
        for one, view in views.items():
            source = self.fx(one) if one in PROJECTIONS else self.raw(one)
            source.createOrReplaceTempView(view)
        found = self.spark.sql(re.sub(r"\$(\w+)", lambda m: views[m[1]], text))
        for view in views.values():
            self.spark.catalog.dropTempView(view)
        return found


def with_fx(*names: str, more: str = "") -> str:
    """WITH clause that defines the projections (and those they read) for the oracle."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for one in re.findall(r"\$(\w+)", PROJECTIONS[name]):
            if one in PROJECTIONS:
                add(one)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)

    def text(name: str) -> str:
        return re.sub(r"\$(\w+)", lambda m: f"fx_{m[1]}" if m[1] in PROJECTIONS else m[1], PROJECTIONS[name])

    parts = [f"fx_{n} AS ({text(n)})" for n in ordered]
    if more:
        parts.append(more)
    return "WITH " + ",\n".join(parts) + "\n"


def ts_text(value: Column | str) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def sql_ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


# Guarded JSON array expansion for the oracle.
def sql_items(column: str) -> str:
    return (
        f"unnest(CASE WHEN {column} IS NOT NULL AND {column} NOT IN ('', 'null') "
        f"AND json_type({column}) = 'ARRAY' THEN from_json({column}, '[\"json\"]') ELSE [] END)"
    )
