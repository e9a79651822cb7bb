"""Join helpers for keys of which one may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(big: DataFrame, small: DataFrame, key: str, spread_by: list[str], how: str = "left",
           salts: int = 16) -> DataFrame:
    """Join ``big`` to ``small`` (unique on ``key``), hot keys spread over ``salts`` tasks.

    Each big row gets a salt from its own columns, so a retried task repeats it; each
    small row is copied once per salt. Below the broadcast threshold Spark broadcasts the
    small side and the salt costs nothing but the copies.
    """
    salt, taken = "_salt", {c.lower() for c in [*big.columns, *small.columns]}
    while salt in taken:
        salt += "_"
    salted_big = big.withColumn(salt, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted_small = small.withColumn(salt, copies)
    return salted_big.join(salted_small, [key, salt], how).drop(salt)
