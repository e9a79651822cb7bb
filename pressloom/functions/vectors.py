"""Vector expressions over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions.text import _c


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; NULL when a vector has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(a: Column | str) -> Column:
    """The vector scaled to length 1; its own length is computed once."""
    return F.flatten(F.transform(F.array(norm(a)), lambda n: F.transform(_c(a), lambda x: x.cast("double") / n)))


def mean_vector(vector: Column | str, dim: int) -> Column:
    """Aggregate: element-wise mean of vectors of length ``dim``.

    One average per position keeps the shuffle at one small row per task and group
    and needs no row per vector element.
    """
    c = _c(vector)
    return F.array(*[F.avg(F.get(c, F.lit(i)).cast("double")) for i in range(dim)])
