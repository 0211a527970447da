"""Dense vector expressions over ``array<double>`` columns (JVM higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sq_dist(a, b) -> Column:
    """Squared Euclidean distance of two equal-length arrays."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def dist(a, b) -> Column:
    return F.sqrt(sq_dist(a, b))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm2(a) -> Column:
    return F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0), lambda acc, v: acc + v)


def l2_normalize(a) -> Column:
    n = F.sqrt(norm2(a))
    return F.when(n > 0, F.transform(_c(a), lambda x: x / n)).otherwise(_c(a))


def as_double_array(a) -> Column:
    return _c(a).cast("array<double>")
