"""Vector math on ``array<float>`` columns via higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sq_norm(v) -> Column:
    return F.aggregate(_c(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x)


def l2_norm(v) -> Column:
    return F.sqrt(sq_norm(v))


def l2_normalize(v) -> Column:
    """Unit-length copy, computed in double and stored as float; a zero vector
    passes unchanged."""
    def scaled(n):
        return F.when(n > 0, F.transform(_c(v), lambda x: (x.cast("double") / n).cast("float"))).otherwise(_c(v))
    return F.transform(F.array(l2_norm(v)), scaled)[0]  # the norm once a vector, not once a component


def inner_product(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def cosine(a, b) -> Column:
    """Null where either vector is zero."""
    return F.try_divide(inner_product(a, b), l2_norm(a) * l2_norm(b))


def sq_distance(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)
