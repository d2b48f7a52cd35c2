"""Dense vectors as ``array<float>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarmart.functions.scalar import ColumnLike, _c


def literal_vector(values: Sequence[float]) -> Column:
    return F.lit([float(v) for v in values])


def dot(a: ColumnLike, b: ColumnLike) -> Column:
    products = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: ColumnLike) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: ColumnLike, b: ColumnLike) -> Column:
    """Cosine similarity; NULL for a NULL vector or one of length zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def check_dims(vector: ColumnLike, dims: int) -> Column:
    """True if the vector is NULL or has the declared number of dimensions."""
    v = _c(vector)
    return v.isNull() | (F.size(v) == dims)
