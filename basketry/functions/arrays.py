"""Array expressions used on baskets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _n(k: Column | int) -> Column:
    return F.lit(k) if isinstance(k, int) else k


def tail(arr: Column | str, k: Column | int) -> Column:
    """Last ``k`` elements (requires 1 <= k <= size)."""
    a = _col(arr)
    return F.slice(a, F.size(a) - _n(k) + 1, _n(k))


def head(arr: Column | str, k: Column | int) -> Column:
    """All but the last ``k`` elements (requires 0 <= k <= size)."""
    a = _col(arr)
    return F.slice(a, F.lit(1), F.size(a) - _n(k))


def cast_elements(arr: Column | str, to: str) -> Column:
    """Higher-order element cast; invalid values become NULL."""
    return F.transform(_col(arr), lambda x: x.try_cast(to))


def one_hot_dense(idx: Column | str, width: Column | int) -> Column:
    """Dense 0/1 array of ``width`` with a 1 at ``idx``; an id outside
    [0, width) or NULL gives all zeros."""
    i = _col(idx)
    return F.transform(F.sequence(F.lit(0), _n(width) - 1),
                       lambda j: F.when(j == i, F.lit(1)).otherwise(F.lit(0)))


def join_ints(arr: Column | str, sep: str = ",", null: str = "NULL") -> Column:
    """Render an int array as text; NULL elements keep their place as ``null``."""
    return F.array_join(F.transform(_col(arr), lambda x: x.cast("string")), sep, null)
