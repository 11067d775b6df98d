"""Helpers for single-dimension GROUPING SETS aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def set_name(dims: list[str], gid_col: str = "_gid") -> Column:
    """For ``groupingSets([[d] for d in dims], *dims)`` with ``grouping_id()``
    in ``gid_col``: the name of the dimension each output row groups by."""
    k = len(dims)
    expr = None
    for i, d in enumerate(dims):
        gid = (1 << k) - 1 - (1 << (k - 1 - i))   # every bit set except dimension i's
        cond = F.col(gid_col) == gid
        expr = F.when(cond, F.lit(d)) if expr is None else expr.when(cond, F.lit(d))
    return expr


def set_key(dims: list[str], cast: str | None = None) -> Column:
    """The grouped value of each row (the other dimensions are null there)."""
    cols = [F.col(d).cast(cast) if cast else F.col(d) for d in dims]
    return F.coalesce(*cols)
