"""String helpers that stay inside whole-stage codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def word(col, n: int = 1, sep: str = " ") -> Column:
    """n-th ``sep``-separated word (1-based); NULL when there is no such word."""
    return F.try_element_at(F.split(_c(col), re.escape(sep)), F.lit(n))


def str_c(*parts, sep: str = "") -> Column:
    """Concatenate; any NULL part makes the result NULL (unlike concat_ws)."""
    cols = []
    for i, p in enumerate(parts):
        if i and sep:
            cols.append(F.lit(sep))
        cols.append(p if isinstance(p, Column) else F.lit(p))
    return F.concat(*cols)


def comma(col) -> Column:
    """Whole number with thousands separators, e.g. 12,345."""
    return F.format_number(_c(col), 0)
