"""Encoding, sentinel and selector expressions (inventory D1-D17, J1, J3).

Missing values come in four states that stay distinct until stage 3:
NULL, the sentinel ``-1``, an unmapped label (NULL after a map lookup, so
its missing-flag is 0) and a real value. The helpers below keep them apart.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTINEL = -1


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def map_literal(mapping: Mapping) -> Column:
    """A ``MapType`` literal built from a python mapping (small, fixed maps)."""
    pairs = []
    for key, value in mapping.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.create_map(*pairs)


def lookup(col: Column | str, mapping: Mapping, default=None) -> Column:
    """Value of ``mapping[col]``; unmapped / NULL -> ``default``
    (NULL unless given). A missing key yields NULL, never an error."""
    value = F.try_element_at(map_literal(mapping), _c(col))
    return value if default is None else F.coalesce(value, F.lit(default))


def binary_with_missing(col: Column | str) -> Column:
    """1 -> 1, 0 -> 0, anything else or NULL -> -1 (int)."""
    c = _c(col)
    return F.when(c == 1, F.lit(1)).when(c == 0, F.lit(0)).otherwise(F.lit(SENTINEL)).cast("int")


def missing_flag(col: Column | str, sentinel=SENTINEL) -> Column:
    """1 where the value equals the sentinel, else 0 (NULL -> 0)."""
    return F.coalesce(_c(col) == sentinel, F.lit(False)).cast("int")


def sentinel_to_null(col: Column | str, sentinel=SENTINEL) -> Column:
    """Sentinel -> NULL, other values unchanged."""
    return F.nullif(_c(col), F.lit(sentinel))


def log1p_positive(col: Column | str) -> Column:
    """``log1p`` where the value is > 0, NULL otherwise."""
    c = _c(col)
    return F.when(c > 0, F.log1p(c))


def select_by_type(type_col: Column | str, when_value: str, if_col, else_col) -> Column:
    """Take ``if_col`` where type equals ``when_value``, else ``else_col``
    (NULL type falls to ``else_col``)."""
    return F.when(_c(type_col) == when_value, _c(if_col)).otherwise(_c(else_col))


def out_of_range_flag(col: Column | str, lo, hi, sentinel=SENTINEL) -> Column:
    """1 when the value is present, not the sentinel, and outside the
    inclusive range [lo, hi]."""
    c = _c(col)
    cond = c.isNotNull() & (c != sentinel) & ((c < lo) | (c > hi))
    return F.coalesce(cond, F.lit(False)).cast("int")


def cap_to_sentinel(col: Column | str, lo, hi, sentinel=SENTINEL) -> Column:
    """Values outside [lo, hi] (sentinel exempt) become the sentinel."""
    c = _c(col)
    bad = (c != sentinel) & ((c < lo) | (c > hi))
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(sentinel)).otherwise(c)
