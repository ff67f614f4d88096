"""String column expressions (inventory C1-C10, B1).

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen. Each takes and returns a ``Column``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal / scientific number, optional sign and surrounding blanks.
# Guards ``try_cast`` against forms the JVM parser accepts but a
# dataframe-library parser would not ("1d", "1f", "Infinity", "0x1p3").
_NUMBER_RE = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def regex_group(col: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``'s group, NULL when nothing matches.

    ``regexp_extract`` yields '' on no match; NULL is what a missing value
    must be downstream (null checks, drop-na).
    """
    return F.nullif(F.regexp_extract(_c(col), pattern, group), F.lit(""))


def strip_blank(col: Column | str) -> Column:
    """Remove leading/trailing whitespace of every kind (``trim`` only strips
    spaces, leaving tabs and newlines)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def lower_strip(col: Column | str) -> Column:
    """Join-key normalisation, lower case + strip."""
    return strip_blank(F.lower(_c(col)))


def normalize_label(col: Column | str) -> Column:
    """Lower, '-' -> ' ', strip, collapse whitespace runs to one space."""
    spaced = F.regexp_replace(F.lower(_c(col)), "-", " ")
    return F.regexp_replace(strip_blank(spaced), r"\s+", " ")


def classify(
    col: Column | str,
    groups: Mapping[str, Iterable[str]],
    default: str = "Other",
    normalize: bool = True,
) -> Column:
    """Map a label to the first group whose member set contains it.

    NULL (or no group) gives ``default``. With ``normalize`` the label goes
    through :func:`normalize_label` first.
    """
    value = normalize_label(col) if normalize else _c(col)
    out = None
    for name, members in groups.items():
        cond = value.isin(list(members))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def yes_no(col: Column | str, yes: str = "yes", no: str = "no") -> Column:
    """C4: case/blank-insensitive yes/no -> 1 / 0, anything else NULL."""
    v = lower_strip(_c(col))
    return F.when(v == yes.lower(), F.lit(1)).when(v == no.lower(), F.lit(0)).cast("int")


def to_number(col: Column | str) -> Column:
    """B1: string -> double, malformed -> NULL (never raises under ANSI)."""
    s = _c(col).cast("string")
    return F.when(s.rlike(_NUMBER_RE), strip_blank(s).try_cast("double"))


def clean_numeric_string(col: Column | str, remove: str = "m", strict: bool = False) -> Column:
    """Drop every occurrence of ``remove``, strip, '' / 'nan' / 'None' ->
    NULL, then parse as double: malformed text -> NULL, or with ``strict``
    the query fails on it (an ANSI cast), as a strict float parse does."""
    s = strip_blank(F.replace(_c(col).cast("string"), F.lit(remove), F.lit("")))
    s = F.when(s.isin("", "nan", "None"), F.lit(None).cast("string")).otherwise(s)
    if strict:
        return F.when(s.isNull() | s.rlike(_NUMBER_RE), s).otherwise(F.concat(F.lit("not a number: "), s)) \
            .cast("double")
    return to_number(s)


def normalize_vat(col: Column | str) -> Column:
    """Strip, then ':No' / ': No' / 'No' -> 'No'."""
    return F.regexp_replace(strip_blank(_c(col)), r"^:?\s*No$", "No")


def int_key_string(col: Column | str) -> Column:
    """Numeric-looking key -> canonical integer string; NULL / 0 -> NULL.

    Leading zeros are lost ('0999' -> '999'), as an int round trip does.
    """
    raw = F.coalesce(_c(col).cast("string"), F.lit("0"))
    return F.nullif(to_number(raw).cast("long").cast("string"), F.lit("0"))


def coalesce_blank(first: Column | str, second: Column | str) -> Column:
    """C9: '' counts as missing, then fall back to the second language."""
    return F.coalesce(F.nullif(_c(first), F.lit("")), _c(second))


def round_half_even(col: Column | str, digits: int = 0) -> Column:
    """banker's rounding, as a numpy round does."""
    return F.bround(_c(col), digits)
