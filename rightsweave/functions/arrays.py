"""Column helpers for arrays used as sets, chains and aligned lists.

Everything here returns a native ``Column`` expression, so it stays inside
whole-stage code generation; nothing calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source system.
ROLE_PUBLISHER = "E"
ROLE_SUBPUBLISHER = "SE"
CREATOR_ROLES = ("A", "C", "CA")
CONTRACT_TYPE_OPTION = "OPTION"
STRICT_REQUIREMENT = "STRICTE"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_string(c) -> Column:
    """Array -> ``a|b|c`` text (element order kept); null stays null."""
    return F.array_join(F.transform(_c(c), lambda x: x.cast("string")), "|")


def as_set(c) -> Column:
    """Canonical set form: distinct and sorted."""
    return F.array_sort(F.array_distinct(_c(c)))


def set_union(a, b) -> Column:
    return F.array_sort(F.array_union(_c(a), _c(b)))  # distinct already


def set_intersect(a, b) -> Column:
    return F.array_sort(F.array_intersect(_c(a), _c(b)))  # distinct already


def or_empty(c, element_type: str) -> Column:
    """Null array -> typed empty array."""
    return F.coalesce(_c(c), F.array().cast(f"array<{element_type}>"))


def flatten_or_empty(c, element_type: str) -> Column:
    """Flatten an array of arrays; a null outer array gives an empty array."""
    return F.flatten(F.coalesce(_c(c), F.array().cast(f"array<array<{element_type}>>")))


def safe_size(c) -> Column:
    """``size`` with the old convention: a null array has size -1."""
    return F.coalesce(F.size(_c(c)), F.lit(-1))


def restriction_meet(a, b) -> Column:
    """Meet of two inclusive restriction lists (non-void case): the intersection.

    Both empty gives empty.  Use with :func:`restriction_void`.
    """
    return set_intersect(a, b)


def restriction_void(a, b) -> Column:
    """True when two inclusive restriction lists make a chain void.

    Exactly one side empty, or two non-empty sides without common element.
    Having no inclusive restriction is therefore *not* "everything allowed"
    once the other contract restricts.
    """
    a, b = _c(a), _c(b)
    sa, sb = F.size(a), F.size(b)
    both_empty = (sa == 0) & (sb == 0)
    return ~both_empty & ((sa == 0) | (sb == 0) | (F.size(F.array_intersect(a, b)) == 0))


def later_start(a, b) -> Column:
    """Later of two start dates; a null on either side keeps the first."""
    a, b = _c(a), _c(b)
    return F.when(a < b, b).otherwise(a)


def earlier_end(a, b) -> Column:
    """Earlier of two end dates; a null first end stays null (open)."""
    a, b = _c(a), _c(b)
    return F.when(a > b, b).otherwise(a)


def truncated_pct_product(x, y) -> Column:
    """``x * y / 100`` truncated toward zero, as a double; null if either is null."""
    return F.try_divide(_c(x) * _c(y), F.lit(100.0)).cast("long").cast("double")


def pct_product(x, y) -> Column:
    """``x * y / 100`` (no truncation); null if either is null."""
    return F.try_divide(_c(x) * _c(y), F.lit(100.0))


def pairwise_pct(first_list, second_list, field: str = "pct_publisher", truncate: bool = True) -> Column:
    """Element-wise percent product of two aligned struct lists.

    Entry ``i`` of the first list takes ``pct * second[i].pct / 100``
    (truncated toward zero unless ``truncate=False``); when the second list
    is shorter the value becomes null.
    """
    first_list, second_list = _c(first_list), _c(second_list)
    prod = truncated_pct_product if truncate else pct_product
    return F.transform(
        first_list,
        lambda x, i: x.withField(field, prod(x[field], F.get(second_list, i)[field])),
    )


def first_of(c, field: str) -> Column:
    """Field of the first struct of a list; null for an empty list."""
    return F.get(_c(c), 0)[field]
