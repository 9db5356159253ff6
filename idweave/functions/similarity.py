"""Set similarity on array columns.

Used per row when both sets are already small arrays (for example, a pair of
profiles compared in a test or a UI). The distributed pair scorer in
``operators.match`` never materialises sets; it computes the same numbers
from intersection counts and set sizes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

# Attribute weights of the identity score (sum to 1).
DEFAULT_WEIGHTS = {"phone": 0.3, "name": 0.3, "mail": 0.2, "contacts": 0.2}


def jaccard(a, b) -> Column:
    """|a ∩ b| / |a ∪ b| as double; two empty sets give 0 (not 0/0)."""
    a, b = col_of(a), col_of(b)
    inter = F.size(F.array_intersect(a, b)).cast("double")
    union = F.size(F.array_union(a, b)).cast("double")
    return F.coalesce(F.try_divide(inter, union), F.lit(0.0))


def weighted_jaccard(pairs: dict[str, tuple], weights: dict[str, float] | None = None) -> Column:
    """``100 * sum(w_k * jaccard(a_k, b_k))`` over attributes k.

    ``pairs`` maps attribute name -> (left array column, right array column).
    """
    weights = weights or DEFAULT_WEIGHTS
    total = F.lit(0.0)
    for name, (a, b) in pairs.items():
        total = total + F.lit(float(weights[name])) * jaccard(a, b)
    return F.lit(100.0) * total
