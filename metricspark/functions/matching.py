"""Predicates over label-id arrays.

Arrays hold 0 where a key is not set and never hold null, so the results are never null
unless stated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metricspark.schema import NAME_KEY


def contains(labels: Column, ids: Column) -> Column:
    """Every id is among the labels; true for no ids."""
    return F.size(F.array_except(ids, labels)) == 0


def match_positive(labels: Column, ids: Column) -> Column:
    """At least one id is among the labels; false for no ids."""
    return F.arrays_overlap(labels, ids)


def match_negative(labels: Column, ids: Column) -> Column:
    """No id is among the labels; a series without the key passes."""
    return ~F.arrays_overlap(labels, ids)


def without_name(labels: Column) -> Column:
    """The array without its first slot, the metric name."""
    return F.slice(labels, F.lit(2), F.greatest(F.size(labels) - 1, F.lit(0)))


def eq(left: Column, right: Column) -> Column:
    """Same length and every slot of ``right`` past the name is in ``left``.

    Positions are not compared and an unset slot counts as an element, so this is only as
    exact as the arrays are dense; see :func:`eq_exact`.
    """
    return (F.size(left) == F.size(right)) & contains(left, without_name(right))


def eq_matcher(labels: Column, ids: Column) -> Column:
    """The labels are exactly the ids plus the name. Null for no ids."""
    wanted = F.nullif(F.size(ids), F.lit(0)) + 1
    return (F.size(labels) == wanted) & contains(labels, ids)


def eq_map(labels: Column, pairs: Column, ids: Column) -> Column:
    """The labels are exactly the pairs of a map, given the ids the pairs resolve to."""
    return (F.size(labels) == count_keys(without_name_key(pairs)) + 1) & contains(labels, ids)


def eq_exact(left: Column, right: Column) -> Column:
    """Same set labels past the name, whatever the positions and gaps."""
    as_set = lambda a: F.array_remove(without_name(a), 0)
    return (F.size(as_set(left)) == F.size(as_set(right))) & contains(as_set(left), as_set(right))


def without_name_key(pairs: Column) -> Column:
    return F.map_filter(pairs, lambda k, _: k != NAME_KEY)


def count_keys(pairs: Column) -> Column:
    return F.size(F.map_keys(pairs))
