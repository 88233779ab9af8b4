"""Label lists: static labels, duplicate keys, canonical order, compact identity."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from metricspark.schema import LABELS, NAME_KEY

_SNAKE_CASE = re.compile(r"[a-z0-9]+(?:_[a-z0-9]+)*")


def label(key: Column | str, value: Column | str) -> Column:
    """One ``struct<key,value>``; plain strings are taken as literals."""
    as_col = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(as_col(key).alias("key"), as_col(value).alias("value"))


def labels_of(pairs: Sequence[tuple[str, Column]]) -> Column:
    """Label list from columns; a null value leaves its label out. Lists of one label or none are put
    together, which compiles, unlike a higher-order function over all of them."""
    none = F.array().cast(LABELS)
    return F.concat(none, *[F.when(v.isNotNull(), F.array(label(k, v))).otherwise(none) for k, v in pairs])


def present(labels: Column) -> Column:
    return F.filter(labels, lambda p: p["value"].isNotNull())


def labels_from_map(labels: Column) -> Column:
    return F.map_entries(labels)


def parse_static_labels(text: str) -> list[tuple[str, str]]:
    """``a=1,b=2`` to pairs. Names are snake case, values not empty; empty text is no labels."""
    if not text:
        return []
    pairs = []
    for part in text.split(","):
        name, sep, value = part.partition("=")
        if not sep or not value or not _SNAKE_CASE.fullmatch(name):
            raise ValueError(f"invalid static label {part!r}")
        pairs.append((name, value))
    return pairs


def with_static_labels(
    labels: Column,
    static: Sequence[tuple[str, str]] | Mapping[str, str] = (),
    target_labels: Column | None = None,
) -> Column:
    """Global labels, then the target's non-null labels, then the sample's own."""
    pairs = list(static.items()) if isinstance(static, Mapping) else list(static)
    parts = [labels]
    if target_labels is not None:
        parts.insert(0, F.coalesce(present(target_labels), F.slice(labels, 1, 0)))
    if pairs:
        parts.insert(0, F.array(*[label(k, v) for k, v in pairs]))
    return F.concat(*parts)


def last_wins(labels: Column) -> Column:
    """Keep the last label of each key, so a sample's own label beats a static one."""
    keys = F.transform(labels, lambda p: p["key"])
    deduped = F.filter(
        labels,
        lambda p, i: ~F.exists(
            F.slice(labels, i + 2, F.size(labels)), lambda later: later["key"] == p["key"]
        ),
    )
    return F.when(F.size(F.array_distinct(keys)) == F.size(labels), labels).otherwise(deduped)


def sorted_by_key(labels: Column) -> Column:
    """Stable sort of label pairs by key."""
    ranked = F.transform(
        labels,
        lambda p, i: F.struct(p["key"].alias("key"), i.alias("ord"), p["value"].alias("value")),
    )
    return F.transform(F.sort_array(ranked), lambda p: label(p["key"], p["value"]))


def canonical_labels(name: Column, labels: Column) -> Column:
    """The identity of a series: its labels with the metric name, one per key, in key order.

    Labels with a key each, none of them the name's, are only sorted, which compiles; higher-order
    functions, which do not, run where a key comes twice."""
    named = F.array(label(NAME_KEY, name))
    keys = labels.getField("key")
    plain = ~F.array_contains(keys, NAME_KEY) & (F.size(F.array_distinct(keys)) == F.size(keys))
    own = F.filter(labels, lambda p: p["key"] != NAME_KEY)
    return F.when(plain, F.sort_array(F.concat(named, labels))).otherwise(sorted_by_key(F.concat(named, last_wins(own))))


def series_hash(*parts: Column) -> Column:
    """64-bit pre-key of a label list. Equal hashes still need an equality check."""
    return F.xxhash64(*parts)


def labels_text(labels: Column, sep: str = ",") -> Column:
    """``k=v`` pairs joined, for display and comparison."""
    return F.array_join(F.transform(labels, lambda p: F.concat(p["key"], F.lit("="), p["value"])), sep)
