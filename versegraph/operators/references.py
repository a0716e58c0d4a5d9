"""Orphan references: composite keys with partial nulls, matched in time.

References are grouped by their null mask (which key columns are null). Each mask that the declared semantics checks and the
references have is anti-joined with the targets on its non-null columns only, so that every anti-join is an equi-join that
shuffles on the key. Any key column can be null; under ``partial`` one aggregation (at most a row for each mask) tells beforehand
which masks there are, and intervals that several masks are merged from are written once to the shared folder.

Match semantics, as for foreign keys in SQL:

* ``simple``  - a reference with any null key column is not checked;
* ``partial`` - a reference must agree with some target in its non-null columns; one without any is not checked;
* ``full``    - either all key columns are null (not checked) or none; a mixed reference is always an orphan.

Defined results: null times make a reference unresolvable (it is an orphan); targets with null keys never match; a target
without a start is never there; an empty target table makes every checked reference an orphan; repeated references give one
row each as delivered, repeated targets change nothing; other columns of either table are carried or ignored, and may clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.session import stored

#: Prefix of the targets' columns inside the join, so that names of both tables can clash.
T = "__target_"


def masks(keys: Sequence[str], semantics: str) -> list[tuple[str, ...]]:
    """Sets of non-null key columns that ``semantics`` compares."""
    if semantics not in ("simple", "partial", "full"):
        raise ValueError(f"unknown match semantics {semantics!r}")
    if semantics != "partial":
        return [tuple(keys)]
    return [kept for take in product((True, False), repeat=len(keys)) if (kept := tuple(k for k, t in zip(keys, take) if t))]


def occurring(references: DataFrame, keys: Sequence[str]) -> set[tuple[str, ...]]:
    """Sets of non-null key columns of the references."""
    rows = references.select(*(F.col(k).isNotNull().alias(k) for k in keys)).distinct().collect()
    return {tuple(k for k in keys if row[k]) for row in rows}


def orphans(
    references: DataFrame,
    targets: DataFrame,
    keys: Sequence[tuple[str, str]],
    *,
    semantics: str = "simple",
    at: str | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Rows of ``references`` with no target at their time.

    keys: pairs of (reference column, target column). at: the reference's time; a target is there from ``since``
    (inclusive) to ``until`` (exclusive, null for good). Without ``at`` every target is always there.
    """
    own = [r for r, _ in keys]
    right = targets.select(*(F.col(t).alias(T + r) for r, t in keys), *((F.col(since).alias(T + "since"), F.col(until).alias(T + "until")) if at else ()))
    checked = masks(own, semantics)
    if semantics == "partial":
        there = occurring(references, own)
        checked = [kept for kept in checked if kept in there]
    covers = _covers(right, own, checked) if at else {}
    found: DataFrame | None = None
    for kept in checked:
        null = [k for k in own if k not in kept]
        part = references.filter(_all([F.col(k).isNotNull() for k in kept] + [F.col(k).isNull() for k in null]))
        # a mask with fewer columns meets many targets a key, whose intervals mostly overlap: keep their union
        have = covers[kept] if kept in covers else right.select(*(T + k for k in kept), *((T + "since", T + "until") if at else ()))
        if not at:
            have = have.distinct()
        on = [F.col(k) == F.col(T + k) for k in kept]
        if at:
            on += [F.col(at) >= F.col(T + "since"), F.col(T + "until").isNull() | (F.col(at) < F.col(T + "until"))]
        lost = part.join(have, _all(on), "left_anti")
        found = lost if found is None else found.unionByName(lost)
    if semantics == "full":
        mixed = references.filter(_any([F.col(k).isNull() for k in own]) & _any([F.col(k).isNotNull() for k in own]))
        found = found.unionByName(mixed)
    return references.filter(F.lit(False)) if found is None else found


#: Parts in which the intervals of a key are merged first, so that a key that a third of all rows have is no task's own.
PARTS = 64


def _covers(targets: DataFrame, keys: Sequence[str], checked: Sequence[tuple[str, ...]]) -> dict[tuple[str, ...], DataFrame]:
    """The merged intervals of each mask with nulls. Those of masks that lack several columns are merged out of those of one that lacks one, stored once."""
    merged = lambda df, kept: _merged(df.select(*(T + k for k in kept), T + "since", T + "until"), [T + k for k in kept])
    bases: dict[tuple[str, ...], DataFrame] = {}
    out: dict[tuple[str, ...], DataFrame] = {}
    for kept in sorted(checked, key=len):
        null = [k for k in keys if k not in kept]
        if len(null) > 1:
            base = tuple(k for k in keys if k != null[-1])
            if base not in bases:
                bases[base] = stored(merged(targets, base), "intervals")
            out[kept] = merged(bases[base], kept)
        elif null:
            out[kept] = bases[kept] if kept in bases else merged(targets, kept)
    return out


def _merged(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """The union of each key's intervals as disjoint ones: merged within parts of the key by the hash of their start, and what is left of those together."""
    part = F.pmod(F.xxhash64(T + "since"), F.lit(PARTS)).alias(T + "part")
    return _islands(_islands(intervals.select("*", part), [*keys, T + "part"]).drop(T + "part"), keys)


def _islands(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals of each key that overlap or touch as one; an end that is null outlasts all."""
    since, until = F.col(T + "since"), F.col(T + "until")
    order = Window.partitionBy(*keys).orderBy(T + "since")
    before = F.max(F.struct(until.isNull().alias("open"), until.alias("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (~before["open"] & (since > before["end"])), 1).otherwise(0)
    rows = intervals.filter(since.isNotNull()).withColumn(T + "begins", begins).withColumn(T + "island", F.sum(T + "begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy(*keys, T + "island").agg(F.min(T + "since").alias(T + "since"), F.when(F.bool_or(until.isNull()), None).otherwise(F.max(T + "until")).alias(T + "until")).drop(T + "island")


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
