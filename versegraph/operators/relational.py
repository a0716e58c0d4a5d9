"""Lookups, scopes, groups and sets over DataFrames.

Small sides are broadcast only where a bounded count allows it (``functions.session.small``); everything else is an
equi-join or an aggregation with partial combining. Null keys match nothing; repeated rows stay unless an operator says otherwise;
empty inputs give empty (or for anti-joins unchanged) results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import small

FEW = 100_000


def in_scope(df: DataFrame, scope: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``scope``."""
    return df.join(scope.select(*keys).distinct(), list(keys), "left_semi")


def missing(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``expected`` without a partner."""
    return expected.join(present.select(*keys).distinct(), list(keys), "left_anti")


def flagged(df: DataFrame, other: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """``out``: whether ``other`` has the key."""
    have = other.select(*keys).distinct().withColumn(out, F.lit(True))
    return df.join(have, list(keys), "left").withColumn(out, F.coalesce(out, F.lit(False)))


def first_match(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    """The label of the first condition that holds."""
    out = F.lit(default)
    for condition, label in reversed(cases):
        out = F.when(condition, label).otherwise(out)
    return out


def preferred(df: DataFrame, keys: Sequence[str], value: str, ranking: Sequence[str], out: str) -> DataFrame:
    """For each key its value that comes first in ``ranking``; values outside it come last, in their own order."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ranking)), F.col(value)), F.lit(0).cast("long")), F.lit(len(ranking) + 1).cast("long"))
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, F.struct(rank, value)).alias(out))


def banded(df: DataFrame, bands: DataFrame, value: str, low: str, high: str) -> DataFrame:
    """``df`` with the band that holds its value, low <= value < high; bands are a small dimension, checked before it is broadcast."""
    return df.join(small(bands, FEW), (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high)), "left")


def looked_up(df: DataFrame, alias: DataFrame, key: str, alias_key: str, value: str, out: str, default: Column) -> DataFrame:
    """``out``: the value of the alias table for ``key``, else ``default``."""
    table = small(alias.select(F.col(alias_key).alias("__k"), F.col(value).alias("__v")).filter("__k is not null").dropDuplicates(["__k"]), FEW)
    return df.join(table, F.col(key) == F.col("__k"), "left").withColumn(out, F.coalesce("__v", default)).drop("__k", "__v")


def others_in_group(df: DataFrame, group: str, member: str, out: str, separator: str = ", ") -> DataFrame:
    """``out``: the other members of each member's group, in order; groups are curated and small (parallel passages), not data-sized.

    Members meet through their group's sorted set, so no pairs are made.
    """
    sets = df.groupBy(group).agg(F.array_sort(F.collect_set(member)).alias("__all"))
    return df.join(sets, group).withColumn(out, F.array_join(F.filter("__all", lambda m: m != F.col(member)), separator)).drop("__all")


def expanded(df: DataFrame, first: Column, last: Column, out: str) -> DataFrame:
    """One row for each number of an inclusive range; a range that ends before it starts has none."""
    numbers = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return df.withColumn(out, F.explode(numbers))


def wide_to_long(df: DataFrame, keys: Sequence[str], groups: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """One row for each column group up to the first whose first column is null or empty, with its position from 1."""
    entries = F.array(*(F.struct(*(F.col(c).alias(n) for c, n in zip(g, names))) for g in groups))
    empty = F.array_position(F.transform(entries, lambda e: F.coalesce(e[names[0]].cast("string"), F.lit("")) == ""), True)
    kept = F.slice(entries, 1, F.when(empty == 0, F.size(entries)).otherwise(empty - 1).cast("int"))
    return df.select(*keys, F.posexplode(kept).alias("pos", "e")).select(*keys, (F.col("pos") + 1).cast("int").alias("pos"), *(F.col(f"e.{n}").alias(n) for n in names))


def two_step(df: DataFrame, names: DataFrame, key: str, retry: Column, name: str, value: str, out: str) -> DataFrame:
    """``out``: the value of the table ``names`` for ``key`` or else for ``retry``; null without either."""
    first = looked_up(df, names, key, name, value, "__first", F.lit(None).cast("string")).withColumn("__retry", retry)
    return looked_up(first, names, "__retry", name, value, out, F.lit(None).cast("string")).withColumn(out, F.coalesce("__first", out)).drop("__first", "__retry")


def overridden(df: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` with ``value`` replaced where ``overrides`` (key, value) has another; the least of several overrides of a key."""
    least = overrides.select(F.col(key), F.col(value).alias("__over")).groupBy(key).agg(F.min("__over").alias("__over"))
    return df.join(least, key, "left").withColumn(value, F.coalesce("__over", value)).drop("__over")


def ranked(df: DataFrame, scope: Sequence[str], order: Sequence, kind: str, kinds: Sequence[str], last: Sequence, out: str) -> DataFrame:
    """``out``: place in the scope by ``order``, then by the kind's place in ``kinds``, then by ``last``; other kinds are dropped. A scope is a chapter."""
    from pyspark.sql import Window

    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col(kind))
    window = Window.partitionBy(*scope).orderBy(*order, "__rank", *last)
    return df.withColumn("__rank", rank).filter("__rank > 0").withColumn(out, F.row_number().over(window).cast("long")).drop("__rank")
