"""Operators that depend on order: cursors, islands, guards, gaps, ordered text. Every order is total, down to a tie-break.

Windows run within ``scope`` columns, which name the unit that the data bounds (a page, a chapter, an order). Nulls sort
first, repeated rows keep their places, empty input gives empty output, and other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _window(scope: Sequence[str], order: Sequence) -> Window:
    return Window.partitionBy(*scope).orderBy(*order)


def forward_fill(df: DataFrame, scope: Sequence[str], order: Sequence, marker: Column, value: Column, out: str) -> DataFrame:
    """``out``: ``value`` of the last row up to here where ``marker`` holds. The value travels in a struct, so a marked null resets the cursor."""
    carried = F.last(F.when(marker, F.struct(value.alias("v"))), ignorenulls=True).over(_window(scope, order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, carried["v"])


def islands(df: DataFrame, scope: Sequence[str], order: Sequence, boundary: Column, out: str, *, inclusive: bool = True) -> DataFrame:
    """``out``: number of the island, 0 before the first boundary. inclusive: a boundary row opens its island, else it closes the one before."""
    rows = _window(scope, order).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    return df.withColumn(out, F.coalesce(F.sum(F.when(boundary, 1).otherwise(0)).over(rows), F.lit(0)).cast("long"))


def monotonic_cursor(df: DataFrame, scope: Sequence[str], order: Sequence, key: Sequence[str], out: str) -> DataFrame:
    """``out``: whether the row's key is not before any earlier one; rows that go back are the ones a forward-only cursor ignores."""
    key_struct = F.struct(*key)
    before = F.max(key_struct).over(_window(scope, order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(out, F.coalesce(key_struct >= before, F.lit(True)))


def gaps(df: DataFrame, scope: Sequence[str], number: str, first: int = 1) -> DataFrame:
    """Rows (scope, number, expected) where the distinct numbers of a scope do not start at ``first`` or skip one."""
    distinct = df.select(*scope, number).filter(F.col(number).isNotNull()).distinct()
    expected = F.coalesce(F.lag(number).over(_window(scope, [number])) + 1, F.lit(first))
    return distinct.withColumn("expected", expected.cast("int")).filter(F.col(number) != F.col("expected"))


def out_of_order(df: DataFrame, scope: Sequence[str], order: Sequence, number: str) -> DataFrame:
    """Rows whose number is under that of the row before."""
    return df.withColumn("previous", F.lag(number).over(_window(scope, order))).filter(F.col(number) < F.col("previous"))


def repeats(df: DataFrame, scope: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every row of a scope after its first. The first is found with partial minima, so a scope may hold a third of all rows; rows that tie with it are firsts, too."""
    first = df.groupBy(*scope).agg(F.min(F.struct(*order)).alias("__first")).select(*(F.col(c).alias(f"__{c}") for c in scope), "__first")
    same = F.lit(True)
    for c in scope:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return df.join(first, same).filter(F.struct(*order) > F.col("__first")).drop("__first", *(f"__{c}" for c in scope))


def first_of(df: DataFrame, scope: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each scope, with partial minima; of equal rows one."""
    rest = [c for c in df.columns if c not in scope]
    first = df.groupBy(*scope).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return first.select(*scope, *(F.col(f"__first.`{c}`").alias(c) for c in rest)).select(*df.columns)


def neighbours(df: DataFrame, number: str, last: str) -> DataFrame:
    """``previous`` and ``following``: the numbers before and after each row's, from 1 to ``last``, whether they are there or not; null outside."""
    n = F.col(number)
    return df.withColumns({"previous": F.when(n.between(2, F.col(last) + 1), n - 1), "following": F.when(n.between(0, F.col(last) - 1), n + 1)})


def ordered_text(df: DataFrame, scope: Sequence[str], order: Sequence[str], text: str, separator: str | Column, out: str) -> DataFrame:
    """One row for each scope with its texts joined in order; a scope is a unit that the data bounds, such as a chapter.

    A column as separator is put before each text but the first (drop capitals join without a space).
    """
    fixed = isinstance(separator, str)
    own = df.select(*scope, F.struct(*order, F.coalesce(F.col(text), F.lit("")).alias("__t"), (F.lit("") if fixed else separator).alias("__s")).alias("__r"))
    rows = own.groupBy(*scope).agg(F.array_sort(F.collect_list("__r")).alias("__rows"))
    if fixed:
        joined = F.array_join(F.transform("__rows", lambda r: r["__t"]), separator)
    else:
        joined = F.array_join(F.transform("__rows", lambda r, i: F.when(i == 0, r["__t"]).otherwise(F.concat(r["__s"], r["__t"]))), "")
    return rows.select(*scope, joined.alias(out))


def merged_splits(df: DataFrame, scope: Sequence[str], order: Sequence, number: str, joins: Column, out: str) -> DataFrame:
    """``out``: the digits of a row and the next where ``joins`` holds (a number split in two); rows used up by the one before are dropped."""
    w = _window(scope, order)
    nxt = F.lead(number).over(w)
    flagged = df.withColumns({"__j": F.coalesce(joins & nxt.isNotNull(), F.lit(False)), "__n": nxt})
    merged = F.when(F.col("__j"), F.concat(F.col(number).cast("string"), F.col("__n").cast("string")).cast("long")).otherwise(F.col(number).cast("long"))
    return flagged.withColumn(out, merged).withColumn("__u", F.coalesce(F.lag("__j").over(w), F.lit(False))).filter("not __u").drop("__j", "__n", "__u")


def plausible(df: DataFrame, scope: Sequence[str], order: Sequence[str], number: str, most: int, step: int, out: str) -> DataFrame:
    """One row a scope with ``out``: the numbers that a reader accepts in order, each above the last by at most ``step`` and at most ``most``."""
    rows = df.filter(F.col(number).isNotNull()).groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(number).cast("int").alias("__v")))).alias("__r"))
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0))
    fold = F.aggregate(
        F.transform("__r", lambda r: r["__v"]),
        F.array().cast("array<int>"),
        lambda a, v: F.when((v > last(a)) & (v <= last(a) + step) & (v <= most), F.concat(a, F.array(v))).otherwise(a),
    )
    return rows.select(*scope, fold.alias(out))


# Letters that a scan reads for digits.
AS_DIGITS = ("lIOoSB", "110058")


def verse_sequence(df: DataFrame, scope: Sequence[str], order: Sequence[str], token: str, most: int = 176, step: int = 25) -> DataFrame:
    """One row a scope with ``accepted``: array of struct(number, how) of the markers that a reader takes for verse numbers, in order.

    A marker is read with letters for digits. It is accepted (``next``) if it goes on by at most ``step`` and is no more than ``most``; it
    begins anew (``reset``) if it is 1 or 2 after 3 or more; it stands for the expected number (``repaired``) if that differs from it in one
    character. Others are dropped. A scope is a page or a chapter.
    """
    rows = df.filter(F.col(token).isNotNull()).groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct(*order, F.translate(F.col(token), *AS_DIGITS).alias("__t")))).alias("__r"))
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1))["number"], F.lit(0))
    take = lambda a, n, how: F.concat(a, F.array(F.struct(n.cast("int").alias("number"), F.lit(how).alias("how"))))

    def read(a: Column, seen: Column) -> Column:
        n, at = seen.try_cast("int"), last(a)
        return F.when((n > at) & (n <= at + step) & (n <= most), take(a, n, "next")).when(n.isin(1, 2) & (at >= 3), take(a, n, "reset")).when((at < most) & (F.levenshtein(seen, (at + 1).cast("string")) == 1), take(a, at + 1, "repaired")).otherwise(a)

    return rows.select(*scope, F.aggregate(F.transform("__r", lambda r: r["__t"]), F.array().cast("array<struct<number:int,how:string>>"), read).alias("accepted"))


def reading_order(df: DataFrame, scope: Sequence[str], x: str, y: str, width: Column, tie: Sequence[str], out: str) -> DataFrame:
    """``out``: place in the reading order of a two-column page: left column first, each from the top (y grows upwards)."""
    column = F.when(F.col(x) < width / 2, 0).otherwise(1)
    return df.withColumn(out, F.row_number().over(_window(scope, [column, F.col(y).desc(), F.col(x), *tie])).cast("long"))
