"""Ordered scans that hold when one key owns a large share of the rows.

A window function puts a whole key into one task. Here keys with at most
``limit`` rows go through a plain window. Rows of larger keys are range
partitioned by (key, order), so one key spreads over many tasks; each piece is
scanned on its own and gets the totals of the earlier pieces added. Pieces are
summarised before they meet, so what is combined is one row per (key, piece).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave.session import materialize

WINDOW_ROWS = 1_000_000
BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, last (non-null) or bit_or.

    ``within`` restarts the value whenever these further columns change.
    """

    kind: str
    column: Column
    within: tuple[str, ...] = field(default=())


_AGGREGATE = {
    "sum": F.sum,
    "last": lambda c: F.last(c, ignorenulls=True),
    "bit_or": F.bit_or,
}


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``name`` sorts ascending, ``-name`` descending."""
    return [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc() for n in order]


def complete_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """``order``, then every other column, so that only exact copies of a row are left equal.

    The same order holds however the rows are cut, so a result never depends on
    the way a key's size sends it.
    """
    named = {n.lstrip("-") for n in order}
    return [*order, *[f.name for f in df.schema if f.name not in named and f.name not in keys
                      and not isinstance(f.dataType, T.MapType)]]


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality, so rows with a null key stay together."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__{k}"]) for k in keys])


@dataclass
class Split:
    usual: DataFrame
    hot: DataFrame | None
    hot_rows: int


def split_hot(df: DataFrame, keys: Sequence[str], limit: int) -> Split:
    """Separate the rows of keys with more than ``limit`` rows.

    Costs one pass over the key columns with map-side counting. Keys are counted
    by hash, which keeps the counting shuffle small; two keys that share a hash
    can only be called hot together, and the hot way is right for any key. The
    hot keys are at most rows/limit many and are broadcast only when few.
    """
    hashed = F.xxhash64(*keys)
    counts = (
        df.select(hashed.alias("__hot_hash")).groupBy("__hot_hash")
        .agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > limit)
    )
    found = counts.agg(F.count(F.lit(1)), F.sum("__rows")).first()
    if not found[0]:
        return Split(df, None, 0)
    hot_keys = materialize(counts).select("__hot_hash")
    if found[0] <= BROADCAST_KEYS:
        hot_keys = F.broadcast(hot_keys)
    on = hashed == F.col("__hot_hash")
    return Split(df.join(hot_keys, on, "left_anti"), df.join(hot_keys, on, "left_semi"), found[1])


def range_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int,
                 rows_per_piece: int) -> DataFrame:
    """Number contiguous pieces of the (keys, order) sort as ``__piece``.

    ``__tie`` makes the order strict, so that exact copies of a row also spread.
    The result is written out because a later evaluation could cut elsewhere.
    """
    pieces = max(2, ceil(rows / rows_per_piece))
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    spread = tied.repartitionByRange(
        pieces, *[F.col(k) for k in keys], *sort_columns(order), F.col("__tie"))
    return materialize(spread.withColumn("__piece", F.spark_partition_id()))


def numbered(df: DataFrame, order: Sequence[str], name: str,
             rows_per_piece: int = WINDOW_ROWS) -> tuple[DataFrame, int]:
    """Number all rows from 0 in ``order``, without sorting them in one task; also their count."""
    rows = df.count()
    pieces = range_pieces(df, [], order, rows, rows_per_piece)
    sizes = pieces.groupBy("__piece").agg(F.count(F.lit(1)).alias("__size"))
    # one row per piece meets in this window, not one per row
    before = Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__piece", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__piece").orderBy(*sort_columns(order), F.col("__tie"))
    place = F.col("__start") + F.row_number().over(inside) - 1
    return pieces.join(starts, "__piece").select(*df.columns, place.alias(name)), rows


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            outputs: dict[str, Running], limit: int = WINDOW_ROWS,
            exclusive: bool = False) -> DataFrame:
    """Add running values per key, in order, current row included unless ``exclusive``.

    Rows that are equal in ``order`` follow each other by their other columns.
    ``last`` needs an ascending order.
    """
    columns = df.columns
    order = complete_order(df, keys, order)
    end = -1 if exclusive else Window.currentRow
    split = split_hot(df, keys, limit)
    ordered = sorted(outputs.items(), key=lambda item: len(item[1].within))
    usual = split.usual
    for name, spec in ordered:
        window = (
            Window.partitionBy(*keys, *spec.within).orderBy(*sort_columns(order))
            .rowsBetween(Window.unboundedPreceding, end)
        )
        usual = usual.withColumn(name, _AGGREGATE[spec.kind](spec.column).over(window))
    if split.hot is None:
        return usual
    hot = split.hot
    for within in sorted({spec.within for spec in outputs.values()}, key=len):
        group = {n: s for n, s in outputs.items() if s.within == within}
        hot = _running_in_pieces(hot, [*keys, *within], order, group, split.hot_rows, limit, end)
    return usual.unionByName(hot.select(*columns, *[n for n, _ in ordered]))


def _running_in_pieces(df: DataFrame, keys: list[str], order: Sequence[str],
                       outputs: dict[str, Running], rows: int, limit: int, end: int) -> DataFrame:
    valued = df.withColumns({f"__v_{n}": s.column for n, s in outputs.items()})
    pieces = range_pieces(valued, keys, order, rows, limit)
    place = F.struct(*[F.col(n.lstrip("-")) for n in order], F.col("__tie"))

    def total(name: str, spec: Running) -> Column:
        value = F.col(f"__v_{name}")
        if spec.kind == "last":
            return F.max_by(value, F.when(value.isNotNull(), place))
        return _AGGREGATE[spec.kind](value)

    totals = pieces.groupBy(*keys, "__piece").agg(
        *[total(n, s).alias(f"__t_{n}") for n, s in outputs.items()])
    earlier = (
        Window.partitionBy(*keys).orderBy("__piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("__piece").alias("__before"),
        *[_AGGREGATE[s.kind](F.col(f"__t_{n}")).over(earlier).alias(f"__c_{n}")
          for n, s in outputs.items()])
    inside = (
        Window.partitionBy(*keys, "__piece").orderBy(*sort_columns(order), F.col("__tie").asc())
        .rowsBetween(Window.unboundedPreceding, end)
    )
    scanned = pieces.withColumns({
        f"__i_{n}": _AGGREGATE[s.kind](F.col(f"__v_{n}")).over(inside)
        for n, s in outputs.items()})
    joined = scanned.join(
        carried, same_keys(scanned, carried, keys) & (F.col("__piece") == F.col("__before")))

    def combined(name: str, spec: Running) -> Column:
        here, before = F.col(f"__i_{name}"), F.col(f"__c_{name}")
        if spec.kind == "sum":
            return F.coalesce(before + here, here, before)
        if spec.kind == "last":
            return F.coalesce(here, before)
        return F.coalesce(before.bitwiseOR(here), here, before)

    return joined.select(*df.columns, *[combined(n, s).alias(n) for n, s in outputs.items()])


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: Column,
              right_time: Column, payload: Sequence[str], strict: bool = False,
              limit: int = WINDOW_ROWS) -> DataFrame:
    """Left rows with the payload of the newest right row at or before their time.

    ``strict`` means before only. Both sides go through one ordered scan, so work
    is linear in their rows even where one key holds many of both; right rows
    with equal time are ordered by payload, greatest wins.
    """
    right_first = 1 if strict else 0
    own = [c for c in left.columns if c not in keys]

    def empty(df: DataFrame, value: Column) -> Column:
        return F.lit(None).cast(df.select(value.alias("v")).schema["v"].dataType)

    found = F.struct(*payload)
    hashed = F.xxhash64(*keys).alias("__hash")  # sorts much faster than the keys themselves
    events = (
        left.select(
            hashed, *left.columns, left_time.alias("__time"), F.lit(1 - right_first).alias("__side"),
            empty(right, found).alias("__right"))
        .unionByName(right.select(
            hashed, *keys, *[empty(left, F.col(c)).alias(c) for c in own],
            right_time.alias("__time"), F.lit(right_first).alias("__side"),
            found.alias("__right")))
    )
    scanned = running(
        events, ["__hash", *keys], ["__time", "__side", "__right"],
        {"__found": Running("last", F.col("__right"))}, limit)
    return scanned.where(F.col("__side") == 1 - right_first).select(
        *left.columns, *[F.col(f"__found.{c}").alias(c) for c in payload])
