"""Skew-safe previous/next-row lookups per key.

``lag(v) over (partition by key order by t)`` puts every row of one key in a
single task.  The billing tables are customer-month grained, so a key is
normally small, but one customer (or a pile of duplicate rows under one id, or
under a NULL id) may still hold a large share of a table.

The rows of a key are ordered by ``t`` (NULLs last), then by a hash slice of
the ``tie`` columns, then by those columns and the value: a total order up to
rows that agree in all of them.  A map-side combined count per key names the
hot keys, those of more than ``HOT_ROWS`` rows; there are at most rows /
``HOT_ROWS`` of them, so they are broadcast.  ``previous_value`` and
``next_value`` take the plain window over the rows of all other keys, which
is one shuffle of them, and cut the rows of the hot keys into buckets, one
per (``t``, slice):

1. the window runs per (key, t, slice) -- neither a hot key nor a hot
   key and month stays together;
2. a map-side-combined ``max_by``/``min_by`` per bucket takes the value to
   hand over -- one row per bucket;
3. a window over that table, bounded by distinct ``t`` times ``SLICES`` rows
   per key, hands each bucket the neighbouring bucket's value;
4. it is joined back null-safely, and the first row of each bucket takes the
   handed-over value.

The rows are read once to count and once to shift them (and twice more if
there are hot keys).  They are dealt anew before the plain window: an input
that was partitioned by the key while it had fewer rows (a log before its
months are exploded) would otherwise be sorted in tasks sized for that.

The result equals the plain window row for row (``bucket=False``, the right
choice when the rows per key are bounded by construction: one shuffle, or none
if the input is already partitioned by the key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64
#: A key with more rows than this is cut into buckets.
HOT_ROWS = 100_000
_SLICE = "__slice"
_EDGE = "__edge"
_NEIGHBOUR = "__neighbour"
_HOT = "__hot"
_HASH = "__hash"


def _shift(df: DataFrame, key: str, order_col: str, value_col: str, out_col: str,
           backwards: bool, bucket: bool, tie: Sequence[str]) -> DataFrame:
    tie = list(tie)
    sliced = F.pmod(F.xxhash64(*tie), F.lit(SLICES)) if tie else F.lit(0).cast("bigint")
    # LEAD is the same walk the other way round: NULLs of ``t`` stay at the end of time.
    if backwards:
        by_time, by = F.col(order_col).asc_nulls_last(), lambda c: F.col(c).asc_nulls_last()
    else:
        by_time, by = F.col(order_col).desc_nulls_first(), lambda c: F.col(c).desc_nulls_first()
    inside = [by(c) for c in dict.fromkeys([*tie, value_col]) if c != order_col]

    def plain(rows: DataFrame, *by_hash: str) -> DataFrame:
        w = Window.partitionBy(*by_hash, key).orderBy(by_time, by(_SLICE), *inside)
        return rows.withColumn(_SLICE, sliced).withColumn(out_col, F.lag(value_col).over(w)).drop(_SLICE, *by_hash)

    if not bucket:
        return plain(df)
    counts = df.groupBy(F.col(key).alias(_HOT)).agg(F.count(F.lit(1)).alias("__rows"))
    hot = F.broadcast(counts.where(F.col("__rows") > HOT_ROWS).select(_HOT))
    is_hot = F.col(key).eqNullSafe(F.col(_HOT))
    # By a hash of the key: by the key itself, Spark would leave out the shuffle where the input has that partitioning.
    cold = plain(df.join(hot, is_hot, "left_anti").withColumn(_HASH, F.hash(key)).repartition(_HASH), _HASH)
    # The bucket's last row in walking order: the greatest (least) of its order
    # columns, a NULL counting as greater than any value.
    withs = df.join(hot, is_hot, "left_semi").withColumn(_SLICE, sliced)
    rank = F.struct(*[x for c in dict.fromkeys([*tie, value_col]) if c != order_col
                      for x in (F.col(c).isNull(), F.col(c))] or [F.lit(0)])
    pick = F.max_by if backwards else F.min_by
    tails = withs.groupBy(key, order_col, _SLICE).agg(pick(F.struct(value_col), rank).alias("__tail"))
    along = Window.partitionBy(key).orderBy(by_time, by(_SLICE))
    handoff = tails.select(F.col(key).alias("__k"), F.col(order_col).alias("__t"), F.col(_SLICE).alias("__s"),
                           F.lag("__tail").over(along)[value_col].alias(_NEIGHBOUR))
    w = Window.partitionBy(key, order_col, _SLICE).orderBy(*(inside or [by(_SLICE)]))
    inner = (withs.repartition(key, order_col, _SLICE)
             .withColumn(out_col, F.lag(value_col).over(w))
             .withColumn(_EDGE, F.row_number().over(w) == 1))
    joined = inner.join(handoff, F.col(key).eqNullSafe(F.col("__k"))
                        & F.col(order_col).eqNullSafe(F.col("__t")) & (F.col(_SLICE) == F.col("__s")), "left")
    return cold.unionByName(joined.select(
        *df.columns,
        F.when(F.col(_EDGE), F.col(_NEIGHBOUR)).otherwise(F.col(out_col)).alias(out_col)))


def previous_value(df: DataFrame, key: str, order_col: str, value_col: str, out_col: str,
                   bucket: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """Add ``out_col`` = LAG(value_col) over (partition by key order by order_col, tie)."""
    return _shift(df, key, order_col, value_col, out_col, True, bucket, tie)


def next_value(df: DataFrame, key: str, order_col: str, value_col: str, out_col: str,
               bucket: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """Add ``out_col`` = LEAD(value_col) over (partition by key order by order_col, tie)."""
    return _shift(df, key, order_col, value_col, out_col, False, bucket, tie)
