"""Exact ranks and exact order statistics per group, for groups of any size.

``row_number`` over a group and ``percentile`` both bring a whole group to one task. A channel may hold a third of all
customers, so both are done here without that:

* ranks come from one range sort over all groups; a task ranks its own rows, and the rows before a task are counted;
* order statistics come from counting: each pass counts the rows per bucket, picks the buckets that hold the wanted
  positions, and the next pass splits only these. Counts combine on the map side and no row is moved.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import write_through

BITS = 16
_SLICE_BITS = 33  # monotonically_increasing_id: the task number sits above 33 bits of position


def sort_once(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Sort by group and ``order`` over all tasks and write the rows once, with their place in the sort.

    Written, because the ranks count rows by the task that sorted them: a second run of the sort might cut the tasks
    differently.
    """
    return write_through(df.orderBy(group, *order).withColumn("_seq", F.monotonically_increasing_id()), "sorted")


def rank_sorted(ordered: DataFrame, group: str) -> DataFrame:
    """Add ``rank`` 1..n per group to the rows of ``sort_once``.

    The sort is by group first, so there is at most one count per sorting task and one per group; AQE, which knows their
    size, chooses the join.
    """
    placed = ordered.withColumn("_task", F.shiftright("_seq", _SLICE_BITS))
    slices = placed.groupBy(group, "_task").agg(F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first"))
    earlier = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        group, "_task", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    ranked = placed.join(offsets, [group, "_task"])
    return ranked.withColumn("rank", F.col("_seq") + F.col("_shift")).drop("_seq", "_task", "_shift")


def rank_in_group(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``rank`` 1..n per group by ``order``, which must be unique per group."""
    return rank_sorted(sort_once(df, group, order), group)


def order_statistics(df: DataFrame, group: str, values: list[str], parts: int = 5) -> DataFrame:
    """The order statistics that ``parts`` quantiles need, exactly, for integer columns.

    ``df`` is read once per pass and once for its extremes, so it should be a written table.

    One row per group, column and cut ``k`` = 0 .. parts, with linear interpolation at position (n-1)k/parts:
    ``low`` and ``high`` are the values around it, ``n`` the count, ``remainder`` of ``parts`` the way between them.
    A pass counts at most 2**16 buckets per group, column and wanted bucket, whatever the number of rows; the width of
    the values alone decides how many passes there are.
    """
    floors = df.agg(
        *[F.min(v).alias(f"min_{i}") for i, v in enumerate(values)],
        *[F.max(v).alias(f"max_{i}") for i, v in enumerate(values)],
    ).first()
    count = len(values)
    lows = [floors[f"min_{i}"] or 0 for i in range(count)]
    widest = max((floors[f"max_{i}"] or 0) - lows[i] for i in range(count))
    passes = max(1, -(-int(widest).bit_length() // BITS))

    # values up to 2^64 apart: the way from the least one is taken in bits, and shifted without a sign
    long = df.select(
        F.col(group),
        *[_offset(F.col(v), low, widest).alias(v) for v, low in zip(values, lows)],
    ).unpivot([group], values, "measure", "value")
    long = long.filter(F.col("value").isNotNull())

    wanted = None
    for level in range(1, passes + 1):
        below = BITS * (passes - level)
        bucket = F.shiftrightunsigned("value", below)
        if wanted is None:
            counts = long.groupBy(group, "measure", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
            inside = Window.partitionBy(group, "measure")
        else:
            prefix = F.shiftrightunsigned("value", below + BITS) if below + BITS < 64 else F.lit(0).cast("bigint")
            counts = (
                long.withColumn("prefix", prefix)
                .join(wanted, [group, "measure", "prefix"])
                .groupBy(group, "measure", "prefix", "targets", bucket.alias("bucket"))
                .agg(F.count(F.lit(1)).alias("rows"))
            )
            inside = Window.partitionBy(group, "measure", "prefix")
        inside = inside.orderBy("bucket")
        upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        counts = counts.withColumns(
            {"before": F.sum("rows").over(upto) - F.col("rows"), "n": F.sum("rows").over(whole)}
        )
        if wanted is None:
            counts = counts.filter(_holds_a_target(parts)).withColumn("targets", _targets(parts))
        # positions inside the bucket, counted from its start
        hits = F.transform(
            F.filter(
                "targets",
                lambda t: (t["position"] >= F.col("before")) & (t["position"] < F.col("before") + F.col("rows")),
            ),
            lambda t: t.withField("position", t["position"] - F.col("before")),
        )
        wanted = counts.select(group, "measure", F.col("bucket").alias("prefix"), hits.alias("targets")).filter(
            F.size("targets") > 0
        )

    found = wanted.select(group, "measure", F.col("prefix").alias("value"), F.inline("targets"))
    low = F.create_map(*[F.lit(part) for pair in zip(values, lows) for part in pair])[F.col("measure")]
    way = F.col("value").cast("decimal(20,0)")
    way = F.when(F.col("value") < 0, way + F.lit(Decimal(1 << 64))).otherwise(way)
    found = found.withColumn("value", (way + low.cast("decimal(20,0)")).cast("bigint"))
    return found.groupBy(group, "measure", "n", "k", "remainder").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )


def _offset(value: Column, low: int, widest: int) -> Column:
    """``value - low`` as 64 bits without a sign. A long where the widest way fits one, which is nearly always."""
    if widest < 1 << 63:
        return value.cast("bigint") - F.lit(low).cast("bigint")
    way = value.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
    high = F.lit(Decimal(1 << 63))
    return F.when(way >= high, way - high - high).otherwise(way).cast("bigint")


def _positions(parts: int):
    """Per cut ``k`` the remainder and the two positions, below and above, counted from zero."""
    for k in range(parts + 1):
        lower = F.expr(f"((n - 1) * {k}) div {parts}")
        remainder = F.expr(f"((n - 1) * {k}) % {parts}").cast("bigint")
        yield k, remainder, (lower, lower + (remainder > 0).cast("bigint"))


def _holds_a_target(parts: int):
    """Whether a bucket holds a wanted position: plain comparisons, because nearly all buckets hold none."""
    inside = [
        (position >= F.col("before")) & (position < F.col("before") + F.col("rows"))
        for _, _, positions in _positions(parts)
        for position in positions
    ]
    return reduce(Column.__or__, inside)


def _targets(parts: int):
    """All wanted positions; cuts 0 and ``parts`` are the extremes."""
    both = [
        F.struct(
            F.lit(k).alias("k"), F.col("n").alias("n"), remainder.alias("remainder"), position.alias("position")
        )
        for k, remainder, positions in _positions(parts)
        for position in positions
    ]
    return F.array(*both)
