"""Operators that follow a row order over the whole table: carried values and running totals.

A window without a partition runs in one task, and one partitioned by a hot key runs its third of the
table in one task. Here the rows are range partitioned by (keys, order), written once with the number of
their partition, and summarised to one row per partition. What a partition needs from its neighbours comes
from the summaries; the rest is a window inside the partition. A hot key simply spans several partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.columns import q, replace_columns
from tablewright.session import materialise

PART = "__part"
MAX_PARTS = 200_000


def ordered_parts(df: DataFrame, order: Sequence, parts: int | None = None) -> DataFrame:
    """Write ``df`` range partitioned by ``order`` with the partition number in ``__part``."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if parts > MAX_PARTS:
        raise ValueError(f"{parts} parts: the one row per part would be too many to summarise in one task")
    ranged = df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id())
    return materialise(ranged, "ordered")


def row_numbers(df: DataFrame, order: Sequence, out: str) -> DataFrame:
    """Number the rows from 0 in ``order``: the place within a range partition after the rows of the partitions before it.

    The rows of each partition are counted, a number per partition.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    written = materialise(ranged, "numbered")
    part = F.shiftright("__place", 33)
    counts = {r["part"]: r["n"] for r in written.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, []
    for p in sorted(counts):
        offsets += [F.lit(p), F.lit(before)]
        before += counts[p]
    offset = F.create_map(*offsets)[part] if offsets else F.lit(0)
    return written.withColumn(out, offset + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))).drop("__place")


def fill_along(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (),
               columns: Sequence[str] | None = None, direction: str = "forward",
               parts: int | None = None) -> DataFrame:
    """Carry the last (forward) or next (backward) present value into missing cells.

    ``partition_by`` and ``order_by`` together must order the rows uniquely. ``columns`` defaults to all
    the others.
    """
    if direction not in ("forward", "backward"):
        raise ValueError(f"unknown direction {direction!r}")
    keys, order = list(partition_by), list(order_by)
    columns = [c for c in (columns or df.columns) if c not in keys + order]
    if not columns:
        return df
    forward = direction == "forward"
    tagged = ordered_parts(df, [q(c) for c in keys + order], parts)

    # Per part and column: the present value nearest to the neighbouring part, with its keys.
    pick = F.max if forward else F.min
    key_struct = F.struct(F.lit(0).alias("k"), *[q(c).alias(f"k{i}") for i, c in enumerate(keys)])
    order_struct = F.struct(*[q(c).alias(f"o{i}") for i, c in enumerate(order)])
    edge = tagged.groupBy(PART).agg(*[
        pick(F.when(q(c).isNotNull(), F.struct(key_struct.alias("k"), order_struct.alias("o"), q(c).alias("v"))))
        .alias(f"e{i}") for i, c in enumerate(columns)])
    edge = materialise(edge, "edges")  # read twice: for the numbers of the parts and for the values
    # Per part and column the number of the part to carry from: a few numbers per part, at most MAX_PARTS rows.
    near = Window.partitionBy(F.lit(0)).orderBy(F.col(PART) if forward else F.col(PART).desc())
    before = near.rowsBetween(Window.unboundedPreceding, -1)
    holds = edge.select(PART, *[F.when(F.col(f"e{i}").isNotNull(), F.col(PART)).alias(f"h{i}") for i in range(len(columns))])
    behind = holds.select(PART, *[F.last(f"h{i}", ignorenulls=True).over(before).alias(f"s{i}") for i in range(len(columns))])
    sources = behind.select(PART, F.posexplode(F.array(*[F.col(f"s{i}") for i in range(len(columns))])).alias("i", "source"))
    # The values, which may be long texts, come by an equi-join on (part, column).
    wide = F.struct(*[F.col(f"e{i}") for i in range(len(columns))])
    fetched = sources.where("source IS NOT NULL").join(edge.select(F.col(PART).alias("source"), wide.alias("e")), "source")
    carried = fetched.groupBy(PART).agg(*[
        F.first(F.when(F.col("i") == i, F.col(f"e.e{i}")), ignorenulls=True).alias(f"c{i}") for i in range(len(columns))])

    # Carried texts may be long, so they are not broadcast. Both sides hash by part, which is also what the
    # window below asks for: the rows move once.
    joined = tagged.join(carried.hint("shuffle_hash"), PART, "left")
    local = Window.partitionBy(PART, *keys).orderBy(*[q(c) if forward else q(c).desc_nulls_last() for c in order])
    local = local.rowsBetween(Window.unboundedPreceding, 0)
    filled = {}
    for i, c in enumerate(columns):
        same_group = F.col(f"c{i}.k").eqNullSafe(key_struct)
        filled[c] = F.coalesce(F.last(q(c), ignorenulls=True).over(local), F.when(same_group, F.col(f"c{i}.v")))
    return joined.select(*[filled[c].alias(c) if c in filled else q(c) for c in df.columns])


def running_totals(df: DataFrame, order_by: str, columns: Sequence[str], descending: bool = False,
                   prefix: str = "cum_", parts: int | None = None) -> DataFrame:
    """Add running sums, current row included, along a unique order column."""
    order = q(order_by).desc() if descending else q(order_by)
    tagged = ordered_parts(df, [order], parts)
    sums = tagged.groupBy(PART).agg(*[F.sum(q(c)).alias(f"s{i}") for i, c in enumerate(columns)])
    before = Window.partitionBy(F.lit(0)).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(PART, *[F.coalesce(F.sum(f"s{i}").over(before), F.lit(0)).alias(f"b{i}")
                                  for i in range(len(columns))])
    local = Window.partitionBy(PART).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    totals = {prefix + c: F.sum(q(c)).over(local) + F.col(f"b{i}") for i, c in enumerate(columns)}
    # A few numbers per part, at most MAX_PARTS rows.
    joined = tagged.join(F.broadcast(offsets), PART)
    return replace_columns(joined, totals).select(*[q(c) for c in df.columns], *[q(c) for c in totals])
