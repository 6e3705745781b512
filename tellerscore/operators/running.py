"""Running totals inside groups, with groups too large for one task split over several.

A window evaluates each group in one task. That is right for almost all groups and wrong for one
that holds a large share of the rows, so groups above a measured size take another way: a range
sort on (group, order) cuts them into pieces, each piece is totalled on its own, and the totals
of the earlier pieces are added.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerscore.session import materialize

# Rows of one group that a single task may sort; above it the group is split.
SPLIT_ROWS = 4_000_000


@dataclass(frozen=True)
class GroupSizes:
    """The rows ``n`` of each group or an upper bound of it, the largest ``n`` and all rows.

    ``frame`` is read only where ``largest`` calls for a split, and then several times, so it
    should be a written table.
    """

    frame: DataFrame
    largest: int
    rows: int


def running_totals(
    rows: DataFrame,
    group: list[str],
    order: list[str],
    measure: Column,
    sizes: GroupSizes,
    split_rows: int = SPLIT_ROWS,
    attach: DataFrame | None = None,
) -> DataFrame:
    """Add ``run_n`` and ``run_s``: count and sum in the group up to and including each row.

    (group, order) must identify a row. ``attach`` has one row per group, whose columns are added
    to the group's rows; joining it afterwards would bring a split group together again.
    """
    rows = rows.withColumn("_measure", measure)
    if sizes.largest <= split_rows:
        return _attach_by_merge(_window_totals(rows, group, order), attach, group)

    hot = sizes.frame.where(F.col("n") > split_rows).select(*group, "n")
    hot_rows = hot.agg(F.sum("n")).first()[0]
    if not hot_rows:
        return _attach_by_merge(_window_totals(rows, group, order), attach, group)
    # There are at most rows / split_rows of them: their list is mostly small enough for adaptive
    # execution to send to every task, and otherwise a merge join whose hot keys it splits.
    hot_groups = hot.select(*group)
    parts = max(2, math.ceil(hot_rows / split_rows))
    common = rows.join(hot_groups, group, "left_anti")
    split = rows.join(hot_groups, group, "left_semi")
    small = _attach_by_merge(_window_totals(common, group, order), attach, group)
    large = _piecewise_totals(split, group, order, parts)
    if attach is not None:
        few = attach.join(hot_groups, group, "left_semi")
        large = large.join(few, group, "left")
    return small.unionByName(large)


def _attach_by_merge(totals: DataFrame, attach: DataFrame | None, group: list[str]) -> DataFrame:
    """The window leaves rows hashed and sorted by the group: a merge join moves only ``attach``."""
    return totals if attach is None else totals.join(attach.hint("merge"), group, "left")


def _window_totals(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    so_far = (
        Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("run_n", F.count(F.lit(1)).over(so_far))
        .withColumn("run_s", F.sum("_measure").over(so_far))
        .drop("_measure")
    )


def pieces(rows: DataFrame, by: list[str], parts: int) -> DataFrame:
    """Cut rows into ``parts`` consecutive pieces of about equal size in the order ``by``.

    The bounds are sampled and the piece number is a task number, so the result is written once;
    reading it again, or losing an executor, cannot move a row to another piece.
    """
    return materialize(
        rows.repartitionByRange(parts, *by).withColumn("_piece", F.spark_partition_id()), "pieces"
    )


def _piecewise_totals(rows: DataFrame, group: list[str], order: list[str], parts: int) -> DataFrame:
    cut = pieces(rows, [*group, *order], parts)
    earlier = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per piece and one more per group that starts inside a piece.
    carried = (
        cut.groupBy(*group, "_piece")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_measure").alias("_s"))
        .select(
            *group,
            "_piece",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"),
            F.sum("_s").over(earlier).alias("_s"),
        )
    )
    inside = _window_totals(cut, [*group, "_piece"], order)
    kind = inside.schema["run_s"].dataType
    return (
        inside.join(carried, [*group, "_piece"])
        .withColumn("run_n", F.col("run_n") + F.col("_n"))
        .withColumn("run_s", _null_safe_sum(F.col("run_s"), F.col("_s")).cast(kind))
        .drop("_piece", "_n", "_s")
    )


def _null_safe_sum(left: Column, right: Column) -> Column:
    """Sum that is null only if both sides are, as SQL's SUM over both would be."""
    return F.when(left.isNotNull() & right.isNotNull(), left + right).otherwise(F.coalesce(left, right))
