"""Positions in an order, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipfold.plans.cut import cut
from clipfold.plans.small import join_small


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str = "posto") -> DataFrame:
    """``df`` with each row's position from 1 within its group.

    One range sort by group and order spreads a hot group over as many tasks as it needs. A row's position is its place in
    its task plus the group's rows in the tasks before, of which there is one count a task and group.
    """
    n = len(df.columns)
    keys = [f"__g{k}" for k in range(len(by))]
    ordered = df.withColumns(dict(zip(keys, (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by)))).orderBy(*keys, *order)
    placed = cut(ordered.withColumn("__at", F.monotonically_increasing_id()).withColumn("__task", F.shiftright("__at", 33)), "ranked")
    counts = placed.groupBy(*keys, "__task").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    if keys:
        before = Window.partitionBy(*keys).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    else:
        before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    joined = join_small(placed, offsets, [*keys, "__task"])
    return joined.select(*df.columns[:n], (F.col("__at") - F.col("__first") + F.col("__before") + 1).cast("bigint").alias(name))
