"""Places in a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketide.llm.tables import kept


def along(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` range-partitioned by ``order``, with their part and place (row number within the part).

    The rows are sampled for the ranges, so they should be a table and not a long plan.
    Ties beyond ``order`` are in no defined order, but keep the one they got here.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    numbered = placed.withColumn("at", at)
    return kept(
        numbered.withColumn("part", F.shiftrightunsigned("at", 33).cast("int"))
        .withColumn("place", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at")
    )


def positions(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with position (from 0, by ``order`` within ``group``) and size (rows of the group).

    ``group`` has no nulls. A group may hold any share of the rows: what is joined are
    counts per group and part, and a group's own window runs over its parts alone.
    """
    placed = along(rows, group, *order)
    runs = placed.groupBy(group, "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        group, "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("size"),
    )
    joined = placed.join(starts, [group, "part"])
    return joined.withColumn("position", F.col("place") + F.col("shift")).drop("part", "place", "shift")
