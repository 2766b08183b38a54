"""Exact percentiles of large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def percentiles(rows: DataFrame, group: str, value: str, shares: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """(group, n, a column per share): percentiles with linear interpolation, exact for groups of any size.

    A bounded sketch first gives bounds that surely enclose each percentile;
    rows outside are only counted, and only the few between them, as counts
    per value, are put in order.  Null values are left out.
    """
    slack = 2.0 / accuracy
    rows = rows.where(F.col(value).isNotNull()).select(group, value)
    near = lambda sign: F.percentile_approx(value, [min(1.0, max(0.0, q + sign * slack)) for q in shares.values()], accuracy)
    bounds = rows.groupBy(group).agg(F.count("*").alias("n"), near(-1).alias("low"), near(1).alias("high"))
    wanted = bounds.select(group, "n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), (F.lit(q) * (F.col("n") - 1)).alias("at"), F.col("low")[i].alias("low"), F.col("high")[i].alias("high")) for i, (name, q) in enumerate(shares.items())
    ])).alias("w")).select(group, "n", "w.*")
    side = F.when(F.col(value) < F.col("low"), -1).when(F.col(value) > F.col("high"), 1).otherwise(0)
    # Counts per value combine before the shuffle; what lies below or above is one row each, with the value next to the bounds.
    counted = rows.join(F.broadcast(wanted), group) if bounds_are_few(bounds) else rows.join(wanted, group)
    counted = counted.withColumn("side", side).groupBy(group, "name", "n", "at", "side", F.when(F.col("side") == 0, F.col(value)).alias("v")).agg(
        F.count("*").alias("k"), F.max(value).alias("most"), F.min(value).alias("least")
    ).withColumn("v", F.when(F.col("side") < 0, F.col("most")).otherwise(F.col("least")))
    placed = counted.withColumn("end", F.sum("k").over(Window.partitionBy(group, "name").orderBy("v")))
    first, second = F.floor("at"), F.ceil("at")
    pick = lambda at: F.max(F.when((F.col("end") > at) & (F.col("end") - F.col("k") <= at), F.col("v")))
    found = placed.groupBy(group, "name", "n", "at").agg(pick(first).alias("a"), pick(second).alias("b"))
    found = found.withColumn("p", F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at")))
    return found.groupBy(group, "n").agg(*[F.max(F.when(F.col("name") == name, F.col("p"))).alias(name) for name in shares])


def bounds_are_few(bounds: DataFrame, most: int = 10_000) -> bool:
    """Whether there are so few groups that their bounds can be sent to every task; at most ``most`` + 1 are counted."""
    return bounds.limit(most + 1).count() <= most
