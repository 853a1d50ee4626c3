"""Exact percentiles of groups of any size.

Spark's own percentile() holds a group's different values in one task. Here values are counted by bands of a function
that only rises with the value; the counts of bands, a few thousand a group, tell in which bands the wanted ranks lie,
and only the values of those bands are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BANDS = 64  # for each factor of e in size


def _band(value: Column) -> Column:
    """Rises with the value: by sign and logarithm of the size."""
    size = F.floor(F.log1p(F.abs(value)) * BANDS).cast("long")
    return F.when(value < 0, -size - 1).otherwise(size)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """keys and a column for each wanted percentile (name -> 0 to 1), linearly interpolated between ranks, as percentile() gives.

    Null values do not count; a group of nulls alone is left out. Infinite values and NaN count as the largest.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v")).withColumn("_band", F.coalesce(_band(F.col("_v")), F.lit((1 << 62))))
    counted = rows.groupBy(*keys, "_band", "_v").agg(F.count("*").alias("_n"))
    bands = counted.groupBy(*keys, "_band").agg(F.sum("_n").alias("_in"))
    by_key = Window.partitionBy(*keys)
    bands = bands.withColumn("_before", F.coalesce(F.sum("_in").over(by_key.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_all", F.sum("_in").over(by_key))
    ranks = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(upper).alias("upper"), (F.floor if not upper else F.ceil)((F.col("_all") - 1) * q).alias("rank"), ((F.col("_all") - 1) * q).alias("at")) for name, q in wanted.items() for upper in (False, True)))
    sought = bands.withColumn("_r", F.explode(ranks)).where((F.col("_r.rank") >= F.col("_before")) & (F.col("_r.rank") < F.col("_before") + F.col("_in"))).select(*keys, "_band", "_before", "_r")
    inside = counted.join(sought.select(*keys, "_band").distinct(), [*keys, "_band"], "left_semi")
    placed = inside.withColumn("_low", F.coalesce(F.sum("_n").over(Window.partitionBy(*keys, "_band").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    hit = placed.join(sought, [*keys, "_band"]).where((F.col("_r.rank") - F.col("_before") >= F.col("_low")) & (F.col("_r.rank") - F.col("_before") < F.col("_low") + F.col("_n")))
    pick = lambda name, upper: F.max(F.when((F.col("_r.name") == name) & (F.col("_r.upper") == upper), F.col("_v")))
    share = lambda name: F.max(F.when(F.col("_r.name") == name, F.col("_r.at") - F.floor("_r.at")))
    between = lambda n: F.when(pick(n, True) == pick(n, False), pick(n, False)).otherwise(pick(n, False) + (pick(n, True) - pick(n, False)) * share(n))
    return hit.groupBy(*keys).agg(*(between(n).alias(n) for n in wanted))
