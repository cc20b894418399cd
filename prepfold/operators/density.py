"""Density curve: the smooth line a distribution plot draws.

A Gaussian kernel estimate on a grid of ``points`` places. Values are binned
linearly: one between two grid points counts for both, more for the nearer.
That is one aggregation with at most ``points`` groups (combined in each
task), and the kernel is then summed over grid points, not over rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.stats import one_row, scalar_struct, without_nan

#: Bandwidths that the grid reaches beyond the smallest and the largest value.
CUT = 3.0


def density_curve(df: DataFrame, c: str, points: int = 128, bandwidth: float | None = None,
                  cut: float = CUT) -> DataFrame:
    """``(point, x, density)`` for ``point`` from 0 to ``points - 1``.

    The bandwidth is Scott's, ``stddev * n ** -0.2``, from the plan's own
    statistics, unless one is given. NULL, NaN and infinite values are not
    counted. Without a spread (no value, one value, all equal) there is no
    bandwidth, and unless one is given no curve: no rows.
    """
    if points < 2:
        raise ValueError("a curve needs two points")
    own = df.select(without_nan(df, f"{c}").cast("double").alias("x"))
    own = own.where(F.col("x").isNotNull() & (F.abs("x") < F.lit(math.inf)))
    moments = one_row(own, {"n": F.count("x").cast("double"), "sd": F.stddev_samp("x"), "lo": F.min("x"), "hi": F.max("x")})
    width = F.lit(float(bandwidth)) if bandwidth is not None else F.col("sd") * F.pow("n", F.lit(-0.2))
    grid = (moments.withColumn("bw", width).withColumn("start", F.col("lo") - cut * F.col("bw"))
            .withColumn("step", (F.col("hi") - F.col("lo") + 2 * cut * F.col("bw")) / F.lit(float(points - 1))))
    s = scalar_struct(grid)
    place = F.try_divide(F.col("x") - s["start"], s["step"])
    cell = F.least(F.floor(place), F.lit(points - 2))  # the largest value may round up to the last point
    cells = (own.where(s["bw"] > 0).select(cell.alias("j"), (place - cell).alias("part"))
             .groupBy("j").agg(F.count(F.lit(1)).alias("rows"), F.sum("part").alias("part")))
    weights = (cells.select(F.explode(F.array(
        F.struct(F.col("j").alias("j"), (F.col("rows") - F.col("part")).alias("w")),
        F.struct((F.col("j") + 1).alias("j"), F.col("part").alias("w")))).alias("s")).select("s.*")
        .groupBy("j").agg(F.sum("w").alias("w")))
    away = (F.col("point") - F.col("j")) * s["step"] / s["bw"]
    # At most points x points small rows: every grid point adds to every other.
    return (weights.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .groupBy("point").agg(F.sum(F.col("w") * F.exp(-away * away / 2)).alias("mass"))
            .select("point", (s["start"] + F.col("point") * s["step"]).alias("x"),
                    (F.col("mass") / (s["n"] * s["bw"] * F.lit(math.sqrt(2 * math.pi)))).alias("density")))
