"""Joins on keys that agree within a tolerance.

Rounding both sides parts keys that lie close to each other on the two sides
of a rounding border. Here the keys are laid on a grid of cells a few
tolerances wide. A left point lies in one cell; a lookup point goes to each
cell that the box of its tolerance touches, so that an equi join on cells
meets every near pair exactly once. The distance decides, and of a left
point's near lookup points the nearest stays.

Equal points are collapsed on both sides before they meet, so a point that a
third of all rows share takes part once; pairs of a cell stream into a
map-side combined minimum and are never written. What remains is as dense as
the distinct points are within a tolerance of each other.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Width of a cell in tolerances: wider cells copy fewer lookup points and compare more pairs.
CELL = 4.0


def _number(c: str) -> Column:
    """A key as a finite double, else NULL (which matches nothing)."""
    x = F.col(f"`{c}`").try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), x)


def tolerance_join(df: DataFrame, lookup: DataFrame, tolerance: Mapping[str, float], value_cols: Sequence[str],
                   order_cols: Sequence[str], exact_keys: Sequence[str] = (),
                   distance_col: str = "distance") -> DataFrame:
    """``df`` with the ``value_cols`` of the nearest lookup row, and its distance.

    ``tolerance`` maps each key that may differ to how much it may; the
    distance is Euclid's of the differences in tolerances, at most 1.
    ``exact_keys`` must be equal. Ties go to the first by ``order_cols``, which
    should tell lookup rows apart. Every left row comes back once; with a NULL,
    NaN or infinite key, or nothing near, its values are NULL. Names of ``df``
    must not begin with two underscores.
    """
    near, exact = list(tolerance), list(exact_keys)
    if any(not t > 0 for t in tolerance.values()):
        raise ValueError("tolerances are greater than zero")
    k, e = [f"__k{i}" for i in range(len(near))], [f"__e{i}" for i in range(len(exact))]
    cells = [f"__c{i}" for i in range(len(near))]
    scaled = [_number(c) / F.lit(float(tolerance[c])) for c in near]

    left = df.withColumns({n: x for n, x in zip(k, scaled)} | {n: F.col(f"`{c}`") for n, c in zip(e, exact)})
    points = left.select(*k, *e).where(" and ".join(f"{n} is not null" for n in k + e)).distinct()
    points = points.withColumns({c: F.floor(F.col(n) / CELL) for c, n in zip(cells, k)})

    right = lookup.select(
        *[x.alias(n + "r") for n, x in zip(k, scaled)],
        *[F.col(f"`{c}`").try_cast(dict(df.dtypes)[c]).alias(n) for n, c in zip(e, exact)],
        F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order_cols)]).alias("__order"),
        F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(value_cols)]).alias("__value"))
    right = right.where(" and ".join([f"{n}r is not null" for n in k] + [f"{n} is not null" for n in e]))
    right = right.groupBy(*[n + "r" for n in k], *e).agg(
        F.min_by("__value", "__order").alias("__value"), F.min("__order").alias("__order"))
    for c, n in zip(cells, k):
        # a hair wider than the tolerance, so that no rounding of the division loses a cell
        reach = F.lit(1.0 + 1e-9)
        right = right.withColumn(c, F.explode(F.sequence(F.floor((F.col(n + "r") - reach) / CELL),
                                                         F.floor((F.col(n + "r") + reach) / CELL))))
    apart = None
    for n in k:
        step = (F.col(n) - F.col(n + "r")) * (F.col(n) - F.col(n + "r"))
        apart = step if apart is None else apart + step
    pairs = points.join(right, cells + e).withColumn("__d", F.sqrt(apart)).where("__d <= 1.0")
    found = pairs.groupBy(*k, *e).agg(
        F.min("__d").alias("__d"), F.min_by("__value", F.struct("__d", "__order")).alias("__value"))
    out = left.join(found, k + e, "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[F.col("__value").getField(f"v{i}").alias(c) for i, c in enumerate(value_cols)],
                      F.col("__d").alias(distance_col))


def _on_sphere(df: DataFrame, lon: str, lat: str) -> DataFrame:
    x, y = F.radians(_number(lon)), F.radians(_number(lat))
    return df.withColumns({"__x": F.cos(y) * F.cos(x), "__y": F.cos(y) * F.sin(x), "__z": F.sin(y)})


def sphere_join(df: DataFrame, lookup: DataFrame, lon: str, lat: str, degrees: float, value_cols: Sequence[str],
                order_cols: Sequence[str], exact_keys: Sequence[str] = (),
                distance_col: str = "degrees_apart") -> DataFrame:
    """``tolerance_join`` of longitudes and latitudes in degrees by the arc
    between them, at most ``degrees``. Points are compared as unit vectors, so
    the date line and the poles, where all longitudes meet, are no border."""
    if not 0 < degrees < 180:
        raise ValueError("degrees lie between 0 and 180")
    chord = 2 * math.sin(math.radians(degrees) / 2)
    out = tolerance_join(_on_sphere(df, lon, lat), _on_sphere(lookup, lon, lat), {"__x": chord, "__y": chord, "__z": chord},
                         value_cols, order_cols, exact_keys, "__apart").drop("__x", "__y", "__z")
    half = F.when(F.col("__apart").isNotNull(), F.least(F.col("__apart") * F.lit(chord / 2), F.lit(1.0)))
    return out.withColumn(distance_col, F.degrees(2 * F.asin(half))).drop("__apart")
