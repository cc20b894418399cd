"""Joins within a tolerance against brute force, with border and pole rows."""

import math
import random

import pytest

from prepfold.operators.tolerance import sphere_join, tolerance_join

NAN = float("nan")


def test_equals_brute_force(spark):
    rng = random.Random(3)
    step = lambda: rng.randrange(400) / 64  # exact in binary: plenty of ties and of points on cell borders
    left = [(i, rng.choice("ab"), step(), -step()) for i in range(400)]
    right = [(i, rng.choice("ab"), step(), -step(), f"v{i}") for i in range(300)]
    df = spark.createDataFrame(left, "id long, g string, x double, y double").repartition(5)
    lookup = spark.createDataFrame(right, "lid long, g string, x double, y double, v string").repartition(3)
    got = {r.id: (r.v, r.distance) for r in
           tolerance_join(df, lookup, {"x": 0.5, "y": 0.25}, ["v"], ["lid"], ["g"]).collect()}
    want = {}
    for i, g, x, y in left:
        near = [(d, k, v) for k, h, a, b, v in right
                if h == g and (d := math.sqrt((x / 0.5 - a / 0.5) ** 2 + (y / 0.25 - b / 0.25) ** 2)) <= 1]
        want[i] = (min(near)[2], min(near)[0]) if near else (None, None)
    assert got == want
    assert sum(v is None for v, _ in want.values()) not in (0, len(left))


def test_keys_across_a_rounding_border(spark):
    df = spark.createDataFrame([(1, 0.4999999), (2, -1e-7), (3, 4.0), (4, None), (5, NAN), (6, 9.0), (6, 9.0)], "id int, x double")
    lookup = spark.createDataFrame([("half", 0.5000001), ("zero", 1e-7), ("four", 3.9999995), ("none", None),
                                    ("nan", NAN), ("nine", 9.0), ("also", 9.0)], "v string, x double")
    rows = tolerance_join(df, lookup, {"x": 1e-6}, ["v"], ["v"]).collect()
    assert sorted((r.id, r.v) for r in rows if r.v) == [(1, "half"), (2, "zero"), (3, "four"), (6, "also"), (6, "also")]
    assert sorted(r.id for r in rows if r.v is None and r.distance is None) == [4, 5]


def test_text_keys_extra_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "2.5", "x"), (2, "bad", "y")], "id int, `k.1` string, distance_note string")
    lookup = spark.createDataFrame([(7, 2.5000001)], "v int, `k.1` double")
    got = sorted(tuple(r) for r in tolerance_join(df, lookup, {"k.1": 1e-5}, ["v"], ["v"]).collect())
    assert [r[:4] for r in got] == [(1, "2.5", "x", 7), (2, "bad", "y", None)]
    assert tolerance_join(df.limit(0), lookup, {"k.1": 1e-5}, ["v"], ["v"]).count() == 0
    assert [r.v for r in tolerance_join(df, lookup.limit(0), {"k.1": 1e-5}, ["v"], ["v"]).collect()] == [None, None]
    with pytest.raises(ValueError):
        tolerance_join(df, lookup, {"k.1": 0.0}, ["v"], ["v"])


def test_date_line_and_poles(spark):
    df = spark.createDataFrame([("line", 179.9999, 10.0), ("north", 0.0, 89.99995), ("south", -90.0, -90.0),
                                ("far", 0.0, 10.0)], "id string, lon double, lat double")
    lookup = spark.createDataFrame([("L", -179.9999, 10.0), ("N", 180.0, 89.99995), ("S", 37.0, -90.0),
                                    ("F", 0.001, 10.0)], "v string, lon double, lat double")
    got = {r.id: (r.v, r.degrees_apart) for r in sphere_join(df, lookup, "lon", "lat", 0.0005, ["v"], ["v"]).collect()}
    assert got["line"] == ("L", pytest.approx(0.0002 * math.cos(math.radians(10)), rel=1e-6))
    assert got["north"] == ("N", pytest.approx(0.0001, rel=1e-6))
    assert got["south"][0] == "S" and got["south"][1] == pytest.approx(0, abs=1e-9)
    assert got["far"] == (None, None)
