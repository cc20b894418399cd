"""Merged states equal those of the whole table."""

import pytest

from prepfold.operators import clean, scale
from prepfold.operators import mergeable as m

NAN = float("nan")


@pytest.fixture(scope="module")
def df(spark):
    rows = [(k % 5, float((k * 37) % 101) + 1e6, float((k * k) % 53)) for k in range(400)]
    rows += [(0, None, 3.0), (1, NAN, 4.0), (2, float("inf"), 5.0), (7, None, None), (None, 1e6, 2.0), (9, 1e6 + 50, NAN)]
    return spark.createDataFrame(rows, "file int, x double, `y.z` double")


def numbers(state):
    return {(r.column_name, r.other_name): tuple(r)[2:] for r in m.state_statistics(state).collect()}


def near(got, want):
    assert set(got) == set(want)
    for k in want:
        for a, b in zip(got[k], want[k]):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-6, abs=1e-9))


@pytest.fixture(scope="module")
def plain(df):
    return df.withColumnRenamed("y.z", "y")


def test_merged_equals_whole(plain):
    whole = m.moment_state(plain, ["x", "y"], [("x", "y")])
    parts = m.moment_state(plain, ["x", "y"], [("x", "y")], by=["file"])
    merged = m.merge_states(parts.drop("file"))
    near(numbers(merged), numbers(whole))
    # in two steps, and onto itself
    days = [m.merge_states(parts.where(w).drop("file")) for w in ("file < 3", "file >= 3 or file is null")]
    near(numbers(m.merge_states(days[0].unionByName(days[1]))), numbers(whole))
    near(numbers(m.merge_states(merged)), numbers(whole))


def test_against_spark(plain):
    from pyspark.sql import functions as F
    good = plain.where("x < double('infinity') and not isnan(x)")
    r = good.agg(F.count("x"), F.avg("x"), F.stddev_samp("x"), F.skewness("x"), F.min("x"), F.max("x")).first()
    got = numbers(m.merge_states(m.moment_state(plain, ["x"], by=["file"]).drop("file")))["x", ""]
    assert got[:6] == (r[0], *[pytest.approx(v, rel=1e-6) for v in tuple(r)[1:]])
    both = good.where("y is not null and not isnan(y)")
    got = numbers(m.merge_states(m.moment_state(plain, [], [("x", "y")], by=["file"]).drop("file")))["x", "y"]
    assert got[6] == pytest.approx(both.corr("x", "y"), rel=1e-6)


def test_groups_stay_apart_and_null_is_a_group(plain):
    parts = m.moment_state(plain, ["x"], by=["file"])
    again = m.merge_states(parts.unionByName(parts.limit(0)), by=["file"])
    assert again.count() == parts.count() == 8
    assert [r.n for r in again.where("file is null").collect()] == [1]
    assert [(r.n, r["mean"], r["min"]) for r in again.where("file = 7").collect()] == [(0, None, None)]


def test_empty_table(plain):
    state = m.moment_state(plain.limit(0), ["x"])
    assert [(r.n, r["mean"], r.m2) for r in state.collect()] == [(0, None, None)]
    assert numbers(m.merge_states(state))["x", ""] == (0,) + (None,) * 7


def test_filter_and_scale_by_state(plain):
    good = plain.where("x < double('infinity') and not isnan(x)")
    state = m.merge_states(m.moment_state(good, ["x", "y"], by=["file"]).drop("file"))
    assert (sorted(m.sigma_filter_by_state(good, state, "x", 1.0).select("x").collect())
            == sorted(clean.sigma_filter(good, "x", 1.0).select("x").collect()))
    assert (sorted(m.min_max_scale_by_state(good, state, ["x"]).select("scaled_x").collect())
            == sorted(scale.min_max_scale(good, ["x"]).select("scaled_x").collect()))
    with pytest.raises(Exception, match="(?i)scalar"):
        parts = m.moment_state(good, ["x"], by=["file"]).drop("file")
        m.sigma_filter_by_state(good, parts, "x").collect()
