"""The density curve against a plain kernel estimate, and its edge rows."""

import math

import numpy as np
import pytest

from prepfold.operators.density import density_curve

NAN, INF = float("nan"), float("inf")


def frame(spark, values):
    return spark.createDataFrame([(x,) for x in values], "`a b` double")


def curve(df, **kw):
    return [(r.point, r.x, r.density) for r in density_curve(df, "a b", **kw).orderBy("point").collect()]


def test_near_the_plain_estimate(spark):
    values = np.random.default_rng(5).gamma(3.0, 2.0, 3000)
    got = curve(frame(spark, values.tolist()).repartition(7), points=256)
    h = values.std(ddof=1) * len(values) ** -0.2
    assert [p for p, _, _ in got] == list(range(256))
    assert got[0][1] == pytest.approx(values.min() - 3 * h) and got[-1][1] == pytest.approx(values.max() + 3 * h)
    for _, x, d in got:
        plain = np.exp(-((x - values) / h) ** 2 / 2).sum() / (len(values) * h * math.sqrt(2 * math.pi))
        assert d == pytest.approx(plain, abs=1e-3)
    step = got[1][1] - got[0][1]
    assert sum(d for _, _, d in got) * step == pytest.approx(1.0, abs=2e-3)


def test_missing_values_do_not_count(spark):
    plain = curve(frame(spark, [1.0, 2.0, 4.0]), points=9)
    assert curve(frame(spark, [1.0, None, 2.0, NAN, INF, -INF, 4.0]), points=9) == [
        (p, pytest.approx(x), pytest.approx(d)) for p, x, d in plain]


@pytest.mark.parametrize("values", [[], [None, NAN], [3.0], [3.0, 3.0, 3.0]])
def test_no_curve_without_a_spread(spark, values):
    assert curve(frame(spark, values)) == []


def test_a_given_bandwidth(spark):
    got = curve(frame(spark, [3.0, 3.0]), points=3, bandwidth=1.0)
    assert [(p, x) for p, x, _ in got] == [(0, 0.0), (1, 3.0), (2, 6.0)]
    assert got[1][2] == pytest.approx(1 / math.sqrt(2 * math.pi))
    with pytest.raises(ValueError):
        density_curve(frame(spark, [1.0]), "a b", points=1)
