"""NaN counts as missing in filters, scales and histograms."""

import math

import pytest

from prepfold.operators import clean, profile, scale

NAN = float("nan")


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, 1.0), (2, 2.0), (3, NAN), (4, None), (5, 5.0)], "id int, x double")


def test_sigma_filter(df):
    assert {r.id for r in clean.sigma_filter(df, "x").collect()} == {1, 2, 5}
    assert clean.sigma_filter(df.where("id in (1, 3)"), "x", keep_if_constant=True).count() == 0


def test_scales(df):
    assert {r.id: r.scaled_x for r in scale.min_max_scale(df, ["x"]).collect()} == \
        {1: 0.0, 2: 0.25, 3: None, 4: None, 5: 1.0}
    assert {r.id: r.p for r in scale.percent_scale(df, "x", "p").collect()} == \
        {1: 0.0, 2: 25.0, 3: None, 4: None, 5: 100.0}
    got = {r.id: (r.r, r.o) for r in scale.reflect_log(df, "x", "r", "o").collect()}
    assert got[3] == (None, None) and got[5] == (1.0, None) and got[1] == (5.0, pytest.approx(1 / math.log(5)))


def test_histogram(df):
    got = [tuple(r) for r in profile.histogram(df, "x", 4).orderBy("bin").collect()]
    assert got == [(0, 1.0, 2.0, 1), (1, 2.0, 3.0, 1), (3, 4.0, 5.0, 1)]
