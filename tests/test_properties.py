"""Property tests (hypothesis) over small generated frames."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from prepfold.operators import features, scale
from prepfold.plans import quantiles

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), finite)), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.1, 0.5, 0.77, 1.0]))
def test_exact_quantile_equals_numpy(spark, rows, q):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.quantile for r in quantiles.exact_quantile(df, "v", q, ["g"]).collect()}
    for g in {k for k, _ in rows}:
        vals = [v for k, v in rows if k == g and v is not None]
        if not vals:
            assert got[g] is None
        else:
            assert got[g] == pytest.approx(float(np.quantile(np.array(vals), q)), rel=1e-9, abs=1e-6)


@SETTINGS
@given(st.lists(st.one_of(st.none(), finite), min_size=1, max_size=40))
def test_min_max_scaled_in_unit_interval(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = [r.scaled_x for r in scale.min_max_scale(df, ["x"]).collect()]
    present = [v for v in vals if v is not None]
    for v, s in zip(vals, out):
        if v is None or max(present) == min(present):
            assert s is None
        else:
            assert -1e-12 <= s <= 1 + 1e-12


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "c", "d"]), max_size=5)),
                min_size=1, max_size=30))
def test_multi_hot_row_sum_is_distinct_token_count(spark, lists):
    text = [None if t is None else ", ".join(t) for t in lists]
    df = spark.createDataFrame(list(enumerate(text)), "no int, g string")
    lst = features.split_list(df, "g", ", ", "lst")
    out = features.multi_hot(lst, "lst", ["a", "b", "c", "d"]).orderBy("no").collect()
    for r, t in zip(out, lists):
        assert r.a + r.b + r.c + r.d == (len(set(t)) if t else 0)
