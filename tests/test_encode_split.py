import datetime as dt

import pytest

from prepfold.operators import encode, split


def test_weekend_binarizer(spark):
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8)]  # Fri..Mon
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = encode.weekend_flag(df, "d", "dow", "weekend").orderBy("d").collect()
    assert [(r.dow, r.weekend) for r in out] == [(5.0, 0.0), (6.0, 1.0), (7.0, 1.0), (1.0, 0.0)]


def test_bucketizer_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (5.5,), (9.0,), (None,)], "BEDROOMS double")
    out = encode.bucketize(df, "BEDROOMS", [0, 1, 2, 3, 4, 5, float("inf")], "bedroom_bucket").collect()
    assert [r.bedroom_bucket for r in out] == [0.0, 1.0, 5.0, 5.0, 5.0, None]
    with pytest.raises(ValueError):
        encode.bucketize(df, "BEDROOMS", [0, 1, float("inf")], "bedrooms")


def test_string_index_ties_and_null_keep(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "s string")
    out, _ = encode.index_categoricals(df, ["s"], drop_originals=False)
    got = {r.s: r.s_IDX for r in out.collect()}
    assert got == {"b": 0.0, "a": 1.0, "c": 2.0, None: 3.0}
    staged, _ = encode.index_categoricals(df, ["s"], drop_originals=True, as_stages=True)
    assert staged.columns == ["s_IDX"]


def test_one_hot_drops_last(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "s string")
    idx, _ = encode.string_index(df, "s", "i")
    oh, _ = encode.one_hot(idx, "i", "v")
    got = {r.s: list(r.arr) for r in oh.select("s", encode.as_array("v").alias("arr")).collect()}
    assert got == {"b": [1.0, 0.0], "a": [0.0, 1.0], "c": [0.0, 0.0]}


def test_assemble_null_raises_unless_imputed(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        encode.assemble(df, ["a", "b"]).collect()
    assert encode.assemble(df.fillna(-1), ["a", "b"]).first().features.toArray().tolist() == [1.0, -1.0]


def test_time_split_boundaries(spark):
    s = dt.date(2020, 6, 1)
    rows = [(1, dt.date(2020, 1, 1), dt.date(2020, 5, 31)),   # ends before: train
            (2, dt.date(2020, 1, 1), s),                      # ends on split: test
            (3, s, dt.date(2020, 7, 1)),                      # starts on split: test
            (4, dt.date(2020, 6, 2), dt.date(2020, 7, 1))]    # starts after: neither
    df = spark.createDataFrame(rows, "id int, start date, end date")
    lab = {r.id: r.split for r in split.label_split(df, "start", "end", s).collect()}
    assert lab == {1: "train", 2: "test", 3: "test", 4: "neither"}
    train, test = split.train_test(df, "start", "end", s)
    assert {r.id for r in train.collect()}.isdisjoint({r.id for r in test.collect()})


def test_split_date_and_as_of(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2020, 3, 1), 60)], "l date, o date, days int")
    assert split.split_date(df, "o", 45).first().split_date == dt.date(2020, 1, 16)
    assert split.pct_split_date(df, "o", 0.5).first().split_date == dt.date(2020, 3, 1)
    out = split.as_of_days(df, "l", "days", dt.date(2020, 1, 11)).first()
    assert (out.days_Original, out.days) == (60, 10)
