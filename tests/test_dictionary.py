"""Label dictionaries and sparse features against Spark ML and brute force."""

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from prepfold.operators import dictionary as d


def test_same_ids_as_string_indexer(spark):
    rows = [(x,) for k, x in enumerate(["b", "a", "A", "é", "", "a.b", "z z", "ab"]) for _ in range(1 + k % 3)] + [(None,)]
    df = spark.createDataFrame(rows, "c string")
    got = {r.label: r.label_id for r in d.label_dictionary(df, "c").collect()}
    labels = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(df).labels
    assert got == {x: k for k, x in enumerate(labels)}


def test_a_million_labels_without_a_collect(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    n = 1_000_000
    df = spark.range(n).select((F.col("id") * 7).alias("c")).union(spark.range(n // 2).select((F.col("id") * 7).alias("c")))
    for name in ("collect", "toArrow", "toPandas", "first", "take", "count"):
        monkeypatch.setattr(DataFrame, name, lambda *a, **k: pytest.fail("came to the driver"))
    ids = d.label_dictionary(df, "c", 16)
    wrong = ids.where((F.col("label_id") != F.col("label") / 7)
                      | (F.col("n_rows") != F.when(F.col("label") < 7 * (n // 2), 2).otherwise(1)))
    sums = ids.agg(F.count("*").alias("n"), F.max("label_id").alias("top"))
    monkeypatch.undo()
    assert wrong.count() == 0
    assert tuple(sums.first()) == (n, n - 1)


def test_hot_labels_stay_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(d, "HEAD", 2)
    rows = [(k, "hot" if k % 3 else f"r{k % 7}") for k in range(200)] + [(900, None), (901, "unseen")]
    df = spark.createDataFrame(rows, "id long, `a.b` string")
    ids = d.label_dictionary(df.where("id < 900"), "a.b")
    of = {r.label: r.label_id for r in ids.collect()}
    got = {r[0]: r[2] for r in d.index_labels(df, "a.b", "at", ids).collect()}
    assert got == {k: of.get(x, len(of)) for k, x in rows}
    kept = {r[0]: r[2] for r in d.index_labels(df, "a.b", "at", ids, "skip").collect()}
    assert kept == {k: of[x] for k, x in rows if x in of}
    with pytest.raises(ValueError):
        d.index_labels(df, "a.b", "at", ids, "error")


def test_sparse_rows(spark):
    rows = [(1, ["A", "a", "a"]), (2, None), (3, []), (4, [None, "a.b"]), (5, ["new"]), (None, ["a"])]
    df = spark.createDataFrame(rows, "id long, l array<string>")
    known = spark.createDataFrame([("a",), ("a",), ("A",), ("a.b",), ("a.b",), ("a.b",)], "t string")
    out = d.sparse_multi_hot(df, "id", "l", d.label_dictionary(known, "t"))
    assert {r.id: r.indices for r in out.collect()} == {1: [1, 2], 2: [], 3: [], 4: [0], 5: [], None: []}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, c string")
    ids = d.label_dictionary(none, "c")
    assert ids.count() == 0 and d.index_labels(none, "c", "at", ids).count() == 0
    one = spark.createDataFrame([(1, "x")], "id long, c string")
    assert d.index_labels(one, "c", "at", ids).first().at == 0
