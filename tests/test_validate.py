from pyspark.sql import functions as F

from prepfold.operators import validate


def test_check_load_pass_and_fail(spark):
    df = spark.range(5).withColumn("x", F.lit(1))
    assert validate.check_load_message(df, 5, 2) == "Validation Passed"
    assert validate.check_load_message(df, 4, 2) == "Validation Failed"
    assert validate.check_load_message(df, 5, 3) == "Validation Failed"
    row = validate.check_load(df, 5, 2).first()
    assert (row.expected_records, row.actual_records, row.actual_columns) == (5, 5, 2)


def test_check_load_empty_frame(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert validate.check_load_message(df, 0, 2) == "Validation Passed"


def test_check_dtypes_reports_all_cases(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "a int, b string, c double")
    rep = {r.column_name: r.status for r in
           validate.check_dtypes(df, {"a": "int", "b": "int", "z": "date"}).collect()}
    assert rep == {"a": "expected", "b": "mismatch", "c": "unchecked", "z": "missing"}


def test_summary_stats_typed(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 4.0), (5, None)], "a int, b double")
    rows = {r.column_name: r for r in validate.summary_stats(df, ["a", "b"]).collect()}
    assert rows["a"]["count"] == 3 and rows["a"]["mean"] == 3.0 and rows["a"]["stddev"] == 2.0
    assert rows["b"]["count"] == 2 and rows["b"]["min"] == 2.0 and rows["b"]["max"] == 4.0


def test_shape_and_conditional_counts(spark):
    df = spark.range(10)
    shapes = {r.stage: (r.n_rows, r.n_columns) for r in
              validate.shape_report({"all": df, "even": df.where("id % 2 = 0")}).collect()}
    assert shapes == {"all": (10, 1), "even": (5, 1)}
    row = validate.conditional_counts(df, {"big": F.col("id") > 6, "null": F.col("id").isNull()}).first()
    assert (row.n_rows, row.big, row.null) == (10, 3, 0)


def test_preview_is_ordered(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in validate.preview(df, 5, ["id"]).collect()] == [0, 1, 2, 3, 4]


def test_sizing_conf_for_100_tb():
    from prepfold.session import sizing_conf
    conf = sizing_conf(100 * (1 << 40), total_cores=4000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600  # 100 TiB / 256 MiB
    assert sizing_conf(1 << 30, total_cores=64)["spark.sql.shuffle.partitions"] == "128"


class _StubConf:
    def __init__(self, value=None):
        self.value = value

    def get(self, key, default=None):
        return self.value if self.value is not None else default


class _StubContext:
    def __init__(self, master, value=None):
        self.master, self._conf, self.dir = master, _StubConf(value), None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = "file:" + path


class _StubSession:
    def __init__(self, master, value=None):
        self.conf, self.sparkContext = _StubConf(value), _StubContext(master, value)


def test_checkpoint_dir_fallbacks():
    import pytest

    from prepfold.session import ensure_checkpoint_dir
    named = _StubSession("yarn", "hdfs:///shared/ckpt")
    assert ensure_checkpoint_dir(named) == "hdfs:///shared/ckpt"
    assert named.sparkContext.dir == "file:hdfs:///shared/ckpt"
    local = _StubSession("local[4]")
    path = ensure_checkpoint_dir(local)
    assert path.startswith("file:") and ensure_checkpoint_dir(local) == path
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_StubSession("yarn"))
