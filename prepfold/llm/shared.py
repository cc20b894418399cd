"""Helpers the operators share: table access, written tables, byte text."""

from __future__ import annotations

import os
import pickle

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.stats import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of ``sf_dir``; Spark opens the path, so any file
    system it knows will do."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, written once and read back.

    A task lost with its executor re-reads files instead of replaying what
    made them, and both sides of a later join are plain exchanges, which AQE
    can split where a key is hot.
    """
    return cut_lineage(df)


class Shared:
    """A broadcast of any object. Broadcasts are pickled by reference, so
    objects of this package's classes would need the package on executors;
    here their bytes are sent, with the classes in them."""

    def __init__(self, spark: SparkSession, value):
        self.bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self.bytes.value)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores behind it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def mapped(docs: DataFrame, run, added: list[T.StructField] = ()) -> DataFrame:
    """``docs.mapInArrow(run)`` whose batches have the columns of ``docs`` and
    the added ones, by position, whatever the names (dots, equal names)."""
    fields = [*docs.schema.fields, *added]
    plain = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(fields)]

    def named(batches):
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=[f.name for f in plain])

    own = docs.toDF(*[f.name for f in plain[:len(docs.columns)]])
    return own.mapInArrow(named, T.StructType(plain)).toDF(*[f.name for f in fields])


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def texts(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null reads as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b if b is not None else b"" for b in column.cast(kind).to_pylist()]
