"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    path = scratch_path(df.sparkSession, "step")
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._step = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables of :func:`materialise` that nothing will read again; other frames are left alone."""
    for df in frames:
        path = df.__dict__.pop("_step", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def is_held_out(doc_id: Column, folds: int = 5) -> Column:
    """True where crc32 of the id as text leaves no remainder (null: as '')."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive [start, stop) runs of at most ``limit`` summed size.

    A single larger element is a run of its own, so work memory is bounded by
    the limit or by the largest element.
    """
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


class Shared:
    """A broadcast object that tasks load without an installed package."""

    def __init__(self, spark: SparkSession, value):
        self._packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._value = None

    def __getstate__(self):
        return {"_packed": self._packed, "_value": None}

    @property
    def value(self):
        if self._value is None:
            self._value = cloudpickle.loads(self._packed.value)
        return self._value
