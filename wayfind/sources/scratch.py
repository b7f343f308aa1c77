"""Scratch tables: in the folder that driver and executors share, one folder per application; those of a step are deleted at its end, the rest on request."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir; where that is unset, below /tmp, and then on a single machine only."""
    own = f"wayfind-{spark.sparkContext.applicationId}"
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base}/{own}"
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"file:///tmp/checkpoints/{own}"


#: Paths of the tables written in the step that goes on, if one does.
_step: ContextVar[list[str] | None] = ContextVar("step", default=None)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str, codec: str = "snappy") -> tuple[DataFrame, str]:
    """Write df as a table in the shared folder and read it back: cuts lineage and outlives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    if (own := _step.get()) is not None:
        own.append(path)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def step(spark: SparkSession) -> Iterator[Callable[[str], None]]:
    """What materialise() writes within is deleted at the end, also after an error, but for the paths that the function it gives is told to keep: those that results read."""
    own: list[str] = []
    kept: set[str] = set()
    token = _step.set(own)
    try:
        yield kept.add
    finally:
        _step.reset(token)
        outer = _step.get()
        for path in own:
            if path not in kept:
                discard(spark, path)
            elif outer is not None:
                outer.append(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing will read again."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Delete all scratch tables of this application, once no result that reads them is needed."""
    discard(spark, shared_dir(spark))
