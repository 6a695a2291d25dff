"""Intermediate tables in the folder that the driver and the executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a session without executors of its own may lack it, and gets a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        where = f"file://{tempfile.mkdtemp(prefix='gristmill-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, name: str = "t") -> DataFrame:
    """`df`, written once and read from there on: its plan ends here, and a lost executor costs no recomputation."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def storing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """`stored` for tables that go at the end; what leaves must not depend on them."""
    paths: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        out = stored(df)
        paths.extend({f.rsplit("/", 1)[0] for f in out.inputFiles()})
        return out

    try:
        yield keep
    finally:
        for path in paths:
            delete(spark, path)
