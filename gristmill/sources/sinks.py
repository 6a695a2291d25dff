"""Sinks and write semantics (SNK-1 to SNK-13)."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import html_escape


def reload(df: DataFrame, path: str) -> None:
    """Replace a table as a whole (SNK-1, SNK-2)."""
    df.write.mode("overwrite").parquet(path)


class Versions:
    """A table as numbered versions in a folder, and a pointer to the one that holds (SNK-3 to SNK-6).

    A version is written whole before a pointer to it appears, by one rename that is checked; a failure anywhere
    leaves the older pointer, and so the older rows, as they were.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm, self.where = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = self.where.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _pointers(self) -> list[tuple[int, str]]:
        if not self.fs.exists(self.where):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(self.where)]
        return sorted((int(n.split("-")[1]), n.split("-", 2)[2]) for n in names if n.startswith("current-"))

    def read(self, schema: str) -> DataFrame:
        """The rows that hold; none before the first version. Any error in reading is an error."""
        pointers = self._pointers()
        if not pointers:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{pointers[-1][1]}")

    def write(self, df: DataFrame) -> None:
        """Make `df`, which may be read from this table, what holds; older versions but the last go."""
        pointers = self._pointers()
        number, name = (pointers[-1][0] + 1 if pointers else 1), f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        made = self._path(f".{name}")
        self.fs.create(made, False).close()
        if not self.fs.rename(made, self._path(f"current-{number:012d}-{name}")):
            raise OSError(f"version {number} of {self.path} could not be named; the last one holds")
        for n, old in pointers[:-1]:
            self.fs.delete(self._path(f"current-{n:012d}-{old}"), True)
            self.fs.delete(self._path(old), True)


def replace_in_place(df: DataFrame, path: str) -> None:
    """Replace a plain table by rows that may be read from it: written beside it, then swapped; the old rows are kept until the new ones are in place."""
    spark = df.sparkSession
    fresh, aside = (f"{path.rstrip('/')}-{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    df.write.parquet(fresh)
    jvm = spark._jvm
    new, old, here = (jvm.org.apache.hadoop.fs.Path(x) for x in (fresh, aside, path))
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(here)
    if had and not fs.rename(here, old):
        raise OSError(f"{path} could not be put aside; it holds as it was")
    if not fs.rename(new, here):
        if had:
            fs.rename(old, here)
        raise OSError(f"{fresh} could not take the place of {path}, which holds as it was")
    if had:
        fs.delete(old, True)


def delete_where(df: DataFrame, predicate) -> DataFrame:
    """Rows for which the predicate isn't true (SNK-5)."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, fields in column order, text as it is (SNK-9)."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def canonical(df: DataFrame) -> DataFrame:
    """Each row as JSON with sorted fields, and its digest (SNK-10)."""
    body = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    return df.select(body.alias("body")).withColumn("sha256", F.sha2("body", 256))


def content_hash(df: DataFrame) -> DataFrame:
    """One digest of all rows, whatever their order: of the number of rows and two sums of row digests, which add up across tasks."""
    row = canonical(df)
    part = lambda i: F.sum(F.conv(F.substring("sha256", i, 15), 16, 10).cast("decimal(38,0)"))
    return row.agg(F.count(F.lit(1)).alias("n"), part(1).alias("a"), part(16).alias("b")).select("n", F.sha2(F.concat_ws(":", "n", F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))), 256).alias("content_hash"))


def frozen_file(cases: DataFrame, path: str, key: str = "id") -> str:
    """Write a small table of cases as JSON lines with sorted fields in order of their key, as one file on the driver; the sha256 of its bytes (SNK-10)."""
    body = F.to_json(F.struct(*sorted(cases.columns)), {"ignoreNullFields": "false"})
    data = "".join(f"{r.body}\n" for r in cases.select(key, body.alias("body")).orderBy(key).toLocalIterator()).encode()
    with open(path, "wb") as f:
        f.write(data)
    return hashlib.sha256(data).hexdigest()


def document_page(df: DataFrame) -> DataFrame:
    """Documents as escaped HTML pages (SNK-13)."""
    return df.withColumn("html", F.concat(F.lit("<h1>"), html_escape(F.coalesce("title", F.lit(""))), F.lit("</h1><pre>"), html_escape(F.coalesce("text", F.lit(""))), F.lit("</pre>")))
