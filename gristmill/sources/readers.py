"""Sources: tables, delimited files, archives, records and settings (SRC-1 to SRC-18)."""

from __future__ import annotations

import io
import json
import os
import sys
import tomllib
import zipfile
from dataclasses import dataclass, fields, replace

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules["gristmill"])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def csv_lines(spark: SparkSession, path: str, columns: list[str], optional: list[str] | None = None) -> DataFrame:
    """A CSV file with header as strings, with csv_line (the header is line 1) and source_file; a byte order mark is dropped, missing optional columns are null (SRC-1).

    Lines are numbered by file from row positions that the text reader gives per split, so nothing meets in one task.
    """
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    df = df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))
    df = df.withColumn("source_file", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)).withColumn("_id", F.monotonically_increasing_id())
    # ids grow along each split; a file's rows keep their order, so their rank within the file is their line
    parts = df.groupBy("source_file", F.shiftright("_id", 33).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("source_file").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = df.groupBy("source_file", F.shiftright("_id", 33).alias("_p")).agg(F.min("_id").alias("_first"))
    offsets = parts.withColumn("_before", before).join(first, ["source_file", "_p"])
    out = df.withColumn("_p", F.shiftright("_id", 33)).join(offsets, ["source_file", "_p"])
    have = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in [*columns, *(optional or [])]]
    return out.select(*have, "source_file", (F.col("_before") + F.col("_id") - F.col("_first") + 2).cast("int").alias("csv_line"))


def jdbc(spark: SparkSession, url: str, query: str, fetch: int = 50_000, **options) -> DataFrame:
    """A query on a relational server, fetched in batches (SRC-2, SRC-3); columns and filters are pushed down."""
    return spark.read.format("jdbc").option("url", url).option("query", query).option("fetchsize", fetch).options(**options).load()


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """A bounded sample for a preview (SRC-4)."""
    return (df.orderBy(*order) if order else df).limit(n)


def by_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of many keys in one join, in place of a query for each (SRC-5, SRC-6)."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def or_empty(spark: SparkSession, read, schema: str) -> DataFrame:
    """An optional source: an empty table where it isn't there (SRC-8). A source that is there and can't be read is an error."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "DATA_SOURCE_NOT_FOUND"):
            raise
        return spark.createDataFrame([], schema)


@F.pandas_udf(T.BinaryType())
def unzipped(blobs: pd.Series) -> pd.Series:
    """The one member of each archive; null for what is none (SRC-9)."""

    def one(blob):
        try:
            with zipfile.ZipFile(io.BytesIO(blob)) as z:
                return z.read(z.namelist()[0])
        except (zipfile.BadZipFile, TypeError, IndexError):
            return None

    return blobs.map(one)


def embedded(texts: DataFrame, embed, size: int, batch: int = 64, tries: int = 2) -> DataFrame:
    """(doc_id, embedding) by a function of a list of texts, in batches, tried again once (SRC-11). embed runs on the executors."""

    def run(frames):
        for frame in frames:
            out = []
            for i in range(0, len(frame), batch):
                part = list(frame["text"][i : i + batch])
                for attempt in range(tries):
                    try:
                        out += [[float(x) for x in v] for v in embed(part)]
                        break
                    except OSError:
                        if attempt == tries - 1:
                            raise
            yield pd.DataFrame({"doc_id": frame["doc_id"], "embedding": out})

    kind = dict(texts.dtypes)["doc_id"]
    return texts.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, embedding array<float>")


def jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Records, one a line; blank lines are skipped (SRC-12)."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema if isinstance(schema, str) else schema.json()).alias("r")).select("r.*")


def json_document(path: str) -> dict | list:
    """A small settings file on the driver (SRC-13)."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def frozen_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(split_key) and (source_id) tables of a manifest, which is an object or a bare list of keys."""
    found = json_document(path)
    keys, ids = (found, []) if isinstance(found, list) else (found.get("split_keys", []), found.get("source_ids", []))
    return spark.createDataFrame([(k,) for k in keys], "split_key string"), spark.createDataFrame([(str(i),) for i in ids], "source_id string")


@dataclass(frozen=True)
class Vehicle:
    """The vehicle that queries are for by default."""

    engine: str = "B5254T4"
    family: str = "B5"
    model: str | None = None
    year: str | None = None
    profile_id: str = ""

    @classmethod
    def load(cls, path: str | None = None, prefix: str = "CAR_") -> Vehicle:
        """Defaults, then a TOML file, then the environment (SRC-14, SRC-15)."""
        out = cls()
        names = {f.name for f in fields(cls)}
        if path and os.path.exists(path):
            with open(path, "rb") as f:
                found = tomllib.load(f)
            found = found.get("car", found)
            out = replace(out, **{k: str(v) for k, v in found.items() if k in names})
        return replace(out, **{n: v for n in names if (v := os.environ.get(prefix + n.upper()))})

    def retargeted(self, spec: str | None) -> Vehicle:
        """Another vehicle for one query, if the words name an engine; else this one (FT-22)."""
        import re

        from ..functions.text import ENGINE_CODE

        code = next((t.upper() for t in re.findall(r"[A-Za-z0-9]+", spec or "") if re.fullmatch(ENGINE_CODE, t.upper())), None)
        if not code:
            return self
        year = re.search(r"\b((?:19|20)\d{2})\b", spec or "")
        return Vehicle(engine=code, family=code[:2], model=None, year=year[1] if year else None)


def env_file(path: str) -> dict[str, str]:
    """KEY=value lines of a settings file; the environment wins."""
    out = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                key, eq, value = line.strip().partition("=")
                if eq and not key.startswith("#"):
                    out[key.strip()] = value.strip().strip("\"'")
    return {k: os.environ.get(k, v) for k, v in out.items()}


def shown(df: DataFrame, most: int = 400, head: int = 32) -> DataFrame:
    """Any result as short text: bytes by length and first hex digits, long strings cut (SRC-16)."""
    cols = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "binary":
            c = F.concat(F.lit("<bytes:"), F.octet_length(c).cast("string"), F.lit(":"), F.lower(F.hex(F.substring(c, 1, head))), F.lit(">"))
        else:
            c = c.cast("string")
            c = F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("…"))).otherwise(c)
        cols.append(c.alias(name))
    return df.select(*cols)


def sql(spark: SparkSession, text: str) -> DataFrame:
    """A free query over the registered tables (SRC-16)."""
    return shown(spark.sql(text))


def rendered_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = ("svg", "png", "gif", "jpeg")) -> DataFrame:
    """(stem, path, content) of files by their extension (SRC-17)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return files.where(ext.isin(*extensions)).select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("stem"), "path", "content")


def first_renders(files: DataFrame, extensions: tuple[str, ...] = ("svg", "png", "gif", "jpeg")) -> DataFrame:
    """(stem, path, content) with one file of each stem: that of the first extension in order (SRC-17)."""
    order = F.array_position(F.lit(list(extensions)), F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)))
    return files.groupBy("stem").agg(F.min_by(F.struct("path", "content"), F.struct(order, "path")).alias("f")).select("stem", "f.path", "f.content")


def blob_file(df: DataFrame, path: str) -> int:
    """Write the one binary value of a result to a file on the driver, and say how many bytes it has (SRC-16)."""
    rows = df.limit(2).collect()
    if len(rows) != 1 or len(rows[0]) != 1:
        raise ValueError("the result must be one value")
    with open(path, "wb") as f:
        return f.write(bytes(rows[0][0]))


def attached(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Register a folder's tables as views, and list what is registered (SRC-18)."""
    for n in names:
        table(spark, folder, n).createOrReplaceTempView(n)
    return sorted(t.name for t in spark.catalog.listTables() if t.isTemporary)
