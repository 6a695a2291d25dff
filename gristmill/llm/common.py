"""Shared helpers of the training-data operators: shared-folder tables, column guards, stable ids."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The code goes to the executors with the tasks, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: What parts words in the contracts: ASCII white space, or ASCII other than letters and digits. (Lower-casing A-Z first would part them alike.)
SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir of the session.

    Only a session whose executors are this very process may lack it, as in tests; a temporary folder is set there then.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that the driver and the executors of {master} share")
        where = f"file://{tempfile.mkdtemp(prefix='gristmill-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where


#: Tables to delete, by open scratch(); each thread and task of the driver has its own.
_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())

#: While a kept table is written, Spark removes the shuffle files of that very job as it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str = "t", lasting: int = 0) -> DataFrame:
    """Write `df` to the shared folder and read it again: lineage ends there, a lost executor costs no recomputation, and later reads see one fixed version.

    Inside `scratch()` the table goes when that ends; one that is lasting by n outlives n of them, and stays where there are no more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    open_ = _scratch.get()
    if len(open_) > lasting:
        open_[-1 - lasting].append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete kept tables."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables kept inside are deleted at the end. What leaves must be kept as lasting, or must not depend on them."""
    paths: list[str] = []
    token = _scratch.set((*_scratch.get(), paths))
    try:
        yield paths
    finally:
        _scratch.reset(token)
        discard(spark, paths)


def ensure(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast to the given types; a missing one is null."""
    have = set(df.columns)
    return df.select(*((F.col(f"`{c}`") if c in have else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()))


def parted(text: Column, by: str) -> Column:
    """The words of a text, and an empty string before and after them where the text begins or ends with what parts words."""
    return F.split(text, by)


def word_count(text: Column, by: str) -> Column:
    """The number of words; a null text has none."""
    words = parted(text, by)
    ends = (F.element_at(words, 1) == "").cast("int") + (F.element_at(words, -1) == "").cast("int")
    return F.greatest(F.lit(0), F.coalesce(F.size(words) - ends, F.lit(0))).cast("long")


def packed(df: DataFrame, *keys: str) -> DataFrame:
    """The named columns, and whole rows as `g_row`, so that no helper column meets one of the table's own names."""
    return df.select(*keys, F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("g_row"))


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """Whether crc32(doc_id as text) mod `mod` is `rest`; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(False))


LEAST_FILTER, MOST_FILTER = 16, 28  # powers of two: bits of the filter that spares rows an exchange, 8 KB to 32 MB


def filter_bits(n: int) -> int:
    """Bits of a filter for n keys, as a power of two: sixteen a key, so that few other keys pass, up to the bound of a broadcast."""
    return min(MOST_FILTER, max(LEAST_FILTER, (16 * n).bit_length()))


def spot_of(key: Column, bits: int) -> Column:
    return F.xxhash64(F.lit("spot"), key).bitwiseAND(F.lit((1 << bits) - 1))


def maybe_in(df: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, Column]:
    """`df` with a bit that is set where `key` is in the kept table `wanted` (key), and for a few others.

    The filter is a bitmap of at most 32 MB whatever the number of keys, so it may be broadcast at any scale; beyond
    some twenty million keys more rows pass in vain, which costs traffic and no result.
    """
    bits = filter_bits(wanted.count())
    marks = wanted.select(spot_of(F.col(key), bits).alias("spot")).groupBy(F.expr("bitmap_bucket_number(spot)").alias("f_bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(spot))").alias("f_bits"))
    df = df.withColumn("f_spot", spot_of(F.col(key), bits))
    joined = df.join(F.broadcast(marks), F.expr("bitmap_bucket_number(f_spot)") == F.col("f_bucket"), "left").drop("f_bucket")
    joined = joined.withColumn("f_byte", F.expr("conv(hex(substring(f_bits, cast(bitmap_bit_position(f_spot) div 8 as int) + 1, 1)), 16, 10)").cast("int"))
    bit = F.coalesce(F.expr("f_bits is not null") & (F.expr("shiftright(f_byte, cast(bitmap_bit_position(f_spot) % 8 as int)) % 2 = 1")), F.lit(False))
    return joined, bit


def hot_join(rows: DataFrame, one: DataFrame, key: str, hot: DataFrame, salt: Column, salts: int = 32) -> DataFrame:
    """`rows` left-joined with `one`, which has a key once; rows of a key in the kept table `hot` (key) are dealt to `salts` tasks by `salt`.

    Both sides ask one filter of bounded size whether a key may be hot, so they agree, also where it errs.
    """
    if hot.isEmpty():
        return rows.join(one, key, "left")
    marked, hit = maybe_in(rows, key, hot)
    dealt = marked.withColumn("h_salt", F.when(hit, F.pmod(salt, F.lit(salts)).cast("int")).otherwise(0)).select(*rows.columns, "h_salt")
    marked, hit = maybe_in(one, key, hot)
    copies = F.when(hit, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(marked.select(*one.columns, F.explode(copies).alias("h_salt")), [key, "h_salt"], "left").drop("h_salt")


PIECE = 4_000_000  # bytes of texts that a Python step works on at a time, about
ROWS_A_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Whole texts travel in batches of 1,000 rows, unless the session says otherwise: Spark's 10,000 hold tens of MB in the JVM and again in Python."""
    if spark.conf.get(ROWS_A_BATCH) == "10000":
        spark.conf.set(ROWS_A_BATCH, "1000")


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """mapInArrow over small batches."""
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, schema: T.StructType | str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """mapInArrow with one function object per task, so that caches live as long as the task and no longer; a step gets few bytes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in in_pieces(batches):
            yield step(batch)

    return in_arrow(df, run, schema)


def in_pieces(batches: Iterator[pa.RecordBatch], most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts and bytes of a piece stay near `most`; a longer single row is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
                lengths += pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
        begin = total = 0
        for i, n in enumerate(lengths.tolist()):
            if i > begin and total + n > most:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        yield batch.slice(begin)
