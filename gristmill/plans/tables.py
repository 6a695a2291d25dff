"""The test tables in the shapes that the operators take: each stands in for a table of a document store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import title_of
from ..operators.tools import Store
from ..sources.readers import Vehicle, table

#: DuckDB forms of the same.
DOCS_SQL = "select doc_id, left(split_part(text, chr(10), 1), 80) as title, text, lang as section, source as db from documents"
TOKENS_SQL = r"list_filter(regexp_split_to_array(strip_accents(lower({0})), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", title_of(F.col("text")).alias("title"), "text", F.col("lang").alias("section"), F.col("source").alias("db"))


ROWS_A_TASK = 1_000_000  # of sold parts, that a task makes distinct, in some hundred MB


def parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts of sections: a supplier is a section. The more rows, the more tasks make them distinct; the join keeps to these."""
    li = _sold(spark, d)
    tasks = max(spark.sparkContext.defaultParallelism, -(-li.count() // ROWS_A_TASK))
    return _described(spark, d, li.repartition(tasks, "p_partkey").distinct())


def least_parts(spark: SparkSession, d: str) -> DataFrame:
    """Each part of `parts` once, in its least section, for those who take no other: a minimum of numbers by key before any text is joined."""
    return _described(spark, d, _sold(spark, d).groupBy("p_partkey").agg(F.min("section_id").alias("section_id")))


def _sold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("section_id"))


def _described(spark: SparkSession, d: str, sold: DataFrame) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("part_number"), F.col("p_name").alias("description"), F.col("p_brand").alias("section_title"))
    return sold.join(p, "p_partkey").select("part_number", "description", "section_id", "section_title")


PARTS_SQL = "select distinct p_partkey::varchar as part_number, p_name as description, l_suppkey as section_id, p_brand as section_title from lineitem join part on l_partkey = p_partkey"


def profiles(spark: SparkSession, d: str) -> DataFrame:
    """Nations as profiles: some without a year, some without an engine."""
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select(k.cast("string").alias("profile_id"), F.when(k % 7 != 6, F.col("n_name")).alias("model"), F.when(k % 3 != 2, (2000 + k % 4).cast("string")).alias("year"), F.when(k % 5 != 4, F.concat(F.lit("E"), (k % 6).cast("string"))).alias("engine"))


PROFILES_SQL = "select n_nationkey::varchar as profile_id, case when n_nationkey % 7 <> 6 then n_name end as model, case when n_nationkey % 3 <> 2 then (2000 + n_nationkey % 4)::varchar end as year, case when n_nationkey % 5 <> 4 then 'E' || (n_nationkey % 6)::varchar end as engine from nation"


def edges(spark: SparkSession, d: str) -> DataFrame:
    """Orders tag the documents of their number with their customers' nations."""
    o = table(spark, d, "orders").select((F.col("o_orderkey") % 5000).alias("doc_id"), F.col("o_custkey").alias("c_custkey"))
    return o.join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_custkey").select("doc_id", F.col("c_nationkey").cast("string").alias("profile_id")).distinct()


EDGES_SQL = "select distinct o_orderkey % 5000 as doc_id, c_nationkey::varchar as profile_id from orders join customer on o_custkey = c_custkey"


def store(spark: SparkSession, d: str) -> Store:
    base = docs(spark, d).withColumns({"doc_id": F.col("doc_id").cast("string"), "ref": F.concat(F.lit("VCC-"), F.lpad(F.col("doc_id").cast("string"), 6, "0")), "model": F.lit(None).cast("string"), "year": F.lit(None).cast("string"), "engine": F.when(F.col("doc_id") % 3 == 0, "B5254T4").when(F.col("doc_id") % 3 == 1, "B4204T"), "refs": F.expr("cast(array() as array<string>)")})
    return Store(base, {"parts": parts(spark, d), "vectors": table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("doc_id"), "embedding")}, Vehicle())
