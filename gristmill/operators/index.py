"""A stored inverted index for many queries over one corpus (SNK-7, JN-9, FT-6): postings by term, lengths, statistics.

Postings lie in folders by a hash of their term, sorted by term, so a query reads the few folders of its terms,
and of those the row groups that hold them. A posting has the positions of its term in title and body, so
phrases are matched without the texts.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.parsers import small_batches
from . import fulltext as ft

cloudpickle.register_pickle_by_value(sys.modules["gristmill"])

BUCKETS = 64


def bucket_of(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


DOCS_A_PART = 250_000  # of which a bucket's postings are sorted in one task, in some hundred MB


def postings_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(term, doc_id, title, body) of whole documents (doc_id, title and body as lists of words): the positions of each word; no list where a field lacks it."""
    docs, terms, places = [], [], []
    for field in ("title", "body"):
        words = batch.column(field)
        sizes = pa.compute.fill_null(pa.compute.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        first = np.cumsum(sizes) - sizes
        docs.append(np.repeat(np.arange(len(sizes)), sizes))
        places.append(np.arange(int(sizes.sum())) - np.repeat(first, sizes))
        terms.append(words.flatten())
    coded = pa.concat_arrays(terms).dictionary_encode()
    of, term, place, field = np.concatenate(docs), coded.indices.to_numpy(), np.concatenate(places), np.repeat([0, 1], [len(d) for d in docs])
    order = np.lexsort((place, field, term, of))
    of, term, place, field = (x[order] for x in (of, term, place, field))
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (term[1:] != term[:-1])
    begin, row = np.flatnonzero(new), np.cumsum(new) - 1
    lists = []
    for n in (0, 1):
        here = field == n
        counts = np.bincount(row[here], minlength=len(begin))
        offsets = np.concatenate(([0], np.cumsum(counts)))
        lists.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(place[here], pa.int32()), mask=pa.array(counts == 0)))
    return pa.record_batch({"term": coded.dictionary.take(pa.array(term[begin])), "doc_id": batch.column("doc_id").take(pa.array(of[begin])), "title": lists[0], "body": lists[1]})


def build(docs: DataFrame, path: str, buckets: int = BUCKETS, key: str = "doc_id") -> None:
    """Write the index of (doc_id, title, text) `docs`: one exchange of postings, none of texts.

    A document's words are in one task already, so its postings are made there. The more documents, the more tasks share a bucket, so that none sorts more than memory holds.
    """
    small_batches(docs.sparkSession)
    words = docs.select(F.col(key).alias("doc_id"), tx.tokens(F.col("title")).alias("title"), tx.tokens(F.col("text")).alias("body"))
    postings = words.mapInArrow(lambda batches: map(postings_of, batches), f"term string, doc_id {dict(words.dtypes)['doc_id']}, title array<int>, body array<int>")
    shares = max(1, -(-docs.count() // DOCS_A_PART))
    dealt = postings.withColumn("bucket", bucket_of(F.col("term"), buckets))
    dealt = dealt.repartitionById(buckets * shares, F.col("bucket") * shares + F.pmod(F.xxhash64("doc_id"), F.lit(shares)).cast("int"))
    dealt.sortWithinPartitions("bucket", "term", "doc_id").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/postings")
    count = lambda c: tx.word_total(tx.token_words(F.col(c)))
    docs.select(F.col(key).alias("doc_id"), (count("title") + count("text")).alias("dl")).write.mode("overwrite").parquet(f"{path}/lengths")
    lengths = docs.sparkSession.read.parquet(f"{path}/lengths")
    lengths.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"), F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")


def lookup(spark: SparkSession, path: str, terms: list[str], buckets: int) -> DataFrame:
    """The postings of a few terms; folders of other terms aren't read."""
    wanted = [r.bucket for r in spark.createDataFrame([(t,) for t in terms], "term string").select(bucket_of(F.col("term"), buckets).alias("bucket")).distinct().collect()]
    found = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(wanted) & F.col("term").isin(terms)).drop("bucket")
    none = F.expr("cast(array() as array<int>)")
    return found.withColumns({"title": F.coalesce("title", none), "body": F.coalesce("body", none)})


def phrase_hits(postings: DataFrame, phrase: str):
    """(doc_id, f): the weighted places of a phrase: lists of its words, each less its offset, are intersected."""
    words = phrase.split()
    lists = []
    for i, w in enumerate(words):
        begin = lambda c, i=i: F.transform(c, lambda p: p - i)
        lists.append(postings.where(F.col("term") == w).select("doc_id", begin("title").alias("t"), begin("body").alias("b")))
    both = reduce(lambda a, b: a.join(b.select("doc_id", F.col("t").alias("t2"), F.col("b").alias("b2")), "doc_id").select("doc_id", F.array_intersect("t", "t2").alias("t"), F.array_intersect("b", "b2").alias("b")), lists)
    f = ft.TITLE_WEIGHT * F.size("t") + ft.BODY_WEIGHT * F.size("b")
    return both.select("doc_id", f.alias("f")).where("f > 0")


def search(spark: SparkSession, path: str, query: ft.Query, relaxed: bool = False) -> DataFrame:
    """(doc_id, rank) by BM25 from the index alone (FT-7); lower is better."""
    stats = spark.read.parquet(f"{path}/stats").first()
    phrases = query.phrases
    if not phrases:
        return spark.createDataFrame([], "doc_id long, rank double")
    postings = lookup(spark, path, sorted({w for p in phrases for w in p.split()}), stats.buckets)
    hits = reduce(DataFrame.unionByName, (phrase_hits(postings, p).withColumn("phrase", F.lit(i)) for i, p in enumerate(phrases)))
    rows = hits.groupBy("doc_id").agg(*(F.coalesce(F.max(F.when(F.col("phrase") == i, F.col("f"))), F.lit(0.0)).alias(f"f{i}") for i in range(len(phrases))))
    rows = rows.join(spark.read.parquet(f"{path}/lengths"), "doc_id")
    found = {r.phrase: r.n for r in hits.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a phrase
    out = ft.ranked(rows, query, ft.Stats(stats.n, stats.avgdl, [found.get(i, 0) for i in range(len(phrases))]), "doc_id")
    return (out if relaxed else out.where("strict")).drop("strict")
