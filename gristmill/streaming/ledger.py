"""The content-hash ledger kept up by a stream (beyond the batch form): each micro-batch is compared with the ledger and upserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import content_hash, upsert
from ..sources.sinks import Versions
from ..sources.stored import stored

LEDGER = "doc_id string, hash string, status string, batch long"


def apply_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Merge one micro-batch of (doc_id, body) into the ledger at `path`. A batch that is delivered again changes nothing."""
    rows = batch.groupBy("doc_id").agg(F.max_by("body", F.struct("seq")).alias("body")).select("doc_id", content_hash(F.col("body")).alias("hash"))
    ledger = Versions(batch.sparkSession, path)
    old = ledger.read(LEDGER)
    known = old.select("doc_id", F.col("hash").alias("old_hash"))
    status = F.when(F.col("old_hash").isNull(), "new").otherwise("changed")
    new = stored(rows.join(known, "doc_id", "left").where("old_hash is null or old_hash <> hash").select("doc_id", "hash", status.alias("status"), F.lit(batch_id).cast("long").alias("batch")), "ledger-batch")
    if not new.isEmpty():  # a batch without news writes nothing
        ledger.write(upsert(old, new, ["doc_id"]))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return Versions(spark, path).read(LEDGER)


def run(spark: SparkSession, source: str, schema: str, path: str, checkpoint: str) -> StreamingQuery:
    """Watch a folder of Parquet files of (doc_id, seq, body) and keep the ledger; stops when all that is there was read."""
    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(lambda b, i: apply_batch(b, i, path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
