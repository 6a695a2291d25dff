"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Each source is a stream: its documents in a shuffled, fixed order, laid end to end by their sizes. The mix
is a row of slots. Slot i has the point frac(i * golden ratio); cumulative weights map the point to a
source; the slot's rank among its source's slots says which block of the source's stream it takes. A
source's blocks are of equal tokens, and a stream that is used up starts again.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source of its own; a
source without words has target 0; empty tables give no rows; repeated rows stand side by side in the
stream; a very long text spans many blocks; ties in the order go by doc_id; other columns, whatever their
names, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, ensure, keep, packed, scratch, table, word_count

GOLDEN = 0.6180339887498949  # the fractional part of the golden ratio
BLOCK = 4096  # tokens a slot holds, about
LEAST_SLOTS = 4096  # of a mix, so that small ones come near their weights too
CHUNK = 1 << 16  # slots that are ranked in one go
BUCKET_ROWS = 2_000  # rows of a stream that are laid end to end in one task
GROUP = 1000  # sources whose goals are summed up in one task


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source_no, source, source_size, target, goal) of (source, source_size): sources in code point order with null last, their weights repeating.

    Targets go by weight and sum to share * all sizes; none is above `most` times its size, and what is over goes to the others
    by weight. However many sources there are, a round reads one row of sums: the words a unit of weight gets.
    """
    rows = numbered(sizes, F.col("source").isNull(), F.col("source"))
    weight = F.get(F.lit([float(w) for w in weights]), F.col("no") % len(weights))
    rows = keep(rows.select(F.col("no").alias("source_no"), "source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap")), "sources")
    sums = rows.agg(F.sum("source_size").alias("total"), F.sum(F.when(F.col("source_size") > 0, F.col("weight"))).alias("weights")).first()
    left, unit = share * (sums.total or 0), 0.0
    open_weights = sums.weights or 0.0
    while open_weights and left > 0:
        unit_now = left / open_weights
        if unit_now <= unit:
            break
        unit = unit_now
        full = rows.where((F.col("source_size") > 0) & (F.col("weight") * unit > F.col("cap"))).agg(F.sum("cap"), F.sum("weight")).first()
        if full[1] is None:
            break
        left, open_weights = share * sums.total - full[0], sums.weights - full[1]
    target = F.when(F.col("source_size") > 0, F.least("cap", F.col("weight") * unit)).otherwise(0.0)
    return rows.select("source_no", "source", "source_size", target.alias("target"), F.round(target).cast("long").alias("goal"))


def numbered(rows: DataFrame, *order) -> DataFrame:
    """`rows` with `no`, gapless from 0 in this order. They are sorted by ranges, and only one count a range is summed up in one place."""
    sorted_ = keep(rows.orderBy(*order).withColumns({"n_part": F.spark_partition_id(), "n_at": F.monotonically_increasing_id()}), "sorted")
    counts = sorted_.groupBy("n_part").agg(F.count(F.lit(1)).alias("n"), F.min("n_at").alias("n_low"))
    firsts = counts.select("n_part", "n_low", (F.sum("n").over(Window.orderBy("n_part")) - F.col("n")).alias("n_first"))
    return sorted_.join(F.broadcast(firsts), "n_part").withColumn("no", F.col("n_first") + F.col("n_at") - F.col("n_low")).drop("n_part", "n_at", "n_low", "n_first")


def laid_out(docs: DataFrame, seed: int = 0) -> DataFrame:
    """`docs` with `start`: the tokens before the document in its source's stream, which is ordered by a hash of id and text.

    Rows that are alike in everything are laid out as one and then side by side. Streams are cut into buckets by the top
    bits of the hash; the order doesn't depend on how many there are.
    """
    bits = min(40, max(0, (docs.count() // BUCKET_ROWS).bit_length()))
    docs = docs.groupBy(*docs.columns).agg(F.count(F.lit(1)).alias("alike"))
    docs = docs.withColumn("bucket", F.shiftrightunsigned(F.shiftrightunsigned("hash", 1), 63 - bits) if bits else F.lit(0).cast("long"))
    sums = docs.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("alike")).alias("inside"))
    before = sums.withColumn("before", F.coalesce(F.sum("inside").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "before")
    docs = docs.join(before, docs.source.eqNullSafe(F.col("b_source")) & (docs.bucket == F.col("b_bucket"))).drop("b_source", "b_bucket")
    order = Window.partitionBy("source", "bucket").orderBy(F.shiftrightunsigned("hash", 1), "hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("first", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("alike")).over(order), F.lit(0)))
    docs = docs.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("alike") - 1)))
    return docs.withColumn("start", F.col("first") + F.col("copy") * F.col("size")).drop("before", "bucket", "first", "copy", "alike")


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source_no, rank, slots, source_size, goal): the source of each slot, the slot's rank among its source's slots and how many these are.

    Cumulative goals cut the unit interval into the sources' ranges; a slot's point finds the range it falls into by way of
    equal cells, so that no slot meets more ranges than begin in its cell. A source whose range no point hits gets one slot at the end.
    """
    spark = targets.sparkSession
    some = keep(targets.where("goal > 0"), "goals")
    n_sources, total = some.agg(F.count(F.lit(1)), F.sum("goal")).first()
    n = max(LEAST_SLOTS, -(-total // block)) if total else 0
    cells = max(1, 4 * n_sources)
    upto = F.sum("goal").over(Window.partitionBy("group").orderBy("source_no"))
    grouped = some.withColumn("group", F.expr(f"source_no div {GROUP}"))
    sums = grouped.groupBy("group").agg(F.sum("goal").alias("inside"))
    before = sums.select("group", (F.sum("inside").over(Window.orderBy("group")) - F.col("inside")).alias("before"))  # one row for many sources
    ranges = grouped.withColumn("upto", upto).join(before, "group").select("source_no", "source_size", "goal", (F.col("before") + F.col("upto") - F.col("goal")).alias("low"), (F.col("before") + F.col("upto")).alias("high"))
    ranges = ranges.withColumns({"low": F.col("low") / F.lit(float(total or 1)), "high": F.col("high") / F.lit(float(total or 1))})
    ranges = ranges.withColumn("cell", F.explode(F.expr(f"sequence(cast(floor(low * {cells}) as long), cast(floor(high * {cells}) as long))")))
    point = F.expr(f"(id * {GOLDEN!r}D) % 1D")
    slots = spark.range(n).select(F.col("id").alias("slot"), point.alias("point"), F.floor(point * cells).cast("long").alias("cell"), F.expr(f"id div {CHUNK}").alias("chunk"))
    slots = slots.join(ranges, "cell").where("low <= point and point < high").select("slot", "source_no", "source_size", "goal", "chunk")
    counts = slots.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    all_ = Window.partitionBy("source_no")
    counts = keep(counts.select("source_no", "chunk", (F.sum("n").over(all_.orderBy("chunk")) - F.col("n")).alias("before"), F.sum("n").over(all_).alias("slots")), "slot-counts")
    ranked = slots.join(counts, ["source_no", "chunk"]).withColumn("rank", F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1 + F.col("before"))
    one = F.lit(1).cast("long")
    missed = some.join(counts, "source_no", "left_anti").select((n + F.col("source_no")).alias("slot"), "source_no", (one - 1).alias("rank"), one.alias("slots"), "source_size", "goal")
    return ranked.select(*missed.columns).unionByName(missed)


def blocks(plan: DataFrame) -> DataFrame:
    """The schedule with the range [low, high) of its source's stream that each slot takes; a block over the stream's end is cut in two, and the stream starts again."""
    edge = lambda r: F.expr(f"cast(floor(cast(goal as decimal(20,0)) * ({r}) / slots) as long)")
    out = plan.withColumns({"from": edge("rank"), "to": edge("rank + 1")})
    lap = F.explode(F.expr("sequence(`from` div source_size, greatest(`from`, `to` - 1) div source_size)"))
    out = out.select("*", lap.alias("lap")).withColumns({"low": F.greatest("from", F.expr("lap * source_size")) - F.expr("lap * source_size"), "high": F.least("to", F.expr("(lap + 1) * source_size")) - F.expr("lap * source_size")})
    return out.where("low < high").select("slot", "source_no", "lap", "low", "high")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of (doc_id, size, source, hash): the documents laid out, with source_no, source_size, target and goal; the targets; the slots with the ranges they take."""
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = keep(source_targets(sizes, weights, share, most), "targets")
    named = targets.withColumnRenamed("source", "t_source")
    # documents without words are in no stream
    streams = laid_out(docs.where("size > 0")).unionByName(docs.where("size = 0").withColumn("start", F.lit(0).cast("long")))
    streams = keep(streams.join(named, streams.source.eqNullSafe(named.t_source), "left").drop("t_source"), "streams")
    return streams, targets, blocks(schedule(targets, block))


def words_taken(streams: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """`streams` with `taken`: the words of each document in the blocks that the slots take, repeats counted.

    Documents and blocks meet on cells of the stream, `block` tokens each, so a document meets only the blocks beside it.
    """
    cell = lambda low, high: F.explode(F.expr(f"sequence({low} div {block}L, ({high} - 1) div {block}L)"))
    rows = streams.where("size > 0").select("source_no", "start", "size", cell("start", "(start + size)").alias("cell"))
    ranges = slots.select("source_no", "low", "high", cell("low", "high").alias("cell"))
    over = F.least(F.col("start") + F.col("size"), "high", (F.col("cell") + 1) * block) - F.greatest("start", "low", F.col("cell") * block)
    found = rows.join(ranges, ["source_no", "cell"]).groupBy("source_no", "start").agg(F.sum(F.greatest(over, F.lit(0))).alias("taken"))
    sized, none = streams.where("size > 0"), streams.where("size = 0")
    return sized.join(found, ["source_no", "start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")).unionByName(none.withColumn("taken", F.lit(0).cast("long")))


def sized_documents(docs: DataFrame) -> DataFrame:
    docs = ensure(docs, doc_id="long", text="string", source="string")
    return docs.select("doc_id", word_count(F.col("text"), SPACE).alias("size"), "source", F.xxhash64("doc_id", "text").alias("hash"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`docs`, all columns, each as many times as the mix takes its words, rounded; repeated rows share what is taken of them."""
    with scratch(docs.sparkSession):
        streams, _, slots = mix(keep(sized_documents(docs), "sized"), weights, share, most)
        times = words_taken(streams, slots).where("taken > 0").groupBy(F.col("hash").alias("m_hash")).agg(F.round(F.sum(F.expr("taken / size")) / F.count(F.lit(1))).cast("int").alias("m_times"))
        times = keep(times.where("m_times > 0"), "times", lasting=1)
    marked = packed(docs, "doc_id", "text").select(F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("m_key"), "g_row")
    out = marked.join(times, F.col("m_key") == F.col("m_hash"))
    return out.select("g_row", F.explode(F.sequence(F.lit(1), "m_times")).alias("m_copy")).select("g_row.*")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of all sources takes."""
    with scratch(spark):
        streams, _, slots = mix(keep(sized_documents(table(spark, sf_dir, "documents")), "sized"))
        out = keep(words_taken(streams, slots).select("doc_id", "size", "source_size", "target", "taken"), "mixed", lasting=1)
    return out
