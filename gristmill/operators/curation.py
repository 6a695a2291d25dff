"""Curation of chat-shaped training records (DS-1 to DS-15, FLT-20 to FLT-22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import estimated_tokens
from ..sources.stored import stored

MAX_TOKENS = 4096
ROLES = ("system", "user", "assistant", "tool")
TOOL_CALL = "array<struct<id:string,name:string,arguments:string>>"
MESSAGE = f"struct<role:string,content:string,tool_calls:{TOOL_CALL},tool_call_id:string>"
#: Shares of the types of records, and of the kinds of grounded ones.
SHARES = {"grounded": 0.55, "refusal": 0.12, "elicitation": 0.08, "cross_vehicle": 0.08, "multi_turn": 0.12, "figure": 0.05}
GROUNDED = {"part": 0.40, "torque": 0.30, "procedure": 0.25, "pinout": 0.05}


def message(role: str, content: Column | None = None, calls: Column | None = None, call_id: Column | None = None) -> Column:
    return F.struct(F.lit(role).alias("role"), (content if content is not None else F.lit(None)).cast("string").alias("content"), (calls if calls is not None else F.lit(None)).cast(TOOL_CALL).alias("tool_calls"), (call_id if call_id is not None else F.lit(None)).cast("string").alias("tool_call_id"))


def tool_call(call_id: Column, name: str, arguments: Column) -> Column:
    return F.array(F.struct(call_id.cast("string").alias("id"), F.lit(name).alias("name"), arguments.cast("string").alias("arguments")))


def vehicle_label(year: Column, model: Column, engine: Column, vin: Column | None = None) -> Column:
    head = F.nullif(F.concat_ws(" ", year, model), F.lit(""))
    return F.concat_ws(" | ", head, F.concat(F.lit("engine "), engine), *([F.concat(F.lit("VIN "), vin)] if vin is not None else []))


def split_key(model: Column, topic: str, missing: str = "?") -> Column:
    return F.concat(F.coalesce(model, F.lit(missing)), F.lit(f"|{topic}"))


def plan_counts(spark: SparkSession, limit: int, shares: dict[str, float] | None = None) -> DataFrame:
    """(example_type, target): shares of the limit, rounded half to even, one at least (DS-4)."""
    rows = spark.createDataFrame(list((shares or SHARES).items()), "example_type string, share double")
    return rows.select("example_type", F.greatest(F.lit(1), F.bround(F.col("share") * limit)).cast("int").alias("target"))


def producer_counts(spark: SparkSession, limit: int) -> DataFrame:
    """(example_type, answer_type, target): the plan with the grounded share split among its kinds, one at least of each."""
    plan = plan_counts(spark, limit)
    kinds = spark.createDataFrame(list(GROUNDED.items()), "answer_type string, share double")
    split = plan.where("example_type = 'grounded'").crossJoin(F.broadcast(kinds))  # one row by four
    split = split.select("example_type", "answer_type", F.greatest(F.lit(1), F.bround(F.col("share") * F.col("target"))).cast("int").alias("target"))
    return split.unionByName(plan.where("example_type <> 'grounded'").select("example_type", F.col("example_type").alias("answer_type"), "target"))


def record_hash(messages: Column) -> Column:
    return F.sha1(F.to_json(messages))


def problems(messages: Column, tools: tuple[str, ...]) -> Column:
    """What is wrong with a record's messages; nothing for a valid one (FLT-22). One fold over the messages keeps the open calls."""
    known = F.array(*map(F.lit, tools))
    none = F.expr("cast(array() as array<string>)")

    def step(acc: Column, m: Column) -> Column:
        calls = F.coalesce(m["tool_calls"], F.expr(f"cast(array() as {TOOL_CALL})"))
        ids = F.transform(calls, lambda c: c["id"])
        asks = (m["role"] == "assistant") & (F.size(calls) > 0)
        answered = F.array_contains(acc["open"], m["tool_call_id"])
        bad = F.concat(
            acc["bad"],
            F.when(F.coalesce(m["role"].isin(*ROLES), F.lit(False)), none).otherwise(F.array(F.lit("bad role"))),
            F.when(asks & F.exists(calls, lambda c: ~F.coalesce(F.array_contains(known, c["name"]), F.lit(False))), F.array(F.lit("unknown tool"))).otherwise(none),
            F.when(asks & F.exists(calls, lambda c: F.try_parse_json(F.coalesce(c["arguments"], F.lit("{}"))).isNull()), F.array(F.lit("arguments not JSON"))).otherwise(none),
            F.when((m["role"] == "tool") & ~F.coalesce(answered, F.lit(False)), F.array(F.lit("answer to unknown call"))).otherwise(none),
        )
        open_ = F.when(asks, F.array_union(acc["open"], ids)).when(m["role"] == "tool", F.filter(acc["open"], lambda x: x != m["tool_call_id"])).otherwise(acc["open"])
        return F.struct(bad.alias("bad"), open_.alias("open"))

    folded = F.aggregate(messages, F.struct(none.alias("bad"), none.alias("open")), step)
    last = F.try_element_at(messages, F.lit(-1))
    end = F.coalesce((last["role"] == "assistant") & (last["content"] != ""), F.lit(False))
    out = F.concat(
        F.when(F.coalesce(F.try_element_at(messages, F.lit(1))["role"] == "system", F.lit(False)), none).otherwise(F.array(F.lit("no system message first"))),
        folded["bad"],
        F.when(F.size(folded["open"]) > 0, F.array(F.lit("unanswered calls"))).otherwise(none),
        F.when(end, none).otherwise(F.array(F.lit("no answer last"))),
    )
    return F.when(F.coalesce(F.size(messages), F.lit(0)) <= 0, F.array(F.lit("empty"))).otherwise(out)


def without_leaks(records: DataFrame, frozen_keys: DataFrame, frozen_sources: DataFrame) -> DataFrame:
    """Records whose split key and sources aren't held out (FLT-21). records: split_key, source_ids; (split_key); (source_id)."""
    hit = records.select("record_id", F.explode("source_ids").alias("source_id")).join(frozen_sources, "source_id", "left_semi").select("record_id").distinct()
    return records.join(frozen_keys, "split_key", "left_anti").join(hit, "record_id", "left_anti")


def short_enough(records: DataFrame, chars: Column, most: int = MAX_TOKENS) -> DataFrame:
    return records.where(estimated_tokens(chars) <= most)


SPARE = 1_000  # rows that are looked at beyond twice those wanted, before all rows are made different


def first_different(rows: DataFrame, key: str, order: str, n: int, but: DataFrame | None = None) -> DataFrame:
    """The first `n` rows by `order` and `key` of different keys that `but` (key) lacks, stored.

    The first rows, repeats among them, hold the first of each key in them. So a few go through a heap in each task, and only
    where these hold fewer different keys than are wanted, and aren't all, are all rows exchanged and sorted by key.
    """
    one_each = lambda x: x.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")
    new = lambda x: x if but is None else x.join(but.select(key), key, "left_anti")
    few = 2 * n + SPARE
    first = stored(rows.orderBy(order, key).limit(few), "first")
    took = stored(one_each(new(first)).orderBy(order, key).limit(n), "kept")
    return took if took.count() == n or first.count() < few else stored(one_each(new(rows)).orderBy(order, key).limit(n), "kept")


def filled(producers: list[tuple[DataFrame, int]], chars: Column, valid: Column, most: int = MAX_TOKENS) -> DataFrame:
    """The first `target` records of each producer in turn that are short, valid and new (DS-7). Producers: hash, seq, ...; few, so the loop is over plans, not rows.

    Each producer's kept records are a stored table, whose hashes are excluded from the next, so a plan doesn't hold those before it;
    a window over all would differ where a duplicate was beyond an earlier quota.
    """
    kept = None
    for rows, target in producers:
        took = first_different(rows.where(estimated_tokens(chars) <= most).where(valid), "hash", "seq", target, kept)
        kept = took if kept is None else kept.unionByName(took)
    return kept


def paired(docs: DataFrame, group: str = "model", order: str = "doc_id") -> DataFrame:
    """Two consecutive documents of each group, none used twice, in order of the second (DS-6)."""
    w = Window.partitionBy(group).orderBy(order)
    rows = docs.withColumns({"n": F.row_number().over(w), "second": F.lead(order).over(w)})
    return rows.where("n % 2 = 1 and second is not null").select(group, F.col(order).alias("first"), "second")


def coherent_vehicle(edges: DataFrame, profiles: DataFrame, prefer: str | None = None) -> DataFrame:
    """One real profile row for each document: the preferred model first, then by model, year, engine (DS-2); lists are never zipped."""
    rows = edges.join(profiles, "profile_id").where("model is not null")
    w = Window.partitionBy("doc_id").orderBy(F.desc(F.col("model").eqNullSafe(F.lit(prefer))), "model", F.asc_nulls_last("year"), F.asc_nulls_last("engine"), "profile_id")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("doc_id", "profile_id", "model", "year", "engine")


def shuffled(records: DataFrame, seed: int = 3407, key: str = "hash") -> DataFrame:
    """A fixed random order (SRT-11): a range exchange on a seeded hash, then local sorts."""
    return records.orderBy(F.xxhash64(F.lit(seed), key), key)


def shortfall(kept: DataFrame, plan: DataFrame) -> DataFrame:
    """(example_type, target, produced, short) (AGG-19)."""
    got = kept.groupBy("example_type").agg(F.count(F.lit(1)).alias("produced"))
    return plan.join(got, "example_type", "left").select("example_type", "target", F.coalesce("produced", F.lit(0)).alias("produced")).withColumn("short", F.col("produced") < F.col("target"))
