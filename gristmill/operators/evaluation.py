"""Graders, scorecards, gates and champion scores (EV-1 to EV-8, AGG-13 to AGG-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx

#: Thresholds with whether higher is better, and weights of the champion score.
GATES = {"part_number_exact": (0.995, True), "torque_exact": (0.995, True), "hallucination_rate": (0.005, False), "refusal_correct": (0.98, True), "retrieval_hit_at_k": (0.90, True)}
WEIGHTS = {"hallucination_rate": 3.0, "part_number_exact": 2.0, "torque_exact": 2.0, "refusal_correct": 1.5, "retrieval_hit_at_k": 1.0, "procedure_correct": 1.0, "figure_correct": 0.5}
#: The grade column of each metric.
METRICS = {"part_number_exact": "part_number_exact", "torque_exact": "torque_exact", "hallucination_rate": "hallucinated", "refusal_correct": "refusal_correct", "retrieval_hit_at_k": "retrieval_hit", "procedure_correct": "procedure_correct", "figure_correct": "figure_correct"}
FAR = 1_000_000_000


def last_answers(answers: DataFrame) -> DataFrame:
    """One answer for each id: the last (JN-19). answers: id, seq, answer, tool_refs."""
    return answers.groupBy("id").agg(F.max_by(F.struct("answer", "tool_refs"), "seq").alias("a")).select("id", "a.answer", "a.tool_refs")


def ref_hit(gold: Column, refs: Column) -> Column:
    """Whether the gold reference was served; null without one (AGG-21)."""
    want = tx.blank_to_null(F.lower(gold))
    return F.when(want.isNotNull(), F.coalesce(F.array_contains(F.transform(refs, lambda r: F.trim(F.lower(r))), want), F.lit(False)))


def graded(cases: DataFrame, answers: DataFrame) -> DataFrame:
    """A nullable column for each grade; what doesn't apply is null (EV-1 to EV-3). cases: id, answer_type, gold_value, gold_part, gold_doc_ref, gold_text, expect_refusal."""
    rows = cases.join(last_answers(answers), "id", "left")
    kind, text = F.col("answer_type"), F.coalesce("answer", F.lit(""))
    low, gold = F.lower(text), F.lower(F.coalesce("gold_text", F.lit("")))
    hit = ref_hit(F.col("gold_doc_ref"), F.coalesce("tool_refs", F.expr("cast(array() as array<string>)")))
    refused = tx.declines(text) & ~tx.asserts_value(text)
    wants = (kind == "refusal") & F.coalesce("expect_refusal", F.lit(False))
    ref = F.lower(F.coalesce("gold_doc_ref", F.lit("")))
    return rows.withColumns({
        "torque_exact": F.when(kind == "torque", tx.quotes_value(text, F.col("gold_value"))),
        "part_number_exact": F.when((kind == "part_number") | ((kind == "cross_vehicle") & (F.coalesce("gold_part", F.lit("")) != "")), tx.quotes_part(text, F.col("gold_part"))),
        "retrieval_hit": F.when(kind.isin("torque", "procedure"), hit),
        "procedure_correct": F.when(kind == "pinout", (gold != "") & (F.instr(low, F.left(gold, F.lit(24))) > 0)).when(kind == "cross_vehicle", F.contains(low, F.lit("verify before use"))),
        "figure_correct": F.when(kind == "figure", F.coalesce(hit, F.lit(False)) | ((ref != "") & (F.instr(low, ref) > 0))),
        "refusal_correct": F.when(wants, refused),
        "hallucinated": F.when(wants, ~refused),
        "missing": F.col("answer").isNull(),
    })


def scorecard(grades: DataFrame) -> DataFrame:
    """(metric, passed, n, rate) in one aggregate (AGG-13, AGG-14); nothing measured is rate 0."""
    row = grades.agg(*(F.struct(F.count_if(F.col(c)).alias("passed"), F.count(c).alias("n")).alias(m) for m, c in METRICS.items()))
    long = row.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, METRICS)), F.array(*METRICS))).alias("metric", "x")).select("metric", "x.passed", "x.n")
    return long.withColumn("rate", F.when(F.col("n") > 0, F.col("passed") / F.col("n")).otherwise(0.0))


def gate_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m, t, h) for m, (t, h) in GATES.items()], "metric string, threshold double, higher_better boolean")


def gated(card: DataFrame) -> DataFrame:
    """Each gate and whether it is passed; one that wasn't measured fails (EV-5)."""
    rows = F.broadcast(gate_table(card.sparkSession)).join(card, "metric", "left")
    ok = (F.coalesce("n", F.lit(0)) > 0) & F.when(F.col("higher_better"), F.col("rate") >= F.col("threshold")).otherwise(F.col("rate") <= F.col("threshold"))
    return rows.select("metric", "threshold", "rate", "n", F.coalesce(ok, F.lit(False)).alias("passes"))


def champion_score(card: DataFrame, group: list[str] | None = None) -> DataFrame:
    """The weighted score (EV-6)."""
    weights = F.broadcast(card.sparkSession.createDataFrame(list(WEIGHTS.items()), "metric string, weight double"))
    part = F.col("weight") * F.when(F.col("metric") == "hallucination_rate", 1 - F.col("rate")).otherwise(F.col("rate"))
    return card.join(weights, "metric").groupBy(*(group or [])).agg(F.round(F.sum(part), 6).alias("score"))


def is_champion(card: DataFrame, champion: DataFrame | None) -> bool:
    """Whether a scorecard takes the lead (EV-6): it passes all gates, and there is no champion or it scores strictly higher. Scorecards are a row a metric."""
    if gated(card).where("not passes").count():
        return False
    return champion is None or champion_score(card).first().score > champion_score(champion).first().score


def precision_recall(found: DataFrame) -> DataFrame:
    """Of (expected, value), nulls for none (AGG-15)."""
    tp = F.count_if(F.col("expected").isNotNull() & F.col("value").isNotNull() & (F.abs(F.col("value") - F.col("expected")) <= 0.05))
    return found.agg(tp.alias("tp"), F.count("value").alias("predicted"), F.count("expected").alias("actual")).select("tp", "predicted", "actual", F.round(F.try_divide("tp", "predicted"), 4).alias("precision"), F.round(F.try_divide("tp", "actual"), 4).alias("recall"))


def rank_of(results: DataFrame, wanted: Column) -> DataFrame:
    """(case_id, rank): the place of the first result that fits, far away for none (EV-7). results: case_id, pos, ..."""
    return results.groupBy("case_id").agg(F.coalesce(F.min(F.when(wanted, F.col("pos"))), F.lit(FAR)).cast("long").alias("rank"))


def names(ref: str | None = None, title: str | None = None) -> Column:
    """Whether a result's reference begins so, or its title has the pattern."""
    out = F.lit(False)
    if ref:
        out = out | F.coalesce(F.startswith(F.upper("ref"), F.lit(ref.upper())), F.lit(False))
    return out | F.coalesce(F.rlike("title", F.lit(f"(?i){title}")), F.lit(False)) if title else out


def ranking_checks(results: DataFrame, checks: list[tuple[str, str, dict]]) -> DataFrame:
    """(check_id, ok) of checks on results (case_id, pos, ref, title, scope, lead) (EV-7).

    Kinds: "above" (what is wanted stands, and not behind what isn't), "within" (it stands among the first n),
    "absent" (it doesn't stand there) and "no lead" (no document of another engine shows its text). A check's
    parameters name the case, and `want`, `other` (of `names`) and `n`.
    """
    place = lambda fits: F.coalesce(F.min(F.when(fits, F.col("pos"))), F.lit(FAR))
    out = None
    for check_id, kind, p in checks:
        want, other, n = names(**p.get("want", {})), names(**p.get("other", {})), p.get("n", FAR)
        ok = {
            "above": (place(want) < FAR) & (place(want) <= place(other)),
            "within": place(want) < n,
            "absent": place(want) >= n,
            "no lead": F.count_if(F.startswith(F.coalesce("scope", F.lit("")), F.lit("other engine")) & F.col("lead").isNotNull()) == 0,
        }[kind]
        row = results.where(F.col("case_id") == p["case"]).agg(F.lit(check_id).alias("check_id"), ok.alias("ok"))
        out = row if out is None else out.unionByName(row)
    return out


def turn_failures(turns: DataFrame) -> DataFrame:
    """`turns` with `failures` and `ok` (EV-8): what an answer must and mustn't say, words that no call's arguments may hold, tools that must be used; where calls can't be seen, rules on them fail.

    turns: answer, must_mention, must_not_say, tool_must_not_contain, tool_must_use, tool_calls array<struct<tool, args>> or null.
    """
    none = F.expr("cast(array() as array<string>)")
    c = lambda name: F.coalesce(F.col(name), none)
    low, calls = F.lower(F.coalesce("answer", F.lit(""))), F.coalesce("tool_calls", F.expr("cast(array() as array<struct<tool:string,args:string>>)"))
    seen = F.col("tool_calls").isNotNull()
    told = lambda rows, text: F.transform(rows, lambda x: F.concat(F.lit(text + " "), x))
    failures = F.concat(
        told(F.filter(c("must_mention"), lambda w: ~F.contains(low, F.lower(w))), "missing"),
        told(F.filter(c("must_not_say"), lambda w: F.contains(low, F.lower(w))), "said"),
        F.when(~seen & (F.size(c("tool_must_not_contain")) + F.size(c("tool_must_use")) > 0), F.array(F.lit("calls not observable"))).otherwise(none),
        told(F.filter(c("tool_must_not_contain"), lambda w: F.exists(calls, lambda x: F.contains(F.lower(x["args"]), F.lower(w)))), "call contains"),
        told(F.when(seen, F.array_except(c("tool_must_use"), F.transform(calls, lambda x: x["tool"]))).otherwise(none), "not used"),
    )
    return turns.withColumn("failures", failures).withColumn("ok", F.size("failures") == 0)


def turns_pass(turns: DataFrame) -> DataFrame:
    """Whether an answer says all it must and nothing it mustn't, and used its tools (EV-8). turns: answer, must_mention, must_not_say, tools_used, tool_must_use."""
    ok = tx.contains_all(F.col("answer"), F.col("must_mention")) & ~tx.contains_any(F.col("answer"), F.col("must_not_say")) & (F.size(F.array_except("tool_must_use", "tools_used")) == 0)
    return turns.withColumn("ok", ok)


def judge_requests(cases: DataFrame, model: str, most: int = 9000) -> DataFrame:
    """One request body for each case, as JSON (EV-9); sending it is not this engine's work."""
    body = F.to_json(F.struct(F.col("id").alias("custom_id"), F.struct(F.lit(model).alias("model"), F.array(F.struct(F.lit("user").alias("role"), F.concat_ws("\n", F.lit("Question:"), "question", F.lit("Reference:"), F.left("gold_passage", F.lit(most)), F.lit("Answer:"), "answer").alias("content"))).alias("messages")).alias("params")))
    return cases.select("id", body.alias("request"))


def judge_cost(rows: DataFrame, per_in: float, per_out: float) -> DataFrame:
    return rows.agg(F.round(F.sum(F.col("tokens_in") * per_in + F.col("tokens_out") * per_out) / 1e6, 6).alias("cost"))


def chosen_cases(cases: DataFrame, ids: list[str]) -> DataFrame:
    """The cases with these ids; an unknown id is an error (FLT-24)."""
    found = cases.where(F.col("id").isin(ids))
    unknown = sorted(set(ids) - {r.id for r in found.select("id").distinct().collect()})  # no more than were asked for
    if unknown:
        raise ValueError(f"no such case: {', '.join(unknown)}")
    return found
