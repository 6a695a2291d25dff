"""Queries of graders, scorecards and gates; documents stand in for cases and answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import evaluation as ev
from ..operators import relational as rel
from ..sources.readers import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


KINDS = ("torque", "part_number", "procedure", "pinout", "figure", "refusal", "cross_vehicle")
#: Answers by doc_id % 9: each says one thing.
ANSWERS = ("It is 15 Nm (VCC-1234-1).", "The number is 30 650 014 (VCC-99).", "I couldn't find that. Which vehicle is it?", "Which car? It is 20 Nm.", "Pin four is ground, signal return for the lamp", "Please verify before use: 30650014.", "", "Nothing in the verified sources covers it.", "See VCC-5 for 12345678.")


def cases(spark, d):
    i = F.col("doc_id")
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (i % 7 + 1).cast("int"))
    return table(spark, d, "documents").select(i.alias("id"), kind.alias("answer_type"), F.when(i % 7 == 0, 15.0).alias("gold_value"), F.when((i % 7).isin(1, 6), "30650014").alias("gold_part"), F.when((i % 7).isin(0, 2, 4), F.when(i % 3 == 0, "VCC-5").otherwise("VCC-7")).alias("gold_doc_ref"), F.when(i % 7 == 3, "PIN four is ground, signal").alias("gold_text"), (i % 7 == 5).alias("expect_refusal"))


def answers(spark, d):
    i = F.col("doc_id")
    one = table(spark, d, "documents").where(i % 11 != 10).select(i.alias("id"), F.lit(1).alias("seq"), F.element_at(F.array(*map(F.lit, ANSWERS)), (i % 9 + 1).cast("int")).alias("answer"), F.array(F.lit(" vcc-5 "), F.lit("VCC-9")).alias("tool_refs"))
    return one.unionByName(one.where("id % 50 = 0").select("id", F.lit(0).alias("seq"), F.lit("older").alias("answer"), "tool_refs"))


_SAID = "(case doc_id % 9 " + " ".join("when {} then '{}'".format(i, a.replace("'", "''")) for i, a in enumerate(ANSWERS)) + " end)"
_GRADES_SQL = f"""g as (select doc_id as id, doc_id % 7 as k, case when doc_id % 11 = 10 then '' else {_SAID} end as a, doc_id % 11 = 10 as missing, doc_id from documents),
x as (select *, case when missing then false else doc_id % 3 = 0 end as hit, doc_id % 9 in (2, 7) and not missing as refused,
 doc_id % 9 = 0 and not missing as says15, doc_id % 9 in (1, 5) and not missing as says_part, doc_id % 9 = 4 and not missing as says_pin, doc_id % 9 = 5 and not missing as says_verify, doc_id % 9 = 8 and not missing and doc_id % 3 = 0 as says_ref from g),
grades as (select id, case when k = 0 then says15 end as torque_exact, case when k in (1, 6) then says_part end as part_number_exact, case when k in (0, 2) then hit end as retrieval_hit, case when k = 3 then says_pin when k = 6 then says_verify end as procedure_correct, case when k = 4 then hit or says_ref end as figure_correct, case when k = 5 then refused end as refusal_correct, case when k = 5 then not refused end as hallucinated, missing from x)"""
_CARD_SQL = "card as (" + " union all ".join(f"select '{m}' as metric, count(*) filter ({c}) as passed, count({c}) as n from grades" for m, c in ev.METRICS.items()) + "), rated as (select metric, passed, n, case when n > 0 then passed / n else 0.0 end as rate from card)"
_GATES_SQL = "gates(metric, threshold, higher) as (values " + ", ".join(f"('{m}', {t}::double, {str(h).lower()})" for m, (t, h) in ev.GATES.items()) + ")"


def _graded(spark, d):
    return ev.graded(cases(spark, d), answers(spark, d))


@query(f"with {_GRADES_SQL} select * from grades")
def ev1_grades(spark, d):
    return _graded(spark, d).select("id", "torque_exact", "part_number_exact", "retrieval_hit", "procedure_correct", "figure_correct", "refusal_correct", "hallucinated", "missing")


@query(f"with {_GRADES_SQL}, {_CARD_SQL} select metric, passed, n, round(rate, 9) as rate from rated")
def agg13_scorecard(spark, d):
    return ev.scorecard(_graded(spark, d)).withColumn("rate", F.round("rate", 9))


@query(f"with {_GRADES_SQL}, {_CARD_SQL}, {_GATES_SQL} select metric, threshold, round(rate, 9) as rate, n, n > 0 and case when higher then rate >= threshold else rate <= threshold end as passes from gates join rated using (metric)")
def ev5_gates(spark, d):
    return ev.gated(ev.scorecard(_graded(spark, d))).withColumn("rate", F.round("rate", 9))


@query(f"with {_GRADES_SQL}, {_CARD_SQL} select round(sum(case metric " + " ".join(f"when '{m}' then {w}" for m, w in ev.WEIGHTS.items()) + " end * case when metric = 'hallucination_rate' then 1 - rate else rate end), 6) as score from rated")
def ev6_champion(spark, d):
    return ev.champion_score(ev.scorecard(_graded(spark, d)))


@query("with r as (select lang as case_id, row_number() over (partition by lang order by doc_id) - 1 as pos, source from documents) select case_id, coalesce(min(case when source = 'src7' then pos end), 1000000000) as rank from r group by case_id")
def ev7_rank_of(spark, d):
    from pyspark.sql import Window

    r = table(spark, d, "documents").select(F.col("lang").alias("case_id"), (F.row_number().over(Window.partitionBy("lang").orderBy("doc_id")) - 1).alias("pos"), "source")
    return ev.rank_of(r, F.col("source") == "src7")


@query("select conv_id, turn, contains(lower(text), 'th') and not contains(lower(text), 'idiot') as ok from conversations")
def ev8_turns(spark, d):
    t = table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("answer"), F.array(F.lit("TH")).alias("must_mention"), F.array(F.lit("idiot")).alias("must_not_say"), F.array(F.lit("search")).alias("tools_used"), F.array(F.lit("search")).alias("tool_must_use"))
    return ev.turns_pass(t).select("conv_id", "turn", "ok")


@query("with x as (select case when doc_id % 4 > 0 then n_chars::double end as e, case when doc_id % 5 > 0 then n_chars + case when doc_id % 6 = 0 then 1.0 else 0.04 end end as v from documents), c as (select count(*) filter (e is not null and v is not null and abs(v - e) <= 0.05) as tp, count(v) as predicted, count(e) as actual from x) select tp, predicted, actual, round(tp / predicted, 4) as precision, round(tp / actual, 4) as recall from c")
def agg15_precision(spark, d):
    i, n = F.col("doc_id"), F.col("n_chars").cast("double")
    return ev.precision_recall(table(spark, d, "documents").select(F.when(i % 4 > 0, n).alias("expected"), F.when(i % 5 > 0, n + F.when(i % 6 == 0, 1.0).otherwise(0.04)).alias("value")))


@query("select doc_id as case_id, coalesce(min_by(how, how * 100 + pos), -1) as how from (select doc_id, 0 as how, doc_id % 3 as pos from documents where doc_id % 2 = 0 union all select doc_id, 1, 5 from documents where doc_id % 4 = 1) group by doc_id")
def jn20_resolved(spark, d):
    t = table(spark, d, "documents").select(F.col("doc_id").alias("case_id"))
    gold = t.select("case_id", F.concat(F.lit("d"), F.col("case_id").cast("string")).alias("doc_id"), F.lit("R").alias("ref"))
    a = t.where("case_id % 2 = 0").select("case_id", (F.col("case_id") % 3).alias("pos"), F.concat(F.lit("d"), F.col("case_id").cast("string")).alias("doc_id"), F.lit("Q").alias("ref"))
    b = t.where("case_id % 4 = 1").select("case_id", F.lit(5).cast("long").alias("pos"), F.lit("none").alias("doc_id"), F.lit("R").alias("ref"))
    return rel.resolved(gold, a.unionByName(b)).select("case_id", "how")


@query("select doc_id, doc_id % 9 in (2, 7) as declines, doc_id % 9 in (0, 3, 5, 8) as asserts from documents")
def str14_cues(spark, d):
    a = F.element_at(F.array(*map(F.lit, ("It is 15 Nm (VCC-1234-1).", "(VCC-99123456)", *ANSWERS[2:]))), (F.col("doc_id") % 9 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", tx.declines(a).alias("declines"), tx.asserts_value(a).alias("asserts"))


@query()
def ev9_judge_requests(spark, d):
    t = table(spark, d, "documents").select(F.col("doc_id").alias("id"), tx.title_of(F.col("text")).alias("question"), F.col("text").alias("gold_passage"), F.lit("yes").alias("answer"))
    return ev.judge_requests(t, "a-model")
