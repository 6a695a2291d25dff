"""Queries of the curation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsers
from ..functions import text as tx
from ..operators import curation as cur
from ..operators import relational as rel
from ..sources.readers import table
from .tables import DOCS_SQL, EDGES_SQL, PROFILES_SQL, docs, edges, profiles

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def _records(spark, d):
    t = table(spark, d, "documents")
    return t.select(F.col("doc_id").alias("record_id"), F.col("doc_id").alias("seq"), cur.split_key(F.nullif("lang", F.lit("es")), "topic").alias("split_key"), F.array(F.col("source"), F.col("doc_id").cast("string")).alias("source_ids"), F.length("text").alias("chars"), F.sha1("text").alias("hash"), "lang")


_RECORDS_SQL = "r as (select doc_id as record_id, doc_id as seq, coalesce(nullif(lang, 'es'), '?') || '|topic' as split_key, [source, doc_id::varchar] as source_ids, length(text) as chars, sha1(text) as hash, lang from documents)"


@query(f"with {_RECORDS_SQL} select record_id, split_key from r where split_key not in ('de|topic') and not list_has_any(source_ids, ['src3', '17', '40'])")
def flt21_without_leaks(spark, d):
    keys = spark.createDataFrame([("de|topic",)], "split_key string")
    ids = spark.createDataFrame([("src3",), ("17",), ("40",)], "source_id string")
    return cur.without_leaks(_records(spark, d), keys, ids).select("record_id", "split_key")


@query(f"with {_RECORDS_SQL} select floor(chars / 3.5) <= 500 as kept, count(*) as n from r group by all")
def flt20_length(spark, d):
    r = _records(spark, d)
    return r.groupBy((tx.estimated_tokens(F.col("chars")) <= 500).alias("kept")).agg(F.count(F.lit(1)).alias("n"))


@query("select * from (values ('grounded', 314), ('refusal', 68), ('elicitation', 46), ('cross_vehicle', 46), ('multi_turn', 68), ('figure', 28)) t(example_type, target)")
def ds4_plan(spark, d):
    return cur.plan_counts(spark, 570)


@query("with r as (select lang, doc_id, row_number() over (partition by lang order by doc_id) as n, lead(doc_id) over (partition by lang order by doc_id) as second from documents) select lang, doc_id as first, second from r where n % 2 = 1 and second is not null")
def ds6_pairs(spark, d):
    return cur.paired(table(spark, d, "documents").select("lang", "doc_id"), "lang")


@query(f"""with {_RECORDS_SQL},
a as (select * from (select *, row_number() over (partition by hash order by seq) as k from r where lang = 'en' and floor(chars / 3.5) <= 4096) where k = 1 order by seq limit 100),
b as (select * from (select *, row_number() over (partition by hash order by seq) as k from r where lang in ('en', 'de') and floor(chars / 3.5) <= 4096 and hash not in (select hash from a)) where k = 1 order by seq limit 80)
select record_id, hash from a union all select record_id, hash from b""")
def ds7_filled(spark, d):
    r = _records(spark, d)
    return cur.filled([(r.where("lang = 'en'"), 100), (r.where("lang in ('en', 'de')"), 80)], F.col("chars"), F.lit(True)).select("record_id", "hash")


@query(f"with e as ({EDGES_SQL}), p as ({PROFILES_SQL}), r as (select doc_id, profile_id, model, row_number() over (partition by doc_id order by (model is not distinct from 'NATION_4') desc, model, year nulls last, engine nulls last, profile_id) as k from e join p using (profile_id) where model is not null) select doc_id, profile_id, model from r where k = 1")
def ds2_coherent_vehicle(spark, d):
    return cur.coherent_vehicle(edges(spark, d), profiles(spark, d), "NATION_4").select("doc_id", "profile_id", "model")


@query("with h as (select source, list_reduce(list_prepend(0::bigint, list_transform(string_split(source, ''), lambda c: ascii(c)::bigint)), lambda h, c: (h * 31 + c) % 4294967296) as h from (select distinct source from documents)) select source, ['first', 'second', 'third'][(h % 3 + 1)::int] as wording from h")
def ds12_wording(spark, d):
    return table(spark, d, "documents").select("source").distinct().select("source", tx.pick(["first", "second", "third"], F.col("source")).alias("wording"))


@query("with c as (select conv_id, list(role order by turn) as roles, arg_max(role, turn) as last_role, arg_max(text, turn) as last_text from conversations group by conv_id) select conv_id, roles[1] = 'system' as system_first, last_role = 'assistant' and coalesce(last_text, '') <> '' as answer_last from c")
def flt22_contract_ends(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    bad = cur.problems(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"), F.lit(None).cast(cur.TOOL_CALL).alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"))), ("search_docs",))
    return c.select("conv_id", (~F.array_contains(bad, "no system message first")).alias("system_first"), (~F.array_contains(bad, "no answer last")).alias("answer_last"))


@query("select doc_id, concat_ws(';', case when doc_id % 7 = 0 then 'arguments not JSON' end, case when doc_id % 5 = 0 then 'answer to unknown call;unanswered calls' end, case when coalesce(text, '') = '' then 'no answer last' end) as problems from documents")
def flt22_contract(spark, d):
    """FLT-22, DS-11: whole records, with a tool call, checked by the fold."""
    t = table(spark, d, "documents")
    call = F.concat(F.lit("c"), F.col("doc_id").cast("string"))
    answer_to = F.when(F.col("doc_id") % 5 == 0, F.lit("other")).otherwise(call)
    messages = F.array(cur.message("system", F.lit("s")), cur.message("user", tx.title_of(F.col("text"))), cur.message("assistant", calls=cur.tool_call(call, "search_docs", F.when(F.col("doc_id") % 7 == 0, "{").otherwise('{"query": "x"}'))), cur.message("tool", F.lit("[]"), call_id=answer_to), cur.message("assistant", F.col("text")))
    return t.select("doc_id", F.array_join(cur.problems(messages, ("search_docs", "get_document")), ";").alias("problems"))


@query("select doc_id as record_id, sha1(text) as hash from documents")
def srt11_shuffled(spark, d):
    return cur.shuffled(_records(spark, d).select("record_id", "hash"))


@query(f"with {_RECORDS_SQL}, p as (select * from (values ('en', 500), ('de', 200), ('xx', 5)) t(example_type, target)), g as (select lang as example_type, count(*) as produced from r group by all) select example_type, target, coalesce(produced, 0) as produced, coalesce(produced, 0) < target as short from p left join g using (example_type)")
def agg19_shortfall(spark, d):
    plan = spark.createDataFrame([("en", 500), ("de", 200), ("xx", 5)], "example_type string, target int")
    return cur.shortfall(_records(spark, d).withColumnRenamed("lang", "example_type"), plan)


#: Lines of our own, with the component and the value that they state.
SPEC_LINES = [
    ("| Flywheel to crankshaft | M10 | 45 Nm |", "Flywheel to crankshaft M10", 45.0),
    ("| Sump bolt 17 Nm |", "Sump bolt", 17.0),
    ("| *Engine_mount, front* (NOTE! renew) | 50 Nm |", "Engine_mount, front", 50.0),
    ("| Hub nut | 30 Nm | 90 Nm |", None, None),
    ("| Same stage twice | 30 Nm | 30 Nm |", "Same stage twice", 30.0),
    ("| 12 Nm |", None, None),
    ("Coolant pump, tightening torque: 10,5 Nm", "Coolant pump", 10.5),
    ("The torque is 24 Nm for all screws", None, None),
    ("Knock sensor torque - 20 N·m", "Knock sensor", 20.0),
    ("Now tighten the caliper guide pins to 28 Nm.", "Now", 28.0),
    ("Tighten crosswise to 9 Nm, then check.", "fastener", 9.0),
    ("The values stand in VCC-300412-2.", None, None),
    ("A rope of 30 Nm is not a thing.", None, None),
]


@query("select * from (values " + ", ".join(f"({i}, {'null' if c is None else repr(c)}, {'null::double' if v is None else v})" for i, (_, c, v) in enumerate(SPEC_LINES)) + ") t(id, component, value)")
def str7_spec_values(spark, d):
    rows = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(SPEC_LINES)], "id int, text string")
    first = F.try_element_at(parsers.parse_specs("text"), F.lit(1))
    return rows.select("id", first["component"].alias("component"), first["value"].alias("value"))


@query(f"with d as ({DOCS_SQL}) select doc_id, case when trim(title) = '' then 'this component' else trim(title) end as topic from d")
def prj19_topic(spark, d):
    """PRJ-19: each title behind one of the verbs, or alone."""
    verb = F.element_at(F.array(F.lit("Replacing "), F.lit(""), F.lit("Checking - "), F.lit("Replacement of ")), (F.col("doc_id") % 4 + 1).cast("int"))
    return docs(spark, d).select("doc_id", tx.topic_of(F.concat(verb, "title")).alias("topic"))


@query(f"with e as ({EDGES_SQL}), p as ({PROFILES_SQL}) select concat_ws(' | ', nullif(concat_ws(' ', year, model), ''), 'engine ' || engine) as label, count(*) as n from e join p using (profile_id) group by all")
def prj18_labels(spark, d):
    p = edges(spark, d).join(profiles(spark, d), "profile_id")
    return p.groupBy(cur.vehicle_label(F.col("year"), F.col("model"), F.col("engine")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query()
def jn22_sibling(spark, d):
    return rel.sibling(profiles(spark, d), "E0", ["NATION_4"])
