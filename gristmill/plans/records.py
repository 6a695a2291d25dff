"""Queries of the record and benchmark builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import records as rec
from ..sources.readers import table
from .tables import docs, least_parts

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def _docs(spark, d):
    """Documents of a store: the source is the model; some state a value, some have figures."""
    k = F.col("doc_id")
    said = F.when(k % 4 == 0, F.concat(F.lit("\nHousing cover, tightening torque: "), (10 + k % 50).cast("string"), F.lit(" Nm"))).otherwise("")
    return docs(spark, d).select("doc_id", F.concat(F.lit("VCC-"), F.lpad(k.cast("string"), 6, "0")).alias("ref"), "title", F.concat("text", said).alias("text"), F.col("db").alias("model"), (2000 + k % 4).cast("string").alias("year"), F.lit(None).cast("string").alias("engine"), F.when(k % 5 == 0, F.array(F.concat(F.lit("fig"), k.cast("string")))).otherwise(F.expr("cast(array() as array<string>)")).alias("refs"))


def _vehicles(spark, d):
    """Each part is for two brands' vehicles."""
    p = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("part_number"), "p_brand", "p_size")
    return p.select("part_number", F.explode(F.array("p_brand", F.concat("p_brand", F.lit("x")))).alias("model"), (2000 + F.col("p_size") % 10).cast("string").alias("year"), F.lit(None).cast("string").alias("engine"))


def _pins(spark, d):
    n = table(spark, d, "nation")
    return n.select(F.col("n_name").alias("module"), F.lit("A").alias("connector"), F.col("n_nationkey").cast("string").alias("pin"), F.when(F.col("n_nationkey") % 5 > 0, F.concat(F.lit("feeds region "), F.col("n_regionkey").cast("string"))).alias("function"), F.lit("red").alias("wire_color"), F.lit("pins.csv").alias("source_file"), F.col("n_nationkey").alias("csv_line"))


def _said(rows):
    """What a record asks and answers."""
    asked = F.element_at(F.filter("messages", lambda m: m["role"] == "user"), 1)["content"]
    return rows.select(asked.alias("question"), F.element_at("messages", -1)["content"].alias("answer"), "split_key")


_D = "d as (select doc_id, 'VCC-' || lpad(doc_id::varchar, 6, '0') as ref, left(split_part(text, chr(10), 1), 80) as title, text || case when doc_id % 4 = 0 then chr(10) || 'Housing cover, tightening torque: ' || (10 + doc_id % 50)::varchar || ' Nm' else '' end as text, source as model, (2000 + doc_id % 4)::varchar as year from documents)"
_CAR = "'[VEHICLE] ' || year || ' ' || model || ' [/VEHICLE]' || chr(10)"
_HASH = "list_reduce(list_prepend(0::bigint, list_transform(string_split({}, ''), lambda c: ascii(c)::bigint)), lambda h, c: (h * 31 + c) % 4294967296)"
_TITLE = "coalesce(nullif(trim(title), ''), 'this component')"


@query(f"with {_D}, h as (select *, {_HASH.format('doc_id::varchar')} % 3 as k, (10 + doc_id % 50)::varchar as v from d where doc_id % 4 = 0) select {_CAR} || case k when 0 then 'What is the tightening torque for Housing cover?' when 1 then 'How tight does Housing cover go?' else 'Which torque do I use on Housing cover?' end as question, v || ' Nm (' || ref || ').' as answer, model || '|torque' as split_key from h")
def ds9_grounded_values(spark, d):
    return _said(rec.grounded_values(_docs(spark, d)))


@query("with p as (select p_partkey::varchar as part_number, p_name, p_brand, (2000 + p_size % 10)::varchar as year from part where p_partkey in (select l_partkey from lineitem)) select '[VEHICLE] ' || year || ' ' || p_brand || ' [/VEHICLE]' || chr(10) || 'What is part ' || part_number || '?' as question, part_number || ' is the ' || p_name || ' (this car).' as answer, p_brand || '|part' as split_key from p")
def ds9_grounded_parts(spark, d):
    return _said(rec.grounded_parts(least_parts(spark, d), _vehicles(spark, d)))


@query(f"with {_D}, q as (select *, left(trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')), 400) as quote from d where length(text) >= 120) select {_CAR} || 'How do I go about this: ' || {_TITLE} || '?' as question, 'See ' || ref || coalesce(' — ' || nullif(trim(title), ''), '') || ': ' || left(quote, 200) || case when length(quote) > 200 then '…' else '' end as answer, model || '|procedure' as split_key from q where length(trim(quote)) >= 30")
def ds9_grounded_procedures(spark, d):
    return _said(rec.grounded_procedures(_docs(spark, d)))


@query("select 'What does pin ' || n_nationkey::varchar || ' of ' || n_name || ' do?' as question, n_name || ' pin ' || n_nationkey::varchar || ': feeds region ' || n_regionkey::varchar || ', wire red (pins.csv:' || n_nationkey::varchar || ').' as answer, 'car|pinout' as split_key from nation where n_nationkey % 5 > 0")
def ds9_grounded_pins(spark, d):
    return _said(rec.grounded_pins(_pins(spark, d)))


@query(f"with {_D} select 'How tight is ' || {_TITLE} || '?' as question, case {_HASH.format('doc_id::varchar')} % 3 when 0 then '{rec.ELICITATIONS[0]}' when 1 then '{rec.ELICITATIONS[1]}' else '{rec.ELICITATIONS[2]}' end as answer, 'any|elicitation' as split_key from d where length(text) >= 120")
def ds9_elicitations(spark, d):
    return _said(rec.elicitations(_docs(spark, d)))


@query("with p as (select p_partkey::varchar as part_number, p_name, p_brand, (2000 + p_size % 10)::varchar as year from part where p_partkey in (select l_partkey from lineitem)) select '[VEHICLE] ' || year || ' ' || p_brand || ' [/VEHICLE]' || chr(10) || 'Does the ' || p_name || ' also fit the ' || year || ' ' || p_brand || 'x?' as question, 'Part ' || part_number || ' is listed for ' || year || ' ' || p_brand || 'x too; verify by VIN before you order.' as answer, p_brand || '|cross' as split_key from p")
def ds9_cross_vehicles(spark, d):
    return _said(rec.cross_vehicles(least_parts(spark, d), _vehicles(spark, d)))


@query(f"with {_D}, r as (select *, row_number() over w as n, lead(doc_id) over w as second from d where length(text) >= 120 window w as (partition by model order by doc_id)) select '[VEHICLE] ' || r.year || ' ' || r.model || ' [/VEHICLE]' || chr(10) || 'Where is it told: ' || trim(r.title) || '?' as question, 'In ' || s.ref || coalesce(' — ' || nullif(trim(s.title), ''), '') || '.' as answer, r.model || '|multi' as split_key from r join d s on s.doc_id = r.second where n % 2 = 1")
def ds9_multi_turns(spark, d):
    return _said(rec.multi_turns(_docs(spark, d)))


@query(f"with {_D} select {_CAR} || 'Show me the figure for ' || {_TITLE} || '.' as question, 'Here: fig' || doc_id::varchar || ' (' || ref || ').' as answer, model || '|figure' as split_key from d where doc_id % 5 = 0")
def ds9_figures(spark, d):
    return _said(rec.figures(_docs(spark, d)))


@query(f"with v as (select distinct source as model, (2000 + doc_id % 4)::varchar as year from documents where source is not null), a as (select unnest({rec.UNANSWERABLE!r}) as ask, unnest(range({len(rec.UNANSWERABLE)})) as n), q as (select *, ask || '{{\"model\":\"' || model || '\",\"year\":\"' || year || '\"}}' as seed from v, a) select '[VEHICLE] ' || year || ' ' || model || ' [/VEHICLE]' || chr(10) || ask as question, case {_HASH.format('seed')} % 3 when 0 then '{rec.REFUSALS[0].replace(chr(39), chr(39) * 2)}' when 1 then '{rec.REFUSALS[1]}' else '{rec.REFUSALS[2]}' end as answer, model || '|refusal-' || n::varchar as split_key from q")
def ds9_refusals(spark, d):
    return _said(rec.refusals(_docs(spark, d)))


def _made(spark, d):
    return rec.producers(_docs(spark, d), least_parts(spark, d), _vehicles(spark, d), _pins(spark, d))


@query("select * from (values ('grounded/part', 126), ('grounded/torque', 94), ('grounded/procedure', 78), ('grounded/pinout', 16), ('refusal/refusal', 68), ('elicitation/elicitation', 46), ('cross_vehicle/cross_vehicle', 46), ('multi_turn/multi_turn', 68), ('figure/figure', 28)) t(example_type, target)")
def ds4_producer_plan(spark, d):
    from ..operators import curation as cur

    return cur.producer_counts(spark, 570).select(F.concat_ws("/", "example_type", "answer_type").alias("example_type"), "target")


@query()
def ds8_report(spark, d):
    """DS-5, DS-7, DS-8: all nine producers filled to their quotas."""
    return rec.generate(spark, _made(spark, d), 570)[1]


@query()
def ds14_cases(spark, d):
    return rec.benchmark_cases(_made(spark, d), 20).select("id", "answer_type", "question", "gold", "split_key")


@query()
def ds15_frozen(spark, d):
    return rec.frozen_manifest(rec.benchmark_cases(_made(spark, d), 20))


@query("select doc_id, 'VCC-' || lpad(doc_id::varchar, 6, '0') || coalesce(' — ' || nullif(trim(left(split_part(text, chr(10), 1), 80)), ''), '') as citation from documents")
def prj11_citations(spark, d):
    return docs(spark, d).select("doc_id", tx.citation_of(F.concat(F.lit("VCC-"), F.lpad(F.col("doc_id").cast("string"), 6, "0")), F.col("doc_id").cast("string"), F.col("title")).alias("citation"))
