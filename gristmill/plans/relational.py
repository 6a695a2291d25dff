"""Queries of scans, filters, joins, aggregations, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import relational as rel
from ..operators import synonyms as syn
from ..operators import tools
from ..sources.readers import table
from ..sources.sinks import canonical, content_hash
from .tables import DOCS_SQL, EDGES_SQL, PARTS_SQL, PROFILES_SQL, docs, edges, least_parts, parts, profiles, store

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


@query("select p_partkey, p_name from part where p_brand = 'Brand#11' or p_name ilike 'a%'")
def flt1_flt3_equality_prefix(spark, d):
    p = table(spark, d, "part")
    return p.where((F.col("p_brand") == "Brand#11") | F.col("p_name").ilike("a%")).select("p_partkey", "p_name")


@query("select c_custkey from customer where upper(c_mktsegment) = 'BUILDING'")
def flt2_case_folded(spark, d):
    return table(spark, d, "customer").where(F.upper("c_mktsegment") == "BUILDING").select("c_custkey")


@query("select p_partkey from part where p_name ilike '%re%' or p_brand ilike '%3%' or p_type ilike '%tin%'")
def flt4_flt5_infix(spark, d):
    p = table(spark, d, "part")
    return p.where(F.col("p_name").ilike("%re%") | F.col("p_brand").ilike("%3%") | F.col("p_type").ilike("%tin%")).select("p_partkey")


_STATED = "select doc_id, case when doc_id % 3 = 0 then 'Tightening torque' else left(split_part(text, chr(10), 1), 80) end as title, text || case when doc_id % 4 = 0 then ' Tighten to 5 Nm.' else '' end as text, case when doc_id % 5 > 0 then 'VCC' end as ref from documents"


@query(f"with t as ({_STATED}) select doc_id from t where (title = 'Tightening torque' or text like '%Tighten to %Nm%') and ref is not null")
def flt6_stated(spark, d):
    k = F.col("doc_id")
    t = docs(spark, d).select("doc_id", F.when(k % 3 == 0, "Tightening torque").otherwise(F.col("title")).alias("title"), F.concat("text", F.when(k % 4 == 0, " Tighten to 5 Nm.").otherwise("")).alias("text"), F.when(k % 5 > 0, "VCC").alias("ref"))
    return t.where(rel.states_values(F.col("title"), F.col("text"), F.col("ref"))).select("doc_id")


@query(f"with t as ({DOCS_SQL}) select doc_id, case when doc_id % 2 = 0 and trim(title) <> '' then title when text <> '' and left(split_part(text, chr(10), 1), 80) <> '' then section || ': ' || left(split_part(text, chr(10), 1), 80) else 'VCC' end as title from t")
def prj8_titled(spark, d):
    return docs(spark, d).select("doc_id", rel.titled(F.when(F.col("doc_id") % 2 == 0, F.col("title")), F.col("section"), F.col("text"), F.lit("VCC")).alias("title"))


@query("select doc_id from documents where text not like '%,%' and length(text) > 200 and (text ilike 'th%' or text ilike 'in%')")
def flt6_flt7_compound(spark, d):
    t = table(spark, d, "documents")
    return t.where(~F.contains("text", F.lit(",")) & (F.length("text") > 200) & (F.col("text").ilike("th%") | F.col("text").ilike("in%"))).select("doc_id")


@query("select doc_id, list_contains(string_split(replace(coalesce(lang || ', ' || source, ''), ' ', ''), ','), 'src1') as has from documents")
def flt10_list_member(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.list_has(F.concat_ws(", ", "lang", "source"), "src1").alias("has"))


@query(f"with p as ({PROFILES_SQL}) select profile_id from p where (model is null or model = 'NATION_4') and (year is null or year = '2002' or engine = 'E0') and (engine is null or engine = 'E0') and not (model is null and year is null and engine is null)")
def flt11_ancestors(spark, d):
    return rel.ancestors(profiles(spark, d), "NATION_4", "2002", "E0").select("profile_id")


@query("select o_orderkey from orders where o_orderstatus = 'O' and o_totalprice > 100000")
def flt12_optional(spark, d):
    return table(spark, d, "orders").where(rel.only([F.col("o_orderstatus") == "O", None, F.col("o_totalprice") > 100000])).select("o_orderkey")


@query("select page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+(e|s))\"', 1)) as path from pages")
def flt14_extensions(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]+(e|s))"'), F.lit(1))).alias("path"))


@query(f"with p as ({PROFILES_SQL}) select profile_id, concat_ws(', ', model, year, engine) as description, (model is not null)::int + (year is not null)::int + (engine is not null)::int as folder_level from p")
def prj4_described(spark, d):
    return rel.described(profiles(spark, d)).select("profile_id", "description", "folder_level")


@query("select 'documents:' || lang || ':' || doc_id::varchar as id, left(split_part(text, chr(10), 1), 80) as title, coalesce(nullif(trim(lang), ''), source, '') as section from documents")
def prj3_prj8_ids_titles(spark, d):
    t = table(spark, d, "documents")
    return t.select(tx.surrogate_id(F.lit("documents"), F.col("lang"), F.col("doc_id")).alias("id"), tx.title_of(F.col("text")).alias("title"), F.coalesce(tx.blank_to_null(F.col("lang")), "source", F.lit("")).alias("section"))


@query("with t as (select conv_id, text, min(turn) as seq from conversations group by conv_id, text), r as (select *, row_number() over (partition by conv_id order by seq, text) as k from t) select conv_id as doc_id, string_agg(text, ' | ' order by seq, text) as breadcrumb from r where k <= 4 group by conv_id")
def prj6_breadcrumbs(spark, d):
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("seq"), F.col("text").alias("title"))
    return rel.breadcrumbs(c)


@query("with l as (select l_suppkey as section_id, 'S' || l_suppkey::varchar as section_title, l_orderkey * 10 + l_linenumber as seq, p_partkey::varchar as part_number, p_name as description, (l_quantity % 3)::int as qty, 4 + l_linenumber % 2 as type_id from lineitem join part on l_partkey = p_partkey) select section_id, '# ' || section_title || chr(10) || string_agg(line, chr(10) order by seq, line) as text from (select *, '- ' || part_number || ' ' || description || case when qty <> 1 then ' (qty ' || qty::varchar || ')' else '' end || case when type_id = 5 then ' [non-stocked]' else '' end as line from l) group by section_id, section_title")
def prj9_section_documents(spark, d):
    li = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = li.select(F.col("l_suppkey").alias("section_id"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("section_title"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("p_partkey").cast("string").alias("part_number"), F.col("p_name").alias("description"), (F.col("l_quantity") % 3).cast("int").alias("qty"), (4 + F.col("l_linenumber") % 2).alias("type_id"))
    return rel.section_documents(rows)


@query("select doc_id, case when length(text) <= 160 then text else regexp_replace(left(text, 160), ',[^,]*$', '', 's') || ' (+' || (length(text) - length(replace(text, ',', '')) - (length(regexp_replace(left(text, 160), ',[^,]*$', '', 's')) - length(replace(regexp_replace(left(text, 160), ',[^,]*$', '', 's'), ',', ''))))::varchar || ' more)' end as short from documents")
def prj12_shortened(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.shorten_list(F.col("text")).alias("short"))


@query("select doc_id, substr(text, 501, 800) as text, length(text) as text_length, length(text) > 1300 as truncated, coalesce(case when length(text) > 1300 then 1300 end, -1) as next_offset from documents")
def prj13_paging(spark, d):
    cols = tx.page(F.col("text"), 500, 800)
    return table(spark, d, "documents").select("doc_id", *cols[:3], F.coalesce(F.when(F.length("text") > 1300, F.lit(1300).cast("long")), F.lit(-1)).alias("next_offset"))


@query(f"with d as ({DOCS_SQL}) select doc_id, trim(coalesce(trim(title), '') || chr(10) || left(text, 6000)) as input, coalesce(nullif(trim(split_part(text, ',', 1)), ''), '') as first_token from d")
def prj15_prj16_inputs(spark, d):
    return docs(spark, d).select("doc_id", F.trim(F.concat(F.trim("title"), F.lit("\n"), F.left("text", F.lit(6000)))).alias("input"), F.coalesce(tx.first_of_list(F.col("text")), F.lit("")).alias("first_token"))


@query("select n_name, r_name, c_custkey from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey")
def jn1_dimension_chain(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_name", "r_name", "c_custkey")


_LEX_SQL = "select doc_id as description_id, case when lang = 'en' then 'us' else 'gb' end as language, text from documents"


@query(f"with l as ({_LEX_SQL}) select doc_id, coalesce(u.text, g.text) as text from labels left join (select * from l where language = 'us') u on doc_id = u.description_id left join (select * from l where language = 'gb') g on doc_id = g.description_id")
def jn4_localised(spark, d):
    lex = table(spark, d, "documents").select(F.col("doc_id").alias("description_id"), F.when(F.col("lang") == "en", "us").otherwise("gb").alias("language"), "text")
    return rel.localised(table(spark, d, "labels").select(F.col("doc_id").alias("description_id")), lex).select(F.col("description_id").alias("doc_id"), "text")


@query("select l_orderkey, l_linenumber, p_name from lineitem join part on l_partkey = p_partkey where p_size in (4, 5)")
def jn5_jn7_inner(spark, d):
    return table(spark, d, "lineitem").join(table(spark, d, "part").where(F.col("p_size").isin(4, 5)), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_name")


@query(f"with e as ({EDGES_SQL}), p as ({PROFILES_SQL}), t as (select doc_id, list_sort(list(profile_id)) as ids, string_agg(distinct model, ',' order by model) as models, string_agg(distinct year, ',' order by year) as years, string_agg(distinct engine, ',' order by engine) as engines from e join p using (profile_id) group by doc_id) select d.doc_id, coalesce('[' || array_to_string(list_transform(ids, lambda x: '\"' || x || '\"'), ',') || ']', '[]') as profile, coalesce(models, '') as models, coalesce(years, '') as years, coalesce(engines, '') as engines from documents d left join t using (doc_id)")
def agg2_snk6_tags(spark, d):
    out = rel.denormalised_tags(table(spark, d, "documents").select("doc_id"), edges(spark, d), profiles(spark, d))
    return out.select("doc_id", "profile", *(F.coalesce(c, F.lit("")).alias(c) for c in ("models", "years", "engines")))


@query(f"with pp as ({PARTS_SQL}), e as ({EDGES_SQL}), p as ({PROFILES_SQL}) select distinct part_number, model, coalesce(year, '') as year, coalesce(engine, '') as engine from pp join e on section_id = doc_id join p using (profile_id) where model is not null")
def jn11_part_vehicles(spark, d):
    p = parts(spark, d).join(edges(spark, d).withColumnRenamed("doc_id", "section_id"), "section_id").join(profiles(spark, d), "profile_id").where("model is not null")
    return p.select("part_number", "model", F.coalesce("year", F.lit("")).alias("year"), F.coalesce("engine", F.lit("")).alias("engine")).distinct()


@query("select doc_id from documents where doc_id in (select doc_id from labels)")
def jn12_semi(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left_semi").select("doc_id")


@query("select doc_id, case when not exists (select 1 from labels l where l.doc_id = d.doc_id) then 'not vehicle-specific' when exists (select 1 from labels l where l.doc_id = d.doc_id and quality = 1) then 'this car' else 'other vehicles' end as scope from documents d")
def jn13_scopes(spark, d):
    t, l_ = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels")
    return rel.scope_labels(t, l_.where("quality = 1"), t.join(l_, "doc_id", "left_anti"))


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def jn14_generic(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left_anti").select("doc_id")


@query("select s_suppkey from supplier where s_suppkey not in (select c_custkey from customer where c_custkey % 3 = 0)")
def jn15_missing(spark, d):
    c = table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("s_suppkey"))
    return rel.missing_rows(table(spark, d, "supplier"), c, ["s_suppkey"]).select("s_suppkey")


@query("with s as (select doc_id, left(sha1(text), 16) as h from documents where doc_id % 10 <> 3), l as (select doc_id, left(sha1(case when doc_id % 7 = 0 then text || 'x' else text end), 16) as h from documents where doc_id % 10 <> 4) select coalesce(s.doc_id, l.doc_id) as doc_id, case when l.h is null then 'new' when s.h is null then 'vanished' when s.h = l.h then 'unchanged' else 'changed' end as status from s full join l on s.doc_id = l.doc_id")
def jn16_incremental(spark, d):
    t = table(spark, d, "documents")
    new = t.where("doc_id % 10 <> 3").select("doc_id", rel.content_hash(F.col("text")).alias("hash"))
    old = t.where("doc_id % 10 <> 4").select("doc_id", rel.content_hash(F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))).alias("hash"))
    return rel.incremental(new, old)


@query("select doc_id, text from (select doc_id, text from documents where doc_id not in (select doc_id from benchmark_docs) union all select doc_id, text from benchmark_docs)".replace("benchmark_docs", "(select item_id as doc_id, text from benchmark)"))
def snk3_upsert(spark, d):
    new = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return rel.upsert(table(spark, d, "documents").select("doc_id", "text"), new, ["doc_id"])


@query("select doc_id, lang from documents union all select item_id + 990, 'xx' from benchmark where item_id + 990 not in (select doc_id from documents)")
def snk4_insert_absent(spark, d):
    new = table(spark, d, "benchmark").select((F.col("item_id") + 990).alias("doc_id"), F.lit("xx").alias("lang"))
    return rel.insert_absent(table(spark, d, "documents").select("doc_id", "lang"), new, ["doc_id"])


@query("select source as db, lang as section, count(*) as n from documents group by all order by n desc")
def agg3_agg4_counts(spark, d):
    return table(spark, d, "documents").groupBy(F.col("source").alias("db"), F.col("lang").alias("section")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with p as ({PARTS_SQL}) select part_number, arg_min(description, section_id) as description, min(section_id) as section_id, min(section_title) as section_title from p where part_number not in ('', 'ns') and trim(description) <> '' group by part_number")
def agg5_parts(spark, d):
    return rel.parts_list(least_parts(spark, d))


@query("select distinct c_mktsegment, c_nationkey from customer order by c_mktsegment, c_nationkey limit 20")
def agg6_distinct_top(spark, d):
    return table(spark, d, "customer").select("c_mktsegment", "c_nationkey").distinct().orderBy("c_mktsegment", "c_nationkey").limit(20)


@query("select sum(length(text))::bigint as total, max(doc_id) as top, coalesce(max(case when doc_id < 0 then doc_id end), 0) as none from documents")
def agg11_sums(spark, d):
    return table(spark, d, "documents").agg(F.sum(F.length("text")).cast("long").alias("total"), F.max("doc_id").alias("top"), F.coalesce(F.max(F.when(F.col("doc_id") < 0, F.col("doc_id"))), F.lit(0)).alias("none"))


@query("with r as (select *, row_number() over (partition by p_name order by p_size, p_partkey) as k from part) select p_name, p_partkey, p_size from r where k = 1")
def agg12_best_of_group(spark, d):
    return rel.best_of(table(spark, d, "part"), ["p_name"], [F.col("p_size"), F.col("p_partkey")]).select("p_name", "p_partkey", "p_size")


@query("select p_partkey, p_brand, coalesce(try_cast(nullif(regexp_extract(p_type, '^\\s*(-?\\d{1,9})', 1), '') as int), 0) as n, coalesce(try_cast(nullif(regexp_extract(split_part(p_brand, '#', 2), '^\\s*(-?\\d{1,9})', 1), '') as int), 0) as brand_no from part")
def srt3_leading_int(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_brand", tx.leading_int(F.col("p_type")).alias("n"), tx.leading_int(F.substring_index("p_brand", "#", -1)).alias("brand_no"))


@query("select doc_id, lang from documents order by (lang = 'de') desc, doc_id limit 12")
def srt2_boolean_sort(spark, d):
    return table(spark, d, "documents").orderBy(F.desc(F.col("lang") == "de"), "doc_id").limit(12).select("doc_id", "lang")


@query("select doc_id from labels where quality = 1 union select doc_id from labels where toxic = 1 union select doc_id from documents where lang = 'es'")
def set1_set2_unions(spark, d):
    l_ = table(spark, d, "labels")
    return l_.where("quality = 1").select("doc_id").union(l_.where("toxic = 1").select("doc_id")).union(table(spark, d, "documents").where("lang = 'es'").select("doc_id")).distinct()


@query("with a as (select doc_id, list_distinct(string_split(lang || ',' || source || ',x', ',')) as l from documents) select doc_id, len(l) as n, list_contains(l, 'x') and list_contains(l, 'en') as both_in from a")
def set4_set7_arrays(spark, d):
    a = F.array_distinct(F.split(F.concat_ws(",", "lang", "source", F.lit("x")), ","))
    return table(spark, d, "documents").select("doc_id", F.size(a).cast("long").alias("n"), (F.size(F.array_intersect(a, F.array(F.lit("x"), F.lit("en")))) == 2).alias("both_in"))


@query("select doc_id, left(sha1(text), 16) as h16, sha256(text) as h256 from documents")
def fn5_fn7_hashes(spark, d):
    return table(spark, d, "documents").select("doc_id", rel.content_hash(F.col("text")).alias("h16"), F.sha2("text", 256).alias("h256"))


@query("select doc_id, round_even(n_chars / 8.0, 0) as half_even, ln(1 + n_chars) as ln_ from documents".replace("ln(1 + n_chars)", "round(ln(1 + n_chars), 9)"))
def fn2_fn3_math(spark, d):
    return table(spark, d, "documents").select("doc_id", F.bround(F.col("n_chars") / 8.0).alias("half_even"), F.round(F.log(1 + F.col("n_chars")), 9).alias("ln_"))


@query("select source, list_reduce(list_prepend(0::bigint, list_transform(string_split(source, ''), lambda c: ascii(c)::bigint)), lambda h, c: (h * 31 + c) % 4294967296) as h from (select distinct source from documents)")
def fn8_poly_hash(spark, d):
    return table(spark, d, "documents").select("source").distinct().select("source", tx.poly_hash(F.col("source")).alias("h"))


@query("select event_id, json_valid(props) as valid from events")
def fn10_json_valid(spark, d):
    return table(spark, d, "events").select("event_id", F.try_parse_json("props").isNotNull().alias("valid"))


@query(f"with tagged as (select distinct doc_id as section_id from ({EDGES_SQL})), mine as (select distinct doc_id as section_id from ({EDGES_SQL}) join ({PROFILES_SQL}) using (profile_id) where engine is null and (model is not null or year is not null)), p as ({PARTS_SQL}), r as (select part_number, section_id, case when section_id not in (from tagged) then 1 when section_id in (from mine) then 0 else 2 end as scope_rank from p where description ilike '%e%') select part_number, section_id, ['this car', 'not vehicle-specific', 'other vehicles'][scope_rank + 1] as scope from (select *, row_number() over (partition by part_number order by scope_rank, section_id) as k from r) where k = 1 order by scope_rank, part_number limit 20")
def ft24_epc_part(spark, d):
    s = store(spark, d)
    s.tables |= {"section_profiles": edges(spark, d).withColumnRenamed("doc_id", "section_id"), "profiles": profiles(spark, d)}
    return tools.epc_part(s, component="e").select("part_number", "section_id", "scope")


@query("select p_brand as module, p_partkey::varchar as pin from part where upper(p_brand) = 'BRAND#11' order by p_brand, p_partkey limit 50")
def ft24_lookup_pin(spark, d):
    s = store(spark, d)
    pins = table(spark, d, "part").select(F.col("p_brand").alias("module"), F.lit("B").alias("connector"), F.col("p_partkey").cast("string").alias("pin"), F.col("p_name").alias("function"), F.lit("x").alias("goes_to"), F.lit(None).cast("string").alias("notes"))
    s.tables |= {"pins": pins, "components": spark.createDataFrame([("x", "a component")], "component_id string, description string")}
    return tools.lookup_pin(s, module="brand#11", limit=50).select("module", "pin")


def _lexicon(spark, d):
    k, t = F.col("p_partkey"), F.col("p_name")
    p = table(spark, d, "part").select(k.alias("description_id"), t.alias("us"), F.regexp_replace(F.regexp_replace(t, "[aeiou](?=[a-z]* )", "u"), "part", "piece").alias("gb"))
    return p.select("description_id", F.lit("us").alias("language"), F.col("us").alias("text")).unionByName(p.select("description_id", F.lit("gb").alias("language"), F.col("gb").alias("text")))


@query()
def agg8_agg9_mined_words(spark, d):
    return syn.mined_words(_lexicon(spark, d))


@query()
def str10_mined_phrases(spark, d):
    return syn.mined_phrases(_lexicon(spark, d))


@query()
def snk10_canonical(spark, d):
    return canonical(table(spark, d, "labels"))


@query()
def snk10_content_hash(spark, d):
    return content_hash(table(spark, d, "labels"))
