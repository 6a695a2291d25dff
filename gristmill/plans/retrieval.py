"""Queries of full-text, vector, fusion and figure operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import parsers
from ..functions import text as tx
from ..operators import figures as fg
from ..operators import fulltext as ft
from ..operators import index as inv
from ..operators import relational as rel
from ..operators import tools
from ..operators import vectors as vec
from ..sources.readers import Vehicle, table
from ..sources.stored import shared_folder, stored
from .tables import DOCS_SQL, TOKENS_SQL, docs, store

QUERY = "the nation intake"
PHRASES = [p for p in ft.compile_query(QUERY).phrases]
SEARCH = ft.compile_query("with thanes reth")


def _line_sql(c: str) -> str:
    return f"' ' || array_to_string({TOKENS_SQL.format(c)}, '  ') || ' '"


def _bm25_sql(query: ft.Query, relaxed: bool) -> str:
    """BM25 in SQL, stated on its own: hits by text replacement on token lines."""
    ps = query.phrases
    hit = lambda line, p: f"((length({line}) - length(replace({line}, ' {'  '.join(p.split())} ', ''))) // {len(' ' + '  '.join(p.split()) + ' ')})"
    fs = ", ".join(f"8.0 * {hit('tl', p)} + {hit('bl', p)} as f{i}" for i, p in enumerate(ps))
    dfs = ", ".join(f"count(*) filter (f{i} > 0) as d{i}" for i in range(len(ps)))
    score = " + ".join(f"greatest(1e-6, ln((n - d{i} + 0.5) / (d{i} + 0.5))) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * dl / avgdl))" for i in range(len(ps)))
    groups = [[ps.index(tx.index_phrase(a)) for a in g if tx.index_phrase(a)] for g in query.groups.values()]
    word = " or " if relaxed else " and "
    where = word.join("(" + " or ".join(f"f{i} > 0" for i in g) + ")" for g in groups)
    return f"""with d as ({DOCS_SQL}),
l as (select *, {_line_sql('title')} as tl, {_line_sql('text')} as bl, len({TOKENS_SQL.format('title')}) + len({TOKENS_SQL.format('text')}) as dl from d),
h as (select *, {fs} from l), s as (select count(*) as n, avg(dl) as avgdl, {dfs} from h),
m as (select doc_id, title, text, -({score}) as rank from h, s where {where})"""


def p0_ranked_search(spark, d):
    """FT-5, FT-7, SRT-1: the eight best documents."""
    rows = ft.top_k(ft.bm25(docs(spark, d), SEARCH, relaxed=True), "rank", 8)
    return rows.select("doc_id", F.round("rank", 6).alias("rank"))


def ft7_bm25_strict(spark, d):
    return ft.bm25(docs(spark, d), SEARCH).select("doc_id", F.round("rank", 6).alias("rank"))


def ft7_indexed(spark, d):
    """SNK-7, JN-9: the same ranks from a stored index, without the texts."""
    path = f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    inv.build(docs(spark, d), path)
    return inv.search(spark, path, SEARCH).select("doc_id", F.round("rank", 6).alias("rank"))


def ft6_token_counts(spark, d):
    """FT-6, AGG-10: in how many documents each token stands."""
    words = docs(spark, d).select("doc_id", F.explode(F.array_distinct(tx.tokens(F.col("text")))).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def ft11_rerank(spark, d):
    rows = ft.reranked(ft.bm25(docs(spark, d), SEARCH, relaxed=True), SEARCH)
    return ft.top_k(rows, "adj", 30).select("doc_id", F.round("adj", 6).alias("adj"))


def ft8_penalties(spark, d):
    rows = ft.penalised(ft.bm25(docs(spark, d), SEARCH, relaxed=True), [(F.col("section") == "de", 6.0), (F.col("db") == "src1", 1.5)])
    return ft.top_k(rows, "rank", 30).select("doc_id", F.round("rank", 6).alias("rank"))


def ft10_relaxed_tier(spark, d):
    rows = ft.relaxed_tier(docs(spark, d), SEARCH)
    return rows.select("doc_id", "strict", F.round("rank", 6).alias("rank"))


def ft12_blended(spark, d):
    # thirty rows, stored, as the blend looks at them several times: else each look scans all texts
    base = stored(ft.reranked(ft.top_k(ft.bm25(docs(spark, d), SEARCH, relaxed=True), "rank", 30), SEARCH).select("doc_id", "section", "adj"), "base")
    return ft.blended(base.where("section = 'en'"), base, 10).select("pos", "doc_id", "tier")


def ft14_nearest(spark, d):
    v = table(spark, d, "embeddings")
    q = list(v.where("vec_id = 0").first().embedding)
    return vec.nearest(v.where("vec_id <> 0"), q).select("vec_id", F.round("dist", 5).alias("dist"))


def ft15_gate(spark, d):
    return vec.gated(ft14_nearest(spark, d), 1.35, 0.15).select("vec_id", "dist")


def ft14_nearest_to_each(spark, d):
    v = table(spark, d, "embeddings")
    q = v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vec.nearest_to_each(q, v, 5).select("query_id", "vec_id", F.round("dist", 4).alias("dist"))


def _lists(spark, d):
    lex = ft.top_k(ft.bm25(docs(spark, d), SEARCH, relaxed=True), "rank", 12).select("doc_id", (F.row_number().over(Window.orderBy("rank", "doc_id")) - 1).alias("pos"))
    near = ft14_nearest(spark, d).select(F.col("vec_id").alias("doc_id"), (F.row_number().over(Window.orderBy("dist", "vec_id")) - 1).alias("pos"))
    return lex, near


def ft17_fused(spark, d):
    return vec.fused(*_lists(spark, d), 15).select("doc_id", F.coalesce("lex", F.lit(-1)).alias("lex"), F.coalesce("vec", F.lit(-1)).alias("vec"), F.round("score", 8).alias("score"))


def ft16_filled(spark, d):
    return vec.filled(*_lists(spark, d), 20)


def ft2_expansion(spark, d):
    """FT-2 to FT-5: compiled queries as text."""
    rows = [(q, ft.compile_query(q).rendered(), ft.compile_query(q).rendered(True)) for q in ("headlight bolt torque", "how to reset", "valve cover gap", "procedure")]
    return spark.createDataFrame(rows, "query string, strict string, relaxed string")


def ft9_snippet(spark, d):
    return docs(spark, d).select("doc_id", ft.snippet(F.col("text"), ["thanes", "with"]).alias("snippet"))


def ft24_search_docs(spark, d):
    """FT-8 to FT-20 and FT-24: the whole search."""
    return tools.search_docs(store(spark, d), "with thanes reth", 8).select("pos", "doc_id", F.round("rank", 6).alias("rank"), "scope", "applicability")


def ft24_get_document(spark, d):
    return tools.get_document(store(spark, d), "3", 1000)


def ft24_list_sources(spark, d):
    return tools.list_sources(store(spark, d))


def ft19_reference(spark, d):
    return tools.search_docs(store(spark, d), "see vcc 000012-1 for more", 5).select("pos", "doc_id", "ref")


def ft21_conflicts(spark, d):
    """FT-21: values stated in the first results of a search through all documents, each a whole text with a sentence behind it."""
    even = F.col("doc_id") % 2 == 0
    said = docs(spark, d).withColumns({"text": F.concat("text", F.lit("\nintake manifold bolts "), F.when(even, "19").otherwise("20"), F.lit(" Nm")), "scope": F.when(even, "this car").otherwise("other vehicles")})
    rows = ft.top_k(ft.bm25(said, SEARCH, relaxed=True), "rank", 12).withColumn("pos", F.row_number().over(Window.orderBy("rank", "doc_id")) - 1)
    return ft.conflicts(rows, ["intake"])


def ft22_retarget(spark, d):
    rows = [(s, v.engine, v.family, v.year) for s in ("XC90 B6294T 2006", "D5244T", "which car", "B4204T3 2016") for v in [Vehicle().retargeted(s)]]
    return spark.createDataFrame(rows, "spec string, engine string, family string, year string")


def flt18_applicability(spark, d):
    engines = F.element_at(F.array(*(F.lit(x) for x in ("B5254T4", "B4204T,B5254T4", "D24 , B230FT", "", "XYZ1", "B6304T"))), (F.col("doc_id") % 6 + 1).cast("int"))
    return docs(spark, d).select("doc_id", tx.applicability(engines, "B5").alias("applicability"))


def str5_engine_codes(spark, d):
    t = F.concat(F.lit("B5254T4 and B230FT, D24TIC not D5200235 nor B2155 "), F.col("title"))
    return docs(spark, d).select("doc_id", F.array_join(F.slice(tx.engine_codes(t), 1, 3), ",").alias("codes"))


def fig1_weights(spark, d):
    w = fg.idf_weights(docs(spark, d), ["with", "thanes", "the", "of"])
    return spark.createDataFrame([(t, round(x, 8)) for t, x in w.items()], "term string, weight double")


def _figure_docs(spark, d):
    """Every document with its whole text, one marker within it and one behind."""
    return docs(spark, d).select("doc_id", F.concat(F.left("text", F.lit(300)), F.lit(" [image A1] the with "), F.substr("text", F.lit(301)), F.lit(" B4204T [image M2]")).alias("text"))


def fig2_markers(spark, d):
    return fg.markers(_figure_docs(spark, d)).select("doc_id", "ordinal", "title", "at")


def fig3_scores(spark, d):
    return fg.scored(fg.markers(_figure_docs(spark, d)), {"the": 1.0, "with": 2.0}, "B5").select("doc_id", "ordinal", F.round("score", 6).alias("score"))


def fig6_paths(spark, d):
    rows = fg.scored(fg.markers(_figure_docs(spark, d)), {"the": 1.0, "with": 2.0}, "B5")
    refs = _figure_docs(spark, d).select("doc_id", F.array(F.lit("a1.cgm"), F.lit("m2.png")).alias("refs"))
    graphics = spark.createDataFrame([("A1", "a1.cgm"), ("M2", "m2.png")], "title string, path string")
    paths = fg.ordered_paths(rows, refs, graphics)
    return fg.stored(paths, spark.createDataFrame([("a1.svg", "image/svg+xml"), ("m2.png", "image/png")], "path string, content_type string"))


def fig7_chosen(spark, d):
    rows = fg.gated(fg.scored(fg.markers(_figure_docs(spark, d)), {"the": 1.0, "with": 2.0}), ["the", "with"])
    return fg.chosen(rows)


#: Each document as archived markup, its whole text a paragraph of one line.
_FLAT = r"[\x00-\x20\x7F]+"


def str3_xml_rendered(spark, d):
    parsers.small_batches(spark)
    clean = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    flat = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), _FLAT, " "))
    page = F.concat(F.lit('<sheet docno="'), F.col("doc_id").cast("string"), F.lit('"><title>'), clean(F.coalesce("source", F.lit("none"))), F.lit("</title><section><warning>"), clean(F.coalesce("lang", F.lit("none"))), F.lit("</warning><para>"), clean(flat), F.lit("</para></section></sheet>"))
    return table(spark, d, "documents").select("doc_id", parsers.xml_rendered(page).alias("r")).select("doc_id", "r.docno", "r.root", "r.md", F.size("r.images").alias("n_images"))


def str3_rendered(spark, d):
    parsers.small_batches(spark)
    return table(spark, d, "pages").select("page_id", parsers.rendered("html").alias("r")).select("page_id", "r.md", F.size("r.images").alias("n_images"))


def str2_stripped(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(tx.strip_tags(F.col("html")).cast("binary")).alias("digest"), F.length(tx.strip_tags(F.col("html"))).alias("n"))


def set3_merged(spark, d):
    lex, near = _lists(spark, d)
    return rel.merged_lists(lex, near).select("doc_id", "src", "pos")


QUERIES = {f.__name__: f for f in (p0_ranked_search, ft7_bm25_strict, ft7_indexed, ft6_token_counts, ft11_rerank, ft8_penalties, ft10_relaxed_tier, ft12_blended, ft14_nearest, ft15_gate, ft14_nearest_to_each, ft17_fused, ft16_filled, ft2_expansion, ft9_snippet, ft24_search_docs, ft24_get_document, ft24_list_sources, ft19_reference, ft21_conflicts, ft22_retarget, flt18_applicability, str5_engine_codes, fig1_weights, fig2_markers, fig3_scores, fig6_paths, fig7_chosen, str3_rendered, str3_xml_rendered, str2_stripped, set3_merged)}

_RELAXED, _STRICT = _bm25_sql(SEARCH, True), _bm25_sql(SEARCH, False)
_BONUS = " + ".join(f"case when contains(lower(title), '{t}') then 2.0 else 0.0 end" for t in SEARCH.terms if len(t) >= 3)
_DIST = "sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: (x[1]::double - x[2]::double) * (x[1]::double - x[2]::double))))"
_NEAR = f"near as (select a.vec_id, {_DIST} as dist from embeddings a, embeddings b where b.vec_id = 0 and a.vec_id <> 0 order by dist, a.vec_id limit 40)"
_LISTS = f"{_RELAXED}, {_NEAR}, lex as (select doc_id, row_number() over (order by rank, doc_id) - 1 as pos from (select * from m order by rank, doc_id limit 12)), v as (select vec_id as doc_id, row_number() over (order by round(dist, 5), vec_id) - 1 as pos from near)"
_FIGS = "f as (select doc_id, left(text, 300) || ' [image A1] the with ' || substr(text, 301) || ' B4204T [image M2]' as text from documents)"

#: The whole search: hits with corpus statistics, both tiers with bonuses, the own one's generic documents with their penalty, the blend, then shape.
_SEARCH_SQL = f"""{_RELAXED.replace("m as (select doc_id, title, text,", "m as (select doc_id, title, text, (" + " and ".join(f"f{i} > 0" for i in range(len(SEARCH.phrases))) + ") as strict,")},
g as (select *, case doc_id % 3 when 0 then 'this car' when 2 then 'not vehicle-specific' else 'other vehicles' end as scope, {_BONUS} as bonus from m),
t0 as (select doc_id, scope, strict, bonus, rank + case when scope = 'not vehicle-specific' then 1.5 else 0 end as rank from g where scope <> 'other vehicles'), t1 as (select doc_id, scope, strict, bonus, rank from g),
c0 as (select * from (select *, row_number() over (partition by strict order by rank, doc_id) as own, row_number() over (order by rank, doc_id) as every, count(*) filter (strict) over () as ns from t0) where (strict and own <= 30) or (ns < 2 and every <= 30)),
c1 as (select * from (select *, row_number() over (partition by strict order by rank, doc_id) as own, row_number() over (order by rank, doc_id) as every, count(*) filter (strict) over () as ns from t1) where (strict and own <= 30) or (ns < 2 and every <= 30)),
b0 as (select *, row_number() over (order by rank - bonus, doc_id) as at_ from c0 order by rank - bonus, doc_id limit 8),
b1 as (select *, row_number() over (order by at1) as at_ from (select *, row_number() over (order by rank - bonus, doc_id) as at1 from c1 order by rank - bonus, doc_id limit 8) where doc_id not in (select doc_id from b0)),
k as (select least(greatest(2, 8 - (select count(*) from b0), case when (select count(*) filter (strict) from t0) = 0 and (select count(*) from t0) > 0 and (select count(*) filter (strict) from t1) > 0 then 4 else 0 end), (select count(*) from b1)) as room),
r as (select doc_id, rank, scope, 0 as tier, at_ from b0, k where at_ <= 8 - room union all select doc_id, rank, 'other vehicles', 1, at_ from b1, k where at_ <= room)
select (row_number() over (order by tier, at_) - 1)::int as pos, r.doc_id::varchar as doc_id, round(rank, 6) as rank, case when r.doc_id % 3 = 1 then 'other engine (not this car)' else scope end as scope, case r.doc_id % 3 when 0 then 'compatible' when 1 then 'wrong' else 'generic' end as applicability from r"""

ORACLE_SQL = {
    "p0_ranked_search": f"{_RELAXED} select doc_id, round(rank, 6) as rank from m order by m.rank, doc_id limit 8",
    "ft7_bm25_strict": f"{_STRICT} select doc_id, round(rank, 6) as rank from m",
    "ft7_indexed": f"{_STRICT} select doc_id, round(rank, 6) as rank from m",
    "ft6_token_counts": f"select term, count(*) as df from (select distinct doc_id, unnest({TOKENS_SQL.format('text')}) as term from documents) group by term",
    "ft11_rerank": f"{_RELAXED}, r as (select doc_id, rank - ({_BONUS}) as adj from m) select doc_id, round(adj, 6) as adj from r order by r.adj, doc_id limit 30",
    "ft8_penalties": f"{_RELAXED}, r as (select m.doc_id, rank + case when lang = 'de' then 6.0 else 0.0 end + case when source = 'src1' then 1.5 else 0.0 end as rank from m join documents using (doc_id)) select doc_id, round(rank, 6) as rank from r order by r.rank, doc_id limit 30",
    "ft10_relaxed_tier": f"{_RELAXED}, t as (select doc_id, rank, doc_id in (select doc_id from h where " + " and ".join(f"f{i} > 0" for i in range(len(SEARCH.phrases))) + ") as strict from m), n as (select count(*) filter (strict) as ns from t), k as (select *, row_number() over (partition by strict order by rank, doc_id) as own, row_number() over (order by rank, doc_id) as every from t) select doc_id, strict, round(rank, 6) as rank from k, n where (strict and own <= 30) or (ns < 2 and every <= 30)",
    "ft12_blended": f"{_RELAXED}, base as (select k.doc_id, lang, k.rank - k.bonus as adj from (select doc_id, rank, {_BONUS} as bonus from m order by rank, doc_id limit 30) k join documents using (doc_id)), b0 as (select doc_id, row_number() over (order by adj, doc_id) as at_ from base where lang = 'en' order by adj, doc_id limit 10), b1 as (select doc_id, row_number() over (order by at1) as at_ from (select doc_id, row_number() over (order by adj, doc_id) as at1 from base order by adj, doc_id limit 10) where doc_id not in (select doc_id from b0)), k as (select least(greatest(2, 10 - (select count(*) from b0)), (select count(*) from b1)) as room), r as (select doc_id, 0 as tier, at_ from b0, k where at_ <= 10 - room union all select doc_id, 1, at_ from b1, k where at_ <= room) select (row_number() over (order by tier, at_) - 1)::int as pos, doc_id, tier from r",
    "ft2_expansion": """select * from (values
('headlight bolt torque', '("headlight" OR "headlamp") AND ("bolt" OR "screw") AND ("torque")', '"headlight" OR "headlamp" OR "bolt" OR "screw" OR "torque"'),
('how to reset', '("to") AND ("reset" OR "initializing" OR "initialization" OR "calibration")', '"to" OR "reset" OR "initializing" OR "initialization" OR "calibration"'),
('valve cover gap', '("valve" OR "camshaft") AND ("cover") AND ("gap" OR "clearance" OR "electrode")', '"valve" OR "camshaft" OR "cover" OR "gap" OR "clearance" OR "electrode"'),
('procedure', '("procedure")', '"procedure"')) t(query, strict, relaxed)""",
    "ft14_nearest": f"with {_NEAR} select vec_id, round(dist, 5) as dist from near",
    "ft15_gate": f"with {_NEAR}, r as (select vec_id, round(dist, 5) as dist from near) select * from r where dist <= 1.35 and dist - (select min(dist) from r) <= 0.15",
    "ft14_nearest_to_each": f"with p as (select b.vec_id as query_id, a.vec_id, {_DIST} as dist from embeddings a, embeddings b where b.vec_id % 50 = 0), r as (select *, row_number() over (partition by query_id order by dist, vec_id) as k from p) select query_id, vec_id, round(dist, 4) as dist from r where k <= 5",
    "ft17_fused": f"{_LISTS} select coalesce(lex.doc_id, v.doc_id) as doc_id, coalesce(lex.pos, -1) as lex, coalesce(v.pos, -1) as vec, round(coalesce(0.3 / (60 + lex.pos), 0) + coalesce(1.0 / (60 + v.pos), 0), 8) as score from lex full join v on lex.doc_id = v.doc_id order by coalesce(0.3 / (60 + lex.pos), 0) + coalesce(1.0 / (60 + v.pos), 0) desc, lex.pos nulls last, v.pos nulls last limit 15",
    "ft16_filled": f"{_LISTS}, u as (select doc_id, 0 as src, pos from lex union all select doc_id, 1, pos from v), k as (select *, row_number() over (partition by doc_id order by src, pos) as n from u) select doc_id, src, pos from k where n = 1 order by src, pos limit 20",
    "set3_merged": f"{_LISTS}, u as (select doc_id, 0 as src, pos from lex union all select doc_id, 1, pos from v), k as (select *, row_number() over (partition by doc_id order by src, pos) as n from u) select doc_id, src, pos from k where n = 1",
    "flt18_applicability": "select doc_id, case doc_id % 6 when 0 then 'compatible' when 1 then 'compatible' when 2 then 'wrong' when 3 then 'generic' when 4 then 'generic' else 'wrong' end as applicability from documents",
    "str5_engine_codes": "select doc_id, 'B5254T4,B230FT,D24TIC' as codes from documents",
    "fig1_weights": "with t(term) as (values ('with'), ('thanes'), ('the')), c as (select count(*) as n from documents) select term, round(ln(1 + n / ((select count(*) from documents where contains(lower(text), term)) + 1)), 8) as weight from t, c",
    "fig2_markers": f"with {_FIGS}, a as (select doc_id, text, 0 as ordinal, 'A1' as title, strpos(text, '[image A1]') - 1 as at_ from f union all select doc_id, text, 1, 'M2', strpos(text, '[image M2]') - 1 from f) select doc_id, ordinal::int as ordinal, title, at_::int as \"at\" from a",
    "fig3_scores": f"with {_FIGS}, a as (select doc_id, text, 0 as ordinal, strpos(text, '[image A1]') - 1 as at_ from f union all select doc_id, text, 1, strpos(text, '[image M2]') - 1 from f), w as (select *, lower(substr(text, greatest(at_ - 240, 0) + 1, at_ + 240 - greatest(at_ - 240, 0))) as near, contains(substr(text, greatest(at_ - 280, 0) + 1, least(at_, 280)), 'B4204') or contains(substr(text, at_ + 1, 280), 'B4204') as other from a) select doc_id, ordinal::int as ordinal, round(case when other then -1.0 else (contains(near, 'the')::int * 1.0 + contains(near, 'with')::int * 2.0) * case ordinal when 1 then 0.6 else 1.0 end end, 6) as score from w",
    "ft24_list_sources": "select 'documents' as kind, source || '/' || lang as name, count(*) as rows from documents group by all union all select 'table', 'parts', count(*) from (select distinct l_partkey, l_suppkey from lineitem join part on l_partkey = p_partkey) union all select 'table', 'vectors', count(*) from embeddings",
    "ft22_retarget": "select * from (values ('XC90 B6294T 2006', 'B6294T', 'B6', '2006'), ('D5244T', 'D5244T', 'D5', null), ('which car', 'B5254T4', 'B5', null), ('B4204T3 2016', 'B4204T3', 'B4', '2016')) t(spec, engine, family, year)",
    "ft24_search_docs": _SEARCH_SQL,
    "ft19_reference": "select (row_number() over (order by doc_id) - 1)::int as pos, doc_id::varchar as doc_id, 'VCC-' || lpad(doc_id::varchar, 6, '0') as ref from documents where starts_with('VCC-' || lpad(doc_id::varchar, 6, '0'), 'VCC-000012')",
    "ft24_get_document": "select doc_id::varchar as doc_id, 'VCC-' || lpad(doc_id::varchar, 6, '0') as ref, left(split_part(text, chr(10), 1), 80) as title, substr(text, 1001, 8000) as text, length(text) as text_length, length(text) > 9000 as truncated, case when length(text) > 9000 then 9000 end as next_offset from documents where doc_id = 3",
    "str3_xml_rendered": r"with s as (select doc_id, coalesce(source, 'none') as source, coalesce(lang, 'none') as lang, trim(regexp_replace(coalesce(text, ''), '[\x00-\x20\x7F]+', ' ', 'g')) as x from documents) select doc_id, doc_id::varchar as docno, 'sheet' as root, concat_ws(chr(10) || chr(10), '# ' || source, '**WARNING:** ' || lang, nullif(x, '')) as md, 0 as n_images from s",
    "str2_stripped": r"with s as (select page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \t\r\n\f\x0B]+', ' ', 'g')) as x from pages) select page_id, md5(x) as digest, length(x)::int as n from s",
}
