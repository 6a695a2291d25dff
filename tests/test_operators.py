"""Operators on hand-made fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from gristmill.functions import parsers
from gristmill.functions import text as tx
from gristmill.operators import curation as cur
from gristmill.operators import evaluation as ev
from gristmill.operators import figures as fg
from gristmill.operators import fulltext as ft
from gristmill.operators import relational as rel
from gristmill.operators import synonyms as syn
from gristmill.operators import tools
from gristmill.operators import vectors as vec
from gristmill.sources import readers, sinks
from gristmill.streaming import ledger


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_query_compiler():
    q = ft.compile_query("How to check the valve cover gap procedure", {"gap": ["play"]}, {"valve cover": "rocker lid".split("|")})
    assert q.terms == ["to", "check", "the", "valve", "cover", "gap"]
    assert q.groups["valve"] == ["valve", "camshaft"] and q.groups["gap"] == ["gap", "clearance", "electrode", "play"] and q.groups["cover"] == ["cover", "rocker lid"]
    assert ft.compile_query("procedure").terms == ["procedure"] and ft.compile_query("!").rendered() == '""'


def test_bm25_title_and_phrases(spark):
    docs = spark.createDataFrame([(1, "gear box", "oil"), (2, "oil", "the gear box and gear"), (3, None, None), (4, "gear", "box")], "doc_id int, title string, text string")
    q = ft.Query("q", ["gear"], {"gear": ["gear box"]})
    assert [r.doc_id for r in ft.top_k(ft.bm25(docs, q), "rank", 5).collect()] == [1, 2]
    assert ft.bm25(docs, ft.Query("q", [], {})).count() == 0
    assert ft.relaxed_tier(docs, ft.compile_query("gear oil")).where("strict").count() == 2


def test_engine_codes(spark):
    got = one(spark, tx.engine_codes(F.lit("B5254T4, B230FT, D24TIC, D5200235, B2155")))
    assert got == ["B5254T4", "B230FT", "D24TIC"]
    rows = [(None, "generic"), ("", "generic"), ("B5254T4", "compatible"), ("B4204T", "wrong"), ("B4204T, B5254T4", "compatible"), ("XX1", "generic"), (" D24 ", "wrong")]
    df = spark.createDataFrame(rows, "e string, want string")
    assert df.where(tx.applicability(F.col("e"), "B5") != F.col("want")).count() == 0


def test_small_functions(spark):
    assert one(spark, tx.shorten_list(F.lit("aa,bb,cc,dd"), 6)) == "aa,bb (+2 more)"
    assert one(spark, tx.linked_citations(tx.linked_citations(F.lit("see VCC-12-1."), "u"), "u")) == "see [VCC-12-1](u/VCC-12-1)."
    assert one(spark, tx.quotes_part(F.lit("It is 30 650 014 (VCC-1234567)"), F.lit("30650014"))) and not one(spark, tx.quotes_part(F.lit("(VCC-1234567)"), F.lit("1234567")))
    assert one(spark, tx.quotes_value(F.lit("15,5 N·m"), F.lit(15.5))) and not one(spark, tx.quotes_value(F.lit("155 Nm"), F.lit(15.5)))
    assert one(spark, tx.value_visible(F.lit("to 40 Nm"), "40")) and not one(spark, tx.value_visible(F.lit("to 140 Nm"), "40"))
    assert one(spark, tx.poly_hash(F.lit("ab"))) == 3105
    assert one(spark, tx.question_after(F.lit("[VEHICLE]x[/VEHICLE]\nWhy?"))) == "Why?"
    assert one(spark, tx.sniff(F.lit(bytearray(b"\x89PNG\r\n\x1a\n123")))) == "image/png"
    assert one(spark, tx.sibling_renders(F.lit("a/b.cgm")))[0] == "a/b.svg"
    assert one(spark, tx.html_escape(F.lit("<a&b>"))) == "&lt;a&amp;b&gt;"
    assert one(spark, tx.safe_path(F.lit("a/b.png"))) and not one(spark, tx.safe_path(F.lit("../b.png")))
    assert one(spark, tx.leading_int(F.lit("10A"))) == 10 and one(spark, tx.leading_int(F.lit("A1"))) == 0


def test_parsers():
    assert [parsers.porter_stem(w) for w in ("caresses", "ponies", "relational", "hopping", "conditional", "adjustment")] == ["caress", "poni", "relat", "hop", "condit", "adjust"]
    assert parsers.replaced_span(["anti", "roll", "bar"], ["sway", "bar"]) == ("anti roll", "sway") and parsers.replaced_span(["a"], ["a"]) is None
    md, images = parsers.render_markup("<title>T</title><p>See <a>VCC-1</a><a>the guide</a></p><ul><li>x</li></ul><table><tr><td>a</td><td>b</td></tr></table><warning>hot</warning><img src='i.png' title='A1'>")
    assert md.splitlines() == ["# T", "See [the guide]", "- x", "| a | b |", "**WARNING:** hot", "[image A1]"] and images == ["i.png"]
    assert parsers.xml_text("<a>x <b>y</b></a>") == "x y" and parsers.xml_text("<a>") is None


def test_archived_markup():
    page = """<sheet docno="D1" IE-ID="e1"><metadata>no</metadata><title>T</title>lead<section><title>S</title><procedure><title>P</title>
      <ptxt>Turn <emph>left</emph>until <href>en-GBx</href><href>it  stops</href><href title="See">0800c8af1</href></ptxt></procedure></section>
      <list1><item><ptxt>one</ptxt><list2><item>two</item></list2><note>mind</note></item></list1><hint>Hm</hint><caution/>
      <row><entry>a</entry><entry/><other>x</other></row><graphic><href title="A1">i.png</href><href>j.png</href><href>i.png</href></graphic>
      <value unit="mm"> 5 </value><component>bolt</component><xref>0900c8af7</xref><xref><href title="Guide"/></xref><diagnostic>own<p>kept</p></diagnostic>tail</sheet>"""
    md, images, docno, ie_id, root = parsers.render_xml(page)
    assert md.split("\n\n") == ["# T", "lead", "## S", "### P", "Turn **left** until [it stops][See]", "- one twomind", "**NOTE:** mind", "**HINT:** Hm", "| a | |", "_[image A1]_", "value: 5 mm", "component: bolt", "[Guide]", "kept", "tail"]
    assert images == ["i.png", "j.png"] and (docno, ie_id, root) == ("D1", "e1", "sheet")
    assert parsers.render_xml("<n:a xmlns:n='u'><n:para>x</n:para></n:a>")[0] == "x"
    assert parsers.render_xml("<a><p>x</b> y") == ("x y", [], None, None, None) and parsers.render_xml(None)[0] == "" == parsers.render_xml(b"")[0]
    deep = "<section>" * 3000 + "<title>d</title>" + "</section>" * 3000
    assert parsers.render_xml(deep)[0] == "###### d" and parsers.render_xml("<p>" + "<sub>" * 3000 + "d" + "</sub>" * 3000 + "</p>")[0] == "d"


def test_incremental_and_prune(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "doc_id string, hash string")
    new = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4")], "doc_id string, hash string")
    assert {r.doc_id: r.status for r in rel.incremental(new, old).collect()} == {"a": "unchanged", "b": "changed", "c": "vanished", "d": "new"}
    assert [r.doc_id for r in rel.prune(old, new, False).collect()] == ["c"] and rel.prune(old, new, True).count() == 0


def test_tags(spark):
    docs = spark.createDataFrame([("x",), ("y",)], "doc_id string")
    edges = spark.createDataFrame([("x", "1"), ("x", "2")], "doc_id string, profile_id string")
    profiles = spark.createDataFrame([("1", "S60", "2005", None), ("2", "S60", "2006", "B5254T4")], "profile_id string, model string, year string, engine string")
    rows = {r.doc_id: r for r in rel.denormalised_tags(docs, edges, profiles).collect()}
    assert rows["x"].profile == '["1","2"]' and rows["x"].models == "S60" and rows["x"].years == "2005,2006" and rows["x"].engines == "B5254T4"
    assert rows["y"].profile == "[]" and rows["y"].models is None
    assert [r.profile_id for r in rel.ancestors(profiles, "S60", "2005", "B9").collect()] == ["1"]


def test_synonyms(spark):
    rows = [(i, "us", t) for i, t in enumerate(("hood latch", "hood hinge", "sway bar link", "sway bar bush"))] + [(i, "gb", t) for i, t in enumerate(("bonnet latch", "bonnet hinge", "anti roll bar link", "anti roll bar bush"))]
    lex = spark.createDataFrame(rows, "description_id int, language string, text string")
    assert {(r.term, r.alt, r.n) for r in syn.mined_words(lex).collect()} == {("hood", "bonnet", 2), ("bonnet", "hood", 2)}
    assert ("sway", "anti roll") in {(r.term, r.alt) for r in syn.mined_phrases(lex).collect()}


def test_vectors_and_fusion(spark):
    v = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.3, 0.4]), (2, [3.0, 4.0])], "vec_id int, embedding array<float>")
    assert [(r.vec_id, round(r.dist, 4)) for r in vec.nearest(v, [0.0, 0.0], 2).collect()] == [(0, 0.0), (1, 0.5)]
    assert vec.gated(vec.nearest(v, [0.0, 0.0]), 0.92, 0.16).count() == 1
    lex = spark.createDataFrame([("a", 0), ("b", 1)], "doc_id string, pos int")
    near = spark.createDataFrame([("c", 0), ("a", 1)], "doc_id string, pos int")
    assert [r.doc_id for r in vec.fused(lex, near, 3).collect()] == ["a", "c", "b"]
    assert [r.doc_id for r in vec.filled(lex, near, 3).orderBy("src", "pos").collect()] == ["a", "b", "c"]


def test_figures(spark):
    docs = spark.createDataFrame([("d", "intake valve here [image A1] then B4204T engine [image M2]")], "doc_id string, text string")
    rows = fg.gated(fg.scored(fg.markers(docs), {"valve": 2.0}, "B5"), ["valves"])
    got = {r.title: (r.at, r.score, r.gate) for r in rows.collect()}
    assert got["A1"][0] == 18 and got["M2"][1] == -1.0 and got["A1"][2]


def test_contract(spark):
    call = cur.tool_call(F.lit("c1"), "search", F.lit("{}"))
    good = F.array(cur.message("system", F.lit("s")), cur.message("user", F.lit("u")), cur.message("assistant", calls=call), cur.message("tool", F.lit("r"), call_id=F.lit("c1")), cur.message("assistant", F.lit("a")))
    twice = F.array(cur.message("user", F.lit("u")), cur.message("assistant", calls=call), cur.message("tool", F.lit("r"), call_id=F.lit("c1")), cur.message("tool", F.lit("r"), call_id=F.lit("c1")))
    assert one(spark, cur.problems(good, ("search",))) == []
    assert one(spark, cur.problems(twice, ("other",))) == ["no system message first", "unknown tool", "answer to unknown call", "no answer last"]
    assert one(spark, cur.problems(F.expr(f"cast(array() as array<{cur.MESSAGE}>)"), ())) == ["empty"]


def test_gate_unmeasured(spark):
    grades = spark.createDataFrame([(True, None), (True, None)], "torque_exact boolean, x boolean").select("torque_exact", *(F.lit(None).cast("boolean").alias(c) for c in set(ev.METRICS.values()) - {"torque_exact"}))
    got = {r.metric: r.passes for r in ev.gated(ev.scorecard(grades)).collect()}
    assert got["torque_exact"] and not got["part_number_exact"] and not got["hallucination_rate"]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿Pin,Goes\n1,x\n2,y\n", encoding="utf-8")
    rows = readers.csv_lines(spark, str(tmp_path / "a.csv"), ["Pin", "Goes"], ["Notes"]).orderBy("csv_line").collect()
    assert [(r.Pin, r.Notes, r.csv_line, r.source_file) for r in rows] == [("1", None, 2, "a.csv"), ("2", None, 3, "a.csv")]
    df = spark.createDataFrame([(1, "é"), (2, None)], "id int, t string")
    sinks.write_jsonl(df, str(tmp_path / "j"))
    assert readers.jsonl(spark, str(tmp_path / "j"), "id int, t string").orderBy("id").collect() == df.orderBy("id").collect()
    assert sinks.content_hash(df).first() == sinks.content_hash(df.orderBy("id", ascending=False)).first()
    (tmp_path / "f.json").write_text(json.dumps({"split_keys": ["k"], "source_ids": [3]}))
    keys, ids = readers.frozen_split(spark, str(tmp_path / "f.json"))
    assert keys.first().split_key == "k" and ids.first().source_id == "3"
    (tmp_path / "c.toml").write_text('[car]\nengine = "D5244T"\n')
    assert readers.Vehicle.load(str(tmp_path / "c.toml")).engine == "D5244T"
    assert readers.Vehicle().retargeted("V70 d5244t 2004").year == "2004" and readers.Vehicle().retargeted("any").engine == "B5254T4"
    assert readers.shown(spark.sql("select x'0aff' as b, repeat('x', 500) as s")).first().b == "<bytes:2:0aff>"
    assert readers.or_empty(spark, lambda: spark.read.parquet(str(tmp_path / "none")), "a int").count() == 0
    path = str(tmp_path / "t")
    sinks.reload(df, path)
    sinks.replace_in_place(rel.upsert(spark.read.parquet(path), spark.createDataFrame([(2, "z")], "id int, t string"), ["id"]), path)
    assert {r.t for r in spark.read.parquet(path).collect()} == {"é", "z"}


def test_zip(spark, tmp_path):
    import io
    import zipfile

    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("a.xml", "<a>t</a>")
    df = spark.createDataFrame([(bytearray(b.getvalue()),), (bytearray(b"no"),), (None,)], "b binary")
    got = df.select(parsers.xml_plain(readers.unzipped("b").cast("string")).alias("x")).collect()
    assert [r.x for r in got] == ["t", None, None]


def test_tools(spark):
    docs = spark.createDataFrame([("1", "VCC-1", "intake valve", None, None, "B5254T4", "s", "intake valve text", ["a.png"], "db"), ("2", "VCC-2", "intake valve", None, None, "B4204T", "s", "intake valve text", [], "db")], "doc_id string, ref string, title string, model string, year string, engine string, section string, text string, refs array<string>, db string")
    s = tools.Store(docs)
    rows = tools.search_docs(s, "intake valve", 5).collect()
    assert [(r.doc_id, r.scope) for r in rows] == [("1", "this car"), ("2", "other engine (not this car)")] and rows[0].lead and rows[1].lead is None
    assert [r.doc_id for r in tools.search_docs(s, "intake valve 1999", 5, profile="V70 B4204T").collect()] == ["2"] and "B4204T" in tools.search_docs(s, "intake 1999", 5, profile="V70 B4204T").first().notice
    assert tools.get_document(s, "VCC-2").first().doc_id == "2"
    assert tools.list_sources(s).count() == 1


def test_stream_ledger(spark, tmp_path):
    src, path, schema = str(tmp_path / "in"), str(tmp_path / "ledger"), "doc_id string, seq int, body string"
    spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema).coalesce(1).write.parquet(src)
    ledger.run(spark, src, schema, path, str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([("b", 2, "z"), ("c", 2, "w")], schema).coalesce(1).write.mode("append").parquet(src)
    ledger.run(spark, src, schema, path, str(tmp_path / "cp")).awaitTermination()
    assert {r.doc_id: r.status for r in ledger.read_ledger(spark, path).collect()} == {"a": "new", "b": "changed", "c": "new"}


def test_ledger_survives_failures(spark, tmp_path, monkeypatch):
    """Neither a read that fails nor a rename that does loses rows, and a batch that comes again changes nothing."""
    path, rows = str(tmp_path / "ledger"), lambda *r: spark.createDataFrame(r, "doc_id string, seq int, body string")
    ledger.apply_batch(rows(("a", 1, "x"), ("b", 1, "y")), 0, path)
    monkeypatch.setattr(sinks.Versions, "read", lambda self, schema: (_ for _ in ()).throw(OSError("no answer")))
    with pytest.raises(OSError, match="no answer"):
        ledger.apply_batch(rows(("c", 1, "z")), 1, path)
    monkeypatch.undo()

    class Refusing:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return (lambda *a: False) if name == "rename" else getattr(self.fs, name)

    make = sinks.Versions.__init__
    monkeypatch.setattr(sinks.Versions, "__init__", lambda self, *a: (make(self, *a), setattr(self, "fs", Refusing(self.fs)))[0])
    with pytest.raises(OSError, match="last one holds"):
        ledger.apply_batch(rows(("c", 1, "z")), 1, path)
    monkeypatch.undo()
    assert {r.doc_id for r in ledger.read_ledger(spark, path).collect()} == {"a", "b"}
    for _ in range(2):
        ledger.apply_batch(rows(("c", 1, "z"), ("b", 1, "y")), 1, path)
    assert {(r.doc_id, r.status, r.batch) for r in ledger.read_ledger(spark, path).collect()} == {("a", "new", 0), ("b", "new", 0), ("c", "new", 1)}


def test_search_rules(spark):
    """Catalogue entries step back unless parts are asked for by any of the words; a vehicle without a model has the profiles of its engine."""
    schema = "doc_id string, ref string, title string, engine string, section string, text string, refs array<string>, db string"
    docs = spark.createDataFrame([("1", "VCC-000001", "intake manifold", "B5254T4", "s", "intake manifold, fitted", [], "db"), ("2", None, "intake manifold parts", None, "s", "intake manifold intake manifold", [], "EPC"), ("3", "VCC-123456-1", "Faulty signal", None, "s", "other", [], "db")], schema)
    profiles = spark.createDataFrame([("p", "S60", None, "B5254T4"), ("q", "V70", "2001", "B6294T")], "profile_id string, model string, year string, engine string")
    edges = spark.createDataFrame([("1", "p"), ("3", "q")], "doc_id string, profile_id string")
    s = tools.Store(docs, {"profiles": profiles, "doc_profiles": edges})
    assert [r.doc_id for r in s.own(s.car).collect()] == ["1"]
    found = lambda q, **k: [(r.doc_id, r.scope) for r in tools.search_docs(s, q, 5, **k).collect()]
    assert found("intake manifold") == [("1", "this car"), ("2", "not vehicle-specific")]
    rank = lambda q: {r.doc_id: r["rank"] for r in tools.search_docs(s, q, 5).collect()}
    plain, asked = rank("intake manifold"), rank("intake manifold part number")
    assert plain["1"] == asked["1"] and plain["2"] == pytest.approx(asked["2"] + 6.0)
    assert found("see VCC 123456")[0][0] == "3" and found("VCC-999999 intake manifold")[0][0] == "1"  # an unknown reference falls through
    assert found("intake manifold", profile="all")[0][1] is None
    first = tools.search_docs(s, "intake manifold 2019", 5).first()
    assert "2015" in first.notice and first.citation.startswith("VCC-000001") and tools.search_docs(s, "zzz", 5).count() == 0


def test_search_conflict_and_vectors(spark):
    schema = "doc_id string, ref string, title string, engine string, section string, text string, refs array<string>, db string"
    docs = spark.createDataFrame([("1", "VCC-000001", "Tightening torque", "B5254T4", "s", "camshaft cap 17 Nm", [], "db"), ("2", "VCC-000002", "Tightening torque", "D5244T", "s", "camshaft cap 20 Nm", [], "db"), ("3", "VCC-000003", "camshaft notes", None, "s", "about the camshaft", [], "db"), ("4", "VCC-000004", "far", None, "s", "nothing shared", [], "db")], schema)
    vectors = spark.createDataFrame([("3", [1.0, 0.0]), ("4", [0.2, 0.0])], "doc_id string, embedding array<float>")
    s = tools.Store(docs, {"vectors": vectors})
    rows = tools.search_docs(s, "camshaft cap tightening torque", 5).collect()
    assert rows[0].conflict and "[17]" in rows[0].conflict and "[20]" in rows[0].conflict and [r.lead for r in rows if r.doc_id == "2"] == [None]
    near = tools.search_docs(s, "camshaft cap tightening torque", 5, query_vector=[1.0, 0.0], gate=(0.9, 0.9)).collect()
    assert near[0].doc_id == "1" and "3" in {r.doc_id for r in near} and "4" not in {r.doc_id for r in near}  # 4 shares no word and isn't very near


def test_nearest_in_blocks(spark):
    v = spark.range(300).selectExpr("cast(id as int) as vec_id", "array(cast(id * 37 % 101 as float), cast(id % 7 as float)) as embedding")
    q = v.where("vec_id % 3 = 0").selectExpr("vec_id as query_id", "embedding")
    key = lambda rows: sorted((r.query_id, r.vec_id, r["rank"]) for r in rows.collect())
    assert key(vec.nearest_to_each(q, v, 4)) == key(vec.nearest_to_each(q, v, 4, block=7, share=11))


def test_fill_keeps_plans_small(spark):
    rows = spark.createDataFrame([(i, f"h{i % 50}", 10) for i in range(200)], "seq int, hash string, chars int")
    got = cur.filled([(rows.where(f"seq % 9 = {i}"), 4) for i in range(9)], F.col("chars"), F.lit(True))
    hashes = [r.hash for r in got.collect()]
    assert len(hashes) == len(set(hashes)) == 36
    assert got._jdf.queryExecution().analyzed().toString().count("Relation [") <= 9


def test_records_are_valid(spark, sf):
    """Every producer's records pass the contract; the fill keeps to its quotas, and frozen keys to themselves."""
    from gristmill.operators import records as rec
    from gristmill.plans import records as plans

    made = plans._made(spark, sf)
    for name, rows in made.items():
        bad = rows.select(F.explode(cur.problems(F.col("messages"), rec.TOOLS)).alias("p")).groupBy("p").count().collect()
        assert not bad and rows.count() > 0, (name, bad)
    cases = rec.benchmark_cases(made, 3)
    frozen = rec.frozen_manifest(cases).first()
    assert frozen.n_cases == cases.count() and frozen.split_keys == sorted(set(frozen.split_keys)) and len(frozen.content_hash) == 64
    keys = spark.createDataFrame([(k,) for k in frozen.split_keys], "split_key string")
    ids = spark.createDataFrame([(i,) for i in frozen.source_ids], "source_id string")
    kept, report = rec.generate(spark, {k: made[k] for k in (("grounded", "part"), ("grounded", "torque"), ("figure", "figure"))}, 60, (keys, ids))
    assert not {r.split_key for r in kept.collect()} & set(frozen.split_keys) and all(r.produced <= r.target for r in report.collect())


def test_grounding_in_results(spark):
    """With a retriever's results a record stands only if its document was found and shows the value, or opens to it."""
    from gristmill.operators import records as rec

    docs = spark.createDataFrame([(i, f"VCC-{i}", "t", f"Pump, tightening torque: {10 + i} Nm" + "x" * (20_000 if i == 4 else 0), "S60", "2005", "B5", []) for i in range(1, 5)], "doc_id long, ref string, title string, text string, model string, year string, engine string, refs array<string>")
    hit = lambda i, snippet: (str(i), f"VCC-{i}", "t", snippet)
    found = spark.createDataFrame([(1, [hit(9, "no"), hit(1, "Pump 11 Nm")]), (2, [hit(2, "torn")]), (3, [hit(9, "no")]), (4, [hit(4, "torn")])], "doc_id long, results array<struct<doc_id:string,ref:string,title:string,snippet:string>>")
    got = {r.source_ids[0]: [m.role for m in r.messages] for r in rec.grounded_values(docs, found).collect()}
    assert got == {"VCC-1": ["system", "user", "assistant", "tool", "assistant"], "VCC-2": ["system", "user", "assistant", "tool", "assistant", "tool", "assistant"]}


def test_champion(spark):
    card = lambda rate, n=10: spark.createDataFrame([(m, 0, n, (1 - rate) if m == "hallucination_rate" else rate) for m in ev.METRICS], "metric string, passed int, n int, rate double")
    assert ev.is_champion(card(1.0), None) and not ev.is_champion(card(0.5), None) and not ev.is_champion(card(1.0, 0), None)
    assert ev.is_champion(card(1.0), card(0.999)) and not ev.is_champion(card(1.0), card(1.0))


def test_ranking_checks(spark):
    rows = [("q", 0, "VCC-1-1", "Head", "this car", "x"), ("q", 1, "VCC-2", "Bolt", "other engine (not this car)", None), ("r", 0, None, "Oil", "other engine (not this car)", "leaked")]
    results = spark.createDataFrame(rows, "case_id string, pos int, ref string, title string, scope string, lead string")
    checks = [("a", "above", {"case": "q", "want": {"ref": "vcc-1"}, "other": {"ref": "VCC-2"}}), ("b", "above", {"case": "q", "want": {"ref": "VCC-9"}, "other": {"ref": "VCC-2"}}), ("c", "within", {"case": "q", "want": {"title": "bolt"}, "n": 1}), ("d", "within", {"case": "q", "want": {"title": "bolt"}, "n": 2}), ("e", "absent", {"case": "q", "want": {"ref": "VCC-9"}}), ("f", "no lead", {"case": "q"}), ("g", "no lead", {"case": "r"})]
    assert {r.check_id: r.ok for r in ev.ranking_checks(results, checks).collect()} == {"a": True, "b": False, "c": False, "d": True, "e": True, "f": True, "g": False}


def test_turn_failures(spark):
    schema = "answer string, must_mention array<string>, must_not_say array<string>, tool_must_not_contain array<string>, tool_must_use array<string>, tool_calls array<struct<tool:string,args:string>>"
    rows = [("Use 17 Nm", ["17 nm"], ["guess"], ["V70"], ["search_docs"], [("search_docs", '{"query": "x"}')]), ("I guess", ["17"], ["guess"], ["v70"], ["epc_part"], [("search_docs", '{"car": "V70"}')]), (None, [], [], [], ["epc_part"], None)]
    got = [r.failures for r in ev.turn_failures(spark.createDataFrame(rows, schema)).collect()]
    assert got == [[], ["missing 17", "said guess", "call contains v70", "not used epc_part"], ["calls not observable"]]
    with pytest.raises(ValueError, match="zz"):
        ev.chosen_cases(spark.createDataFrame([("a",)], "id string"), ["a", "zz"])


def test_figures_fall_through(spark):
    rows = spark.createDataFrame([("a", 0, 3.0, True), ("b", 0, 2.0, True), ("c", 0, 1.0, False)], "doc_id string, ordinal int, score double, gate boolean")
    able = lambda *ids: spark.createDataFrame([(i,) for i in ids], "doc_id string")
    pick = lambda shows: [r.doc_id for r in fg.chosen(rows, shows).collect()]
    assert pick(None) == ["a"] and pick(able("b", "c")) == ["b"] and pick(able("c")) == []
    shown = spark.createDataFrame([("x.cgm", "x.svg", 0), ("y", None, 1), ("z.png", "z.png", 2)], "path string, served string, pos int")
    assert tuple(fg.summary(shown, 2).first()) == (1, 1, 1, "![figure](x.svg)")


def test_optional_sources_and_frozen_files(spark, tmp_path):
    assert readers.or_empty(spark, lambda: spark.read.parquet(str(tmp_path / "none")), "a int").count() == 0
    with pytest.raises(ZeroDivisionError):
        readers.or_empty(spark, lambda: 1 / 0, "a int")
    import hashlib

    cases = spark.createDataFrame([("b", None), ("a", 1)], "id string, n int")
    digest = sinks.frozen_file(cases, str(tmp_path / "cases.jsonl"))
    data = (tmp_path / "cases.jsonl").read_bytes()
    assert data == b'{"id":"a","n":1}\n{"id":"b","n":null}\n' and digest == hashlib.sha256(data).hexdigest()
    files = spark.createDataFrame([("s", "/x/s.png", b"1"), ("s", "/x/s.svg", b"2"), ("t", "/x/t.gif", b"3")], "stem string, path string, content binary")
    assert {r.stem: r.path for r in readers.first_renders(files).collect()} == {"s": "/x/s.svg", "t": "/x/t.gif"}
    assert readers.blob_file(files.where("stem = 't'").select("content"), str(tmp_path / "blob")) == 1


def test_abilities(spark):
    docs = spark.createDataFrame([("1", "t", "x")], "doc_id string, title string, text string")
    pins = spark.createDataFrame([], "module string")
    got = {r.ability: (r.ready, r.detail) for r in tools.abilities(tools.Store(docs, {"pins": pins, "parts": docs})).collect()}
    assert got["search"][0] and got["parts"] == (True, "ready") and got["pins"] == (False, "pins") and got["parts by vehicle"] == (False, "profiles, section_profiles")


def test_index_phrases(spark, tmp_path):
    from gristmill.operators import index

    docs = spark.createDataFrame([(1, "gear oil", "the gear oil. Gear oil!"), (2, "oil", "gear, then oil"), (3, None, None)], "doc_id long, title string, text string")
    index.build(docs, str(tmp_path / "index"), 4)
    for q in ("gear oil", "oil", "headlight", "gear box"):
        query = ft.compile_query(q, phrases={"gear oil": ["gear oil"]})
        for relaxed in (False, True):
            got = {r.doc_id: round(r["rank"], 9) for r in index.search(spark, str(tmp_path / "index"), query, relaxed).collect()}
            assert got == {r.doc_id: round(r["rank"], 9) for r in ft.bm25(docs, query, relaxed).collect()}


def test_sections_and_titles(spark):
    rows = spark.createDataFrame([(1, "Hub", 2, "22", "nut", 1, 4, "A / B"), (1, "Hub", 1, "11", "seal", 2, 5, "A / B"), (2, "Rim", 1, "33", None, 1, 4, " ")], "section_id int, section_title string, seq int, part_number string, description string, qty int, type_id int, function_group string")
    got = {r.section_id: r.text for r in rel.section_documents(rows).collect()}
    assert got == {1: "# Hub\n_Function group: A / B_\n\n- 11 seal (qty 2) [non-stocked]\n- 22 nut", 2: "# Rim\n- 33 "}
    docs = spark.createDataFrame([("a", "x"), ("b", "y")], "doc_id string, text string")
    crumbs = spark.createDataFrame([("a", "Engine | Head")], "doc_id string, breadcrumb string")
    assert {r.doc_id: r.text for r in rel.under_breadcrumbs(docs, crumbs).collect()} == {"a": "_Section: Engine | Head_\n\nx", "b": "y"}
    t = lambda *a: one(spark, rel.titled(*(F.lit(x).cast("string") for x in a)))
    assert [t("T", "k", "x", "r"), t(" ", "spec", "component: Nut\n\nvalue: 5 Nm\nmore", "r"), t(None, None, "x", "r"), t(None, "k", "", "r")] == ["T", "spec: Nut — 5 Nm", "document: x", "r"]


def test_accents_and_stems(spark):
    assert one(spark, F.array_join(tx.tokens(F.lit("Été, ÜBER-Größe ñandú Ålesund straße")), " ")) == "ete uber große nandu alesund straße"
    assert one(spark, tx.token_words(F.lit(" Déjà-vu 2É "))) == "deja vu 2e"
    pins = spark.createDataFrame([("CEM", "A", "1", "heating relays", "X1", None), ("CEM", "A", "2", "heat", None, "relay"), ("CEM", "B", "3", "relaying nothing", None, None)], "module string, connector string, pin string, function string, goes_to string, notes string")
    store = tools.Store(spark.createDataFrame([("1", "t")], "doc_id string, text string"), {"pins": pins})
    assert [r.pin for r in tools.lookup_pin(store, query="heated relay").collect()] == ["1", "2"]
    assert [r.pin for r in tools.lookup_pin(store, module="cem", pin="B:3").collect()] == ["3"]


def test_nearest_to_each_odd_vectors(spark):
    """blocks go through products of matrices, no row for each pair; vectors without a distance come last, as in the query's SQL, and elements that one side lacks don't count."""
    rows = [(0, [0.0, 0.0]), (1, None), (2, [3.0, 4.0]), (3, [3.0]), (4, []), (5, [0.0, 1.0]), (6, [None, 2.0]), (7, [3.0, 4.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    q = v.where("vec_id in (0, 1)").selectExpr("vec_id as query_id", "embedding")
    for sizes in ({}, {"block": 1, "share": 2}):
        got = vec.nearest_to_each(q, v, 7, **sizes)
        rank = {(r.query_id, r["rank"]): (r.vec_id, r.dist) for r in got.collect()}
        assert [rank[0, i] for i in range(1, 8)] == [(0, 0.0), (5, 1.0), (6, 2.0), (3, 3.0), (2, 5.0), (7, 5.0), (1, None)]
        assert [rank[1, i] for i in range(1, 8)] == [(i, None) for i in range(7)]
        assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().toString()


def test_nearest_to_each_ties(spark):
    """Equal distances by key, also where far more than k share one, and those that a product of matrices can't tell apart."""
    v = spark.range(500).selectExpr("id as vec_id", "array(cast(100000 + id % 3 as float), cast(0.001 * (id % 5) as float)) as embedding")
    q = v.where("vec_id % 50 = 0").selectExpr("vec_id as query_id", "embedding")
    points = {r.vec_id: r.embedding for r in v.collect()}
    want = {i: sorted((sum((a - b) ** 2 for a, b in zip(points[i], p, strict=True)) ** 0.5, j) for j, p in points.items())[:4] for i in range(0, 500, 50)}
    got = {}
    for r in vec.nearest_to_each(q, v, 4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.dist, r.vec_id))
    assert got == want


def test_cut_words_are_no_engine_codes(spark):
    """where the window's edge cuts a key or a number, the rest isn't a code; a whole one at the edge is."""
    filler = " x" * 200
    texts = {"cut word": "AKIA7MD53SFPSDLP" + filler[:270], "whole word": " D53SFPSDLP" + filler[:270], "begins the text": "D53SFPSDLP" + filler[:200]}
    rows = spark.createDataFrame([(k, t + "[image A1] the", len(t)) for k, t in texts.items()] + [(k, "[image A1]" + filler[: 280 - 11 - n] + " " + c, 0) for k, n, c in (("cut number", 4, "D2445 the"), ("whole number", 4, "D244 the"))], "k string, text string, at int")
    got = {r.k: r.code for r in rows.select("k", fg.nearest_engine(F.col("text"), F.col("at")).alias("code")).collect()}
    assert got == {"cut word": None, "whole word": "D53SFPSDLP", "begins the text": "D53SFPSDLP", "cut number": None, "whole number": "D244"}


def test_index_in_shares(spark, tmp_path, monkeypatch):
    """postings are whole before their one exchange, and a bucket's are dealt to as many tasks as the documents need."""
    import pyarrow as pa

    from gristmill.operators import index

    batch = pa.record_batch({"doc_id": pa.array(["b", "a", "c"]), "title": pa.array([["oil", "oil"], None, []]), "body": pa.array([["gear", "oil"], ["x"], None])})
    rows = {(r["doc_id"], r["term"]): (r["title"], r["body"]) for r in index.postings_of(batch).to_pylist()}
    assert rows == {("b", "oil"): ([0, 1], [1]), ("b", "gear"): (None, [0]), ("a", "x"): (None, [0])}
    assert index.postings_of(batch.slice(2)).num_rows == 0
    monkeypatch.setattr(index, "DOCS_A_PART", 7)
    docs = spark.range(60).selectExpr("id as doc_id", "if(id % 5 = 0, 'gear oil', null) as title", "concat('the gear oil ', repeat('gear ', cast(id % 7 as int))) as text")
    index.build(docs, str(tmp_path / "index"), 2)
    assert all(len(list(p.glob("*.parquet"))) > 1 for p in (tmp_path / "index" / "postings").glob("bucket=*"))
    query = ft.compile_query("gear oil", phrases={"gear oil": ["gear oil"]})
    got = {r.doc_id: round(r["rank"], 9) for r in index.search(spark, str(tmp_path / "index"), query).collect()}
    assert len(got) == 60 and got == {r.doc_id: round(r["rank"], 9) for r in ft.bm25(docs, query).collect()}


@pytest.mark.parametrize("name", ["ds9_grounded_values", "str3_xml_rendered", "str3_rendered"])
def test_whole_texts_in_small_batches(spark, sf, name):
    """what a Python step holds is bounded by rows and bytes, whatever the table's size."""
    from gristmill.plans import catalog

    rows, size = parsers.ROWS_A_BATCH, parsers.BYTES_A_BATCH
    spark.conf.set(rows, "10000")
    spark.conf.unset(size)
    catalog.QUERIES[name](spark, sf)
    assert int(spark.conf.get(rows)) <= 1000 and int(spark.conf.get(size)) <= 4_000_000


def test_blend_scans_texts_once(spark, sf):
    """the blend's looks at its candidates don't scan the documents again."""
    from gristmill.plans import catalog

    assert not [f for f in catalog.QUERIES["ft12_blended"](spark, sf).inputFiles() if "documents" in f]


@pytest.mark.parametrize("spare", [0, 1000])
def test_first_of_different_keys(spark, monkeypatch, spare):
    """Also where the first rows are repeats, or are all taken already."""
    monkeypatch.setattr(cur, "SPARE", spare)
    data = [(i // 40, f"h{i // 40 % 9}", i) for i in range(600)] + [(3, "h1", 900), (0, "h8", 901), (2, None, 902)]
    rows = spark.createDataFrame(data, "seq int, hash string, n int").repartition(5)
    taken = spark.createDataFrame([("h0",), ("h3",)], "hash string")
    for but, n in ((None, 4), (None, 20), (taken, 3), (taken, 0)):
        best = {}
        for seq, h, _ in data:
            if but is None or h not in ("h0", "h3"):
                best[h] = min(best.get(h, seq), seq)
        want = sorted((s, h or "", h) for h, s in best.items())[:n]
        got = cur.first_different(rows, "hash", "seq", n, but).collect()
        assert sorted((r.seq, r.hash or "", r.hash) for r in got) == want


def test_records_are_made_once(spark, sf):
    """what a filter asks of a record doesn't repeat what it is made of, such as a whole text without its spaces."""
    from gristmill.operators import records as rec
    from gristmill.plans import records as plans

    made = plans._made(spark, sf)[("grounded", "procedure")]
    valid = made.where(F.size(cur.problems(F.col("messages"), rec.TOOLS)) == 0).where("chars < 10000")
    assert valid.select("hash", "messages")._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(text#") == 1
    assert valid.count() > 0
