"""Queries of the library read every row and whole texts: each against plain Python on a small table."""

import pytest
from gristmill.plans import catalog

TEXTS = {1: "short", 3: "a the b " * 400, 7: "with oil " * 30 + "é" * 2500, 10: "x" * 300, 12: "y" * 301 + "with", 201: "plain words, nothing else. " * 900, 205: ""}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("small"))
    spark.createDataFrame([(i, t, "en" if i % 2 else "de", "src1") for i, t in TEXTS.items()], "doc_id long, text string, lang string, source string").write.parquet(f"{where}/documents.parquet")
    return where


def marked():
    return {i: t[:300] + " [image A1] the with " + t[300:] + " B4204T [image M2]" for i, t in TEXTS.items()}


def markers():
    """(doc_id, ordinal) -> score, by the words and codes around each marker."""
    out = {}
    for i, t in marked().items():
        for n, title in enumerate(("A1", "M2")):
            at = t.index(f"[image {title}]")
            near, code = t[max(0, at - 240) : at + 240].lower(), "B4204T" in t[max(0, at - 280) : at] or "B4204T" in t[at : at + 280]
            out[i, n] = -1.0 if code else (("the" in near) + 2.0 * ("with" in near)) * (0.6 if n else 1)
    return out


def test_figures_read_all(small, spark):
    run = lambda name: catalog.QUERIES[name](spark, small).collect()
    want = {(i, n, title, t.index(f"[image {title}]")) for i, t in marked().items() for n, title in enumerate(("A1", "M2"))}
    assert sorted(map(tuple, run("fig2_markers"))) == sorted(want)
    scores = markers()
    assert {(r.doc_id, r.ordinal): r.score for r in run("fig3_scores")} == pytest.approx(scores)
    assert {(r.doc_id, r.path, r.served) for r in run("fig6_paths")} == {(i, ("a1.cgm", "m2.png")[n], ("a1.svg", "m2.png")[n]) for (i, n), s in scores.items() if s >= 0}
    assert [(r.doc_id, r.best, r.gate) for r in run("fig7_chosen")] == [(1, 3.0, True)]


def test_sections_hold_all_lines(spark, tmp_path):
    """PRJ-9: orders of any number."""
    lines = [(key, n, key % 2 + 1, key % 2 + n, float(n)) for key in (1, 2999, 3000, 60000, 5_000_000) for n in (1, 2, 3)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "bolt"), (2, "nut")], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    want = {}
    for key, n, part, section, _ in lines:
        line = f"- {part} {('bolt', 'nut')[part - 1]}" + (f" (qty {n % 3})" if n % 3 != 1 else "") + (" [non-stocked]" if n % 2 else "")
        want[section] = want.get(section, f"# S{section}") + "\n" + line
    assert dict(map(tuple, catalog.QUERIES["prj9_section_documents"](spark, str(tmp_path)).collect())) == want


def test_records_of_all_documents(small, spark):
    """FLT-22: an empty text is no answer; the answer is the whole text."""
    got = dict(map(tuple, catalog.QUERIES["flt22_contract"](spark, small).collect()))
    want = {}
    for i, t in TEXTS.items():
        bad = ["arguments not JSON"] * (i % 7 == 0) + ["answer to unknown call", "unanswered calls"] * (i % 5 == 0) + ["no answer last"] * (t == "")
        want[i] = ";".join(bad)
    assert got == want


def test_topics_of_all_documents(small, spark):
    assert dict(map(tuple, catalog.QUERIES["prj19_topic"](spark, small).collect())) == {i: t.split("\n")[0][:80].strip(" ") or "this component" for i, t in TEXTS.items()}


def test_localised_whole_texts(small, spark):
    spark.createDataFrame([(i,) for i in (*TEXTS, 404)], "doc_id long").write.mode("overwrite").parquet(f"{small}/labels.parquet")
    assert dict(map(tuple, catalog.QUERIES["jn4_localised"](spark, small).collect())) == {**TEXTS, 404: None}


def test_conflicts_among_all_documents(spark, tmp_path):
    """FT-21: the hits have high ids; one is found by the end of its text, and states a value there."""
    texts = {i: "nothing here" for i in range(20)} | {100: "thanes reth", 301: "filler " * 500 + "thanes\nintake hose 33 Nm, thanes"}
    spark.createDataFrame([(i, t, "en", "src1") for i, t in texts.items()], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r) for r in catalog.QUERIES["ft21_conflicts"](spark, str(tmp_path)).collect()] == [([19], [20, 33], [20, 33])]


def test_least_sections(spark, tmp_path, monkeypatch):
    """AGG-5: no pairs of parts and sections are kept where the least section is asked; where all are, the tasks grow with the rows."""
    from gristmill.plans import tables

    spark.createDataFrame([(k, s) for k in (1, 2, 3) for s in (9, 7, 7, 8)] + [(4, None), (None, 1), (99, 1)], "l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, f"p{k}", "b", 1) for k in (1, 2, 3, 4, 5)], "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = catalog.QUERIES["agg5_parts"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [(str(k), f"p{k}", 7 if k < 4 else None, "b") for k in (1, 2, 3, 4)]
    parts = catalog.QUERIES["ds9_grounded_parts"](spark, str(tmp_path))
    assert parts.count() == 4
    for plan in (got, parts):
        assert "Aggregate [p_partkey#" in (said := plan._jdf.queryExecution().optimizedPlan().toString()) and "section_id#" not in said.split("Aggregate [p_partkey#")[1].split("]")[0]
    monkeypatch.setattr(tables, "ROWS_A_TASK", 1)
    assert "hashpartitioning(p_partkey#" in (said := tables.parts(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()) and ", 15)" in said
    assert tables.parts(spark, str(tmp_path)).count() == 10
