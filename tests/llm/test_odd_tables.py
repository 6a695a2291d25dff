"""Every query and stage on tables with nulls, empty and long texts, ties, repeated rows, clashing columns, and on empty ones."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gristmill.llm import queries
from gristmill.llm.common import keep

CLASH = ["key", "size", "shard", "slot", "hash", "n", "cls", "tid", "score", "row", "start", "f_hit", "f_spot", "g_row", "m_key", "text_hash", "term", "held_out", "source_size", "found", "keys", "hits"]
ROWS = [
    (1, "You idiot, you moron, stupid trash. " * 3, "en", "a"), (2, None, None, None), (3, "", "", ""), (None, "no id here at all", "en", "b"), (None, None, None, None), (5, "   \n\t ", "fr", None),
    (6, "same words in the same order here", "en", "a"), (7, "same words in the same order here", "en", "a"), (7, "same words in the same order here", "en", "a"), (8, "one", "en", "c"), (9, "Été à la plage " * 20000, "fr", "b"),
    (10, "x@y.zz and 10.0.0.1 and 4111 1111 1111 1111 and +1 (212) 555-0100", "de", "b"), (11, "MIT license", None, "c"), (12, "-1" * 40000, "en", "c"), (13, "🙂 \x00 \u2028", "en", None),
]


@pytest.fixture(scope="module", params=["odd", "empty"])
def folder(request, spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp(request.param))
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    for i, c in enumerate(CLASH):
        docs = docs.withColumn(c, F.lit(i))
    tables = {
        "documents": docs,
        "labels": spark.createDataFrame([(1, 1, 1), (1, 0, None), (None, None, 1), (6, None, 0), (404, 1, 0)], "doc_id long, quality int, toxic int").withColumn("text", F.lit(0)),
        "benchmark": spark.createDataFrame([(1, None), (2, ""), (None, "one"), (3, "same words in the same order here"), (3, "same words in the same order here")], "item_id long, text string").withColumn("phrase", F.lit(0)),
        "pages": spark.createDataFrame([(1, None), (None, ""), (2, "http://"), (2, "http://a.com/en/" + "x" * 100000), (3, "casino")], "page_id long, url string").withColumn("host", F.lit(0)),
    }
    for name, df in tables.items():
        (df if request.param == "odd" else df.limit(0)).coalesce(1).write.parquet(f"{where}/{name}.parquet")
    return request.param, where


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(name, folder, spark):
    kind, where = folder
    rows = queries.QUERIES[name](spark, where).collect()
    assert len(rows) == (0 if kind == "empty" else 5 if name.startswith("op10") else len(ROWS))
    if kind == "odd" and name.startswith("op6"):
        got = [(r.doc_id, r.component_id) for r in rows]
        assert got.count((7, 6)) == 2 and (6, 6) in got and (2, 2) in got and (3, 3) in got
    if kind == "odd" and name.startswith("op9"):
        assert {r.doc_id for r in rows if r.contaminated} == {6, 7, 8}


def test_pipeline(folder, spark):
    kind, where = folder
    docs = spark.read.parquet(f"{where}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, where))
        seen[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != "sharding":
            assert docs.columns == columns
    if kind == "odd":
        assert 1 not in seen["toxicity"] and len(seen["toxicity"]) == len(ROWS) - 1
        assert 6 in seen["ngram_jaccard_join"] and 7 not in seen["ngram_jaccard_join"]
        assert not {6, 8} & set(seen["benchmark_decontamination"]) and {2, 3, 9, 10, 12} <= set(seen["benchmark_decontamination"])
        assert sorted(map(str, seen["sharding"])) == sorted(map(str, seen["source_mixing"]))
    else:
        assert not any(seen.values())
