"""Benchmark decontamination by a distributed positional inverted index, in DataFrame operations only.

The index stores postings (text, term, position) of training text for the terms that the benchmark is looked up
by: of each window of ten words its rarest three, by counts over all documents, and of each item its rarest
two. A posting's position less the term's place in an item says where the item would begin. These lists are
intersected from the rarest on: the lists of the windows' rarest terms say which beginnings are open, the
longer lists are read for those alone, and a window whose three terms stand is looked up whole in postings of
all words of the texts that are left. Runs of words that stand as in the item are the exact matches. Proximity
matches are texts that have an item's two rarest terms at most ten words apart.

Defined cases: null and empty texts have no words and no hits; an item without words has no window; an item
of fewer words than a window is one window; repeated rows each get the result of their text, and are looked up
once; ties of counts go by the term; a very long text is many postings and never one row; other columns
aren't read, and `uncontaminated` passes them through whatever their names; empty tables give no rows, or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NOT_ALNUM, ensure, keep, maybe_in, packed, parted, scratch, table, word_count

A_Z, A_Z_LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WIDTH = 10  # words of a window
ANCHORS = 3  # rarest terms of a window whose lists are intersected
NEAR = 10  # words that an item's two rarest terms stand apart at most
#: A counted side of so many rows at most is broadcast; beyond, rows are spared by a bitmap and the join shuffles what passes.
SMALL_ROWS = 200_000


def lower_a_z(text: Column) -> Column:
    return F.translate(text, A_Z, A_Z_LOW)


def words_of(text: Column) -> Column:
    """The words as written, maybe with an empty string at either end; `lower_a_z` of each is the contract's word."""
    return parted(text, NOT_ALNUM)


def text_hash() -> Column:
    return F.xxhash64("text", F.length("text")).alias("text_hash")


def having(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """`rows` joined with the kept table `wanted` by `key`."""
    if wanted.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        return rows.join(F.broadcast(wanted), key)
    marked, hit = maybe_in(rows, key, wanted)
    return marked.where(hit).select(*rows.columns).join(wanted, key)


def tokens(docs: DataFrame, term: bool = True) -> DataFrame:
    """(other columns..., pos, word) of `docs` with text: a row for each word, or for no word in a text without any; words before others' case is folded in full, if they are to be terms."""
    own = [c for c in docs.columns if c != "text"]
    words = docs.select(*own, words_of(F.lower("text") if term else F.col("text")).alias("w"))
    # the outer form, as a plain one makes Spark part each text twice, to drop those without words first
    places = words.select(*own, (F.element_at("w", 1) == "").cast("int").alias("lead"), F.posexplode_outer("w").alias("at", "word"))
    return places.select(*own, (F.col("at") - F.col("lead")).alias("pos"), "word")  # an empty string before the first word has place -1


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index of (text_hash, text) `docs` for the kept `terms` (term): (text_hash, term, pos)."""
    return having(tokens(docs).withColumnRenamed("word", "term"), terms, "term").select("text_hash", "term", "pos")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, count) over all places of all documents; terms that no document has are absent."""
    return having(tokens(docs.select("text")).select(F.col("word").alias("term")), terms, "term").groupBy("term").count()


def item_classes(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (item_id, text): the different sequences of words (item, words, n), n words a window; their (item, item_id)."""
    words = F.filter(words_of(lower_a_z(F.col("text"))), lambda w: w != "")
    rows = items.select("item_id", words.alias("words")).where(F.size("words") > 0).withColumn("item", F.xxhash64("words"))
    return rows.groupBy("item").agg(F.first("words").alias("words")), rows.select("item", "item_id").distinct()


def anchors_of(places: DataFrame, width: int) -> DataFrame:
    """Of known (item, length, at, term, count): (item, begin, need, at, term, lead): the `need` rarest places of each window whose terms all occur in training; `lead` marks the rarest."""
    size = F.least(F.lit(width), "length")
    begins = F.explode(F.sequence(F.greatest(F.lit(0), F.col("at") - size + 1), F.least(F.col("at"), F.col("length") - size)))
    rows = places.select("item", "at", "term", "count", size.alias("size"), begins.alias("begin"))
    by = Window.partitionBy("item", "begin")
    rows = rows.withColumns({"known": F.count(F.lit(1)).over(by), "rank": F.row_number().over(by.orderBy("count", "term", "at"))})
    rows = rows.where((F.col("known") == F.col("size")) & (F.col("rank") <= ANCHORS))
    return rows.select("item", "begin", F.least(F.lit(ANCHORS), "size").alias("need"), "at", "term", (F.col("rank") == 1).alias("lead"))


def rarest_pairs(places: DataFrame) -> DataFrame:
    """Of known (item, ..., term, count): (item, term, other), its two rarest different terms."""
    rows = places.select("item", "term", "count").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy("count", "term"))).where("rank <= 2")
    return rows.groupBy("item").agg(F.max(F.expr("if(rank = 1, term, null)")).alias("term"), F.max(F.expr("if(rank = 2, term, null)")).alias("other")).where("other is not null")


def phrase_matches(docs: DataFrame, index: DataFrame, classes: DataFrame, anchors: DataFrame, width: int) -> DataFrame:
    """(text_hash, item, start, end): every run of at least a window's words that stand in a text as in the item."""
    line = ["text_hash", "item", "shift"]
    shift = (F.col("pos") - F.col("at")).alias("shift")
    leads = keep(anchors.where("lead").select("term", "item", "at").distinct(), "leads")
    open_ = keep(having(index, leads, "term").select("text_hash", "item", shift).distinct().withColumn("line", F.xxhash64(*line)), "open")
    others = keep(anchors.select("term", "item", "at").distinct(), "anchors")
    lists, hit = maybe_in(having(index, others, "term").select("text_hash", "item", shift, "at").withColumn("line", F.xxhash64(*line)), "line", open_)
    stand = keep(lists.where(hit).select(*line, "at").distinct(), "stand")
    windows = stand.join(anchors.select("item", "at", "begin", "need"), ["item", "at"]).groupBy(*line, "begin", "need").agg(F.count(F.lit(1)).alias("n")).where("n = need")
    # whole windows: each word of theirs against the words of the texts that are left
    sized = classes.select("item", "words", F.least(F.lit(width), F.size("words")).alias("size"))
    asked = windows.select(*line, "begin").join(sized.select("item", "size"), "item").select(*line, "size", F.explode(F.expr("sequence(begin, begin + size - 1)")).alias("at")).distinct()
    asked = keep(asked.join(classes.select("item", F.posexplode("words").alias("at", "word")), ["item", "at"]).withColumn("pos", F.col("shift") + F.col("at")), "asked")
    left = keep(asked.select("text_hash").distinct(), "left")
    texts, some = maybe_in(docs, "text_hash", left)
    there = tokens(texts.where(some).select("text_hash", "text"), term=False).select("text_hash", "pos", lower_a_z(F.col("word")).alias("word")).distinct()
    found = asked.join(there, ["text_hash", "pos", "word"])
    by = Window.partitionBy(*line).orderBy("at")
    runs = found.select(*line, "size", "pos", (F.col("at") - F.row_number().over(by)).alias("run")).groupBy(*line, "size", "run").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"))
    return runs.where("end - start >= size").select("text_hash", "item", "start", "end")


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int = NEAR) -> DataFrame:
    """(text_hash, item): texts where the two terms of (item, term, other) stand at most `within` words apart, in either order."""
    # places are cut into cells of `within` words; a neighbour stands in the same cell or the next one to either side
    ones = having(index, pairs, "term").select("text_hash", "item", "pos", F.expr(f"pos div {within}").alias("cell")).distinct()
    others = having(index, keep(pairs.select("item", F.col("other").alias("term")), "others"), "term")
    others = others.select("text_hash", "item", F.col("pos").alias("at"), F.explode(F.expr(f"array(pos div {within} - 1, pos div {within}, pos div {within} + 1)")).alias("cell")).distinct()
    return ones.join(others, ["text_hash", "item", "cell"]).where(F.abs(F.col("pos") - F.col("at")) <= within).select("text_hash", "item").distinct()


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, near: bool = True) -> DataFrame:
    """Of (doc_id, text) and (item_id, text): (text_hash, n_hit, n_items, items, n_near), one row for each different text with an exact or a proximity match."""
    with scratch(docs.sparkSession):
        return keep(_contamination(docs, items, width, near), "contamination", lasting=1)


def _contamination(docs: DataFrame, items: DataFrame, width: int, near: bool) -> DataFrame:
    docs = docs.select(text_hash(), "text")
    classes, owners = item_classes(items)
    classes, owners = keep(classes, "classes"), keep(owners, "owners")
    places = classes.select("item", F.size("words").alias("length"), F.posexplode("words").alias("at", "word")).withColumn("term", F.lower("word"))
    terms = keep(places.select("term").distinct(), "terms")
    counts = keep(term_counts(docs, terms), "term-counts")
    places = places.join(counts, "term")
    anchors, pairs = keep(anchors_of(places, width), "anchors"), keep(rarest_pairs(places), "pairs")
    wanted = anchors.select("term")
    if near:
        wanted = wanted.union(pairs.select("term")).union(pairs.select("other"))
    index = keep(postings(docs, keep(wanted.distinct(), "wanted")), "postings")
    hits = keep(phrase_matches(docs, index, classes, anchors, width), "hits")
    done = F.max("end").over(Window.partitionBy("text_hash").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    spans = hits.select("text_hash", "start", "end").distinct()
    covered = spans.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(done, F.lit(0))))).groupBy("text_hash").agg(F.sum("new").alias("n_hit"))
    named = hits.select("text_hash", "item").distinct().join(owners, "item").groupBy("text_hash").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    out = covered.join(named, "text_hash").select("text_hash", "n_hit", F.size("items").cast("long").alias("n_items"), "items")
    if not near:
        return out.withColumn("n_near", F.lit(0).cast("long"))
    close = proximity_matches(index, pairs).join(owners, "item").groupBy("text_hash").agg(F.count(F.lit(1)).alias("n_near"))
    return out.join(close, "text_hash", "full")


def uncontaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """`docs`, all columns, without the texts that hold a benchmark window. Only texts that may be hit are exchanged."""
    with scratch(docs.sparkSession):
        hit = keep(contamination(ensure(docs, doc_id="long", text="string"), ensure(items, item_id="string", text="string"), width, near=False).select("text_hash"), "hit", lasting=1)
    marked, bit = maybe_in(packed(docs, "text").withColumn("text_hash", text_hash()).drop("text"), "text_hash", hit)
    marked = marked.withColumn("f_hit", bit)
    return marked.where("not f_hit").select("g_row.*").unionByName(marked.where("f_hit").join(hit, "text_hash", "left_anti").select("g_row.*"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document lie in windows of ten words that benchmark items have too, and near how many items' rarest terms stand together."""
    docs = ensure(table(spark, sf_dir, "documents"), doc_id="long", text="string")
    items = ensure(table(spark, sf_dir, "benchmark"), item_id="string", text="string")
    hit = contamination(docs, items)
    own = docs.select("doc_id", text_hash(), word_count(F.col("text"), NOT_ALNUM).alias("n_words"))
    out = own.join(hit, "text_hash", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_list = F.coalesce(F.array_join("items", ","), F.lit(""))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.sha2(items_list, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


ORACLE_SQL = {
    "op9_benchmark_decontamination": r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (select distinct item_id, list_slice(w, i, i + 9) as ws from (select item_id, w, unnest(range(1, greatest(2, len(w) - 8))) as i from b where len(w) > 0)),
lens as (select distinct len(ws) as n from win),
docwin as (select doc_id, i, n, list_slice(w, i, i + n - 1) as ws from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lens where len(w) >= n)),
hits as (select distinct doc_id, i, n, item_id from docwin join win using (ws)),
cov as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items from (select distinct doc_id, item_id from hits) group by doc_id),
tok as (select doc_id, generate_subscripts(w, 1) as pos, lower(unnest(w)) as term from d),
cnt as (select term, count(*) as n from tok group by term),
terms as (select distinct item_id, lower(term) as term from (select item_id, unnest(w) as term from b)),
rare as (select item_id, term, row_number() over (partition by item_id order by n, term) as k from terms join cnt using (term)),
near as (select distinct x.doc_id, r.item_id from rare r join rare q on r.item_id = q.item_id and r.k = 1 and q.k = 2 join tok x on x.term = r.term join tok y on y.doc_id = x.doc_id and y.term = q.term and abs(x.pos - y.pos) <= 10),
close as (select doc_id, count(*) as n_near from near group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near, 0)::bigint as n_near
from d left join cov using (doc_id) left join its using (doc_id) left join close using (doc_id)
""",
}
