"""N-gram Jaccard join by parity sketches, and the components that its links make.

A document's set is its distinct word shingles. Sets linked at similarity t differ in at most
D = (1 - t) / t * size elements. A parity sketch deals a set's elements to blocks and XORs their hashes in
each block, so an element that only one of two sets has changes one block, and the sketches differ in no
more blocks than the sets do in elements. By pigeonhole, two linked sets share one of the first D + 1
blocks that aren't empty; these are a set's keys. Blocks depend on the size band alone, and sets that may
link into the next band have keys there too. A short sketch of 512 bits, whose Hamming distance is a lower
bound of the difference as well, rejects most other pairs, and the shingles themselves decide.

Only components are wanted, so not all pairs of a large group of near copies are looked at: sets equal to
each other are one class; then each class is held against a few leaders, one for each key it shares, and
after that only pairs that aren't joined yet are looked at, wherever they share a key. A key that many classes
share is never one task's: leaders are found by partial aggregation, looked up under salted keys, and what
is left of such a key is compared block by block.

Defined cases: null texts, empty ones and such without words have no set, link with nothing and are their
own component; a text of fewer words than a shingle is one shingle; repeated rows and equal texts are
linked; a null doc_id takes part and never names a component; ties fall to the smallest doc_id; a very long
text is a piece of its own and its set is exact; empty tables give no rows; other columns aren't read, and
`one_of_each` passes them through whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ensure, hot_join, in_arrow, in_pieces, keep, maybe_in, packed, scratch, table

WORDS_KEPT = 200_000  # word hashes that a task keeps
LANES = [f"s{i}" for i in range(8)]  # of the short sketch, 64 bits each
LONG = 4096  # bits of the long sketch, which spares hopeless pairs the exchange of whole sets
BEST = 2  # leaders that a class is verified against in a round
MANY = 1_000  # documents of a component that are told its name in one task
HOT = 50_000  # members of a key that are looked up in one task
BLOCK = 2_000  # members of a key that are held against as many others in one task
ROUNDS = 2
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A fixed scramble of 64-bit numbers."""
    x = x + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or "").encode().lower().split()  # bytes: lower-cases A-Z and parts at ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(width, len(h))
    total = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        total += mixed(h[i : len(h) - n + 1 + i], i + 1) * MULTIPLIERS[i]
    return np.unique(mixed(total))


def most_apart(size: int, num: int, den: int) -> int:
    """How many elements a set of this size and a linked one at most differ in."""
    return (den - num) * size // num


def blocks_of(band: int, num: int, den: int) -> int:
    """Blocks of a band's sketches: enough that the first D + 1 that aren't empty nearly always exist."""
    need = most_apart((2 << band) - 1, num, den) + 1
    return need + need // 8 + 2


def keys_of(elements: np.ndarray, num: int, den: int) -> np.ndarray:
    """The keys of a set that isn't empty."""
    n, out = len(elements), []
    need = most_apart(n, num, den) + 1
    band = n.bit_length() - 1
    values, places = mixed(elements, 3), elements >> np.uint64(24)
    for b in (band, band + 1):
        if b > band and n * den < num << b:
            break  # too small to link into the next band
        block = (places % np.uint64(blocks_of(b, num, den))).astype(np.int64)
        order = np.argsort(block, kind="stable")
        sorted_ = block[order]
        starts = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
        parity = np.bitwise_xor.reduceat(values[order], starts)
        used = parity != 0
        parity, at = parity[used][:need], sorted_[starts][used][:need]
        out.append(mixed(parity ^ mixed(at.astype(np.uint64), 16 + b), 5))
        if len(parity) < need:  # such sets, which are rare, also meet each other
            out.append(mixed(np.array([b], np.uint64), 7))
    return np.concatenate(out)


def parity_bits(elements: np.ndarray, bits: int, salt: int) -> np.ndarray:
    """A sketch of so many bits, a power of two, as 64-bit numbers: each element flips one."""
    odd = np.bincount((mixed(elements, salt) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_class(elements: np.ndarray) -> int:
    """One number for equal sets."""
    a, b = mixed(elements, 13).sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(elements, 17))
    return int(mixed(np.array([a ^ mixed(np.array([b], np.uint64), 19)[0]], np.uint64), len(elements)).astype(np.int64)[0])


SIGNED = f"doc_id long, tid long, n long, cls long, keys array<long>, long_ array<long>, {', '.join(f'{x} long' for x in LANES)}"


def signatures(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Of (doc_id, tid, text): set size, class, keys and short sketch; a document without a set has size 0 and nulls."""

    def run(batches):
        hashes = WordHashes()
        for batch in in_pieces(batches):
            sizes, classes, keys, sketches, longs = [], [], [], [], []
            for text in batch.column("text"):
                elements = shingle_set(text.as_py(), width, hashes)
                sizes.append(len(elements))
                some = len(elements) > 0
                classes.append(set_class(elements) if some else None)
                keys.append(keys_of(elements, num, den).astype(np.int64) if some else np.empty(0, np.int64))
                sketches.append(parity_bits(elements, 512, 11))
                longs.append(parity_bits(elements, LONG, 23))
            ends = np.concatenate(([0], np.cumsum([len(x) for x in keys]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))
            lanes = np.stack(sketches)
            long_ = pa.ListArray.from_arrays(pa.array(np.arange(len(longs) + 1, dtype=np.int32) * (LONG // 64)), pa.array(np.concatenate(longs)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tid"), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), lists, long_, *(pa.array(lanes[:, i]) for i in range(8))], names=["doc_id", "tid", "n", "cls", "keys", "long_", *LANES])

    return in_arrow(docs.select("doc_id", "tid", "text"), run, SIGNED)


def text_id(text: Column) -> Column:
    return F.xxhash64(F.lit("text"), text)


def close_enough(num: int, den: int) -> Column:
    """Whether sizes and short sketches let the sets of a row, (a_n, a_s0...) and (b_n, b_s0...), be linked."""
    apart = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"a_{x}").bitwiseXOR(F.col(f"b_{x}"))) for x in LANES))
    sizes = (F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num) & (apart * (den + num) <= (F.col("a_n") + F.col("b_n")) * (den - num))
    return sizes


def named(df: DataFrame, side: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{side}_{c}") for c in df.columns))


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Those of (a, b) that are linked, by their whole sets. Only texts of the classes at hand are exchanged."""
    with scratch(docs.sparkSession):
        known = classes.select("cls", "n", "long_")
        both = pairs.join(named(known, "a"), F.col("a") == F.col("a_cls")).join(named(known, "b"), F.col("b") == F.col("b_cls"))
        apart = F.aggregate(F.zip_with("a_long_", "b_long_", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
        hopeful = both.where(apart * (den + num) <= (F.col("a_n") + F.col("b_n")) * (den - num)).select("a", "b")
        return _verified(keep(hopeful, "pairs"), classes, docs, width, num, den)


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    wanted = keep(ends.join(classes.select("cls", "tid"), "cls"), "ends")
    texts, hit = maybe_in(docs.select("tid", "text"), "tid", wanted)
    texts = texts.where(hit).select("tid", "text").dropDuplicates(["tid"]).join(wanted, "tid")

    def run(batches):
        hashes = WordHashes()
        for batch in in_pieces(batches):
            sets = [shingle_set(x.as_py(), width, hashes).view(np.int64) for x in batch.column("text")]
            ends_ = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.ListArray.from_arrays(pa.array(ends_), pa.array(np.concatenate(sets)))], names=["cls", "elements"])

    sets = keep(in_arrow(texts.select("cls", "text"), run, "cls long, elements array<long>"), "sets")
    both = pairs.join(named(sets, "a"), F.col("a") == F.col("a_cls")).join(named(sets, "b"), F.col("b") == F.col("b_cls"))
    shared = F.size(F.array_intersect("a_elements", "b_elements"))
    linked = shared * den >= (F.size("a_elements") + F.size("b_elements") - shared) * num
    return keep(both.where(linked).select("a", "b"), "links", lasting=1)


def components(links: DataFrame) -> DataFrame:
    """(v, comp) of (a, b): the smallest class that each can reach. Labels fall to the smallest of the neighbours', then to their label's label."""
    edges = keep(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = keep(edges.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        seen = edges.join(labels, F.col("b") == F.col("v")).groupBy(F.col("a")).agg(F.min("comp").alias("near"))
        low = labels.join(seen, F.col("v") == F.col("a")).select("v", F.least("comp", "near").alias("low"), "comp")
        low = keep(low, "labels")
        next_ = keep(low.join(low.select(F.col("v").alias("w"), F.col("low").alias("lower")), F.col("low") == F.col("w")).select("v", F.least("low", "lower").alias("comp"), (F.col("comp") != F.least("low", "lower")).alias("moved")), "labels")
        labels = next_.select("v", "comp")
        if next_.where("moved").isEmpty():
            return labels


def joined_up(comps: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Components (v, comp) after more links (a, b)."""
    if links.isEmpty():
        return comps
    if comps is None:
        return components(links)
    for side in "ab":
        links = links.join(comps, F.col(side) == F.col("v"), "left").withColumn(side, F.coalesce("comp", side)).select("a", "b")
    links = links.where("a <> b")
    if links.isEmpty():
        return comps
    more = components(links)
    up = comps.join(more.select(F.col("v").alias("w"), F.col("comp").alias("higher")), F.col("comp") == F.col("w"), "left").select("v", F.coalesce("higher", "comp").alias("comp"))
    return keep(up.unionByName(more.join(comps.select("v"), "v", "left_anti")), "components")


def link_components(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """Of (doc_id, text): (doc_id, n_shingles, component_id); documents link when den * |A and B| >= num * |A or B|."""
    with scratch(docs.sparkSession):
        known = text_groups(docs, width, num, den)
        least = keep(known.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("many")), "least")
        hot = keep(least.where(F.col("many") > MANY).select("comp"), "hot")
        out = hot_join(known, least.drop("many"), "comp", hot, F.xxhash64("doc_id", "tid"))
        return keep(out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")), "components", lasting=1)


def text_groups(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Of (doc_id, text): (doc_id, tid, n, cls, comp): the text's hash, the size and class of its set and a name of its component; no class and component without a set."""
    with scratch(docs.sparkSession):
        return keep(_text_groups(docs, width, num, den), "groups", lasting=1)


def salts(many: str) -> Column:
    return F.expr(f"cast(({many} + {HOT - 1}) div {HOT} as long)")


def _text_groups(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    docs = ensure(docs, doc_id="long", text="string").withColumn("tid", text_id(F.col("text")))
    with scratch(docs.sparkSession):  # keys take room: what holds them goes as soon as it has been used
        with scratch(docs.sparkSession):
            all_ = keep(signatures(docs, width, num, den), "signed")
            wide = all_.where("n > 0").groupBy("cls").agg(*(F.first(c).alias(c) for c in ("tid", "n", *LANES, "long_", "keys")))
            wide = keep(wide, "classes", lasting=1)
            signed = keep(all_.select("doc_id", "tid", "n", "cls"), "signed", lasting=2)
        held = wide.select("cls", F.explode("keys").alias("key"))
        shared = keep(held.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.min_by("cls", F.xxhash64("key", "cls")).alias("leader")).where("many > 1"), "shared")
        marked, hit = maybe_in(held, "key", shared)
        members = keep(marked.where(hit).select("key", "cls").join(shared, "key"), "members", lasting=1)
        classes = keep(wide.drop("keys"), "classes", lasting=1)
    sketches = classes.select("cls", "n", *LANES)
    comps = None

    def sketched(pairs: DataFrame) -> DataFrame:
        return pairs.join(named(sketches, "a"), F.col("a") == F.col("a_cls")).join(named(sketches, "b"), F.col("b") == F.col("b_cls")).where(close_enough(num, den))

    def with_comps() -> DataFrame:
        out = members.select("key", "cls", "many")
        return out.withColumn("comp", F.col("cls")) if comps is None else out.join(comps, F.col("cls") == F.col("v"), "left").select("key", "cls", "many", F.coalesce("comp", "cls").alias("comp"))

    for round_ in range(ROUNDS):
        if comps is None:
            pairs = members.where("cls <> leader").select(F.col("cls").alias("a"), F.col("leader").alias("b"))
        else:  # another leader for each key whose members are still apart
            now = keep(with_comps(), "now")
            order = F.xxhash64("cls", "key", F.lit(round_))
            led = now.groupBy("key").agg(F.max("many").alias("many"), F.min_by("cls", order).alias("b"), F.min_by("comp", order).alias("b_comp"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
            led = led.select("key", "b", "b_comp", F.explode(F.sequence(F.lit(1), salts("many"))).alias("salt"))
            pairs = now.withColumn("salt", F.pmod(F.xxhash64("cls"), salts("many")) + 1).join(led, ["key", "salt"]).where("comp <> b_comp").select(F.col("cls").alias("a"), "b")
        near = sketched(pairs.distinct())
        apart = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"a_{x}").bitwiseXOR(F.col(f"b_{x}"))) for x in LANES))
        best = near.select("a", "b", F.row_number().over(Window.partitionBy("a").orderBy(apart, "b")).alias("rank")).where(F.col("rank") <= BEST)
        comps = joined_up(comps, verified(best.select("a", "b"), classes, docs, width, num, den))
    # what is left: classes that share a key and aren't joined; those of a large key meet block by block
    now = keep(with_comps().drop("many"), "open")
    mixed_keys = now.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("many")).where("low <> high")
    open_ = now.join(mixed_keys.select("key", F.expr(f"cast((many + {BLOCK - 1}) div {BLOCK} as long)").alias("blocks")), "key").join(sketches, "cls")
    open_ = keep(open_.withColumn("block", F.pmod(F.xxhash64("cls", F.lit("block")), "blocks")), "open")
    all_blocks = F.explode(F.expr("sequence(0L, blocks - 1)"))
    a, b = (named(open_.withColumn("facing", all_blocks), side) for side in "ab")
    meet = reduce(lambda x, y: x & y, (F.col(x) == F.col(y) for x, y in (("a_key", "b_key"), ("a_block", "b_facing"), ("a_facing", "b_block"))))
    rest = a.join(b, meet & (F.col("a_comp") < F.col("b_comp")) & close_enough(num, den)).select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b")).distinct()
    comps = joined_up(comps, verified(rest, classes, docs, width, num, den))
    out = signed if comps is None else signed.join(comps, F.col("cls") == F.col("v"), "left")
    return out.select("doc_id", "tid", "n", "cls", (F.coalesce("comp", "cls") if comps is not None else F.col("cls")).alias("comp"))


def one_of_each(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """`docs`, all columns, with one row of each component: that of the smallest doc_id (a null one comes last), the text of the smaller hash where the id is repeated, and one of rows that are alike in both. Rows without a set all stay."""
    row_id = lambda doc_id, text: F.xxhash64(F.lit("row"), doc_id, text)
    with scratch(docs.sparkSession):
        known = text_groups(docs, width, num, den).where("n > 0")
        best = known.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tid")).alias("w"))
        stays = best.select(row_id(F.col("w.doc_id"), F.col("w.tid")).alias("rid"), F.lit(True).alias("stays"))
        fate = known.groupBy(row_id(F.col("doc_id"), F.col("tid")).alias("rid")).agg(F.count(F.lit(1)).alias("many")).join(stays, "rid", "left")
        fate = keep(fate.where("stays is null or many > 1").select("rid", F.col("stays").isNotNull().alias("stays")), "fate", lasting=1)
    marked = packed(docs, "doc_id", "text").select(row_id(F.col("doc_id").cast("long"), text_id(F.col("text").cast("string"))).alias("rid"), "g_row")
    marked, hit = maybe_in(marked, "rid", fate)
    marked = marked.withColumn("f_hit", hit)
    # most rows surely stay and needn't be exchanged; of the others, repeated ones are told apart by nothing and the rest by a number
    doubtful = marked.where("f_hit").select("rid", "g_row").join(fate, "rid", "left").where("stays is null or stays")
    doubtful = doubtful.withColumn("alone", F.when(F.col("stays"), F.lit(-1)).otherwise(F.monotonically_increasing_id())).dropDuplicates(["rid", "alone"])
    return marked.where("not f_hit").select("g_row.*").unionByName(doubtful.select("g_row.*"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The components of documents whose sets of four-word shingles are 85% alike."""
    return link_components(table(spark, sf_dir, "documents"))


ORACLE_SQL = {
    "op6_ngram_jaccard_join": r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(list_slice(w, i, i + 3), ' ') as shingle from (select doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
e as (select x, y from p join n as nx on nx.doc_id = x join n as ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)),
b as (select x, y from e union select y, x from e),
r as (select distinct x as v, x as t from b union select r.v, b.y from r join b on b.x = r.t),
m as (select v, min(t) as least from r group by v)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(m.least, d.doc_id) as component_id from d left join n using (doc_id) left join m on m.v = d.doc_id
""",
}
