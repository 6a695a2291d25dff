"""Personal data: fixed shapes first, then bootstrapped contextual extraction.

Spans of the four base shapes, and values assigned to words like "token" or "password", are seeds. Each is an
instance that stands in patterns: the two words before it, and the word before with the word after, whole
words without quotes and brackets. Spark scores the pattern-instance graph: a pattern's confidence for a kind
is the share of its different instances that are known to be of it, and an instance's score joins the
confidences of its patterns. Any word of any text that stands in a pattern with enough known instances is a
candidate, and an instance that is discovered makes its other patterns candidates in the next round; rounds go
on until nothing is new. A pattern with too many other instances can't become confident, so a task names no more
of them than it takes to tell. Discovered instances become spans of kinds named like "near_phone", wherever they stand.

Defined cases: null and empty texts have no spans; spans of different kinds may overlap, those of a kind
don't; repeated rows get equal results and teach once, as only different instances count; ties are ordered
by start, then kind; empty tables give no rows; very long texts are read whole, in time in proportion to
their length; other columns aren't read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure, keep, map_batches, scratch, table

#: Base kinds in order, and their shapes.
KINDS = ("email", "ip", "card", "phone")
EMAIL_TAIL = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_HEAD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match can only begin where its digits do
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: Words that a secret is assigned to, and the shape of such an assignment.
SECRET_WORDS = ("token", "password", "passwd", "secret", "apikey", "api_key", "api-key", "access_key", "private_key", "auth_token")
SECRET_WORD = re.compile("|".join(SECRET_WORDS), re.IGNORECASE)
SECRET = re.compile(r"[\"']?\x20?[=:]\x20?[\"']?([^\s\"'<>(),;=:]{12,})")
ALL_KINDS = (*KINDS, "secret")
WORD = re.compile(r"[^\s\"'<>()\[\]{},;=:]+|[=:]")

LEAST_KNOWN = 3  # different known instances a pattern needs
CONFIDENT = 0.6  # the share of a pattern's instances that must be known, after smoothing
ACCEPT = 0.6  # an instance's score
LEAST_LENGTH = 5  # of a word that may be an instance
WORDS_KEPT = 200_000  # word hashes that a task keeps
SLOT_BITS = 22  # of the filters that go to the tasks, 4 MB each
SLOT = np.uint64((1 << SLOT_BITS) - 1)

NONDIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches; each holds one "@", so they are found from there."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        tail = EMAIL_TAIL.match(text, at + 1)
        if tail:
            begin = at
            while begin > free and text[begin - 1] in EMAIL_HEAD:
                begin -= 1
            if begin < at:
                out.append((begin, tail.end()))
                free = tail.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) in order; matches that fail their test are dropped."""
    out = [(b, 0, e) for b, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := NONDIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(NONDIGIT.sub("", m[0])) <= 15]
    return sorted(out)


def secrets(text: str) -> list[tuple[int, int]]:
    """Values with a digit that are assigned to a word for secrets."""
    out, free = [], 0
    for m in SECRET_WORD.finditer(text):
        if m.start() >= free and (value := SECRET.match(text, m.end())) and DIGIT.search(value[1]):
            out.append((value.start(1), value.end(1)))
            free = value.end(1)
    return out


def pattern_hash(side: int, a, b):
    """One number of two words' hashes and of which side they stand on; words are numbers or arrays of them."""
    with np.errstate(over="ignore"):
        x = (np.uint64(a) if np.isscalar(a) else a) * np.uint64(0x9E3779B97F4A7C15) + (np.uint64(b) if np.isscalar(b) else b) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(side)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


class WordHashes(dict):
    """Hashes of words in lower case and without points behind them, forgotten when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word.lower().rstrip(".!?"))
        return out


def patterns_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word: the pattern of the two words before it, and of the word before and the one after; 0 where they lack."""
    before, around = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
    if len(words) > 2:
        before[2:] = pattern_hash(1, words[:-2], words[1:-1])
        around[1:-1] = pattern_hash(2, words[:-2], words[2:])
    return before, around


def seed_instances(text: str, spans: list[tuple[int, int, int]], hashes: WordHashes) -> list[tuple[int, int, int]]:
    """(pattern, instance, kind) of (start, kind, end) spans."""
    words = [(m.start(), m.end(), m[0]) for m in WORD.finditer(text)]
    begins, ends = [w[0] for w in words], [w[1] for w in words]
    out = []
    for b, k, e in spans:
        i = bisect_left(ends, b + 1)  # the first word that reaches into the span
        j = bisect_left(begins, e)  # the first one behind it
        instance = hashes[text[b:e]]
        if i >= 2:
            out.append((int(pattern_hash(1, hashes[words[i - 2][2]], hashes[words[i - 1][2]])), instance, k))
        if i >= 1 and j < len(words):
            out.append((int(pattern_hash(2, hashes[words[i - 1][2]], hashes[words[j][2]])), instance, k))
    return out


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


SPANS = "array<struct<start:int,kind:int,end:int>>"
EDGES = "array<struct<pattern:long,instance:long,kind:int>>"
SCHEMA = f"doc_id long, text_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base {SPANS}, seeds {EDGES}"


def find_base(docs: DataFrame) -> DataFrame:
    """Of (doc_id, text_id, text): counts, the digest and spans of the base kinds and the assigned secrets, and the seeds' part of the graph."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    edge = pa.list_(pa.struct([("pattern", pa.int64()), ("instance", pa.int64()), ("kind", pa.int32())]))

    def make():
        hashes = WordHashes()

        def one(text: str | None) -> tuple:
            text = text or ""
            base = base_spans(text)
            counts = [sum(k == n for _, k, _ in base) for n in range(len(KINDS))]
            digest = hashlib.sha256(",".join(f"{KINDS[k]}:{b}:{e}" for b, k, e in base).encode()).hexdigest()
            all_ = sorted(base + [(b, len(KINDS), e) for b, e in secrets(text)])
            seeds = seed_instances(text, all_, hashes) if all_ else []
            return (*counts, digest, [{"start": b, "kind": k, "end": e} for b, k, e in all_], [{"pattern": signed(p), "instance": signed(i), "kind": k} for p, i, k in seeds])

        kinds = [pa.int64()] * 4 + [pa.string(), span, edge]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            cols = zip(*(one(x.as_py()) for x in batch.column("text")), strict=True)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["doc_id", "text_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "seeds"])

        return step

    return map_batches(docs.select("doc_id", "text_id", "text"), SCHEMA, make)


def slots_of(keys: DataFrame, value: str) -> np.ndarray:
    """A filter of `keys` (key, ...) of the same 4 MB whatever their number: each slot has the greatest `value` (0 to 255) of the keys in it; beyond some hundred thousand more words pass in vain."""
    parts = keys.select(F.col("key").bitwiseAND(F.lit((1 << SLOT_BITS) - 1)).cast("int").alias("slot"), F.expr(value).cast("int").alias("value")).groupBy("slot").agg(F.max("value").alias("value"))
    out = np.zeros(1 << SLOT_BITS, np.uint8)
    for batch in parts.toArrow().to_batches():  # no more rows than the filter has slots
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def free_words(text: str, words: list[str], found: list[int]) -> list[tuple[int, int, int]]:
    """(place among the words, start, end) of those found that are long enough and apart from the fixed shapes, without points behind them."""
    found = [i for i in found if len(words[i].rstrip(".!?")) >= LEAST_LENGTH]
    if not found:
        return []
    places = [m.start() for m in WORD.finditer(text)]
    taken, j, until, out = sorted([(b, e) for b, _, e in base_spans(text)] + secrets(text)), 0, 0, []
    for i in found:
        b = places[i]
        e = b + len(words[i].rstrip(".!?"))
        while j < len(taken) and taken[j][0] < e:
            until, j = max(until, taken[j][1]), j + 1
        if until <= b:
            out.append((i, b, e))
    return out


def find_edges(docs: DataFrame, limits: np.ndarray, instances: np.ndarray) -> DataFrame:
    """Of (text): different (pattern, instance) of words that may stand in a likely pattern, and of words that may be one of the instances with all their patterns.

    A slot of `limits` says, as a power of two, how many different instances leave its patterns any hope; a task tells one more than that, which is enough to reject a pattern.
    """

    def make():
        hashes, seen = WordHashes(), {}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            patterns, values = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                words = WORD.findall(text)
                if not words:
                    continue
                h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                contexts = patterns_of(h)
                known = instances[h & SLOT].astype(bool)
                wanted = []
                for context in contexts:
                    likely = (limits[context & SLOT] > 0) | known
                    wanted += [(i, p) for i, p in zip(np.flatnonzero(likely).tolist(), context[likely].tolist(), strict=True) if p and (known[i] or seen.get(p, ()) is not None)]
                if not wanted:
                    continue
                free = {i for i, _, _ in free_words(text, words, sorted({i for i, _ in wanted}))}
                for i, p in wanted:
                    if i in free:
                        had, value = seen.setdefault(p, set()), int(h[i])
                        if had is not None and value in had or had is None and not known[i]:
                            continue
                        patterns.append(signed(p))
                        values.append(signed(value))
                        if had is not None:
                            had.add(value)
                            limit = int(limits[p & SLOT])
                            if limit and len(had) > 1 << limit:
                                seen[p] = None  # no hope
            return pa.RecordBatch.from_arrays([pa.array(patterns, pa.int64()), pa.array(values, pa.int64())], names=["pattern", "instance"])

        return step

    return map_batches(docs.select("text"), "pattern long, instance long", make)


def find_places(docs: DataFrame, instances: np.ndarray) -> DataFrame:
    """Of (text_id, text): (text_id, start, end, instance) of words that may be one of the instances."""

    def make():
        hashes = WordHashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text_id, text in zip(batch.column("text_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                words = WORD.findall(text)
                h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                rows += [(text_id, b, e, signed(int(h[i]))) for i, b, e in free_words(text, words, np.flatnonzero(instances[h & SLOT]).tolist())]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["text_id", "start", "end", "instance"])

        return step

    return map_batches(docs.select("text_id", "text"), "text_id long, start int, end int, instance long", make)


def likely_patterns(edges: DataFrame, known: DataFrame) -> DataFrame:
    """(pattern, kind, sure) with at least LEAST_KNOWN different known instances; sure: the sum of their scores."""
    sums = edges.select("pattern", "instance").distinct().join(known, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("sure"), F.count(F.lit(1)).alias("n"))
    return sums.where(F.col("n") >= LEAST_KNOWN).select("pattern", "kind", "sure")


def score_graph(edges: DataFrame, seeds: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round on distinct (pattern, instance) edges and (instance, kind, score) of seeds and of all that is known: (pattern, kind, confidence) and the (instance, kind, score) that isn't a seed."""
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    patterns = likely_patterns(edges, known).join(sizes, "pattern").withColumn("confidence", F.col("sure") / (F.col("n") + 1))
    patterns = keep(patterns.where(F.col("confidence") >= CONFIDENT).select("pattern", "kind", "confidence"), "patterns")
    joined = edges.join(patterns, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.99)))))).alias("score"))
    return patterns, keep(joined.where(F.col("score") >= ACCEPT).join(seeds.select("instance").distinct(), "instance", "left_anti"), "instances")


def discover(docs: DataFrame, edges: DataFrame) -> DataFrame | None:
    """Of (text) and the seeds' distinct (pattern, instance, kind): the (instance, kind, score) that is discovered; None where nothing is."""
    seeds = keep(edges.select("instance", "kind").distinct().withColumn("score", F.lit(1.0)), "seeds")
    known, found, before = seeds, None, None
    graph = keep(edges.select("pattern", "instance").distinct(), "graph")
    while True:
        # what may be seen in this round: patterns with enough known instances, and what has been discovered
        likely = keep(likely_patterns(graph, known).groupBy(F.col("pattern").alias("key")).agg(F.max("sure").alias("sure")), "likely")
        new = keep((found if found is not None else seeds.limit(0)).select(F.col("instance").alias("key")).distinct(), "discovered")
        now = (likely.count(), new.count())
        if now == before or not now[0]:
            return found if now[1] else None
        before = now
        # a confident pattern has at most its known instances' scores over CONFIDENT different ones
        limits = slots_of(likely, f"least(60, ceil(log2(sure / {CONFIDENT} + 1)))")
        seen = find_edges(docs, limits, slots_of(new, "1"))
        graph = keep(seen.union(edges.select("pattern", "instance")).distinct(), "graph")
        _, more = score_graph(graph, seeds, known)
        found = more if found is None else keep(found.unionByName(more).groupBy("instance", "kind").agg(F.max("score").alias("score")), "instances")  # what is known stays known, so this ends
        known = seeds.unionByName(found)


def extract_pii(docs: DataFrame) -> DataFrame:
    """Of (doc_id, text): base counts and digest, all spans as "kind:start:end" by start and kind, and how many these are."""
    with scratch(docs.sparkSession):
        return keep(_extract_pii(docs), "pii", lasting=1)


def _extract_pii(docs: DataFrame) -> DataFrame:
    docs = ensure(docs, doc_id="long", text="string").withColumn("text_id", F.xxhash64("text", F.length("text")))
    rows = keep(find_base(docs), "base")
    edges = keep(rows.select(F.explode("seeds").alias("x")).select("x.*").distinct(), "edges")
    found = discover(docs, edges)
    out = rows.drop("seeds")
    if found is None:
        out = out.withColumn("more", F.lit(None).cast(SPANS))
    else:
        kinds = keep(found.groupBy("instance").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind")), "kinds")
        places = find_places(docs, slots_of(kinds.withColumnRenamed("instance", "key"), "1")).distinct()
        new = places.join(kinds, "instance")
        new = new.groupBy("text_id").agg(F.collect_list(F.struct("start", (F.col("kind") + len(ALL_KINDS)).alias("kind"), "end")).alias("more"))  # of one text
        out = out.join(new, "text_id", "left")
    names = F.lit([*ALL_KINDS, *(f"near_{k}" for k in ALL_KINDS)])
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.expr(f"cast(array() as {SPANS})"))))
    text = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.array_join(text, ",").alias("spans"), F.size(spans).cast("long").alias("n_spans"), F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_discovered"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of documents."""
    return extract_pii(table(spark, sf_dir, "documents"))
