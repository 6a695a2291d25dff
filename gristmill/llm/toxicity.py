"""Toxicity by a weighted lexicon that one Aho-Corasick pass matches in folded text.

Folding lower-cases, maps look-alike letters to the plain ones, and undoes digit substitutions in words
that mix letters with digits. The lexicon holds words, which need a boundary on both sides, and stems,
which need one before. Hits inside exception phrases don't count. A score sums the weights of the hits and
is normalised by the text's length. Words, stems and weights are learned from labelled documents; a short
list of plain words stands in where no label speaks.

Defined cases: null and empty texts score 0; labels that are null or missing teach nothing, and without
any labels the plain list alone holds; repeated training texts teach once; a doc_id with several labels is
toxic if one is; empty tables give no rows; texts of any length and make are read whole, in time in
proportion to it; ties between a word and its stem go to the greater weight; other columns aren't read.
"""

from __future__ import annotations

import math
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure, held_out, keep, map_batches, scratch, table

#: Plain words, and phrases in which such words mean no harm.
PLAIN = ("clown", "disgusting", "idiot", "idiots", "imbecile", "loser", "losers", "moron", "morons", "pathetic", "scum", "scumbag", "stupid", "trash", "vermin", "worthless")
EXCEPTIONS = ("trash can", "trash bin", "trash collection", "clown fish", "clown car", "circus clown", "sore loser rule", "idiot proof", "idiot light", "stupid simple", "pond scum", "soap scum", "worthless check")
#: Letters that look like plain ones.
LOOKALIKES = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ӏ": "l", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "ı": "i", "ɑ": "a", "ɡ": "g"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
FOLD = str.maketrans(LOOKALIKES | {chr(0xFF41 + i): chr(97 + i) for i in range(26)} | {c: None for c in "​‌‍⁠­﻿"})
UNDIGIT = str.maketrans(DIGITS)
ODD = re.compile(r"[0-9@$!]")
LOOKS = re.compile("[" + "".join(map(chr, FOLD)) + "]")
RUN = re.compile(r"(?:[^\W_]|[@$!])+")
WORD = re.compile(r"[^\W\d_]+")

SAMPLE, CLEAN_SAMPLE = 3000, 30_000  # training documents of each label, and clean ones for a second look, at most, about: the bounds of the fit
STEMS = (4, 5, 6, 7)  # lengths of stems
LEAST_SHARE, LEAST_DOCS, PURITY = 0.01, 4, 0.95
DOUBT = 4  # clean documents of the sample that each entry is taken to stand in besides those seen
PRIOR, TOP_WEIGHT = 2.5, 4.5
BLOCK_AT = 0.7
SCALE = 500  # words after which a text counts as long


def fold(text: str) -> str:
    """Lower case, look-alike letters made plain, and digits and signs made letters in runs that hold one before a letter. Every place is looked at a bounded number of times."""
    low = text.lower()
    if not low.isascii() and LOOKS.search(low):
        low = low.translate(FOLD)
    out, done = [], 0
    for odd in ODD.finditer(low):
        at = begin = odd.start()
        if at < done:
            continue
        while begin > done and low[begin - 1].isalnum():  # the letters of its run that stand before it
            begin -= 1
        end = RUN.match(low, at).end()
        body = low[begin:end].rstrip("@$!")  # signs behind a word are no letters
        last = next((i for i in range(len(body) - 1, -1, -1) if body[i].isalpha()), 0)  # digits behind it alone change nothing
        if ODD.search(body, 0, last):
            out += (low[done:begin], body.translate(UNDIGIT), low[begin + len(body) : end])
        else:
            out.append(low[done:end])
        done = end
    return "".join((*out, low[done:])) if out else low


def automaton(weights: dict[str, float], exceptions=EXCEPTIONS) -> ahocorasick.Automaton:
    """weights: by "w:" and a word or "s:" and a stem."""
    found: dict[str, dict] = {}
    for key, weight in weights.items():
        found.setdefault(key[2:], {})[key[0]] = weight
    for phrase in exceptions:
        found.setdefault(phrase, {})["x"] = 0.0
    out = ahocorasick.Automaton()
    for term, kinds in found.items():
        out.add_word(term, (len(term), kinds))
    if found:
        out.make_automaton()
    return out


def lexicon_hits(low: str, lexicon: ahocorasick.Automaton) -> list[float]:
    """The weights of all hits in folded text."""
    hits, safe = [], []
    if not len(lexicon):
        return hits
    for end, (n, kinds) in lexicon.iter(low):
        begin, end = end + 1 - n, end + 1
        if begin and low[begin - 1].isalpha():
            continue
        closed = end == len(low) or not low[end].isalpha()
        if closed and "x" in kinds:
            safe.append((begin, end))
        if closed and "w" in kinds:
            hits.append((begin, kinds["w"]))
        elif "s" in kinds:
            hits.append((begin, kinds["s"]))
    starts: dict[int, float] = {}  # one hit a word
    for begin, weight in hits:
        starts[begin] = max(weight, starts.get(begin, 0.0))
    if not safe:
        return list(starts.values())
    safe.sort()
    out, i, until = [], 0, 0
    for begin in sorted(starts):
        while i < len(safe) and safe[i][0] <= begin:
            until = max(until, safe[i][1])
            i += 1
        if begin >= until:
            out.append(starts[begin])
    return out


def score_text(text: str | None, lexicon: ahocorasick.Automaton) -> tuple[float, int]:
    """(score, hits) of a whole text."""
    if not text:
        return 0.0, 0
    hits = lexicon_hits(fold(text), lexicon)
    if not hits:
        return 0.0, 0
    return 1 - math.exp(-sum(hits) / (1 + math.log2(1 + len(text.split()) / SCALE))), len(hits)


def training_sample(docs: DataFrame, labels: DataFrame, most: dict[int, int]) -> DataFrame:
    """(text, toxic, share) of about most[label] labelled documents of each label, picked by a hash of the id; share: of that label's documents."""
    labels = ensure(labels, doc_id="long", toxic="int").where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labels = labels.where(~held_out(F.col("doc_id"), 3, 1))
    shares = {r.toxic: min(1.0, most.get(r.toxic, 0) / r["count"]) for r in labels.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for toxic, s in shares.items():
        share = F.when(F.col("toxic") == toxic, s).otherwise(share)
    picked = labels.withColumn("share", share).where(F.pmod(F.xxhash64(F.lit("pick"), "doc_id"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    picked = picked.limit(2 * sum(most.values()))  # the bound that lets it be broadcast
    return ensure(docs, doc_id="long", text="string").join(F.broadcast(picked), "doc_id").select("text", "toxic", "share")


def text_features(text: str | None) -> set[str]:
    words = set(WORD.findall(fold(text or "")))
    return {"w:" + w for w in words if 3 <= len(w) <= 40} | {"s:" + w[:n] for w in words for n in STEMS if len(w) > n}


def count_features(sample: DataFrame, only: frozenset[str] | None = None) -> DataFrame:
    """(feature, bad, good, ratio) over the different texts of the sample: in how many toxic and clean ones a feature stands, and clean to toxic in all documents. The feature "" stands in all."""
    hashed = sample.withColumn("id", F.xxhash64("text"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for x, i, t, s in zip(*(batch.column(c).to_pylist() for c in ("text", "id", "toxic", "share")), strict=True):
                features = text_features(x)
                rows += [(f, i, t, s) for f in ("", *(features if only is None else features & only))]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.float64()), strict=True)], names=["feature", "id", "toxic", "share"])

        return step

    seen = map_batches(hashed, "feature string, id long, toxic int, share double", make).dropDuplicates(["feature", "id"])
    toxic = F.col("toxic") == 1
    clean, bad = F.sum(F.when(~toxic, 1 / F.col("share")).otherwise(0.0)), F.sum(F.when(toxic, 1 / F.col("share")).otherwise(0.0))
    return seen.groupBy("feature").agg(F.sum(toxic.cast("int")).alias("bad"), F.sum((~toxic).cast("int")).alias("good"), F.try_divide(clean, bad).alias("ratio"))


def learn_weights(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> dict[str, float]:
    """Weights of words and stems: log odds of standing in a toxic text, for those that are nearly pure."""
    with scratch(docs.sparkSession):
        return _learn_weights(docs, labels, most)


def _learn_weights(docs: DataFrame, labels: DataFrame, most: int) -> dict[str, float]:
    seen = keep(count_features(training_sample(docs, labels, {1: most, 0: most})), "features")
    all_ = seen.where("feature = ''").first()
    if all_ is None or not all_.bad:
        return {"w:" + w: PRIOR for w in PLAIN}
    n_bad = all_.bad
    least = max(LEAST_DOCS, round(LEAST_SHARE * n_bad))  # this share bounds the entries by a hundred times the features of a text of the sample
    first = {r.feature: r for r in seen.where((F.col("bad") >= least) & (F.col("ratio") <= 0.25) & (F.col("feature") != "")).collect()}
    second = {r.feature: r for r in count_features(training_sample(docs, labels, {1: most, 0: CLEAN_SAMPLE}), frozenset(first)).collect()}
    n_good = second[""].good
    rows = [r for f, r in second.items() if f and r.bad >= least and 1 / (1 + r.ratio) >= PURITY]
    words, weights = {}, {"w:" + w: PRIOR for w in PLAIN}
    odds = lambda r: min(TOP_WEIGHT, math.log(r.bad / n_bad) - math.log((r.good + DOUBT) / (n_good + DOUBT)))
    for r in rows:
        if r.feature[0] == "w":
            words[r.feature[2:]] = r
    stems: dict[str, float] = {}
    for r in sorted(rows, key=lambda r: (len(r.feature), r.feature)):
        stem = r.feature[2:]
        if r.feature[0] == "s" and not any(stem[:n] in stems for n in STEMS):
            best = max((w.bad for x, w in words.items() if x.startswith(stem)), default=0)
            if r.bad > 1.3 * best:  # else the word says it
                stems[stem] = odds(r)
    weights |= {"w:" + w: max(odds(r), weights.get("w:" + w, 0.0)) for w, r in words.items() if not any(w[:n] in stems for n in STEMS)}
    return weights | {"s:" + s: w for s, w in stems.items()}


def score_toxicity(docs: DataFrame, weights: dict[str, float], exceptions=EXCEPTIONS, text: str = "text") -> DataFrame:
    """`docs` without its text, and with score and hits."""
    kept = [f for f in docs.schema.fields if f.name != text]

    def make():
        lexicon = automaton(weights, exceptions)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores, hits = zip(*(score_text(x.as_py(), lexicon) for x in batch.column(text)), strict=True)
            return pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(scores, pa.float64()), pa.array(hits, pa.int32())], names=[*(f.name for f in kept), "score", "hits"])

        return step

    return map_batches(docs, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "score double, hits int"]), make)


def mark_toxic(docs: DataFrame, weights: dict[str, float], exceptions=EXCEPTIONS) -> DataFrame:
    """`docs` with all its columns that are not toxic: the filter of a pipeline."""

    def make():
        lexicon = automaton(weights, exceptions)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([score_text(x.as_py(), lexicon)[0] < BLOCK_AT for x in batch.column("text")], pa.bool_()))

        return step

    return map_batches(docs, docs.schema, make)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of documents, learned from the labels that aren't held out."""
    docs = ensure(table(spark, sf_dir, "documents"), doc_id="long", text="string")
    out = score_toxicity(docs, learn_weights(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= BLOCK_AT).cast("int").alias("predicted"), "hits")
