"""Language ID by a linear-chain conditional random field over words.

A word's emission sums learned weights of its affixes, letter n-grams and, for frequent words, the word
itself; learned transitions join the words of a text. Forward-backward gives each word's language, also in
code-switched text; a text's language is the one with most of its words. Emissions and transitions are fit
together by the gradient of the likelihood, what is expected of the model less what is seen, on whole texts of
a sample of labelled documents, whose sentences are shuffled so that languages switch between them.

Defined cases: a null text, or one without a letter, is "und" with score 0; without any labelled document
all texts are "und"; null and empty lang values teach nothing; repeated rows get equal results; ties go to the
language that is first in order; a run of letters without a break is words of at most 32 letters, all read;
very long texts are read whole, in blocks that are joined exactly and worked on a bounded number at a time;
empty tables give no rows; other columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure, held_out, in_arrow, in_pieces, keep, scratch, table

WORD = re.compile(r"[^\W\d_]{1,32}")
SENTENCE = re.compile(r"[.!?。！？\n]+")
UNKNOWN = "und"
#: The bounds of the fit: training documents of a language, about, picked by a hash of the id among those of at most so many characters.
DOCS_PER_LANG, LONGEST = 100, 100_000
MOST_LANGS = 500  # languages that are learned at most, those of the most documents: the field has a weight for each two of them
LEAST_RUN, SPLICE = 8, 40  # words of the shuffled runs of sentences, and of a training sequence, at least
STEPS, RATE, DECAY = 60, 0.15, 1e-4  # of the fit
BLOCK = 64  # words of a block in forward-backward
GROUP = 1 << 21  # numbers that a group of blocks holds at a time, about
FEW = 16  # languages up to which blocks are joined by their matrices, and beyond by vectors
CACHE = 1_000_000, 1 << 22  # words whose emissions are kept by a task, and their numbers, at most
TINY = 1e-12


def word_features(word: str) -> list[str]:
    padded = f"^{word}$"
    ends = [f"<{word[:n]}" for n in range(1, 5)] + [f">{word[-n:]}" for n in range(1, 5)]
    return ["=" + word, *ends, *(padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1))]


@dataclass
class Field:
    """A fitted field: languages, feature -> row of weights, transitions from row to column."""

    langs: list[str]
    features: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """The summed weights of each word's known features."""
        known, rows, ends = self.features.get, [], []
        for word in words:
            rows.append(len(self.weights))  # a row of zeros, so that no word is without one
            rows += [i for f in word_features(word) if (i := known(f)) is not None]
            ends.append(len(rows))
        weights = np.concatenate((self.weights, np.zeros((1, len(self.langs)), np.float32)))
        return np.add.reduceat(weights[rows], [0, *ends[:-1]], 0)


def potentials(scores: np.ndarray) -> np.ndarray:
    """exp of scores, each row (or the whole of transitions) scaled to 1 at most."""
    return (np.exp(scores - scores.max(-1, keepdims=True)) + TINY).astype(np.float32)


def unit(v: np.ndarray) -> np.ndarray:
    return v / v.sum(-1, keepdims=True)


class Blocks:
    """Texts that stand end to end, cut into blocks of BLOCK words; `e` has a row for each different word, `ids` names the word at each place."""

    def __init__(self, e: np.ndarray, ids: np.ndarray, lengths: np.ndarray, t: np.ndarray):
        self.e, self.ids, self.t, self.k = e, ids, t, e.shape[1]
        self.n = -(-lengths // BLOCK)  # blocks of each text
        self.first = np.concatenate(([0], np.cumsum(self.n)[:-1])).astype(np.int64)
        within = np.arange(self.n.sum()) - np.repeat(self.first, self.n)
        text_at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        self.start = np.repeat(text_at, self.n) + within * BLOCK
        self.size = np.minimum(BLOCK, np.repeat(lengths, self.n) - within * BLOCK)
        self.into = np.full((len(self.start), self.k), 1 / self.k, np.float32)  # the state before each block
        self.out_of = np.full((len(self.start), self.k), 1 / self.k, np.float32)  # what follows it, by the state at its end
        long_ = np.flatnonzero(self.n > 1)
        if len(long_):
            (self.join_by_matrices if self.k <= FEW else self.join_by_vectors)(long_)

    def at(self, blocks: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The potentials at place i of the blocks, and which blocks reach that far."""
        there = self.size[blocks] > i
        return self.e[self.ids[self.start[blocks] + np.where(there, i, 0)]], there

    def join_by_matrices(self, texts: np.ndarray) -> None:
        all_ = np.concatenate([np.arange(self.first[x], self.first[x] + self.n[x]) for x in texts.tolist()])
        step, k = max(1, GROUP // (self.k * self.k)), self.k
        whole = np.empty((len(all_), k, k), np.float32)
        for g in range(0, len(all_), step):
            blocks = all_[g : g + step]
            run = np.broadcast_to(np.eye(k, dtype=np.float32), (len(blocks), k, k))
            for i in range(BLOCK):
                e, there = self.at(blocks, i)
                new = (run.reshape(-1, k) @ self.t).reshape(-1, k, k) * e[:, None, :]
                new /= new.sum((1, 2), keepdims=True)
                run = new if there.all() else np.where(there[:, None, None], new, run)
            whole[g : g + step] = run
        at = 0
        for x in texts.tolist():
            n, b = int(self.n[x]), int(self.first[x])
            for j in range(1, n):
                self.into[b + j] = unit(self.into[b + j - 1] @ whole[at + j - 1])
            for j in range(n - 2, -1, -1):
                self.out_of[b + j] = unit(whole[at + j + 1] @ self.out_of[b + j + 1])
            at += n

    def join_by_vectors(self, texts: np.ndarray) -> None:
        most = int(self.n[texts].max())
        for j in range(most - 1):  # the blocks behind all of these are full
            blocks = self.first[texts[self.n[texts] > j + 1]] + j
            v = self.into[blocks]
            for i in range(BLOCK):
                v = unit((v @ self.t) * self.at(blocks, i)[0])
            self.into[blocks + 1] = v
        for j in range(most - 1, 0, -1):
            blocks = self.first[texts[self.n[texts] > j]] + j
            v = self.out_of[blocks]
            for i in range(BLOCK - 1, -1, -1):
                e, there = self.at(blocks, i)
                new = unit((v * e) @ self.t.T)
                v = new if there.all() else np.where(there[:, None], new, v)
            self.out_of[blocks - 1] = v

    def marginals(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(blocks, forward, backward, which places are words) for some blocks at a time; the product of both is each word's distribution, unscaled."""
        step = max(1, GROUP // (self.k * BLOCK))
        for g in range(0, len(self.start), step):
            blocks = np.arange(g, min(g + step, len(self.start)))
            forth, back = (np.empty((len(blocks), BLOCK, self.k), np.float32) for _ in range(2))
            v = self.into[blocks]
            for i in range(BLOCK):
                v = unit((v @ self.t) * self.at(blocks, i)[0])
                forth[:, i] = v
            v = self.out_of[blocks]
            for i in range(BLOCK - 1, -1, -1):
                back[:, i] = v
                e, there = self.at(blocks, i)
                new = unit((v * e) @ self.t.T)
                v = new if there.all() else np.where(there[:, None], new, v)
            yield blocks, forth, back, np.arange(BLOCK) < self.size[blocks, None]


def posteriors(blocks: Blocks) -> Iterator[np.ndarray]:
    """The distributions of the words, some at a time and in order."""
    for _, forth, back, real in blocks.marginals():
        yield unit((forth * back)[real])


def forward_backward(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The marginals (words, labels) of texts that stand end to end, each of lengths[i] > 0 words, given scores."""
    t = np.exp(transitions - transitions.max()).astype(np.float32)
    return np.concatenate(list(posteriors(Blocks(potentials(emissions), np.arange(len(emissions)), lengths, t))))


def expected(e: np.ndarray, ids: np.ndarray, lengths: np.ndarray, t: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the model expects less what is seen, for texts of at most BLOCK words: each word's distribution less its label, and the counts of transitions."""
    k, blocks = e.shape[1], Blocks(e, ids, lengths, t)
    words, pairs = [], np.zeros((k, k))
    own = np.eye(k, dtype=np.float32)
    for group, forth, back, real in blocks.marginals():
        words.append(unit((forth * back)[real]))
        before = blocks.into[group]
        for i in range(BLOCK):
            there = real[:, i]
            if not there.any():
                break
            here = e[ids[blocks.start[group[there]] + i]] * back[there, i]
            scale = ((before[there] @ t) * here).sum(1, keepdims=True)
            pairs += (before[there].T @ (here / scale)) * t
            before = forth[:, i]
    wrong = np.concatenate(words) - own[gold]
    inner = np.ones(len(ids), bool)
    inner[blocks.start] = False
    at = np.flatnonzero(inner)
    np.subtract.at(pairs, (gold[at - 1], gold[at]), 1)
    first = gold[blocks.start]  # no label is seen before the first word: there the model says, given that word's
    for b, n in zip(*np.unique(first, return_counts=True), strict=True):
        pairs[:, b] -= n * unit(t[:, b])
    return wrong, pairs


def fit_field(samples: list[tuple[str, list[str]]], seed: int = 7) -> Field | None:
    """The field of (lang, words of a run) by gradient steps on the likelihood of shuffled runs."""
    langs = sorted({lang for lang, words in samples if words})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    by_lang = {lang: [w for x, w in samples if x == lang and w] for lang in langs}
    most = max(map(len, by_lang.values()))
    pool = [(i, w) for i, lang in enumerate(langs) for w in (by_lang[lang] * -(-min(most, 4 * len(by_lang[lang])) // len(by_lang[lang])))]
    words, gold, lengths, n = [], [], [], 0
    for i in rng.permutation(len(pool)).tolist():
        lang, run = pool[i]
        words += run
        gold += [lang] * len(run)
        n += len(run)
        if n >= SPLICE:
            lengths += [BLOCK] * (n // BLOCK) + ([n % BLOCK] if n % BLOCK else [])
            n = 0
    lengths += [BLOCK] * (n // BLOCK) + ([n % BLOCK] if n % BLOCK else [])
    ids: dict[str, int] = {}
    token = np.array([ids.setdefault(w, len(ids)) for w in words])
    counts = np.bincount(token)
    feats = [[f for f in word_features(w) if f[0] != "=" or counts[i] >= 3] for w, i in ids.items()]
    seen: dict[str, int] = {}
    for fs in feats:
        for f in fs:
            seen[f] = seen.get(f, 0) + 1
    features = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= 2 or f[0] == "="))}
    known = [[features[f] for f in fs if f in features] for fs in feats]
    of_word = np.repeat(np.arange(len(ids)), [len(x) for x in known])
    of_feature = np.array([i for x in known for i in x], np.int64)
    k, n, gold_, lengths_ = len(langs), len(token), np.array(gold), np.array(lengths)
    w, t = np.zeros((len(features), k)), np.zeros((k, k))
    gw, gt = np.zeros_like(w), np.zeros_like(t)

    def summed(values: np.ndarray, to: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(to, values[:, j], size) for j in range(k)], 1)

    for _ in range(STEPS):
        e = potentials(summed(w[of_feature], of_word, len(ids)))
        wrong, pairs = expected(e, token, lengths_, np.exp(t - t.max()).astype(np.float32), gold_)
        grad = summed(summed(wrong, token, len(ids))[of_word], of_feature, len(features)) + DECAY * n * w
        gw += grad**2
        w -= RATE * grad / (np.sqrt(gw) + 1e-6)
        grad = pairs + DECAY * n * t
        gt += grad**2
        t -= RATE * grad / (np.sqrt(gt) + 1e-6)
    return Field(langs, features, w.astype(np.float32), t.astype(np.float32))


def runs_of(text: str) -> list[list[str]]:
    """The words of a whole text in runs of whole sentences, each of at least LEAST_RUN words but the last."""
    out, run = [], []
    for sentence in SENTENCE.split(text.lower()):
        run += WORD.findall(sentence)
        if len(run) >= LEAST_RUN:
            out.append(run)
            run = []
    return out + [run] if run else out


def training_runs(docs: DataFrame, most: int = DOCS_PER_LANG, longest: int = LONGEST) -> list[tuple[str, list[str]]]:
    """(lang, words) runs of all sentences of about `most` documents of each language, picked by a hash of the id among those of at most `longest` characters."""
    rows = docs.where("text is not null and lang is not null and lang <> '' and doc_id is not null").where(~held_out(F.col("doc_id"), 4, 2)).where(F.length("text") <= longest)
    with scratch(docs.sparkSession):
        names = keep(rows.select("doc_id", "lang"), "training-rows")  # without texts, which stay in their scan
        counts = names.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGS)
        share = F.broadcast(counts.select("lang", F.least(F.lit(1.0), F.lit(most) / F.col("n")).alias("share")))
        chosen = names.join(share, "lang").where(F.pmod(F.xxhash64(F.lit("pick"), "doc_id"), F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("doc_id").distinct()
        chosen = keep(chosen, "chosen", lasting=1)
    picked = rows.join(F.broadcast(chosen), "doc_id")  # about `most` ids for each of MOST_LANGS languages
    found = sorted((r.lang, r.text) for r in picked.select("lang", "text").distinct().collect())
    return [(lang, run) for lang, text in found for run in runs_of(text)]


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, n_words long, n_switches long"


class Cache:
    """Rows of emission potentials for words, forgotten when there are too many."""

    def __init__(self, field: Field):
        self.field, self.at = field, {}
        self.most = min(CACHE[0], CACHE[1] // len(field.langs))
        self.rows = np.empty((self.most, len(field.langs)), np.float32)

    def ids(self, words: list[str]) -> np.ndarray:
        new = set(words) - self.at.keys()
        if len(self.at) + len(new) > len(self.rows):  # forget all; a single piece may need more room than the cache has
            self.at.clear()
            new = set(words)
            self.rows = np.empty((max(self.most, len(new)), len(self.field.langs)), np.float32)
        if new:
            some, at = list(new), len(self.at)
            self.rows[at : at + len(some)] = potentials(self.field.emissions(some))
            self.at.update(zip(some, range(at, at + len(some)), strict=True))
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))


def identify_language(docs: DataFrame, field: Field | None) -> DataFrame:
    """Of (doc_id, text, held_out): the language of most words, its mean probability, and how often the words' language switches."""

    def run(batches):
        k = len(field.langs) if field else 0
        cache = Cache(field) if field else None
        t = np.exp(field.transitions - field.transitions.max()).astype(np.float32) if field else None
        for batch in in_pieces(batches, 300_000 if k <= FEW else 5_000_000 // k):
            n_docs = batch.num_rows
            texts = [WORD.findall(x.as_py().lower()) if x.is_valid else [] for x in batch.column("text")]
            lengths = np.array([len(x) for x in texts])
            pred, score, switches = np.full(n_docs, -1), np.zeros(n_docs), np.zeros(n_docs, np.int64)
            some = np.flatnonzero(lengths)
            if k and len(some):
                own = lengths[some]
                ids = cache.ids([w for x in texts for w in x])
                starts = np.concatenate(([0], np.cumsum(own)[:-1]))
                text_of = np.repeat(np.arange(len(some)), own)
                sums, best, at = np.zeros((len(some), k)), np.empty(len(ids), np.int32), 0
                for part in posteriors(Blocks(cache.rows, ids, own, t)):
                    of = text_of[at : at + len(part)]
                    low = int(of[0])
                    cuts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
                    sums[low : low + len(cuts)] += np.add.reduceat(part.astype(np.float64), cuts, 0)
                    best[at : at + len(part)] = part.argmax(1)
                    at += len(part)
                turn = np.concatenate(([False], best[1:] != best[:-1]))
                turn[starts] = False
                pred[some], score[some], switches[some] = sums.argmax(1), sums.max(1) / own, np.add.reduceat(turn.astype(np.int64), starts)
            names = [field.langs[i] if i >= 0 else UNKNOWN for i in pred] if field else [UNKNOWN] * n_docs
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(lengths, pa.int64()), pa.array(switches)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return in_arrow(docs, run, SCHEMA)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of documents, learned from the rows that aren't held out."""
    docs = ensure(table(spark, sf_dir, "documents"), doc_id="long", text="string", lang="string")
    with scratch(spark):
        field = fit_field(training_runs(docs))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id"), 4, 2).alias("held_out"))
    return identify_language(rows, field).select("doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches")
