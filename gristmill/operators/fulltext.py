"""Ranked full-text search: expansion, matching, BM25, priors, tiers, blending (FT-1 to FT-20).

A query's terms are few: one scan counts their hits in each document beside its length, one small aggregate
gives document frequencies over the whole corpus, and a top-k ends it. `index.py` keeps postings for many queries.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

#: Everyday words and the corpus's words for them, and expansions that need two words.
SYNONYMS = {
    "headlight": ["headlamp"], "headlights": ["headlamps"], "aiming": ["aligning", "alignment"], "aim": ["align"], "windshield": ["windscreen"], "windshields": ["windscreens"],
    "serpentine": ["auxiliaries", "auxiliary", "drive"], "intake": ["inlet"], "inlet": ["intake"], "rail": ["pipe", "pipes"], "capacity": ["volume", "liters", "litres"], "oxygen": ["o2", "ho2s"],
    "reset": ["initializing", "initialization", "calibration"], "calibration": ["initializing", "adaptation"], "calibrate": ["initialize", "adapt"], "boot": ["trunk"], "bonnet": ["hood"], "fender": ["wing"],
    "muffler": ["silencer"], "abs": ["bcm", "brake"], "gap": ["clearance", "electrode"], "bolt": ["screw"], "bolts": ["screws"], "screw": ["bolt"], "screws": ["bolts"], "pattern": ["sequence"], "patterns": ["sequences"],
}
PAIR_SYNONYMS = {("throttle", "body"): ("body", ["unit", "module"]), ("valve", "cover"): ("valve", ["camshaft"])}

K1, B = 1.2, 0.75
TITLE_WEIGHT, BODY_WEIGHT = 8.0, 1.0
TITLE_BONUS, SPEC_BONUS = 2.0, 4.0
CANDIDATES, MOST_ALTS = 30, 8


@dataclass
class Query:
    """A compiled query: for each term the wordings that stand for it, the term itself first."""

    text: str
    terms: list[str]
    groups: dict[str, list[str]] = field(default_factory=dict)

    @property
    def phrases(self) -> list[str]:
        """All wordings as phrases of index tokens, each once."""
        return list(dict.fromkeys(p for g in self.phrase_groups() for p in g))

    def phrase_groups(self) -> list[list[str]]:
        return [[p for w in wordings if (p := tx.index_phrase(w))] for wordings in self.groups.values()]

    def rendered(self, relaxed: bool = False) -> str:
        """The query as one line of text: every group, or any wording when relaxed."""
        quoted = [[f'"{w}"' for w in wordings] for wordings in self.groups.values()]
        if relaxed:
            quoted = [[w] for w in dict.fromkeys(w for g in quoted for w in g)]
        either = [g[0] if relaxed else f"({' OR '.join(g)})" for g in quoted]
        return (" OR " if relaxed else " AND ").join(either) or '""'


def expansions(terms: list[str], mined: dict[str, list[str]], phrases: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
    """(term, further wordings) by rules of three kinds: for a word alone, for two words anywhere in the query, for words side by side."""
    line = f" {' '.join(terms)} "
    rules = [(t, list(dict.fromkeys(SYNONYMS.get(t, []) + mined.get(t, [])))[:MOST_ALTS]) for t in dict.fromkeys(terms)]
    rules += [(target, extra) for pair, (target, extra) in PAIR_SYNONYMS.items() if set(pair) <= set(terms)]
    rules += [(phrase.split()[-1], alts) for phrase, alts in phrases.items() if " " in phrase.strip() and f" {' '.join(phrase.split())} " in line]
    return rules


def compile_query(text: str, mined: dict[str, list[str]] | None = None, phrases: dict[str, list[str]] | None = None) -> Query:
    """A query's terms with their wordings (FT-1 to FT-5)."""
    terms = tx.query_terms(text)
    out = Query(text, terms, {t: [t] for t in terms})
    for term, wordings in expansions(terms, mined or {}, phrases or {}):
        out.groups[term] += [w for w in wordings if w not in out.groups[term]]
    return out


def counted(docs: DataFrame, query: Query) -> DataFrame:
    """`docs` (doc_id, title, text, ...) with `dl` and, for phrase i, the weighted hits `f{i}`; texts are folded once.

    The counts come out of a generator of one row, which filters on them don't pass: else Spark counts in the filter and again behind it.
    """
    words = docs.withColumns({"_tw": tx.token_words(F.col("title")), "_bw": tx.token_words(F.col("text"))})
    lines = words.select(*docs.columns, (tx.word_total(F.col("_tw")) + tx.word_total(F.col("_bw"))).alias("dl"), tx.spaced_line(F.col("_tw")).alias("_tl"), tx.spaced_line(F.col("_bw")).alias("_bl"))
    counts = [(TITLE_WEIGHT * tx.hits(F.col("_tl"), p) + BODY_WEIGHT * tx.hits(F.col("_bl"), p)).alias(f"f{i}") for i, p in enumerate(query.phrases)]
    return lines.select(*docs.columns, F.inline(F.array(F.struct("dl", *counts))))


@dataclass
class Stats:
    """Of a corpus: documents, their mean length, and in how many each phrase stands."""

    n: int
    avgdl: float | None
    df: list[int]


def corpus_stats(rows: DataFrame, query: Query) -> Stats:
    """Over counted documents: one row comes to the driver."""
    of = [F.count_if(F.col(f"f{i}") > 0) for i in range(len(query.phrases))]
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"), F.array(*of).alias("df")).first()
    return Stats(r.n, r.avgdl, list(r.df))


def strictly(query: Query) -> Column:
    """Whether a counted document has a wording of each term."""
    at = {p: i for i, p in enumerate(query.phrases)}
    groups = [[F.col(f"f{at[p]}") > 0 for p in g] for g in query.phrase_groups()]
    return reduce(lambda a, b: a & b, (reduce(lambda a, b: a | b, g, F.lit(False)) for g in groups), F.lit(bool(groups)))


def ranked(rows: DataFrame, query: Query, stats: Stats, *keep: str) -> DataFrame:
    """Counted documents with any phrase: `keep` columns, `rank` (lower is better) and whether they match strictly (FT-7)."""
    phrases = query.phrases
    norm = K1 * (1 - B + B * F.col("dl") / F.lit(stats.avgdl or 1.0))
    score, some = F.lit(0.0), F.lit(False)
    for i in range(len(phrases)):
        idf, f = max(1e-6, math.log((stats.n - stats.df[i] + 0.5) / (stats.df[i] + 0.5))), F.col(f"f{i}")
        score, some = score + F.lit(idf) * f * (K1 + 1) / (f + norm), some | (f > 0)
    return rows.where(some).select(*keep, (-score).alias("rank"), strictly(query).alias("strict"))


def bm25(docs: DataFrame, query: Query, relaxed: bool = False) -> DataFrame:
    """Matching documents with `rank`: lower is better. Statistics are those of all of `docs`."""
    if not query.phrases:
        return docs.where("false").withColumn("rank", F.lit(0.0))
    rows = counted(docs, query)
    out = ranked(rows, query, corpus_stats(rows, query), *docs.columns)
    return (out if relaxed else out.where("strict")).drop("strict")


def top_k(rows: DataFrame, by: str | Column, k: int, key: str = "doc_id") -> DataFrame:
    return rows.orderBy(by, key).limit(k)


def reranked(rows: DataFrame, query: Query) -> DataFrame:
    """`adj`: the rank less a bonus for each query term in the title, and for spec tables when a value is asked for (FT-11)."""
    title = F.lower(F.coalesce("title", F.lit("")))
    bonus = sum((F.when(F.contains(title, F.lit(t)), TITLE_BONUS).otherwise(0.0) for t in query.terms if len(t) >= 3), F.lit(0.0))
    if tx.spec_intent(query.text):
        bonus = bonus + F.when(F.startswith(title, F.lit("tightening torque")), SPEC_BONUS).otherwise(0.0)
    return rows.withColumn("adj", F.col("rank") - bonus)


def penalised(rows: DataFrame, when: list[tuple[Column, float]]) -> DataFrame:
    """`rank` with additive penalties (FT-8)."""
    return rows.withColumn("rank", F.col("rank") + sum((F.when(c, p).otherwise(0.0) for c, p in when), F.lit(0.0)))


def tier(hits: DataFrame, query: Query, k: int = CANDIDATES) -> tuple[DataFrame, bool]:
    """Of ranked hits (strict, rank): the k best strict ones, and where fewer than two match and the query has several terms, the k best of all behind them; whether there are relaxed ones only (FT-10)."""
    strict = top_k(hits.where("strict"), "rank", k)
    n = strict.limit(2).count()
    if n >= 2 or len(query.terms) < 2:
        return strict, False
    every = top_k(hits, "rank", k)
    rows = every if not n else every.unionByName(strict.join(every.select("doc_id"), "doc_id", "left_anti"))
    return rows, not n and not every.isEmpty()


def relaxed_tier(docs: DataFrame, query: Query, k: int = CANDIDATES) -> DataFrame:
    """`tier` over documents, with `strict`."""
    rows = counted(docs, query)
    return tier(ranked(rows, query, corpus_stats(rows, query), *docs.columns), query, k)[0]


def blended(car: DataFrame, other: DataFrame, limit: int, low_confidence: bool = False) -> DataFrame:
    """Rows of the own tier first, room being kept for some of the others, and for more of them where the own tier is loose and the other strict (FT-12). Both have doc_id and adj, and count up to `limit` rows."""
    best = lambda rows: top_k(rows, "adj", limit).withColumn("at", F.row_number().over(Window.orderBy("adj", "doc_id")))
    own = best(car)
    others = best(other).join(own.select("doc_id"), "doc_id", "left_anti").withColumn("at", F.row_number().over(Window.orderBy("adj", "doc_id")))
    n_own, n_others = own.count(), others.count()
    room = max(2, limit - n_own)
    room = min(max(room, limit // 2) if low_confidence else room, n_others)
    rows = own.where(F.col("at") <= limit - room).withColumn("tier", F.lit(0)).unionByName(others.where(F.col("at") <= room).withColumn("tier", F.lit(1)), allowMissingColumns=True)
    return rows.withColumn("pos", F.row_number().over(Window.orderBy("tier", "at")) - 1)


def snippet(text: Column, terms: list[str], width: int = 24) -> Column:
    """The words around the first that begins with a query term (FT-9; our own cut, not an engine's)."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    at = F.array_position(F.transform(words, lambda w: F.exists(F.array(*map(F.lit, terms or [""])), lambda t: F.startswith(F.lower(w), t))), True)
    begin = F.greatest(F.lit(1), at.cast("int") - width // 2)
    cut = F.array_join(F.slice(words, begin, F.lit(width)), " ")
    return F.concat(F.when(begin > 1, "… ").otherwise(""), cut, F.when(F.size(words) >= begin + width, " …").otherwise(""))


def shaped(rows: DataFrame, family: str, enforce: bool = True, lead: int = 2800, lead_rows: int = 3) -> DataFrame:
    """Results with their lead text for the first few (FT-20). Needs pos, engine, text, scope.

    Where applicability is enforced, a document of another engine is labelled so and its lead withheld; one that
    isn't tagged, but begins with another engine, keeps its scope and loses its lead.
    """
    fits = tx.applicability(F.col("engine"), family) if enforce else F.lit("compatible")
    begins = (fits == "generic") & tx.names_only_others(F.left("text", F.lit(lead)), family) & (F.col("pos") < lead_rows)
    shown = (F.col("pos") < lead_rows) & (fits != "wrong") & ~begins
    warning = F.when(fits == "wrong", "written for another engine").when(begins, "begins with values of another engine")
    return rows.withColumns({"applicability": fits, "lead": F.when(shown, F.left("text", F.lit(lead))), "scope": F.when(fits == "wrong", "other engine (not this car)").otherwise(F.col("scope")), "warning": warning})


def conflicts(rows: DataFrame, anchors: list[str], first: int = 6) -> DataFrame:
    """Spec values that other scopes state and the own scope doesn't, among the first results (FT-21). Needs pos, scope, text."""
    pairs = F.regexp_extract_all("text", F.lit(r"(?i)([A-Za-z][A-Za-z /()-]{2,40}?)\D{0,12}?(\d{1,3})\s*Nm"), F.lit(0))
    said = rows.where(F.col("pos") < first).select("scope", F.explode(pairs).alias("p")).where(F.exists(F.array(*map(F.lit, anchors)), lambda a: F.contains(F.lower("p"), a)))
    value = F.regexp_extract("p", r"(?i)(\d{1,3})\s*Nm", 1).cast("int")
    own = F.collect_set(F.when(F.col("scope") == "this car", value))
    other = F.collect_set(F.when(F.col("scope") != "this car", value))
    both = said.agg(F.array_sort(own).alias("own_values"), F.array_sort(other).alias("other_values"))
    return both.withColumn("extra", F.array_except("other_values", "own_values")).where((F.size("own_values") > 0) & (F.size("extra") > 0))
