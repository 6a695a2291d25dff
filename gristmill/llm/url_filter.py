"""URL filters: rules by host and path, then a weighted vocabulary that one Aho-Corasick pass counts.

A term counts where no ASCII letter or digit stands before or after it. Each has a weight: one strict term
reaches the limit alone, and soft terms reach it together, when several different ones stand in a url. The
vocabulary is a parameter, and may be read from a table of terms and weights.

Defined cases: a null url, or one without "://", has empty host and path and fits no rule; a null url is
allowed; an empty table gives no rows; repeated rows and extra columns change nothing; a repeated term has its
greatest weight; a very long url is read whole; of rules of one length the later name holds.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure, map_batches, table

#: The rules as (host, path, verdict).
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
#: Terms by weight, in English, Spanish, German and French: those that reject alone, those of which two do, and those that only add to others.
LIMIT = 4
WEIGHTS = {
    4: ("casino", "casinos", "porn", "porno", "pornografia", "pornographie", "xxx", "xvideos", "hentai", "viagra", "cialis", "escorts", "escort", "jackpot", "sexcam", "camgirls", "tragaperras", "spielautomaten", "spielbank"),
    2: ("adult", "adulto", "bet", "bets", "betting", "apuestas", "wetten", "poker", "slots", "roulette", "ruleta", "loan", "loans", "kredit", "pharmacy", "farmacia", "apotheke", "pharmacie", "pills", "sexy", "sex", "nude", "dating", "torrent", "torrents", "warez", "crack", "keygen", "replica", "lottery", "loteria"),
    1: ("bonus", "cheap", "barato", "billig", "diet", "free", "gratis", "gratuit", "kostenlos", "win", "winner", "prize", "premio", "discount", "rabatt", "hot", "singles", "rx"),
}
VOCABULARY = {term: weight for weight, terms in WEIGHTS.items() for term in terms}
MOST_TERMS = 1_000_000  # of a vocabulary that is read from a table: it goes to every task

A_Z_PAIR = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
A_Z = str.maketrans(*A_Z_PAIR)
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
SCHEMA = "page_id long, host string, path string, rule string, verdict string, strict_hits int, soft_hits int, weight int"


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path; both empty where there is no "://"."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return rest[:end].translate(A_Z), tail[:stop]


def fitting_rule(host: str, path: str, rules=RULES) -> tuple[str, str] | None:
    """The longest fitting rule as (name, verdict)."""
    fits = [(h + p, verdict) for h, p, verdict in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: (len(r[0]), r[0]), default=None)


def read_vocabulary(terms: DataFrame) -> dict[str, int]:
    """Of (term, weight): the weights by lower-cased term; null and empty terms and such without a weight above 0 say nothing."""
    rows = ensure(terms, term="string", weight="int").where("term <> '' and weight > 0").groupBy(F.translate("term", *A_Z_PAIR).alias("term")).agg(F.max("weight").alias("weight"))
    found = rows.limit(MOST_TERMS + 1).collect()
    if len(found) > MOST_TERMS:
        raise ValueError(f"a vocabulary of more than {MOST_TERMS} terms")
    return {r.term: r.weight for r in found}


def automaton_of(vocabulary: dict[str, int]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term, weight in vocabulary.items():
        found.add_word(term, (term, weight))
    if vocabulary:
        found.make_automaton()
    return found


def term_hits(url: str, automaton: ahocorasick.Automaton) -> dict[str, int]:
    """The different terms with a boundary on both sides, and their weights."""
    low, out = url.translate(A_Z), {}
    if not len(automaton):
        return out
    for end, (term, weight) in automaton.iter(low):
        begin = end + 1 - len(term)
        if (begin == 0 or low[begin - 1] not in LETTERS) and (end + 1 == len(low) or low[end + 1] not in LETTERS):
            out[term] = weight
    return out


def judge_urls(pages: DataFrame, rules=RULES, vocabulary: dict[str, int] | None = None, limit: int = LIMIT) -> DataFrame:
    """Of (page_id, url): host, path, the rule that holds, the verdict, the counts of different strict and soft terms, and their weight."""
    terms = VOCABULARY if vocabulary is None else vocabulary

    def make():
        automaton = automaton_of(terms)

        def one(url: str | None) -> tuple:
            host, path = split_url(url)
            rule = fitting_rule(host, path, rules)
            hits = term_hits(url or "", automaton)
            strict, weight = sum(w >= limit for w in hits.values()), sum(hits.values())
            verdict = rule[1] if rule else "block" if weight >= limit else "allow"
            return host, path, rule and rule[0], verdict, strict, len(hits) - strict, weight

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = list(zip(*map(one, batch.column("url").to_pylist()), strict=True))
            kinds = [pa.string()] * 4 + [pa.int32()] * 3
            return pa.RecordBatch.from_arrays([batch.column("page_id"), *(pa.array(c, k) for c, k in zip(rows, kinds, strict=True))], names=["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits", "weight"])

        return step

    return map_batches(ensure(pages, page_id="long", url="string"), SCHEMA, make)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judge_urls(table(spark, sf_dir, "pages"))


def _terms_sql(low: int, high: int, weighted: bool) -> str:
    return " + ".join(f"{w if weighted else 1} * regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::int" for t, w in VOCABULARY.items() if low <= w < high)


ORACLE_SQL = {
    "op10_url_filter": f"""
with a as (select page_id, coalesce(url, '') as url, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low, strpos(coalesce(url, ''), '://') as mark from pages),
b as (select *, case when mark > 0 then substr(url, mark + 3) else '' end as rest from a),
c as (select *, regexp_extract(rest, '^[^/?#]*') as rawhost from b),
d as (select page_id, low, translate(rawhost, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(substr(rest, length(rawhost) + 1), '^[^?#]*') as path from c),
r(rh, rp, rv) as (values {", ".join(repr(x) for x in RULES)}),
f as (select page_id, host, path, rh || rp as rule, rv, row_number() over (partition by page_id, host, path order by length(rh || rp) desc) as k from d, r where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)),
t as (select *, ({_terms_sql(LIMIT, 99, False)})::int as strict_hits, ({_terms_sql(0, LIMIT, False)})::int as soft_hits, ({_terms_sql(0, 99, True)})::int as weight from d)
select t.page_id, t.host, t.path, f.rule, coalesce(f.rv, case when weight >= {LIMIT} then 'block' else 'allow' end) as verdict, strict_hits, soft_hits, weight
from t left join f on t.page_id = f.page_id and t.host = f.host and t.path = f.path and f.k = 1
""",
}
