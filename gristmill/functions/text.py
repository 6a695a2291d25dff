"""Scalar text functions as Column expressions; all stay in the JVM."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that a query drops, unless nothing else is left.
STOP_TERMS = frozenset({"part", "parts", "number", "oem", "pn", "procedure", "procedures", "instructions", "instruction", "steps", "guide", "how", "howto", "recommended", "proper", "correct", "official"})
#: Shapes of engine codes (three families), of a spec value's unit, and of a document reference.
ENGINE_CODE = r"\bB2\d{2}(?!\d)(?:[A-Z][A-Z0-9]*)?|\bB[4568]\d{3}(?!\d)(?:[A-Z][A-Z0-9]*)?|\bD\d{2,4}(?!\d)(?:[A-Z][A-Z0-9]*)?"
MAGNITUDE = r"(?i)(\d+(?:[.,]\d+)?)\s*(?:n[\s·.\-]?m|nm|newton[\s\-]?met(?:re|er)s?)\b"
CITATION = r"(?i)\(?\s*VCC-?[0-9A-Za-z]+-?[0-9A-Za-z]*\s*\)?"
#: Wordings by which an answer refuses or asks back, and by which a question asks for a value.
REFUSAL_CUES = ("could ?n'?t find", "couldn'?t verify", "could not (?:find|verify)", "no verified", "nothing in the verified", "not able to verify", "unable to verify", "don'?t have a verified", "i (?:can'?t|cannot) confirm")
ELICIT_CUES = ("which vehicle", "give me the vin", "what'?s the vin", "what (?:model|year|engine)", "(?:tell|give) me .{0,30}(?:vin|engine code|model|year)", "need the car", "so i can narrow", "to narrow (?:the search|it|down|your search)")
SPEC_INTENT = r"(?i)\btorque|\btightening|\bnm\b|\bnewton|\btighten"
#: Beginnings of a title that name an action.
LEADING_VERBS = ("Replacing", "Removing", "Installing", "Checking", "Replacement of")


#: Accented small letters and the plain letters that they are built on, by Unicode's own decompositions.
ACCENTED = {c: plain for c in map(chr, (*range(0xDF, 0x250), *range(0x1E00, 0x1F00))) if c.islower() and (plain := unicodedata.normalize("NFD", c)[0]) != c and plain.isascii()}


def folded(text: Column) -> Column:
    """Lower-cased, without accents; only texts beyond ASCII are looked through for these."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.octet_length(low) > F.length(low), F.translate(low, "".join(ACCENTED), "".join(ACCENTED.values()))).otherwise(low)


def tokens(text: Column) -> Column:
    """Index tokens: lower-cased runs of letters and digits without accents (FT-6)."""
    return F.filter(F.split(folded(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def token_words(text: Column) -> Column:
    """The index tokens as one text, a space between each two."""
    return F.trim(F.regexp_replace(folded(text), r"[^\p{L}\p{N}]+", " "))


def word_total(words: Column) -> Column:
    return F.when(words == "", 0).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1)


def spaced_line(words: Column) -> Column:
    """`token_line` of the tokens in `token_words`."""
    return F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))


def token_line(toks: Column) -> Column:
    """Tokens on one line, each with a space on both sides, so that counting text counts tokens and phrases."""
    return F.concat(F.lit(" "), F.array_join(toks, "  "), F.lit(" "))


def hits(line: Column, phrase: str) -> Column:
    """How often a phrase of index tokens stands in a token line."""
    mark = " " + "  ".join(phrase.split()) + " "
    return ((F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))) / len(mark)).cast("long")


def query_terms(query: str, stop: frozenset[str] = STOP_TERMS) -> list[str]:
    """Lower-cased query tokens without stop words, or all of them if none would be left (FT-1)."""
    found = [t.lower() for t in re.findall(r"[A-Za-z0-9_.:/-]+", query)]
    return [t for t in found if t not in stop] or found


def index_phrase(term: str) -> str:
    """A query token as index tokens."""
    return " ".join(t for t in re.split(r"[\W_]+", term.lower()) if t)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def title_of(text: Column, most: int = 80) -> Column:
    return F.left(F.substring_index(text, "\n", 1), F.lit(most))


def surrogate_id(*parts: Column) -> Column:
    return F.concat_ws(":", *(p.cast("string") for p in parts))


def shorten_list(c: Column, most: int = 160) -> Column:
    """A comma list cut to `most` characters at a comma, with how many entries are left out (PRJ-12)."""
    cut = F.left(c, F.lit(most))
    kept = F.when(F.instr(cut, ",") > 0, F.expr("1")).otherwise(0)
    head = F.when(kept == 1, F.regexp_replace(cut, ",[^,]*$", "")).otherwise(cut)
    commas = lambda x: F.length(x) - F.length(F.replace(x, F.lit(","), F.lit("")))
    left = commas(c) - commas(head)
    return F.when(F.length(c) <= most, c).otherwise(F.concat(head, F.lit(" (+"), left.cast("string"), F.lit(" more)")))


def leading_int(c: Column) -> Column:
    """A permissive integer cast: leading digits count, anything else is 0 (SRT-3)."""
    return F.coalesce(F.expr("cast(null as int)") if c is None else F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"^\s*(-?\d{1,9})", 1), F.lit("")).try_cast("int"), F.lit(0))


def list_has(c: Column, value: str) -> Column:
    """Exact membership in a comma list, spaces ignored (FLT-10)."""
    return F.array_contains(F.split(F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit("")), ","), value)


def first_of_list(c: Column) -> Column:
    return blank_to_null(F.substring_index(c, ",", 1))


def engine_codes(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(ENGINE_CODE), F.lit(0))


def applicability(engines: Column, family: str) -> Column:
    """'compatible' if the comma list names an engine of the family, 'wrong' if it names only others that are known, else 'generic' (FLT-18)."""
    parts = F.filter(F.split(F.regexp_replace(F.coalesce(engines, F.lit("")), r"\s+", ""), ","), lambda x: x != "")
    return F.when(F.exists(parts, lambda x: F.rlike(x, F.lit(f"^(?:{family})"))), "compatible").when(F.exists(parts, lambda x: F.rlike(x, F.lit(f"^(?:{ENGINE_CODE})"))), "wrong").otherwise("generic")


def names_only_others(text: Column, family: str) -> Column:
    """Whether a text names engines, and none of the family (FLT-19)."""
    codes = engine_codes(text)
    return (F.size(codes) > 0) & ~F.exists(codes, lambda x: F.rlike(x, F.lit(f"^(?:{family})")))


def without_citations(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), CITATION, " ")


def normal_part(c: Column) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9A-Za-z]", ""))


def quotes_part(answer: Column, gold: Column) -> Column:
    """Whether an answer holds the part number as a whole token, citations aside (STR-12)."""
    parts = F.regexp_extract_all(without_citations(answer), F.lit(r"\d(?:[\d \-]*\d)?"), F.lit(0))
    return (normal_part(gold) != "") & F.exists(parts, lambda p: normal_part(p) == normal_part(gold))


def magnitudes(c: Column) -> Column:
    """All spec values in a text (STR-13)."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(MAGNITUDE), F.lit(1)), lambda x: F.replace(x, F.lit(","), F.lit(".")).try_cast("double"))


def quotes_value(answer: Column, gold: Column, within: float = 0.05) -> Column:
    return F.coalesce(F.exists(magnitudes(answer), lambda v: F.abs(v - gold) <= within + 1e-12), F.lit(False))


def asserts_value(c: Column) -> Column:
    text = without_citations(c)
    return (F.size(magnitudes(text)) > 0) | F.rlike(text, F.lit(r"\b\d{5,}\b"))


def declines(c: Column) -> Column:
    """Whether an answer refuses, or asks back (STR-14)."""
    return F.rlike(F.lower(F.coalesce(c, F.lit(""))), F.lit("|".join(f"(?:{p})" for p in (*REFUSAL_CUES, *ELICIT_CUES))))


def value_visible(text: Column, value: str) -> Column:
    """Whether a number stands in a text by itself, not inside a longer one (STR-15)."""
    return F.rlike(text, F.lit(rf"(?<![\w.]){re.escape(value)}(?![\d.]\d|\d)"))


def spec_intent(query: str) -> bool:
    return re.search(SPEC_INTENT, query or "") is not None


def poly_hash(c: Column) -> Column:
    """h * 31 + code point, modulo 2 ** 32 (FN-8)."""
    return F.aggregate(F.filter(F.split(c, ""), lambda x: x != ""), F.lit(0).cast("long"), lambda h, x: (h * 31 + F.ascii(x)) % F.lit(4294967296))


def pick(variants: list[str], seed: Column) -> Column:
    """One of a few wordings, by a stable hash of the seed; the first without one (DS-12)."""
    return F.when(F.coalesce(seed, F.lit("")) == "", F.lit(variants[0])).otherwise(F.element_at(F.array(*map(F.lit, variants)), (poly_hash(seed) % len(variants)).cast("int") + 1))


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"[ \t\r\n\f\x0B]+", " "))


def topic_of(title: Column, fallback: str = "this component") -> Column:
    """What a title is about: without its leading verb, or a placeholder where nothing is left (PRJ-19)."""
    t = F.trim(F.coalesce(title, F.lit("")))
    rest = F.trim(F.regexp_replace(F.trim(F.regexp_replace(t, f"^(?:{'|'.join(LEADING_VERBS)})", "")), "^[- ]+", ""))
    return F.coalesce(F.nullif(rest, F.lit("")), F.lit(fallback))


def linked_citations(c: Column, base: str) -> Column:
    """Document references as links; doing it again changes nothing (STR-11)."""
    return F.regexp_replace(c, r"(?<![/\[\w-])(VCC-\d[\d-]*)", rf"[$1]({base}/$1)")


def sniff(data: Column) -> Column:
    """The kind of an image by its first bytes (STR-16)."""
    head = F.hex(F.substring(data, 1, 12))
    kinds = {"89504E470D0A1A0A": "image/png", "FFD8FF": "image/jpeg", "47494638": "image/gif", "3C737667": "image/svg+xml", "3C3F786D6C": "image/svg+xml"}
    return reduce(lambda out, kv: F.when(F.startswith(head, F.lit(kv[0])), kv[1]).otherwise(out), kinds.items(), F.lit(None).cast("string"))


def safe_path(c: Column) -> Column:
    """Whether a path is plain: no parent steps, no odd characters (STR-17)."""
    return F.rlike(c, F.lit(r"^[A-Za-z0-9_][A-Za-z0-9_./ -]*$")) & ~F.contains(c, F.lit(".."))


def contains_all(c: Column, wanted: Column) -> Column:
    return F.forall(wanted, lambda w: F.instr(F.lower(c), F.lower(w)) > 0)


def contains_any(c: Column, banned: Column) -> Column:
    return F.exists(banned, lambda w: F.instr(F.lower(c), F.lower(w)) > 0)


def question_after(c: Column, mark: str = "[/VEHICLE]\n") -> Column:
    return F.when(F.instr(c, mark) > 0, F.substring_index(c, mark, -1)).otherwise(c)


def estimated_tokens(chars: Column) -> Column:
    return F.floor(chars / 3.5)


def html_escape(c: Column) -> Column:
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")), c)


def page(text: Column, offset: int, size: int = 8000) -> list[Column]:
    """A window of a long text, and where the next one begins (PRJ-13)."""
    total = F.length(text)
    more = total > offset + size
    return [F.substring(text, offset + 1, size).alias("text"), total.cast("long").alias("text_length"), more.alias("truncated"), F.when(more, F.lit(offset + size).cast("long")).alias("next_offset")]


def sibling_renders(path: Column) -> Column:
    """The rendered files that may stand beside a vector figure, best first (PRJ-20)."""
    stem = F.regexp_replace(path, r"\.[^.]+$", "")
    return F.when(F.lower(F.regexp_extract(path, r"\.[^.]+$", 0)) == ".cgm", F.array(*(F.concat(stem, F.lit(e)) for e in (".svg", ".png", ".gif", ".jpeg"))))


def citation_of(ref: Column, doc_id: Column, title: Column) -> Column:
    """How a document is cited: by its reference, else by its id, with its title (PRJ-11)."""
    name = F.coalesce(F.nullif(ref, F.lit("")), F.concat(F.lit("document "), doc_id))
    return F.concat(name, F.coalesce(F.concat(F.lit(" — "), F.nullif(F.trim(title), F.lit(""))), F.lit("")))


def pin_citation(module: Column, connector: Column, pin: Column, source: Column, line: Column) -> Column:
    """How a pin is cited: module, connector and pin, and the file and line it stands in (PRJ-11)."""
    return F.concat(F.concat_ws(" ", module, F.concat(F.coalesce(connector, F.lit("")), F.lit(":"), pin)), F.lit(" — "), F.concat_ws(":", source, line.cast("string")))


def part_citation(number: Column) -> Column:
    return F.concat(F.lit("EPC/PartItems/"), number)


def settled(df: DataFrame, *columns: Column) -> DataFrame:
    """A select whose columns are made once a row: what is asked of them later doesn't repeat what they are made of, as filters do that are moved before a projection."""
    return df.select(F.inline(F.array(F.struct(*columns))))
