"""The query tools of the engine, over a store of DataFrames (FT-24): search, paging, pins, parts, figures, inventory."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parsers
from ..functions import text as tx
from ..sources.readers import Vehicle
from ..sources.stored import storing
from . import figures as fg
from . import fulltext as ft
from . import relational as rel
from . import vectors as vec

PAGE = 8000
SCOPES = {"this car": 0, "not vehicle-specific": 1, "other vehicles": 2}


def clamp(limit: int, most: int) -> int:
    return max(1, min(int(limit), most))


@dataclass
class Store:
    """documents (doc_id, ref, title, model, year, engine, section, text, refs), doc_profiles, profiles, pins, components, parts, section_profiles, graphics, images, vectors; all but documents may be missing."""

    documents: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)
    car: Vehicle = field(default_factory=Vehicle)

    def with_all_columns(self) -> DataFrame:
        """The documents, with nulls for the columns they lack."""
        missing = [c for c in ("ref", "profile", "model", "year", "engine", "section", "db") if c not in self.documents.columns]
        return self.documents.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else self.documents

    def own(self, car: Vehicle) -> DataFrame:
        """Ids of documents of a vehicle: by exact engine token, and by its profiles' ancestors."""
        by_engine = self.documents.where(tx.list_has(F.col("engine"), car.engine)).select("doc_id")
        if "doc_profiles" not in self.tables:
            return by_engine
        mine = rel.ancestors(self.tables["profiles"], car.model, car.year, car.engine)
        return by_engine.union(self.tables["doc_profiles"].join(mine, "profile_id", "left_semi").select("doc_id")).distinct()

    def generic(self) -> DataFrame:
        """Ids of documents without any profile (JN-14)."""
        if "doc_profiles" not in self.tables:
            return self.documents.where(F.coalesce("engine", F.lit("")) == "").select("doc_id")
        return self.documents.select("doc_id").join(self.tables["doc_profiles"], "doc_id", "left_anti")


#: Beginnings and whole titles of documents that only describe a fault, words that ask for such ones, and words that ask for parts.
STUB_BEGINNINGS = ("Diagnostic trouble code", "Signal too", "Signal missing")
STUB_TITLES = ("Faulty signal", "Intermittent fault", "Faulty software")
FAULT_WORDS = frozenset({"dtc", "code", "codes", "fault", "diagnostic", "signal", "trouble"})
PARTS_WORDS = frozenset({"part", "parts", "number", "oem", "pn"})
CATALOGUE_PENALTY, STUB_PENALTY, GENERIC_PENALTY = 6.0, 5.0, 1.5
COVERAGE_END = 2015


def priors(query: str, terms: list[str]) -> list[tuple[Column, float]]:
    """Penalties of catalogue entries and fault descriptions, unless the question is about such (FT-8). The raw words count: terms lack those of parts."""
    title = F.coalesce("title", F.lit(""))
    stub = F.lower(title).isin(*(t.lower() for t in STUB_TITLES))
    for t in STUB_BEGINNINGS:
        stub = stub | F.startswith(F.lower(title), F.lit(t.lower()))
    asks = set(re.findall("[a-z]+", query.lower()))
    out = [] if asks & PARTS_WORDS else [(F.col("db") == "EPC", CATALOGUE_PENALTY)]
    return out if set(terms) & FAULT_WORDS else [*out, (stub, STUB_PENALTY)]


def in_profile(hits: DataFrame, profile: str) -> tuple[DataFrame, str | None]:
    """Hits whose profile, model, year or engine holds the words; if none does, those of the longest word that any holds, then all, with a notice (FT-18)."""
    if profile.strip().lower() == "all":
        return hits, None
    holds = lambda w: F.coalesce(F.contains(F.lower(F.concat_ws("\n", "profile", "model", "year", "engine")), F.lit(w.lower())), F.lit(False))
    for i, w in enumerate([profile, *sorted(re.findall("[A-Za-z0-9]+", profile), key=len, reverse=True)]):
        rows = hits.where(holds(w))
        if not rows.isEmpty():
            return rows, None if i == 0 else f"nothing for '{profile}', shown for '{w}'"
    return hits, f"nothing for '{profile}', shown for all"


def looked_up(store: Store, query: str, limit: int) -> DataFrame | None:
    """Documents that a reference in the query names, None where there are none (FT-19)."""
    named = re.search(r"VCC[- ]?(\d{6})(?:-\d+)?", query, re.I)
    if not named:
        return None
    hit = store.documents.where(F.startswith("ref", F.lit(f"VCC-{named[1]}"))).orderBy("ref", "doc_id").limit(limit)
    return None if hit.isEmpty() else hit.select("doc_id", (F.row_number().over(Window.orderBy("ref", "doc_id")) - 1).alias("pos"), F.lit(0.0).alias("rank"), F.lit(None).cast("string").alias("scope"))


def explicit(hits: DataFrame, compiled: ft.Query, profile: str, limit: int) -> tuple[DataFrame, str | None]:
    """The best hits for a vehicle that was named, or for all; loose ones where the strict are few (FT-18)."""
    k = max(limit, ft.CANDIDATES)
    strict = hits.where("strict")
    rows, notice = in_profile(hits if strict.isEmpty() else strict, profile)
    best = ft.top_k(rows, "rank", k)
    if len(compiled.terms) > 2 and best.limit(max(2, limit // 2)).count() < max(2, limit // 2):
        loose = ft.top_k(in_profile(hits, profile)[0], "rank", k)
        best = best.unionByName(loose.join(best.select("doc_id"), "doc_id", "left_anti"))
    order = Window.orderBy("adj", "doc_id")
    best = ft.top_k(ft.reranked(best, compiled), "adj", limit).withColumn("pos", F.row_number().over(order) - 1)
    return best.select("doc_id", "pos", "rank", F.lit(None).cast("string").alias("scope")), notice


def with_vectors(store: Store, rows: DataFrame, compiled: ft.Query, query_vector: list[float], limit: int, loose: bool, gate: tuple[float, float], scopes: DataFrame) -> DataFrame:
    """Results with vector neighbours: in free places, or fused by ranks where the words match loosely at best (FT-15 to FT-17).

    Every neighbour has its rank among all; one that the words didn't find must be near enough, and share a word unless it is very near.
    """
    near = vec.nearest(store.tables["vectors"], query_vector, key="doc_id").withColumn("best", F.min("dist").over(Window.partitionBy(F.lit(0))))
    near = near.withColumn("pos", F.row_number().over(Window.orderBy("dist", "doc_id")) - 1)
    wanted = {t for t in compiled.terms if len(t) >= 3}
    wanted |= {w for t in wanted for w in compiled.groups[t]}
    texts = near.join(store.documents.select("doc_id", "title", "text"), "doc_id")  # as many as there are neighbours
    line = F.lower(F.concat_ws(" ", "title", "text"))
    anchored = F.lit(False)
    for w in sorted(wanted):
        anchored = anchored | F.contains(line, F.lit(w))
    found = rows.select("doc_id", F.lit(True).alias("found"))
    passes = (F.col("dist") <= gate[0]) & (F.col("dist") - F.col("best") <= gate[1]) & (anchored | (F.col("dist") <= vec.UNANCHORED))
    near = texts.join(found, "doc_id", "left").where(F.coalesce("found", F.lit(False)) | passes).select("doc_id", "pos")
    lexical = rows.select("doc_id", "pos")
    mixed = vec.fused(lexical, near, limit) if loose else vec.filled(lexical, near, limit)
    order = Window.orderBy(F.desc("score"), F.asc_nulls_last("lex"), "vec") if loose else Window.orderBy("src", "pos")
    at = mixed.select("doc_id", (F.row_number().over(order) - 1).alias("pos"))
    out = at.join(rows.select("doc_id", "rank", F.col("scope").alias("known")), "doc_id", "left").join(scopes, "doc_id", "left")
    return out.select("doc_id", "pos", "rank", F.coalesce("known", "scope").alias("scope"))


def conflict_of(rows: DataFrame, query: str, terms: list[str], vehicle: Vehicle) -> str | None:
    """What the first results say of different values, where a value is asked for (FT-21)."""
    anchors = sorted({t for t in terms if len(t) >= 3 and not re.fullmatch(tx.SPEC_INTENT, t) and not tx.spec_intent(t)})
    found = ft.conflicts(rows, anchors).first() if anchors and tx.spec_intent(query) else None
    return found and f"{' '.join(anchors)}: {found.own_values} Nm for the {vehicle.engine}, others say {found.extra} Nm"


RESULT = "pos int, doc_id string, ref string, title string, model string, year string, engine string, section string, scope string, applicability string, rank double, lead string, snippet string, warning string, citation string, notice string, conflict string"


def search_docs(store: Store, query: str, limit: int = 8, car: str | None = None, profile: str | None = None, query_vector: list[float] | None = None, gate: tuple[float, float] = (vec.CEILING, vec.MARGIN), mined: dict | None = None, phrases: dict | None = None) -> DataFrame:
    """Ranked results with scope, lead text, citation and warnings.

    A reference in the query that is known is looked up. Else the corpus is scanned once: hits and their ranks are
    kept, narrow, and both tiers, own and generic documents first, are cut from them. Vector neighbours fill free
    places, or are fused in when no strict match was found. The at most 25 results come to the driver.
    """
    limit, vehicle = clamp(limit, 25), store.car.retargeted(car)
    spark, documents = store.documents.sparkSession, store.with_all_columns()
    scoped = car is not None or (profile or "").strip().lower() in ("", "this-car", "car", vehicle.engine.lower())
    compiled, said = ft.compile_query(query, mined, phrases), []
    with storing(spark) as keep:
        rows, enforce = looked_up(store, query, limit), False
        if rows is None:
            said = [f"nothing here is of {y}: coverage ends in {COVERAGE_END}" for y in re.findall(r"\b20\d{2}\b", query) if int(y) > COVERAGE_END][:1]
            if not compiled.phrases:
                rows = documents.where("false").select("doc_id", F.lit(0).alias("pos"), F.lit(0.0).alias("rank"), F.lit(None).cast("string").alias("scope"))
            else:
                narrow = ("doc_id", "title", "db", "profile", "model", "year", "engine")
                all_ = keep(ft.counted(documents, compiled).select(*narrow, "dl", *(f"f{i}" for i in range(len(compiled.phrases)))))
                hits = ft.penalised(ft.ranked(all_, compiled, ft.corpus_stats(all_, compiled), *narrow), priors(query, compiled.terms))
                if scoped:
                    hits = keep(rel.scope_labels(hits, store.own(vehicle), store.generic()))
                    tiers, loose = [], []
                    for of_tier in (ft.penalised(hits.where("scope <> 'other vehicles'"), [(F.col("scope") == "not vehicle-specific", GENERIC_PENALTY)]), hits):
                        found, relaxed_only = ft.tier(of_tier, compiled, max(limit, ft.CANDIDATES))
                        tiers.append(keep(ft.reranked(found, compiled)))
                        loose.append(relaxed_only)
                    rows = keep(ft.blended(*tiers, limit, loose[0] and not loose[1]).select("doc_id", "pos", "rank", F.when(F.col("tier") == 0, F.col("scope")).otherwise("other vehicles").alias("scope")))
                    said += ["only some of the words match"] if all(loose) else []
                    if query_vector is not None and "vectors" in store.tables:
                        scopes = rel.scope_labels(documents.select("doc_id"), store.own(vehicle), store.generic())
                        rows = with_vectors(store, rows, compiled, query_vector, limit, all(loose), gate, scopes)
                    enforce = True
                else:
                    rows, notice = explicit(keep(hits), compiled, profile, limit)
                    said += [notice] if notice else []
        found = keep(rows)
        whole = documents.join(F.broadcast(found), "doc_id")  # `limit` rows at most
        out = ft.shaped(whole, vehicle.family, enforce).withColumns({"snippet": ft.snippet(F.col("text"), compiled.terms), "citation": tx.citation_of(F.col("ref"), F.col("doc_id"), F.col("title"))})
        conflict = conflict_of(out, query, compiled.terms, vehicle)
        first = F.col("pos") == 0
        out = out.withColumns({"notice": F.when(first, F.nullif(F.lit("; ".join(said)), F.lit(""))), "conflict": F.when(first, F.lit(conflict).cast("string")), **{c: tx.shorten_list(F.col(c)) for c in ("model", "year", "engine")}})
        return spark.createDataFrame(out.select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in RESULT.split(", "))).orderBy("pos").collect(), RESULT)


def get_document(store: Store, doc_id: str, offset: int = 0) -> DataFrame:
    """One window of a document's text, by id, or by the beginning of its reference (FIG-9, PRJ-13)."""
    rows = store.documents.where((F.col("doc_id") == doc_id) | F.col("ref").ilike(f"{doc_id}%"))
    first = rows.orderBy(F.desc(F.col("doc_id") == doc_id), "doc_id").limit(1)
    return first.select("doc_id", "ref", "title", *tx.page(F.col("text"), offset, PAGE))


def lookup_pin(store: Store, module: str | None = None, pin: str | None = None, query: str | None = None, limit: int = 200) -> DataFrame:
    """Pins by module and pin ("B4" and "B:4" name a connector too), or by words; by number (FLT-13, SRT-3). truncated: there are more."""
    connector, number = None, pin
    if pin and (m := re.fullmatch(r"\s*([A-Za-z]+)\s*:?\s*(\d+)\s*", pin)):
        connector, number = m[1].upper(), m[2]
    rows = store.tables["pins"]
    both = None
    if query:  # each word of the query, stemmed, among the stemmed words of the pin (FT-6)
        have = parsers.stemmed(tx.tokens(F.concat_ws(" ", "function", "goes_to", "notes")))
        wanted = dict.fromkeys(parsers.porter_stem(w) for t in tx.query_terms(query) for w in tx.index_phrase(t).split())
        both = F.size(F.array_except(F.array(*map(F.lit, wanted)), have)) == 0 if wanted else None
    rows = rows.where(rel.only([F.upper("module") == module.upper() if module else None, F.upper("connector") == connector if connector else None, F.col("pin") == number if number else None, both]))
    rows = rows.join(store.tables["components"].select(F.col("component_id").alias("goes_to"), F.col("description").alias("component")), "goes_to", "left") if "components" in store.tables else rows
    rows = rows.orderBy("module", "connector", tx.leading_int(F.col("pin")), "pin").limit(limit + 1)
    return rows.withColumn("truncated", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) > limit).limit(limit)


def epc_part(store: Store, part_number: str | None = None, component: str | None = None, limit: int = 20) -> DataFrame:
    """Parts by number or words, each number once with its best scope; own vehicle's first (AGG-12, SRT-5)."""
    limit, p = clamp(limit, 50), store.tables["parts"]
    number = tx.normal_part(F.lit(part_number)) if part_number else None
    rows = p.where(rel.only([tx.normal_part(F.col("part_number")) == number if part_number else None, F.col("description").ilike(f"%{component}%") if component else None]))
    edges = store.tables["section_profiles"]
    mine = edges.join(rel.ancestors(store.tables["profiles"], store.car.model, store.car.year, store.car.engine), "profile_id", "left_semi").select("section_id")
    untagged = p.select("section_id").distinct().join(edges, "section_id", "left_anti")
    rows = rel.scope_labels(rows, mine, untagged, "section_id")
    rank = F.coalesce(*(F.when(F.col("scope") == s, r) for s, r in SCOPES.items()), F.lit(3))
    first = rel.best_of(rows.withColumn("scope_rank", rank), ["part_number"], [F.col("scope_rank"), F.col("section_id")])
    return first.orderBy("scope_rank", "part_number").limit(limit)


def get_figures(store: Store, query: str | None = None, doc_id: str | None = None, limit: int = 8) -> DataFrame:
    """The figures of the document that shows a component best, or of a given document; nothing on a near miss (FIG-1 to FIG-8)."""
    limit, docs = clamp(limit, 12), store.documents
    refs = docs.where(F.size("refs") > 0).select("doc_id", "refs")
    graphics = store.tables["graphics"] if "graphics" in store.tables else docs.sparkSession.createDataFrame([], "title string, path string")
    terms = [t for t in tx.query_terms(query or "") if len(t) >= 3]
    if doc_id:
        pool = docs.where(F.col("doc_id") == doc_id)
    else:
        fits = docs.where((tx.applicability(F.col("engine"), store.car.family) != "wrong") & (F.size("refs") > 0))
        pool = fits.join(ft.top_k(ft.bm25(fits, ft.compile_query(query or ""), relaxed=True), "rank", 12).select("doc_id"), "doc_id", "left_semi")
    rows = fg.gated(fg.scored(fg.markers(pool), fg.idf_weights(docs, terms), store.car.family), terms, {t: ft.SYNONYMS.get(t, []) for t in terms})
    shows = fg.ordered_paths(rows, refs, graphics).select("doc_id")
    best = fg.chosen(rows, shows).select("doc_id") if not doc_id else pool.select("doc_id")
    out = fg.ordered_paths(rows, refs, graphics).join(best, "doc_id", "left_semi").where(F.col("pos") < limit)
    return fg.stored(out, store.tables["images"]) if "images" in store.tables else out


#: What each ability of the tools needs.
ABILITIES = {"vector search": ("vectors",), "scopes": ("profiles", "doc_profiles"), "pins": ("pins",), "parts": ("parts",), "parts by vehicle": ("parts", "profiles", "section_profiles"), "figures": ("images",)}


def abilities(store: Store) -> DataFrame:
    """(ability, ready, detail): whether the tables that it needs are there and hold rows (AGG-20)."""
    spark, held = store.documents.sparkSession, {}
    for name in sorted({t for ts in ABILITIES.values() for t in ts}):
        held[name] = name in store.tables and not store.tables[name].isEmpty()
    rows = [("search", not store.documents.isEmpty(), "documents")] + [(a, all(held[t] for t in ts), ", ".join(t for t in ts if not held[t]) or "ready") for a, ts in ABILITIES.items()]
    return spark.createDataFrame(rows, "ability string, ready boolean, detail string")


def list_sources(store: Store) -> DataFrame:
    """What the store holds: documents by source and section, and each table's rows (AGG-1 to AGG-4, AGG-20)."""
    out = store.documents.groupBy(F.lit("documents").alias("kind"), F.concat_ws("/", "db", "section").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    for name, t in store.tables.items():
        out = out.unionByName(t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("table").alias("kind"), F.lit(name).alias("name"), "rows"))
    return out.orderBy("kind", F.desc("rows"), "name")
