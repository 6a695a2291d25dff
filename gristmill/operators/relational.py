"""The relational operators of ingest and lookup, as functions of DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null


def only(filters: list[Column | None]) -> Column:
    """Optional filters, joined; an error if there is none (FLT-12)."""
    given = [f for f in filters if f is not None]
    if not given:
        raise ValueError("give at least one filter")
    return reduce(lambda a, b: a & b, given)


def ancestors(profiles: DataFrame, model: str | None, year: str | None, engine: str) -> DataFrame:
    """Profiles that hold for a vehicle, a null meaning any; a profile of nulls alone holds for none, and what isn't known of the vehicle rules none out (FLT-11)."""
    m, y, e = F.col("model"), F.col("year"), F.col("engine")
    fits = e.isNull() | (e == engine)
    if model:
        fits = fits & (m.isNull() | (m == model))
    if year:
        fits = fits & (y.isNull() | (y == year) | F.coalesce(e == engine, F.lit(False)))
    return profiles.where(fits & ~(m.isNull() & y.isNull() & e.isNull()))


def denormalised_tags(docs: DataFrame, edges: DataFrame, profiles: DataFrame, key: str = "doc_id") -> DataFrame:
    """`docs` with their profile ids as JSON and their models, years and engines as comma lists; none: "[]" and null (AGG-2)."""
    lists = lambda c: F.nullif(F.array_join(F.array_sort(F.collect_set(c)), ","), F.lit("")).alias(f"{c}s")
    tags = edges.join(profiles, "profile_id").groupBy(key).agg(F.to_json(F.array_sort(F.collect_list("profile_id"))).alias("profile"), *map(lists, ("model", "year", "engine")))
    return docs.join(tags, key, "left").withColumn("profile", F.coalesce("profile", F.lit("[]")))


def described(profiles: DataFrame) -> DataFrame:
    """The parts of a profile's name that aren't blank, joined, and how many there are (PRJ-4, PRJ-5)."""
    parts = [blank_to_null(F.col(c)) for c in ("model", "year", "engine")]
    return profiles.withColumns({"description": F.concat_ws(", ", *parts), "folder_level": sum((p.isNotNull().cast("int") for p in parts), F.lit(0))})


def localised(items: DataFrame, lexicon: DataFrame, key: str = "description_id") -> DataFrame:
    """Items with their first language's text, else the second's; the lexicon is cut by language before each join (JN-4)."""
    us = lexicon.where("language = 'us'").select(key, F.col("text").alias("us"))
    gb = lexicon.where("language = 'gb'").select(key, F.col("text").alias("gb"))
    return items.join(us, key, "left").join(gb, key, "left").withColumn("text", F.coalesce("us", "gb")).drop("us", "gb")


def scope_labels(docs: DataFrame, own: DataFrame, generic: DataFrame, key: str = "doc_id") -> DataFrame:
    """A scope for each document: untagged ones are 'not vehicle-specific', then 'this car', then 'other vehicles' (JN-13, FT-13)."""
    o, g = own.select(key).distinct().withColumn("_own", F.lit(True)), generic.select(key).distinct().withColumn("_generic", F.lit(True))
    out = docs.join(o, key, "left").join(g, key, "left")
    return out.withColumn("scope", F.when(F.col("_generic"), "not vehicle-specific").when(F.col("_own"), "this car").otherwise("other vehicles")).drop("_own", "_generic")


def incremental(source: DataFrame, ledger: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, status): unchanged, changed, new or vanished, by content hash (JN-16). source: key, hash; ledger: key, hash."""
    s, l_ = source.select(key, F.col("hash").alias("new_hash")), ledger.select(key, F.col("hash").alias("old_hash"))
    status = F.when(F.col("old_hash").isNull(), "new").when(F.col("new_hash").isNull(), "vanished").when(F.col("old_hash") == F.col("new_hash"), "unchanged").otherwise("changed")
    return s.join(l_, key, "full").select(key, status.alias("status"))


def prune(seen: DataFrame, current: DataFrame, full: bool, key: str = "doc_id") -> DataFrame:
    """Ids to remove: what the ledger knows and the source lacks; none on a full reload, which starts empty (SET-5)."""
    return seen.where("false") if full else seen.join(current, key, "left_anti").select(key)


def content_hash(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 16)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Last writer wins: new rows replace old ones of the same key (SNK-3)."""
    if order:
        new = new.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where("_n = 1").drop("_n")
    return old.join(new, keys, "left_anti").unionByName(new)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't there yet (SNK-4)."""
    return old.unionByName(new.dropDuplicates(keys).join(old, keys, "left_anti"))


def best_of(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group (AGG-12)."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where("_n = 1").drop("_n")


def parts_list(parts: DataFrame) -> DataFrame:
    """Usable part numbers, each once, with its least section (AGG-5, FLT-9)."""
    ok = F.col("part_number").isNotNull() & ~F.col("part_number").isin("", "ns") & (F.trim(F.coalesce("description", F.lit(""))) != "")
    return parts.where(ok).groupBy("part_number").agg(F.min_by("description", F.struct("section_id", "description")).alias("description"), F.min("section_id").alias("section_id"), F.min("section_title").alias("section_title"))


def section_documents(parts: DataFrame) -> DataFrame:
    """One document for each section: its title, then its parts in source order (PRJ-9). parts: section_id, section_title, seq, part_number, description, qty, type_id."""
    qty = F.when(F.col("qty").isNotNull() & (F.col("qty") != 1), F.concat(F.lit(" (qty "), F.col("qty").cast("string"), F.lit(")"))).otherwise("")
    line = F.concat(F.lit("- "), F.coalesce("part_number", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")), qty, F.when(F.col("type_id") == 5, " [non-stocked]").otherwise(""))
    lines = F.array_sort(F.collect_list(F.struct("seq", line.alias("line"))))
    group = F.min("function_group") if "function_group" in parts.columns else F.lit(None).cast("string")
    out = parts.groupBy("section_id", "section_title").agg(lines.alias("lines"), group.alias("group"))
    path = F.coalesce(F.concat(F.lit("_Function group: "), F.nullif(F.trim("group"), F.lit("")), F.lit("_\n\n")), F.lit(""))
    return out.select("section_id", F.concat(F.lit("# "), "section_title", F.lit("\n"), path, F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).alias("text"))


def under_breadcrumbs(docs: DataFrame, crumbs: DataFrame) -> DataFrame:
    """`docs` with their breadcrumb, where they have one, before the text (PRJ-6)."""
    rows = docs.join(crumbs.select("doc_id", "breadcrumb"), "doc_id", "left")
    head = F.coalesce(F.concat(F.lit("_Section: "), F.nullif("breadcrumb", F.lit("")), F.lit("_\n\n")), F.lit(""))
    return rows.withColumn("text", F.concat(head, F.coalesce("text", F.lit("")))).drop("breadcrumb")


def titled(title: Column, kind: Column, text: Column, ref: Column) -> Column:
    """A title, or in its place the kind and the first line, or the reference where there is no line (PRJ-8). A component and its value on lines of their own count as one line."""
    flat = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("component: "), F.lit("")), F.lit("\n\nvalue: "), F.lit(" — "))
    first = F.left(F.substring_index(flat, "\n", 1), F.lit(80))
    return F.coalesce(F.when(F.trim(title) != "", title), F.concat(F.coalesce(kind, F.lit("document")), F.lit(": "), F.nullif(first, F.lit(""))), ref)


def states_values(title: Column, text: Column, ref: Column) -> Column:
    """Whether a document that can be cited is a table of spec values or orders to tighten to one (FLT-6)."""
    return ((F.coalesce(title, F.lit("")) == "Tightening torque") | F.coalesce(text.like("%Tighten to %Nm%"), F.lit(False))) & ref.isNotNull()


def breadcrumbs(tree: DataFrame, most: int = 4) -> DataFrame:
    """The first different titles above each document, in source order (PRJ-6). tree: doc_id, seq, title."""
    first = tree.where("title is not null").groupBy("doc_id", "title").agg(F.min("seq").alias("seq"))
    titles = F.transform(F.slice(F.array_sort(F.collect_list(F.struct("seq", "title"))), 1, most), lambda x: x["title"])
    return first.groupBy("doc_id").agg(F.array_join(titles, " | ").alias("breadcrumb"))


def sibling(vehicles: DataFrame, engine: str, not_models: list[str]) -> DataFrame:
    """The first other vehicle with the same engine (JN-22)."""
    return vehicles.where((F.col("engine") == engine) & ~F.col("model").isin(not_models or [""])).orderBy("model", "year").limit(1)


def resolved(gold: DataFrame, results: DataFrame) -> DataFrame:
    """For each gold (case_id, doc_id, ref), the first result with its id, else the first with its ref (JN-20). results: case_id, pos, doc_id, ref."""
    r = results.select("case_id", "pos", F.col("doc_id").alias("r_id"), F.col("ref").alias("r_ref"))
    how = F.when(F.col("r_id") == F.col("doc_id"), 0).when(F.col("r_ref") == F.col("ref"), 1)
    return best_of(gold.join(r, "case_id").withColumn("how", how).where("how is not null"), ["case_id"], [F.col("how"), F.col("pos")])


def merged_lists(*lists: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lists of (key, pos) end to end; the first occurrence of a key stays (SET-3)."""
    both = reduce(DataFrame.unionByName, [x.select(key, "pos", F.lit(i).alias("src")) for i, x in enumerate(lists)])
    return best_of(both, [key], [F.col("src"), F.col("pos")])


def missing_rows(part: DataFrame, whole: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of one table that another lacks (JN-15)."""
    return part.join(whole, keys, "left_anti")
