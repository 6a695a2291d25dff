"""Figure ranking by the words around image markers (FIG-1 to FIG-10)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

MARKER = r"\[image ([^\]]+)\]"
WINDOW, ENGINE_WINDOW, GATE_WINDOW = 240, 280, 1200
MANUAL_FACTOR = 0.6


def idf_weights(docs: DataFrame, terms: list[str]) -> dict[str, float]:
    """ln(1 + N / (df + 1)) of each different term of three letters or more (FIG-1); one scan, one row to the driver."""
    terms = list(dict.fromkeys(t for t in terms if len(t) >= 3))
    low = F.lower(F.coalesce("text", F.lit("")))
    row = docs.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.contains(low, F.lit(t))).alias(f"d{i}") for i, t in enumerate(terms))).first()
    return {t: math.log(1 + row.n / (row[f"d{i}"] + 1)) for i, t in enumerate(terms)}


def markers(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ordinal, title, at): the image markers of each text and where they stand (FIG-2). Lengths of the pieces between markers give the places."""
    pieces = F.split("text", r"\[image [^\]]+\]")
    titles = F.regexp_extract_all("text", F.lit(MARKER), F.lit(1))
    rows = docs.where(F.contains("text", F.lit("[image "))).select("doc_id", "text", pieces.alias("p"), titles.alias("t"))
    rows = rows.select("doc_id", "text", "p", "t", F.posexplode("t").alias("ordinal", "title"))
    before = F.aggregate(F.slice("p", 1, F.col("ordinal") + 1), F.lit(0), lambda s, x: s + F.length(x)) + F.aggregate(F.slice("t", 1, F.col("ordinal")), F.lit(0), lambda s, x: s + F.length(x) + 8)
    return rows.select("doc_id", "text", "ordinal", "title", before.alias("at"))


def around(text: Column, at: Column, width: int) -> Column:
    begin = F.greatest(F.lit(0), at - width)
    return F.substring(text, begin + 1, at + width - begin)


def nearest_engine(text: Column, at: Column, width: int = ENGINE_WINDOW) -> Column:
    """The engine code nearest to a place: the last one before it or the first one after it. The rest of a word that the window's edge cuts is no code, nor is a number cut short."""
    # one character more on either side tells whether a word or a number is cut
    before = F.substring(text, F.greatest(F.lit(0), at - width - 1) + 1, F.least(at, F.lit(width + 1)))
    before = F.when(at > width, F.regexp_replace(before, r"^(?s:.)(?:\B\w+)?", "")).otherwise(before)
    after = F.substring(text, at + 1, F.lit(width))
    after = F.when(F.rlike(F.substring(text, at + width, F.lit(2)), F.lit("^[0-9]{2}")), F.regexp_replace(after, "[0-9]+$", "")).otherwise(after)
    left, right = tx.engine_codes(before), tx.engine_codes(after)
    last, first = F.try_element_at(left, F.lit(-1)), F.try_element_at(right, F.lit(1))
    gap_left = F.length(F.call_function("substring_index", before, last, F.lit(-1))) + F.length(last)
    gap_right = F.call_function("instr", after, first) - 1
    return F.when(last.isNull(), first).when(first.isNull() | (gap_left <= gap_right), last).otherwise(first)


def scored(rows: DataFrame, weights: dict[str, float], family: str | None = None) -> DataFrame:
    """Markers with a score: the weights of terms near them, less where the title is a manual's, -1 at another engine's code (FIG-3)."""
    near = F.lower(around(F.col("text"), F.col("at"), WINDOW))
    score = sum((F.when(F.contains(near, F.lit(t)), w).otherwise(0.0) for t, w in weights.items()), F.lit(0.0))
    score = score * F.when(F.startswith("title", F.lit("M")), MANUAL_FACTOR).otherwise(1.0)
    if family:
        code = nearest_engine(F.col("text"), F.col("at"))
        score = F.when(code.isNotNull() & ~F.rlike(code, F.lit(f"^(?:{family})")), -1.0).otherwise(score)
    return rows.withColumn("score", score)


def gated(rows: DataFrame, terms: list[str], alternates: dict[str, list[str]] | None = None) -> DataFrame:
    """Markers near which every term stands: itself, in the singular, or by an alternate (FIG-5)."""
    near, ok = F.lower(around(F.col("text"), F.col("at"), GATE_WINDOW)), F.lit(True)
    for t in terms:
        forms = [t, *([t[:-1]] if t.endswith("s") and len(t) > 3 else []), *(alternates or {}).get(t, [])]
        one = F.lit(False)
        for f in forms:
            one = one | F.contains(near, F.lit(f))
        ok = ok & one
    return rows.withColumn("gate", ok)


def ordered_paths(rows: DataFrame, refs: DataFrame, graphics: DataFrame) -> DataFrame:
    """(doc_id, path, pos): a document's figures, best marker first, then those without one (FIG-6). Markers and references pair up one to one, else by title. refs: doc_id, refs array; graphics: title, path."""
    counts = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    both = rows.join(refs, "doc_id").join(counts, "doc_id")
    zipped = both.where(F.col("n") == F.size("refs")).select("doc_id", "score", "ordinal", F.element_at("refs", F.col("ordinal") + 1).alias("path"))
    named = both.where(F.col("n") != F.size("refs")).join(graphics, "title").where(F.array_contains("refs", F.col("path"))).select("doc_id", "score", "ordinal", "path")
    ranked = zipped.unionByName(named).where("score >= 0").groupBy("doc_id", "path").agg(F.max("score").alias("score"), F.min("ordinal").alias("ordinal"))
    bad = zipped.unionByName(named).where("score < 0").select("doc_id", "path").distinct()
    rest = refs.select("doc_id", F.posexplode("refs").alias("ordinal", "path")).join(bad, ["doc_id", "path"], "left_anti").join(ranked.select("doc_id", "path"), ["doc_id", "path"], "left_anti")
    all_ = ranked.withColumn("src", F.lit(0)).unionByName(rest.select("doc_id", "path", F.lit(0.0).alias("score"), "ordinal", F.lit(1).alias("src")))
    return all_.select("doc_id", "path", (F.row_number().over(Window.partitionBy("doc_id").orderBy("src", F.desc("score"), "ordinal", "path")) - 1).alias("pos"))


def chosen(rows: DataFrame, shows: DataFrame | None = None) -> DataFrame:
    """The document with the best marker, if that passes its gate; a near miss ends the search with nothing, and a document with nothing to show is passed over (FIG-7). shows: doc_id of those that have something."""
    best = rows.groupBy("doc_id").agg(F.max("score").alias("best"), F.max_by("gate", F.struct("score", -F.col("ordinal"))).alias("gate")).where("best > 0")
    if shows is not None:
        able = shows.select("doc_id").distinct().withColumn("able", F.lit(True))
        # a near miss counts where it stands, whether or not it could be shown
        best = best.join(able, "doc_id", "left").where("able or not gate").drop("able")
    return best.orderBy(F.desc("best"), "doc_id").limit(1).where("gate")


def summary(shown: DataFrame, limit: int) -> DataFrame:
    """One row on a document's figures (FIG-10): how many are shown and left out, and links to them as text. shown: path, served, pos."""
    have = F.col("served").isNotNull() & (F.col("pos") < limit)
    links = F.array_sort(F.collect_list(F.when(have, F.struct("pos", F.concat(F.lit("![figure]("), "served", F.lit(")")).alias("link")))))
    return shown.agg(F.count_if(have).cast("int").alias("n_shown"), F.count_if(F.col("pos") >= limit).cast("int").alias("n_left_out"), F.count_if(F.col("served").isNull() & (F.col("pos") < limit)).cast("int").alias("n_missing"), F.array_join(F.transform(links, lambda x: x["link"]), "\n").alias("markdown"))


def stored(paths: DataFrame, images: DataFrame) -> DataFrame:
    """Paths with their baked image, or that of a rendered sibling (FIG-8). images: path, content_type."""
    own = paths.join(images, "path", "left")
    options = paths.select("path", F.posexplode(tx.sibling_renders(F.col("path"))).alias("k", "sib")).join(images.select(F.col("path").alias("sib"), F.col("content_type").alias("sib_type")), "sib")
    first = options.groupBy("path").agg(F.min_by("sib", "k").alias("sib"), F.min_by("sib_type", "k").alias("sib_type"))
    out = own.join(first, "path", "left")
    return out.select(*paths.columns, F.coalesce(F.when(F.col("content_type").isNotNull(), F.col("path")), "sib").alias("served"), F.coalesce("content_type", "sib_type").alias("content_type"))
