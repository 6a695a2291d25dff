"""Training records and benchmark cases from a document store (DS-1, DS-5, DS-8 to DS-11, DS-14, DS-15).

Each builder is a projection: a source of rows goes in, a record a row comes out, as column expressions. Records
have example_type, answer_type, messages, vehicle, split_key, source_ids, seq, hash and chars. Where a
retriever's results are given, a record is grounded in them: it stands only if its document was found, and its
value is in sight there or in the opened document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsers
from ..functions import text as tx
from . import curation as cur

TOOLS = ("search_docs", "get_document", "lookup_pin", "epc_part", "get_figures", "list_sources")
SYSTEM = "You help with vehicle repair. Look things up with the tools, cite what you quote, and say so when nothing is found."
VEHICLE = "struct<model:string,year:string,engine:string>"
SHORTEST, SNIPPET, QUOTE, LARGEST = 120, 400, 200, 9000
#: Wordings of our own; a stable hash of the seed picks one.
VALUE_QUESTIONS = ["What is the tightening torque for {}?", "How tight does {} go?", "Which torque do I use on {}?"]
REFUSALS = ["I couldn't find that in the documents, so I won't guess.", "I could not verify this; no document here states it.", "There is no verified value for that here."]
ELICITATIONS = ["Which vehicle is it? Give me the VIN, or model, year and engine.", "I need the car first: what model, year and engine?", "Tell me the engine code or the VIN, so I can narrow it down."]
UNANSWERABLE = ["What is the resale value of this car?", "Which colour sells best for this model?", "How many of these were built by hand?", "What did the brochure promise about this car?"]


def wording(variants: list[str], seed: Column, *fill: Column) -> Column:
    """A picked wording with `{}` filled in."""
    text = tx.pick(variants, seed)
    for f in fill:
        text = F.concat(F.substring_index(text, "{}", 1), f, F.substring(text, F.length(F.substring_index(text, "{}", 1)) + 3, 10_000)) if any("{}" in v for v in variants) else text
    return text


def user(question: Column, vehicle: Column | None = None) -> Column:
    """A question, behind the vehicle it is about where one is known."""
    if vehicle is None:
        return cur.message("user", question)
    label = cur.vehicle_label(vehicle["year"], vehicle["model"], vehicle["engine"])
    return cur.message("user", F.when(label != "", F.concat(F.lit("[VEHICLE] "), label, F.lit(" [/VEHICLE]\n"), question)).otherwise(question))


def turn(name: str, arguments: dict[str, Column], result: Column, n: int = 1) -> list[Column]:
    """A tool call and its result."""
    call = F.lit(f"call_{n}")
    return [cur.message("assistant", calls=cur.tool_call(call, name, F.to_json(F.struct(*(v.alias(k) for k, v in arguments.items()))))), cur.message("tool", result, call_id=call)]


def result_json(*rows: Column) -> Column:
    return F.to_json(F.array(*rows))


def record(rows: DataFrame, kind: str, answer: str, messages: list[Column] | Column, key: Column, sources: Column, vehicle: Column | None = None, order: Column | None = None) -> DataFrame:
    """Records of `rows` (DS-11); `order` is their place within the producer."""
    all_ = F.concat(F.array(cur.message("system", F.lit(SYSTEM))), messages if isinstance(messages, Column) else F.array(*messages))
    out = tx.settled(rows, F.lit(kind).alias("example_type"), F.lit(answer).alias("answer_type"), all_.alias("messages"), (vehicle if vehicle is not None else F.lit(None)).cast(VEHICLE).alias("vehicle"), key.alias("split_key"), sources.cast("array<string>").alias("source_ids"), (order if order is not None else F.lit(0)).alias("seq"))
    return out.withColumns({"hash": cur.record_hash(F.col("messages")), "chars": F.length(F.to_json("messages"))})


def vehicle_of(rows: DataFrame) -> Column:
    """The vehicle columns of a document; a list of several years or engines says nothing of one (DS-2)."""
    one = lambda c: F.when(~F.contains(F.coalesce(c, F.lit("")), F.lit(",")), c)
    return F.struct(tx.first_of_list(F.col("model")).alias("model"), one(F.col("year")).alias("year"), one(F.col("engine")).alias("engine"))


def valued_documents(docs: DataFrame) -> DataFrame:
    """Documents that state a spec value, with the first: component and value (DS-1)."""
    parsers.small_batches(docs.sparkSession)
    first = F.try_element_at(parsers.parse_specs("text"), F.lit(1))
    return docs.where(F.rlike("text", F.lit(tx.MAGNITUDE))).withColumn("spec", first).where("spec is not null").select("*", "spec.component", "spec.value").drop("spec")


def procedures(docs: DataFrame) -> DataFrame:
    """Documents long enough to be one."""
    return docs.where(F.length("text") >= SHORTEST)


def illustrated(docs: DataFrame) -> DataFrame:
    return docs.where(F.size("refs") > 0)


def hit_of(docs: DataFrame, retrieved: DataFrame | None, snippet: Column) -> DataFrame:
    """`docs` with `results`, the search's answer as JSON, and `hit`, what it shows of the document itself (DS-10). retrieved: doc_id, results array<struct<doc_id, ref, title, snippet>>."""
    if retrieved is None:
        alone = F.struct(F.col("doc_id").cast("string").alias("doc_id"), "ref", "title", snippet.alias("snippet"))
        return docs.withColumn("hit", alone).withColumn("results", result_json(F.col("hit")))
    found = retrieved.select(F.col("doc_id").alias("r_id"), F.col("results").alias("r_results"))
    out = docs.join(found, F.col("doc_id") == F.col("r_id"))
    own = F.filter("r_results", lambda r: r["doc_id"] == F.col("doc_id").cast("string"))
    return out.withColumn("hit", F.try_element_at(own, F.lit(1))).where("hit is not null").withColumn("results", F.to_json("r_results")).drop("r_id", "r_results")


def grounded_values(docs: DataFrame, retrieved: DataFrame | None = None) -> DataFrame:
    """A spec value, quoted from a hit, or from the document that is opened where the hit doesn't show it."""
    amount = F.format_string("%s Nm", F.regexp_replace(F.col("value").cast("string"), r"\.0$", ""))
    rows = hit_of(valued_documents(docs), retrieved, F.concat("component", F.lit(": "), amount)).withColumn("amount", amount)
    shown = F.contains(F.coalesce(F.col("hit.snippet"), F.lit("")), F.split_part("amount", F.lit(" "), F.lit(1)))
    rows = rows.withColumn("shown", shown).where(F.col("shown") | ((F.length("text") <= LARGEST) & F.contains("text", F.split_part("amount", F.lit(" "), F.lit(1)))))
    vehicle, query = vehicle_of(rows), F.concat("component", F.lit(" tightening torque"))
    opened = F.when(F.col("shown"), F.expr(f"cast(array() as array<{cur.MESSAGE}>)")).otherwise(F.array(*turn("get_document", {"doc_id": F.col("doc_id").cast("string")}, F.to_json(F.struct("doc_id", "title", "text")), 2)))
    answer = F.concat("amount", F.lit(" ("), tx.citation_of(F.col("ref"), F.col("doc_id").cast("string"), F.lit("")), F.lit(")"), F.coalesce(F.concat(F.lit(", for the "), vehicle["engine"]), F.lit("")), F.lit("."))
    messages = F.concat(F.array(user(wording(VALUE_QUESTIONS, F.col("doc_id").cast("string"), F.col("component")), vehicle), *turn("search_docs", {"query": query}, F.col("results"))), opened, F.array(cur.message("assistant", answer)))
    return record(rows, "grounded", "torque", messages, cur.split_key(vehicle["model"], "torque"), F.array("ref"), vehicle, F.col("doc_id"))


def grounded_parts(parts: DataFrame, vehicles: DataFrame | None = None) -> DataFrame:
    """What a part number is. vehicles: part_number, model, year, engine; the first of a part's counts (DS-3)."""
    rows = parts.groupBy("part_number").agg(F.min(F.struct("section_id", "section_title", "description")).alias("p")).select("part_number", "p.*").where("part_number <> '' and description <> ''")
    empty = F.lit(None).cast(VEHICLE)
    if vehicles is not None:
        first = vehicles.groupBy("part_number").agg(F.min(F.struct("model", "year", "engine")).alias("vehicle"))
        rows, empty = rows.join(first, "part_number", "left"), F.col("vehicle")
    scope = F.when(empty.isNotNull(), "this car").otherwise("not vehicle-specific")
    found = F.struct("part_number", "description", F.col("section_title").alias("section"), scope.alias("scope"), tx.part_citation(F.col("part_number")).alias("citation"))
    question = F.concat(F.lit("What is part "), "part_number", F.lit("?"))
    answer = F.concat("part_number", F.lit(" is the "), "description", F.lit(" ("), scope, F.lit(")."))
    return record(rows, "grounded", "part_number", [user(question, empty), *turn("epc_part", {"part_number": F.col("part_number")}, result_json(found)), cur.message("assistant", answer)], F.concat(F.coalesce(empty["model"], F.lit("any")), F.lit("|part")), F.array("part_number"), empty, F.col("part_number"))


def grounded_procedures(docs: DataFrame, retrieved: DataFrame | None = None) -> DataFrame:
    """How something is done: the beginning of the document that tells it."""
    flat = F.trim(F.regexp_replace("text", r"\s+", " "))
    told = tx.settled(procedures(docs), "doc_id", "ref", "title", "model", "year", "engine", F.left(flat, F.lit(SNIPPET)).alias("told"))
    rows = hit_of(told, retrieved, F.col("told")).withColumn("quote", F.trim(F.regexp_replace("hit.snippet", r"\s+", " "))).where(F.length("quote") >= 30)
    title, vehicle = F.nullif(F.trim("title"), F.lit("")), vehicle_of(rows)
    question = F.concat(F.lit("How do I go about this: "), F.coalesce(title, tx.topic_of(F.col("title"))), F.lit("?"))
    answer = F.concat(F.lit("See "), tx.citation_of(F.col("ref"), F.col("doc_id").cast("string"), F.col("title")), F.lit(": "), F.left("quote", F.lit(QUOTE)), F.when(F.length("quote") > QUOTE, "…").otherwise(""))
    return record(rows, "grounded", "procedure", [user(question, vehicle), *turn("search_docs", {"query": F.coalesce(title, F.lit("this component"))}, F.col("results")), cur.message("assistant", answer)], cur.split_key(vehicle["model"], "procedure"), F.array("ref"), vehicle, F.col("doc_id"))


def grounded_pins(pins: DataFrame, model: str = "car") -> DataFrame:
    """What a pin is for, and its wire. pins: module, connector, pin, function, wire_color, source_file, csv_line."""
    rows = pins.where(F.coalesce("function", F.lit("")) != "")
    cite = tx.pin_citation(F.col("module"), F.col("connector"), F.col("pin"), F.col("source_file"), F.col("csv_line"))
    source = F.concat_ws(":", "source_file", F.col("csv_line").cast("string"))
    found = F.struct("module", "connector", "pin", "wire_color", "function", cite.alias("citation"))
    question = F.concat(F.lit("What does pin "), "pin", F.lit(" of "), F.coalesce("module", F.lit("the module")), F.lit(" do?"))
    answer = F.concat(F.coalesce("module", F.lit("the module")), F.lit(" pin "), "pin", F.lit(": "), "function", F.coalesce(F.concat(F.lit(", wire "), "wire_color"), F.lit("")), F.lit(" ("), source, F.lit(")."))
    return record(rows, "grounded", "pinout", [user(question), *turn("lookup_pin", {"module": F.col("module"), "pin": F.col("pin")}, result_json(found)), cur.message("assistant", answer)], F.lit(f"{model}|pinout"), F.array(source), None, F.struct("module", "pin"))


def refusals(docs: DataFrame, asks: list[str] = UNANSWERABLE) -> DataFrame:
    """Asks that no document answers, for each vehicle that documents have."""
    rows = docs.select(vehicle_of(docs).alias("vehicle")).where("vehicle.model is not null or vehicle.engine is not null").distinct()
    rows = rows.select("vehicle", F.posexplode(F.lit(asks)).alias("n", "ask"))
    topic = F.concat(F.lit("refusal-"), F.col("n").cast("string"))
    return record(rows, "refusal", "refusal", [user(F.col("ask"), F.col("vehicle")), *turn("search_docs", {"query": F.col("ask")}, F.lit("[]")), cur.message("assistant", tx.pick(REFUSALS, F.concat("ask", F.to_json("vehicle"))))], F.concat(F.coalesce(F.col("vehicle.model"), F.lit("?")), F.lit("|"), topic), F.array(topic), F.col("vehicle"), F.struct("n", "vehicle"))


def elicitations(docs: DataFrame) -> DataFrame:
    """A question without a vehicle is answered by asking for it; all share one key."""
    question = F.concat(F.lit("How tight is "), tx.topic_of(F.col("title")), F.lit("?"))
    return record(procedures(docs), "elicitation", "elicitation", [user(question), cur.message("assistant", tx.pick(ELICITATIONS, F.col("doc_id").cast("string")))], F.lit("any|elicitation"), F.array("ref"), None, F.col("doc_id"))


def cross_vehicles(parts: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Whether one vehicle's part fits another: both are named, and the number is to be verified."""
    many = vehicles.groupBy("part_number").agg(F.array_sort(F.collect_set(F.struct("model", "year", "engine"))).alias("v")).where(F.size("v") > 1)
    rows = parts.groupBy("part_number").agg(F.min("description").alias("description")).join(many, "part_number").select("part_number", "description", F.get("v", F.lit(0)).alias("vehicle"), F.get("v", F.lit(1)).alias("other"))
    label = cur.vehicle_label(F.col("other.year"), F.col("other.model"), F.col("other.engine"))
    question = F.concat(F.lit("Does the "), "description", F.lit(" also fit the "), label, F.lit("?"))
    found = F.struct("part_number", "description", label.alias("fits"), tx.part_citation(F.col("part_number")).alias("citation"))
    answer = F.concat(F.lit("Part "), "part_number", F.lit(" is listed for "), label, F.lit(" too; verify by VIN before you order."))
    return record(rows, "cross_vehicle", "cross_vehicle", [user(question, F.col("vehicle")), *turn("epc_part", {"component": F.col("description")}, result_json(found)), cur.message("assistant", answer)], cur.split_key(F.col("vehicle.model"), "cross"), F.array("part_number"), F.col("vehicle"), F.col("part_number"))


def multi_turns(docs: DataFrame, group: str = "model") -> DataFrame:
    """Two documents of a model, asked for one after the other (DS-6)."""
    pool = procedures(docs)
    pairs = cur.paired(pool, group)
    side = lambda n: pool.select(F.col("doc_id").alias(n), *(F.col(c).alias(f"{n}_{c}") for c in ("ref", "title", "text", "model", "year", "engine")))
    rows = pairs.drop(group).join(side("first"), "first").join(side("second"), "second")
    messages = []
    for i, n in enumerate(("first", "second")):
        found = F.struct(F.col(n).cast("string").alias("doc_id"), F.col(f"{n}_ref").alias("ref"), F.col(f"{n}_title").alias("title"))
        question = F.concat(F.lit("And now: " if i else "Where is it told: "), F.trim(f"{n}_title"), F.lit("?"))
        messages += [user(question, None if i else F.struct(F.col("first_model").alias("model"), F.col("first_year").alias("year"), F.col("first_engine").alias("engine"))), *turn("search_docs", {"query": F.trim(f"{n}_title")}, result_json(found), i + 1), cur.message("assistant", F.concat(F.lit("In "), tx.citation_of(F.col(f"{n}_ref"), F.col(n).cast("string"), F.col(f"{n}_title")), F.lit(".")))]
    return record(rows, "multi_turn", "multi_turn", messages, cur.split_key(F.col("first_model"), "multi"), F.array("first_ref", "second_ref"), None, F.col("second"))


def figures(docs: DataFrame) -> DataFrame:
    """The figures of a document, shown and cited."""
    rows, vehicle = illustrated(docs), vehicle_of(docs)
    found = F.struct(F.col("doc_id").cast("string").alias("doc_id"), "ref", "refs")
    question = F.concat(F.lit("Show me the figure for "), tx.topic_of(F.col("title")), F.lit("."))
    answer = F.concat(F.lit("Here: "), F.get("refs", F.lit(0)), F.lit(" ("), tx.citation_of(F.col("ref"), F.col("doc_id").cast("string"), F.lit("")), F.lit(")."))
    return record(rows, "figure", "figure", [user(question, vehicle), *turn("get_figures", {"query": tx.topic_of(F.col("title"))}, result_json(found)), cur.message("assistant", answer)], cur.split_key(vehicle["model"], "figure"), F.array("ref"), vehicle, F.col("doc_id"))


def producers(docs: DataFrame, parts: DataFrame, vehicles: DataFrame, pins: DataFrame, retrieved: DataFrame | None = None) -> dict[tuple[str, str], DataFrame]:
    """All nine by (example_type, answer_type), in the order in which they fill (DS-5)."""
    return {
        ("grounded", "part"): grounded_parts(parts, vehicles),
        ("grounded", "torque"): grounded_values(docs, retrieved),
        ("grounded", "procedure"): grounded_procedures(docs, retrieved),
        ("grounded", "pinout"): grounded_pins(pins),
        ("refusal", "refusal"): refusals(docs),
        ("elicitation", "elicitation"): elicitations(docs),
        ("cross_vehicle", "cross_vehicle"): cross_vehicles(parts, vehicles),
        ("multi_turn", "multi_turn"): multi_turns(docs),
        ("figure", "figure"): figures(docs),
    }


def generate(spark: SparkSession, made: dict[tuple[str, str], DataFrame], limit: int, frozen: tuple[DataFrame, DataFrame] | None = None, most: int = cur.MAX_TOKENS) -> tuple[DataFrame, DataFrame]:
    """The records of all producers up to their quotas, in a fixed random order, and a report of quotas and counts (DS-7, DS-8)."""
    plan = cur.producer_counts(spark, limit)
    quotas = {(r.example_type, r.answer_type): r.target for r in plan.collect()}  # a dozen rows
    free = [(name, rows if frozen is None else cur.without_leaks(rows.withColumn("record_id", F.col("hash")), *frozen).drop("record_id")) for name, rows in made.items()]
    valid = F.size(cur.problems(F.col("messages"), TOOLS)) == 0
    kept = cur.filled([(rows.withColumns({"producer": F.lit(f"{name[0]}/{name[1]}"), "seq": F.xxhash64(F.lit("order"), "hash")}), quotas[name]) for name, rows in free], F.col("chars"), valid, most)
    report = cur.shortfall(kept.withColumn("example_type", F.col("producer")), plan.select(F.concat_ws("/", "example_type", "answer_type").alias("example_type"), "target"))
    return cur.shuffled(kept), report


def benchmark_cases(made: dict[tuple[str, str], DataFrame], quota: int) -> DataFrame:
    """(id, answer_type, question, gold, split_key, source_ids, vehicle) of up to `quota` of each kind, first by a hash (DS-14). The question is the first of a record, the gold answer its last message."""
    out = None
    for (kind, answer), rows in made.items():
        asked = F.element_at(F.filter("messages", lambda m: m["role"] == "user"), 1)["content"]
        cases = rows.select(F.lit(f"{kind}/{answer}").alias("answer_type"), asked.alias("question"), F.element_at("messages", -1)["content"].alias("gold"), F.lit(kind == "refusal").alias("expect_refusal"), "split_key", "source_ids", "vehicle", F.concat(F.lit(f"{answer}-"), F.left("hash", F.lit(12))).alias("id"))
        cases = cur.first_different(cases.withColumn("_at", F.xxhash64(F.lit("bench"), "id")), "id", "_at", quota).drop("_at")
        out = cases if out is None else out.unionByName(cases)
    return out


def frozen_manifest(cases: DataFrame, version: str = "1") -> DataFrame:
    """One row that freezes a benchmark (DS-15, AGG-16): how many cases, the digest of their lines in order of id, and the sorted keys and sources that training must not use. A benchmark is small: its quotas bound it."""
    line = F.to_json(F.struct(*sorted(cases.columns)), {"ignoreNullFields": "false"})
    rows = cases.select(F.struct("id", line.alias("line")).alias("row"), "split_key", "source_ids")
    return rows.agg(F.lit(version).alias("version"), F.count(F.lit(1)).alias("n_cases"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("row")), lambda r: r["line"]), "\n"), 256).alias("content_hash"), F.array_sort(F.collect_set("split_key")).alias("split_keys"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("source_ids")))).alias("source_ids"))
