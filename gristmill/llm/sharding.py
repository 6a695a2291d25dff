"""Sharding by histogram sort, in DataFrame operations only.

A key is given to each row, so that rows with equal texts stand together. Borders of shards, and of the parts
that a shard is sorted in, are found by counting: each round sums the exact bytes and rows in equal steps of
the key range around every border that is still loose, and keeps the one step that holds the border. When
all are tight enough the rows are exchanged once, each to the part that the borders name, and sorted there.
A part's first place is known from the counts, so the rows are numbered without gaps as they are.

Defined cases: a null text has size 1 and a null checksum becomes 0; empty tables give no rows and no
borders; a group of equal texts larger than a part or a shard is cut inside, by the hash of its rows; fully
identical rows share a key and a part, and a shard's border falls at an exact place among them; texts of any
length are one row each; all columns but the text are payload, whatever their names, and one that is itself
called size, shard or slot is kept as own_size, own_shard or own_slot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ensure, keep, scratch, table

TEXT_BITS, ROW_BITS = 40, 22  # of the key: equal texts stand together, and one text's copies still spread
KEY_BITS = TEXT_BITS + ROW_BITS
PROBE_BITS = 6  # a round splits the key range around a border into 64 steps
TOLERANCE = 0.0005  # of a shard's bytes: how far a border may lie from its place
PART_BYTES = 16 << 20  # of rows that one task sorts, about
LOOSE = 0.25  # of a part's bytes: how far a border between parts may lie from its place
FRAME = 64  # bytes a row takes besides its text, about


@dataclass
class Border:
    """Rows whose key is below `key`, and the first `ties` of those with that key, lie before the border; they are `before` rows."""

    key: int
    ties: int
    before: int


def sort_key(text: Column, row: list[Column]) -> Column:
    """A key of 62 bits: 40 from the text, then 22 from the whole row."""
    high = F.shiftrightunsigned(F.xxhash64(F.lit("text"), text), 64 - TEXT_BITS)
    low = F.shiftrightunsigned(F.xxhash64(F.lit("row"), *row), 64 - ROW_BITS)
    return F.shiftleft(high, ROW_BITS).bitwiseOR(low)


def find_borders(rows: DataFrame, goals: list[tuple[float, float]], total: int, count: int) -> list[Border]:
    """The border for each (bytes before it, slack in bytes) over (key, size) `rows` of `total` bytes and `count` rows.

    A round reads the counts of 2 ** PROBE_BITS steps for each border that is still loose, whatever the number of rows.
    """
    # of each goal: the low end of its step and the step's width in bits; bytes and rows below the low end; bytes and rows inside
    spans = [[0, KEY_BITS, 0, 0, total, count] for _ in goals]
    bits = KEY_BITS
    while True:
        loose = {s[0] >> bits for s, (_, slack) in zip(spans, goals, strict=True) if s[1] == bits and bits and s[4] > slack and s[5] > 1}
        if not loose:
            break
        finer = max(0, bits - (PROBE_BITS if bits < KEY_BITS else max(PROBE_BITS, (4 * len(goals)).bit_length())))
        near = rows if bits == KEY_BITS else rows.where(F.shiftright("key", bits).isin(sorted(loose)))
        sums: dict[int, list[tuple[int, int, int]]] = {}
        for step, n_bytes, n in near.groupBy(F.shiftright("key", finer).alias("step")).agg(F.sum("size"), F.count(F.lit(1))).collect():
            sums.setdefault(step >> (bits - finer), []).append((step, n_bytes, n))
        for steps in sums.values():
            steps.sort()
        for s, (goal, _) in zip(spans, goals, strict=True):
            if s[1] != bits or s[0] >> bits not in loose:
                continue
            for step, n_bytes, n in sums[s[0] >> bits]:
                if s[2] + n_bytes >= goal:
                    break
                s[2], s[3] = s[2] + n_bytes, s[3] + n
            else:  # rounding of the goal: the last step holds it
                s[2], s[3] = s[2] - n_bytes, s[3] - n
            s[0], s[1], s[4], s[5] = step << finer, finer, n_bytes, n
        bits = finer
    out = []
    for (low, width, below, n_below, inside, n), (goal, slack) in zip(spans, goals, strict=True):
        if not width and inside > slack and n > 1:  # many rows with one key
            ties = min(n, max(0, round((goal - below) / inside * n)))
            out.append(Border(low, ties, n_below + ties))
        elif goal - below <= below + inside - goal:
            out.append(Border(low, 0, n_below))
        else:
            out.append(Border(low + (1 << width), 0, n_below + n))
    return sorted(out, key=lambda b: b.before)


def borders_up_to(keys: list[int], key: Column) -> Column:
    """How many of the sorted `keys` are at most `key`: a binary search."""
    if not keys:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(keys).bit_length()))]
    at = F.lit(keys).cast("array<long>")
    return F.aggregate(F.lit(steps), F.lit(0), lambda n, step: F.when(F.get(at, n + step - 1) <= key, n + step).otherwise(n))


def hashable(kind: T.DataType) -> bool:
    return "map<" not in kind.simpleString() and "variant" not in kind.simpleString()


def histogram_shard(df: DataFrame, shards: int = 16, payload: list[str] | None = None, text: str = "text", tolerance: float = TOLERANCE) -> DataFrame:
    """`payload` columns (all by default) with size, shard (0 up to shards - 1) and slot (its place there, gapless from 0); the bytes of the shards are near equal."""
    payload = df.columns if payload is None else payload
    own = {c: f"_p{i}" for i, c in enumerate(payload)}  # no clash with a payload's names
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + 1
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name in own and hashable(f.dataType)]
    rows = df.select(*(F.col(f"`{c}`").alias(n) for c, n in own.items()), size.alias("size"), sort_key(F.col(f"`{text}`"), hashed).alias("key"))
    with scratch(df.sparkSession):
        narrow = keep(rows.select("key", "size"), "shard-keys")
        total, count = narrow.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
        cuts = find_borders(narrow, [(total * i / shards, total / shards * tolerance) for i in range(1, shards)], total, count) if count else []
        # parts: what is sorted in one task; their borders are those of the shards and some between
        moved = count * FRAME + (total if text in own else 0)
        parts = max(shards, -(-moved // PART_BYTES))
        goals = [(total * i / parts, total / parts * LOOSE) for i in range(1, parts)] if parts > shards else []
        edges = sorted({(b.key, b.before) for b in [*cuts, *(find_borders(narrow, goals, total, count) if goals else [])] if not b.ties})
    # a part begins at the first row of its key; the borders inside a key's rows don't part it
    keys = [k for k, _ in edges]
    firsts = [0, *(n for _, n in edges)]
    placed = rows.withColumn("part", borders_up_to(keys, F.col("key"))).repartitionById(len(firsts), "part").sortWithinPartitions("key", F.xxhash64(F.lit("row"), *(own[f.name] for f in df.schema.fields if f.name in own and hashable(f.dataType))))
    placed = placed.withColumn("at", F.get(F.lit(firsts).cast("array<long>"), F.col("part")) + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    starts = [0, *(b.before for b in cuts)]
    out = placed.withColumn("shard", borders_up_to(starts[1:], F.col("at"))).withColumn("slot", F.col("at") - F.get(F.lit(starts).cast("array<long>"), F.col("shard")))
    named = {c: f"own_{c}" if c in ("size", "shard", "slot") else c for c in own}
    return out.select(*(F.col(n).alias(named[c]) for c, n in own.items()), "size", F.col("shard").cast("int"), F.col("slot").cast("long"))


def op1_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by the law `bytes`."""
    docs = ensure(table(spark, sf_dir, "documents"), doc_id="long", text="string")
    docs = docs.withColumn("text_crc32", F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long"))
    out = histogram_shard(docs, payload=["doc_id", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
