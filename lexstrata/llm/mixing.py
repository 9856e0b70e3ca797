"""Mixing sources to target weights with a low-discrepancy schedule; DataFrame operations only.

Slot i of the schedule takes the point frac(i / golden ratio), which cumulative target weights map to a source; a
source's slots are ranked. Each source's documents are shuffled by hash, laid end to end for up to three epochs and cut
into blocks of equal token counts. The slot of rank r takes block r, so every stretch of the schedule is near the
weights and what is taken of a source is a prefix of its shuffled epochs. The last block of a source ends where its
target does; a source that gets no slot is given one behind the schedule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_RE, Tables, unused_prefix
from .ranks import BROADCAST_ROWS, hex_digits, join_small, running

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = "mix"
#: 2^32 / golden ratio; slot i's point is i times this, modulo 2^32.
GOLDEN = 2654435769
#: Slots there are at least (each source's share is off by a few), and the largest block in words.
SLOTS, BLOCK = 65536, 1024
#: Parts of the interval that the schedule is joined on.
CELL_BITS = 12
#: Copies of a unit that one task writes out; units of more are dealt over tasks.
COPIES = 4096

DEC = "decimal(38,0)"


def size_of(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_RE)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, most: int = EPOCHS) -> DataFrame:
    """sources: (source, source_size), one row each. Adds target, quota (the target in whole words; quotas sum to all
    words), and lo/hi, its part of [0, 2^32).

    Sources by code point, null last, get the weights in turn and share all words. Where a share is above `most` times
    the source, it stops there and the rest is shared anew: with sources ordered by size over weight, those that stop
    are the first ones, up to the first that takes its share of what the ones before it leave.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(w).cast("long") for w in weights])
    s = sources.withColumn("ix", F.row_number().over(by_name)).withColumn("w", F.element_at(pattern, F.expr(f"cast((ix - 1) % {len(weights)} as int) + 1")))
    everything, before = W.partitionBy(), W.orderBy("ratio", "ix").rowsBetween(W.unboundedPreceding, -1)
    scale = 1
    for w in weights:
        scale *= w
    s = s.withColumn("ratio", F.expr(f"source_size * ({scale} div w)"))
    s = s.withColumn("total", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
    s = s.withColumn("left_words", F.col("total") - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)))
    s = s.withColumn("left_w", F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0)))
    stops = F.col("source_size").cast(DEC) * most * F.col("left_w") <= F.col("w").cast(DEC) * F.col("left_words")
    s = s.withColumn("rank", F.row_number().over(W.orderBy("ratio", "ix"))).withColumn("stops", stops)
    s = s.withColumn("first_free", F.min(F.when(~F.col("stops"), F.col("rank"))).over(everything))
    free = F.col("rank") >= F.col("first_free")
    s = s.withColumn("free", F.coalesce(free, F.lit(False)))
    at_first = lambda c: F.coalesce(F.min(F.when(F.col("rank") == F.col("first_free"), F.col(c))).over(everything), F.lit(1))
    s = s.withColumn("rest", at_first("left_words")).withColumn("rest_w", at_first("left_w"))
    s = s.withColumn("target", F.when(F.col("free"), (F.col("w") * F.col("rest")).cast("double") / F.col("rest_w").cast("double")).otherwise((F.col("source_size") * most).cast("double")))
    s = s.withColumn("num", F.when(F.col("free"), (F.col("w") * F.col("rest")).cast(DEC)).otherwise(F.col("source_size").cast(DEC) * most * F.col("rest_w")).cast(DEC))
    upto = by_name.rowsBetween(W.unboundedPreceding, 0)
    point = lambda c: F.expr(f"case when total = 0 then 0 else ({c} * cast(4294967296 as {DEC})) div (cast(total as {DEC}) * rest_w) end")
    s = s.withColumn("cum", F.sum("num").over(upto).cast(DEC)).withColumn("cum_before", (F.col("cum") - F.col("num")).cast(DEC))
    whole = lambda c: F.expr(f"{c} div cast(rest_w as {DEC})")
    return s.select("source", "ix", "source_size", "target", (whole("cum") - whole("cum_before")).alias("quota"), point("cum_before").alias("lo"), point("cum").alias("hi"))


def schedule(spark, sources: DataFrame, slots: int, n_sources: int) -> DataFrame:
    """(ix, slot, rank): the source of every slot, and its rank among the source's slots."""
    if slots == 0:
        return sources.where("false").select("ix", F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("rank"))
    a = "pmod(id, 4294967296)"
    x = F.expr(f"pmod(pmod(shiftright({a}, 16) * {GOLDEN}, 65536) * 65536 + ({a} & 65535) * {GOLDEN}, 4294967296)")
    points = spark.range(slots).select(F.col("id").alias("slot"), x.alias("x")).withColumn("part", F.shiftright("x", 32 - CELL_BITS))
    shift = 32 - CELL_BITS
    parts = sources.where("hi > lo").select("ix", "lo", "hi", F.explode(F.expr(f"sequence(shiftright(lo, {shift}), shiftright(hi - 1, {shift}))")).alias("part"))
    many = n_sources + (1 << CELL_BITS) > 100_000  # a part is one source's, or else a source begins in it
    named = points.join(parts if many else F.broadcast(parts), "part").where("x >= lo and x < hi").select("ix", "slot")
    # slots of a source are ranked within stretches of the schedule, and stretches within the source
    stretch = max(64, 1 << (slots.bit_length() // 2))
    ranked = running(named.withColumn("stretch", F.expr(f"slot div {stretch}")), ["ix"], "stretch", ["slot"], {"rank": F.lit(1).cast("long")})
    return ranked.select("ix", "slot", "rank")


@dataclass
class Mix:
    """units: one row for each distinct (doc_id, source, size), `copies` rows of the input stand behind it. pieces: (ix,
    slot, rank, place, taken): the words that each slot takes, and from which unit (its place in its source). taken: units with the
    words that the mix takes of all their copies and epochs."""

    units: DataFrame
    pieces: DataFrame
    taken: DataFrame


def mix(documents: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> Mix:
    """Plans the mix of all documents. Null texts are empty and are never taken; the null source is a source, ordered last.

    Rows that agree in doc_id, source and size are one unit and share what is taken of it evenly. Every source gives its
    target, to the word.
    """
    spark = documents.sparkSession
    tables = Tables(spark, "mix")
    rows = documents.select("doc_id", F.col("source").cast("string").alias("source"), size_of().alias("size"))
    units = tables.put(rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")).withColumn("words", F.col("size") * F.col("copies")), "units")
    totals = tables.put(units.groupBy("source").agg(F.sum("words").alias("source_size")), "totals")
    n_sources, total = totals.agg(F.count(F.lit(1)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    block = max(1, min(BLOCK, total // SLOTS))
    shares = tables.put(targets(totals, weights, epochs), "targets")
    n_slots = -(-total // block)
    slots = tables.put(schedule(spark, shares, n_slots, n_sources), "schedule")
    without = shares.where("quota > 0").join(slots.select("ix").distinct(), "ix", "left_anti")
    slots = slots.unionByName(without.select("ix", (F.col("ix") + (n_slots - 1)).cast("long").alias("slot"), F.lit(0).cast("long").alias("rank")))
    slots = tables.put(slots, "slots")
    counts = shares.join(slots.groupBy("ix").agg(F.count(F.lit(1)).alias("slots")), "ix", "left").select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"), "ix", "source_size", "target", F.coalesce("slots", F.lit(0)).cast("long").alias("slots"), "quota")
    counts = counts.withColumn("upto", F.col("quota"))
    n_units = units.count()
    keyed = units.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    keyed = join_small(keyed, counts, ["key"], n_sources)
    shuffled = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = keyed.withColumn("shuffle", shuffled).withColumn("cell", F.substring("shuffle", 1, hex_digits(n_units)))
    placed = tables.put(running(keyed, ["ix"], "cell", ["shuffle", "doc_id", "size"], {"place": F.col("words")}).drop("cell", "shuffle", "key"), "placed")
    laid = placed.where("words > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    laid = laid.withColumn("from", F.expr("place + epoch * source_size")).withColumn("to", F.expr(f"least(place + epoch * source_size + words, upto)")).where("from < to")
    cut = laid.withColumn("rank", F.explode(F.expr(f"sequence(least(from div {block}, slots - 1), least((to - 1) div {block}, slots - 1))")))
    cut = cut.withColumn("part", F.expr(f"least(to, if(rank = slots - 1, upto, (rank + 1) * {block})) - greatest(from, rank * {block})"))
    pieces = cut.join(slots, ["ix", "rank"]).select("ix", "slot", "rank", "place", "doc_id", "source", "size", "copies", "source_size", "target", F.col("part").alias("taken"))
    same = ["doc_id", "source", "size", "copies", "source_size", "target", "place"]
    every = pieces.select(*same, "taken").unionByName(placed.select(*same, F.lit(0).cast("long").alias("taken")))
    taken = every.groupBy(*same).agg(F.sum("taken").alias("taken")).drop("place")
    return Mix(units, pieces, taken)


def _copies(taken: DataFrame) -> DataFrame:
    """A row for every copy of a unit, with a number (from 0) and the words that the copy gives: as many as the others, or one more."""
    chunked = taken.where(F.col("copies") > COPIES).withColumn("chunk", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})"))).repartition("doc_id", "source", "size", "chunk")
    rows = taken.where(F.col("copies") <= COPIES).withColumn("chunk", F.lit(0).cast("long")).unionByName(chunked)
    rows = rows.withColumn("copy", F.explode(F.expr(f"sequence(chunk * {COPIES}, least(copies, (chunk + 1) * {COPIES}) - 1)")))
    return rows.withColumn("taken", F.expr("taken div copies + if(copy < taken % copies, 1, 0)")).drop("chunk")


def mixed_rows(documents: DataFrame, **options) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target (its source's), taken (words the mix takes, repeats counted).

    Rows that repeat id, source and size share what is taken of them: each gives the same number of words, or one more,
    so the rows of a source sum to what the source gives. Null texts have size 0 and are never taken; no rows give none."""
    return _copies(mix(documents, **options).taken).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: a row of documents for every epoch that takes it whole, and one with its first words where a source's
    last block cuts it (with the spaces and line ends before each; n_chars recounted). Documents without words are not
    taken. Rows that repeat id, source and size are one unit; they are numbered as they come, which of them gives a word
    more does not matter to any source's sum."""
    p = unused_prefix(documents)
    units = Tables(documents.sparkSession, "units").put(mix(documents, **options).taken.where("taken > 0"), "taken")
    taken = units.select(F.col("doc_id").alias(f"{p}id"), F.col("source").alias(f"{p}source"), F.col("size").alias(f"{p}size"), F.col("taken").alias(f"{p}taken"), F.col("copies").alias(f"{p}copies"))
    sized = documents.withColumn(f"{p}n", size_of())
    same = F.col("doc_id").eqNullSafe(F.col(f"{p}id")) & F.col("source").cast("string").eqNullSafe(F.col(f"{p}source")) & (F.col(f"{p}n") == F.col(f"{p}size"))
    single = sized.join(taken.where(f"{p}copies = 1"), same).withColumn(f"{p}share", F.col(f"{p}taken"))
    # Only rows of repeated units are numbered, cell by cell; where these units are few, documents are not moved for them.
    repeated = taken.where(f"{p}copies > 1")
    few = repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    many = sized.join(F.broadcast(repeated) if few else repeated, same).withColumn(f"{p}row", F.monotonically_increasing_id())
    many = Tables(documents.sparkSession, "mixed").put(many, "repeated").withColumn(f"{p}cell", F.shiftright(f"{p}row", 10))  # numbers have to stay as they are
    many = many.withColumn(f"{p}key", F.to_json(F.struct(f"{p}id", f"{p}source", f"{p}size")))
    many = running(many, [f"{p}key"], f"{p}cell", [f"{p}row"], {f"{p}copy": F.lit(1).cast("long")})
    many = many.withColumn(f"{p}share", F.expr(f"{p}taken div {p}copies + if({p}copy < {p}taken % {p}copies, 1, 0)"))
    columns = [*documents.columns, f"{p}size", f"{p}share"]
    rows = single.select(*columns).unionByName(many.select(*columns)).where(f"{p}share > 0")
    rows = rows.withColumn(f"{p}epoch", F.explode(F.expr(f"sequence(0L, ({p}share - 1) div {p}size)"))).withColumn(f"{p}take", F.expr(f"least({p}size, {p}share - {p}epoch * {p}size)"))
    space, word = r"[\\x20\\x09-\\x0D]", r"[^\\x20\\x09-\\x0D]"
    head = F.array_join(F.expr(f"slice(regexp_extract_all(text, '({space}*{word}+)', 1), 1, cast({p}take as int))"), "")
    rows = rows.withColumn("text", F.when(F.col(f"{p}take") < F.col(f"{p}size"), head).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(f"{p}take") < F.col(f"{p}size"), F.length("text").cast(documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*documents.columns)
