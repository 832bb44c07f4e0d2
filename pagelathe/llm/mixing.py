"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of equally many documents.  Block i of a source
with weight w of a total of W has the release time floor(i*W/w) and the deadline
ceil((i+1)*W/w); each slot goes to the released block with the earliest
deadline.  The weights fill every slot, so earliest-deadline-first meets every
window and, as long as no source has run out, a source is less than one block
away from its weight's share at any slot.

With g the greatest common divisor of the weights, the schedule repeats after
W/g slots.  One period, or what of it the blocks need, is computed by a fold over
its slots, segment by segment from the counts at each start; later rounds follow
by arithmetic.  Sources of equal weight take turns by name, so the fold looks at
different weights only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.llm.common import is_empty, packed, staged

#: Documents of a block, rows of a numbering segment, slots of a segment of positions.
BLOCK = 32
SEGMENT_ROWS = 50_000
SEGMENT_SLOTS = 1_000
#: Slots that one job folds, in parts of SEGMENT_SLOTS; rounds of a block that are listed at once.
LOT = 65_536


def div(a, b) -> Column:
    return F.call_function("div", a, b)


def root_weights(counts: DataFrame) -> DataFrame:
    """Default targets (source, weight): whole square roots of the row counts."""
    return counts.select("source", F.floor(F.sqrt("n")).cast("bigint").alias("weight"))


def slots_per_period(weights: DataFrame, period: int) -> DataFrame:
    """(source, slots): whole slots that add up to the period.

    One for each source with a positive weight, the others in proportion,
    largest remainders first, ties by source name.
    """
    whole = weights.where("weight > 0")
    free = F.lit(period) - F.col("s")
    base = whole.select(
        "source", "weight", whole.agg(F.sum("weight")).scalar().alias("w"), whole.agg(F.count("*")).scalar().alias("s")
    ).select("source", "s", div(free * F.col("weight"), F.col("w")).alias("base"), F.pmod(free * F.col("weight"), F.col("w")).alias("left"))
    every = Window.partitionBy(F.lit(0))
    return base.withColumn("rank", F.row_number().over(every.orderBy(F.desc("left"), "source"))).withColumn("given", F.sum("base").over(every)).select(
        "source", (1 + F.col("base") + (F.col("rank") <= F.lit(period) - F.col("s") - F.col("given")).cast("bigint")).alias("slots")
    )


def period_schedule(slots: DataFrame, period: int) -> DataFrame:
    """One row per slot of a period: slot, source, nth (of the source), before.

    ``before`` holds, per source in name order, its number of slots before this
    one.  For short periods: mix() folds with schedule().
    """
    sources = slots.agg(F.sort_array(F.collect_list(F.struct("source", "slots"))).alias("s"))  # one entry per slot at most
    width = F.size("s")
    none = F.transform(F.col("s"), lambda x: F.lit(0).cast("bigint"))

    def due(done: Column, t: Column) -> Column:
        """The index of the released block with the earliest deadline."""
        windows = F.transform(
            F.col("s"),
            lambda x, i: F.when(
                div(F.get(done, i) * period, x["slots"]) <= t,
                F.struct(div((F.get(done, i) + 1) * period + x["slots"] - 1, x["slots"]).alias("deadline"), i.alias("at")),
            ),
        )
        return F.array_min(F.filter(windows, lambda w: w.isNotNull()))["at"]

    start = F.struct(none.alias("done"), F.array().cast("array<struct<at:int,done:array<bigint>>>").alias("log"))

    def step(state: Column, t: Column) -> Column:
        chosen = due(state["done"], t)
        return F.struct(
            F.transform(state["done"], lambda d, i: d + F.when(i == chosen, 1).otherwise(0)).alias("done"),
            F.concat(state["log"], F.array(F.struct(chosen.cast("int").alias("at"), state["done"].alias("done")))).alias("log"),
        )

    run = sources.where(width > 0).select("s", F.aggregate(F.sequence(F.lit(0).cast("bigint"), F.lit(period - 1).cast("bigint")), start, step, lambda x: x["log"]).alias("log"))
    return run.select("s", F.posexplode("log").alias("slot", "x")).select(
        F.col("slot").cast("bigint").alias("slot"),
        F.get("s", F.col("x.at"))["source"].alias("source"),
        F.get(F.col("x.done"), F.col("x.at")).alias("nth"),
        F.col("x.done").alias("before"),
    )


def schedule(shares: DataFrame, block: int) -> DataFrame:
    """(source, n, slots, period, turn, slot) of a period's blocks that are there, over shares (source, weight, n)."""
    size = F.lit(block).cast("bigint")
    listed = shares.select("source", "weight", "n", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("source")) - 1).cast("bigint").alias("at"))
    listed = staged(listed.withColumn("blocks", div(F.col("n") + (block - 1), size)), "listed")
    sizes = listed.groupBy("weight").agg(F.count("*").alias("m"), F.max("blocks").alias("blocks")).collect()  # one row per different weight
    common = math.gcd(*[r.weight for r in sizes]) or 1
    period = sum(r.m * (r.weight // common) for r in sizes)
    # No block that is there has a later deadline.
    needed = max((min(period, -(-r.blocks * period // (r.weight // common))) for r in sizes), default=0)
    listed = listed.withColumns({"slots": div(F.col("weight"), F.lit(common).cast("bigint")), "period": F.lit(period).cast("bigint")})
    groups = listed.groupBy("slots").agg(F.count("*").alias("m"), F.sort_array(F.collect_list("at")).alias("members"))
    groups = groups.agg(F.sort_array(F.collect_list(F.struct("slots", "m", "members"))).alias("groups"))
    state = staged(groups.select("groups", F.transform("groups", lambda x: F.lit(0).cast("bigint")).alias("done")), "state")

    def step(state: Column, t: Column) -> Column:
        """One slot: the released block with the earliest deadline, ties by source name."""
        windows = F.zip_with(
            F.col("groups"),
            state["done"],
            lambda x, d: F.when(
                div(div(d, x["m"]) * period, x["slots"]) <= t,
                F.struct(div((div(d, x["m"]) + 1) * period + x["slots"] - 1, x["slots"]).alias("deadline"), F.get(x["members"], F.pmod(d, x["m"]).cast("int")).alias("at"), div(d, x["m"]).alias("turn"), x["slots"].alias("slots")),
            ),
        )
        # Evaluated once, as a one-element array.
        return F.transform(
            F.array(F.array_min(F.filter(windows, lambda w: w.isNotNull()))),
            lambda due: F.struct(
                F.zip_with(F.col("groups"), state["done"], lambda x, d: d + F.when(x["slots"] == due["slots"], 1).otherwise(0)).alias("done"),
                F.array_append(state["log"], F.struct(due["at"].alias("at"), due["turn"].alias("turn"))).alias("log"),
            ),
        )[0]

    entries = "array<struct<at:bigint,turn:bigint>>"
    logs = []
    for first in range(0, needed, LOT):
        stop = min(first + LOT, needed)

        def part(state: Column, start: Column) -> Column:
            ran = F.aggregate(F.sequence(start, F.least(start + (SEGMENT_SLOTS - 1), F.lit(stop - 1).cast("bigint"))), F.struct(state["done"].alias("done"), F.array().cast(entries).alias("log")), step)
            return F.transform(F.array(ran), lambda r: F.struct(r["done"].alias("done"), F.array_append(state["logs"], r["log"]).alias("logs")))[0]

        starts = F.sequence(F.lit(first).cast("bigint"), F.lit(stop - 1).cast("bigint"), F.lit(SEGMENT_SLOTS).cast("bigint"))
        run = F.aggregate(starts, F.struct(F.col("done"), F.array().cast(f"array<{entries}>").alias("logs")), part)
        state = staged(state.select("groups", run.alias("run")).select("groups", "run.done", F.flatten("run.logs").alias("log")), "state")
        logs.append(state.select(F.posexplode("log").alias("slot", "x")).select((F.col("slot") + F.lit(first).cast("bigint")).alias("slot"), "x.at", "x.turn"))
    if not logs:
        return listed.select("source", "n", "slots", "period", F.col("at").alias("turn"), F.col("at").alias("slot")).limit(0)
    return reduce(DataFrame.unionByName, logs).join(listed, "at").where("turn < blocks").select("source", "n", "slots", "period", "turn", "slot")


def placed_blocks(turns: DataFrame, block: int) -> DataFrame:
    """(source, block_no, slot, position): every block with its slot and the rows before it."""
    last = div(div(F.col("n") + (block - 1), F.lit(block).cast("bigint")) - 1 - F.col("turn"), F.col("slots"))
    whole = F.lit(0).cast("bigint")
    blocks = (
        turns.select("*", last.alias("last"))
        .select("*", F.explode(F.sequence(whole, F.col("last"), F.lit(LOT).cast("bigint"))).alias("lot"))
        .select("*", F.explode(F.sequence("lot", F.least(F.col("lot") + (LOT - 1), "last"))).alias("round"))
        .select("source", "n", (F.col("round") * F.col("slots") + F.col("turn")).alias("block_no"), (F.col("round") * F.col("period") + F.col("slot")).alias("slot"))
    )
    blocks = blocks.select("source", "block_no", "slot", F.least(F.lit(block).cast("bigint"), F.col("n") - F.col("block_no") * block).alias("size"), div(F.col("slot"), F.lit(SEGMENT_SLOTS).cast("bigint")).alias("part"))
    blocks = staged(blocks, "blocks")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("size").alias("size")).select("part", F.coalesce(F.sum("size").over(before.partitionBy(F.lit(0)).orderBy("part")), whole).alias("earlier"))
    local = F.coalesce(F.sum("size").over(before.partitionBy("part").orderBy("slot")), whole)
    return blocks.withColumn("local", local).join(parts, "part").select("source", "block_no", "slot", (F.col("earlier") + F.col("local")).alias("position"))


def mix(docs: DataFrame, weights: DataFrame | None = None, source_col: str = "source", id_col: str = "doc_id", block: int = BLOCK, period: int | None = None) -> DataFrame:
    """Every input row as ``row`` with its source, block_no, slot and position.

    ``weights`` (source, weight bigint) are the targets; by default the square
    roots of the sizes.  Positions number the mixed sequence from 0 without
    gaps: a source that has run out leaves its slots to no one, and sources
    without a target follow after all others.  Inside a source documents come
    in the order of a hash of their id, equal ids in any order.  A null source
    is the source ''.  No row is dropped or repeated; an empty table stays
    empty.  Any number of sources with any weights is mixed exactly; only with
    a ``period`` weights are rounded to that many slots, and no more sources fit.
    """
    rows = packed(docs).select(
        "row",
        F.coalesce(F.col("row").getField(source_col).cast("string"), F.lit("")).alias("source"),
        F.md5(F.coalesce(F.col("row").getField(id_col).cast("string"), F.lit("")).cast("binary")).alias("at"),
    )
    counts = staged(rows.groupBy("source").agg(F.count("*").alias("n")), "sources")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    weights = root_weights(counts) if weights is None else weights.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.col("weight").cast("bigint").alias("weight"))
    weights = weights.join(counts.select("source"), "source", "left_semi")
    digits = 2
    while 16**digits * SEGMENT_ROWS < total:
        digits += 1

    # Numbers inside a source: rank in a segment of hashes plus the segments before it.
    rows = rows.withColumn("segment", F.substring("at", 1, digits))
    earlier = Window.partitionBy("source").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(
        rows.groupBy("source", "segment").agg(F.count("*").alias("size")).select("source", "segment", "size", F.coalesce(F.sum("size").over(earlier), F.lit(0)).cast("bigint").alias("first")),
        "segments",
    )

    if period is None:
        shares = weights.where("weight > 0")
    else:
        shares = slots_per_period(weights, period).withColumnRenamed("slots", "weight")
        if (asked := shares.count()) > period:
            raise ValueError(f"{asked} sources do not fit into a period of {period} slots")
    shares = staged(shares.join(counts, "source"), "shares")
    blocks = placed_blocks(staged(schedule(shares, block), "period"), block)
    # The blocks of a segment go with its number, so that rows are not moved for them.
    size = F.lit(block).cast("bigint")
    spans = offsets.select("source", "segment", F.explode(F.sequence(div(F.col("first"), size), div(F.col("first") + F.col("size") - 1, size))).alias("block_no"))
    spans = spans.join(blocks, ["source", "block_no"]).groupBy("source", "segment").agg(F.sort_array(F.collect_list(F.struct("block_no", "slot", "position"))).alias("blocks"))
    offsets = staged(offsets.drop("size").join(spans, ["source", "segment"], "left"), "placed-segments")

    local = F.row_number().over(Window.partitionBy("source", "segment").orderBy("at")) - 1
    numbered = rows.withColumn("local", local.cast("bigint")).join(offsets, ["source", "segment"]).withColumn("nth", F.col("first") + F.col("local"))

    scheduled = shares.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    # Sources without a target: one after the other, by name; often there are none.
    others = counts.join(shares, "source", "left_anti").select("source", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("source").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("others_before"))
    if is_empty(others):
        numbered = numbered.withColumn("others_before", F.lit(0).cast("bigint"))
    else:
        numbered = numbered.join(others, "source", "left")

    block_no = div(F.col("nth"), size)
    at = F.get("blocks", (block_no - div(F.col("first"), size)).cast("int"))
    placed = numbered.select("row", "source", "nth", "others_before", block_no.alias("block_no"), at.alias("at"), scheduled.alias("scheduled"))
    position = F.when(F.col("at").isNotNull(), F.col("at.position") + F.pmod(F.col("nth"), size)).otherwise(F.col("scheduled") + F.col("others_before") + F.col("nth"))
    return placed.select("row", "source", "block_no", F.col("at.slot").alias("slot"), position.cast("bigint").alias("position"))
