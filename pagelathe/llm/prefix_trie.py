"""Prefix trie of conversations: ROLLUP over positional turn columns.

A conversation becomes rows of ``SPAN`` neighbouring turns, one column per
position; the row also carries the node that the turns before it lead to.  One
GROUP BY (block, node before, ROLLUP(turn columns)) then meets every prefix of
every length at once, and grouping_id says which position it ends at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelathe.llm.common import joined_hot, staged
from pagelathe.llm.scan import FACTOR, scanned

#: Positions of a block of columns.
SPAN = 8
#: Ids of one piece of a list of conversations.
PIECE = 4_096
OPENING_TURNS, FAMILY = 6, 100
NODE = ("depth", "h1", "h2")


def ordered_turns(conversations: DataFrame, name: str = "turns") -> DataFrame:
    """conv_id, position (from 1), role, text, turn_id, chars of every turn.

    Turns are ordered by turn, null first, those of one number by role and text;
    a null role or text is an empty one.  Rows without a conv_id belong to no
    conversation and are left out.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", text("role"), text("text"))
    told = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    found = scanned(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], {}, name)
    return found.withColumns({"turn_id": F.unhex(F.md5(told.cast("binary"))), "chars": F.length("text").cast("bigint")})


def opening_turns(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from the head of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % OPENING_TURNS


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations that share openings: conv_id, section, position, turn_id, chars.

    A conversation c gets the first h turns of conversation c - c % 100, all if
    it has fewer, none if it is absent, then its own turns after its first h.
    Its section 0 is a row without a turn, so that turnless conversations stay.
    """
    turns = turns.select("conv_id", "position", "turn_id", "chars")
    members = turns.where("position = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("head"), opening_turns(F.col("conv_id")).alias("h"))
    nothing = members.select("conv_id", F.lit(0).alias("section"), F.lit(0).cast("bigint").alias("position"), F.lit(None).cast("binary").alias("turn_id"), F.lit(None).cast("bigint").alias("chars"))
    # A family has 100 members and a head five such turns at most.
    heads = turns.where(f"position < {OPENING_TURNS} AND conv_id % {FAMILY} = 0").withColumnRenamed("conv_id", "head")
    shared = members.join(heads, "head").where("position <= h").select("conv_id", F.lit(1).alias("section"), "position", "turn_id", "chars")
    own = turns.where(F.col("position") > opening_turns(F.col("conv_id"))).select("conv_id", F.lit(2).alias("section"), "position", "turn_id", "chars")
    return nothing.unionByName(shared).unionByName(own)


def _paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, turn: the turn struct holds the node it leads to and the one before."""
    hashed = turns.where("turn_id IS NOT NULL").withColumns({"a": F.xxhash64("turn_id"), "b": F.xxhash64(F.lit("b"), "turn_id")}).withColumnRenamed("position", "at")
    order = [F.col("section"), F.col("at")]
    found = scanned(hashed, "conv_id", order, {"h1": ("a", FACTOR), "h2": ("b", FACTOR + 2)}, "paths")
    return found.select("conv_id", F.col("position").alias("depth"), F.struct("turn_id", "chars", "h1", "h2", "h1_before", "h2_before").alias("turn"))


def _blocks(paths: DataFrame, extra: dict[str, str]) -> DataFrame:
    """Rows of SPAN positions: conv_id, block, p1 and p2 of the node before, t1 to t8, and further columns by position."""
    at = F.greatest("depth", F.lit(1).cast("bigint")) - 1
    placed = paths.withColumns({"block": F.call_function("div", at, F.lit(SPAN)), "slot": F.when(F.col("depth") > 0, at % SPAN + 1)})
    of = lambda c, i: F.max(F.when(F.col("slot") == i, F.col(c)))
    first = F.max(F.when(F.col("slot") == 1, F.struct("turn.h1_before", "turn.h2_before")))
    turns = [of("turn", i).alias(f"t{i}") for i in range(1, SPAN + 1)]
    more = [of(c, i).alias(f"{short}{i}") for c, short in extra.items() for i in range(1, SPAN + 1)]
    rows = placed.groupBy("conv_id", "block").agg(first.alias("p"), *turns, *more)
    return rows.withColumns({"p1": F.coalesce("p.h1_before", F.lit(0).cast("bigint")), "p2": F.coalesce("p.h2_before", F.lit(0).cast("bigint"))}).drop("p")


def _rolled_up(blocks: DataFrame, measures: str) -> DataFrame:
    """One row per node: depth, last (turn struct, null for the root) and the measures."""
    turns = ", ".join(f"t{i}" for i in range(1, SPAN + 1))
    last = "CASE level " + " ".join(f"WHEN {i} THEN t{i}" for i in range(1, SPAN + 1)) + " END"
    # A group whose last column is null is met again at the depth where its conversations end.
    return blocks.sparkSession.sql(
        f"""
        SELECT block * {SPAN} + level AS depth, {last} AS last, * EXCEPT (block, level, {turns}) FROM (
          SELECT block, {turns}, {SPAN} - bit_count(grouping_id()) AS level, {measures}
          FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP({turns}))
        WHERE level = 0 AND block = 0 OR {last} IS NOT NULL""",
        blocks=blocks,
    )


def _by_level(short: str) -> str:
    """Sum of the column that belongs to the level; the root takes that of its children."""
    return "CASE " + f"{SPAN} - bit_count(grouping_id()) WHEN 0 THEN sum({short}1) " + " ".join(f"WHEN {i} THEN sum({short}{i})" for i in range(1, SPAN + 1)) + " END"


def _digests(ends: DataFrame) -> DataFrame:
    """h1, h2, ends_sha256 of (h1, h2, conv_id): SHA-256 of the ids of a node, ascending, joined by commas.

    Ranges of (node, id) write pieces of bounded length; a node's pieces are
    hashed one after another, so neither its ids nor its text is ever in one row.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []

        def close() -> None:
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for h1, h2, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h1, h2) != node or len(ids) == PIECE:
                    close()
                    node, ids = (h1, h2), []
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["h1", "h2", "first", "ids"])
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["h1", "h2", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for h1, h2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h1, h2) == node:
                    state.update(b",")
                else:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (h1, h2), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["h1", "h2", "ends_sha256"])
                out.clear()
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], ["h1", "h2", "ends_sha256"])

    ranged = ends.select("h1", "h2", "conv_id").repartitionByRange("h1", "h2", "conv_id").sortWithinPartitions("h1", "h2", "conv_id")
    cut = staged(ranged.mapInArrow(pieces, "h1 bigint, h2 bigint, first bigint, ids string"), "pieces")
    return cut.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "first").mapInArrow(digest, "h1 bigint, h2 bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations.

    ``turns`` has conv_id, section, position, turn_id and chars: the turns of a
    conversation in the order of (section, position); rows with a null turn_id
    only say that the conversation is there.  Repeated rows are repeated turns.
    Nodes are the different sequences of the first d turns, the root has none;
    an empty table has no node.

    Columns: depth, h1, h2 (together the node), up1, up2 (its parent), conv_id
    (its smallest conversation), turn_id, chars (of its last turn),
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    turns = turns.withColumn("conv_id", F.col("conv_id").cast("bigint")).where("conv_id IS NOT NULL")
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    paths = staged(_paths(turns), "paths")
    kind = paths.schema["turn"].dataType
    here = turns.select("conv_id").distinct()
    present = here.select("conv_id", F.lit(0).cast("bigint").alias("depth"), none("turn", kind))
    met = paths.unionByName(present)

    rolled = _rolled_up(_blocks(met, {}), "min(conv_id) AS conv_id, count(*) AS n_convs")
    zero = F.lit(0).cast("bigint")
    nodes = staged(
        rolled.select(
            "depth",
            F.coalesce("last.h1", zero).alias("h1"),
            F.coalesce("last.h2", zero).alias("h2"),
            F.col("last.h1_before").alias("up1"),
            F.col("last.h2_before").alias("up2"),
            F.col("last.turn_id").alias("turn_id"),
            F.coalesce("last.chars", zero).alias("chars"),
            "conv_id",
            "n_convs",
        ),
        "nodes",
    )
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("h1"), F.col("up2").alias("h2")).agg(F.count("*").alias("n_children"))
    nodes = staged(nodes.join(kids, [*NODE], "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes-children")

    # A node belongs to its smallest conversation, once; what lies below a node
    # is then the sum, over its conversations, of what they own from there on.
    owned = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), (F.col("n_children") == 0).cast("bigint").alias("leaf"))
    valued = paths.join(owned, ["conv_id", "depth"], "left").withColumns({"saved": F.coalesce("saved", zero), "leaf": F.coalesce("leaf", zero)})
    below = scanned(staged(valued, "valued"), "conv_id", [F.col("depth").desc()], {"saved_below": ("saved", 1), "leaves_below": ("leaf", 1)}, "below")
    below = below.where("saved_below <> 0 OR leaves_below <> 0").select("conv_id", "depth", "turn", "saved_below", "leaves_below")
    sums = _rolled_up(_blocks(below, {"saved_below": "s", "leaves_below": "l"}), f"{_by_level('s')} AS saved_tokens, {_by_level('l')} AS n_leaves")
    sums = sums.select("depth", F.coalesce("last.h1", zero).alias("h1"), F.coalesce("last.h2", zero).alias("h2"), "saved_tokens", "n_leaves")

    last = met.groupBy("conv_id").agg(F.max(F.struct("depth", F.coalesce("turn.h1", zero).alias("h1"), F.coalesce("turn.h2", zero).alias("h2"))).alias("end"))
    ends = _digests(last.select("conv_id", "end.*"))

    parents = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("up1"), F.col("h2").alias("up2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    whole = nodes.join(sums, [*NODE], "left").join(ends, ["h1", "h2"], "left")
    lone = whole.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    named = joined_hot(staged(whole.where("depth > 0"), "nodes-whole"), parents, ["depth", "up1", "up2"], "n_children")
    return named.unionByName(lone).withColumns(
        {
            # A trie of turnless conversations alone has just the root, its own leaf.
            "n_leaves": F.greatest(F.coalesce("n_leaves", zero), F.lit(1).cast("bigint")),
            "saved_tokens": F.coalesce("saved_tokens", zero),
            "ends_sha256": F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())),
        }
    )


def last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Role and text of each node's last turn, from ``ordered_turns``; null for the root."""
    texts = turns.groupBy("turn_id").agg(F.first(F.struct("role", "text")).alias("said"))
    return nodes.join(texts, "turn_id", "left").select("*", "said.role", "said.text").drop("said")
