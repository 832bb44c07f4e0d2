"""Benchmark decontamination by SimHash over item-sized windows.

1. Texts become sequences of word-shingle hashes.  A window can only be similar
   to an item if it shares shingles with one, so positions that hold a shingle
   of the benchmark are found first (one join on hashes).
2. For every such position and item size a window of that size starts there, if
   it holds enough shared shingles to reach the threshold at all.  Shifting a
   window to its first shared shingle never lowers a similarity, so no other
   windows are needed.
3. Windows and items get 64-bit SimHash fingerprints, summed in packed lanes.
4. Fingerprints within the radius agree, in one block of 16 bits out of four, up
   to a quarter of the radius: items list all neighbours of their blocks, and
   an equality join finds every pair within the radius.
5. Candidates are verified by the weighted Jaccard similarity of the shingles
   (weights are numbers of occurrences).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelathe.llm.common import packed, staged

WORDS, THRESHOLD = 5, 0.8
#: Bits in which fingerprints may differ.  Two windows of similarity 0.8 differ
#: in 9.7 of 64 bits on average; 15 are reached by 97 of 100 such pairs, and all
#: exact passages differ in none.
RADIUS = 15
BLOCKS, BLOCK_BITS = 4, 16


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hashes of all runs of ``words`` lower-case words, in order; empty for shorter texts."""
    parts = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\p{M}_]+"), lambda w: w != "")
    none = F.array().cast("array<bigint>")
    return bound(
        parts,
        lambda w: F.when(F.size(w) < words, none).otherwise(F.transform(F.sequence(F.lit(1), F.size(w) - (words - 1)), lambda i: F.xxhash64(F.slice(w, i, words)))),
    )


def fingerprint(hashes: Column, lane: int) -> Column:
    """SimHash of an array of hashes; counters are lanes of ``lane`` bits in longs."""
    lanes = 64 // lane
    ones = sum(1 << (lane * i) for i in range(lanes))
    ones -= (ones >> 63) << 64
    start = F.struct(*[F.lit(0).cast("bigint").alias(f"c{j}") for j in range(lane)])
    sums = F.aggregate(
        hashes,
        start,
        lambda a, h: F.struct(*[(a[f"c{j}"] + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(ones).cast("bigint"))).alias(f"c{j}") for j in range(lane)]),
    )

    def bits(x: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for j in range(lane):
            for i in range(lanes):
                count = F.shiftrightunsigned(x["s"][f"c{j}"], lane * i).bitwiseAND(F.lit((1 << lane) - 1).cast("bigint"))
                out = out.bitwiseOR(F.when(2 * count > x["n"], F.shiftleft(F.lit(1).cast("bigint"), j + lane * i)).otherwise(F.lit(0).cast("bigint")))
        return out

    return bound(F.struct(sums.alias("s"), F.size(hashes).alias("n")), bits)


def block_keys(print_: Column) -> Column:
    """(number, value) of the 16-bit blocks of a fingerprint."""
    return F.array(*[F.struct(F.lit(b).alias("number"), F.shiftrightunsigned(print_, BLOCK_BITS * b).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("bigint")).cast("int").alias("value")) for b in range(BLOCKS)])


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Sum of smaller over sum of larger numbers of occurrences."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    times = lambda c, x: F.size(F.filter(c, lambda y: y == x))
    both = F.array_intersect(a, b)
    least = F.when(plain, F.size(both)).otherwise(F.aggregate(both, F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x))))
    return least / (F.size(a) + F.size(b) - least)


def numbered(docs: DataFrame) -> DataFrame:
    """Rows with a number that stays, as (no, row)."""
    return staged(packed(docs).select(F.monotonically_increasing_id().alias("no"), "row"), "numbered")


def contaminated(rows: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(no, item_id, similarity, start, n_shingles) of rows that hold an item.

    ``rows`` is a written table (no, row).  A row holds an item if one of its
    windows of the item's size has a weighted Jaccard similarity of
    ``threshold`` or more with it; the best window is given, the first of equal
    ones, counted in words from 0.  Items with fewer than ``words`` words, null
    texts and empty tables match nothing.  Equal items are all given.
    """
    items = staged(
        benchmark.select(F.col(item_col).alias("item_id"), shingle_hashes(F.col(item_text), words).alias("item")).where(F.size("item") > 0).withColumn("k", F.size("item")),
        "items",
    )
    longest = items.agg(F.max("k")).first()[0] or 0
    # Counters that hold the longest item; they do not change any result.
    lane = 8 if longest < 1 << 7 else 16 if longest < 1 << 15 else 32
    known = staged(items.select(F.explode("item").alias("h")).distinct(), "item-shingles")
    at = rows.select("no", F.posexplode(shingle_hashes(F.col("row").getField(text_col), words)).alias("at", "h"))
    shared = staged(at.join(known, "h").groupBy("no").agg(F.sort_array(F.collect_list("at")).alias("at")), "shared")

    sizes = items.agg(F.sort_array(F.collect_set("k"))).scalar()
    texts = rows.select("no", F.col("row").getField(text_col).alias("text")).join(shared, "no").select("no", "at", shingle_hashes(F.col("text"), words).alias("g"), sizes.alias("sizes"))

    def windows(at: Column, g: Column, sizes: Column) -> Column:
        def starting(p: Column, i: Column) -> Column:
            # The place, among shared positions, of the last one that a window needs.
            enough = lambda k: F.get(at, i + F.ceil(k * threshold - 1e-9).cast("int") - 1) < p + k
            return F.transform(F.filter(sizes, enough), lambda k: F.struct(p.alias("start"), k.alias("k"), F.slice(g, p + 1, k).alias("part")))

        return F.flatten(F.transform(at, starting))

    cut = texts.select("no", F.explode(windows(F.col("at"), F.col("g"), F.col("sizes"))).alias("w")).select("no", "w.start", "w.k", "w.part")
    printed = staged(cut.withColumn("print", fingerprint(F.col("part"), lane)), "windows")

    spread = F.filter(F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda m: F.bit_count(m) <= radius // BLOCKS)
    index = (
        items.withColumn("item_print", fingerprint(F.col("item"), lane))
        .select("item_id", "item", "item_print", "k", F.explode(block_keys(F.col("item_print"))).alias("b"))
        .select("item_id", "item_print", "k", "b.number", "b.value", F.explode(spread).alias("mask"))
        .select("item_id", "item_print", "k", "number", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
    )
    pairs = (
        printed.select("no", "start", "k", "print", F.explode(block_keys(F.col("print"))).alias("b"))
        .select("no", "start", "k", "print", "b.number", "b.value")
        .join(index, ["k", "number", "value"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select("no", "start", "k", "item_id")
        .distinct()
    )
    candidates = pairs.join(printed.select("no", "start", "k", "part"), ["no", "start", "k"]).join(items.select("item_id", "k", "item"), ["item_id", "k"])
    return (
        candidates.withColumn("similarity", weighted_jaccard(F.col("part"), F.col("item")))
        .where(F.col("similarity") >= threshold - 1e-9)
        .groupBy("no", "item_id")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), F.size("part").alias("n"))).alias("best"))
        .select("no", "item_id", "best.similarity", (-F.col("best.s")).alias("start"), F.col("best.n").alias("n_shingles"))
    )
