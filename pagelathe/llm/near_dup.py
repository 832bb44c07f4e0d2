"""Near duplicates by b-bit MinHash: bands, corrected estimates, full sets.

Of every minimum the two lowest bits are kept, 32 to a long.  Items that share a
band are candidates; the bits that two signatures have in common, corrected for
equal bits by chance, estimate their similarity; only pairs whose estimate is not
far below the threshold are compared on their full shingle sets.

Groups of n alike are not n * n pairs: first every item is compared with the
first item of the band where the two look closest.  Where a band still holds
several components, signatures of its items are compared in blocks, which give
back one row per item; items that may still have a link are then compared on
their full sets, again in blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelathe.llm.common import is_empty, joined_hot, staged
from pagelathe.llm.components import connected
from pagelathe.llm.minhash import _compare, _roots, band_keys, multipliers
from pagelathe.llm.words import WordHashes, rolling

#: Words of a shingle, and the similarity of a link in hundredths.
WORDS, PERCENT = 5, 85
#: 21 bands of 6 rows: a pair at the threshold shares one with probability 0.99995.
BANDS, ROWS = 21, 6
#: Minima, bits kept of each, and how far an estimate may lie below the
#: threshold: 0.2 is over five standard deviations of 128 two-bit minima.
MINIMA, BITS, SLACK = 128, 2, 0.2
LOW_BITS = 0x5555555555555555
#: Items of a block of signatures, and items and shingles of a block of sets.
BLOCK_ITEMS, SET_ITEMS, SET_SHINGLES = 512, 128, 200_000
#: Shingles that are hashed at once.
TILE = 4_096


class Shingles:
    """Text to its distinct shingle hashes, ascending."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, _Bytes()

    def __call__(self, text: str) -> np.ndarray:
        # Bytes change only A to Z and split only at space and 9 to 13.
        found = text.encode("utf-8", "surrogatepass").lower().split()
        h = np.frombuffer(b"".join(map(self.known.__getitem__, found)), "<u8")
        return np.unique(rolling(h, min(self.words, len(h)))) if len(h) else h


class _Bytes(WordHashes):
    def __missing__(self, word: bytes) -> bytes:
        return super().__missing__(word.decode("utf-8", "surrogatepass"))


def minima(h: np.ndarray) -> np.ndarray:
    """Minima of MINIMA hash functions over one set of shingle hashes."""
    factor, offset = (x.astype(np.uint32) for x in multipliers(MINIMA))
    low = (h >> np.uint64(32)).astype(np.uint32)
    least = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(low), TILE):
        part = low[start : start + TILE]
        with np.errstate(over="ignore"):
            mixed = (part[None, :] ^ offset[:, None]) * (factor[:, None] | np.uint32(1))
        np.minimum(least, mixed.min(axis=1), out=least)
    return least


def packed_bits(least: np.ndarray) -> np.ndarray:
    """The two low bits of well-mixed minima, 32 minima to a long."""
    # The low bits of a product hold only low bits, so they are taken from a mix of all.
    spread = (least ^ (least >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    bits = ((spread >> np.uint32(12)) & np.uint32(3)).astype(np.uint64).reshape(-1, 32)
    return (bits << np.arange(0, 64, 2, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


def estimate(same: Column) -> Column:
    """Similarity from the number of equal minima, corrected for those equal by chance."""
    chance = 2.0**-BITS
    return (same / MINIMA - chance) / (1 - chance)


def _same(a: str, b: str) -> Column:
    """How many two-bit fields of two signatures are equal."""
    differ = F.zip_with(a, b, lambda x, y: F.bit_count((x.bitwiseXOR(y).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), 1))).bitwiseAND(F.lit(LOW_BITS))))
    return F.lit(MINIMA) - F.aggregate(differ, F.lit(0), lambda total, n: total + n)


def _signer(words: int):
    @F.arrow_udf("struct<key: binary, size: bigint, bits: array<bigint>, bands: array<bigint>>")
    def signed(texts: pa.Array) -> pa.Array:
        of, keys, sizes, bits, every = Shingles(words), [], [], [], []
        for text in texts:
            h = of(text.as_py())
            sizes.append(len(h))
            keys.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
            if len(h):
                least = minima(h)
                bits.append(packed_bits(least))
                every.append(band_keys(least[None, : BANDS * ROWS].astype(np.uint64), ROWS)[0])
            else:
                bits.append(np.empty(0, np.int64))
                every.append(np.empty(0, np.int64))
        lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]).astype(np.int32)), pa.array(np.concatenate(x) if x else np.empty(0, np.int64))) for x in (bits, every)]
        return pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), *lists], ["key", "size", "bits", "bands"])

    return signed


def _setter(words: int):
    @F.arrow_udf("array<bigint>")
    def sets(texts: pa.Array) -> pa.Array:
        of = Shingles(words)
        found = [of(t.as_py()).view(np.int64) for t in texts]
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32)), pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))

    return sets


def _with(pairs: DataFrame, items: DataFrame, column: str) -> DataFrame:
    """Pairs (u, v) with a column of both items; v may be the same in very many pairs."""
    pairs = pairs.join(items.select(F.col("uid").alias("u"), F.col(column).alias(f"{column}_u")), "u")
    often = pairs.groupBy("v").agg(F.count("*").alias("n"))
    found = often.join(items.select(F.col("uid").alias("v"), F.col(column).alias(f"{column}_v")), "v")
    return joined_hot(pairs, found, ["v"], "n", by=["u"])


def _closest(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """Of the pairs of each u the one that looks closest, if its estimate does not rule out the threshold."""
    told = _with(pairs, items, "bits").select("u", "v", _same("bits_u", "bits_v").alias("same"))
    return told.where(estimate(F.col("same")) >= percent / 100 - SLACK).groupBy("u").agg(F.max(F.struct("same", -F.col("v"))).alias("best")).select("u", (-F.col("best.col2")).alias("v"))


def _sets(table: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """uid and set of the items wanted, a written table."""
    return staged(table.select(F.col("no").alias("uid"), "text").join(wanted.distinct(), "uid").select("uid", _setter(words)("text").alias("set")), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    both = _with(pairs, sets, "set").withColumn("shared", F.size(F.array_intersect("set_u", "set_v")))
    return both.where(100 * F.col("shared") >= percent * (F.size("set_u") + F.size("set_v") - F.col("shared"))).select("u", "v")


def _in_blocks(rows: DataFrame, group: str, parts: Column, bundles: Column) -> DataFrame:
    """Rows (uid, ...) once for every pair of blocks of their group: single, bundle, a and b name the pair.

    Groups of one block share bundles; each has to be compared within itself.
    """
    bundle = F.when(F.col("parts") == 1, F.pmod(F.xxhash64(group), bundles)).otherwise(F.col(group))
    return (
        rows.withColumn("parts", parts.cast("bigint"))
        .withColumns({"single": F.col("parts") == 1, "bundle": bundle, "part": F.pmod(F.xxhash64("uid"), F.col("parts"))})
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .withColumns({"a": F.least("part", "other"), "b": F.greatest("part", "other")})
        .drop("parts", "part", "other")
    )


def _undecided(members: DataFrame, found: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """(u, v): items that may have a link to another component of a band, tied to the groups they form."""
    of = staged(members.join(found.withColumnRenamed("node", "uid"), "uid", "left").withColumn("component", F.coalesce("component", "uid")), "of-bands")
    mixed = of.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    mixed = staged(mixed.where("low <> high").select("band", "n", F.col("n").alias("size")), "mixed-bands")
    total = mixed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = joined_hot(of.select("band", "uid", "component"), mixed, ["band"], "n", by=["uid"]).join(items.select("uid", "bits"), "uid")
    placed = _in_blocks(rows, "band", F.ceil(F.col("size") / BLOCK_ITEMS), F.lit(max(1, total // BLOCK_ITEMS)))
    least_same = int(np.ceil(((percent / 100 - SLACK) * (1 - 2.0**-BITS) + 2.0**-BITS) * MINIMA - 1e-9))

    def compare(table: pa.Table) -> pa.Table:
        uid, component, band = (table.column(c).to_numpy() for c in ("uid", "component", "band"))
        bits = table.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(uid), -1)
        near = np.empty((len(uid), len(uid)), bool)
        for start in range(0, len(uid), BLOCK_ITEMS):
            rows = slice(start, start + BLOCK_ITEMS)
            same = np.full(near[rows].shape, MINIMA, np.int16)
            for column in bits.T:
                x = column[rows, None] ^ column[None, :]
                same -= np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(LOW_BITS)).astype(np.int16)
            near[rows] = (same >= least_same) & (band[rows, None] == band[None, :]) & (component[rows, None] != component[None, :])
        has = near.any(axis=1)
        return pa.table({"u": uid[has], "v": uid[_roots(near)][has]})

    return placed.select("band", "uid", "component", "bits", "single", "bundle", "a", "b").groupBy("single", "bundle", "a", "b").applyInArrow(compare, "u bigint, v bigint").distinct()


def _linked(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): items (node, component) of a group tied to the first that links lead to, by their full sets."""
    rows = staged(groups.withColumnRenamed("node", "uid").join(sets.select("uid", F.size("set").alias("size")), "uid"), "grouped")
    whole = rows.groupBy("component").agg(F.count("*").alias("n"), F.greatest(F.ceil(F.count("*") / SET_ITEMS), F.ceil(F.sum("size") / SET_SHINGLES)).alias("blocks"))
    whole = staged(whole, "groups")
    items, shingles = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    sized = joined_hot(rows.select("uid", "component"), whole, ["component"], "n", by=["uid"]).join(sets, "uid")
    placed = _in_blocks(sized, "component", F.col("blocks"), F.lit(max(1, items // SET_ITEMS, shingles // SET_SHINGLES)))

    def compare(table: pa.Table) -> pa.Table:
        uid, component = table.column("uid").to_numpy(), table.column("component").to_numpy()
        linked = _compare([x.values.to_numpy() for x in table.column("set")], percent / 100)
        linked &= component[:, None] == component[None, :]
        np.fill_diagonal(linked, False)
        has = linked.any(axis=1)
        return pa.table({"u": uid[has], "v": uid[_roots(linked)][has]})

    return placed.select("uid", "component", "set", "single", "bundle", "a", "b").groupBy("single", "bundle", "a", "b").applyInArrow(compare, "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are runs of anything but space and the characters 9 to 13, A to Z in
    lower case; a document's set are its different runs of ``words`` words, or
    the whole sequence if it has fewer.  Documents are linked if 100 times their
    common shingles is ``percent`` times all of theirs or more; equal sets are.
    ``component_id`` is the smallest id that links lead to, its own included;
    ``kept`` says that it is the row's own.

    A null, empty or wordless text has an empty set and no link.  Repeated rows
    are copies of each other and all have the same ``kept``.  Null ids come after
    all others: a component of null ids alone has the id null.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("no"), F.col(id_col).alias("doc_id"), text.alias("text"))
    table = staged(rows.withColumn("s", _signer(words)("text")).select("no", "doc_id", "text", "s.*"), "signed")
    lead = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"))
    items = table.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("no", "bits", "bands")).alias("s"), F.min(lead).alias("lead"))
    items = staged(items.select("key", F.col("s.no").alias("uid"), "lead", F.col("s.bits").alias("bits"), F.col("s.bands").alias("bands")), "items")

    keys = staged(items.select("uid", F.explode("bands").alias("band")), "keys")
    shared = staged(keys.groupBy("band").agg(F.min("uid").alias("first"), F.count("*").alias("n")).where("n > 1"), "shared-bands")
    members = staged(joined_hot(keys, shared, ["band"], "n", by=["uid"]), "members")

    tried = members.where("uid <> first").select(F.col("uid").alias("u"), F.col("first").alias("v")).distinct()
    tried = staged(_closest(tried, items, percent), "pairs")
    links = staged(_confirmed(tried, _sets(table, tried.select(F.explode(F.array("u", "v")).alias("uid")), words), percent), "links")
    found = staged(connected(links), "components")
    groups = staged(connected(staged(_undecided(members, found, items, percent), "undecided")), "undecided-groups")
    if not is_empty(groups):
        more = staged(_linked(groups, _sets(table, groups.select(F.col("node").alias("uid")), words), percent), "links")
        found = staged(connected(links.unionByName(more)), "components")

    whole = items.join(found.withColumnRenamed("node", "uid"), "uid", "left").select("key", "lead", F.coalesce("component", "uid").alias("component"))
    heads = whole.groupBy("component").agg(F.min("lead").alias("head"), F.count("*").alias("n"))
    of_key = staged(joined_hot(whole.select("key", "component"), heads, ["component"], "n", by=["key"]).select("key", "head"), "heads")
    copies = table.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n")).join(of_key, "key")
    plain = table.select("no", "doc_id", "size", "key")
    with_head = joined_hot(plain.where("key IS NOT NULL"), copies, ["key"], "n", by=["no"]).select("doc_id", "size", F.col("head.id").alias("component_id"))
    whole = with_head.unionByName(plain.where("key IS NULL").select("doc_id", "size", F.col("doc_id").alias("component_id")))
    return whole.select("doc_id", F.col("size").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
