"""Similarity links by MinHash bands: candidates, exact verification, groups.

Items that share a band key become edges to the first item of that key; the
components of these edges hold every pair that shares a band.  Inside a
component each pair of blocks of items is one group of bounded size in which all
pairs are compared on their full shingle sets, and which gives back one row per
item: its number of links and its local root.  No pair of items is ever a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.llm.common import staged
from pagelathe.llm.components import connected
from pagelathe.llm.words import mixed

#: Bounds of a block: items, and shingles of all its items.
BLOCK_ITEMS = 128
BLOCK_SHINGLES = 200_000
#: Items of small components that are compared in one go.
PACK_ITEMS = 32
#: Band keys that may be frequent and are settled by a table of this size.
HEAVY_KEYS, COUNTERS = 1_000, 65_536
#: Columns of the incidence matrix that are held at once.
TILE = 4_096


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` rows for a pair at the threshold to share one with this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of n hash functions, from a fixed rule."""
    made = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return made[:n] | np.uint64(1), made[n:]


def permuted(h: np.ndarray, n: int) -> np.ndarray:
    """n independent minima over one set of shingle hashes."""
    factor, offset = multipliers(n)
    with np.errstate(over="ignore"):
        least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        for start in range(0, len(h), 2_048):
            part = h[start : start + 2_048]
            np.minimum(least, ((part[None, :] ^ offset[:, None]) * factor[:, None]).min(axis=1), out=least)
    return least


def permuted_runs(h: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """permuted() of many sets, one after another in ``h``; one row each."""
    factor, offset = (x.astype(h.dtype) for x in multipliers(n))
    out, held = np.empty((n, len(starts)), h.dtype), np.empty_like(h)
    with np.errstate(over="ignore"):
        for i in range(n):
            np.multiply(np.bitwise_xor(h, offset[i], out=held), factor[i], out=held)
            np.minimum.reduceat(held, starts, out=out[i])
    return out.T


def band_keys(minima: np.ndarray, rows: int, seed: int = 0) -> np.ndarray:
    """One 64-bit key per band of ``rows`` neighbouring columns."""
    bands = minima.shape[1] // rows
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64) + np.uint64(seed << 32)), (minima.shape[0], bands)).copy()
        for r in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + minima[:, r : bands * rows : rows])
    return key.view(np.int64)


def candidates(keys: DataFrame) -> DataFrame:
    """(node, component) of the items in a written table (uid, band) that share a band key."""
    # Keys that may be frequent get their first item from one small table, so
    # that no task sorts all their rows; the others are settled by one shuffle.
    nominated = keys.selectExpr(f"approx_top_k(band, {HEAVY_KEYS}, {COUNTERS}) AS top").select(F.explode("top").alias("t")).where(f"t.count > {BLOCK_ITEMS}").select(F.col("t.item").alias("band"))
    heavy = staged(keys.join(F.broadcast(nominated), "band").groupBy("band").agg(F.min("uid").alias("first")), "heavy-keys")
    settled = keys.join(F.broadcast(heavy), "band")  # ``HEAVY_KEYS`` rows at most
    rest = keys.join(F.broadcast(heavy.select("band")), "band", "left_anti").withColumn("first", F.min("uid").over(Window.partitionBy("band")))
    edges = settled.select("uid", "first").unionByName(rest.select("uid", "first")).where("uid <> first")
    return connected(edges.select(F.col("uid").alias("u"), F.col("first").alias("v")))


def _compare(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of the threshold or more."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    fresh = np.ones(len(every), bool)
    fresh[1:] = every[1:] != every[:-1]
    number = np.cumsum(fresh) - 1
    return linked_pairs(number, owner, sizes, threshold)


def linked_pairs(number: np.ndarray, owner: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """_compare of sets given as (shingle number, ascending; owner) without repeats, and their sizes."""
    n = len(sizes)
    shared = np.bincount(number, minlength=0)[number] > 1
    number, owner = number[shared], owner[shared]
    both = np.zeros((n, n), np.float32)
    if len(number):
        column = np.cumsum(np.concatenate([[0], np.diff(number) != 0]))
        width = min(TILE, int(column[-1]) + 1)
        cuts = np.searchsorted(column, np.arange(0, column[-1] + 1, TILE))
        for a, b in zip(cuts, [*cuts[1:], len(column)], strict=True):
            tile = np.zeros((n, width), np.float32)
            tile[owner[a:b], column[a:b] % TILE] = 1
            both += tile @ tile.T
    union = sizes[:, None] + sizes[None, :] - both
    return (union > 0) & (both >= threshold * union - 1e-9)


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index that each index is connected with."""
    n = len(linked)
    near = linked | np.eye(n, dtype=bool)
    root = np.arange(n)
    while True:
        new = np.where(near, root[None, :], n).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def verified(items: DataFrame, keys: DataFrame, texts: DataFrame, shingles: Callable[[], Callable[[str], np.ndarray]] | None, threshold: float, on: str = "uid", compared: Callable[[list[str]], np.ndarray] | None = None) -> DataFrame:
    """(uid, links, copies_linked, root, and ``on``): true links of items that share a band.

    ``items`` (uid, size, copies), ``keys`` (uid, band) and ``texts`` (uid,
    text) are written tables; ``on`` is another column that both share, to find the texts by; ``shingles()`` makes, once per task, the function from a text to its
    distinct shingle hashes, or ``compared`` says of a list of texts which pairs
    are similar.  Only items with links have rows; ``links`` counts
    other items, ``copies_linked`` their copies, ``root`` is a member of the
    same group and one for all of it.
    """
    groups = staged(candidates(keys), "candidates")
    member = staged(items.select(*{"uid": 0, on: 0}, "size", "copies").join(groups.withColumnRenamed("node", "uid"), "uid"), "members")
    parts = member.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_ITEMS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("bigint").alias("parts")
    )
    many = staged(parts.where("parts > 1"), "parts")
    items_, shingles_ = member.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    packs = max(1, items_ // PACK_ITEMS, shingles_ // BLOCK_SHINGLES)
    # Components of one block share groups; each is compared within itself.
    single = F.col("parts") == 1
    placed = (
        member.join(many, "component", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint")))
        .withColumn("part", F.pmod(F.xxhash64("uid"), "parts"))
        .withColumn("bundle", F.when(single, F.pmod(F.xxhash64("component"), F.lit(packs))).otherwise(F.col("component")))
        .join(texts.select(on, "text"), on)
        .select("uid", "copies", "component", "bundle", "part", "text", single.alias("single"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("other"))
        .select("uid", "copies", "text", "component", "bundle", "single", "part", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"))
    )

    def compare(table: pa.Table) -> pa.Table:
        texts_ = table.column("text").to_pylist()
        part, a = table.column("part").to_numpy(), table.column("a")[0].as_py()
        within = a == table.column("b")[0].as_py()
        if compared:
            linked = compared(texts_)
        else:
            of = shingles()
            linked = _compare([of(t) for t in texts_], threshold)
        np.fill_diagonal(linked, False)
        component = table.column("component").to_numpy()
        linked &= component[:, None] == component[None, :]
        if not within:
            linked &= (part == a)[:, None] != (part == a)[None, :]
        copies = table.column("copies").to_numpy()
        uid = table.column("uid").to_numpy()
        has = linked.any(axis=1)
        return pa.table({"uid": uid[has], "links": linked.sum(axis=1)[has].astype(np.int64), "copies_linked": (linked @ copies)[has].astype(np.int64), "root": uid[_roots(linked)][has]})

    schema = "uid bigint, links bigint, copies_linked bigint, root bigint"
    found = staged(placed.groupBy("single", "bundle", "a", "b").applyInArrow(compare, schema), "links")
    groups = connected(found.select(F.col("uid").alias("u"), F.col("root").alias("v")))
    sums = found.groupBy("uid").agg(F.sum("links").alias("links"), F.sum("copies_linked").alias("copies_linked"))
    linked = sums.join(groups.select(F.col("node").alias("uid"), F.col("component").alias("root")), "uid")
    return linked if on == "uid" else linked.join(member.select("uid", on), "uid")

