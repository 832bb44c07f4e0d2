"""N-gram Jaccard join of documents by MinHash banding."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelathe.llm import minhash
from pagelathe.llm.common import packed, staged
from pagelathe.llm.words import WordHashes, word_shingles

#: Words of a shingle, similarity of a link, and the recall bands are chosen for.
WORDS, THRESHOLD = 5, 0.8
RECALL, ROWS = 0.999, 6


def _signer(words: int, threshold: float, recall: float, rows: int):
    bands = minhash.bands_for(threshold, recall, rows)

    @F.arrow_udf("struct<key: binary, size: bigint, bands: array<bigint>>")
    def signed(texts: pa.Array) -> pa.Array:
        cache, keys, sizes, every = WordHashes(), [], [], []
        for text in texts:
            h = word_shingles(text.as_py() or "", words, cache)
            sizes.append(len(h))
            keys.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
            every.append(minhash.band_keys(minhash.permuted(h, bands * rows)[None, :], rows)[0] if len(h) else np.empty(0, np.int64))
        ends = np.cumsum([0, *map(len, every)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(every) if every else np.empty(0, np.int64)))
        return pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), lists], ["key", "size", "bands"])

    return signed


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """Every input row as ``row`` with copy_id, class_id, n_links and first.

    Two documents are linked if the Jaccard similarity of their sets of
    ``words`` lower-case words in a row is ``threshold`` or more.  Documents
    with equal sets are copies; they count as links of each other and are
    compared with others once.  ``copy_id`` is the smallest id among the copies,
    ``class_id`` the smallest id reachable over links, ``n_links`` the number of
    other rows that are linked directly; ``first`` is true for one row of each
    class, the one with the smallest id.  Null ids come after all others.

    A text of fewer words is one shingle; a null, empty or wordless text has
    none and is linked to nothing.  Repeated rows are copies.  Pairs at the
    threshold share a band with probability ``recall`` or more, closer pairs
    with more; a link is only given after comparison of the full sets.
    """
    signed = _signer(words, threshold, recall, rows)
    rows_ = packed(docs).select(F.monotonically_increasing_id().alias("no"), "row", signed(F.coalesce(F.col("row").getField(text_col), F.lit(""))).alias("s"))
    table = staged(rows_.select("no", "row", F.col("s.key").alias("key"), F.col("s.size").alias("size"), F.col("s.bands").alias("bands")), "signed")
    key_id = F.col("row").getField(id_col)
    order = F.struct(key_id.isNull().alias("missing"), key_id.alias("id"), F.col("no").alias("no"))
    items = staged(
        table.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("no").alias("uid"), F.count("*").alias("copies"), F.min(order).alias("lead"), F.min(F.struct("size", "bands")).alias("s"))
        .select("key", "uid", "copies", "lead", F.col("s.size").alias("size"), F.col("s.bands").alias("bands")),
        "items",
    )

    def shingler():
        cache = WordHashes()
        return lambda text: word_shingles(text or "", words, cache)

    texts = table.select(F.col("no").alias("uid"), F.col("row").getField(text_col).alias("text"))
    keys = staged(items.select("uid", F.explode("bands").alias("band")), "keys")
    found = staged(minhash.verified(items, keys, texts, shingler, threshold), "found")
    heads = staged(found.select("uid", "root").join(items.select("uid", "lead"), "uid").groupBy("root").agg(F.min("lead").alias("head")), "heads")
    whole = staged(
        items.select("key", "uid", "copies", "lead")
        .join(found, "uid", "left")
        .join(heads, "root", "left")
        .select("key", "copies", "lead", F.coalesce("head", "lead").alias("head"), F.coalesce("copies_linked", F.lit(0)).alias("copies_linked")),
        "classes",
    )
    alone = F.col("copies").isNull()
    return table.select("no", "row", "key").join(whole, "key", "left").select(
        "row",
        F.when(alone, key_id).otherwise(F.col("lead.id")).alias("copy_id"),
        F.when(alone, key_id).otherwise(F.col("head.id")).alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("copies_linked"), F.lit(0)).cast("bigint").alias("n_links"),
        (alone | (F.col("head.no") == F.col("no"))).alias("first"),
    )
