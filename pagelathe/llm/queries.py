"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.llm import alignment, decontaminate, exact_dedup, extraction, licenses, line_dedup, mixing, near_dup, ngram_join, prefix_trie, quality, token_files, warc


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_bit_plane_tokens(spark, sf):
    return token_files.encode_documents(spark, table(spark, sf, "documents"), tokenizer_path())


def op2_minhash_join(spark, sf):
    return ngram_join.link_documents(table(spark, sf, "documents")).select(F.col("row.doc_id").alias("doc_id"), "class_id", "copy_id", "n_links")


def op3_license_rules(spark, sf):
    return licenses.scan_licenses(table(spark, sf, "documents"))


def op4_heavy_hitter_dedup(spark, sf):
    return exact_dedup.mark_duplicates(table(spark, sf, "documents"))


def op5_fuzzy_lines(spark, sf):
    return line_dedup.dedup_lines(table(spark, sf, "documents"))


def op6_pfair_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents").select("doc_id", "source")).select(F.col("row.doc_id").alias("doc_id"), "source", "block_no", "slot", "position")


def op7_co_training(spark, sf):
    found = quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.select("row.doc_id", *[F.round(c, 9).alias(c) for c in ("p_content", "p_metadata", "score")], "kept")


def op8_simhash_windows(spark, sf):
    rows = decontaminate.numbered(table(spark, sf, "documents").select("doc_id", "text"))
    hits = decontaminate.contaminated(rows, table(spark, sf, "benchmark"))
    return rows.select("no", "row.doc_id").join(hits, "no").drop("no")


def op9_template_extraction(spark, sf):
    found = extraction.extract_pages(table(spark, sf, "pages"))
    return found.select("row.page_id", "row.url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op10_warc_chunks(spark, sf):
    found = warc.archive_pages(table(spark, sf, "pages"))
    return found.select(F.col("page_key").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


def op11_prefix_trie(spark, sf):
    turns = prefix_trie.ordered_turns(table(spark, sf, "conversations"))
    found = prefix_trie.prefix_trie(prefix_trie.rebuilt(turns))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_token_alignment(spark, sf):
    return alignment.align(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_bbit_minhash(spark, sf):
    return near_dup.near_duplicates(table(spark, sf, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bit_plane_tokens,
        op2_minhash_join,
        op3_license_rules,
        op4_heavy_hitter_dedup,
        op5_fuzzy_lines,
        op6_pfair_mixing,
        op7_co_training,
        op8_simhash_windows,
        op9_template_extraction,
        op10_warc_chunks,
        op11_prefix_trie,
        op12_token_alignment,
        op13_bbit_minhash,
    )
}
