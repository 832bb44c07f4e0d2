"""Books to a table of embedded chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelathe.functions.text import PASSAGE_PREFIX, add_prefix
from pagelathe.operators.corpus import (
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    LOT,
    PAGES_PER_PART,
    assemble_documents,
    chunk_by_stride,
    chunk_documents,
    clean_documents,
    drop_noise,
    lots_of_parts,
    require_rows,
    trim_boilerplate,
    trim_parts,
    with_chunk_id,
)
from pagelathe.operators.models import EMBED_BATCH, Load, batch_embed, spread
from pagelathe.sources.writers import write_kb


def chunks_from_documents(
    documents: DataFrame,
    keys: tuple[str, ...] = ("source",),
    filtered: bool = True,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    native: bool = False,
) -> DataFrame:
    """Clean, trim, cut and filter whole texts: one stage without a shuffle."""
    cleaned = clean_documents(documents.select(*keys, "text"))
    body = trim_boilerplate(cleaned).select(*keys, "text") if filtered else cleaned
    return _cut(body, keys, filtered, size, overlap, native)


def chunks_from_pages(
    pages: DataFrame, filtered: bool = True, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, native: bool = False
) -> DataFrame:
    """As above from book pages; stops if there are none."""
    documents = assemble_documents(require_rows(pages, "pages"))
    return chunks_from_documents(documents, ("source",), filtered, size, overlap, native)


def body_parts(pages: DataFrame, pages_per_part: int = PAGES_PER_PART) -> DataFrame:
    """``source, part_no, text``: clean and trimmed books of any length, no book in one row.

    Joined by newlines in order, the parts of a source are the text that
    ``chunks_from_pages`` cuts.
    """
    parts = lots_of_parts(require_rows(pages, "pages"), pages_per_part)
    return trim_parts(clean_documents(parts), beside=LOT).where("in_body").select("source", "part_no", "text")


def _cut(body: DataFrame, keys: tuple[str, ...], filtered: bool, size: int, overlap: int, native: bool) -> DataFrame:
    cut = chunk_by_stride if native else chunk_documents
    kept = drop_noise(cut(body, size, overlap), filtered)
    return with_chunk_id(kept, *keys, "chunk_no").withColumn("embed_text", add_prefix("text", PASSAGE_PREFIX))


def build_knowledge_base(chunks: DataFrame, load: Load, out: str, batch: int = EMBED_BATCH) -> DataFrame:
    """Embed the chunks, spread evenly over the tasks first, and write the table."""
    write_kb(batch_embed(spread(chunks, "chunk_id"), load, batch=batch), out)
    return chunks.sparkSession.read.parquet(out)
