"""Books to chunks: assemble pages, clean, trim, cut, filter."""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelathe.functions.text import (
    CLEANING,
    CONTENTS_HEADINGS,
    END_HEADINGS,
    heading_after_contents,
    heading_pattern,
    last_word_after,
    noise_reason,
    strip,
    word_pattern,
)
from pagelathe.operators.ordered import whole_quotient, with_running
from pagelathe.session import in_buckets, scratch_folder

# Sizes of chunks, where to cut, from paragraphs down to single
# characters, and the shares of a text in which headings count.
CHUNK_SIZE = 800
CHUNK_OVERLAP = 120
SEPARATORS = ("\n\n", "\n", ". ", "! ", "? ", " ", "")
TAIL_SHARE = 0.70
CONTENTS_SHARE = 0.20
HEADING_SHARE = 0.30
# Pages of one part of a source, and the block of pages without a number.
PAGES_PER_PART = 64
NO_PAGE = -(1 << 62)
# Blocks of one lot, and the columns that name a lot: the source, null ones too, and its number.
BLOCKS_PER_LOT = 16
LOT = ("_key", "_lot")
# Text up to the first line end between two letters.
PART_END = r"(?s)^(.*?\p{L}\r*)\n(?=\p{L})"
# Characters of chunks handed back to Spark at once.
LOT_CHARS = 1_000_000


def assemble_documents(pages: DataFrame) -> DataFrame:
    """``source, text``: page texts of a source joined by newlines, in page order.

    A source is one row however many pages it has, as every later rule (joined
    words, page numbers, headings, chunks) reads across pages.
    """
    gathered = F.sort_array(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text"))))
    return pages.groupBy("source").agg(gathered.alias("_pages")).select("source", F.array_join(F.col("_pages.text"), "\n").alias("text"))


def assemble_parts(pages: DataFrame, pages_per_part: int = PAGES_PER_PART) -> DataFrame:
    """``source, part_no, text``: the same texts in parts of about ``pages_per_part`` pages.

    The parts of a source joined by newlines are its ``assemble_documents`` text.
    Parts meet only at a line end between two letters, across which no rule of
    cleaning or trimming reads: a joined word needs a hyphen before the line end,
    a page number a digit, a blank run a second line end, a chapter heading a
    full stop or a digit.  So ``clean_documents`` of the parts are the parts of
    the clean text.  A block of pages without such a line end stays with the part
    before it.  Part numbers ascend, with gaps.
    """
    return lots_of_parts(pages, pages_per_part).drop(*LOT)


def lots_of_parts(pages: DataFrame, pages_per_part: int = PAGES_PER_PART) -> DataFrame:
    """``assemble_parts`` with the columns ``LOT``, by which its rows lie together.

    A lot is a row of neighbouring blocks.  All texts move into their lots once
    and stay in the buckets these are written to; only what the first blocks of
    a lot add to a part of an earlier lot moves again.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_key")
    block_of = lambda page_no: F.coalesce(whole_quotient(page_no.cast("bigint"), pages_per_part), F.lit(NO_PAGE))
    lot_of = lambda block: whole_quotient(block, BLOCKS_PER_LOT)
    page = F.struct("page_no", F.coalesce("text", F.lit("")).alias("text"))
    gathered = pages.groupBy(key, lot_of(block_of(F.col("page_no"))).alias("_lot")).agg(
        F.first("source").alias("source"), F.sort_array(F.collect_list(page)).alias("_pages")
    )
    own = lambda n: F.transform(F.filter("_pages", lambda p: block_of(p["page_no"]) == n), lambda p: p["text"])
    numbers = F.array_distinct(F.transform("_pages", lambda p: block_of(p["page_no"])))
    blocks = gathered.withColumn("_blocks", F.transform(numbers, lambda n: F.struct(n.alias("no"), F.array_join(own(n), "\n").alias("text"))))
    head = lambda b: F.length(F.regexp_extract(b["text"], PART_END, 1))
    # Written with the place of the cuts, so that the steps between read no text.
    marked = blocks.withColumn("_blocks", F.transform("_blocks", lambda b: F.struct(b["no"].alias("no"), b["text"].alias("text"), head(b).alias("head"))))
    opens = F.transform(F.filter("_blocks", lambda b: b["head"] > 0), lambda b: b["no"])
    lots = in_buckets(marked.select("source", *LOT, "_blocks", F.col("_blocks")[0]["no"].alias("_low"), opens.alias("_opens")), "lots", *LOT)

    small = lots.select(*LOT, "_low", F.array_max("_opens").alias("_last"))
    firsts = small.groupBy("_key").agg(F.min("_low").alias("_first"))
    running = with_running(small, ["_key"], "_lot", F.col("_last"), "_before", "max")
    placed = running.join(firsts, "_key").select(*LOT, "_first", F.coalesce("_before", "_first").alias("_owner"))

    def pieces(b: Column) -> Column:
        owner = F.coalesce(F.array_max(F.filter("_opens", lambda n: n < b["no"])), F.col("_owner"))
        piece = lambda part, text: F.struct(part.alias("part_no"), b["no"].alias("no"), text.alias("text"))
        halves = F.array(piece(owner, F.left(b["text"], b["head"])), piece(b["no"], F.substr(b["text"], b["head"] + 2)))
        return F.when((b["no"] == F.col("_first")) | (b["head"] == 0), F.array(piece(owner, b["text"]))).otherwise(halves)

    cut = F.flatten(F.transform("_blocks", pieces))
    # The first lot of a source has no pieces of other lots.
    late = lots.join(placed.where(lot_of(F.col("_first")) != F.col("_lot")), [*LOT])
    gone = late.select("_key", F.inline_outer(F.filter(cut, lambda p: lot_of(p["part_no"]) != F.col("_lot")))).where("part_no IS NOT NULL")
    moved = gone.groupBy("_key", lot_of(F.col("part_no")).alias("_lot")).agg(F.collect_list(F.struct("part_no", "no", "text")).alias("_moved"))
    kept = F.filter(cut, lambda p: lot_of(p["part_no"]) == F.col("_lot"))
    held = lots.join(placed, [*LOT]).join(moved, [*LOT], "left").withColumn("_pieces", F.sort_array(F.concat(kept, F.coalesce("_moved", F.array()))))
    text = lambda n: F.array_join(F.transform(F.filter("_pieces", lambda p: p["part_no"] == n), lambda p: p["text"]), "\n")
    parts = F.transform(F.array_distinct(F.transform("_pieces", lambda p: p["part_no"])), lambda n: F.struct(n.alias("part_no"), text(n).alias("text")))
    return held.select("source", *LOT, F.inline_outer(parts)).where("part_no IS NOT NULL").select("source", "part_no", "text", *LOT)


def in_source_order(df: DataFrame) -> DataFrame:
    return df.orderBy("source")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no {what} found")
    return df


def clean_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """``clean_text`` in steps, each skipped for texts it cannot change."""
    for pattern, replacement, signs in CLEANING:
        changed = F.regexp_replace(text, pattern, replacement)
        if signs:
            present = reduce(or_, [F.contains(F.col(text), F.lit(s)) for s in signs])
            changed = F.when(present, changed).otherwise(F.col(text))
        df = df.withColumn(text, changed)
    return df.withColumn(text, strip(text))


def trim_boilerplate(
    df: DataFrame,
    text: str = "text",
    end: Sequence[str] = END_HEADINGS,
    contents: Sequence[str] = CONTENTS_HEADINGS,
    heading: str | None = None,
) -> DataFrame:
    """Cut the back matter and the table of contents of each text.

    The tail goes from the last end heading if that lies past 70 % of the
    text; the front goes up to the first chapter heading if the contents
    heading lies in the first 20 % and the chapter before 30 %.  Both shares
    refer to the length before any cut.  Adds ``trimmed_front``/``trimmed_end``.
    """
    share = lambda part: F.floor(F.lit(part) * F.col("_n")).cast("int")
    measured = df.withColumn("_n", F.length(text)).withColumn("_cut", last_word_after(text, share(TAIL_SHARE), end))
    body = measured.withColumn("_body", F.when(F.col("_cut").isNull(), F.col(text)).otherwise(F.left(text, "_cut")))
    toc, start = heading_after_contents("_body", share(CONTENTS_SHARE), contents, heading)
    found = body.withColumns({"_toc": toc, "_start": start})
    skip = (
        (F.col("_start") > 0)
        & (F.col("_toc") < F.lit(CONTENTS_SHARE) * F.col("_n"))
        & (F.col("_start") < F.lit(HEADING_SHARE) * F.col("_n"))
    )
    return (
        found.withColumn("trimmed_front", F.when(skip, F.col("_start")).otherwise(0))
        .withColumn("trimmed_end", F.coalesce(F.col("_n") - F.col("_cut"), F.lit(0)))
        .withColumn(text, F.when(F.col("trimmed_front") > 0, F.substr("_body", F.col("trimmed_front") + 1)).otherwise(F.col("_body")))
        .drop("_n", "_cut", "_body", "_toc", "_start")
    )


def trim_parts(
    df: DataFrame,
    source: str = "source",
    part: str = "part_no",
    text: str = "text",
    end: Sequence[str] = END_HEADINGS,
    contents: Sequence[str] = CONTENTS_HEADINGS,
    heading: str | None = None,
    beside: Sequence[str] = (),
) -> DataFrame:
    """``trim_boilerplate`` for documents that span several rows.

    Each part is written once with the places of its own headings.  Only those
    few numbers are added up and compared per source; the texts are read once
    more and cut at offsets joined back to them by part.  Parts that lie wholly
    in a trimmed end become empty; ``in_body`` tells them from parts that meet
    the body, whose texts joined by newlines are the trimmed text.

    ``beside`` are columns without nulls by which the rows lie together already
    (few parts have the same): the texts then stay where they are, and the
    offsets come to them.
    """
    spark = df.sparkSession
    toc_word, chapter = word_pattern(contents), heading or heading_pattern()
    before = lambda pattern: F.length(F.regexp_extract(text, rf"(?s)^(.*?)(?:{pattern})", 1))
    has = lambda pattern: F.rlike(F.col(text), F.lit(pattern))
    facts = {
        "_len": F.length(text).cast("bigint"),
        "_end": F.coalesce(last_word_after(text, F.lit(0), end), F.when(has(f"^(?:{word_pattern(end)})"), 0)),
        "_toc": F.when(has(toc_word), before(toc_word)),
        "_head": F.when(has(chapter), before(chapter)),
        "_after": F.nullif(heading_after_contents(text, F.length(text), contents, chapter)[1], F.lit(0)),
    }
    path = f"{scratch_folder(spark)}/parts-{uuid.uuid4().hex}"
    marked = df.withColumn(text, F.coalesce(text, F.lit(""))).withColumns(facts)
    if beside:
        parts = in_buckets(marked, "parts", *beside)
    else:
        marked.write.parquet(path)
        parts = spark.read.schema(marked.schema).parquet(path)
    # Parts are joined by one newline, hence the extra character per part.
    small = parts.select(F.col(source).alias("_s"), F.col(part).alias("_p"), *beside, *facts)
    running = with_running(small, ["_s"], "_p", F.col("_len") + 1, "_at").withColumn("_at", F.coalesce("_at", F.lit(0)))
    # A few numbers a part, read three times below.
    running.write.parquet(f"{path}-placed")
    placed = spark.read.schema(running.schema).parquet(f"{path}-placed")
    toc_at = F.struct("_p", (F.col("_at") + F.col("_toc")).alias("at"))
    per_source = placed.groupBy(F.col("_s").alias("_of")).agg(
        F.max(F.col("_at") + F.col("_len")).alias("_n"),
        F.max(F.col("_at") + F.col("_end")).alias("_tail"),
        F.min(F.when(F.col("_toc").isNotNull(), toc_at)).alias("_opens"),
    )
    known = placed.join(per_source, F.col("_s").eqNullSafe(F.col("_of"))).drop("_of")
    after = F.when(F.col("_p") == F.col("_opens")["_p"], F.col("_after")).when(F.col("_p") > F.col("_opens")["_p"], F.col("_head"))
    starts = known.where(after.isNotNull()).groupBy(F.col("_s").alias("_of")).agg(F.min(F.col("_at") + after).alias("_start"))
    started = known.join(starts, F.col("_s").eqNullSafe(F.col("_of")), "left")
    cut = F.when(F.col("_tail") > F.lit(TAIL_SHARE) * F.col("_n"), F.col("_tail")).otherwise(F.col("_n"))
    skip = (
        (F.col("_opens")["at"] < F.lit(CONTENTS_SHARE) * F.col("_n"))
        & (F.col("_start") < F.lit(HEADING_SHARE) * F.col("_n"))
        & (F.col("_start") < cut)
    )
    front = F.when(skip, F.col("_start")).otherwise(0)
    bounds = started.select("_s", "_p", *beside, "_at", "_n", cut.alias("_cut"), front.alias("_front"))
    if beside:
        found = bounds.groupBy(*beside).agg(F.collect_list(F.struct("_s", "_p", "_at", "_n", "_cut", "_front")).alias("_bounds"))
        own = F.filter("_bounds", lambda b: b["_s"].eqNullSafe(F.col(source)) & b["_p"].eqNullSafe(F.col(part)))
        placed_parts = parts.join(found, [*beside]).withColumn("_own", own[0]).select("*", "_own.*")
    else:
        placed_parts = parts.join(bounds, F.col(source).eqNullSafe(F.col("_s")) & F.col(part).eqNullSafe(F.col("_p")))
    lo = F.greatest(F.col("_front") - F.col("_at"), F.lit(0))
    hi = F.least(F.col("_cut") - F.col("_at"), F.col("_len"))
    return (
        placed_parts.withColumn(text, F.when(hi > lo, F.substr(text, (lo + 1).cast("int"), (hi - lo).cast("int"))).otherwise(""))
        .withColumn("in_body", (F.col("_at") <= F.col("_cut")) & (F.col("_at") + F.col("_len") >= F.col("_front")))
        .withColumn("trimmed_front", F.col("_front").cast("bigint"))
        .withColumn("trimmed_end", (F.col("_n") - F.col("_cut")).cast("bigint"))
        .select(*df.columns, "in_body", "trimmed_front", "trimmed_end")
    )


def split_text(text: str, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    """Chunks of one text: cut at the coarsest separator present, pack pieces
    up to ``size`` characters, carry at most ``overlap`` into the next chunk."""
    return list(_chunks(text, 0, len(text), size, overlap, tuple(separators)))


def _chunks(text: str, lo: int, hi: int, size: int, overlap: int, separators: tuple[str, ...]) -> Iterator[str]:
    level = next((i for i, s in enumerate(separators) if s == "" or text.find(s, lo, hi) >= 0), len(separators) - 1)
    finer = separators[level + 1 :] if separators[level] else ()
    edges = _edges(text, lo, hi, separators[level])
    if isinstance(edges, range) and size > 1:
        yield from _pack(text, edges, size, overlap)
        return
    run = [edges[0]]
    for left, right in zip(edges, edges[1:]):
        if right - left < size:
            run.append(right)
            continue
        yield from _pack(text, run, size, overlap)
        if finer:
            yield from _chunks(text, left, right, size, overlap, finer)
        else:
            yield text[left:right]
        run = [right]
    yield from _pack(text, run, size, overlap)


def _edges(text: str, lo: int, hi: int, separator: str) -> Sequence[int]:
    """Offsets that bound the pieces; each separator opens the piece after it."""
    if separator == "":
        return range(lo, hi + 1)
    edges = [lo]
    at = text.find(separator, lo, hi)
    while at >= 0:
        if at > lo:
            edges.append(at)
        at = text.find(separator, at + len(separator), hi)
    if hi > edges[-1]:
        edges.append(hi)
    return edges


def _pack(text: str, edges: Sequence[int], size: int, overlap: int) -> Iterator[str]:
    """Chunks of adjacent pieces given by their edges, which ascend.

    A chunk ends at the last edge within ``size``; the next starts at the first
    edge that carries at most ``overlap`` and leaves room for one more piece.
    """
    first, final = 0, len(edges) - 1
    while True:
        last = bisect_right(edges, edges[first] + size, first) - 1
        chunk = text[edges[first] : edges[last]].strip()
        if chunk:
            yield chunk
        if last == final:
            return
        least = max(edges[last] - overlap, edges[last + 1] - size)
        first = min(bisect_left(edges, least, first), last)


def chunk_documents(
    df: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
    text: str = "text",
) -> DataFrame:
    """Overlapping chunks that prefer paragraph, line, sentence and word ends.

    Rows stay in their partition; the other columns are carried along.
    """
    if overlap > size:
        raise ValueError("overlap must not exceed size")
    keep = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*keep, T.StructField("chunk_no", T.LongType()), T.StructField("text", T.StringType())])
    names = schema.names

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, number, chunk in _in_lots(batch.column(text), lambda t: _chunks(t, 0, len(t), size, overlap, tuple(separators))):
                carried = [batch.column(f.name).take(pa.array(origin)) for f in keep]
                yield pa.RecordBatch.from_arrays([*carried, pa.array(number, pa.int64()), pa.array(chunk, pa.string())], names)

    return df.mapInArrow(cut, schema)


def _in_lots(texts: pa.Array, split) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """Row, number and chunk of every text, handed on before a lot grows large."""
    lot, chars = ([], [], []), 0
    for row, text in enumerate(texts):
        for number, chunk in enumerate(split(text.as_py() or "")):
            for column, value in zip(lot, (row, number, chunk)):
                column.append(value)
            chars += len(chunk)
            if chars >= LOT_CHARS:
                yield lot
                lot, chars = ([], [], []), 0
    if lot[0]:
        yield lot


def chunk_by_stride(df: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, text: str = "text") -> DataFrame:
    """Fixed windows of ``size`` characters every ``size - overlap``, all in the JVM.

    The text is cut once into strides, and a window is one stride plus the
    head of the next, so the cost grows with the text, not its square.
    """
    stride = size - overlap
    if stride <= 0 or overlap > stride:
        raise ValueError("overlap must be at most half of size")
    keep = [F.col(c) for c in df.columns if c != text]
    blocks = df.select(*keep, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0)).alias("_b"))
    # A last stride no longer than the overlap is already in the window before it.
    count = F.size("_b")
    spare = (count > 1) & (F.length(F.get("_b", count - 1)) <= overlap)
    windows = F.zip_with(
        F.slice("_b", F.lit(1), F.greatest(count - F.when(spare, 1).otherwise(0), F.lit(0))),
        F.slice("_b", F.lit(2), F.greatest(count - 1, F.lit(0))),
        lambda own, following: strip(F.concat(own, F.substring(F.coalesce(following, F.lit("")), 1, overlap))),
    )
    # The outer form keeps the optimizer from testing the array in a filter of
    # its own, which would evaluate every expression behind it a second time.
    cut = blocks.select(*[c for c in df.columns if c != text], F.posexplode_outer(windows).alias("chunk_no", "text"))
    return cut.withColumn("chunk_no", F.col("chunk_no").cast("bigint")).where(F.col("text") != "")


def with_chunk_id(df: DataFrame, *keys: str) -> DataFrame:
    """Chunk id of 128 bits from its place (source, number), the same in every run."""
    return df.withColumn("chunk_id", F.md5(F.to_json(F.struct(*keys)).cast("binary")))


def mark_noise(df: DataFrame, min_chars: int = 150, max_ratio: float = 0.40, text: str = "text") -> DataFrame:
    return df.withColumn("drop_reason", noise_reason(text, min_chars, max_ratio))


def drop_noise(df: DataFrame, enabled: bool = True, **limits) -> DataFrame:
    return mark_noise(df, **limits).where(F.col("drop_reason").isNull()).drop("drop_reason") if enabled else df


def filter_report(df: DataFrame, *keys: str) -> DataFrame:
    """Rows before, kept and dropped from a ``drop_reason`` column, in one pass."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_before"),
        F.count_if(F.col("drop_reason").isNull()).alias("n_after"),
        F.count("drop_reason").alias("n_dropped"),
    )


def drop_reasons(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count("*").alias("n"))
