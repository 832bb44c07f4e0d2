"""Main text of pages by template deduction from equivalence classes.

Over all pages of a host, every element path and every text in its path is a
token with an occurrence vector: how often it stands in which page.  Tokens
with the same vector form an equivalence class (vectors are compared by sums of
hashes, so no page list is ever gathered, however large a host).  Classes that
cover enough pages and hold element tokens are valid; the elements among them
that stand once in a page are the template's skeleton, nested by their paths,
and texts in the same class are the template's own.  What the template does not
fix are slots.  The main text is in the innermost section of the skeleton that
holds most of the text in slots, or in the article around it; without an article,
slots beside that section whose texts are headings or as long as sentences belong
to it too.  A second pass reads these slots from every page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from pagelathe.llm.common import packed, staged
from pagelathe.llm.markup import SECTIONS, spaced, walk

#: Share of a host's pages that a valid class stands in, and that a listed slot does.
SUPPORT, SLOT_SUPPORT = 0.6, 0.2
#: Share of a host's slot text that the main section holds.
MAIN_SHARE = 0.6
#: Mean characters of a slot's texts from which they are sentences, not link names or labels.
SENTENCE = 40
#: Pages of a host from which a text in a class with elements is template text.
FEW_PAGES = 5
HEADING = re.compile("h[1-6]")
#: Tokens that a task gathers before it passes their sums on.
GATHER = 200_000


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def page_tokens(page: str) -> dict[tuple[str, int, bool], list[int]]:
    """(path, text hash or 0, aside) -> [occurrences, characters] of one page."""
    found: dict[tuple[str, int, bool], list[int]] = {}
    pieces: dict[str, tuple[bool, list[str]]] = {}

    def put(path: str, aside: bool, text: str) -> None:
        text = spaced([text])
        if text:
            entry = found.setdefault((path, xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1 | 1, aside), [0, 0])
            entry[0] += 1
            entry[1] += len(text)

    for kind, node, text in walk(page):
        if kind == "open":
            found.setdefault((node.path, 0, node.aside), [0, 0])[0] += 1
        elif kind == "text" and not text.isspace():
            pieces.setdefault(node.path, (node.aside, []))[1].append(text)
        elif kind == "break":
            for path, (aside, texts) in pieces.items():
                put(path, aside, "".join(texts))
            pieces.clear()
    for path, (aside, texts) in pieces.items():
        put(path, aside, "".join(texts))
    return found


def occurrence_sums(pages: DataFrame) -> DataFrame:
    """(host, path, text, aside, pages, times, chars, v1, v2) over pages (no, host, html).

    v1 and v2 add up hashes of (page, times): equal sums are equal vectors.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list[int]] = {}

        def flush() -> pa.RecordBatch:
            keys, values = list(zip(*sums, strict=True)), list(zip(*sums.values(), strict=True))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_()]
            columns = [pa.array(c, k) for c, k in zip(keys, kinds, strict=True)] + [pa.array(c, pa.int64()) for c in values]
            return pa.RecordBatch.from_arrays(columns, ["host", "path", "text", "aside", "pages", "times", "chars", "v1", "v2"])

        for batch in batches:
            for no, host, page in zip(*(batch.column(c).to_pylist() for c in ("no", "host", "html")), strict=True):
                for (path, text, aside), (times, chars) in page_tokens(page).items():
                    h = xxhash.xxh64_intdigest(f"{no}:{times}")
                    entry = sums.setdefault((host, path, text, aside), [0, 0, 0, 0, 0])
                    for i, x in enumerate((1, times, chars, h >> 34, h & 0x3FFFFFFF)):
                        entry[i] += x
                if len(sums) >= GATHER:
                    yield flush()
                    sums.clear()
        if sums:
            yield flush()

    schema = "host string, path string, text bigint, aside boolean, pages bigint, times bigint, chars bigint, v1 bigint, v2 bigint"
    parts = pages.select("no", "host", "html").mapInArrow(gather, schema)
    return parts.groupBy("host", "path", "text", "aside").agg(*[F.sum(c).alias(c) for c in ("pages", "times", "chars", "v1", "v2")])


def _main_sections(skeleton: list[str], slots: list[tuple[str, int, int]]) -> list[str]:
    """Paths under which the main text stands, from (path, characters, texts) of the slots.

    The article around the innermost section with most of the slot text; without
    an article that section, and every slot beside it that holds headings or sentences.
    """
    total = sum(c for _, c, _ in slots)
    if not total:
        return []
    inside = lambda path, of: path == of or path.startswith(of + "/")
    name = lambda path: path.rsplit("/", 1)[1].split(".")[0].split("#")[0]
    held = {s: sum(c for p, c, _ in slots if inside(p, s)) for s in skeleton if name(s) in SECTIONS}
    most = [s for s, c in held.items() if c >= MAIN_SHARE * total]
    if not most:
        return []
    best = max(most, key=lambda s: (s.count("/"), s))
    around = [s for s in held if name(s) in ("article", "main") and inside(best, s)]
    if around:
        return [min(around, key=lambda s: (s.count("/"), s))]
    beside = {p for p, c, n in slots if not inside(p, best) and (c >= SENTENCE * n or HEADING.fullmatch(name(p)))}
    return [best, *sorted(beside)]


@F.arrow_udf(ArrayType(StringType()))
def _choose(skeleton: pa.Array, slots: pa.Array) -> pa.Array:
    chosen = [
        _main_sections(s or [], [(x["path"], x["chars"], x["times"]) for x in t or []])
        for s, t in zip(skeleton.to_pylist(), slots.to_pylist(), strict=True)
    ]
    return pa.array(chosen, pa.list_(pa.string()))


def deduce_templates(pages: DataFrame) -> DataFrame:
    """(host, main, fixed): the paths of the main text and the paths of template texts.

    Only tokens with enough support come together for a host, at most as many as
    a few pages have, never its pages.
    """
    tokens = staged(occurrence_sums(pages), "tokens")
    size = staged(pages.groupBy("host").agg(F.count("*").alias("n")), "hosts")
    # Equivalence classes with at least one element, in enough pages.
    often = tokens.join(size, "host").where(F.col("pages") >= SUPPORT * F.col("n"))
    vector = ["host", "pages", "times", "v1", "v2"]
    classes = often.where("text = 0").select(*vector).distinct()
    valid = often.join(classes, vector, "left_semi")
    skeleton = valid.where("text = 0 AND NOT aside AND times = pages").groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("skeleton"))
    own = valid.where(f"text <> 0 AND NOT aside AND n >= {FEW_PAGES}").groupBy("host", "path").agg(F.sum("chars").alias("own"))
    # A slot is fixed if all its text is the template's.
    slots = tokens.where("text <> 0 AND NOT aside").groupBy("host", "path").agg(F.sum("chars").alias("chars"), F.sum("times").alias("times"))
    slots = slots.join(size, "host").where(F.col("times") >= SLOT_SUPPORT * F.col("n")).join(own, ["host", "path"], "left")
    fixed = F.coalesce(F.col("own") == F.col("chars"), F.lit(False))
    by_host = slots.groupBy("host").agg(
        F.collect_list(F.when(~fixed, F.struct("path", "chars", "times"))).alias("slots"),
        F.sort_array(F.collect_list(F.when(fixed, F.col("path")))).alias("fixed"),
        F.collect_list(F.struct("path", "chars", "times")).alias("every"),
    )
    # Pages that are all alike show no slots: then nothing counts as fixed.
    alike = F.size("slots") == 0
    by_host = by_host.select("host", F.when(alike, F.col("every")).otherwise(F.col("slots")).alias("slots"), F.when(alike, F.array().cast("array<string>")).otherwise(F.col("fixed")).alias("fixed"))
    return staged(by_host.join(skeleton, "host", "left").select("host", _choose("skeleton", "slots").alias("main"), "fixed"), "templates")


def main_text(page: str, main: Sequence[str], fixed: frozenset[str]) -> str:
    """Text of a page under the ``main`` paths, of the whole page if it lacks the first of them."""
    parts: list[list[str]] = [[], []]
    found = False
    for kind, node, text in walk(page):
        if kind == "open":
            found = found or bool(main) and node.path == main[0]
            continue
        inside = any(node.path == m or node.path.startswith(m + "/") for m in main)
        if kind == "break":
            text = " "
        elif node.aside or node.path in fixed:
            continue
        parts[0].append(text)
        if inside or kind == "break":
            parts[1].append(text)
    return spaced(parts[found])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every input row as ``row`` with its host and main text.

    A null page is an empty one and has an empty text; pages without a host in
    their address are pages of one host ''.  Repeated rows count as pages of
    their own.  A page broken off anywhere keeps all text up to there.
    """
    rows = packed(pages).select("row", host_of(F.col("row").getField(url_col).cast("string")).alias("host"), F.coalesce(F.col("row").getField(html_col), F.lit("")).alias("html"))
    # Page numbers only tell pages of one pass apart.
    templates = deduce_templates(rows.select(F.monotonically_increasing_id().alias("no"), "host", "html"))

    @F.arrow_udf("string")
    def extracted(page: pa.Array, main: pa.Array, fixed: pa.Array) -> pa.Array:
        out = (main_text(p.as_py() or "", m or (), frozenset(f or ())) for p, m, f in zip(page, main.to_pylist(), fixed.to_pylist(), strict=True))
        return pa.array(list(out), pa.string())

    return rows.join(templates, "host", "left").select("row", "host", extracted("html", "main", "fixed").alias("text"))
