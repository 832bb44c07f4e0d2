import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagelathe.operators import corpus
from pagelathe.plans import knowledge


def placed(*marks, n=1000):
    text = [("x " * n)[i] for i in range(n)]
    for at, word in marks:
        text[at : at + len(word)] = word
        if at:
            text[at - 1] = " "
        text[at + len(word)] = " "
    return "".join(text)


END, TOC, HEAD = "Kaynakça", "İçindekiler", "1. Ünite"


@pytest.mark.parametrize(
    "text, front, end",
    [
        (placed((700, END)), 0, 0),
        (placed((701, END)), 0, 299),
        (placed((300, END), (800, END)), 0, 200),
        (placed((300, END), (600, END)), 0, 0),
        (placed((199, TOC), (299, HEAD)), 299, 0),
        (placed((200, TOC), (250, HEAD)), 0, 0),
        (placed((10, TOC), (300, HEAD)), 0, 0),
        (placed((701, END), (150, TOC), (250, HEAD)), 250, 299),
        ("", 0, 0),
        (placed((0, TOC), (40, "giriş")), 40, 0),
        (placed((0, TOC), (40, "BÖLÜM 1")), 40, 0),
        (placed((0, TOC), (40, "BÖLÜM 12")), 0, 0),
        (placed((800, "EKLE")), 0, 200),
        (placed((800, "EK")), 0, 0),
        (placed((800, "dizini")), 0, 0),
        (placed((800, "dızın")), 0, 200),
        ("😀" + placed((750, END))[1:], 0, 250),
    ],
)
def test_trim(spark, text, front, end):
    row = corpus.trim_boilerplate(spark.createDataFrame([(text,)], "text string")).first()
    assert (row.trimmed_front, row.trimmed_end) == (front, end)
    assert row.text == text[front : len(text) - end]


def test_trim_lexicon_is_a_parameter(spark):
    df = spark.createDataFrame([(placed((800, "Index")),)], "text string")
    assert corpus.trim_boilerplate(df).first().trimmed_end == 0
    assert corpus.trim_boilerplate(df, end=("INDEX",)).first().trimmed_end == 200


def test_assemble(spark):
    pages = [("b", 2, "two"), ("a", 0, "x"), ("b", 0, "zero"), ("b", 1, None), ("b", 10, "ten")]
    df = spark.createDataFrame(pages, "source string, page_no int, text string").repartition(3)
    got = {r.source: r.text for r in corpus.assemble_documents(df).collect()}
    assert got == {"a": "x", "b": "zero\n\ntwo\nten"}
    assert [r.source for r in corpus.in_source_order(corpus.assemble_documents(df)).collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        corpus.require_rows(df.limit(0), "pages")


def test_parts_are_trimmed_as_one(spark):
    whole = placed((150, TOC), (250, HEAD), (701, END))
    lines = [whole[i : i + 37] for i in range(0, len(whole), 37)]
    # Keep words whole: cut only where no marker is hit.
    text = "\n".join(lines)
    if any(w not in text for w in (TOC, HEAD, END)):
        text = whole.replace(" x x x x x ", "\nx x x x x\n")
        lines = text.split("\n")
    df = spark.createDataFrame([("b", i, t) for i, t in enumerate(lines)], "source string, page_no int, text string")
    single = corpus.trim_boilerplate(corpus.assemble_documents(df)).first()
    parts = corpus.trim_parts(df.withColumnRenamed("page_no", "part_no")).orderBy("part_no").collect()
    assert {(r.trimmed_front, r.trimmed_end) for r in parts} == {(single.trimmed_front, single.trimmed_end)}
    assert "".join(r.text for r in parts).replace("\n", "") == single.text.replace("\n", "")


def random_books(seed, books=8, pages=25):
    """Pages with what the rules look for at their edges: hyphens, numbers, blanks, headings, nothing."""
    rng = random.Random(seed)
    bits = ["ab", "Şx", "e-", "12", " 7 ", "\n", "\r\n", "\n\n", " ", "\t", ".", TOC, END, "1 . ÜNİTE", "BİRİNCİ", "Bölüm", "word word", "x\ny", "😀"]
    for b in range(books):
        for p in range(rng.choice([1, 3, pages])):
            text = None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
            yield (None if b == 0 else f"b{b}", p * rng.choice([1, 1, 5]), text)


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_texts_do_not_depend_on_parts(spark, size):
    """Assembled, cleaned and trimmed in parts of any size as in one row; null sources, texts and ties too."""
    pages = spark.createDataFrame(list(random_books(3)), "source string, page_no int, text string")
    joined = lambda df: {r.source: "\n".join(x.text for x in sorted(r.p)) for r in df.groupBy("source").agg(F.collect_list(F.struct("part_no", "text")).alias("p")).collect()}
    texts = lambda df: {r.source: r.text for r in df.collect()}
    whole, parts = corpus.assemble_documents(pages), corpus.assemble_parts(pages, size)
    assert joined(parts) == texts(whole)
    cleaned = corpus.clean_documents(whole)
    assert joined(corpus.clean_documents(parts)) == texts(cleaned)
    trimmed = corpus.trim_parts(corpus.clean_documents(parts))
    assert joined(trimmed.where("in_body")) == texts(corpus.trim_boilerplate(cleaned))
    if size == 1:
        assert parts.count() > 2 * whole.count()


def test_texts_of_parts_stay_where_they_lie(spark, tmp_path):
    """No exchange of the plan that trims parts carries their texts."""
    pages = spark.createDataFrame(list(random_books(3)), "source string, page_no int, text string")
    pages.write.parquet(str(tmp_path / "pages"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = knowledge.body_parts(spark.read.parquet(str(tmp_path / "pages")), 2)
        plan = parts._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan)
    assert moved
    assert not [columns for columns in moved if re.search(r"\btext#", columns)]


def test_no_pages_no_parts(spark):
    none = spark.createDataFrame([], "source string, page_no int, text string")
    assert corpus.trim_parts(corpus.clean_documents(corpus.assemble_parts(none))).count() == 0


CASES = [
    ("aaaa bbbb cccc", 10, 4, ["aaaa bbbb", "cccc"]),
    ("aaaa bbbb cccc", 10, 5, ["aaaa bbbb", "bbbb cccc"]),
    ("abcdefghijkl", 5, 2, ["abcde", "defgh", "ghijk", "jkl"]),
    ("  short ", 50, 5, ["short"]),
    ("", 10, 2, []),
    ("  \n ", 10, 2, []),
    ("one\n\ntwo\n\nthree four five", 10, 0, ["one\n\ntwo", "three", "four five"]),
]


@pytest.mark.parametrize("text, size, overlap, expected", CASES)
def test_recursive(spark, text, size, overlap, expected):
    assert corpus.split_text(text, size, overlap, corpus.SEPARATORS) == expected
    df = spark.createDataFrame([("s", text)], "source string, text string")
    rows = corpus.chunk_documents(df, size, overlap).orderBy("chunk_no").collect()
    assert [(r.source, r.chunk_no, r.text) for r in rows] == [("s", i, t) for i, t in enumerate(expected)]


def test_few_chunks_are_held_at_once():
    texts = pa.array(["word " * 400] * 2_000 + [None, "x" * 5])
    lots = list(corpus._in_lots(texts, lambda t: corpus.split_text(t, 800, 120, corpus.SEPARATORS)))
    assert max(sum(map(len, chunks)) for _, _, chunks in lots) < 2_000_000
    assert sum(len(chunks) for _, _, chunks in lots) == 2_000 * 3 + 1


def brute(text, size, overlap, separators):
    """The packing rule of SURVEY 2.14 step by step, on lists of strings."""
    sep = next(s for s in separators if s == "" or s in text)
    rest = separators[separators.index(sep) + 1 :]
    pieces = list(text) if sep == "" else text.split(sep)
    if sep:
        pieces = [pieces[0]] + [sep + p for p in pieces[1:]]
    out, held = [], []

    def pack(items):
        window = []
        for p in items:
            if sum(map(len, window)) + len(p) > size:
                out.append("".join(window).strip())
                while window and (sum(map(len, window)) > overlap or sum(map(len, window)) + len(p) > size):
                    window.pop(0)
            window.append(p)
        out.append("".join(window).strip())

    for p in filter(None, pieces):
        if len(p) < size:
            held.append(p)
            continue
        pack(held)
        held = []
        out.extend(brute(p, size, overlap, rest) if rest else [p])
    pack(held)
    return [c for c in out if c]


def test_recursive_against_brute_force():
    rng = random.Random(5)
    parts = ["\n\n", "\n", ". ", "! ", "? ", " ", "ab", "cdefg", "ş", "😀", "word", " \n", "..."]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(120)))
        size = rng.randrange(2, 40)
        overlap = rng.randrange(0, size)
        got = corpus.split_text(text, size, overlap, corpus.SEPARATORS)
        assert got == brute(text, size, overlap, list(corpus.SEPARATORS))
        assert all(len(c) <= size for c in got)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 6, 7, 8, 11, 12, 13, 40])
def test_stride_equals_recursive_without_separators(spark, n):
    text = "".join(chr(97 + i % 26) for i in range(n))
    df = spark.createDataFrame([("s", text)], "source string, text string")
    got = [r.text for r in corpus.chunk_by_stride(df, 5, 2).orderBy("chunk_no").collect()]
    assert got == corpus.split_text(text, 5, 2, [""])


def test_chunks_leave_in_lots(spark, monkeypatch):
    """Long texts are handed back piece by piece; other columns keep type and nulls."""
    monkeypatch.setattr(corpus, "LOT_CHARS", 30)
    df = spark.createDataFrame([(1, None, "word " * 40), (None, 2.5, "x")], "a bigint, b double, text string").coalesce(1)
    rows = corpus.chunk_documents(df, 12, 0).collect()
    assert [r.text for r in rows if r.a == 1] == corpus.split_text("word " * 40, 12, 0, corpus.SEPARATORS)
    assert [(r.a, r.b, r.chunk_no, r.text) for r in rows if r.a is None] == [(None, 2.5, 0, "x")]


def test_null_texts(spark):
    df = spark.createDataFrame([("s", None), ("t", "abc")], "source string, text string")
    assert corpus.chunk_documents(df).count() == corpus.chunk_by_stride(df).count() == 1


def test_noise_filter_is_idempotent_and_counted(spark):
    df = spark.createDataFrame([("a" * 200,), ("b",), ("#" * 200,)], "text string")
    kept = corpus.drop_noise(df)
    assert kept.count() == corpus.drop_noise(kept).count() == 1
    assert corpus.drop_noise(df, enabled=False).count() == 3
    assert tuple(corpus.filter_report(corpus.mark_noise(df)).first()) == (3, 1, 2)


def test_chunk_ids_repeat(spark):
    df = spark.createDataFrame([("s", "abcdef " * 50)], "source string, text string")
    ids = lambda parts: sorted(r.chunk_id for r in corpus.with_chunk_id(corpus.chunk_documents(df.repartition(parts), 40, 5), "source", "chunk_no").collect())
    assert ids(1) == ids(7) and len(set(ids(1))) == len(ids(1))
