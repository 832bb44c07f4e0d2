"""The driver tables in the shapes the operators expect.

Whole tables and whole texts; what the tables lack (gaps, padding, headings,
action lines) is added by an expression over the row's own id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.operators.ordered import whole_quotient
from pagelathe.sources.readers import spread

NBSP = "\u00a0"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table; the text ones are dealt out to all cores if their files are few."""
    rows = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(rows) if name == "documents" else rows


def by_remainder(key: str, n: int, cases: dict[int, Column | str | None], otherwise: Column) -> Column:
    """CASE key % n WHEN ... END."""
    out = otherwise
    for r, value in cases.items():
        out = F.when(F.col(key) % n == r, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def raw_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring documents as the two sides of a pair, with padded, blank and null sides."""
    # Grouping moves the rows anyway, so they are not dealt out first.
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    padded = F.concat(F.lit("\t "), F.col("text"), F.lit(NBSP))
    side = by_remainder("doc_id", 13, {0: None}, by_remainder("doc_id", 11, {0: " \n\t"}, padded))
    pair = whole_quotient(F.col("doc_id"), 2)
    odd = F.col("doc_id") % 2 == 1
    pairs = docs.select("doc_id", pair.alias("ex_id"), side.alias("side")).groupBy("ex_id").agg(
        F.first(F.when(~odd, F.col("side")), ignorenulls=True).alias("en"),
        F.first(F.when(odd, F.col("side")), ignorenulls=True).alias("tr"),
    )
    return pairs.withColumn("split", by_remainder("ex_id", 10, {0: "validation", 1: "test"}, F.lit("train")))


def noisy_documents(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        by_remainder(
            "doc_id",
            3,
            {
                0: F.replace(text, F.lit("en"), F.lit("e-\r\nn")),
                1: F.replace(text, F.lit(". "), F.lit(".\n\n\n\n 12 \n\n")),
            },
            F.replace(text, F.lit(" "), F.lit(" \t ")),
        ).alias("text"),
    )


def headed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with contents, chapter and end headings in and out of the guarded places."""
    text = F.col("text")
    half, tenth = (whole_quotient(F.length(text), n).cast("int") for n in (2, 10))
    front = F.concat(F.lit("İçindekiler "), F.left(text, tenth), F.lit("\n1 . Ünite\n"), text)
    back = F.concat(F.lit("\nKaynakça\n"), F.left(text, tenth))
    middle = F.concat(F.left(text, half), F.lit(" DİZİN "), F.substr(text, half + 1))
    late = F.concat(text, F.lit(" içindekiler GİRİŞ "), text)
    cases = {0: text, 1: F.concat(text, back), 2: front, 3: F.concat(front, back), 4: middle}
    return table(spark, sf, "documents").select("doc_id", by_remainder("doc_id", 6, cases, late).alias("text"))


def document_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Each line of a document as a page; empty lines as pages without text."""
    docs = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("page_no", "line"))
    return docs.select(
        F.concat(F.lit("book-"), F.col("doc_id").cast("string")).alias("source"), "page_no", F.nullif("line", F.lit("")).alias("text")
    )


def book_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Twelve words a line and a line a page, with broken words, page numbers, gaps and headings between."""
    words = F.regexp_replace("text", r"((?:[^ \n]+ ){12})", "$1\n")
    noisy = by_remainder(
        "doc_id",
        3,
        {0: F.replace(words, F.lit(" \n"), F.lit("\n")), 1: F.replace(words, F.lit("en"), F.lit("e-\r\nn"))},
        F.replace(words, F.lit(" \n"), F.lit("\n 12 \n\n\n")),
    )
    docs = headed_documents(spark, sf).select("doc_id", noisy.alias("text"))
    pages = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("page_no", "text"))
    return pages.select(F.concat(F.lit("book-"), F.col("doc_id").cast("string")).alias("source"), "page_no", "text")


def _exam_parts(spark: SparkSession, sf: str) -> dict[str, Column]:
    word = lambda i: F.get(F.split("text", " ", 6), F.lit(i))
    options = [
        word(0),
        by_remainder("doc_id", 3, {0: ""}, word(1)),
        F.concat(F.lit(" "), word(2), F.lit(" ")),
        by_remainder("doc_id", 5, {0: None}, word(3)),
        by_remainder("doc_id", 4, {0: None, 1: None}, word(4)),
    ]
    subject = by_remainder("doc_id", 5, {0: None, 1: "", 2: "  ", 3: " Tarih "}, F.lit("Fizik"))
    answers = {0: " b) x", 1: "1", 2: "5", 3: "Doğru: B", 4: "Z", 5: None, 6: "٢"}
    return {
        "options": options,
        "subject": subject,
        "answer": by_remainder("doc_id", 8, answers, F.lit("4")),
        "question": by_remainder("doc_id", 17, {0: None}, F.col("text")),
    }


def exam_list(spark: SparkSession, sf: str) -> DataFrame:
    p = _exam_parts(spark, sf)
    choices = F.array(*p["options"], F.lit("sixth"))
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        p["question"].alias("Question"),
        p["subject"].alias("Subject"),
        choices.alias("Choices"),
        p["answer"].alias("Answer"),
    )


def exam_fields(spark: SparkSession, sf: str) -> DataFrame:
    p = _exam_parts(spark, sf)
    fields = [o.alias(f"choice_{letter}") for letter, o in zip("abcde", p["options"])]
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), p["question"].alias("soru"), p["subject"].alias("konu"), *fields, p["answer"].alias("cevap")
    )


def benchmark_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark passages as questions with their first words as choices."""
    words = F.split("text", " ", 6)
    choices = F.array(*[F.struct(F.lit(c).alias("letter"), F.get(words, F.lit(i)).alias("text")) for i, c in enumerate("ABCDE")])
    answer = F.substr(F.lit("ABCDE"), (F.col("item_id") % 5 + 1).cast("int"), F.lit(1))
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("qa_id"), F.col("text").alias("question"), choices.alias("choices"), answer.alias("answer")
    )


def training_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a log: views carry a loss, errors an evaluation loss."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        (F.col("user_id") % 10).cast("string").alias("run_id"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") * 25).alias("step"),
        F.when(kind == "view", F.col("value")).alias("loss"),
        F.when(kind == "error", F.col("value")).alias("eval_loss"),
    )


def agent_trace(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations whose assistant turns end in action lines."""
    tool = F.when(F.col("conv_id") % 2 == 0, "turkish_rag_search").otherwise("wikipedia_search")
    query = F.concat(F.lit("\nAction: "), tool, F.lit("(c"), F.col("conv_id").cast("string"), F.lit(" (t"), F.col("turn").cast("string"), F.lit("))"))
    finish = F.concat(F.lit("\n Action: finish(answer "), F.col("conv_id").cast("string"), F.lit(") "))
    lines = (
        F.when((F.col("conv_id") % 3 == 0) & (F.col("turn") == 3), finish)
        .when(F.col("turn") == 7, F.concat(query, finish))
        .when(F.col("conv_id") % 3 == 1, F.concat(query, query))
        .otherwise(query)
    )
    text = F.when(F.col("role") == "assistant", F.concat("text", lines)).otherwise(F.col("text"))
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", text.alias("text"))


def exchanges(spark: SparkSession, sf: str) -> DataFrame:
    """Each user turn with the assistant turn right after it, if there is one."""
    turns = table(spark, sf, "conversations")
    replies = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    return turns.where(F.col("role") == "user").select("conv_id", "turn", "text").join(replies, ["conv_id", "turn"], "left")


# Stand-ins for models: cheap, deterministic, and expressible in SQL.
ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def load_letter_embedder():
    def embed(texts):
        rows = [np.bincount(np.frombuffer(t.lower().encode(), dtype=np.uint8), minlength=256) for t in texts]
        return np.array(rows, dtype=np.float64)[:, [ord(c) for c in ALPHABET]]

    return embed


def load_letter_generator():
    def generate(prompts):
        return [f" {'ABCDE'[len(p) % 5]}) " for p in prompts]

    return generate


def load_length_scorer():
    def score(triples):
        return [min(len(s), len(h)) / max(len(r), len(h), 1) for s, h, r in triples]

    return score


def load_word_tokenizer():
    def encode(texts):
        return [t.split() for t in texts]

    def decode(rows):
        return [" ".join(r) for r in rows]

    return encode, decode
