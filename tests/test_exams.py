import pytest
from pyspark.sql import functions as F

from pagelathe.functions import prompts as P
from pagelathe.operators import corpus, exams

LIST = "id bigint, Question string, Subject string, Choices array<string>, Answer string"


def one(spark, schema, *row, **options):
    return exams.normalise_exam(spark.createDataFrame([(1, *row)], f"id bigint, {schema}"), "id", **options).first()


def letters(row):
    return {c.letter: c.text for c in row.choices}


def test_list_with_gaps(spark):
    row = one(spark, LIST[11:], "q", None, ["a", "", None, " c ", "d", "e", "f"], "3")
    assert letters(row) == {"A": "a", "D": "c", "E": "d"}
    # Three choices are kept, so the index is read from 1 and names a gap.
    assert row.answer == "C" and not row.answer_in_choices and row.drop_reason is None


def test_separate_fields(spark):
    row = one(spark, "soru string, choice_a string, `choice b` string, option_c string, cevap string", "q", "x", "y", " ", "b")
    assert letters(row) == {"A": "x", "B": "y"} and row.answer == "B"


def test_bare_letters(spark):
    schema = "question string, A string, B string, choiceC string, answer string"
    assert one(spark, schema, "q", "x", "y", "z", "A").drop_reason == "too_few_choices"
    assert letters(one(spark, schema, "q", "x", "y", "z", "A", bare_letters=True)) == {"A": "x", "B": "y", "C": "z"}


def test_list_column_null_falls_to_fields(spark):
    row = one(spark, "question string, choices array<string>, choice_a string, choice_b string, answer string", "q", None, "x", "y", "0")
    assert letters(row) == {"A": "x", "B": "y"} and row.answer == "A"


def test_too_few_and_missing(spark):
    assert one(spark, LIST[11:], "q", None, ["a"], "A").drop_reason == "too_few_choices"
    # The first alias that exists counts, even when it is null.
    both = one(spark, "question string, soru string, choices array<string>, answer string", None, "x", ["a", "b"], "A")
    assert both.drop_reason == "no_question_or_answer"
    assert one(spark, "choices array<string>, answer string", ["a", "b"], "A").drop_reason == "no_question_or_answer"


@pytest.mark.parametrize(
    "answer, n, expected",
    [("0", 5, "A"), ("1", 5, "B"), ("4", 5, "E"), ("5", 5, "E"), ("6", 5, None), ("4", 4, "D")]
    + [("B) x", 5, "B"), ("Doğru: B", 5, "D"), ("Z", 5, None), ("-1", 5, None), ("1.0", 5, None), ("true", 5, "E")]
    + [("99999999999999999999", 5, None), (" c ", 5, "C"), ("٢", 5, "C")],
)
def test_answers(spark, answer, n, expected):
    assert one(spark, LIST[11:], "q", None, list("vwxyz")[:n], answer).answer == expected


def test_answer_types(spark):
    assert one(spark, "question string, choices array<string>, answer int", "q", ["a", "b"], 1).answer == "B"
    assert one(spark, "question string, choices array<string>, answer boolean", "q", ["a", "b"], True).answer == "E"


@pytest.mark.parametrize("given, expected", [(None, "History"), ("", "History"), ("  ", ""), (" Tarih ", "Tarih")])
def test_subject(spark, given, expected):
    assert one(spark, LIST[11:], "q", given, ["a", "b"], "A").subject == expected


def test_subject_filter(spark):
    given = [(None, None), ("TARIH", None), ("Fizik", "other_subject"), (" history", None)]
    for subject, reason in given:
        assert one(spark, LIST[11:], "q", subject, ["a", "b"], "A", subject_filter=True).drop_reason == reason


def test_report(spark):
    df = spark.createDataFrame([(1, "q", "", ["a", "b"], "A"), (2, None, "", ["a", "b"], "A"), (3, "q", "", ["a"], "A")], LIST)
    marked = exams.normalise_exam(df, "id")
    assert tuple(corpus.filter_report(marked).first()) == (3, 1, 2)
    assert exams.valid_items(marked).count() == 1


def choices():
    return F.array(*[F.struct(F.lit(a).alias("letter"), F.lit(b).alias("text")) for a, b in (("A", "x"), ("C", "y"))])


def test_prompts(spark):
    df = spark.createDataFrame([("s?", None), ("s?", ""), ("s?", "[1] k")], "question string, context string").withColumn("choices", choices())
    assert df.select(P.format_choices("choices")).first()[0] == "A) x\nC) y"
    got = [r[0] for r in df.select(P.qa_messages("question", "choices", "context")).collect()]
    assert got[0] == got[1] and got[0][0].content == P.QA_SYSTEM
    assert got[0][1].content == "Soru: s?\n\nA) x\nC) y\n\nCevap (sadece harf):"
    assert got[2][0].content == P.QA_CONTEXT_SYSTEM
    assert got[2][1].content == "Bağlam:\n[1] k\n\nSoru: s?\n\nA) x\nC) y\n\nCevap (sadece harf):"


def test_accuracy(spark):
    df = spark.createDataFrame([("A", "A"), ("xyz", "A"), ("C", "B")], "raw string, answer string")
    marked = exams.mark_answers(df)
    assert [r.correct for r in marked.collect()] == [True, False, False]
    row = exams.accuracy(marked, "rag", 5).first()
    assert (row.mode, row.n, row.correct, round(row.accuracy, 4), row.top_k) == ("rag", 3, 1, 0.3333, 5)
    assert tuple(exams.accuracy(marked.limit(0), "zero_shot").first()) == ("zero_shot", 0, 0, 0.0, None)


def test_compare(spark):
    rows = [("zero_shot", 4, 1, 0.25, None), ("rag", 4, 3, 0.75, 5)]
    both = exams.compare_modes(spark.createDataFrame(rows, "mode string, n bigint, correct bigint, accuracy double, top_k int")).first()
    assert (both.zero_shot_correct, both.rag_correct, both.top_k, both.delta_pp) == (1, 3, 5, 50.0)
