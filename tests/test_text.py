
import pytest
from pyspark.sql import functions as F

from pagelathe.functions import text as X
from pagelathe.operators import corpus


def test_strip_knows_every_space(values):
    spaces = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
    assert values(X.strip("c"), f"{spaces}a b{spaces}", spaces, " hello ", "x\x1c") == ["a b", "", "hello", "x"]


def test_space_class_equals_python(values):
    every = [chr(c) for c in range(0x3100)]
    found = values(F.rlike("c", F.lit(rf"(?U)^[{X.SPACE_CLASS}]$")), *every)
    assert [c for c, f in zip(every, found) if f] == [c for c in every if c.isspace()]


def test_text_chars_agree_with_isalnum(values):
    every = [chr(c) for c in range(0x20, 0x600)]
    found = values(F.rlike("c", F.lit(r"^[\p{L}\p{N}]$")), *every)
    assert [c for c, f in zip(every, found) if f != c.isalnum()] == []


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Os-\nmanlı", "Osmanlı"),
        ("x-\nşy", "xşy"),
        ("a\r\nb", "a\nb"),
        ("x\n 12 \ny", "x\n\ny"),
        ("a\n\n7\n\nb", "a\n\nb"),
        ("x\n12345\ny", "x\n12345\ny"),
        ("a\n\n\n\nb", "a\n\nb"),
        ("a \t b", "a b"),
        ("x-\n y", "x-\n y"),
        ("  a 　", "a"),
        ("a\n٣٤\nb", "a\n\nb"),
        ("12", ""),
    ],
)
def test_clean(values, given, expected):
    assert values(X.clean_text("c"), given) == [expected]


def test_clean_whole_column_and_in_steps(spark, values):
    """Several rules at once; both forms agree."""
    cases = [
        ("a-\nb -\n c\r\n 1 \n\n\n 22\x1c\n333\n\n\n\nx\t\t y  \n4\n5\n 6 \n7 8\n", "ab -\n c\n\nx y \n\n7 8"),
        ("\n9", ""),
        ("q\n\n\n10\n\n\n", "q"),
        ("é-\né 1\n2", "éé 1"),
    ]
    given, expected = zip(*cases, strict=True)
    assert values(X.clean_text("c"), *given) == list(expected)
    df = spark.createDataFrame(list(enumerate(given)), "i int, text string")
    assert [r.text for r in corpus.clean_documents(df).orderBy("i").collect()] == list(expected)


def test_noise(values):
    a150 = "a" * 150
    given = [
        "a" * 149,
        a150,
        a150 + " ... 1",
        a150 + " ... 1 ... 2",
        "a" * 90 + "#" * 60,
        "a" * 89 + "#" * 61,
        " " * 10 + "a" * 140 + " " * 10,
        "",
    ]
    assert values(X.noise_reason("c"), *given) == ["short", None, None, "dot_leaders", None, "symbols", "short", "short"]


def test_direction(spark):
    rows = [("English", "Turkish"), ("german", "FRENCH"), ("TURKISH", "english")]
    df = spark.createDataFrame(rows, "s string, t string")
    assert [r[0] for r in df.select(X.direction("s", "t")).collect()] == ["en2tr", "ge2fr", "tr2en"]


def test_first_letter(values):
    given = ["B", "b.", "Cevap: B", "The answer is D", "xyz", "", None]
    assert values(X.first_letter("c"), *given) == ["B", "B", "C", "E", None, None, None]
    assert values(X.first_letter("c", strict=True), *given) == ["B", "B", "B", "D", None, None, None]


def test_prefix(values):
    assert values(X.remove_prefix("c"), "passage: foo", "passage: passage: z", "bar") == ["foo", "passage: z", "bar"]
    assert values(X.add_prefix("c"), "foo") == ["passage: foo"]


def test_truncate_words(values):
    assert values(X.truncate_words("c", 2), " a b  c", "a", "") == ["a b", "a", ""]


def test_format_score(spark):
    df = spark.createDataFrame([(0.65, 0.05), (None, None), (1.0, -0.01256)], "v double, d double")
    shown = df.select(X.format_score("v"), X.format_score("d", signed=True), X.format_score("d", digits=2, signed=True)).collect()
    assert [tuple(r) for r in shown] == [("0.6500", "+0.0500", "+0.05"), ("—", "—", "—"), ("1.0000", "-0.0126", "-0.01")]


def test_foreign_digits(values):
    assert values(X.ascii_digits("c"), "٢", "１2", "x") == ["2", "12", "x"]
