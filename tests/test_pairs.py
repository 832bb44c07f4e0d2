import pytest
from pyspark.sql import functions as F

from pagelathe.functions import prompts as P
from pagelathe.sources import readers
from pagelathe.operators import pairs

PAIR = "ex_id bigint, en string, tr string"


def made(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], PAIR)


def test_build_examples(spark):
    raw = made(
        spark,
        (None, "merhaba"),
        ("\t\n", "merhaba"),
        (" hello ", "selam "),
        ("abcd", "x" * 10),
        ("abcde", "x" * 10),
        ("x" * 10, "y" * 2000),
        ("x" * 10, "y" * 2001),
    )
    out = pairs.build_examples(raw).orderBy("ex_id").collect()
    assert [r.ex_id for r in out] == [4, 5, 8, 9, 10, 11]
    assert tuple(out[0]) == (4, "English", "Turkish", "hello", "selam")
    assert tuple(out[1]) == (5, "Turkish", "English", "selam", "hello")
    assert pairs.build_examples(raw, both=False).count() == 3


def numbered(spark, n, parts=1):
    return spark.range(n).select(F.col("id").alias("ex_id"), F.lit("t").alias("src")).repartition(parts)


def test_sample(spark):
    few = numbered(spark, 4)
    assert [r.ex_id for r in pairs.sample_cap(few, 4).orderBy("ex_id").collect()] == [0, 1, 2, 3]
    one = {r.ex_id for r in pairs.sample_cap(numbered(spark, 10, 1), 4).collect()}
    seven = {r.ex_id for r in pairs.sample_cap(numbered(spark, 10, 7), 4).collect()}
    assert len(one) == 4 and one == seven and one <= set(range(10))
    assert pairs.sample_cap(few, 0).count() == 0
    assert pairs.sample_cap(few, -1).count() == pairs.sample_cap(few, None).count() == 4
    assert pairs.sample_cap(numbered(spark, 5000, 5), 1234).distinct().count() == 1234
    assert {r.ex_id for r in pairs.sample_cap(numbered(spark, 10), 4, seed=7).collect()} != one


def test_sample_of_copies(spark):
    """A third of the rows share one id; the sample is still of exact size."""
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("ex_id")).repartition(5)
    for n in (1, 299, 300, 450, 899):
        assert pairs.sample_cap(rows, n).count() == n


def test_cap(spark):
    langs = ["English", "Turkish", "English", "Turkish", "English", "German"]
    df = spark.createDataFrame(list(enumerate(langs)), "ex_id bigint, src_lang string").repartition(3)
    kept = pairs.in_direction_order(pairs.cap_per_direction(df, 2))
    assert [(r.src_lang, r.ex_id) for r in kept.collect()] == [("English", 0), ("English", 2), ("Turkish", 1), ("Turkish", 3)]
    assert pairs.cap_per_direction(df, 0).count() == 6
    totals = {tuple(r) for r in pairs.split_counts(df, "src_lang", totals=True).collect()}
    assert totals == {("English", 3), ("Turkish", 2), ("German", 1), (None, 6)}


def test_messages(spark):
    rows = [("hi", "English", "Turkish", "selam"), ("hi", "English", "Turkish", ""), ("hi", "English", "Turkish", None)]
    df = spark.createDataFrame(rows, "src string, src_lang string, tgt_lang string, tgt string")
    got = [r[0] for r in df.select(P.translation_messages("src", "src_lang", "tgt_lang", "tgt")).collect()]
    assert [[m.role for m in r] for r in got] == [["system", "user", "assistant"]] * 2 + [["system", "user"]]
    assert got[0][1].content == "Translate the following text from English to Turkish:\n\nhi"
    assert got[0][2].content == "selam" and got[1][2].content == ""
    text = pairs.training_text(df).first().text
    assert text.endswith("<|im_start|>assistant\nselam<|im_end|>\n")
    prompt = pairs.with_prompt(df, turn_start="[", turn_end="]").first().prompt
    assert prompt == f"[system\n{P.TRANSLATION_SYSTEM}][user\nTranslate the following text from English to Turkish:\n\nhi][assistant\n"


def test_preview(spark):
    df = spark.createDataFrame([(i, "x" * 200, "y", "z") for i in (5, 3, 9, 1)], "ex_id bigint, src string, tgt string, hypothesis string")
    out = pairs.preview(df).collect()
    assert [r.ex_id for r in out] == [1, 3, 5] and len(out[0].src) == 140


@pytest.mark.parametrize("parts", [1, 7])
def test_examples_do_not_depend_on_partitions(spark, parts):
    raw = spark.range(40).select(F.col("id").alias("ex_id"), F.expr("repeat('ab', cast(id as int))").alias("en"), F.lit("abcdef").alias("tr"))
    out = pairs.build_examples(raw.repartition(parts))
    assert sorted(r.ex_id for r in out.collect()) == list(range(6, 80))


def test_samples_of_a_corpus_without_ids_do_not_depend_on_partitions(spark):
    rows = [(f"text {i % 40}", f"metin {i % 40}") for i in range(120)]
    df = spark.createDataFrame(rows, "src string, tgt string")
    one, two = (
        sorted(tuple(r) for r in pairs.sample_cap(readers.with_content_ids(df.repartition(n), "ex_id", "src", "tgt"), 30).collect()) for n in (1, 7)
    )
    assert one == two and len(one) == len({r[2] for r in one}) == 30


def test_content_ids_of_repeats_in_any_layout(spark):
    rows = [("same", None)] * 40 + [(None, "same"), ("a", "b"), ("a", "b"), ("", None)]
    df = spark.createDataFrame(rows, "en string, tr string")
    found = []
    for n in (1, 3, 9):
        got = readers.with_content_ids(df.repartition(n), "ex_id", "en", "tr").collect()
        assert len({r.ex_id for r in got}) == len(rows) and {(r.en, r.tr) for r in got} == set(rows)
        found.append(sorted(r.ex_id for r in got))
    assert found[0] == found[1] == found[2]
    same = [i for i in found[0] if sum(j.startswith(i.split("-")[0]) for j in found[0]) == 40]
    assert sorted(int(i.split("-")[1]) for i in same) == list(range(1, 41))


def test_directions_of_ids_that_are_text(spark):
    df = spark.createDataFrame([("k-1", "one two", "bir iki")], "ex_id string, en string, tr string")
    assert [r.ex_id for r in pairs.expand_directions(df).orderBy("ex_id").collect()] == ["k-1.0", "k-1.1"]
