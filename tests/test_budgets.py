"""Token budgets, score files, rows in the order of their files."""

import random

import pytest
from pyspark.sql import functions as F

from pagelathe.operators import models, pairs
from pagelathe.plans import translation
from pagelathe.sources import readers, writers

EXAMPLES = "ex_id bigint, src_lang string, tgt_lang string, src string, tgt string"


def load_letters():
    return (lambda texts: [list(t) for t in texts]), (lambda rows: ["".join(r) for r in rows])


def dealt(lengths, room):
    """One token after the other to the text that has the fewest and can take one."""
    kept = [0] * len(lengths)
    for _ in range(room):
        open_ = [i for i in range(len(lengths)) if kept[i] < lengths[i]]
        if not open_:
            break
        kept[min(open_, key=lambda i: (kept[i], -lengths[i], -i))] += 1
    return kept


def test_texts_share_the_room(spark):
    rng = random.Random(2)
    texts = [("x" * rng.randrange(14), "y" * rng.randrange(14)) for _ in range(300)] + [("", ""), ("x" * 14, "y" * 14)]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "i int, a string, b string")
    for budget in (0, 3, 4, 15, 40):
        got = {r.i: (r.a, r.b) for r in models.fit_tokens(df, load_letters, budget, ["a", "b"], F.lit("fff")).collect()}
        for i, (a, b) in enumerate(texts):
            n, m = dealt([len(a), len(b)], max(budget - 3, 0))
            assert got[i] == (a[:n], b[:m])


def test_nulls_stay_and_nothing_fails_on_no_rows(spark):
    df = spark.createDataFrame([(None, "y" * 9), ("x", None)], "a string, b string")
    rows = models.fit_tokens(df, load_letters, 5, ["a", "b"]).collect()
    assert sorted(map(tuple, rows), key=str) == [("x", None), (None, "yyyyy")]
    assert models.fit_tokens(df.limit(0), load_letters, 5, ["a", "b"]).count() == 0


def load_few():
    """A tokenizer that refuses more than a few megabytes of text at once."""

    def encode(texts):
        if sum(map(len, texts)) > 2_000_000:
            raise MemoryError("too many texts at once")
        return [list(t) for t in texts]

    return encode, lambda rows: ["".join(r) for r in rows]


def test_tokens_of_few_texts_are_held_at_once(spark):
    df = spark.range(0, 3000, 1, 1).select("id", *[F.repeat(F.lit(c), 1000).alias(c) for c in "ab"], F.lit(None).cast("string").alias("c"))
    for cut in (models.fit_tokens(df, load_few, 10, ["a", "b", "c"]), models.truncate_tokens(df, load_few, 5, "a").withColumn("b", F.left("b", F.lit(5)))):
        assert [tuple(r) for r in cut.groupBy("a", "b", "c").count().collect()] == [("aaaaa", "bbbbb", None, 3000)]


def test_only_the_source_of_a_prompt_is_cut(spark):
    df = spark.createDataFrame([(0, "English", "Turkish", "s" * 500, "t")], EXAMPLES)
    bare = len(pairs.with_prompt(df.withColumn("src", F.lit(""))).first().prompt)
    cut = pairs.with_prompt(df, (load_letters, bare + 7)).first()
    whole = pairs.with_prompt(df).first()
    assert cut.prompt == whole.prompt.replace("s" * 500, "s" * 7) and cut.src == "s" * 500


def test_jobs_keep_their_budgets(spark, tmp_path):
    """Training texts are cut, test examples stay whole, and prompts of the test keep the budget."""
    raw = spark.createDataFrame([(s, i, "e" * 900, "t" * 900) for s in translation.SPLITS for i in range(3)], "split string, ex_id bigint, en string, tr string")
    translation.prepare_examples(raw, str(tmp_path), tokenizer=load_letters)
    read = lambda split: readers.read_jsonl(spark, f"{tmp_path}/{split}", readers.EXAMPLES)
    text = pairs.training_text(read("train")).select(F.max(F.length("text"))).first()[0]
    assert text == translation.TRAIN_TOKENS and read("test").select(F.min(F.length("src"))).first()[0] == 900
    found = translation.predict(spark, f"{tmp_path}/test", f"{tmp_path}/out", lambda: lambda ps: [str(len(p)) for p in ps], tokenizer=load_letters, max_tokens=600)
    assert {r.hypothesis for r in found.collect()} == {"600"} and found.count() == 6


def test_score_file(spark, tmp_path):
    ours = spark.createDataFrame([("tr2en", 0.5, 4), ("en2tr", None, 0)], "direction string, score double, n bigint")
    old = spark.createDataFrame([("maps_en2tr", 0.25)], "key string, score double")
    writers.write_scores(ours, f"{tmp_path}/s", old)
    assert spark.read.text(f"{tmp_path}/s", wholetext=True).first()[0].strip() == (
        '{"en2tr":null,"en2tr_n":0,"tr2en":0.5,"tr2en_n":4,"_baseline_hw2":{"maps_en2tr":0.25}}'
    )
    scores, baselines = readers.read_scores(spark, f"{tmp_path}/s")
    assert sorted(map(tuple, scores.collect())) == [("en2tr", None, 0), ("tr2en", 0.5, 4)]
    assert [tuple(r) for r in baselines.collect()] == [("maps_en2tr", 0.25)]
    writers.write_scores(ours.limit(0), f"{tmp_path}/none")
    scores, baselines = readers.read_scores(spark, f"{tmp_path}/none")
    assert scores.count() == baselines.count() == 0


@pytest.mark.parametrize("swap", [False, True])
def test_order_of_files_is_seen(spark, tmp_path, swap):
    df = spark.createDataFrame([(i, str(i)) for i in random.Random(1).sample(range(400), 400)], "i int, text string")
    writers.write_in_order(df.repartition(6), f"{tmp_path}/w", ["i"])
    rows = readers.read_in_order(spark, f"{tmp_path}/w")
    assert all(r.position == r.i + 1 and r.in_order for r in rows.collect())
    if swap:
        rows.drop("in_order").repartitionByRange(3, F.desc("position")).write.json(f"{tmp_path}/bad")
        assert not all(r.in_order for r in readers.read_in_order(spark, f"{tmp_path}/bad").collect())
