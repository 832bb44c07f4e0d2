"""Models, sources, sinks and the plans that join them."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pagelathe.operators import exams, models
from pagelathe.plans import knowledge, questions, translation
from pagelathe.sources import readers, writers
from workload import inputs


def lines(path):
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    return [line for f in parts for line in open(os.path.join(path, f), encoding="utf-8").read().splitlines()]


def test_models(spark, tmp_path):
    log = str(tmp_path)

    def load():
        # One file per worker call of load; batch sizes are its content.
        def generate(prompts):
            with open(os.path.join(log, f"{os.getpid()}"), "a") as f:
                f.write(f"{len(prompts)}\n")
            return [f"  {p}!\n" for p in prompts]

        return generate

    df = spark.range(20).coalesce(1).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    out = models.batch_generate(df, load, batch=8)
    assert out.where(F.col("raw").isNotNull()).where(F.length("raw") > 0).count() == 20
    # The filters must not have run the model a second time.
    assert sorted(int(n) for f in os.listdir(log) for n in open(os.path.join(log, f))) == [4, 8, 8]
    assert {r.raw for r in out.where("id < 2").collect()} == {"p0!", "p1!"}
    assert out.select("id").count() == 20

    embedded = models.batch_embed(spark.createDataFrame([("ab",), ("..",)], "embed_text string"), inputs.load_letter_embedder).collect()
    assert abs(sum(x * x for x in embedded[0].embedding) - 1) < 1e-6 and set(embedded[1].embedding) == {0.0}

    scored = models.batch_score(spark.createDataFrame([("ab", "abc", "abcd")], "src string, hypothesis string, tgt string"), inputs.load_length_scorer)
    assert scored.first().seg_score == 0.5
    cut = models.truncate_tokens(spark.createDataFrame([("a  b c",)], "text string"), inputs.load_word_tokenizer, 2)
    assert cut.first().text == "a b"


def test_jsonl(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = [(1, "ş", [("A", "x"), ("C", "y")], None)]
    df = spark.createDataFrame(rows, "qa_id bigint, question string, choices array<struct<letter:string,text:string>>, prediction string")
    writers.write_jsonl(df.withColumns({"subject": F.lit("s"), "answer": F.lit("A")}), path)
    (line,) = lines(path)
    assert json.loads(line) == {"qa_id": 1, "question": "ş", "choices": {"A": "x", "C": "y"}, "prediction": None, "subject": "s", "answer": "A"}
    assert "ş" in line
    back = readers.read_qa(spark, path).first()
    assert [(c.letter, c.text) for c in back.choices] == [("A", "x"), ("C", "y")]
    writers.write_jsonl(df.limit(0), path)
    assert lines(path) == []

    blank = tmp_path / "blank.jsonl"
    blank.write_text('{"key": "a", "score": 1.0}\n\n   \n{"key": "b", "score": 2}\n', encoding="utf-8")
    assert readers.read_jsonl(spark, str(blank), readers.BASELINES).count() == 2
    blank.write_text("{broken\n", encoding="utf-8")
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(blank), readers.BASELINES).collect()


def test_summary_and_baselines(spark, tmp_path):
    path = str(tmp_path / "summary")
    marked = spark.createDataFrame([("A", "A")], "prediction string, answer string")
    writers.write_summary(exams.accuracy(marked, "zero_shot"), path)
    text = "\n".join(lines(path))
    assert text.startswith("{\n") and json.loads(text) == {"mode": "zero_shot", "n": 1, "correct": 1, "accuracy": 1.0, "top_k": None}
    assert readers.read_baselines(spark, str(tmp_path / "none.json")) is None
    scores = tmp_path / "scores.json"
    scores.write_text('{\n "maps_en2tr": 0.79,\n "rag_tr2en": 0.83}', encoding="utf-8")
    assert {r.key: r.score for r in readers.read_baselines(spark, str(scores)).collect()} == {"maps_en2tr": 0.79, "rag_tr2en": 0.83}
    scores.write_text("not json", encoding="utf-8")
    assert readers.read_baselines(spark, str(scores)).count() == 0


def test_exam_source_prunes(spark, tmp_path):
    path = str(tmp_path / "exam")
    rows = [("History", "test", 1), ("History", "dev", 2), ("Physics", "test", 3)]
    spark.createDataFrame(rows, "config string, split string, id bigint").write.partitionBy("config", "split").parquet(path)
    one, every = readers.read_exam(spark, path)
    assert [r.id for r in one.collect()] == [1] and not every
    assert "PartitionFilters: [isnotnull" in one._jdf.queryExecution().executedPlan().toString()
    everything, every = readers.read_exam(spark, path, "All")
    assert sorted(r.id for r in everything.collect()) == [1, 3] and every


def test_translation_job(spark, tmp_path):
    raw = spark.createDataFrame(
        [(s, i, {"en": f"hello world {i}", "tr": f"merhaba dünya {i}"}) for i, s in enumerate(["train"] * 6 + ["validation", "test", "test"])],
        readers.PAIRS,
    )
    writers.write_jsonl(raw, str(tmp_path / "raw"))
    pairs = readers.read_parallel(spark, str(tmp_path / "raw"))
    out = str(tmp_path / "data")
    translation.prepare_examples(pairs, out, train_samples=5)
    assert [len(lines(f"{out}/{s}")) for s in translation.SPLITS] == [5, 2, 4]
    done = translation.predict(spark, f"{out}/test", str(tmp_path / "pred"), inputs.load_letter_generator, limit=1)
    assert sorted(r.src_lang for r in done.collect()) == ["English", "Turkish"]
    report = translation.evaluate(done, inputs.load_length_scorer)
    assert {(r.direction, r.n) for r in report.collect()} == {("en2tr", 1), ("tr2en", 1)}


def test_book_to_answers(spark, tmp_path):
    text = "Osmanlı tarihi uzun bir tarihtir ve çok sayıda olay içerir. " * 40
    pages = spark.createDataFrame([("b", i, text) for i in range(4)] + [("c", 0, "kısa")], readers.PAGES)
    chunks = knowledge.chunks_from_pages(pages)
    assert {r.source for r in chunks.select("source").distinct().collect()} == {"b"}
    assert knowledge.chunks_from_pages(pages, filtered=False).where("source = 'c'").count() == 1
    numbered = pages.withColumn("page_no", F.col("page_no") + 16_382)
    assert {r.text for r in knowledge.chunks_from_pages(numbered).collect()} == {r.text for r in chunks.collect()}
    with pytest.raises(ValueError):
        knowledge.chunks_from_pages(pages.limit(0))
    kb = knowledge.build_knowledge_base(chunks, inputs.load_letter_embedder, str(tmp_path / "kb"))
    assert kb.count() == chunks.count() == kb.select("chunk_id").distinct().count()
    qa = spark.createDataFrame([(1, "Osmanlı tarihi?", "A"), (2, "olay?", "B")], "qa_id bigint, question string, answer string").withColumn(
        "choices", F.array(F.struct(F.lit("A").alias("letter"), F.lit("x").alias("text")), F.struct(F.lit("B").alias("letter"), F.lit("y").alias("text")))
    )
    asked = questions.with_retrieved_context(qa, kb, inputs.load_letter_embedder, k=2)
    details, summary = questions.evaluate_questions(asked, inputs.load_letter_generator, str(tmp_path / "rag"), "rag", 2)
    assert details.where("used_context and context like '[1] %[2] %'").count() == 2
    row = summary.first()
    assert (row.mode, row.n, row.top_k) == ("rag", 2, 2)
    _, plain = questions.evaluate_questions(qa, inputs.load_letter_generator, str(tmp_path / "zs"), "zero_shot")
    assert plain.first().n == 2
