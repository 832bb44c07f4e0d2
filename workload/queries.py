"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.functions import text as X
from pagelathe.functions.prompts import format_choices, qa_messages, render_chat
from pagelathe.operators import agents, corpus, exams, models, ordered, pairs, retrieval, scores
from pagelathe.plans import knowledge, questions
from pagelathe.session import scratch_folder
from pagelathe.sources import readers, writers
from workload import inputs
from workload.inputs import table


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Pairs


def examples(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.build_examples(inputs.raw_pairs(spark, sf))


def pairs_clean(spark, sf):
    return examples(spark, sf)


def pairs_one_direction(spark, sf):
    return pairs.build_examples(inputs.raw_pairs(spark, sf), both=False)


def pairs_sample(spark, sf):
    return pairs.sample_cap(examples(spark, sf), 150)


def pairs_cap(spark, sf):
    return pairs.with_direction(pairs.cap_per_direction(examples(spark, sf), 100)).select("direction", "ex_id", "src")


def pairs_counts(spark, sf):
    counted = pairs.split_counts(pairs.with_direction(examples(spark, sf)), "split", "direction", totals=True)
    return counted.select(F.coalesce("split", F.lit("all")).alias("split"), F.coalesce("direction", F.lit("all")).alias("direction"), "n")


def pairs_preview(spark, sf):
    return pairs.preview(examples(spark, sf).drop("split"))


def chat_text(spark, sf):
    talk = inputs.exchanges(spark, sf).select(
        F.lit("English").alias("src_lang"), F.lit("Turkish").alias("tgt_lang"), F.col("text").alias("src"), F.col("reply").alias("tgt")
    )
    return pairs.training_text(talk)


def chat_prompt(spark, sf):
    return pairs.with_prompt(examples(spark, sf)).select("ex_id", "prompt")


# Corpus


def doc_assemble(spark, sf):
    return corpus.assemble_documents(inputs.document_pages(spark, sf)).select("source", "text")


def doc_clean(spark, sf):
    return corpus.clean_documents(inputs.noisy_documents(spark, sf))


def doc_trim(spark, sf):
    return _longs(corpus.trim_boilerplate(inputs.headed_documents(spark, sf)), "trimmed_front", "trimmed_end")


def doc_trim_parts(spark, sf):
    """Documents spread over rows of one page each, trimmed as wholes."""
    pages = inputs.headed_documents(spark, sf).select(
        F.col("doc_id").alias("source"), F.posexplode(F.split("text", "\n")).alias("part_no", "text")
    )
    trimmed = corpus.trim_parts(pages)
    return trimmed.groupBy(F.col("source").alias("doc_id")).agg(
        F.sum(F.length("text").cast("bigint")).alias("kept_chars"),
        F.max("trimmed_front").alias("trimmed_front"),
        F.max("trimmed_end").alias("trimmed_end"),
    )


def doc_body_parts(spark, sf):
    """Books of noisy, headed pages cleaned and trimmed in parts, joined again for the comparison."""
    parts = knowledge.body_parts(inputs.book_pages(spark, sf), pages_per_part=4)
    joined = F.array_join(F.sort_array(F.collect_list(F.struct("part_no", "text")))["text"], "\n")
    return parts.groupBy("source").agg(joined.alias("text"))


def chunk_stride(spark, sf):
    return corpus.chunk_by_stride(table(spark, sf, "documents").select("doc_id", "text"))


def chunk_recursive(spark, sf):
    return corpus.chunk_documents(table(spark, sf, "documents").select("doc_id", "text"))


def chunk_noisy(spark, sf):
    """Exact chunks of texts with blank runs, tabs and broken words, as they are."""
    return corpus.chunk_documents(inputs.noisy_documents(spark, sf))


def chunk_headed(spark, sf):
    """Exact chunks of texts with headings, after the trim."""
    return corpus.chunk_documents(corpus.trim_boilerplate(inputs.headed_documents(spark, sf)).select("doc_id", "text"))


def _noisy_chunks(spark, sf):
    chunks = corpus.chunk_by_stride(table(spark, sf, "documents").select("doc_id", "lang", "text"))
    swapped = F.translate("text", "enatir", "#%*=+~")
    leaders = F.concat("text", F.lit(" ..... 12 and .... 13"))
    kind = (F.col("doc_id") + F.col("chunk_no")) % 4
    return corpus.mark_noise(chunks.withColumn("text", F.when(kind == 1, swapped).when(kind == 2, leaders).otherwise(F.col("text"))))


def chunk_noise(spark, sf):
    return _noisy_chunks(spark, sf).select("doc_id", "chunk_no", "drop_reason")


def noise_report(spark, sf):
    return corpus.filter_report(_noisy_chunks(spark, sf), "lang")


def noise_reasons(spark, sf):
    return corpus.drop_reasons(_noisy_chunks(spark, sf))


def kept_chunks_per_language(spark, sf):
    """Clean, trim, cut, drop noise, count: the corpus path end to end."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    chunks = knowledge.chunks_from_documents(docs, ("doc_id", "lang"))
    return chunks.groupBy("lang").agg(F.count("*").alias("n_chunks"), F.sum(F.length("text").cast("bigint")).alias("n_chars"))


def _book_chunks(spark, sf):
    return knowledge.chunks_from_pages(inputs.document_pages(spark, sf))


def book_chunks(spark, sf):
    return _book_chunks(spark, sf).select("source", "chunk_no", "text")


# Questions


def _shown(normalised: DataFrame) -> DataFrame:
    return normalised.withColumn("choices", format_choices("choices"))


def qa_normalise_list(spark, sf):
    return _shown(exams.valid_items(exams.normalise_exam(inputs.exam_list(spark, sf), "id")))


def qa_normalise_fields(spark, sf):
    return _shown(exams.valid_items(exams.normalise_exam(inputs.exam_fields(spark, sf), "id", subject_filter=True)))


def qa_drop_reasons(spark, sf):
    return corpus.drop_reasons(exams.normalise_exam(inputs.exam_fields(spark, sf), "id", subject_filter=True))


def _marked(spark, sf):
    talk = table(spark, sf, "conversations").where(F.col("role") != "system")
    answer = F.substr(F.lit("ABCDE"), (F.col("conv_id") % 5 + 1).cast("int"), F.lit(1))
    mode = F.when(F.col("role") == "user", "zero_shot").otherwise("rag")
    return exams.mark_answers(talk.select(mode.alias("mode"), "conv_id", "turn", F.col("text").alias("raw"), answer.alias("answer")))


def qa_marks(spark, sf):
    return _marked(spark, sf).select("conv_id", "turn", "mode", "answer", "prediction", "correct")


def qa_strict_letters(spark, sf):
    return exams.mark_answers(table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("raw"), F.lit("A").alias("answer")), strict=True).select("conv_id", "turn", "prediction")


def qa_accuracy(spark, sf):
    return _rounded(exams.accuracy_by(_marked(spark, sf), "mode"), "accuracy")


def mode_compare(spark, sf):
    per_mode = exams.accuracy_by(_marked(spark, sf), "mode").withColumn("top_k", F.when(F.col("mode") == "rag", 5).cast("bigint"))
    compared = _rounded(exams.compare_modes(per_mode), "zero_shot_accuracy", "rag_accuracy", "delta_pp")
    return compared.withColumn("delta_text", X.format_score("delta_pp", digits=2, signed=True))


# Retrieval


def knn_topk(spark, sf):
    vectors = table(spark, sf, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("qa_id"), "embedding")
    base = vectors.select(F.col("vec_id").alias("chunk_id"), "embedding")
    return _longs(_rounded(retrieval.knn_topk(asked, base), "distance"), "rank")


def knn_blocked(spark, sf):
    """The same neighbours with more questions than one block holds."""
    vectors = table(spark, sf, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("qa_id"), "embedding")
    base = vectors.select(F.col("vec_id").alias("chunk_id"), "embedding")
    return _longs(_rounded(retrieval.knn_topk(asked, base, max_cells=16_000), "distance"), "rank")


def articles_topk(spark, sf):
    """Articles are the documents that the embeddings table has vectors of."""
    vectors = table(spark, sf, "embeddings")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("article_id"), "text")
    articles = vectors.select(F.col("vec_id").alias("article_id"), "embedding").join(docs, "article_id")
    found = retrieval.retrieve_articles(vectors.select(F.col("vec_id").alias("qa_id"), "embedding"), articles)
    return _longs(_rounded(found, "distance"), "rank").select("qa_id", "rank", "article_id", "distance", "text")


def _document_kb(spark, sf):
    """Documents as a stored knowledge base: searched and read back without cutting them again."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    kept = corpus.drop_noise(corpus.chunk_documents(docs))
    # Readable ids for the SQL twin; chunks_from_documents hashes them instead.
    numbered = kept.withColumn("chunk_id", F.col("doc_id") * (1 << 32) + F.col("chunk_no"))
    chunks = numbered.withColumn("embed_text", X.add_prefix("text"))
    return knowledge.build_knowledge_base(chunks, inputs.load_letter_embedder, _folder(spark, "kb"))


def rag_context(spark, sf):
    asked = questions.with_retrieved_context(inputs.benchmark_questions(spark, sf), _document_kb(spark, sf), inputs.load_letter_embedder)
    return asked.select("qa_id", "context")


def rag_prompts(spark, sf):
    """Prompts of all questions; those with an odd id have no context and fall back to zero-shot."""
    asked = inputs.benchmark_questions(spark, sf)
    even = asked.where(F.col("qa_id") % 2 == 0).select("qa_id", F.concat(F.lit("[1] "), "question").alias("context"))
    prompted = questions.with_qa_prompt(retrieval.attach_context(asked, even))
    return prompted.select("qa_id", "prompt", "used_context")


def rag_answers(spark, sf):
    """Retrieve, prompt, generate, parse and mark with stand-in models."""
    asked = questions.with_retrieved_context(inputs.benchmark_questions(spark, sf), _document_kb(spark, sf), inputs.load_letter_embedder)
    answered = questions.answer_questions(questions.with_qa_prompt(asked), inputs.load_letter_generator)
    return answered.select("qa_id", "raw", "prediction", "correct")


def zero_shot_accuracy(spark, sf):
    answered = questions.answer_questions(
        questions.with_qa_prompt(inputs.benchmark_questions(spark, sf)), inputs.load_letter_generator
    )
    return _rounded(exams.accuracy(answered, "zero_shot"), "accuracy").drop("top_k")


# Scores and logs


def _scored(spark, sf):
    predicted = examples(spark, sf).withColumn("hypothesis", F.col("src"))
    return models.batch_score(predicted, inputs.load_length_scorer)


def direction_scores(spark, sf):
    return _rounded(scores.direction_scores(_scored(spark, sf)), "score")


def _baselines(spark, sf):
    rates = table(spark, sf, "labels").agg(F.avg("quality").alias("q"), F.avg("toxic").alias("t"))
    rows = [("maps_en2tr", "q"), ("zero_shot_tr2en", "t"), ("rag_en2tr", "t"), ("rag_tr2en", "q")]
    return rates.select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.col(c).alias("score")) for k, c in rows])))


def score_compare(spark, sf):
    compared = scores.attach_baselines(scores.direction_scores(_scored(spark, sf)), _baselines(spark, sf))
    return _rounded(compared, "score", "zero_shot", "maps", "rag", "delta")


def score_table(spark, sf):
    return scores.comparison_table(scores.attach_baselines(scores.direction_scores(_scored(spark, sf)), _baselines(spark, sf)))


def train_summary(spark, sf):
    return scores.training_summary(inputs.training_log(spark, sf))


def eval_curve(spark, sf):
    return _rounded(scores.eval_curve(inputs.training_log(spark, sf), tol=0.5), "change")


def early_stop(spark, sf):
    return scores.early_stop(inputs.training_log(spark, sf), patience=5, tol=6.0)


def loss_plateaus(spark, sf):
    return _rounded(scores.plateaus(inputs.training_log(spark, sf), patience=5, tol=6.0), "spread")


# Models


def model_generate(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("prompt"))
    return models.batch_generate(docs, inputs.load_letter_generator).drop("prompt")


def model_embed(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", X.add_prefix("text").alias("embed_text"))
    embedded = models.batch_embed(docs, inputs.load_letter_embedder)
    return embedded.select("doc_id", F.posexplode("embedding").alias("dim", "value")).select(
        "doc_id", F.col("dim").cast("bigint").alias("dim"), F.round(F.col("value").cast("double"), 5).alias("value")
    )


def model_score(spark, sf):
    return _rounded(_scored(spark, sf).select("ex_id", "seg_score"), "seg_score")


def truncate_tokens(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return models.truncate_tokens(docs, inputs.load_word_tokenizer, 512)


def truncate_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.truncate_words("text", 512).alias("text"))


def prompt_budget(spark, sf):
    """Prompts of whole documents with the source cut to a budget of word tokens."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("ex_id"), F.lit("English").alias("src_lang"), F.lit("Turkish").alias("tgt_lang"), F.col("text").alias("src")
    )
    fitted = pairs.with_prompt(docs, budget=(inputs.load_word_tokenizer, 96))
    return fitted.select("ex_id", "prompt")


def training_budget(spark, sf):
    """Examples whose source and target share a budget of word tokens."""
    talk = examples(spark, sf).select("ex_id", "src_lang", "tgt_lang", "src", "tgt")
    return pairs.fit_examples(talk, inputs.load_word_tokenizer, 96)


def batch_rows(spark, sf):
    batches = ordered.batch_rows(table(spark, sf, "documents").select("doc_id", "lang"), 8, "doc_id")
    ids = F.array_join(F.transform("rows", lambda r: r["doc_id"].cast("string")), ",")
    return batches.select("batch_no", "n_rows", ids.alias("doc_ids"))


# Agent tables


GRAMS = 1000


def language_profiles(spark, sf):
    return agents.fit_language_profiles(table(spark, sf, "documents"), GRAMS)


def _detected(spark, sf):
    return agents.detect_language(table(spark, sf, "documents"), language_profiles(spark, sf), fallback="lang")


def lang_detect(spark, sf):
    return _rounded(_detected(spark, sf), "confidence").select("doc_id", "detected", "confidence", "lang")


def lang_route(spark, sf):
    found = _detected(spark, sf)
    # The tables hold no Turkish; German stands in for it.
    routed = agents.route(found.withColumn("lang", F.when(F.col("lang") == "de", "tr").otherwise(F.col("lang"))))
    return routed.groupBy("tool", "lang").agg(F.count("*").alias("n"))


def trace_actions(spark, sf):
    return agents.parse_actions(inputs.agent_trace(spark, sf))


def trace_guard(spark, sf):
    return agents.round_guard(agents.parse_actions(inputs.agent_trace(spark, sf)))


def trace_guard_segmented(spark, sf):
    """The same with conversations cut every two turns."""
    return agents.round_guard(agents.parse_actions(inputs.agent_trace(spark, sf)), width=2)


def trace_answer(spark, sf):
    return agents.final_answer(agents.parse_actions(inputs.agent_trace(spark, sf)))


def _verdicts(spark, sf):
    text = F.col("text")
    said = inputs.by_remainder("turn", 4, {0: " OK\n", 1: F.concat(F.lit("REVISE: "), text), 2: "ok then"}, F.concat(F.lit("REVISE:"), text))
    return agents.parse_verdict(table(spark, sf, "conversations").select("conv_id", "turn", said.alias("text")))


def verdicts(spark, sf):
    return _verdicts(spark, sf).drop("text")


def allowed_revisions(spark, sf):
    return agents.allowed_revisions(_verdicts(spark, sf)).select("conv_id", "turn", "reason")


def abstain_rate(spark, sf):
    talk = table(spark, sf, "conversations")
    kind = (F.col("conv_id") + F.col("turn")) % 5
    said = F.when(kind == 0, agents.ABSTENTIONS[0] + "\n").when(kind == 1, agents.ABSTENTIONS[1]).otherwise(F.col("text"))
    return _rounded(agents.abstention_rate(agents.mark_abstentions(talk.select("role", said.alias("text"))), "role"), "rate")


def lang_match(spark, sf):
    profiles = _folder(spark, "profiles")
    language_profiles(spark, sf).write.parquet(profiles)
    known = spark.read.parquet(profiles)
    talk = inputs.exchanges(spark, sf).where(F.col("reply").isNotNull()).select("conv_id", "turn", "text", "reply")
    asked = agents.detect_language(talk, known).withColumnRenamed("detected", "question_lang").drop("confidence", "lang")
    both = agents.detect_language(asked, known, "reply").withColumnRenamed("detected", "answer_lang")
    return agents.language_match(both).select("conv_id", "turn", "question_lang", "answer_lang", "same_language")


def vote(spark, sf):
    talk = table(spark, sf, "conversations").select(F.col("conv_id").alias("qa_id"), X.first_letter("text", strict=True).alias("answer"))
    return agents.majority_vote(talk)


# Sources and sinks


def io_examples(spark, sf):
    """Nested pairs written and read back, expanded, written as JSON lines and read back."""
    raw = inputs.raw_pairs(spark, sf).select("split", "ex_id", F.struct("en", "tr").alias("translation"))
    home = _folder(spark, "pairs")
    writers.write_jsonl(raw, f"{home}/raw")
    writers.write_jsonl(pairs.build_examples(readers.read_parallel(spark, f"{home}/raw")).drop("split"), f"{home}/examples")
    return readers.read_jsonl(spark, f"{home}/examples", readers.EXAMPLES)


def io_without_ids(spark, sf):
    """Pairs in files without ids, some repeated: content ids, both directions, sample and cap."""
    raw = inputs.raw_pairs(spark, sf)
    home = _folder(spark, "bare")
    rows = raw.unionByName(raw.where(F.col("ex_id") % 3 == 0)).select("split", F.struct("en", "tr").alias("translation"))
    writers.write_jsonl(rows, home)
    examples = pairs.build_examples(readers.read_parallel(spark, home, own_ids=False)).drop("split")
    return pairs.cap_per_direction(pairs.sample_cap(examples, 150), 40)


def io_exam(spark, sf):
    """Exam rows laid out by subject and split; one subject read back and normalised."""
    home = _folder(spark, "exam")
    rows = inputs.exam_fields(spark, sf).withColumn("config", F.when(F.col("id") % 2 == 0, "History").otherwise("Geography"))
    rows.withColumn("split", F.when(F.col("id") % 4 < 2, "test").otherwise("dev")).write.partitionBy("config", "split").parquet(home)
    read, every = readers.read_exam(spark, home, "History", "test")
    items = exams.valid_items(exams.normalise_exam(read, "id", subject_filter=every))
    writers.write_jsonl(items.drop("answer_in_choices"), f"{home}-items")
    return readers.read_qa(spark, f"{home}-items").withColumn("choices", format_choices("choices"))


def io_summary(spark, sf):
    home = _folder(spark, "summary")
    writers.write_summary(exams.accuracy(_marked(spark, sf), "all"), home)
    text = spark.read.text(home, wholetext=True)
    return text.select(F.from_json("value", "mode string, n bigint, correct bigint").alias("s")).select("s.*")


def io_knowledge_base(spark, sf):
    """Chunks embedded, written as the chunk table and read back."""
    home = _folder(spark, "kb")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    chunks = knowledge.chunks_from_documents(docs, ("doc_id",))
    kb = knowledge.build_knowledge_base(chunks, inputs.load_letter_embedder, home)
    return kb.select("doc_id", "chunk_no", "text", "embed_text", F.size("embedding").cast("bigint").alias("dims"))


def io_scores(spark, sf):
    """Scores with their baselines as one wide object, written, read back and compared."""
    home = _folder(spark, "scores")
    writers.write_scores(scores.direction_scores(_scored(spark, sf)), home, _baselines(spark, sf))
    found, baselines = readers.read_scores(spark, home)
    return _rounded(scores.attach_baselines(found, baselines), "score", "zero_shot", "maps", "rag", "delta")


def io_direction_order(spark, sf):
    """Predictions in direction order: positions of the rows, and whether the files hold them in that order."""
    home = _folder(spark, "ordered")
    known = examples(spark, sf).select("ex_id", "src_lang", "src")
    writers.write_in_order(pairs.direction_place(known), home, ["_place", "ex_id"])
    rows = readers.read_in_order(spark, home)
    return rows.select("ex_id", "src_lang", "position", "in_order")


def io_source_order(spark, sf):
    """Assembled sources in the order of their names, written and read back with positions."""
    home = _folder(spark, "sources")
    writers.write_in_order(corpus.assemble_documents(inputs.document_pages(spark, sf)), home, ["source"])
    return readers.read_in_order(spark, home).select("source", "position", "in_order", F.length("text").cast("bigint").alias("n_chars"))


def io_blank_lines(spark, sf):
    """One object per line with empty and blank lines between, read as if there were none."""
    home = _folder(spark, "blank")
    line = F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"})
    blanks = F.when(F.col("turn") % 2 == 0, F.lit("\n\n")).otherwise(F.lit("\n \t\n"))
    table(spark, sf, "conversations").select(F.concat(blanks, line, F.lit("\n")).alias("value")).write.text(home)
    return readers.read_jsonl(spark, home, readers.TRACE)


QUERIES = {
    f.__name__: f
    for f in (
        kept_chunks_per_language,
        pairs_clean,
        pairs_one_direction,
        pairs_sample,
        pairs_cap,
        pairs_counts,
        pairs_preview,
        chat_text,
        chat_prompt,
        doc_assemble,
        doc_clean,
        doc_trim,
        doc_trim_parts,
        doc_body_parts,
        chunk_stride,
        chunk_recursive,
        chunk_noisy,
        chunk_headed,
        chunk_noise,
        noise_report,
        noise_reasons,
        book_chunks,
        qa_normalise_list,
        qa_normalise_fields,
        qa_drop_reasons,
        qa_marks,
        qa_strict_letters,
        qa_accuracy,
        mode_compare,
        knn_topk,
        knn_blocked,
        articles_topk,
        rag_context,
        rag_prompts,
        rag_answers,
        zero_shot_accuracy,
        direction_scores,
        score_compare,
        score_table,
        train_summary,
        eval_curve,
        loss_plateaus,
        early_stop,
        model_generate,
        model_embed,
        model_score,
        truncate_tokens,
        truncate_words,
        prompt_budget,
        training_budget,
        batch_rows,
        language_profiles,
        lang_detect,
        lang_route,
        trace_actions,
        trace_guard,
        trace_guard_segmented,
        trace_answer,
        verdicts,
        allowed_revisions,
        abstain_rate,
        lang_match,
        vote,
        io_examples,
        io_without_ids,
        io_exam,
        io_summary,
        io_knowledge_base,
        io_scores,
        io_direction_order,
        io_source_order,
        io_blank_lines,
    )
}
