"""Multiple-choice questions: one shape out of many, marking, accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelathe.functions.text import ascii_digits, first_letter, strip

LETTERS = "ABCDE"
CHOICE_TYPE = "array<struct<letter:string,text:string>>"

# Names under which the fields occur, in order of preference.
QUESTION_NAMES = ("question", "soru")
ANSWER_NAMES = ("answer", "answer_key", "answer key", "correct", "label", "cevap")
SUBJECT_NAMES = ("subject", "section", "konu")
CHOICE_LIST_NAMES = ("choices", "options", "secenekler", "şıklar")
CHOICE_FIELD_NAMES = ("choice {}", "choice_{}", "option_{}")
HISTORY_SUBJECTS = ("history", "tarih")
DEFAULT_SUBJECT = "History"


def find_column(df: DataFrame, names: Sequence[str]) -> str | None:
    """First candidate that exists, ignoring case.

    Its value counts even where it is null: later candidates are not consulted.
    """
    present = {c.lower(): c for c in df.columns}
    return next((present[n] for n in names if n in present), None)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _text(name: str) -> Column:
    return strip(_quoted(name).cast("string"))


def _choices_from_list(name: str) -> Column:
    first = F.slice(_quoted(name).cast("array<string>"), 1, len(LETTERS))
    lettered = F.transform(
        first, lambda v, i: F.struct(F.substring(F.lit(LETTERS), i + 1, F.lit(1)).alias("letter"), strip(v).alias("text"))
    )
    return F.filter(lettered, lambda c: F.coalesce(c["text"], F.lit("")) != "")


def _choices_from_fields(df: DataFrame, bare_letters: bool) -> Column:
    found = []
    for letter in LETTERS:
        names = [n.format(letter.lower()) for n in CHOICE_FIELD_NAMES]
        if bare_letters:
            names += [f"choice{letter.lower()}", letter.lower()]
        name = find_column(df, names)
        if name:
            found.append(F.struct(F.lit(letter).alias("letter"), _text(name).alias("text")))
    if not found:
        return F.array().cast(CHOICE_TYPE)
    return F.filter(F.array(*found), lambda c: F.coalesce(c["text"], F.lit("")) != "")


def choice_column(df: DataFrame, bare_letters: bool = False) -> Column:
    """Options from a list column, or from one column per letter where it is null or absent."""
    fields = _choices_from_fields(df, bare_letters)
    name = find_column(df, CHOICE_LIST_NAMES)
    if name is None or not isinstance(df.schema[name].dataType, T.ArrayType):
        return fields
    return F.when(_quoted(name).isNotNull(), _choices_from_list(name)).otherwise(fields)


def answer_letter(answer: Column, n_choices: Column, strict: bool = False) -> Column:
    """Answer as a letter: index from 0, then from 1, or the first A-E in the text."""
    said = F.upper(strip(answer.cast("string")))
    index = ascii_digits(said).try_cast("int")
    at = lambda i: F.substring(F.lit(LETTERS), i, F.lit(1))
    return (
        F.when(
            said.rlike(r"^\p{Nd}+$"),
            F.when(index < n_choices, at(index + 1)).when((index >= 1) & (index == n_choices), at(index)),
        )
        .otherwise(first_letter(said, strict))
    )


def _is_falsy(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    value = _quoted(name)
    if isinstance(kind, T.BooleanType):
        return value.isNull() | ~value
    if isinstance(kind, T.NumericType):
        return value.isNull() | (value == 0)
    return value.isNull() | (value.cast("string") == "")


def normalise_exam(
    df: DataFrame, qa_id: str, subject_filter: bool = False, bare_letters: bool = False, strict_letters: bool = False
) -> DataFrame:
    """Every row in the QA shape with a ``drop_reason`` that is null for usable rows."""
    question, answer, subject = (find_column(df, n) for n in (QUESTION_NAMES, ANSWER_NAMES, SUBJECT_NAMES))
    missing = F.lit(None).cast("string")
    raw_subject = _text(subject) if subject else missing
    named = df.select(
        _quoted(qa_id).alias("qa_id"),
        (F.when(_is_falsy(df, subject), DEFAULT_SUBJECT).otherwise(raw_subject) if subject else F.lit(DEFAULT_SUBJECT)).alias("subject"),
        (_text(question) if question else missing).alias("question"),
        choice_column(df, bare_letters).alias("choices"),
        (_quoted(answer).cast("string") if answer else missing).alias("_said"),
        (~F.lower(raw_subject).isin(*HISTORY_SUBJECTS) if subject_filter else F.lit(False)).alias("_other"),
    )
    n_choices = F.size("choices")
    lettered = named.withColumn("answer", answer_letter(F.col("_said"), n_choices, strict_letters))
    reason = (
        F.when(F.col("question").isNull() | F.col("_said").isNull(), "no_question_or_answer")
        .when(F.coalesce("_other", F.lit(False)), "other_subject")
        .when(n_choices < 2, "too_few_choices")
        .when(F.col("answer").isNull(), "no_answer_letter")
    )
    offered = F.coalesce(F.exists("choices", lambda c: c["letter"] == F.col("answer")), F.lit(False))
    return lettered.withColumns({"answer_in_choices": offered, "drop_reason": reason}).drop("_said", "_other")


def valid_items(normalised: DataFrame) -> DataFrame:
    return normalised.where(F.col("drop_reason").isNull()).drop("drop_reason")


def mark_answers(df: DataFrame, raw: str = "raw", strict: bool = False) -> DataFrame:
    """Predicted letter and whether it is right; no letter counts as wrong."""
    return df.withColumn("prediction", first_letter(raw, strict)).withColumn(
        "correct", F.col("prediction").eqNullSafe(F.col("answer"))
    )


def accuracy(df: DataFrame, mode: str | Column, top_k: int | None = None) -> DataFrame:
    """One summary row, also for empty input."""
    return df.agg(*_accuracy_columns()).select(
        (F.lit(mode) if isinstance(mode, str) else mode).alias("mode"),
        "n",
        "correct",
        "accuracy",
        F.lit(top_k).cast("int").alias("top_k"),
    )


def accuracy_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*_accuracy_columns())


def _accuracy_columns() -> list[Column]:
    right = F.count_if(F.col("prediction").eqNullSafe(F.col("answer")))
    return [
        F.count("*").alias("n"),
        right.alias("correct"),
        F.coalesce(F.try_divide(right.cast("double"), F.count("*")), F.lit(0.0)).alias("accuracy"),
    ]


def compare_modes(summaries: DataFrame, base: str = "zero_shot", other: str = "rag") -> DataFrame:
    """Two summary rows side by side with the gain in percentage points."""
    pick = lambda mode, c: F.max(F.when(F.col("mode") == mode, F.col(c)))
    return summaries.agg(
        *[pick(m, c).alias(f"{m}_{c}") for m in (base, other) for c in ("n", "correct", "accuracy")],
        pick(other, "top_k").alias("top_k"),
    ).withColumn("delta_pp", (F.col(f"{other}_accuracy") - F.col(f"{base}_accuracy")) * 100)
