"""Chat messages as array<struct<role,content>> and their rendering to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelathe.functions.text import ColumnOrName, col

# Prompt wording.
TRANSLATION_REQUEST = ("Translate the following text from ", " to ", ":\n\n")
TRANSLATION_SYSTEM = "You are a professional translator. Translate accurately without adding commentary."
QA_SYSTEM = (
    "Sen Türk tarihi konusunda uzman bir öğretmensin. Aşağıdaki çoktan seçmeli soruyu cevapla. "
    "Sadece doğru seçeneğin harfini ver (A, B, C, D veya E). Başka hiçbir şey yazma."
)
QA_CONTEXT_SYSTEM = (
    "Sen Türk tarihi konusunda uzman bir öğretmensin. Aşağıdaki bağlam parçalarına ve genel tarih bilgine "
    "dayanarak çoktan seçmeli soruyu cevapla. Sadece doğru seçeneğin harfini ver (A, B, C, D veya E). "
    "Başka hiçbir şey yazma."
)
QUESTION_LABEL = "Soru: "
CONTEXT_LABEL = "Bağlam:\n"
ANSWER_CUE = "Cevap (sadece harf):"

# Chat markers in the public ChatML convention; callers may pass their own.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>\n"


def message(role: str, content: ColumnOrName) -> Column:
    return F.struct(F.lit(role).alias("role"), col(content).alias("content"))


def translation_messages(
    src: ColumnOrName, src_lang: ColumnOrName, tgt_lang: ColumnOrName, target: ColumnOrName | None = None
) -> Column:
    """System and user turn; an assistant turn when the target is not null."""
    before, between, after = (F.lit(x) for x in TRANSLATION_REQUEST)
    ask = F.concat(before, col(src_lang), between, col(tgt_lang), after, col(src))
    turns = [message("system", F.lit(TRANSLATION_SYSTEM)), message("user", ask)]
    if target is None:
        return F.array(*turns)
    return F.when(col(target).isNull(), F.array(*turns)).otherwise(F.array(*turns, message("assistant", target)))


def format_choices(choices: ColumnOrName) -> Column:
    return F.array_join(F.transform(col(choices), lambda c: F.concat(c["letter"], F.lit(") "), c["text"])), "\n")


def _question_block(question: ColumnOrName, choices: ColumnOrName) -> Column:
    return F.concat(
        F.lit(QUESTION_LABEL), col(question), F.lit("\n\n"), format_choices(choices), F.lit(f"\n\n{ANSWER_CUE}")
    )


def zero_shot_messages(question: ColumnOrName, choices: ColumnOrName) -> Column:
    return F.array(message("system", F.lit(QA_SYSTEM)), message("user", _question_block(question, choices)))


def context_messages(question: ColumnOrName, choices: ColumnOrName, context: ColumnOrName) -> Column:
    body = F.concat(F.lit(CONTEXT_LABEL), col(context), F.lit("\n\n"), _question_block(question, choices))
    return F.array(message("system", F.lit(QA_CONTEXT_SYSTEM)), message("user", body))


def has_context(context: ColumnOrName) -> Column:
    return F.coalesce(col(context), F.lit("")) != ""


def qa_messages(question: ColumnOrName, choices: ColumnOrName, context: ColumnOrName) -> Column:
    """Prompt with context when there is any, otherwise the zero-shot prompt."""
    return F.when(has_context(context), context_messages(question, choices, context)).otherwise(
        zero_shot_messages(question, choices)
    )


def render_chat(
    messages: ColumnOrName, open_reply: bool = False, turn_start: str = TURN_START, turn_end: str = TURN_END
) -> Column:
    """Messages as one string; ``open_reply`` adds the start of the assistant turn."""
    turns = F.transform(
        col(messages),
        lambda m: F.concat(F.lit(turn_start), m["role"], F.lit("\n"), m["content"], F.lit(turn_end)),
    )
    text = F.array_join(turns, "")
    return F.concat(text, F.lit(f"{turn_start}assistant\n")) if open_reply else text
