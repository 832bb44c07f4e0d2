"""Rules of a tool-using question agent, applied to tables of texts and traces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.functions.text import SPACE_CLASS, ColumnOrName, col, strip
from pagelathe.operators.ordered import SEGMENT, SEGMENT_WIDTH, top_n_per_group, with_segments

# Tools, protocol words and the sentences that decline to answer.
RETRIEVAL_TOOLS = ("turkish_rag_search", "wikipedia_search")
FINISH_TOOL = "finish"
MAX_ROUNDS = 3
MIN_CONFIDENCE = 0.9
ABSTENTIONS = (
    "Verilen kaynaklarda yeterli bilgi yok.",
    "The provided sources do not contain enough information.",
)

ACTION_LINE = rf"(?mdU)^[{SPACE_CLASS}]*Action:[{SPACE_CLASS}]*(\w+)\((.*)\)[{SPACE_CLASS}]*$"
REVISE_LINE = r"(?s)^REVISE:(.*)$"


# Characters whose grams are counted at once.
COUNT_CHARS = 4_000_000
# Weights that are gathered at once while scoring.
SCORE_CELLS = 4_000_000


def fit_language_profiles(df: DataFrame, top: int, lang: str = "lang", text: str = "text", n: int = 3) -> DataFrame:
    """Most frequent character n-grams per language: ``lang, gram, n``.

    Grams are counted per Arrow batch as integers, so only distinct ones leave
    the scan; Spark sums the counts and keeps the ``top`` of each language,
    which is the size of the model.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, texts in batch.groupby("lang")["text"]:
                for part in _runs(texts, COUNT_CHARS):
                    codes, times = np.unique(np.concatenate([_codes(t, n) for t in part]), return_counts=True)
                    yield pd.DataFrame({"lang": name, "code": codes, "n": times})

    @F.pandas_udf("string")
    def spelled(codes: pd.Series) -> pd.Series:
        return codes.map(lambda c: "".join(chr(c >> (21 * i) & 0x1FFFFF) for i in reversed(range(n))))

    labelled = df.select(F.col(lang).alias("lang"), F.lower(text).alias("text")).dropna()
    counts = labelled.mapInPandas(count, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # Codes order like the grams they stand for.
    kept = top_n_per_group(counts, ["lang"], [F.col("n").desc(), F.col("code")], top)
    return kept.select("lang", spelled("code").alias("gram"), "n")


def _runs(texts: pd.Series, chars: int) -> Iterator[list[str]]:
    """Consecutive texts of together at least ``chars`` characters."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def detect_language(
    df: DataFrame, profiles: DataFrame, text: str = "text", fallback: str | None = None, min_confidence: float = MIN_CONFIDENCE, n: int = 3
) -> DataFrame:
    """Language and confidence of every text by naive Bayes over n-grams.

    Adds ``detected``, ``confidence`` and ``lang`` to the columns of ``df``:
    ``lang`` is the detected one from ``min_confidence`` up, else the
    ``fallback`` column.  Texts without a known n-gram have no detected
    language.  Profiles (their languages times the ``top`` they were fitted
    with) go to the tasks; texts are scored where they are.
    """
    found = _scorer(df, profiles, n)(F.lower(text))
    sure = F.col("_found.confidence") >= min_confidence
    other = F.col(fallback) if fallback else F.lit(None).cast("string")
    return (
        df.withColumn("_found", found)
        .withColumns({"detected": F.col("_found.detected"), "confidence": F.col("_found.confidence"), "lang": F.when(sure, F.col("_found.detected")).otherwise(other)})
        .drop("_found")
    )


def _codes(text: str, n: int) -> np.ndarray:
    """Every n-gram of a text as one integer, 21 bits per character."""
    if n > 3:
        raise ValueError("grams of more than 3 characters do not fit one integer")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    size = max(len(points) - n + 1, 0)
    code = np.zeros(size, dtype=np.int64)
    for i in range(n):
        code = (code << 21) | points[i : i + size]
    return code


def _scorer(df: DataFrame, profiles: DataFrame, n: int):
    """UDF: lower-cased text to its best language and that one's share of the likelihood."""
    known = profiles.select("lang", "gram", "n").toPandas()
    counts = known.pivot_table(index="gram", columns="lang", values="n", aggfunc="sum", fill_value=0).sort_index(axis=1)
    logs = np.log((counts.to_numpy() + 1) / (counts.to_numpy().sum(axis=0) + len(counts)))
    codes = np.array([_codes(g, n)[0] for g in counts.index], dtype=np.int64)
    order = np.argsort(codes)
    shared = df.sparkSession.sparkContext.broadcast((codes[order], logs[order], counts.columns.to_list()))

    def scored(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the weights of known grams of every text, and their number."""
        vocabulary, weights, _ = shared.value
        sizes = [len(g) for g in grams]
        every = np.concatenate(grams)
        owner = np.repeat(np.arange(len(grams)), sizes)
        at = np.minimum(np.searchsorted(vocabulary, every), len(vocabulary) - 1)
        hit = vocabulary[at] == every
        at, owner = at[hit], owner[hit]
        hits = np.bincount(owner, minlength=len(grams))
        return np.stack([np.bincount(owner, weights[at, i], len(grams)) for i in range(weights.shape[1])], axis=1), hits

    @F.pandas_udf("struct<detected: string, confidence: double>")
    def best(texts: pd.Series) -> pd.DataFrame:
        names, out, lot, cells = np.array([*shared.value[2], None], dtype=object), [], [], 0

        def flush() -> None:
            sums, hits = scored(lot)
            top = sums.argmax(axis=1)
            share = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            out.append(pd.DataFrame({"detected": names[np.where(hits > 0, top, -1)], "confidence": np.where(hits > 0, share, 0.0)}))

        for text in texts:
            lot.append(_codes(text, n) if text else np.empty(0, dtype=np.int64))
            cells += len(lot[-1])
            if cells >= SCORE_CELLS:
                flush()
                lot, cells = [], 0
        if lot:
            flush()
        return pd.concat(out, ignore_index=True)

    @F.pandas_udf("struct<detected: string, confidence: double>")
    def nothing(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"detected": [None] * len(texts), "confidence": 0.0})

    return best if len(codes) else nothing


def route(df: DataFrame, lang: str = "lang") -> DataFrame:
    """Tool by language: Turkish goes to the book base, all else to the encyclopedia."""
    return df.withColumn("tool", F.when(F.col(lang) == "tr", RETRIEVAL_TOOLS[0]).otherwise(RETRIEVAL_TOOLS[1]))


def split_routes(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(routed.where(F.col("tool") == t) for t in RETRIEVAL_TOOLS)


def parse_actions(trace: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per ``Action: tool(argument)`` line, numbered within its turn."""
    pairs = F.arrays_zip(
        F.regexp_extract_all("text", F.lit(ACTION_LINE), F.lit(1)).alias("tool"),
        F.regexp_extract_all("text", F.lit(ACTION_LINE), F.lit(2)).alias("arg"),
    )
    # The plain substring test spares most texts the pattern.
    lines = trace.where(F.contains(F.col("text"), F.lit("Action:"))).select(key, "turn", F.posexplode_outer(pairs).alias("action_no", "_a")).where(F.col("_a").isNotNull())
    return lines.select(key, "turn", F.col("action_no").cast("bigint").alias("action_no"), "_a.tool", "_a.arg")


def round_guard(
    actions: DataFrame, max_rounds: int = MAX_ROUNDS, key: str = "conv_id", width: int = SEGMENT_WIDTH
) -> DataFrame:
    """Number the retrievals of each conversation, flag those beyond the limit
    and everything after the first ``finish``.

    Long conversations are cut into turn segments that exchange counts only.
    """
    marked = with_segments(actions, "turn", width).withColumn("_retrieval", F.col("tool").isin(*RETRIEVAL_TOOLS))
    # One number per place, so that its minimum can be hash-aggregated.
    place = F.shiftleft(F.col("turn").cast("bigint"), 31) + F.col("action_no")
    whole = Window.partitionBy(key)
    earlier = whole.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        marked.groupBy(key, SEGMENT)
        .agg(F.count_if("_retrieval").alias("_n"), F.min(F.when(F.col("tool") == FINISH_TOOL, place)).alias("_end"))
        .select(
            key,
            SEGMENT,
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.min("_end").over(whole).alias("_finish"),
        )
    )
    inside = Window.partitionBy(key, SEGMENT).orderBy("turn", "action_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        marked.withColumn("_so_far", F.sum(F.col("_retrieval").cast("bigint")).over(inside))
        .join(carried, [key, SEGMENT])
        .withColumn("round", F.when(F.col("_retrieval"), F.col("_before") + F.col("_so_far")))
        .withColumn("over_limit", F.coalesce(F.col("round") > max_rounds, F.lit(False)))
        .withColumn("after_finish", F.coalesce(place > F.col("_finish"), F.lit(False)))
        .select(key, "turn", "action_no", "tool", "arg", "round", "over_limit", "after_finish")
    )


def final_answer(actions: DataFrame, key: str = "conv_id") -> DataFrame:
    """Argument of the first ``finish`` of each conversation, null if there is none."""
    at = F.when(F.col("tool") == FINISH_TOOL, F.struct("turn", "action_no"))
    return actions.groupBy(key).agg(F.min_by("arg", at).alias("final_answer"))


def parse_verdict(df: DataFrame, text: str = "text") -> DataFrame:
    """``verdict`` ok, revise or unparsed, and the ``reason`` of a revision."""
    said = strip(text)
    return df.withColumns(
        {
            "verdict": F.when(said == "OK", "ok").when(said.startswith("REVISE:"), "revise").otherwise("unparsed"),
            "reason": F.when(said.startswith("REVISE:"), strip(F.regexp_extract(said, REVISE_LINE, 1))),
        }
    )


def allowed_revisions(verdicts: DataFrame, key: str = "conv_id", order_by: str = "turn", most: int = 1) -> DataFrame:
    """The first ``most`` revisions of each conversation; later ones are not acted on."""
    revisions = verdicts.where(F.col("verdict") == "revise")
    return top_n_per_group(revisions, [key], [F.col(order_by)], most)


def mark_abstentions(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("abstained", strip(text).isin(*ABSTENTIONS))


def abstention_rate(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if("abstained").alias("n_abstained"),
        F.avg(F.col("abstained").cast("double")).alias("rate"),
    )


def language_match(df: DataFrame, question_lang: str = "question_lang", answer_lang: str = "answer_lang") -> DataFrame:
    return df.withColumn("same_language", F.col(question_lang).eqNullSafe(F.col(answer_lang)))


def majority_vote(df: DataFrame, key: str = "qa_id", answer: str = "answer") -> DataFrame:
    """Most frequent answer per question, the smallest among equals; nulls do not vote."""
    counts = df.groupBy(key, answer).agg(F.count(answer).alias("votes"))
    winner = F.min(F.struct((-F.col("votes")).alias("_v"), F.col(answer).isNull().alias("_none"), answer))
    return counts.groupBy(key).agg(winner.alias("_w"), F.sum("votes").alias("n_votes")).select(
        key, F.col("_w")[answer].alias(answer), (-F.col("_w._v")).alias("votes"), "n_votes"
    )

