"""Batch jobs around a model the caller brings.

``load`` is called once per Python worker and returns a function from a list of
inputs to a list of outputs.  Results are marked non-deterministic so that the
optimizer never runs a model twice for one column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelathe.functions.text import ColumnOrName, col

Load = Callable[[], Callable]

GENERATE_BATCH = 8
EMBED_BATCH = 64
SCORE_BATCH = 8
# Bytes of texts whose tokens are held at once: tokens weigh many times their texts.
LOT_BYTES = 1_000_000


def _slices(n: int, size: int) -> Iterator[slice]:
    return (slice(at, at + size) for at in range(0, n, size))


def _lots(columns: Sequence[pa.Array], size: int = LOT_BYTES) -> Iterator[list[list]]:
    """Rows of a batch as lists, column by column, some bytes of text at a time."""
    sizes = np.sum([pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False) for c in columns], axis=0, dtype=np.int64)
    lot = (np.cumsum(sizes) - sizes) // size
    cuts = [0, *(np.flatnonzero(np.diff(lot)) + 1), len(sizes)]
    return ([c.slice(a, b - a).to_pylist() for c in columns] for a, b in zip(cuts, cuts[1:]) if b > a)


def _joined(lots: Iterator[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays([pa.array([], kind), *lots])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt evenly before a model runs on them.

    The number of partitions is given, four for each core: left open, small rows
    would be merged by their bytes into a few tasks, however long a model takes.
    """
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def batch_generate(df: DataFrame, load: Load, prompt: str = "prompt", out: str = "raw", batch: int = GENERATE_BATCH) -> DataFrame:
    """Reply text for each prompt, stripped."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for prompts in series:
            values = prompts.tolist()
            replies = [r for part in _slices(len(values), batch) for r in model(values[part])]
            yield pd.Series([None if r is None else r.strip() for r in replies], dtype="object")

    udf = F.pandas_udf(run, "string").asNondeterministic()
    return df.withColumn(out, udf(prompt))


def batch_embed(df: DataFrame, load: Load, text: ColumnOrName = "embed_text", out: str = "embedding", batch: int = EMBED_BATCH) -> DataFrame:
    """Vector of length one for each text (a zero vector stays zero)."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in series:
            values = texts.tolist()
            rows: list = []
            for part in _slices(len(values), batch):
                vectors = np.asarray(model(values[part]), dtype=np.float64)
                norms = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
                rows.extend(np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0).astype(np.float32))
            yield pd.Series(rows, dtype="object")

    udf = F.pandas_udf(run, "array<float>").asNondeterministic()
    return df.withColumn(out, udf(col(text)))


def batch_score(
    df: DataFrame,
    load: Load,
    src: str = "src",
    hypothesis: str = "hypothesis",
    reference: str = "tgt",
    out: str = "seg_score",
    batch: int = SCORE_BATCH,
) -> DataFrame:
    """Segment score for each (source, hypothesis, reference)."""

    def run(columns: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for rows in columns:
            triples = list(zip(*[c.tolist() for c in rows]))
            yield pd.Series([s for part in _slices(len(triples), batch) for s in model(triples[part])], dtype="float64")

    udf = F.pandas_udf(run, "double").asNondeterministic()
    return df.withColumn(out, udf(src, hypothesis, reference))


def truncate_tokens(df: DataFrame, load: Load, max_tokens: int, text: str = "text") -> DataFrame:
    """Cut to a token budget with the caller's tokenizer.

    ``load`` returns a pair of functions: texts to token lists, token lists to texts.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode, decode = load()
        for batch in batches:
            cut = (decode([tokens[:max_tokens] for tokens in encode(texts)]) for (texts,) in _lots([batch]))
            yield _joined((pa.array(list(lot), pa.string()) for lot in cut), pa.string())

    return df.withColumn(text, F.arrow_udf(run, "string")(text))


def fit_tokens(df: DataFrame, load: Load, max_tokens: int, texts: Sequence[str], frame: Column | None = None) -> DataFrame:
    """Cut ``texts`` so that they and the ``frame`` around them keep a token budget.

    The frame (what a chat adds to the texts) is never cut.  Texts that fit
    together stay as they are, character by character.  Else the room left by
    the frame is dealt out evenly; what a short text leaves, and an odd
    token, goes to the longer ones (of equal ones to the last), and only texts
    longer than their share lose their ends.  Tokens are counted
    text by text with the caller's tokenizer, as in ``truncate_tokens``; null
    texts and frames have none.
    """

    kind = pa.struct([(t, pa.string()) for t in texts])

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        encode, decode = load()

        def fitted(frames: list, *given: list) -> pa.Array:
            room = [max(max_tokens - len(tokens), 0) for tokens in encode([f or "" for f in frames])]
            held = [encode([t or "" for t in column]) for column in given]
            shares = [_shares([len(tokens[row]) for tokens in held], free) for row, free in enumerate(room)]
            for i, (column, tokens) in enumerate(zip(given, held)):
                over = [row for row, share in enumerate(shares) if len(tokens[row]) > share[i]]
                for row, cut in zip(over, decode([tokens[row][: shares[row][i]] for row in over]) if over else ()):
                    column[row] = cut
            return pa.StructArray.from_arrays([pa.array(column, pa.string()) for column in given], fields=list(kind))

        for columns in batches:
            yield _joined((fitted(*lot) for lot in _lots(columns)), kind)

    schema = T.StructType([T.StructField(t, T.StringType()) for t in texts])
    udf = F.arrow_udf(run, schema)
    fitted = df.withColumn("_fit", udf(F.lit("") if frame is None else frame, *texts))
    return fitted.withColumns({t: F.col("_fit")[t] for t in texts}).drop("_fit")


def _shares(lengths: list[int], room: int) -> list[int]:
    """Tokens that each text may keep: short ones whole, the rest in even parts."""
    kept = list(lengths)
    left, open_ = room, len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (lengths[i], i)):
        kept[i] = min(lengths[i], left // open_)
        left, open_ = left - kept[i], open_ - 1
    return kept
