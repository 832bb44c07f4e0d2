"""Exact nearest chunks per question, and the context built from them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelathe.functions.text import remove_prefix
from pagelathe.operators.ordered import top_n_per_group
from pagelathe.session import scratch_folder, shared_files

TOP_K = 5
ARTICLES_K = 2
ARTICLE_CHARS = 1500
# Numbers of a block of questions, and of a lot of base rows, that a task holds
# at a time: 32 and 128 MB as doubles, whatever the dimension.
BLOCK_CELLS, LOT_CELLS = 4_000_000, 16_000_000
# Questions whose hits are sent to the chunk table.
FEW_QUERIES = 20_000
# Size of one distance matrix, and of one exact recomputation.
MATRIX_CELLS = 4_000_000
REFINE_PAIRS = 100_000
# Squared distances that agree to this many decimals count as equal, so that
# equal vectors rank by id whatever order the sums were taken in.
DECIMALS = 12

def count_up_to(df: DataFrame, most: int) -> int | None:
    """Row count, or None if there are more than ``most`` rows."""
    n = df.limit(most + 1).count()
    return None if n > most else n


def small_query_count(queries: DataFrame, max_queries: int = FEW_QUERIES) -> int | None:
    """Number of queries if at most ``max_queries``, else None; vectors are not computed for it."""
    return count_up_to(queries.select(F.lit(1)), max_queries)


class _Nearest:
    """Running top ``k`` per query over blocks of base rows.

    ``limit`` is a squared distance within which ``k`` base rows are known
    already, from other rows than these; nothing beyond it is kept.
    """

    def __init__(self, queries: np.ndarray, k: int, limit: np.ndarray | None = None):
        self.queries, self.k = queries, k
        self.norms = (queries**2).sum(1)
        self.limit = np.full(len(queries), np.inf) if limit is None else limit.copy()
        self.best: pd.DataFrame | None = None

    def add(self, ids: np.ndarray, base: np.ndarray) -> None:
        step = max(1, MATRIX_CELLS // max(1, len(self.queries)))
        for at in range(0, len(ids), step):
            self._merge(ids[at : at + step], base[at : at + step])

    def _merge(self, ids: np.ndarray, base: np.ndarray) -> None:
        """A matrix product finds the candidates; their distances are then
        summed term by term, as the product loses the digits that ties need."""
        norms = (base**2).sum(1)
        rough = self.norms[:, None] + norms[None, :] - 2.0 * self.queries @ base.T
        bound = self.limit
        if len(base) > self.k:
            bound = np.minimum(bound, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1])
        slack = 1e-9 * (1.0 + self.norms + norms.max())
        qi, bi = np.nonzero(rough <= (bound + slack)[:, None])
        exact = np.empty(len(qi))
        for at in range(0, len(qi), REFINE_PAIRS):
            part = slice(at, at + REFINE_PAIRS)
            diff = self.queries[qi[part]] - base[bi[part]]
            exact[part] = np.einsum("ij,ij->i", diff, diff)
        found = pd.DataFrame({"q": qi, "id": ids[bi], "d2": exact.round(DECIMALS)})
        both = found if self.best is None else pd.concat([self.best, found], ignore_index=True)
        ordered = both.sort_values(["q", "d2", "id"], kind="stable")
        self.best = ordered.groupby("q", sort=False).head(self.k)
        full = self.best.groupby("q")["d2"].agg(["size", "max"])
        full = full[full["size"] == self.k]
        at = full.index.to_numpy()
        self.limit[at] = np.minimum(self.limit[at], full["max"].to_numpy())

    def hits(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return names[self.best["q"].to_numpy()], self.best["id"].to_numpy(), self.best["d2"].to_numpy()


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _out_of_reach(queries: np.ndarray, limit: np.ndarray, centre: np.ndarray, radius: float) -> bool:
    """Whether a ball of base rows is farther from every query than its limit (triangle inequality)."""
    if not np.isfinite(limit).all():
        return False
    away = np.sqrt(((queries - centre) ** 2).sum(1)) - radius
    # The slack covers rounding, so that rows at exactly the limit are still seen.
    return bool((away > np.sqrt(limit) + 1e-6 * (1.0 + radius + np.abs(away))).all())


def _lots(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and vectors of neighbouring base rows, ``cells`` numbers or a little more at a time."""
    ids, rows, held = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids.append(batch.column(0))
        rows.append(_matrix(batch.column(1)))
        held += rows[-1].size
        if held >= cells:
            yield pa.concat_arrays(ids), np.concatenate(rows)
            ids, rows, held = [], [], 0
    if ids:
        yield pa.concat_arrays(ids), np.concatenate(rows)


def _question_blocks(folder: str, cells: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and vectors of the written questions, ``cells`` numbers at most at a time, in the same order each time."""
    store, paths = shared_files(folder, ".parquet")
    for path in paths:
        with store.open_input_file(path) as source:
            file = pq.ParquetFile(source)
            if not file.metadata.num_rows:
                continue
            wide = next(file.iter_batches(batch_size=1)).column(1)
            for batch in file.iter_batches(batch_size=max(1, cells // max(1, len(wide[0])))):
                yield batch.column(0), _matrix(batch.column(1))


def knn_topk(
    queries: DataFrame,
    base: DataFrame,
    k: int = TOP_K,
    query_id: str = "qa_id",
    chunk_id: str = "chunk_id",
    vector: str = "embedding",
    max_cells: int = BLOCK_CELLS,
    lot_cells: int = LOT_CELLS,
) -> DataFrame:
    """``query_id, rank, chunk_id, distance`` of the exact Euclidean top ``k``.

    Ties go to the lower chunk id; nothing is de-duplicated; ids are of any
    type.  The question vectors are written once, so that a model behind them
    runs once per question, and never pass the driver: a task holds one lot of
    its base rows and reads the question files block by block.  The base is read
    once, in place, however many questions there are.  A lot that the triangle
    inequality puts beyond what a block's questions have found is skipped.
    """
    spark = base.sparkSession
    folder = f"{scratch_folder(spark)}/questions-{uuid.uuid4().hex}"
    q = queries.select(query_id, vector).where(F.col(vector).isNotNull())
    q.write.parquet(folder)
    b = base.select(chunk_id, vector).where(F.col(vector).isNotNull()).coalesce(spark.sparkContext.defaultParallelism)
    schema = T.StructType([q.schema[query_id], b.schema[chunk_id], T.StructField("_d2", T.DoubleType())])
    names = schema.names

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits: dict[int, np.ndarray] = {}  # one number per question
        for ids, rows in _lots(batches, lot_cells):
            centre = rows.mean(axis=0)
            radius = float(np.sqrt(((rows - centre) ** 2).sum(1).max()))
            numbers = np.arange(len(ids))
            # Equal distances go to the lower id, so rows are numbered in the order of ids.
            order = pc.sort_indices(ids)
            ids, rows = ids.take(order), rows[order.to_numpy()]
            for at, (keys, block) in enumerate(_question_blocks(folder, max_cells)):
                known = limits.get(at)
                if known is not None and _out_of_reach(block, known, centre, radius):
                    continue
                nearest = _Nearest(block, k, known)
                nearest.add(numbers, rows)
                limits[at] = nearest.limit
                of, hit, d2 = nearest.hits(np.arange(len(keys)))
                if len(of):
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(of)), ids.take(pa.array(hit)), pa.array(d2)], names)

    top = top_n_per_group(b.mapInArrow(scan, schema), [query_id], [F.col("_d2"), F.col(chunk_id)], k, rank="rank")
    return top.select(query_id, F.col("rank").cast("int").alias("rank"), chunk_id, F.sqrt("_d2").alias("distance"))


def attach_text(
    hits: DataFrame, chunks: DataFrame, n_hits: int | None, chunk_id: str = "chunk_id", text: str = "text", max_hits: int = 1_000_000
) -> DataFrame:
    """Chunk text for each hit.

    The chunk table is far larger than the hits.  With a known bound on the
    hits (``n_hits``, queries times k) they are sent to the chunks, which are
    then scanned without a shuffle; otherwise both sides are shuffled.
    """
    wanted = chunks.select(chunk_id, text)
    if n_hits is not None and n_hits <= max_hits:
        return wanted.join(F.broadcast(hits), chunk_id)
    return hits.join(wanted, chunk_id)


def retrieve(
    queries: DataFrame,
    chunks: DataFrame,
    k: int = TOP_K,
    query_id: str = "qa_id",
    chunk_id: str = "chunk_id",
    vector: str = "embedding",
    text: str = "text",
) -> DataFrame:
    """Top ``k`` chunks per question with their text."""
    n = small_query_count(queries)
    hits = knn_topk(queries, chunks, k, query_id, chunk_id, vector)
    return attach_text(hits, chunks, None if n is None else n * k, chunk_id, text)


def assemble_context(hits: DataFrame, query_id: str = "qa_id", text: str = "text") -> DataFrame:
    """``[1] first``, blank line, ``[2] second`` ... per question, passage prefix removed."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", remove_prefix(text).alias("text"))))
    numbered = F.transform(ranked, lambda h: F.concat(F.lit("["), h["rank"].cast("string"), F.lit("] "), h["text"]))
    return hits.groupBy(query_id).agg(F.array_join(numbered, "\n\n").alias("context"))


def attach_context(qa: DataFrame, context: DataFrame, query_id: str = "qa_id") -> DataFrame:
    """Context for every question, empty where nothing was retrieved."""
    return qa.join(context, query_id, "left").withColumn("context", F.coalesce("context", F.lit("")))


def retrieve_articles(
    queries: DataFrame,
    articles: DataFrame,
    k: int = ARTICLES_K,
    chars: int = ARTICLE_CHARS,
    query_id: str = "qa_id",
    article_id: str = "article_id",
    vector: str = "embedding",
    text: str = "text",
) -> DataFrame:
    """Nearest articles, each shortened to its opening ``chars``."""
    found = retrieve(queries, articles, k, query_id, article_id, vector, text)
    return found.withColumn(text, F.left(text, F.lit(chars)))
