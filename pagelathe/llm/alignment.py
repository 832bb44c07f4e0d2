"""Alignment of two tokenizers by products of token-byte incidence matrices.

Each tokenizer gives a sparse matrix, tokens by bytes, in compressed sparse rows
(CSR).  The rows of A times the transpose of B, after Gustavson, hold for every
token of A the tokens of B that it shares bytes with, and how many.  The same
product of token-group incidences holds the tokens of the same group, where
groups are cut at the bytes at which tokens of both end.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelathe.llm.common import joined_hot, staged

#: Bytes of texts that are aligned at once, and of a tile of one product.
LOT_BYTES, TILE_BYTES = 1 << 20, 1 << 20
#: Id pairs up to which their counts are broadcast (some 50 bytes each).
FEW_PAIRS = 400_000
#: Fixed value: how byte-level BPE of this kind cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass
class Csr:
    """Compressed sparse rows; the entries of a row are in ascending columns."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(self.height, dtype=self.columns.dtype), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, self.rows()[order], self.values[order], self.height)

    def times(self, other: Csr) -> Csr:
        """Row-by-row product: the rows of ``other`` that a row's columns name are added up."""
        lengths = np.diff(other.starts)[self.columns]
        if (lengths == 1).all():
            rows, columns, values = self.rows(), other.columns[other.starts[self.columns]], self.values * other.values[other.starts[self.columns]]
        else:
            ends = np.cumsum(lengths)
            at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - other.starts[self.columns], lengths)
            rows, columns, values = np.repeat(self.rows(), lengths), other.columns[at], np.repeat(self.values, lengths) * other.values[at]
        if len(rows) and ((np.diff(rows) == 0) & (np.diff(columns) < 0)).any():
            order = np.lexsort((columns, rows))
            rows, columns, values = rows[order], columns[order], values[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])
        first = np.flatnonzero(new)
        total = np.add.reduceat(values, first) if len(first) else values[:0]
        starts = np.concatenate([[0], np.cumsum(np.bincount(rows[first], minlength=self.height))])
        return Csr(starts, columns[first], total, other.width)


def byte_incidence(ends: np.ndarray, n_bytes: int) -> Csr:
    """Tokens by bytes, of tokens that lie one after another; one entry per byte."""
    columns = np.arange(n_bytes, dtype=np.int32)
    return Csr(np.concatenate([[0], ends]), columns, np.ones(n_bytes, np.int32), n_bytes)


def group_incidence(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens by groups; every token is in the group that its end is in."""
    # Both ascend, so counting the cuts before each end is one pass, not a search.
    before = np.zeros(int(cuts[-1]) + 2 if len(cuts) else 1, np.int32)
    before[cuts + 1] = 1
    return Csr(np.arange(len(ends) + 1), np.cumsum(before, dtype=np.int32)[ends], np.ones(len(ends), np.int32), len(cuts))


def linked(ends_a: np.ndarray, ends_b: np.ndarray, cuts: np.ndarray, tile: int = TILE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping tokens: index in A, index in B and shared bytes of every link.

    Tiles end at cuts, so that no link lies in two; one holds ``tile`` bytes or
    a single group.
    """
    found, at = [], 0
    while at < (cuts[-1] if len(cuts) else 0):
        stop = cuts[max(np.searchsorted(cuts, at + tile, side="right") - 1, np.searchsorted(cuts, at, side="right"))]
        a, b = (np.searchsorted(e, [at, stop], side="right") for e in (ends_a, ends_b))
        a_rows, b_rows = (byte_incidence(e[x[0] : x[1]] - at, int(stop - at)) for e, x in ((ends_a, a), (ends_b, b)))
        # Tokens that follow one another have one entry per byte: the transpose needs no sort.
        b_bytes = Csr(np.arange(b_rows.width + 1), b_rows.rows(), b_rows.values, b_rows.height)
        product = a_rows.times(b_bytes)
        found.append((product.rows() + a[0], product.columns + b[0], product.values))
        at = stop
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def grouped(ends_a: np.ndarray, ends_b: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens of A by the tokens of B in the same group."""
    return group_incidence(ends_a, cuts).times(group_incidence(ends_b, cuts).transposed())


def _byte_of() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable
    ones for themselves, the others, in order, for the signs from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Byte-level BPE from a tokenizers file; space + text goes in."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already keeps every core busy
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        of = _byte_of()
        names = [self.whole.id_to_token(i) or "" for i in range(self.whole.get_vocab_size())]
        self.bytes = [bytes(of[c] for c in n) if all(c in of for c in n) else n.encode() for n in names]
        self.quick = self._quick(path)

    def _quick(self, path: str):
        """The same ids from a faster library, where the file says that merges are in the order of ids."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, cut = told["model"], told.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and told.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        plain = plain and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        special = {t["content"] for t in told.get("added_tokens", [])}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model.get("merges", [])]
        if not plain or any(x >= y for x, y in zip(merged, merged[1:])) or len(merged) + 256 != len(model["vocab"].keys() - special):
            return None
        ranks = {self.bytes[i]: i for name, i in model["vocab"].items() if name not in special}
        return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list[list[int]]:
        if self.quick:
            return [self.quick.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self.whole.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """Sentencepiece model; it puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Lot:
    """Some texts, aligned together: block-diagonal matrices, one block per text."""

    def __init__(self, aligner: Aligner, texts: list[str]):
        whole = [(" " + t).encode("utf-8", "surrogatepass") for t in texts]
        ids = [[], []]
        fit = np.array([t != "" for t in texts], bool)
        for side, model in enumerate((aligner.a, aligner.b)):
            ids[side] = model(texts)
            of = model.bytes.__getitem__
            fit &= np.array([b"".join(map(of, i)) == w for i, w in zip(ids[side], whole, strict=True)], bool)
        size = np.where(fit, [len(w) for w in whole], 0)
        #: Where each text ends, in bytes of the lot, and its tokens on either side.
        self.text_ends = np.cumsum(size)
        self.ids, self.token_ends, self.ends = [], [], []
        for side, lengths in enumerate((aligner.a_lengths, aligner.b_lengths)):
            kept = [i if f else [] for i, f in zip(ids[side], fit, strict=True)]
            flat = np.fromiter(chain.from_iterable(kept), np.int32, sum(map(len, kept)))
            self.ids.append(flat)
            self.token_ends.append(np.cumsum([len(i) for i in kept]))
            self.ends.append(np.cumsum(lengths[flat]))
        # A text's last byte ends tokens of both, so groups never reach over it.
        ends_b = np.zeros(int(self.text_ends[-1]) + 1, bool)
        ends_b[self.ends[1]] = True
        both = self.ends[0][ends_b[self.ends[0]]]
        self.cuts = both[np.diff(both, prepend=0) > 0]
        self.links = linked(*self.ends, self.cuts)
        self.groups = [group_incidence(e, self.cuts) for e in self.ends]

    def counts(self) -> dict[str, np.ndarray]:
        """Per text: tokens of either side, groups, links and pairs of one group."""
        per = lambda ends: np.diff(np.concatenate([[0], ends]))
        cut_ends = np.searchsorted(self.cuts, self.text_ends, side="right")
        link_ends = np.searchsorted(self.links[0], self.token_ends[0], side="left")
        # Only the size of the group product: each row is as long as its group in B.
        members = np.bincount(self.groups[1].columns, minlength=len(self.cuts))
        shared = np.concatenate([[0], np.cumsum(members[self.groups[0].columns])])[self.token_ends[0]]
        return {"n_a": per(self.token_ends[0]), "n_b": per(self.token_ends[1]), "n_groups": per(cut_ends), "n_links": per(link_ends), "n_shared": per(shared)}

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different id pairs of each text: where texts end, a, b and their number of links."""
        stops = np.searchsorted(self.links[0], self.token_ends[0])
        text = np.repeat(np.arange(len(stops)), np.diff(stops, prepend=0))
        a, b = self.ids[0][self.links[0]].astype(np.int64), self.ids[1][self.links[1]]
        order = np.sort((text << np.int64(40)) + a * width + b) if len(text) else np.empty(0, np.int64)
        new = np.ones(len(order), bool)
        new[1:] = order[1:] != order[:-1]
        first = np.flatnonzero(new)
        pair = order[first] & ((1 << 40) - 1)
        ends = np.searchsorted(order[first] >> 40, np.arange(len(self.text_ends)), side="right")
        return ends, pair // width, pair % width, np.diff(np.append(first, len(order)))

    def group_texts(self, signs: list[bytes]) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text; ``signs`` are all ids three times, followed by , | and ;"""
        groups = [g.columns for g in self.groups]
        members = [np.cumsum(np.bincount(g, minlength=len(self.cuts))) for g in groups]
        before_b = np.concatenate([[0], members[1]])[groups[0]]
        before_a = members[0][groups[1]]
        n_ids = len(signs) // 3
        codes = np.empty(sum(map(len, self.ids)), np.int64)
        for side, (ids, group, others) in enumerate(zip(self.ids, groups, (before_b, before_a), strict=True)):
            last = np.ones(len(ids), bool)
            last[:-1] = group[1:] != group[:-1]
            codes[np.arange(len(ids)) + others] = ids + np.where(last, (1 + side) * n_ids, 0)
        named = list(map(signs.__getitem__, codes.tolist()))
        stops = (self.token_ends[0] + self.token_ends[1]).tolist()
        return [b"".join(named[x:y])[:-1] for x, y in zip([0, *stops], stops)]


class Aligner:
    """Both tokenizers with the lengths of their tokens; one per Python worker."""

    held: dict = {}

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteBpe(a_path), Pieces(b_path)
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in m.bytes], np.int64) for m in (self.a, self.b))
        self.width = len(self.b_lengths)
        names = [str(i).encode() for i in range(max(len(self.a_lengths), self.width))]
        self.signs = [n + end for end in (b",", b"|", b";") for n in names]
        # Pairs are numbered below 2^40, texts of a lot above.
        if len(self.a_lengths) * self.width >= 1 << 40:
            raise ValueError("the vocabularies have more than 2^40 id pairs")

    @classmethod
    def of_worker(cls, a_path: str, b_path: str) -> Aligner:
        if (a_path, b_path) not in cls.held:
            cls.held[a_path, b_path] = cls(a_path, b_path)
        return cls.held[a_path, b_path]

    def lots(self, batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, Lot]]:
        """Neighbouring rows of about LOT_BYTES, or one longer row."""
        texts = batch.column(column).to_pylist()
        start, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= LOT_BYTES or i + 1 == len(texts):
                yield start, i + 1, Lot(self, texts[start : i + 1])
                start, held = i + 1, 0


def _lists(stops: np.ndarray, **columns: np.ndarray) -> pa.Array:
    """A list per text of structs, or of numbers if there is one column."""
    arrays = [pa.array(c) for c in columns.values()]
    inner = arrays[0] if len(arrays) == 1 else pa.StructArray.from_arrays(arrays, list(columns))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]).astype(np.int32)), inner)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("no"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment of every row itself: doc_id, a_ids, a_ends, b_ids, b_ends, cuts, links, shared.

    Ends and cuts are byte offsets in space + text; links (a, b, bytes) are token
    numbers and shared bytes, ``shared`` (a, b) the tokens of one group.  For
    texts without tokens, see ``align``, all lists are empty.
    """
    rows = _texts(docs, id_col, text_col).drop("no")
    kind = rows.schema["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of_worker(a_path, b_path)
        for batch in batches:
            for start, stop, lot in aligner.lots(batch, "text"):
                tokens, origin = lot.token_ends, np.concatenate([[0], lot.text_ends[:-1]])
                shift = [np.repeat(origin, np.diff(np.concatenate([[0], t]))) for t in tokens]
                first = [np.concatenate([[0], t[:-1]]) for t in tokens]
                cut_ends = np.searchsorted(lot.cuts, lot.text_ends, side="right")

                def placed(a: np.ndarray, b: np.ndarray, **more: np.ndarray) -> pa.Array:
                    ends = np.searchsorted(a, tokens[0], side="left")
                    home = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
                    return _lists(ends, a=(a - first[0][home]).astype(np.int32), b=(b - first[1][home]).astype(np.int32), **more)

                a, b, shared_bytes = lot.links
                groups = grouped(*lot.ends, lot.cuts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, stop - start),
                        *(x for i in (0, 1) for x in (_lists(tokens[i], ids=lot.ids[i]), _lists(tokens[i], ends=lot.ends[i] - shift[i]))),
                        _lists(cut_ends, cuts=lot.cuts - np.repeat(origin, np.diff(np.concatenate([[0], cut_ends])))),
                        placed(a, b, bytes=shared_bytes.astype(np.int32)),
                        placed(groups.rows(), groups.columns),
                    ],
                    ["doc_id", "a_ids", "a_ends", "b_ids", "b_ends", "cuts", "links", "shared"],
                )

    pair = "array<struct<a: int, b: int{}>>"
    sides = ", ".join(f"{s}_ids array<int>, {s}_ends array<bigint>" for s in "ab")
    return rows.mapInArrow(cut, f"doc_id {kind.dataType.simpleString()}, {sides}, cuts array<bigint>, links {pair.format(', bytes: int')}, shared {pair.format('')}")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", few_pairs: int = FEW_PAIRS) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_shared.

    A is a byte-level BPE of the tokenizers library, B a sentencepiece model.
    Links are pairs of an A and a B token whose bytes overlap.  The count of an
    id pair is its number of links in all rows; ``n_best`` counts the links whose
    count is the highest of their B id, ``count_sum`` adds up the counts.
    ``groups_sha256`` is the SHA-256 of the groups as ``a1,a2|b1;a3|b2``.

    Texts that are null or empty, or whose tokens do not join to space + text,
    have no tokens: zeros and ''.  Repeated rows count as often as they occur;
    a null id is kept.
    """
    rows = _texts(docs, id_col, text_col)
    fields = f"no bigint, doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_shared bigint, groups_sha256 string, pairs array<struct<a: int, b: int, n: bigint>>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of_worker(a_path, b_path)
        for batch in batches:
            for start, stop, lot in aligner.lots(batch, "text"):
                ends, a, b, n = lot.pairs(aligner.width)
                told = [hashlib.sha256(t).hexdigest() if t else "" for t in lot.group_texts(aligner.signs)]
                numbers = {k: pa.array(v.astype(np.int64)) for k, v in lot.counts().items()}
                found = {
                    "no": batch.column("no").slice(start, stop - start),
                    "doc_id": batch.column("doc_id").slice(start, stop - start),
                    **numbers,
                    "groups_sha256": pa.array(told, pa.string()),
                    "pairs": _lists(ends, a=a.astype(np.int32), b=b.astype(np.int32), n=n.astype(np.int64)),
                }
                yield pa.RecordBatch.from_arrays(list(found.values()), list(found))

    table = staged(rows.mapInArrow(cut, fields), "aligned")
    links = table.select("no", F.inline("pairs"))
    pairs = staged(links.groupBy("a", "b").agg(F.sum("n").alias("links"), F.count("*").alias("texts")), "pairs")
    # One row per id of B, so its size is that of the vocabulary.
    highest = pairs.groupBy("b").agg(F.max("links").alias("highest"))
    marked = staged(pairs.join(F.broadcast(highest), "b").select("a", "b", "links", "texts", (F.col("links") == F.col("highest")).alias("best")), "pairs-best")
    few = marked.limit(few_pairs + 1).count() <= few_pairs
    met = links.join(F.broadcast(marked.drop("texts")), ["a", "b"]) if few else joined_hot(links, marked, ["a", "b"], "texts")
    sums = met.groupBy("no").agg(F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"), F.sum(F.col("n") * F.col("links")).alias("count_sum"))
    whole = table.drop("pairs").join(sums, "no", "left")
    zero = F.lit(0).cast("bigint")
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", "n_shared")
