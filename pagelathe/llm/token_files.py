"""Token ids in bit-plane files.

A file holds the ids of consecutive documents as chunks of a fixed number of
ids.  A chunk is transposed into 32 bit planes (or 4 byte planes), each plane is
compressed with zstandard on its own, and the file ends with an index: for each
chunk its place, its number of ids and the lengths of its planes; for each
document its key and its number of ids.

File layout, little-endian:
    8 bytes   magic
    planes of chunk 0, planes of chunk 1, ...
    index     zstandard frame of a JSON head and the number columns after it
    8 bytes   length of the index
    8 bytes   magic

Tasks write below one folder, each under a name of its own; the manifest that
Spark commits afterwards says which files count, so a repeated or lost task
leaves nothing behind that a reader would see.
"""

from __future__ import annotations

import json
import operator
import os
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelathe.llm.common import new_folder, staged, staged_path, store_of

MAGIC = b"BITPLN01"
CHUNK_IDS = 65_536
LEVEL = 3
END_ID = 1
#: Word chunks whose ids a worker keeps, and bytes of them; a full table is emptied.
CACHE, CACHE_BYTES = 1_000_000, 64 << 20
#: Bytes of texts that are encoded before the ids of the first go into chunks; each distinct word of them is looked up once.
LOT_BYTES = 4 << 20
#: Words that go to the tokenizer at once, and the word that is put between them.
WORDS, BETWEEN = 2_048, "|"
TAILS = ".,*#$%&!?|"
# The pattern of the tokenizer file whose matches hold no white space, and its normaliser of spaces.
WORD_PATTERN = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
SPACES = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
#: Sign of special tokens; texts that hold it are encoded whole.
SPECIAL = "<|"


def planes_of(ids: np.ndarray, kind: str = "bit") -> list[bytes]:
    """The 32 bit planes or 4 byte planes of unsigned 32-bit ids."""
    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [octets[:, i].tobytes() for i in range(4)]
    planes = []
    for column in np.ascontiguousarray(octets.T):
        if column.any():
            planes += [np.packbits(column & np.uint8(1 << i), bitorder="little").tobytes() for i in range(8)]
        else:
            planes += [bytes((len(column) + 7) // 8)] * 8
    return planes


def ids_of(planes: list[bytes], n: int) -> np.ndarray:
    """The ids behind planes_of."""
    if len(planes) == 4:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")
    octets = np.zeros((4, n), np.uint8)
    for at, plane in enumerate(planes):
        packed = np.frombuffer(plane, np.uint8)
        if packed.any():
            octets[at // 8] |= np.unpackbits(packed, count=n, bitorder="little") << np.uint8(at % 8)
    return np.ascontiguousarray(octets.T).reshape(-1).view("<u4")


class PlaneWriter:
    """Ids in, chunks out; holds less than one chunk of ids and the index."""

    def __init__(self, sink, chunk: int = CHUNK_IDS, kind: str = "bit"):
        self.sink, self.chunk, self.kind = sink, chunk, kind
        self.squeeze = zstandard.ZstdCompressor(level=LEVEL)
        self.waiting: list[np.ndarray] = []
        self.held, self.at = 0, len(MAGIC)
        self.chunks: list[list[int]] = []
        self.keys: list = []
        self.counts: list[int] = []
        sink.write(MAGIC)

    def add(self, key, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.counts.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.chunk:
            every = np.concatenate(self.waiting)
            whole = len(every) // self.chunk * self.chunk
            for start in range(0, whole, self.chunk):
                self._put(every[start : start + self.chunk])
            self.waiting, self.held = [every[whole:].copy()], len(every) - whole

    def _put(self, ids: np.ndarray) -> None:
        packed = [self.squeeze.compress(p) for p in planes_of(ids, self.kind)]
        for p in packed:
            self.sink.write(p)
        self.chunks.append([self.at, len(ids), *map(len, packed)])
        self.at += sum(map(len, packed))

    def close(self) -> None:
        if self.held:
            self._put(np.concatenate(self.waiting))
        head = json.dumps({"kind": self.kind, "chunk": self.chunk, "chunks": self.chunks, "keys": self.keys}).encode()
        index = self.squeeze.compress(len(head).to_bytes(8, "little") + head + np.array(self.counts, "<u8").tobytes())
        self.sink.write(index + len(index).to_bytes(8, "little") + MAGIC)


def read_index(file) -> tuple[dict, np.ndarray]:
    """Head and ids per document of an open file."""
    size = file.size()
    file.seek(size - 16)
    tail = file.read(16)
    if tail[8:] != MAGIC:
        raise ValueError("not a bit-plane file")
    length = int.from_bytes(tail[:8], "little")
    file.seek(size - 16 - length)
    plain = zstandard.ZstdDecompressor().decompress(file.read(length))
    end = 8 + int.from_bytes(plain[:8], "little")
    return json.loads(plain[8:end]), np.frombuffer(plain, "<u8", offset=end)


def read_chunk(file, entry: list[int]) -> np.ndarray:
    """The ids of one chunk, found through its index entry."""
    open_up = zstandard.ZstdDecompressor()
    file.seek(entry[0])
    data, planes, at = file.read(sum(entry[2:])), [], 0
    for length in entry[2:]:
        planes.append(open_up.decompress(data[at : at + length]))
        at += length
    return ids_of(planes, entry[1])


def _parts(x: dict | None, key: str) -> list[dict]:
    return [] if x is None else x.get(key, [x])


def splits_at_space(description: dict) -> bool:
    """Whether the ids of a text are those of its words between white space.

    True for tokenizers whose first pre-tokenizer keeps only matches of a
    pattern without white space, whose normalisers change no word's neighbours,
    and that add nothing of their own; any other kind is encoded whole.
    """
    changes, cuts = _parts(description["normalizer"], "normalizers"), _parts(description["pre_tokenizer"], "pretokenizers")
    plain = all(c["type"] in ("NFC", "Lowercase") or c == SPACES for c in changes) and all(t["content"].startswith(SPECIAL) for t in description["added_tokens"])
    if not cuts or not plain or description["truncation"] or description["padding"]:
        return False
    first = cuts[0]
    drops = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and first["pattern"] == WORD_PATTERN
    return drops and all(c["type"] == "ByteLevel" and not c["add_prefix_space"] and not c["use_regex"] for c in cuts[1:])


class Apart(dict):
    """Character -> whether it is a letter or digit that the tokenizer cuts off from a mark beside it.

    Not so where it puts a combining sign in the letter's place, which stays with the mark.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.normalizer, self.cutter = tokenizer.normalizer, tokenizer.pre_tokenizer

    def __missing__(self, c: str) -> bool:
        text = f"{BETWEEN}{c}{BETWEEN}"
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        pieces = [p for p, _ in self.cutter.pre_tokenize_str(text)] if self.cutter else [text]
        got = self[c] = c.isalnum() and pieces[0] == BETWEEN == pieces[-1]
        return got


class Encoder:
    """Whole texts to ids.

    For a tokenizer that never joins across white space, word chunks between
    white space are encoded once and kept; the ids of a text are those of its
    chunks.  ``by_word`` says whether the tokenizer is of that kind; left out,
    its own description decides (see ``splits_at_space``), which also says
    whether words of ASCII letters reach the tokenizer's model as they are.
    """

    def __init__(self, path: str, by_word: bool | None = None):
        # Spark already keeps every core busy.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        description = json.loads(self.tokenizer.to_str())
        self.bare = splits_at_space(description)
        self.by_word = self.bare if by_word is None else by_word
        self.lower = any(c["type"] == "Lowercase" for c in _parts(description["normalizer"], "normalizers"))
        self.model, self.apart = self.tokenizer.model, Apart(self.tokenizer)
        self.known: dict[str, bytes] = {}
        self.room = 0
        between = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None

    @classmethod
    def of_worker(cls, path: str, by_word: bool | None) -> Encoder:
        """The encoder of this Python worker, which outlives a task and keeps what it knows."""
        held = vars(sys).setdefault("_encoders", {})
        if (path, by_word) not in held:
            held[path, by_word] = cls(path, by_word)
        return held[path, by_word]

    def _plain(self, texts: list[str]) -> list[bytes]:
        # In small lots: results of the library take a hundred times the room of the ids.
        lots = (texts[i : i + WORDS] for i in range(0, len(texts), WORDS))
        return [array("I", e.ids).tobytes() for lot in lots for e in self.tokenizer.encode_batch_fast(lot, add_special_tokens=False)]

    def _words(self, words: list[str], mark: str) -> Iterator[bytes]:
        """Ids of words between white space, each on its own; a lot goes in as one text of words and marks."""
        if self.between is None:
            yield from self._plain(words)
            return
        for start in range(0, len(words), WORDS):
            lot = words[start : start + WORDS]
            ids = np.array(self.tokenizer.encode_batch_fast([mark.join(lot)], add_special_tokens=False)[0].ids, "<u4")
            data, at = ids.tobytes(), 0
            for end in (*(np.flatnonzero(ids == self.between) * 4).tolist(), len(data)):
                yield data[at:end]
                at = end + 4

    def _bare(self, word: str) -> bytes:
        """Ids of a word that normaliser and pre-tokenizer leave as it is."""
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words not yet known; marks at a word's end are looked up apart."""
        # Whole words and the pieces they are put together from, in lists of their own: tuples of them are work for the collector.
        known, apart, whole, heads, tails, pieces = self.known, self.apart, [], [], [], {""}
        for w in filter(None, words):
            # Lower-casing ASCII here only makes words meet sooner.
            head, tail = w.lower() if self.lower and w.isascii() else w, ""
            if head[-1] in TAILS and (rest := head.rstrip(TAILS)) and apart[rest[-1]]:
                head, tail = rest, head[len(rest) :]
                pieces.add(tail)
            pieces.add(head)
            if tail or head != w:
                whole.append(w)
                heads.append(head)
                tails.append(tail)
        held = {p: b for p in pieces if (b := known.get(p)) is not None}
        new, fresh = pieces.difference(held, [""]), {"": b""}
        letters = [p for p in new if p.isascii() and p.isalpha()] if self.bare else []
        fresh.update(zip(letters, map(self._bare, letters), strict=True))
        rest = new.difference(letters)
        odd = [p for p in rest if BETWEEN in p]
        joined = [p for p in rest.difference(odd) if apart[p[0]] and apart[p[-1]]]
        spaced = list(rest.difference(odd, joined))
        fresh.update(zip(odd, self._plain(odd), strict=True))
        fresh.update(zip(joined, self._words(joined, BETWEEN), strict=True))
        fresh.update(zip(spaced, self._words(spaced, f" {BETWEEN} "), strict=True))
        of = {**held, **fresh}.__getitem__
        fresh.update(zip(whole, map(operator.add, map(of, heads), map(of, tails)), strict=True))
        # What one lot brings is bounded by its texts; the table as a whole by words and bytes.
        self.room += sum(map(len, fresh)) + sum(map(len, fresh.values()))
        if len(known) + len(fresh) > CACHE or self.room > CACHE_BYTES:
            known.clear()
            self.room = 0
        else:
            known.update(fresh)
        return fresh

    def __call__(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if not self.by_word or pc.any(special := pc.match_substring(texts, SPECIAL)).as_py():
            whole = special.to_pylist() if self.by_word else [True] * len(texts)
            plain = iter(self._plain([t for t, w in zip(texts.to_pylist(), whole, strict=True) if w]))
            by_word = iter(self(texts.filter(pc.invert(special))) if self.by_word else [])
            return [np.frombuffer(next(plain), "<u4") if w else next(by_word) for w in whole]
        if self.lower:
            texts = pc.if_else(pc.string_is_ascii(texts), pc.ascii_lower(texts), texts)
        # At ASCII white space only; the tokenizer itself cuts at any other inside a word.
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, words))
        new = [i for i, b in enumerate(ids) if b is None]
        if new:
            found = self._learn([words[i] for i in new])
            for i in new:
                ids[i] = found[words[i]]
        every = pa.array(ids, pa.large_binary()).take(coded.indices)
        data = np.frombuffer(every.buffers()[2] or b"", "<u4")
        ends = np.frombuffer(every.buffers()[1], np.int64)[np.cumsum(np.concatenate([[0], pc.list_value_length(split)]))] // 4
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _lots(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and number of rows of neighbours that together hold LOT_BYTES, or one longer text more."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // LOT_BYTES)) + 1).tolist(), len(ends)]
    return ((a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, order_by: list, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, chunk: int = CHUNK_IDS, kind: str = "bit", by_word: bool | None = None) -> DataFrame:
    """Write the ids of all rows in the order given; returns the manifest.

    The manifest (file_no, file, n_docs, n_ids, first) is a written table; first
    is the number of ids in all files before.  Each file holds one range of the
    order.  A null text is an empty one and has just the end id; null keys are
    kept as null; an empty table has no files.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[c.alias(f"o{i}") for i, c in enumerate(order_by)])
    # The hash of the text makes equal keys divisible and their order definite.
    order = [*[f"o{i}" for i in range(len(order_by))], "tie"]
    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("file_no"), "doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out = None, None
        for batch in batches:
            for start, rows_ in _lots(batch.column(2)):
                part = batch.slice(start, rows_)
                if out is None:
                    encode = Encoder.of_worker(tokenizer, by_word)
                    store, at = store_of(folder)
                    file_no, name = part.column(0)[0].as_py(), f"ids-{uuid.uuid4().hex}.bpl"
                    store.create_dir(at, recursive=True)
                    sink = store.open_output_stream(f"{at}/{name}", compression=None)
                    out, total = PlaneWriter(sink, chunk, kind), 0
                for key, ids in zip(part.column(1).to_pylist(), encode(part.column(2)), strict=True):
                    ids = np.append(ids, np.uint32(end_id))
                    total += len(ids)
                    out.add(key, ids)
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"file_no": pa.array([file_no], pa.int32()), "file": [name], "n_docs": pa.array([len(out.keys)], pa.int64()), "n_ids": pa.array([total], pa.int64())})

    files = staged(ranged.mapInArrow(write, "file_no int, file string, n_docs bigint, n_ids bigint"), "files")
    before = Window.partitionBy(F.lit(0)).orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return staged_path(files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("bigint")), f"{folder}.manifest")


def read_token_files(manifest: DataFrame, folder: str, key_type: str = "bigint", with_ids: bool = False) -> DataFrame:
    """Documents back from the files: doc_id, start, n_tokens, ids_crc32 (and ids).

    A task holds one chunk; a document over many chunks is checked in passing.
    """
    spark = manifest.sparkSession
    tasks = max(1, spark.sparkContext.defaultParallelism * 4)
    kind = pa.int64() if key_type == "bigint" else pa.string()

    def documents(name: str, first: int) -> Iterator[tuple]:
        store, at = store_of(folder)
        with store.open_input_file(f"{at}/{name}") as file:
            head, counts = read_index(file)
            left, entries = np.empty(0, "<u4"), iter(head["chunks"])
            for key, n in zip(head["keys"], counts.tolist(), strict=True):
                crc, need, ids = 0, n, []
                while need:
                    if not len(left):
                        left = read_chunk(file, next(entries))
                    take = left[:need]
                    left, need = left[len(take) :], need - len(take)
                    crc = zlib.crc32(take.tobytes(), crc)
                    if with_ids:
                        ids.append(take)
                yield (key, first, n, crc, np.concatenate(ids) if ids else None)
                first += n

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
                lot = []
                for found in documents(name, first):
                    lot.append(found)
                    if len(lot) == (64 if with_ids else 8192):
                        yield pack(lot)
                        lot = []
                if lot:
                    yield pack(lot)

    def pack(lot: list[tuple]) -> pa.RecordBatch:
        key, start, n, crc, ids = zip(*lot, strict=True)
        columns = [pa.array(key, kind), *(pa.array(x, pa.int64()) for x in (start, n, crc))]
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        if with_ids:
            columns, names = [*columns, pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))], [*names, "ids"]
        return pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return manifest.repartition(tasks, "file").mapInArrow(read, schema)


def encode_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, order_by: list | None = None, **options) -> DataFrame:
    """Write the files below the shared folder and read them back: doc_id, start, n_tokens, ids_crc32.

    One row per input row, in ascending order of ``order_by``, by default of the
    id (null ids first); ties are ordered by a hash of the text.  A null or
    empty text has just the end id; an empty table gives no rows.
    """
    folder = new_folder(spark, "token-files")
    manifest = write_token_files(docs, folder, tokenizer, order_by or [F.col("doc_id")], **options)
    return read_token_files(manifest, folder)
