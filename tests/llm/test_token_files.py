import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelathe.llm import token_files as tf
from pagelathe.llm.common import new_folder
from pagelathe.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=200), st.sampled_from(["bit", "byte"]))
def test_planes_round_trip(ids, kind):
    array = np.array(ids, "<u4")
    planes = tf.planes_of(array, kind)
    assert len(planes) == (32 if kind == "bit" else 4)
    assert tf.ids_of(planes, len(array)).tolist() == ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("aΣσςÉé .*%'\n\t|<>\x1c　Ⅷ½3x", max_size=40))
def test_word_by_word_equals_whole_texts(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert tf.Encoder.of_worker(tokenizer_path(), True)([text])[0].tolist() == whole


def test_special_strings(tokenizer):
    for text in ("a <|endoftext|> b", "x<|startoftext|>y", "<|EndOfText|>"):
        assert tf.Encoder(tokenizer_path())([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_tokenizer_that_keeps_white_space_gets_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    encode = tf.Encoder(path)
    assert not encode.by_word and tf.Encoder(tokenizer_path()).by_word
    for text in ("two words", " a  b\n", "x | y|z", ""):
        assert encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_the_table_of_words_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "CACHE_BYTES", 2_000)
    monkeypatch.setattr(tf, "WORDS", 3)
    encode = tf.Encoder(tokenizer_path())
    for n in range(60):
        texts = [f"word{n} shared, mark| a|b {'x' * 90}{n} |", "shared, again...", "", "| || |."]
        for text, ids in zip(texts, encode(texts), strict=True):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert sum(map(len, encode.known)) <= 2_000


def test_a_letter_that_ends_in_a_combining_sign_keeps_its_marks(tokenizer):
    for text in ("İ, x", "aİ.", "İ", "|İ", "क़| क़,", "İ,İ, é, É. été,", "The THE the. THE."):
        assert tf.Encoder(tokenizer_path())([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_tokenizer_that_tells_case_apart(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(tokenizer_path()) as file:
        cased = json.load(file)
    cased["normalizer"] = {"type": "NFC"}
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(cased))
    encode, whole = tf.Encoder(str(path)), Tokenizer.from_file(str(path))
    text = "The THE the, Word word WORD."
    assert encode.by_word
    assert encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_a_lot_asks_once_for_each_distinct_word(tokenizer):
    class Counted(dict):
        asked = 0

        def get(self, word):
            Counted.asked += 1
            return super().get(word)

    encode = tf.Encoder(tokenizer_path())
    encode(["the same words"])
    encode.known = Counted(encode.known)
    texts = ["the same words " * 500] * 20 + ["", " the\xa0same\x85words\t", "Same É words"]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert Counted.asked < 50
    mixed = ["the <|endoftext|> same", *texts[-2:], "<|x|>"]
    assert [ids.tolist() for ids in encode(mixed)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in mixed]


def test_lots_of_bounded_size(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tf, "LOT_BYTES", 10)
    sizes = [3, 3, 3, 3, 25, 0, 0, 9, 1, 40]
    lots = list(tf._lots(pa.array(["x" * n for n in sizes])))
    assert [a for a, _ in lots] == np.cumsum([0, *(n for _, n in lots[:-1])]).tolist() and sum(n for _, n in lots) == len(sizes)
    assert all(sum(sizes[a : a + n]) - max(sizes[a : a + n]) <= 10 for a, n in lots)


class Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_writer_and_index():
    out = Memory()
    writer = tf.PlaneWriter(out, chunk=16)
    lists = [np.arange(n, dtype="<u4") * 70_000 for n in (3, 0, 40, 13)]
    for key, ids in enumerate(lists):
        writer.add(key, ids)
    writer.close()
    head, counts = tf.read_index(out)
    assert head["keys"] == [0, 1, 2, 3] and counts.tolist() == [3, 0, 40, 13]
    assert [c[1] for c in head["chunks"]] == [16, 16, 16, 8]
    assert np.concatenate([tf.read_chunk(out, c) for c in head["chunks"]]).tolist() == np.concatenate(lists).tolist()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_files_hold_all_documents_in_order(spark, odd, tokenizer, kind):
    folder = new_folder(spark, "ids")
    manifest = tf.write_token_files(odd, folder, tokenizer_path(), [F.col("doc_id")], chunk=1000, kind=kind)
    found = tf.read_token_files(manifest, folder, with_ids=True).orderBy("start").collect()
    texts = {}
    for r in odd.collect():
        texts.setdefault(r.doc_id, []).append(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1])
    keys = [r.doc_id for r in found]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k) and len(keys) == 13
    start = 0
    for r in found:
        texts[r.doc_id].remove(r.ids)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        start += len(r.ids)
    assert not any(texts.values())


def test_empty_table(spark, odd):
    assert tf.encode_documents(spark, odd.limit(0), tokenizer_path()).count() == 0
