import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pagelathe.llm import alignment
from pagelathe.llm.queries import op12_token_alignment, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def byte_of_sign():
    table, extra = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            table[chr(b)] = b
        else:
            table[chr(extra)] = b
            extra += 1
    return table


def spans(texts):
    """(id, from, to) of the tokens of each text on both sides, by the libraries' plain calls."""
    import sentencepiece
    from tokenizers import Tokenizer

    t, sp, signs = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_of_sign()
    t.encode_special_tokens = True
    for text in texts:
        sides, want = [], (" " + (text or "")).encode()
        a = t.encode(" " + (text or ""), add_special_tokens=False).ids
        b = sp.encode(text or "")
        piece = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
        for ids, of in ((a, lambda i: bytes(signs[c] for c in t.id_to_token(i))), (b, piece)):
            at, side = 0, []
            for i in ids:
                side.append((i, at, at + len(of(i))))
                at += len(of(i))
            sides.append((side, b"".join(of(i) for i in ids)))
        yield ([], []) if not text or sides[0][1] != want or sides[1][1] != want else (sides[0][0], sides[1][0])


def by_hand(rows):
    aligned = list(spans([t for _, t in rows]))
    every = [[(x, y) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in aligned]
    counts = Counter((x[0], y[0]) for links in every for x, y in links)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for (doc_id, _), (a, b), links in zip(rows, aligned, every, strict=True):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, at = [], 0
        for cut in cuts:
            inside = [[str(x[0]) for x in side if at < x[2] <= cut] for side in (a, b)]
            groups.append((inside, len(inside[0]) * len(inside[1])))
            at = cut
        told = ";".join("|".join(",".join(side) for side in g) for g, _ in groups)
        of = [counts[x[0], y[0]] for x, y in links]
        best = sum(counts[x[0], y[0]] == highest[y[0]] for x, y in links)
        out.append((doc_id, len(a), len(b), len(cuts), len(links), best, sum(of), hashlib.sha256(told.encode()).hexdigest() if a else "", sum(n for _, n in groups)))
    return sorted(out, key=repr)


ODD = ["", None, "  two  spaces \n line ﬁ ", "▁ sign", "<s> </s> <unk> <|endoftext|> <0x41>", "a\x00b\ttab\r\n", "𝄞 musique ünïcödé 日本語テキスト", "'s 're don't 12345 67", "z" * 3_000, " ", "\n", "é" * 700, "word " * 400]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["alpha", "beta", "Gamma", "unhappily", "x1", "naïve", "Straße", "…", "tokenisation", "of"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(30)]
    return list(enumerate([*ODD, *made, made[0], ODD[4]])) + [(None, "alpha beta"), (3, "alpha beta"), (3, "alpha beta")]


def aligned(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id bigint, text string, no string, links string, a bigint").repartition(3)
    return sorted((tuple(r) for r in alignment.align(table, A, B, **options).collect()), key=repr)


def test_against_all_pairs(spark, rows):
    assert aligned(spark, rows) == by_hand(rows)


def test_without_a_broadcast(spark, rows):
    assert aligned(spark, rows, few_pairs=3) == by_hand(rows)


def test_no_rows(spark):
    assert aligned(spark, []) == []


def test_small_tiles(monkeypatch, rows):
    lot = alignment.Lot(alignment.Aligner.of_worker(A, B), [t or "" for _, t in rows])
    small = alignment.linked(*lot.ends, lot.cuts, tile=7)
    assert all((x == y).all() for x, y in zip(small, lot.links, strict=True)) and len(small[0])


def test_same_ids_without_the_quick_library(rows):
    a = alignment.ByteBpe(A)
    texts = [t for _, t in rows if t]
    quick = a(texts)
    assert a.quick is not None
    a.quick = None
    assert a(texts) == quick


def test_products_of_random_matrices():
    rng = np.random.default_rng(4)
    for _ in range(20):
        x, y = (rng.integers(0, 3, s) * (rng.random(s) < 0.4) for s in ((7, 11), (11, 5)))
        made = []
        for m in (x, y):
            made.append(alignment.Csr(np.concatenate([[0], np.cumsum((m != 0).sum(1))]), np.nonzero(m)[1], m[m != 0], m.shape[1]))
        product = made[0].times(made[1])
        dense = np.zeros((7, 5), int)
        dense[product.rows(), product.columns] = product.values
        assert (dense == x @ y).all()
        assert (made[0].transposed().transposed().columns == made[0].columns).all()


def test_the_alignments_themselves(spark, rows):
    table = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = alignment.alignments(table, A, B).collect()
    for r, (a, b) in zip(found, spans([t for _, t in rows]), strict=True):
        assert [*zip(r.a_ids, r.a_ends)] == [(i, e) for i, _, e in a] and [*zip(r.b_ids, r.b_ends)] == [(i, e) for i, _, e in b]
        if len(a) < 500:
            overlap = [(i, k, min(x[2], y[2]) - max(x[1], y[1])) for i, x in enumerate(a) for k, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]]
            assert [tuple(x) for x in r.links] == overlap
            home = lambda end: sum(c < end for c in r.cuts)
            assert [tuple(x) for x in r.shared] == [(i, k) for i, x in enumerate(a) for k, y in enumerate(b) if home(x[2]) == home(y[2])]


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    small = [r for r in rows if len(r[1] or "") < 3_000]
    found = {r[0]: tuple(r) for r in op12_token_alignment(spark, folder).collect()}
    assert len(found) == len(rows)
    for mine in by_hand(small):
        # Counts are over the whole table, the rest is each text's own.
        assert found[mine[0]][:5] == mine[:5] and found[mine[0]][7:] == mine[7:]
