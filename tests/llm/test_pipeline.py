"""The pipeline on the smallest tables, stage by stage against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from pagelathe.llm.common import staged
from pagelathe.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def test_columns(stages):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality_keeps_good_labels(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    every = {r.doc_id for r in stages[0].collect()}
    good = {i for i, q in labels.items() if q == 1 and i in every}
    poor = {i for i, q in labels.items() if q == 0 and i in every}
    assert len(good & kept) >= 0.97 * len(good) and len(poor & kept) <= 0.2 * len(poor)


def grams(text):
    w = re.findall(r"\w+", (text or "").lower())
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def test_one_of_each_group_stays(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    sets = {i: set(grams(t)) for i, t in rows}
    index, root = defaultdict(list), {i: i for i, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, _ in rows:
        shared = Counter(j for g in sets[i] for j in index[g])
        for j, o in shared.items():
            if o >= 0.8 * (len(sets[i]) + len(sets[j]) - o) - 1e-9:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for g in sets[i]:
            index[g].append(i)
    assert {r.doc_id for r in stages[2].collect()} == {i for i, _ in rows if find(i) == i}


def test_no_benchmark_passage_stays(spark, stages):
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: f" {' '.join(re.findall(r'\w+', (r.text or '').lower()))} " for r in stages[2].collect()}
    clean = {i for i, t in rows.items() if not any(f" {x} " in t for x in items)}
    assert {r.doc_id for r in stages[3].collect()} == clean < set(rows)


def test_mix_keeps_rows_and_tokens_follow_it(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    before = Counter(tuple(r) for r in stages[3].collect())
    mixed = stages[4].select("*", "_metadata.file_name", "_metadata.row_index").collect()
    assert Counter(tuple(r)[:-2] for r in mixed) == before
    mixed.sort(key=lambda r: (r.file_name, r.row_index))
    found = sorted(stages[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [r.doc_id for r in mixed]
    start = 0
    for row, r in zip(mixed, found, strict=True):
        ids = tokenizer.encode(row.text or "", add_special_tokens=False).ids + [1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len({r.source for r in mixed[:96]}) > 1


def test_tokens_of_rows_that_are_not_from_files(spark, documents):
    docs = documents((2, "b", "s"), (1, None, "s"))
    found = sorted(corpus_pipeline.write_tokens(spark, docs, SF).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens) for r in found] == [(1, 1), (2, 2)]
