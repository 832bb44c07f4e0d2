import hashlib
from collections import Counter

from pagelathe.llm.exact_dedup import mark_duplicates

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def check(docs, **options):
    rows = [(r.doc_id, (r.text or "").translate(ASCII)) for r in docs.select("doc_id", "text").collect()]
    groups = Counter(t for _, t in rows)
    best = {}
    for i, t in rows:
        best[t] = max(best.get(t, -1), -1 if i is None else i)
    found = mark_duplicates(docs, **options).collect()
    wanted = Counter((i, None if best[t] < 0 else best[t], groups[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == wanted
    kept = [r for r in found if r.kept]
    assert len(kept) == len(groups) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_odd_rows(odd):
    check(odd)


def test_hot_digests_with_few_counters(documents):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i // 2}", "s") for i in range(600)]
    check(documents(*rows))
    check(documents(*rows), heavy=2, counters=16)


def test_empty_table(documents, odd):
    assert mark_duplicates(odd.limit(0)).count() == 0
