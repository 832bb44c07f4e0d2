import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagelathe.llm import decontaminate as dc

WORDS = [f"v{i}" for i in range(500)]


def grams(text):
    w = re.findall(r"\w+", (text or "").lower())
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def by_hand(docs, items):
    out = {}
    for d, text in docs:
        g = grams(text)
        for i, item in items:
            own = grams(item)
            k, c = len(own), Counter(own)
            best = (0.0, 0)
            for s in range(len(g) if k else 0):
                part = g[s : s + k]
                o = sum((Counter(part) & c).values())
                best = max(best, (o / (k + len(part) - o), -s))
            if best[0] >= 0.8 - 1e-9:
                out[d, i] = (round(best[0], 9), -best[1])
    return out


def test_exact_edited_and_odd_passages(spark, documents, odd):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choices(WORDS, k=n))) for i, n in enumerate((5, 6, 20, 40, 41, 90, 300, 4, 0))] + [(90, None), (91, "a b c d e a b c d e a b c d e")]
    texts = []
    for _, item in items[:7] * 6:
        w = item.split()
        for _ in range(rng.randrange(3)):
            if len(w) > 30:
                w[rng.randrange(len(w))] = "other"
        pad = lambda: " ".join(rng.choices(WORDS, k=rng.randrange(30)))
        texts.append(f"{pad()} {' '.join(w).upper()}. {pad()}")
    texts += ["x a b c d e a b c d e a b c d e y", "a b c d e", items[3][1], items[3][1] + " " + items[3][1]]
    docs = documents(*[(100 + i, t, "s") for i, t in enumerate(texts)])
    both = docs.unionByName(odd)
    rows = dc.numbered(both)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = rows.join(dc.contaminated(rows, bench), "no").select("row.doc_id", "item_id", "similarity", "start").collect()
    wanted = by_hand([(r.doc_id, r.text) for r in docs.collect()], items)
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start) for r in found}
    assert len(got) == len(found)
    missed = set(wanted) - set(got)
    # Only pairs that are far from equal may lie outside the radius.
    assert len(missed) <= 1 and all(wanted[m][0] < 0.9 for m in missed)
    assert {k: v[0] for k, v in got.items()} == {k: wanted[k][0] for k in got}
    assert len(wanted) > 30


@pytest.mark.parametrize("lane", [8, 16, 32])
def test_fingerprints_do_not_depend_on_lanes(spark, lane):
    rng = random.Random(1)
    values = [rng.randrange(-(2**63), 2**63) for _ in range(41)]
    majority = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))
    frame = spark.createDataFrame([(values,)], "h array<bigint>")
    assert frame.select(dc.fingerprint(F.col("h"), lane).alias("p")).first().p & (2**64 - 1) == majority


def test_blocks_find_every_fingerprint_in_the_radius(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(200):
        a, b = rng.getrandbits(64), 0
        for bit in rng.sample(range(64), dc.RADIUS):
            b |= 1 << bit
        rows.append(tuple(x - (x >> 63 << 64) for x in (a, a ^ b)))
    frame = spark.createDataFrame(rows, "a bigint, b bigint").select(dc.block_keys(F.col("a")).alias("a"), dc.block_keys(F.col("b")).alias("b"))
    for r in frame.collect():
        assert any((x.value ^ y.value).bit_count() <= dc.RADIUS // dc.BLOCKS for x, y in zip(r.a, r.b, strict=True))


def test_empty_tables(spark, odd):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert dc.contaminated(dc.numbered(odd), none).count() == 0
    assert dc.contaminated(dc.numbered(odd.limit(0)), some).count() == 0
