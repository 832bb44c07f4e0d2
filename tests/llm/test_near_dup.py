import random
import re

import numpy as np
import pytest

from pagelathe.llm import near_dup


def by_hand(rows, percent=85, words=5):
    sets = []
    for _, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(found[i : i + words]) for i in range(max(len(found) - words, 0) + 1)} if found else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    order = lambda x: (x is None, x or 0)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id, key=order)
    return sorted(((d, len(s), least[find(i)], d == least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def near(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, "x", None) for r in rows], "doc_id bigint, text string, uid bigint, key string, bits string").repartition(3)
    return sorted((tuple(r) for r in near_dup.near_duplicates(table, **options).collect()), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def rows():
    """Groups of edits around the threshold, chains, copies, nothing at all."""
    rng = random.Random(11)
    made = []
    for _ in range(12):
        base = [f"w{rng.randrange(5_000)}" for _ in range(rng.randrange(30, 400))]
        made += [" ".join(edited(rng, base, rng.randrange(0, 1 + len(base) // 25))) for _ in range(9)]
    chain = [f"c{i}" for i in range(200)]
    for _ in range(14):
        made.append(" ".join(chain))
        chain = chain[3:] + [f"c{rng.randrange(10**6)}" for _ in range(3)]
    rng.shuffle(made)
    odd = [None, "", " \t\n", "one two", "ONE\ttwo", "one two three four five", "É é", "é É", "a\x1cb c d e f", "z " * 20_000]
    return [*enumerate([*made, *odd, made[0], made[3].upper()]), (None, made[5]), (None, "alone " * 9), (4, made[4]), (4, made[4])]


def test_against_all_pairs(spark, rows):
    found = near(spark, rows)
    assert found == by_hand(rows)
    assert sum(r[3] for r in found) < len(found)


def test_small_blocks_and_another_threshold(spark, rows, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_ITEMS", 4)
    monkeypatch.setattr(near_dup, "SET_ITEMS", 5)
    assert near(spark, rows, percent=90, words=3) == by_hand(rows, 90, 3)


def test_later_rounds_find_what_the_first_of_a_band_misses(spark):
    # A ring around a middle that comes first: items link to their neighbours, few to the middle.
    rng = random.Random(2)
    middle = [f"m{i}" for i in range(300)]
    rows = [(0, " ".join(middle))]
    for ring in range(4):
        own = edited(rng, middle, 14)
        rows += [(1 + 30 * ring + i, " ".join(edited(rng, own, 2))) for i in range(30)]
    assert near(spark, rows) == by_hand(rows)


def test_no_rows(spark):
    assert near(spark, []) == []
    assert near(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_estimates_are_unbiased():
    rng = np.random.default_rng(1)
    for shared in (0, 300, 600, 900):
        guessed = []
        for _ in range(40):
            h = rng.integers(0, 2**63, 2_000 - shared).astype(np.uint64)
            bits = [near_dup.packed_bits(near_dup.minima(np.unique(x))).view(np.uint64) for x in (h[:1_000], h[1_000 - shared :])]
            x = bits[0] ^ bits[1]
            same = near_dup.MINIMA - int(np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(near_dup.LOW_BITS)).sum())
            guessed.append((same / near_dup.MINIMA - 0.25) / 0.75)
        assert abs(np.mean(guessed) - shared / (2_000 - shared)) < 0.03
        assert np.std(guessed) < 0.06
