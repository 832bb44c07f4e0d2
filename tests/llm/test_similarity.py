"""The n-gram join and the line dedup against brute force."""

import functools
import random
import re
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from pyspark.sql import functions as F

from pagelathe.llm import common, line_dedup, minhash, ngram_join
from pagelathe.llm.common import staged
from pagelathe.llm.words import WordHashes, word_shingles

WORDS = [f"w{i}" for i in range(2_000)]


def groups_of(sets, threshold=0.8):
    """Links and group of every set."""
    root, links = list(range(len(sets))), Counter()

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return links, [find(i) for i in range(len(sets))]


def near_copies(rng, n_groups, copies, length):
    rows = []
    for _ in range(n_groups):
        base = [rng.choice(WORDS) for _ in range(length)]
        for c in range(copies):
            text = list(base)
            for _ in range(c % 4):
                text[rng.randrange(length)] = rng.choice(WORDS)
            rows.append(" ".join(text))
    return rows


def shingles(text):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def check_documents(docs):
    rows = docs.collect()
    known = [r for r in rows if r.doc_id is not None]
    links, root = groups_of([shingles(r.text) for r in rows])
    order = lambda i: (rows[i].doc_id is None, rows[i].doc_id or 0)
    members = defaultdict(list)
    for i, r in enumerate(root):
        members[r].append(i)
    wanted = Counter((rows[i].doc_id, links[i], rows[min(members[root[i]], key=order)].doc_id) for i in range(len(rows)))
    found = ngram_join.link_documents(docs).select("row.doc_id", "n_links", "class_id", "first").collect()
    assert Counter((r.doc_id, r.n_links, r.class_id) for r in found) == wanted
    assert sum(r["first"] for r in found) == len(members)
    assert len(known) <= len(found)
    assert all(r.doc_id == r.class_id for r in found if r["first"])


def test_odd_rows(odd):
    check_documents(odd)


def test_many_near_copies_in_small_blocks(documents, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ITEMS", 5)
    rng = random.Random(3)
    texts = near_copies(rng, 12, 4, 60) + near_copies(rng, 1, 40, 90) + [" ".join(rng.choices(WORDS, k=50)) for _ in range(60)]
    check_documents(documents(*[(i, t, "s") for i, t in enumerate(texts)]))


def test_bands_reach_their_recall():
    for threshold, recall, rows in ((0.8, 0.999, 6), (0.8, 0.99, 4), (0.5, 0.9, 3)):
        bands = minhash.bands_for(threshold, recall, rows)
        assert 1 - (1 - threshold**rows) ** bands >= recall > 1 - (1 - threshold**rows) ** (bands - 1)
    # Pairs at exactly 0.8: 80 of 100 shingles shared.
    rng, hits = np.random.default_rng(1), 0
    for _ in range(200):
        h = rng.integers(0, 2**63, 100, dtype=np.uint64)
        a, b = (minhash.band_keys(minhash.permuted(x, 144)[None, :], 6)[0] for x in (h[:90], h[10:]))
        hits += bool(set(a.tolist()) & set(b.tolist()))
    assert hits >= 198


def test_signatures_of_runs_are_those_of_single_sets():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 5, 300)]
    runs = minhash.permuted_runs(np.concatenate(sets), np.array([0, 1, 6]), 8)
    assert runs.tolist() == [minhash.permuted(s, 8).tolist() for s in sets]


def test_word_shingles():
    cache = WordHashes()
    assert len(word_shingles("", 5, cache)) == len(word_shingles(" .,", 5, cache)) == 0
    assert len(word_shingles("One two", 5, cache)) == 1
    assert word_shingles("A b c d e f", 5, cache).tolist() == word_shingles("a, B; c d-e f!", 5, cache).tolist()


def test_similar_lines_of_one_lot_are_those_of_their_sets():
    rng = random.Random(6)
    lines = ["a", "ab", "abababababab", "ab" * 9, *("".join(rng.choices("abcd ", k=rng.choice((20, 60, 200)))) for _ in range(30))]
    lines += [x[:-1] + "z" for x in lines[4:]] + [x + x for x in lines[4:8]]
    for some in (lines, lines[4:], lines[:1]):
        sets = [{x[i : i + 8] for i in range(max(1, len(x) - 7))} for x in some]
        wanted = np.array([[len(a & b) >= 0.8 * len(a | b) - 1e-9 for b in sets] for a in sets])
        # What a line is to itself is not looked at.
        away = ~np.eye(len(some), dtype=bool)
        assert ((line_dedup._similar(8, 0.8)(some) == wanted) | ~away).all() and (len(some) == 1 or (wanted & away).any())


def test_white_space_of_lines(spark):
    lines = [" a  b ", "\ta\tb\r", "a\x0b\fb", "A\t B", "a b", "", " \t ", "É\u00a0 x"]
    found = spark.createDataFrame([(x,) for x in lines], "line string").select(line_dedup.normal_line(F.col("line"))).collect()
    assert [r[0] for r in found] == ["a b"] * 5 + ["", "", "é\u00a0 x"]


def test_case_of_a_whole_text_is_that_of_its_lines(spark):
    text = "ΑΣ\nΑΣ\tΑ\n ΑΣ \x0bΣΑ\rΣ\nİI\n\u0307ÀÉ ß\nΣ\n\nΣ"
    line = F.col("line")
    found = spark.createDataFrame([(text,)], "text string").select(F.posexplode(F.arrays_zip(F.split("text", "\n").alias("line"), F.split(F.lower("text"), "\n").alias("low")))).select("col.*")
    for r in found.select(line_dedup.normal_line(line).alias("a"), line_dedup.spaced_line(F.col("low")).alias("b")).collect():
        assert r.a == r.b


def check_lines(docs):
    norm = lambda x: re.sub(r"\s+", " ", x.lower()).strip()
    rows = docs.collect()
    where, sets = [], []
    for n, r in enumerate(rows):
        for i, x in enumerate((r.text or "").split("\n")):
            if norm(x):
                where.append((n, i))
                sets.append({norm(x)[j : j + 8] for j in range(max(1, len(norm(x)) - 7))})
    _, root = groups_of(sets)
    found = line_dedup.dedup_lines(docs).collect()
    assert Counter((r.doc_id, r.n_lines) for r in found) == Counter((r.doc_id, (r.text or "").count("\n") + 1) for r in rows)
    assert all(r.n_kept == r.n_lines - len(r.dropped) and r.dropped == sorted(set(r.dropped)) for r in found)
    # One line stays of every group, whichever row comes first.
    assert sum(len(r.dropped) for r in found) == len(where) - len(set(root))
    return rows, where, root, found


def test_lines_of_odd_rows(documents):
    check_lines(documents((1, None, "a"), (2, "", "a"), (None, "A line of text that is here\n\n a  line of text that is HERE ", "a"), (3, "a line of text that is here\nab\nAB\nabc", None), (3, "ab", "a"), (4, "x" * 50_000 + "\n" + "x" * 50_001, "a")))


def test_fuzzy_lines(spark, documents):
    rng = random.Random(4)
    lines = near_copies(rng, 25, 4, 24) + ["hot line that is everywhere, really"] * 40
    rng.shuffle(lines)
    docs = documents(*[(i, "\n".join(lines[i * 7 : i * 7 + 7]), "s") for i in range(20)])
    docs = staged(docs.coalesce(1).sortWithinPartitions("doc_id"), "docs")
    rows, where, root, found = check_lines(docs)
    first = {}
    for at, r in zip(where, root, strict=True):
        first.setdefault(r, at)
    gone = defaultdict(list)
    for at, r in zip(where, root, strict=True):
        if first[r] != at:
            gone[rows[at[0]].doc_id].append(at[1])
    assert {r.doc_id: r.dropped for r in found} == {r.doc_id: gone[r.doc_id] for r in rows}
    kept = docs.join(spark.createDataFrame(found), "doc_id").select("text", line_dedup.kept_text(docs.text, "dropped").alias("kept"), "n_kept").collect()
    assert all(len(r.kept.split("\n")) == max(r.n_kept, 1) for r in kept)


def test_texts_of_lines_are_kept_once_and_shuffles_go_with_their_step(spark, monkeypatch, tmp_path):
    rng = random.Random(8)
    rows = [(i, "\n".join(" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(20)) for _ in range(60))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    chars = sum(len(text) for _, text in rows)
    local = [Path(x) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    shuffles = lambda: {f for at in local for f in at.rglob("shuffle_*")}
    others, most = shuffles(), {}

    def watched(write):
        def written(df, name, *more):
            out = write(df, name, *more)
            until = time.time() + 20  # executors delete on their own time
            while shuffles() - others and time.time() < until:
                time.sleep(0.1)
            assert not shuffles() - others, name
            most[name] = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
            return out

        return written

    monkeypatch.setattr(common, "scratch_folder", lambda _: str(tmp_path))
    for module, name in ((line_dedup, "staged"), (line_dedup, "staged_by"), (minhash, "staged")):
        monkeypatch.setattr(module, name, watched(getattr(common, name)))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    found = line_dedup.dedup_lines(docs)
    assert spark.conf.get(setting) == before
    assert [r.n_kept for r in found.collect()] == [60] * 120 == [r.n_lines for r in found.collect()]
    # A letter of eight takes 3 bits or more, a line two digests and 9 bands besides; a second copy of the texts has no room.
    assert most["lines"] < 0.85 * chars and max(most.values()) < 1.4 * chars


@pytest.mark.parametrize("which", [ngram_join.link_documents, line_dedup.dedup_lines])
def test_empty_table(odd, which):
    assert which(odd.limit(0)).count() == 0


def test_the_kept_line_does_not_depend_on_the_layout(spark):
    line = "the very same line stands in every one of these documents and only one of them keeps it"
    rows = [(i, f"{line}\nnumber {i * 7919} has a line of its own that nobody else holds at all") for i in range(20)]
    for order in (rows, rows[::-1], rows[7:] + rows[:7]):
        found = line_dedup.dedup_lines(spark.createDataFrame(order, "doc_id bigint, text string").coalesce(1)).collect()
        assert {r.doc_id: list(r.dropped) for r in found} == {i: [0] if i else [] for i in range(20)}


def test_rolling_hashes_are_polynomials():
    from pagelathe.llm import words

    h = np.random.default_rng(1).integers(0, 2**63, 40).astype(np.uint64)
    for n in (1, 2, 5, 8, 13, 40, 41):
        with np.errstate(over="ignore"):
            step_by_step = [functools.reduce(lambda total, x: total * words.STEP + x, h[i : i + n]) + words.MIX for i in range(len(h) - n + 1)]
        assert words.rolling(h, n).tolist() == words.mixed(np.array(step_by_step, np.uint64)).tolist()
