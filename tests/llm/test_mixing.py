from collections import Counter

import pytest

from pagelathe.llm.mixing import mix, period_schedule, schedule, slots_per_period


def by_hand(slots, period):
    done, order = [0] * len(slots), []
    for t in range(period):
        due = [(-(-(done[i] + 1) * period // a), i) for i, (_, a) in enumerate(slots) if done[i] * period // a <= t]
        i = min(due)[1]
        order.append((t, slots[i][0], done[i]))
        done[i] += 1
    return order


def test_schedule_is_earliest_deadline_first_and_within_one_block(spark):
    slots = [("a", 37), ("b", 11), ("c", 2), ("d", 50)]
    found = period_schedule(spark.createDataFrame(slots, "source string, slots bigint"), 100).collect()
    assert [(r.slot, r.source, r.nth) for r in sorted(found)] == by_hand(slots, 100)
    for r in found:
        for (_, a), before in zip(slots, r.before, strict=True):
            assert abs(before - a * r.slot / 100) < 1


def test_slots_add_up(spark):
    weights = spark.createDataFrame([("a", 1_000_000), ("b", 1), ("c", 0), ("d", 333_333)], "source string, weight bigint")
    found = {r.source: r.slots for r in slots_per_period(weights, 100).collect()}
    assert sum(found.values()) == 100 and set(found) == {"a", "b", "d"} and found["b"] >= 1


def test_positions_follow_the_slots(spark, documents):
    docs = documents(*[(i, "t", "hot" if i % 3 else f"s{i % 5}") for i in range(700)])
    weights = spark.createDataFrame([("hot", 2), ("s0", 1), ("s1", 1), ("s2", 4), ("s3", 1)], "source string, weight bigint")
    found = mix(docs, weights, block=8, period=20).select("row.doc_id", "source", "block_no", "slot", "position").collect()
    assert sorted(r.position for r in found) == list(range(700))
    known = [r for r in found if r.slot is not None]
    assert {r.source for r in found if r.slot is None} == {"s4"}
    order = sorted(known, key=lambda r: r.position)
    assert [r.slot for r in order] == sorted(r.slot for r in order)
    assert min(r.position for r in found if r.source == "s4") == len(known)
    # While nobody has run out, shares hold to within one block.
    share = {s.source: s.slots / 20 for s in slots_per_period(weights, 20).collect()}
    sizes, seen = Counter(r.source for r in found), Counter()
    blocks = sorted({(r.slot, r.source) for r in known})
    for slot, source in blocks:
        if any((seen[s] + 1) * 8 > sizes[s] for s in share):
            break
        seen[source] += 1
        assert all(abs(seen[s] - share[s] * (slot + 1)) < 1 for s in share)


def test_odd_rows(odd):
    found = mix(odd)
    rows = found.collect()
    assert sorted(r.position for r in rows) == list(range(13))
    assert Counter(r.row.asDict()["text"] for r in rows) == Counter(r.text for r in odd.collect())
    assert mix(odd.limit(0)).count() == 0


def test_too_many_sources(documents):
    with pytest.raises(ValueError):
        mix(documents(*[(i, "t", str(i)) for i in range(12)]), period=10)


def test_shares_are_those_of_the_weights_far_beyond_1000_slots(spark):
    for weights in ([("hot", 305), *[(f"s{i:02}", 91 + i % 3) for i in range(19)], ("t", 1)], [("a", 9_001), ("b", 2_011), ("c", 7), ("d", 1)]):
        total = sum(w for _, w in weights)
        found = schedule(spark.createDataFrame([(s, w, w) for s, w in weights], "source string, weight bigint, n bigint"), 1).collect()
        order = sorted((r.slot, r.source, r.turn) for r in found)
        assert order == by_hand(weights, total)
        done = Counter()
        for slot, source, _ in order:
            done[source] += 1
            assert all(abs(done[s] - w * (slot + 1) / total) < 1 for s, w in weights)


def test_mix_follows_exact_weights(spark, documents):
    sizes = {"a": 400, "b": 90, "c": 45, "d": 7}
    docs = documents(*[(i, "t", s) for s, n in sizes.items() for i in range(n)])
    weights = {"a": 1_301, "b": 300, "c": 77, "d": 1}
    frame = spark.createDataFrame(list(weights.items()), "source string, weight bigint")
    found = mix(docs, frame, block=2).select("source", "block_no", "slot", "position").collect()
    total = sum(weights.values())
    wanted = {(s, turn): t for t, s, turn in by_hand(sorted(weights.items()), total)}
    assert all(r.slot == wanted[r.source, r.block_no % weights[r.source]] + total * (r.block_no // weights[r.source]) for r in found)
    assert sorted(r.position for r in found) == list(range(sum(sizes.values())))
    order = sorted(found, key=lambda r: r.position)
    assert [r.slot for r in order] == sorted(r.slot for r in order)


def test_more_than_1000_sources(documents):
    """All have a slot by default; the one of 400 rows has the share of its root."""
    docs = documents(*[(i, "t", "hot" if i < 400 else f"s{i}") for i in range(1_500)])
    found = mix(docs, block=10).select("source", "slot", "position").collect()
    assert sorted(r.position for r in found) == list(range(1_500))
    assert len({r.slot for r in found}) == 1_100 + 40
    hot = sorted({r.slot for r in found if r.source == "hot"})
    total = 1_100 + 20
    assert all(i * total // 20 <= slot < -(-(i + 1) * total // 20) for i, slot in enumerate(hot))


def test_the_sql_states_the_exact_weights(spark, tmp_path):
    """Sources of unequal size, on which rounded weights would give another order."""
    import duckdb

    from pagelathe.llm.oracle import ORACLE
    from pagelathe.llm.queries import op6_pfair_mixing

    rows, at = [], 0
    for source, n in (("a", 3_000), ("b", 900), ("c", 450), (None, 120), ("e", 17), ("f", 450)):
        rows += [(at + i, source) for i in range(n)]
        at += n
    spark.createDataFrame(rows, "doc_id bigint, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op6_pfair_mixing(spark, str(tmp_path)).select("doc_id", "source", "block_no", "slot", "position").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(tuple(r) for r in found) == sorted(con.execute(f"SELECT doc_id, source, block_no, slot, position FROM ({ORACLE['op6_pfair_mixing']})").fetchall())
