import math
from collections import Counter

from pyspark.sql import functions as F

from pagelathe.operators import agents

TRACE = "conv_id bigint, turn int, text string"


def test_language(spark):
    docs = [("en", "the cat and the dog and the bird"), ("tr", "kedi ve köpek ve kuş bir de balık"), ("tr", "bir iki üç")]
    df = spark.createDataFrame(docs, "lang string, text string")
    profiles = agents.fit_language_profiles(df, top=50)
    asked = spark.createDataFrame(
        [(1, "the bird and the cat", "xx"), (2, "köpek ve kedi", "xx"), (3, "??", "yy"), (4, None, "zz"), (5, "", "zz")],
        "id bigint, text string, other string",
    )
    out = agents.detect_language(asked, profiles, fallback="other").orderBy("id").collect()
    assert [(r.detected, r.lang) for r in out] == [("en", "en"), ("tr", "tr"), (None, "yy"), (None, "zz"), (None, "zz")]
    assert out[0].confidence > 0.9 and out[2].confidence == 0.0
    assert agents.detect_language(asked, profiles.limit(0)).where("detected IS NULL AND confidence = 0").count() == 5
    routed = agents.route(spark.createDataFrame([("tr",), ("en",), (None,)], "lang string"))
    assert [r.tool for r in routed.collect()] == ["turkish_rag_search", "wikipedia_search", "wikipedia_search"]
    books, articles = agents.split_routes(routed)
    assert (books.count(), articles.count()) == (1, 2)


def test_repeated_rows_and_lots(spark, monkeypatch):
    """Rows are scored one by one, whatever shares a batch with them."""
    df = spark.createDataFrame([(i % 3, "ab" * i + "cab", "x" if i % 2 else "y") for i in range(20)], "id bigint, text string, lang string")
    profiles = agents.fit_language_profiles(df, top=5)
    counts = {(r.lang, r.gram): r.n for r in profiles.collect()}
    names, grams = sorted({k[0] for k in counts}), sorted({k[1] for k in counts})

    def by_hand(text):
        total = {name: sum(counts.get((name, g), 0) for g in grams) + len(grams) for name in names}
        cut = [text[i : i + 3] for i in range(len(text) - 2) if text[i : i + 3] in grams]
        like = [math.prod((counts.get((name, g), 0) + 1) / total[name] for g in cut) for name in names]
        return (names[like.index(max(like))], round(max(like) / sum(like), 6)) if cut else (None, 0.0)

    monkeypatch.setattr(agents, "SCORE_CELLS", 30)
    found = agents.detect_language(df, profiles).collect()
    assert Counter((r.id, r.text, r.detected, round(r.confidence, 6)) for r in found) == Counter((r.id, r.text, *by_hand(r.text)) for r in df.collect())


def test_actions_guard_and_answer(spark):
    texts = [
        (1, 0, "Thought: x\nAction: turkish_rag_search(x (y))\nObservation: ..."),
        (1, 1, "Action: wikipedia_search(b)\n Action: wikipedia_search(c) "),
        (1, 3, "Action: wikipedia_search(d)"),
        (1, 9, "Action: finish(42)\nAction: finish(43)"),
        (2, 0, "no action here, Action: not(at start)"),
        (2, 1, "Action: wikipedia_search(z)"),
    ]
    acts = agents.parse_actions(spark.createDataFrame(texts, TRACE))
    rows = {(r.conv_id, r.turn, r.action_no): (r.tool, r.arg) for r in acts.collect()}
    assert rows[1, 0, 0] == ("turkish_rag_search", "x (y)") and rows[1, 1, 1] == ("wikipedia_search", "c") and len(rows) == 7
    for width in (2, 1000):
        out = agents.round_guard(acts, width=width).orderBy("conv_id", "turn", "action_no").collect()
        assert [r.round for r in out] == [1, 2, 3, 4, None, None, 1]
        assert [r.over_limit for r in out] == [False, False, False, True, False, False, False]
        assert [r.after_finish for r in out] == [False] * 5 + [True, False]
    assert {r.conv_id: r.final_answer for r in agents.final_answer(acts).collect()} == {1: "42", 2: None}


def test_verdicts_and_abstentions(spark):
    rows = [(1, 0, "OK"), (1, 1, "REVISE: missing date"), (1, 2, "ok then"), (1, 3, " REVISE: again\nmore ")]
    out = agents.parse_verdict(spark.createDataFrame(rows, TRACE))
    got = [(r.verdict, r.reason) for r in out.orderBy("turn").collect()]
    assert got == [("ok", None), ("revise", "missing date"), ("unparsed", None), ("revise", "again\nmore")]
    assert [r.turn for r in agents.allowed_revisions(out).collect()] == [1]
    said = [("tr", agents.ABSTENTIONS[0] + " "), ("tr", "x"), ("en", agents.ABSTENTIONS[1])]
    rates = agents.abstention_rate(agents.mark_abstentions(spark.createDataFrame(said, "lang string, text string")), "lang")
    assert {r.lang: (r.n, r.n_abstained, r.rate) for r in rates.collect()} == {"tr": (2, 1, 0.5), "en": (1, 1, 1.0)}


def test_match_and_vote(spark):
    pairs = spark.createDataFrame([("tr", "tr"), ("tr", "en"), (None, None)], "question_lang string, answer_lang string")
    assert [r.same_language for r in agents.language_match(pairs).collect()] == [True, False, True]
    votes = [(1, "A"), (1, "B"), (1, "B"), (2, "B"), (2, "A"), (3, None), (3, None), (3, "C"), (4, None)]
    won = agents.majority_vote(spark.createDataFrame(votes, "qa_id bigint, answer string"))
    assert {r.qa_id: (r.answer, r.votes, r.n_votes) for r in won.collect()} == {1: ("B", 2, 3), 2: ("A", 1, 2), 3: ("C", 1, 1), 4: (None, 0, 0)}
