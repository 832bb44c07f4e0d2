import pytest

from pagelathe.operators import scores

LOG = "run_id string, seq bigint, step bigint, loss double, eval_loss double"


def test_direction_scores_and_baselines(spark):
    rows = [("English", "Turkish", 0.8), ("English", "Turkish", 0.6), ("Turkish", "English", 0.9), ("German", "English", 0.1)]
    ours = scores.direction_scores(spark.createDataFrame(rows, "src_lang string, tgt_lang string, seg_score double"))
    got = {r.direction: (round(r.score, 6), r.n) for r in ours.collect()}
    assert got == {"en2tr": (0.7, 2), "tr2en": (0.9, 1), "ge2en": (0.1, 1)}
    base = spark.createDataFrame([("maps_en2tr", 0.65), ("rag_xx", 1.0)], "key string, score double")
    table = scores.comparison_table(scores.attach_baselines(ours, base)).orderBy("direction").collect()
    assert tuple(table[0]) == ("en2tr", "—", "0.6500", "—", "0.7000", "+0.0500")
    assert tuple(table[1]) == ("tr2en", "—", "—", "—", "0.9000", "—")
    assert scores.attach_baselines(ours, None).where("maps is null and delta is null").count() == 2


def test_training_summary(spark):
    rows = [("r", 0, 25, 2.0, None), ("r", 1, 50, None, 1.5), ("r", 2, 75, 1.8, None), ("r", 3, 100, 9.0, 1.4), ("s", 0, 5, None, None)]
    got = {r.run_id: tuple(r)[1:] for r in scores.training_summary(spark.createDataFrame(rows, LOG)).collect()}
    assert got == {"r": (100, 1.8, 1.4), "s": (5, None, None)}


PUBLISHED = [1.448, 1.452, 1.435, 1.443, 1.438, 1.447]


@pytest.mark.parametrize("width", [2, 5, 1000])
def test_published_curve(spark, width):
    """Any block width gives the same curve."""
    rows = [("r", i, 200 * (i + 1), None, v) for i, v in enumerate(PUBLISHED)] + [("r", 99, 1300, 1.0, None)]
    log = spark.createDataFrame(rows, LOG)
    curve = scores.eval_curve(log, tol=0.005, width=width).orderBy("step").collect()
    assert [r.step for r in curve] == [200, 400, 600, 800, 1000, 1200]
    assert (curve[-1].best_loss, curve[-1].best_step, round(curve[-1].change, 6)) == (1.435, 600, 0.009)
    assert curve[0].change is None and [r.in_band for r in curve] == [True, True, True, False, True, False]
    flat = scores.plateaus(log, 5, tol=0.0171, width=width).orderBy("step").collect()
    assert [None if r.spread is None else round(r.spread, 6) for r in flat] == [None] * 4 + [0.017, 0.017]
    stop = scores.early_stop(log, 5, tol=0.0171, width=width).first()
    assert (stop.n_evals, stop.stop_step, stop.stop_eval_no) == (6, 1000, 5)
    assert scores.early_stop(log, 5, tol=0.001, width=width).first().stop_step is None
