"""Fits recover known parameters; trained models keep their promises."""

import threading

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from buyerscope.features import store
from buyerscope.lifetime import value
from buyerscope.lifetime.fitting import log_gamma
from buyerscope.models import chains, search, sweeps, twostage
from buyerscope.settings import SCORED, LifetimeSettings, ModelSettings
from buyerscope.sources import retail_view as view
from buyerscope.sources.staging import staged
from tests.conftest import SMALL

FREE = LifetimeSettings(penalty=0.0)


def test_log_gamma():
    import math

    xs = np.array([0.001, 0.3, 1.0, 2.0, 7.9, 8.0, 123.4])
    assert log_gamma(xs) == pytest.approx([math.lgamma(v) for v in xs], abs=1e-10)


def test_purchase_model_recovers_its_parameters(spark):
    rng = np.random.default_rng(7)
    r, alpha, a, b, n = 0.8, 20.0, 0.9, 2.5, 6000
    ages = rng.integers(100, 400, n)
    rows = []
    for age in ages:
        rate, drop = rng.gamma(r, 1 / alpha), rng.beta(a, b)
        t, x, last = 0.0, 0, 0.0
        while True:
            t += rng.exponential(1 / rate)
            if t > age:
                break
            x, last = x + 1, t
            if rng.random() < drop:
                break
        rows.append((x, float(last), float(age)))
    rfm = spark.createDataFrame([(int(x), l, t) for x, l, t in rows], "frequency long, recency double, T double")
    m = value.fit_purchases(rfm, FREE)
    assert m.r == pytest.approx(r, rel=0.15) and m.alpha == pytest.approx(alpha, rel=0.2)
    assert m.a / (m.a + m.b) == pytest.approx(a / (a + b), rel=0.15)


def test_spend_model_recovers_its_parameters(spark):
    rng = np.random.default_rng(5)
    p, q, v, n = 6.0, 4.0, 15.0, 8000
    x = rng.integers(1, 12, n)
    scale = rng.gamma(q, 1 / v, n)
    m = np.array([rng.gamma(p, 1 / s, k).mean() for s, k in zip(scale, x)])
    rfm = spark.createDataFrame([(int(k), float(z)) for k, z in zip(x, m)], "frequency long, monetary_value double")
    fit = value.fit_spend(rfm, FREE)
    assert fit.q == pytest.approx(q, rel=0.15)
    assert fit.v * fit.p / (fit.q - 1) == pytest.approx(v * p / (q - 1), rel=0.05)


def test_expected_purchases_against_direct_integration(spark):
    """A customer without repeat purchases, by simulation-free numeric integration of the rate."""
    m = value.PurchaseModel(0.8, 60.0, 1.7, 3.1)
    df = spark.createDataFrame([(0, 0.0, 0.0), (3, 50.0, 90.0)], "frequency long, recency double, T double")
    got = [r[0] for r in df.select(m.expected_purchases(30.0)).collect()]

    def hyp2f1(a, b, c, z):
        term = total = 1.0
        for n in range(3000):
            term *= (a + n) * (b + n) / ((c + n) * (n + 1)) * z
            total += term
        return total

    for (x, rec, age), g in zip([(0, 0, 0), (3, 50, 90)], got):
        z = 30 / (60 + age + 30)
        f = hyp2f1(0.8 + x, 3.1 + x, 1.7 + 3.1 + x - 1, z)
        top = (1.7 + 3.1 + x - 1) / 0.7 * (1 - f * ((60 + age) / (60 + age + 30)) ** (0.8 + x))
        odds = 1.7 / (3.1 + max(x, 1) - 1) * ((60 + age) / (60 + rec)) ** (0.8 + x)
        assert g == pytest.approx(top / (1 + (odds if x else 0)), rel=1e-9)


@pytest.fixture(scope="module")
def data(spark, small_items):
    features = staged(store.customer_features(small_items, view.FEATURES), "features")
    return features, view.train_labels(spark, SMALL), view.test_customers(spark, SMALL)


SETTINGS = ModelSettings(classifier_trees=5, regressor_trees=5, max_depth=4, min_leaf=2)


def test_two_stage_run(spark, data):
    features, train, test = data
    pipeline = twostage.TwoStagePipeline(SETTINGS)
    run = pipeline.run(features, train, test)
    scored = run.scored.collect()
    assert run.scored.columns == ["cust_id", SCORED]
    assert sorted(r.cust_id for r in scored) == sorted(r.cust_id for r in test.collect())
    assert min(r[SCORED] for r in scored) >= 0
    low, high = run.validation.agg(F.min("p_buy"), F.max("p_buy")).first()
    assert 0 <= low <= high <= 1
    e = run.evaluation.first()
    better = "expected" if e.mae_expected <= e.best_threshold_mae else "threshold"
    assert e.chosen_strategy == run.strategy == better
    assert search.run_summary(spark, "x", {"a": 1}, run).first().params == "a=1"
    assert twostage.count_without_features(features, test) == 0
    assert pipeline.with_models(regressor="r").models()["regressor"] == "r"


def test_no_buyers_is_an_error(spark, data):
    features, train, _ = data
    none = train.withColumn("revenue_2018_2019", F.lit(0.0))
    rows, _ = twostage.TwoStagePipeline(SETTINGS).training_rows(features, none)
    with pytest.raises(ValueError, match="no buyers"):
        twostage.fit_regressor(twostage.default_regressor(SETTINGS), rows)
    with pytest.raises(TypeError, match="probabilities"):
        twostage.fit_classifier(twostage.default_regressor(SETTINGS), rows)


def test_drawn_settings_are_different_and_repeatable():
    a = search.draw_params(search.BOOSTING_GRID, 25, 42)
    assert a == search.draw_params(search.BOOSTING_GRID, 25, 42)
    assert len({str(s) for s in a}) == 25


def test_failed_pair_is_reported(spark, data):
    features, train, _ = data
    rows, names = twostage.TwoStagePipeline(SETTINGS).training_rows(features, train)
    good = (twostage.default_classifier(SETTINGS), twostage.default_regressor(SETTINGS))
    board, failed = search.model_leaderboard(rows, {"good": good, "bad": (good[1], good[1])})
    assert [r.model_name for r in board.collect()] == ["good"] and list(failed) == ["bad"]
    model = twostage.fit_regressor(good[1], rows)
    top = search.top_features(spark, model, names, 3).collect()
    assert len(top) == 3 and top[0].importance >= top[1].importance
    used = [r.feature for r in top]
    moved = search.permutation_importance(twostage.buyers(rows), model, names, used, "target_log")
    assert {r.feature for r in moved.collect()} == set(used)
    assert moved.agg(F.max("importance")).first()[0] > 0
    assert sweeps.FIRST_MODEL_THRESHOLD == 0.5


def test_search_leads_to_scored_customers(spark, data):
    from buyerscope.models import chains

    grid = {"trees": [2, 3], "depth": [2, None], "bootstrap": [False, True]}
    table, run = chains.tuned_run(twostage.TwoStagePipeline(SETTINGS), data, search.FOREST_BASES, (grid, grid), draws=2, folds=2)
    rows = table.collect()
    assert sorted(r.stage for r in rows) == ["classifier"] * 2 + ["regressor"] * 2
    best = max((r for r in rows if r.stage == "classifier"), key=lambda r: r.score).params
    assert f"trees={len(run.classifier.trees)}" in best
    assert run.scored.count() == data[2].count()
    assert search.FOREST_BASES[0].spec.trees == 100  # the base estimator is left as it was


def test_ensemble_scores_every_test_customer(spark, data):
    from buyerscope.models import chains

    forest = (search.randomized_classifier(SETTINGS), search.randomized_regressor(SETTINGS))
    boosted = (search.boosting_classifier(3), search.boosting_regressor(3))
    run = chains.ensemble_run(twostage.TwoStagePipeline(SETTINGS), data, boosted, forest)
    assert {r.stage for r in run.board.collect()} == {"coarse", "fine"}
    assert run.scored.columns == ["cust_id", SCORED]
    assert sorted(r.cust_id for r in run.scored.collect()) == sorted(r.cust_id for r in data[2].collect())
    assert run.scored.agg(F.min(SCORED)).first()[0] >= 0


def test_combinations_match_pairs_judged_alone(spark, data):
    from buyerscope.models import chains

    pipeline = twostage.TwoStagePipeline(SETTINGS)
    forest, boosted = twostage.default_classifier(SETTINGS), search.boosting_classifier(3)
    plain, more = twostage.default_regressor(SETTINGS), search.boosting_regressor(3)
    run = chains.combination_run(pipeline, data, {"f": forest, "b": boosted}, {"p": plain, "m": more})
    board = {(r.classifier, r.regressor): r for r in run.board.collect()}
    assert len(board) == 4 and run.scored.count() == data[2].count()
    rows, _ = pipeline.training_rows(data[0], data[1])
    alone, _ = search.model_leaderboard(rows, {"bm": (boosted, more)})
    one = alone.first()
    assert (one.AUC, one.MAE) == pytest.approx((board["b", "m"].AUC, board["b", "m"].MAE))


def test_neighbours_match_brute_force(spark, monkeypatch):
    """Blocks and small tiles, clusters far from the origin, many features, and one vector that a third of the rows share."""
    from buyerscope.models import neighbours
    from buyerscope.models.neighbours import Neighbours, knn_score

    rng = np.random.default_rng(11)
    monkeypatch.setattr(neighbours, "TILE", 500)
    for width, far in ((3, 0.0), (40, 7e5)):
        pts = np.vstack([rng.normal(c, 3, (150, width)).round(1) for c in (0, 40, 300)] + [np.zeros((220, width))]) + far
        labels = rng.integers(0, 2, len(pts))
        asks = np.vstack([rng.normal(c, 5, (15, width)).round(1) for c in (0, 40, 300, 1000)] + [np.zeros((2, width))]) + far
        names = [f"f{i}" for i in range(width)]
        cols = "cust_id long, " + ", ".join(f"{n} double" for n in names)
        train = spark.createDataFrame([(i, *map(float, p), int(y)) for i, (p, y) in enumerate(zip(pts, labels))], cols + ", y int")
        queries = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(asks)], cols)
        got = {r.cust_id: r.score for r in knn_score(train, queries, names, "y", k=9, block=20).collect()}
        for i, q in enumerate(asks):
            d = np.zeros(len(pts))
            for j in range(width):
                d += (q[j] - pts[:, j]) * (q[j] - pts[:, j])
            assert got[i] == pytest.approx(labels[np.lexsort((np.arange(len(pts)), d))[:9]].mean())
    vectors = array_to_vector(F.array(*names))
    model = Neighbours(True, "y", 9).fit(train.withColumn("features", vectors))
    scored = twostage.buy_probability(model, queries.withColumn("features", vectors)).collect()
    assert {r.cust_id: r.p_buy for r in scored} == pytest.approx(got)
    few = knn_score(train.limit(4), queries, names, "y", k=9).collect()
    assert len(few) == len(asks) and knn_score(train.limit(0), queries, names, "y").collect() == []


def test_jobs_from_files_to_scores(spark, small_items):
    """Ingest, split, features and scoring through files alone."""
    import uuid

    from buyerscope.plans import jobs
    from buyerscope.settings import Paths
    from buyerscope.sources import files
    from buyerscope.sources.staging import staging_root

    root = f"{staging_root(spark)}/jobs-{uuid.uuid4().hex}"
    paths = Paths(f"{root}/tx", f"{root}/train", f"{root}/test", f"{root}/features", f"{root}/out")
    files.write_csv(view.observed_raw(spark, SMALL), f"{root}/raw")
    files.write_csv(view.train_labels(spark, SMALL), paths.train)
    files.write_csv(view.test_customers(spark, SMALL), paths.test)
    assert jobs.ingest(spark, f"{root}/raw", paths).count() == small_items.count()
    jobs.split_transactions(spark, paths)
    parts = spark.read.parquet(f"{paths.output}/split_transactions")
    train = view.train_labels(spark, SMALL)
    assert parts.count() == small_items.join(train, "cust_id", "left_semi").count()
    both = parts.groupBy("cust_id").agg(F.count_distinct("part").alias("n"))
    assert both.where("n > 1").count() == 0
    features = jobs.build_features(spark, paths, view.FEATURES, view.LIFETIME)
    assert features.columns[-3:] == ["prob_alive", "pred_num_purchases", "expected_avg_sales"]
    assert len(features.columns) == 161
    run = jobs.train_and_score(spark, paths, twostage.TwoStagePipeline(SETTINGS))
    back = spark.read.option("header", True).csv(f"{paths.output}/scored_{run.strategy}")
    assert back.columns == ["cust_id", SCORED] and back.count() == view.test_customers(spark, SMALL).count()


class Met(Exception):
    pass


def meeting(n):
    """A job that ends only once ``n`` of its kind run at the same time."""
    all_here = threading.Barrier(n)

    def job(*_):
        all_here.wait(30)
        raise Met

    return job


def fits_meet(monkeypatch, n):
    job = meeting(n)
    monkeypatch.setattr(twostage, "fit_classifier", lambda *a: job())
    monkeypatch.setattr(twostage, "fit_regressor", lambda *a: job())
    twostage.fit_classifier.__name__, twostage.fit_regressor.__name__ = "classifier", "regressor"


def few_rows(spark):
    row = "1L cust_id, 1 target_binary, 2D target_reg, 1D target_log, 0 is_validation, array(1D) x"
    return spark.sql(f"select {row}").withColumn("features", array_to_vector("x"))


def test_a_refit_does_not_wait_for_the_validation(spark, monkeypatch):
    fits_meet(monkeypatch, 4)
    with pytest.raises(Met):
        twostage.TwoStagePipeline().complete(few_rows(spark), ["x"], None, None)


def test_an_ensemble_fits_all_its_models_side_by_side(spark, monkeypatch):
    fits_meet(monkeypatch, 8)
    pipeline = type("P", (), {"training_rows": lambda self, *a: (few_rows(spark), ["x"])})()
    with pytest.raises(Met):
        chains.ensemble_run(pipeline, (None, None, None), ("a", "b"), ("c", "d"))


def test_both_stages_are_searched_side_by_side(spark, monkeypatch):
    monkeypatch.setattr(search, "random_search", meeting(2))
    pipeline = twostage.TwoStagePipeline()
    monkeypatch.setattr(twostage.TwoStagePipeline, "training_rows", lambda self, *a: (few_rows(spark), ["x"]))
    with pytest.raises(Met):
        chains.tuned_run(pipeline, (None, None, None), ("a", "b"), ({}, {}))
