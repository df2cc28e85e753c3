"""Operators against brute force on small data, with repeats and heavy keys."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from buyerscope.models import sweeps
from buyerscope.operators import profile
from buyerscope.operators.quantiles import grouped_quantiles, quantile_row
from buyerscope.operators.ranks import auc, grid_metrics, rank_counts, with_rank
from buyerscope.operators.skew import HotSplit, hot_keys
from buyerscope.operators.split import hashed_positions, stratified_split


def average_ranks(v):
    v = np.asarray(v, float)
    return np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])


def spearman(a, b):
    ra, rb = average_ranks(a), average_ranks(b)
    return float(np.corrcoef(ra, rb)[0, 1])


def test_quantiles_match_numpy(spark):
    rng = random.Random(1)
    rows = []
    for g in range(4):
        for _ in range([1, 2, 57, 400][g]):
            rows.append((g, rng.choice([0.0, -3.5, 1e-9, 1e9, rng.gauss(0, 100), round(rng.gauss(50, 2), 2)])))
    df = spark.createDataFrame(rows + [(0, None)], "g int, v double")
    probs = [0.0, 0.2, 0.25, 0.5, 0.77, 1.0]
    for r in grouped_quantiles(df, ["g"], "v", probs).collect():
        want = np.quantile([v for g, v in rows if g == r.g], r.prob)
        assert r.q == pytest.approx(want, rel=1e-12, abs=1e-12)
    whole = quantile_row(df, "v", probs).first()
    assert list(whole) == pytest.approx(list(np.quantile([v for _, v in rows], probs)))


def test_values_in_one_bucket_are_cut_into_parts(spark):
    """99 % of the values share one scale bucket, half of them within a billionth of it."""
    rng = np.random.default_rng(5)
    near = np.concatenate([100 + rng.random(1500) * 1e-3, 100 + rng.random(1470) * 1e-10, [100.0] * 40])
    v = np.concatenate([near, [-5.0, 0.0, 1e6] * 10])
    df = spark.createDataFrame([(i % 2, float(a)) for i, a in enumerate(v)], "g int, v double")
    probs = [0.0, 0.1, 0.5, 0.501, 0.9, 1.0]
    for r in grouped_quantiles(df, ["g"], "v", probs, most=100).collect():
        assert r.q == pytest.approx(np.quantile(v[r.g :: 2], r.prob), rel=1e-15, abs=1e-15)
    counts = df.groupBy(F.col("v").alias("value")).agg(F.count("*").alias("n")).withColumn("one", F.lit(0))
    got = {r.value: (r.rank, r.total) for r in rank_counts(counts, ["one"], most=100).collect()}
    values, first, times = np.unique(np.sort(v), return_index=True, return_counts=True)
    assert got == {a: (f + (t + 1) / 2, len(v)) for a, f, t in zip(values, first, times)}


def test_one_value_holding_most_rows(spark):
    df = spark.range(20000).select(F.when(F.col("id") < 15000, 0.0).otherwise(F.col("id").cast("double")).alias("v"))
    got = quantile_row(df, "v", [0.5, 0.75, 0.9]).first()
    want = np.quantile([0.0] * 15000 + list(range(15000, 20000)), [0.5, 0.75, 0.9])
    assert list(got) == pytest.approx(list(want))


def test_hot_keys_and_split(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("cust_id"))
    assert hot_keys(df, "cust_id", 0.001, 0) == [0]
    assert hot_keys(df, "cust_id", 0.001, 10_000) == []
    split = HotSplit("cust_id", (0,))
    out = split.run(df, lambda rows, place: place(rows).groupBy("cust_id").count())
    assert out.count() == 601 and out.where("cust_id = 0").first()[1] == 400


def test_hot_split_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(1,)] * 9 + [(None,)] * 9 + [(2,)], "cust_id int")
    for hot in ((), (1,), (1, None)):
        out = HotSplit("cust_id", hot).run(df, lambda rows, place: place(rows).groupBy("cust_id").count())
        assert sorted(map(str, out.collect())) == sorted(map(str, df.groupBy("cust_id").count().collect()))


def test_spearman_with_ties_and_constants(spark):
    df = spark.createDataFrame([(i, float(a), float(b), 1.0) for i, (a, b) in enumerate(zip((1, 2, 3, 4), (1, 1, 5, 4)))],
                               "cust_id long, y double, p double, c double")
    ranked = with_rank(df, "y", "y_rank")
    assert grid_metrics(ranked, [], "y", "y_rank", "p").first().Spearman == pytest.approx(0.737864787372622)
    assert grid_metrics(ranked, [], "y", "y_rank", "c").first().Spearman == 0.0


def test_metrics_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0.0, 0.0, rng.random() * 100]), rng.choice([0.5, rng.random()]), rng.random() * 80) for i in range(500)]
    preds = spark.createDataFrame(rows, "cust_id long, y double, p_buy double, amount double")
    ranked = sweeps.ranked_truth(preds)
    y, p, a = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
    for r in sweeps.threshold_sweep(ranked).collect():
        pred = np.where(p >= r.threshold, a, 0.0)
        assert r.MAE == pytest.approx(np.abs(y - pred).mean())
        assert r.pred_buyers == (p >= r.threshold).sum()
        assert r.Spearman == pytest.approx(spearman(y, pred))
    pos, neg = p[y > 0], p[y == 0]
    want = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    labelled = preds.withColumn("buyer", (F.col("y") > 0).cast("int"))
    assert auc(labelled, [], "buyer", "p_buy").first().AUC == pytest.approx(want)
    for r in sweeps.alpha_sweep(ranked).collect():
        assert r.Spearman == pytest.approx(spearman(y, p**r.alpha * a))


def test_equal_errors_choose_the_smaller_threshold(spark):
    sweep = spark.createDataFrame([(0.3, 5.0), (0.1, 5.0), (0.2, 6.0)], "threshold double, MAE double")
    assert sweeps.best_threshold(sweep).first().threshold == 0.1


def test_fine_weights_stay_inside_zero_and_one(spark):
    rows = [(i, float(i % 7), 0.0, float(i % 7)) for i in range(50)]
    preds = spark.createDataFrame(rows, "cust_id long, y double, pred_first double, pred_second double")
    fine = [r.weight_second for r in sweeps.weight_search(preds).where("stage = 'fine'").collect()]
    assert sorted(fine) == pytest.approx([0.9, 0.92, 0.94, 0.96, 0.98, 1.0])


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.range(1003).select(F.col("id").alias("cust_id"), (F.col("id") % 3 == 0).cast("int").alias("s"))
    got = stratified_split(df, "s")
    sizes = {(r.s, r.is_validation): r["count"] for r in got.groupBy("s", "is_validation").count().collect()}
    assert sizes == {(0, 1): 134, (0, 0): 534, (1, 1): 67, (1, 0): 268}
    again = stratified_split(df.repartition(7), "s")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


def test_positions_are_a_permutation(spark):
    placed = hashed_positions(spark.range(500).withColumnRenamed("id", "cust_id"), "cust_id", 7)
    got = [r.position for r in placed.orderBy("cust_id").collect()]
    assert sorted(got) == list(range(1, 501)) and got != sorted(got)


def test_histogram_puts_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 59.9, 60)], "v double")
    got = {r.bin: r.n for r in profile.histogram(df, F.col("v")).collect()}
    assert got == {1: 1, 2: 1, 60: 2}


def test_leaderboard_union_keeps_missing_auc(spark):
    a = spark.createDataFrame([("x", 0.7, 3.0, 0.2)], "model_name string, AUC double, MAE double, Spearman double")
    b = spark.createDataFrame([("y", 2.0, 0.1)], "model_name string, MAE double, Spearman double")
    got = [(r.place, r.model_name, r.AUC) for r in sweeps.leaderboard(a, b).orderBy("place").collect()]
    assert got == [(1, "y", None), (2, "x", 0.7)]
