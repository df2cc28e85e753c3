"""Tree ensembles against plain recursion, and the same trees from one task and from many."""

import itertools
import tracemalloc

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from buyerscope.models import ensembles, search, trees, twostage
from buyerscope.models.ensembles import Bins, Block, Ensemble, InTask, Trees
from buyerscope.models.trees import Spec


def sample(n=90, width=6, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)), 1)
    x[:, 1] = rng.integers(0, 3, n)
    x[:, 2] = 7.0  # says nothing
    y = np.round(x[:, 0] * 2 + x[:, 1] + rng.normal(size=n) * 0.3, 2)
    return x, y, (y > np.median(y)).astype(float)


def frame(spark, x, y, c):
    rows = [(i, [float(v) for v in a], float(b), int(z), i % 3) for i, (a, b, z) in enumerate(zip(x, y, c))]
    df = spark.createDataFrame(rows, "cust_id long, x array<double>, target_log double, target_binary int, fold int")
    return df.select("cust_id", array_to_vector("x").alias("features"), "target_log", "target_binary", "fold")


def in_task(spec, x, y, weights=None, scale=16.0, base=0.0):
    bins = Bins.of(x)
    key = np.arange(len(x))
    rows = InTask(spec, Block(key, key % 3, y, bins(x)), bins, base, weights, scale)
    grown = [t for n in ensembles.batches_of(spec, 0, spec.trees) for t in rows.grow(n)]
    return Ensemble(spec, bins, grown, base)


def plain_tree(x, y, depth, min_leaf, min_split, w=None):
    """Best variance split over all midpoints, by recursion; returns a function."""
    w = np.ones(len(y)) if w is None else w
    mean = (w * y).sum() / w.sum()
    best = (1e-9, None, None)
    if depth and len(y) >= max(2, min_split) and len(set(y)) > 1:
        for f in range(x.shape[1]):
            u = np.unique(x[:, f])
            for t in (u[1:] + u[:-1]) / 2:
                left = x[:, f] <= t
                if min(left.sum(), (~left).sum()) < min_leaf:
                    continue
                parts = [(w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left)]
                gain = sum(parts) - (w * y).sum() ** 2 / w.sum()
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, f, t)
    if best[1] is None:
        return lambda a: mean
    _, f, t = best
    left = x[:, f] <= t
    a, b = (plain_tree(x[s], y[s], depth - 1, min_leaf, min_split, w[s]) for s in (left, ~left))
    return lambda v: a(v) if v[f] <= t else b(v)


@pytest.mark.parametrize("depth,min_leaf,min_split", [(3, 1, 2), (12, 5, 2), (12, 1, 20)])
def test_best_splits_match_plain_recursion(depth, min_leaf, min_split):
    x, y, _ = sample()
    model = in_task(Spec(False, False, 1, depth, min_leaf, min_split), x, y)
    plain = plain_tree(x, y, depth, min_leaf, min_split)
    assert model.margins(model.bins(x)) == pytest.approx([plain(v) for v in x], abs=1e-5)


def test_balanced_classes_match_weighted_recursion():
    x, _, c = sample()
    c[:60] = 0
    weights = (len(c) / 2 / (c == 0).sum(), len(c) / 2 / (c == 1).sum())
    model = in_task(Spec(True, False, 1, 4, balanced=True), x, c, weights)
    plain = plain_tree(x, c, 4, 1, 2, np.where(c == 1, weights[1], weights[0]))
    assert model.margins(model.bins(x)) == pytest.approx([plain(v) for v in x], abs=1e-8)


def test_random_splits_lie_between_least_and_greatest_and_the_best_is_taken():
    x, y, _ = sample()
    spec = Spec(False, False, 1, 1, split="random", seed=9)
    model = in_task(spec, x, y)
    tree, values = model.trees[0], model.bins.values
    gains = {}
    for f in range(x.shape[1]):
        low, high = x[:, f].min(), x[:, f].max()
        if low == high:
            continue
        t = low + float(trees.hashed(spec.seed, 3, 0, 0, f)) * (high - low)
        left = x[:, f] <= t
        assert left.any() and (~left).any()
        gains[f] = sum(y[s].sum() ** 2 / s.sum() for s in (left, ~left)), t
    best = max(gains, key=lambda f: gains[f][0])
    assert tree.feature[0] == best
    assert values[best, tree.cut[0]] <= gains[best][1] < values[best, tree.cut[0] + 1]


def test_random_forest_grows_to_its_limits():
    x, y, _ = sample(200)
    model = in_task(Spec(False, False, 8, None, 1, split="random"), x, y)
    assert np.corrcoef(model.margins(model.bins(x)), y)[0, 1] > 0.97
    for t in model.trees:
        leaf = t.node_of(model.bins(x))
        for node in np.unique(leaf):
            own = x[leaf == node]
            assert len(set(y[leaf == node])) == 1 or len(np.unique(own, axis=0)) == 1
    least = in_task(Spec(False, False, 8, None, 7, 20, split="random"), x, y)
    for t in least.trees:
        assert np.bincount(t.node_of(least.bins(x))[:]).max() < 200
        assert min(n for n in np.bincount(t.node_of(least.bins(x))) if n) >= 7


def plain_boosting(x, y, rounds, depth, step, loss):
    if loss == "logistic":
        base = np.log(y.mean() / (1 - y.mean()))
    else:
        base = y.mean()
    margin = np.full(len(y), base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        r = y - p if loss == "logistic" else y - margin
        tree = plain_tree(x, r, depth, 1, 2)
        place = np.array([tree(v) for v in x])
        for leaf in np.unique(place):
            own = place == leaf
            margin[own] += step * (r[own].sum() / (p * (1 - p))[own].sum() if loss == "logistic" else r[own].mean())
    return margin


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_boosting_matches_a_plain_loop(loss):
    x, y, c = sample()
    label = c if loss == "logistic" else y
    base = float(np.log(c.mean() / (1 - c.mean()))) if loss == "logistic" else float(y.mean())
    model = in_task(Spec(loss == "logistic", True, 6, 2, step=0.3, loss=loss), x, label, base=base)
    assert model.margins(model.bins(x)) == pytest.approx(plain_boosting(x, label, 6, 2, 0.3, loss), abs=1e-4)


def test_absolute_loss_takes_leaf_medians():
    x, y, _ = sample(400)
    y[0] = 1000.0
    base = float(np.median(y))
    model = in_task(Spec(False, True, 1, 1, step=1.0, loss="absolute"), x, y, base=base, scale=1024.0)
    t = model.trees[0]
    leaf = t.node_of(model.bins(x))
    for node in (1, 2):
        own = np.sort(y[leaf == node] - base)
        assert abs(t.value[node] - own[(len(own) - 1) // 2]) <= 0.03 * abs(own[(len(own) - 1) // 2]) + 1e-3


MANY = [
    Spec(True, True, 3, 2, 2, 5, step=0.1, loss="logistic", features="sqrt", subsample=0.8),
    Spec(False, True, 3, 2, step=0.1, held_out=1),
    Spec(False, True, 3, 2, step=0.5, loss="absolute", subsample=0.6, held_out=0),
    Spec(True, False, 3, 4, 2, features="sqrt", split="random", balanced=True, bootstrap=True, held_out=2),
    Spec(False, False, 2, 5, split="random", features=0.7, held_out=0),
    Spec(False, False, 1, 3, 3),
]


def test_one_task_and_many_give_the_same_trees(spark, monkeypatch):
    x, y, c = sample(240)
    rows = frame(spark, x, y, c).repartition(2)
    monkeypatch.setattr(ensembles, "REPLAYED", 2)
    monkeypatch.setattr(ensembles, "TREES_AT_ONCE", 2)
    for classes, label in ((True, "target_binary"), (False, "target_log")):
        specs = [s for s in MANY if s.classes == classes]
        table = ensembles.binned(rows, label, fold="fold")
        one = ensembles.fit_all(specs, table)
        marks = [sorted({1, s.trees}) for s in specs]
        scored = sorted(ensembles.held_out_scores(specs, marks, table).collect())
        with monkeypatch.context() as few:
            few.setattr(ensembles, "ONE_TASK", 10)
            many = ensembles.fit_all(specs, table)
            scored_many = sorted(ensembles.held_out_scores(specs, marks, table).collect())
        for a, b in zip(one, many):
            assert a.base == b.base and len(a.trees) == len(b.trees) == a.spec.trees
            for s, t in zip(a.trees, b.trees):
                for name in ("feature", "cut", "child", "value"):
                    assert np.array_equal(getattr(s, name), getattr(t, name)), (a.spec, name)
        assert scored == scored_many
        for r in scored:
            assert r.fold == specs[r.model].held_out
            model = one[r.model].cut_to(r.trees)
            assert r.margin == pytest.approx(model.margins(model.bins(x[r.key : r.key + 1]))[0])
        expected = sum(len(set(marks[m])) * sum(i % 3 == s.held_out for i in range(240)) for m, s in enumerate(specs))
        assert len(scored) == expected


def test_held_out_rows_teach_nothing(spark):
    x, y, c = sample(120)
    other = y.copy()
    other[np.arange(120) % 3 == 1] += 50
    # the same scale and bins, so that only the targets of fold 1 differ
    specs = [Spec(False, True, 3, 2, step=0.5, held_out=1), Spec(False, False, 2, 3, split="random", held_out=1)]
    for spec in specs:
        a, b = (in_task(spec, x, v, scale=128.0) for v in (y, other))
        assert all(np.array_equal(s.value, t.value) for s, t in zip(a.trees, b.trees))


def test_models_work_in_the_two_stages(spark):
    x, y, c = sample(150)
    rows = frame(spark, x, np.abs(y), c)
    clf = twostage.fit_classifier(Trees(Spec(True, True, 10, 2, step=0.3, loss="logistic"), "target_binary"), rows)
    reg = twostage.fit_regressor(Trees(Spec(False, False, 10, 5, split="random"), "target_log"), rows)
    scored = twostage.predict(clf, reg, rows).collect()
    assert len(scored) == 150 and all(0 <= r.p_buy <= 1 and r.amount >= 0 for r in scored)
    assert np.mean([(r.p_buy > 0.5) == r.target_binary for r in scored]) > 0.9
    assert sum(clf.featureImportances) == pytest.approx(1.0) and clf.featureImportances[2] == 0
    with pytest.raises(TypeError):
        twostage.fit_classifier(Trees(Spec(False, True, 1, 1), "target_log"), rows)


def test_best_prefix_is_the_least_error_of_all_rounds(spark):
    x, y, c = sample(150)
    y = np.abs(y)
    rows = frame(spark, x, y, c).withColumn("target_binary", F.lit(1))
    train, valid = rows.where("fold <> 0"), rows.where("fold = 0")
    estimator = Trees(Spec(False, True, 30, 4, step=0.5, loss="absolute"), "target_log")
    whole = estimator.fit(train)
    errors = search.round_errors(whole, valid, "target_log")
    own = np.arange(150) % 3 == 0
    for k in (1, 7, 30):
        part = whole.cut_to(k)
        assert errors[k - 1] == pytest.approx(np.abs(y[own] - part.margins(part.bins(x[own]))).mean())
    model = search.fit_best_prefix(estimator, train, valid)
    curve = search.learning_curve(whole, train, valid).collect()
    best = min(curve, key=lambda r: (r.validation_error, r.iteration))
    assert len(model.trees) == best.iteration < 30  # noise is learned in the end
    assert [r.validation_error for r in curve] == pytest.approx(errors)
    assert search.best_round([3.0, 1.0, 2.0, 1.0]) == 2


def test_search_scores_every_draw(spark):
    x, y, c = sample(150)
    rows = frame(spark, x, np.abs(y), c)
    base = Trees(Spec(True, True, 5, 2, step=0.3, loss="logistic"), "target_binary")
    grid = {"trees": [2, 5], "depth": [1, 3]}
    found = search.random_search(rows, base, grid, draws=4, folds=3)
    assert sorted(map(str, found.settings)) == sorted(str({"trees": t, "depth": d}) for t, d in itertools.product([2, 5], [1, 3]))
    assert max(found.scores) == found.scores[found.settings.index({k: getattr(found.best.spec, k) for k in grid})]
    # one draw by hand: AUC of each fold, fitted on the others
    fold = [r.fold for r in rows.select(F.pmod(search.mixed(F.col("cust_id"), 43), F.lit(3)).alias("fold"), "cust_id").orderBy("cust_id").collect()]
    at, aucs = np.array(fold), []
    table = ensembles.binned(rows.drop("fold"), "target_binary")
    for k in range(3):
        bins = table.bins
        own = at == k
        n, s = (~own).sum(), c[~own].sum()
        spec = found.base_with(found.settings[0]).spec
        part = InTask(spec, Block(np.flatnonzero(~own), at[~own], c[~own], bins(x[~own])), bins, float(np.log(s / (n - s))), None, 1.0)
        model = Ensemble(spec, bins, [t for i in range(spec.trees) for t in part.grow([i])], float(np.log(s / (n - s))))
        p = model.margins(bins(x[own]))
        pos, neg = p[c[own] == 1], p[c[own] == 0]
        aucs.append(np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]))
    assert found.scores[0] == pytest.approx(np.mean(aucs))
    worse = search.random_search(rows, Trees(Spec(False, True, 5, 2, step=0.3), "target_log"), grid, draws=2, folds=2)
    assert len(worse.scores) == 2 and worse.best.spec.trees in (2, 5)


def test_bins_keep_order_and_distinct_values():
    x = np.c_[np.arange(1000.0), np.repeat([0.0, 1.0], 500), np.full(1000, 3.0), np.r_[np.zeros(900), np.arange(100)]]
    bins = Bins.of(x)
    codes = bins(x)
    assert codes.max() < trees.BINS
    for f in range(4):
        order = np.argsort(x[:, f], kind="stable")
        assert (np.diff(codes[order, f].astype(int)) >= 0).all()
    assert len(set(codes[:, 0])) == trees.BINS and set(codes[:, 1]) == {0, 1} and set(codes[:, 2]) == {0}
    assert len(set(codes[:, 3])) > 5


def test_no_rows_is_an_error(spark):
    x, y, c = sample(9)
    with pytest.raises(ValueError):
        ensembles.binned(frame(spark, x, y, c).where("false"), "target_log")


# --- adaptive models


def test_adaptive_weights_by_hand():
    """Ten rows, one feature: the first stump splits at 5.5 and is wrong about rows 0 and 9."""
    x = np.arange(10.0)[:, None]
    y = np.array([1, 0, 0, 0, 0, 0, 1, 1, 1, 0], float)
    spec = Spec(True, False, 1, 1, adaptive=True)
    bins = Bins.of(x)
    rows = InTask(spec, Block(np.arange(10), np.zeros(10, int), y, bins(x)), bins, 0.0, None, 1.0)
    (stump,) = rows.grow([0])
    assert stump.say == pytest.approx(np.log(0.8 / 0.2))
    weight = np.exp(rows.margin) / np.exp(rows.margin).sum()
    # 0.1 * 4 for the two wrong rows, 0.1 for the others, over 1.6
    assert weight == pytest.approx([0.25] + [0.0625] * 8 + [0.25])


def test_adaptive_numbers_by_hand():
    spec = Spec(False, False, 1, 3, adaptive=True)
    x, y, _ = sample(40)
    bins = Bins.of(x)
    rows = InTask(spec, Block(np.arange(40), np.zeros(40, int), y, bins(x)), bins, 0.0, None, 16.0)
    (tree,) = rows.grow([0])
    gone = np.abs(tree.value[tree.node_of(bins(x))] - y)
    share = (gone / gone.max()).mean()
    assert tree.say == pytest.approx(np.log((1 - share) / share))
    assert np.exp(rows.margin) == pytest.approx((share / (1 - share)) ** (1 - gone / gone.max()))


def test_votes_by_hand():
    made = [trees.Tree(say=s) for s in (1.0, 2.0, 4.0)]
    guesses = np.array([[1.0, 2.0, 3.0], [9.0, 8.0, 1.0], [5.0, 5.0, 6.0]])
    assert trees.vote(Spec(False, False, 3, adaptive=True), made, guesses).tolist() == [3.0, 1.0, 6.0]
    made[2].say = 2.5
    assert trees.vote(Spec(False, False, 3, adaptive=True), made, guesses).tolist() == [2.0, 8.0, 5.0]
    made[2].say = 4.0
    classes = np.array([[1.0, 0.0, 0.6], [0.0, 0.0, 1.0]])
    assert trees.vote(Spec(True, False, 3, adaptive=True), made, classes) == pytest.approx([3 / 7, 1 / 7])


def test_poisson_counts_follow_their_means():
    u = (np.arange(20_000) + 0.5) / 20_000
    for mean in (0.0, 0.3, 1.0, 12.0, 480.0):
        got = trees.poisson(np.full(len(u), mean), u)
        assert got.mean() == pytest.approx(mean, rel=0.01, abs=1e-9) and got.var() == pytest.approx(mean, rel=0.03, abs=1e-9)
    assert trees.poisson(np.array([700.4]), np.array([0.5])).tolist() == [700.0]


def test_adaptive_models_end_where_nothing_is_wrong_or_chance_is_reached():
    x = np.arange(20.0)[:, None]
    model = in_task(Spec(True, False, 5, 1, adaptive=True), x, (x[:, 0] > 9).astype(float))
    assert [t.say for t in model.trees][0] == 1.0
    rng = np.random.default_rng(0)
    bins = Bins.of(x)
    rows = InTask(Spec(True, False, 60, 1, adaptive=True), Block(np.arange(20), np.zeros(20, int), rng.integers(0, 2, 20).astype(float), bins(x)), bins, 0.0, None, 1.0)
    kept = []
    for k in range(60):
        if not rows.done:
            kept += rows.grow([k])
    assert kept and all(t.say > 0 for t in kept)


def test_adaptive_models_from_one_task_and_many(spark, monkeypatch):
    x, y, c = sample(240)
    rows = frame(spark, x, y, c).repartition(2)
    monkeypatch.setattr(ensembles, "REPLAYED", 2)
    for label, spec in (("target_binary", Spec(True, False, 3, 1, adaptive=True)), ("target_log", Spec(False, False, 2, 2, adaptive=True))):
        table = ensembles.binned(rows, label)
        one = ensembles.fit_all([spec], table)[0]
        with monkeypatch.context() as few:
            few.setattr(ensembles, "ONE_TASK", 10)
            many = ensembles.fit_all([spec], table)[0]
        assert [t.say for t in one.trees] == pytest.approx([t.say for t in many.trees])
        codes = table.bins(x)
        assert one.margins(codes) == pytest.approx(many.margins(codes))
        truth = c if spec.classes else y
        assert np.corrcoef(one.numbers(one.margins(codes)), truth)[0, 1] > 0.6


def _levels(spec, n=3000, width=9):
    """A block of skewed bytes and a model of it in one task."""
    rng = np.random.default_rng(3)
    codes = (rng.beta(0.7, 2, (n, width)) * (trees.BINS - 1)).astype(np.uint8)
    y = (rng.random(n) < 0.2 + codes[:, 0] / 80).astype(float) if spec.classes else rng.random(n) + codes[:, 1] / 20
    bins = ensembles.Bins(np.zeros((width, trees.BINS - 1)), np.tile(np.arange(float(trees.BINS)), (width, 1)))
    return ensembles.InTask(spec, ensembles.Block(np.arange(n), np.full(n, -2), y, codes), bins, 0.0, None, 8.0)


class _ByHistogram:
    """Splits from the whole histogram of a level, as jobs over all rows find them."""

    def __init__(self, columns, spec):
        self.columns = columns

    def search(self, asked, row, at, m, y):
        return trees.best_of_histogram(asked, trees.histogram(self.columns.T, row, at, m, y, asked.choice))

    def follow(self, *_):
        pass


@pytest.mark.parametrize(
    "spec",
    [
        Spec(True, False, 2, 9, 5, features="sqrt", bootstrap=True),
        Spec(False, False, 2, 9, 2, bootstrap=True),
        Spec(False, True, 2, 6, loss="absolute"),
        Spec(True, True, 2, 4, subsample=0.8, loss="logistic"),
        Spec(True, False, 2, 2, adaptive=True),
    ],
)
def test_sums_by_feature_and_sibling_give_the_trees_of_whole_histograms(spec, monkeypatch):
    monkeypatch.setattr(trees, "ROWS_AT_ONCE", 700)
    found = [t for k in range(2) for t in _levels(spec).grow([k])]
    monkeypatch.setattr(trees, "Splits", _ByHistogram)
    wanted = [t for k in range(2) for t in _levels(spec).grow([k])]
    for a, b in zip(found, wanted, strict=True):
        for name in ("feature", "cut", "child", "value", "gain"):
            assert np.array_equal(getattr(a, name), getattr(b, name)), name


def test_a_deep_level_needs_no_whole_histogram(monkeypatch):
    model = _levels(Spec(False, False, 1, 12), 20_000, 100)
    tracemalloc.start()
    tree = model.grow([0])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(tree.feature) > 2000  # a histogram of the widest level has about 200 MB, and is copied several times
    assert peak < 300 << 20


class _FromRows:
    """Random thresholds from all rows of a level, as jobs over all rows find them."""

    def __init__(self, bins, columns, spec, values):
        self.bins, self.values = bins, values

    def search(self, asked, row, at, m, y):
        span = trees.ranges(self.bins, row, at, asked.choice)
        cut = trees.thresholds(asked, span, self.values)
        return trees.best_of_random(asked, cut, span, trees.left_sums(self.bins, row, at, m, y, asked.choice, cut))

    def follow(self, *_):
        pass


@pytest.mark.parametrize("large", [2, 40, 10**9])
@pytest.mark.parametrize(
    "spec",
    [
        Spec(True, False, 3, features="sqrt", split="random", bootstrap=True),
        Spec(True, False, 3, 9, 5, features=0.7, split="random"),
        Spec(True, False, 3, min_leaf=3, split="random", bootstrap=True),
        Spec(False, False, 3, split="random"),
        Spec(False, False, 3, min_split=9, features=0.5, split="random", bootstrap=True),
    ],
)
def test_random_thresholds_by_sibling_and_by_rows_are_those_of_whole_levels(spec, large, monkeypatch):
    monkeypatch.setattr(trees, "LARGE", large)
    monkeypatch.setattr(trees, "NEAR", 2_000)
    found = _levels(spec).grow([0, 1, 2])
    monkeypatch.setattr(trees, "RandomSplits", _FromRows)
    wanted = _levels(spec).grow([0, 1, 2])
    assert any(len(t.feature) > 20 for t in found)
    for a, b in zip(found, wanted, strict=True):
        for name in ("feature", "cut", "child", "value", "gain"):
            assert np.array_equal(getattr(a, name), getattr(b, name)), name


def test_random_thresholds_copy_no_whole_level():
    model = _levels(Spec(False, False, 25, 4, split="random"), 20_000, 100)
    tracemalloc.start()
    model.grow(list(range(25)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20  # sums of all rows and features of a level have as much, and are copied several times


@pytest.mark.parametrize("joint", [1, 30, 10**9])
@pytest.mark.parametrize("rows_at_once", [7, 1 << 15])
def test_words_give_the_trees_of_columns(joint, rows_at_once, monkeypatch):
    monkeypatch.setattr(trees, "JOINT_ROWS", joint)
    monkeypatch.setattr(trees, "ROWS_AT_ONCE", rows_at_once)
    x, y, c = sample(260, 9)
    x[3, 4] = np.nan  # has the last bin
    x[:, 5] = x[:, 0]  # of equal gains the first feature counts
    bins, key = Bins.of(np.nan_to_num(x)), np.arange(260)
    for spec, target in [
        (Spec(False, False, 3, 6, 2, bootstrap=True), y), (Spec(True, False, 2, None, balanced=True), c),
        (Spec(False, True, 4, 3, step=0.3, subsample=0.8), y), (Spec(True, True, 4, 3, step=0.3, loss="logistic"), c),
        (Spec(False, True, 4, 5, step=0.3, loss="absolute"), y), (Spec(False, False, 3, 3, adaptive=True), y),
    ]:
        words = trees.Words(bins.sizes, 260)
        words.fill(0, bins(x[:2]))
        words.fill(2, bins(x[2:]))
        assert np.array_equal(words[np.repeat(key, 9), np.tile(np.arange(9), 260)].reshape(-1, 9), bins(x))
        grown = []
        for held in (bins(x), words):
            rows = InTask(spec, Block(key, key % 3, target, held), bins, 0.0, (1.0, 2.0) if spec.balanced else None, 16.0)
            grown.append([t for n in ensembles.batches_of(spec, 0, spec.trees) for t in rows.grow(n)])
        assert len(grown[0]) == len(grown[1]) > 0
        for a, b in zip(*grown):
            for name in ("feature", "cut", "child", "value", "gain"):
                assert np.array_equal(getattr(a, name), getattr(b, name)), (spec, name)


def test_rows_read_by_each_task_give_the_trees_of_rows_sent(spark, monkeypatch):
    x, y, c = sample(120)
    rows = frame(spark, x, y, c).repartition(3)
    specs = [
        Spec(False, False, 5, 6, 2, bootstrap=True), Spec(False, True, 4, 3, step=0.3, loss="absolute", held_out=1),
        Spec(False, False, 4, features="sqrt"), Spec(False, False, 3, split="random"), Spec(False, False, 3, 3, adaptive=True),
    ]
    table = ensembles.binned(rows, "target_log", fold="fold")
    sent = ensembles.fit_all(specs, table)
    searched = [s for s in specs if not s.adaptive]
    marks = [[2, s.trees] for s in searched]
    scores = sorted(map(tuple, ensembles.held_out_scores([*map(lambda s: ensembles.replace(s, held_out=1), searched)], marks, table).collect()))
    monkeypatch.setattr(ensembles, "SENT", 10)
    monkeypatch.setattr(ensembles, "LONG_TREES_AT_ONCE", 2)
    monkeypatch.setattr(type(table.rows), "toArrow", lambda self: pytest.fail("rows came to the driver"))
    for a, b in zip(sent, ensembles.fit_all(specs, table)):
        assert len(a.trees) == len(b.trees)
        for s, t in zip(a.trees, b.trees):
            assert np.array_equal(s.feature, t.feature) and np.array_equal(s.cut, t.cut) and np.allclose(s.value, t.value)
    again = sorted(map(tuple, ensembles.held_out_scores([*map(lambda s: ensembles.replace(s, held_out=1), searched)], marks, table).collect()))
    assert [r[:5] for r in again] == [r[:5] for r in scores] and np.allclose([r[5] for r in again], [r[5] for r in scores])


def test_thresholds_are_the_last_bins_with_a_value_at_most_the_drawn_one():
    rng = np.random.default_rng(9)
    for width in (1, 7):
        values = np.sort(rng.normal(size=(width, trees.BINS)), axis=1)
        values[:, 40:] = np.inf
        values[0, 10:20] = values[0, 10]
        choice = np.broadcast_to(np.arange(width), (50, width))
        low, high = np.sort(rng.integers(0, 40, (2, 50, width)), axis=0)
        asked = trees.Asked(Spec(False, False, 1, split="random"), np.zeros(50, int), np.arange(50), np.ones(50), np.ones(50), choice, None)
        got = trees.thresholds(asked, np.stack([low, high]).astype(np.int16), values)
        u = trees.hashed(42, 3, np.zeros((50, 1), int), np.arange(50)[:, None], choice)
        for i, f in itertools.product(range(50), range(width)):
            a, b = low[i, f], high[i, f]
            t = values[f, a] + u[i, f] * (values[f, b] - values[f, a])
            assert got[i, f] == max([k for k in range(a, b) if values[f, k] <= t], default=a)
