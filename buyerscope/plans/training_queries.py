"""Registered queries that train models. SQL checks what does not depend on a learner; rows and ranges the rest."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerscope.features import store
from buyerscope.models import chains, search, sweeps, twostage
from buyerscope.operators.ranks import auc
from buyerscope.operators.target_stats import dominant_values
from buyerscope.plans.cleaning_queries import FAVOURITES
from buyerscope.plans.shape import shaped, sql_num
from buyerscope.settings import ModelSettings
from buyerscope.sources import retail_view as view
from buyerscope.sources.staging import staged

QUERIES: dict = {}
ORACLE: dict = {}

SETTINGS = ModelSettings()
PIPELINE = twostage.TwoStagePipeline(SETTINGS)


def _add(name: str):
    def keep(fn):
        QUERIES[name] = fn
        return fn

    return keep


def _features(spark: SparkSession, d: str) -> DataFrame:
    items = staged(view.transactions(spark, d).select(*store.columns_read(store.kept_features())), "items")
    return staged(store.customer_features(items, view.FEATURES), "features")


def _rows(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    return PIPELINE.training_rows(_features(spark, d), view.train_labels(spark, d))


def _parts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.where("is_validation = 0"), rows.where("is_validation = 1")


@_add("fit_classifier")
def fit_classifier(spark, d):
    rows, names = _rows(spark, d)
    model = twostage.fit_classifier(twostage.default_classifier(SETTINGS), _parts(rows)[0])
    size = rows.agg(F.count("*").alias("n_customers"), F.avg("target_binary").alias("buyer_ratio"))
    return shaped(
        size.withColumns({"n_features": F.lit(len(names)), "n_trees": F.lit(len(model.trees))})
    )


@_add("fit_regressor")
def fit_regressor(spark, d):
    """Boosting on buyers cut to its best round on validation: that round, and both errors there."""
    rows, names = _rows(spark, d)
    train, valid = _parts(rows)
    model = search.fit_best_prefix(search.watched_regressor(), train, valid)
    curve = search.learning_curve(model, twostage.buyers(train), twostage.buyers(valid))
    return shaped(curve.where(F.col("iteration") == len(model.trees)).withColumn("n_features", F.lit(len(names))))


ORACLE["fit_classifier"] = f"""{view.oracle_tables()}
SELECT count(*) AS n_customers, {sql_num("avg(CASE WHEN revenue_2018_2019 > 0 THEN 1.0 ELSE 0.0 END)", "buyer_ratio")},
  cast({len(store.kept_features())} as bigint) AS n_features, cast({SETTINGS.classifier_trees} as bigint) AS n_trees FROM train"""


@_add("buy_probability")
def buy_probability(spark, d):
    rows, _ = _rows(spark, d)
    train, valid = _parts(rows)
    model = twostage.fit_classifier(twostage.default_classifier(SETTINGS), train)
    return shaped(twostage.buy_probability(model, valid).select("cust_id", "p_buy"))


@_add("classifier_with_categories")
def classifier_with_categories(spark, d):
    """Stage one without and with the favourite brand and season of each customer, by AUC on validation."""
    train, valid = _parts(_rows(spark, d)[0])
    bought = view.transactions(spark, d).select("cust_id", *FAVOURITES)
    favourites = staged(dominant_values(bought, "cust_id", list(FAVOURITES)), "favourites")
    wide_train, wide_valid, added = twostage.with_categories(train, valid, favourites, seed=SETTINGS.seed)
    boards = []
    for n, a, b in ((0, train, valid), (len(added), staged(wide_train, "wide"), wide_valid)):
        model = twostage.fit_classifier(twostage.default_classifier(SETTINGS), a)
        found = auc(twostage.buy_probability(model, b), [], "target_binary", "p_buy")
        boards.append(found.withColumn("n_categories", F.lit(n)))
    return shaped(boards[0].unionByName(boards[1]))


@_add("evaluate_two_stage")
def evaluate_two_stage(spark, d):
    rows, names = _rows(spark, d)
    return shaped(PIPELINE.validate(rows, names).evaluation)


@_add("model_leaderboard")
def model_leaderboard(spark, d):
    rows, _ = _rows(spark, d)
    with ThreadPoolExecutor(1) as beside:
        direct = beside.submit(search.direct_regression, rows)
        board, failed = search.model_leaderboard(rows, search.model_pairs(SETTINGS))
    board = sweeps.leaderboard(board.drop("place"), direct.result()[1])
    lost = spark.createDataFrame(list(failed.items()), "model_name string, error string")
    return shaped(board.unionByName(lost, allowMissingColumns=True))


def _full_run(spark, d) -> twostage.TwoStageRun:
    return PIPELINE.run(_features(spark, d), view.train_labels(spark, d), view.test_customers(spark, d))


@_add("scored_customers")
def scored_customers(spark, d):
    return shaped(_full_run(spark, d).scored)


@_add("two_stage_run")
def two_stage_run(spark, d):
    """Evaluation and choice on validation, with the summary of the scored customers."""
    from buyerscope.operators.profile import prediction_summary
    from buyerscope.settings import SCORED

    run = _full_run(spark, d)
    summary = prediction_summary(run.scored, SCORED).withColumn("_j", F.lit(1))
    return shaped(run.evaluation.withColumn("_j", F.lit(1)).join(summary, "_j").drop("_j"))


@_add("random_search")
def random_search(spark, d):
    """The published boosting grid searched for both stages, the best refitted, and how many test customers they score."""
    grids = (search.BOOSTING_GRID, search.BOOSTING_GRID)
    table, run = chains.tuned_run(PIPELINE, _tables(spark, d), search.BOOSTING_BASES, grids)
    return shaped(table.withColumn("n_scored", F.lit(run.scored.count())).withColumn("strategy", F.lit(run.strategy)))


@_add("top_features")
def top_features(spark, d):
    rows, names = _rows(spark, d)
    model = twostage.fit_classifier(twostage.default_classifier(SETTINGS), _parts(rows)[0])
    return shaped(search.top_features(spark, model, names, 15))


@_add("permutation_importance")
def permutation_importance(spark, d):
    rows, names = _rows(spark, d)
    train, valid = _parts(rows)
    model = twostage.fit_regressor(twostage.default_regressor(SETTINGS), train)
    top = [r.feature for r in search.top_features(spark, model, names, 20).collect()]
    return shaped(
        search.permutation_importance(twostage.buyers(valid), model, names, top, "target_log")
    )


@_add("learning_curve")
def learning_curve(spark, d):
    rows, _ = _rows(spark, d)
    train, valid = (twostage.buyers(p) for p in _parts(rows))
    model = search.watched_regressor().fit(train)
    return shaped(search.learning_curve(model, train, valid))


@_add("run_summary")
def run_summary(spark, d):
    rows, names = _rows(spark, d)
    run = PIPELINE.validate(rows, names)
    params = {"classifier_trees": SETTINGS.classifier_trees, "max_depth": SETTINGS.max_depth}
    return shaped(search.run_summary(spark, "forest + forest", params, run))


@_add("single_stage_run")
def single_stage_run(spark, d):
    """Direct regression on revenue: scored test customers."""
    from buyerscope.sources.files import scored_customers as two_columns

    features = _features(spark, d)
    rows, names = PIPELINE.training_rows(features, view.train_labels(spark, d))
    model, _ = search.direct_regression(rows)
    test = twostage.join_test_customers(features, view.test_customers(spark, d))
    scored = model.transform(twostage.conformed_vectors(test, names))
    return shaped(two_columns(scored.withColumn("prediction", sweeps.clip0("prediction"))))


def _tables(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    return _features(spark, d), view.train_labels(spark, d), view.test_customers(spark, d)


def _forest_search(spark, d, stage: int) -> DataFrame:
    rows, _ = _rows(spark, d)
    return shaped(search.random_search(_parts(rows)[0], search.FOREST_BASES[stage], search.FOREST_GRID).table(spark))


@_add("forest_search")
def forest_search(spark, d):
    """The published grid of randomized-split forests, for the chance to buy."""
    return _forest_search(spark, d, 0)


@_add("forest_search_amounts")
def forest_search_amounts(spark, d):
    """The same grid for the amount of buyers."""
    return _forest_search(spark, d, 1)


@_add("ensemble_test_customers")
def ensemble_test_customers(spark, d):
    """Boosting and randomized-split forests, each behind its threshold, weighted and refitted: scored test customers."""
    first = (search.boosting_classifier(), search.boosting_regressor())
    second = (search.randomized_classifier(SETTINGS), search.randomized_regressor(SETTINGS))
    return shaped(chains.ensemble_run(PIPELINE, _tables(spark, d), first, second).scored)


@_add("combination_run")
def combination_run(spark, d):
    """Three classifiers with two regressors on validation; the best pair scores the test customers."""
    pairs = search.model_pairs(SETTINGS)
    classifiers = {"LogReg": pairs["LogReg + RF"][0], "RF": pairs["RF + RF"][0], "GBT": pairs["GBT + GBT"][0]}
    regressors = {"RF": pairs["RF + RF"][1], "GBT": pairs["GBT + GBT"][1]}
    run = chains.combination_run(PIPELINE, _tables(spark, d), classifiers, regressors)
    return shaped(run.board.withColumn("n_scored", F.lit(run.scored.count())))
