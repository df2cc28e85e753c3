"""Two-stage buy / how-much model.

Stage one predicts the chance to buy, stage two the log revenue of buyers; the result
is either their product or the amount behind a hard threshold, whichever has the lower
error on the validation customers.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from buyerscope.functions.exprs import clip0, date_ordinal
from buyerscope.models import sweeps
from buyerscope.models.ensembles import Trees
from buyerscope.models.trees import Spec
from buyerscope.operators.clean import prepare_frames
from buyerscope.operators.ranks import auc
from buyerscope.operators.split import stratified_split
from buyerscope.operators.target_stats import with_statistics
from buyerscope.schema import conform_columns, numeric_columns
from buyerscope.settings import TARGET, ModelSettings
from buyerscope.sources.files import scored_customers
from buyerscope.sources.staging import staged

DATE_FEATURES = ("first_purchase", "last_purchase")
NOT_FEATURES = ("cust_id", TARGET, "target_binary", "target_reg", "target_log", "is_validation")


def with_targets(df: DataFrame, target: str = TARGET) -> DataFrame:
    """``target_binary``, ``target_reg`` and ``target_log``."""
    return df.withColumns(
        {
            "target_binary": F.when(F.col(target) > 0, 1).otherwise(0),
            "target_reg": F.col(target).cast("double"),
            "target_log": F.log1p(target),
        }
    )


def buyers(df: DataFrame) -> DataFrame:
    return df.where("target_binary = 1")


def join_labels_left(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Every labelled customer with features; missing numbers are 0."""
    joined = labels.join(features, "cust_id", "left")
    return joined.fillna(0, subset=[c for c in numeric_columns(joined) if c != "cust_id"])


def join_test_customers(features: DataFrame, test: DataFrame) -> DataFrame:
    """Every customer to be scored, with features where there are any.

    A target column that came along with the customers is left out.
    """
    return test.select("cust_id").join(features, "cust_id", "left")


def dates_to_ordinals(df: DataFrame) -> DataFrame:
    return df.withColumns({c: date_ordinal(c) for c in DATE_FEATURES if c in df.columns})


def feature_names(df: DataFrame) -> list[str]:
    """The numeric columns that are neither key nor target."""
    return [c for c in numeric_columns(df) if c not in NOT_FEATURES]


def assembled(df: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """``cust_id``, the kept columns and one ``features`` vector; missing numbers are 0."""
    filled = df.select(
        "cust_id",
        *keep,
        *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in names],
    )
    vector = VectorAssembler(inputCols=names, outputCol="features").transform(filled)
    return vector.select("cust_id", *keep, "features")


def with_categories(
    train: DataFrame, others: DataFrame, categories: DataFrame, target: str = "target_binary", seed: int = 0
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both assembled frames with text columns of ``categories`` (one row per customer) as further features.

    Each category is the mean ``target`` of its training rows; a training row sees those
    before it. Text that reads as dates in the training rows becomes seconds. Returns the
    frames and the names added.
    """
    added = [c for c in categories.columns if c != "cust_id"]
    known = staged(train.join(categories, "cust_id", "left"), "train-categories")
    (a, b), text = prepare_frames(known, [others.join(categories, "cust_id", "left")])
    a, b = with_statistics(a, b, text, target, ["cust_id"], seed=seed)
    names = [n for n in a.columns if n not in train.columns]
    wide = VectorAssembler(inputCols=["features", *names], outputCol="_wide")

    def widened(df: DataFrame) -> DataFrame:
        return wide.transform(df).drop("features", *added, *names).withColumnRenamed("_wide", "features")

    return widened(a), widened(b), names


def with_balanced_weight(df: DataFrame) -> DataFrame:
    """Weight n / (2 * n_class), so that both classes weigh the same."""
    sizes = df.agg(
        F.struct(F.count("*").alias("n"), F.sum("target_binary").alias("pos"))
    ).scalar()
    of_class = F.when(F.col("target_binary") == 1, sizes["pos"]).otherwise(sizes["n"] - sizes["pos"])
    return df.withColumn("weight", sizes["n"] / (of_class * 2.0))


def default_classifier(s: ModelSettings) -> Trees:
    """Bagged trees on classes that weigh the same."""
    spec = Spec(
        True, False, s.classifier_trees, s.max_depth, s.min_leaf, features="sqrt", bootstrap=True, balanced=True, seed=s.seed
    )
    return Trees(spec, "target_binary")


def default_regressor(s: ModelSettings) -> Trees:
    return Trees(Spec(False, False, s.regressor_trees, s.max_depth, s.min_leaf, bootstrap=True, seed=s.seed), "target_log")


def together(*jobs: Callable) -> list:
    """What independent jobs give, run side by side: one fills the slots that the others leave free."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def fit_classifier(estimator: Estimator, train: DataFrame) -> Model:
    if not estimator.hasParam("probabilityCol"):
        raise TypeError(f"{type(estimator).__name__} gives no probabilities; stage one needs them")
    return estimator.fit(with_balanced_weight(train))


def fit_regressor(estimator: Estimator, train: DataFrame) -> Model:
    """Fit on buyers only; an early-stopping marker column is left to the estimator."""
    rows = buyers(train)
    if rows.limit(1).count() == 0:
        raise ValueError("no buyers in the training rows")
    return estimator.fit(rows)


def buy_probability(model: Model, rows: DataFrame) -> DataFrame:
    """Adds ``p_buy``, the probability of class 1 of a two-class model."""
    if getattr(model, "numClasses", 2) != 2:
        raise ValueError("stage one needs a model with exactly two classes")
    added = ("rawPrediction", "probability", "prediction")
    return model.transform(rows).withColumn("p_buy", vector_to_array("probability")[1]).drop(*added)


def predicted_amount(model: Model, rows: DataFrame) -> DataFrame:
    """Adds ``amount``: the log prediction taken back to revenue, at least 0."""
    out = model.transform(rows)
    return out.withColumn("amount", clip0(F.expm1("prediction"))).drop("prediction")


def predict(classifier: Model, regressor: Model, rows: DataFrame) -> DataFrame:
    scored = predicted_amount(regressor, buy_probability(classifier, rows))
    return scored.drop("features")


def evaluate(preds: DataFrame, thresholds=sweeps.PIPELINE_THRESHOLDS, unit: float = 100.0) -> DataFrame:
    """AUC, both strategies and the choice between them as one row.

    ``preds`` has cust_id, y, p_buy and amount; it is staged once and every metric
    reads the staged rows.
    """
    ranked = sweeps.ranked_truth(preds)
    area = auc(ranked.withColumn("buyer", (F.col("y") > 0).cast("int")), [], "buyer", "p_buy")
    choice = sweeps.strategy_choice(ranked, thresholds, unit)
    return area.withColumn("_j", F.lit(1)).join(choice.withColumn("_j", F.lit(1)), "_j").drop("_j")


@dataclass(frozen=True)
class TwoStageRun:
    """What a run leaves behind. Tables are DataFrames keyed by customer."""

    classifier: Model
    regressor: Model
    names: list[str]
    validation: DataFrame
    evaluation: DataFrame
    strategy: str
    threshold: float
    scored: DataFrame | None = None


@dataclass(frozen=True)
class TwoStagePipeline:
    """Split, fit, evaluate, choose, refit on all labels, score.

    Instances are never changed; ``with_models`` gives a copy with other estimators.
    """

    settings: ModelSettings = field(default_factory=ModelSettings)
    classifier: Estimator | None = None
    regressor: Estimator | None = None

    def with_models(self, classifier=None, regressor=None) -> "TwoStagePipeline":
        return replace(
            self, classifier=classifier or self.classifier, regressor=regressor or self.regressor
        )

    def models(self) -> dict[str, Estimator]:
        return {
            "classifier": self.classifier or default_classifier(self.settings),
            "regressor": self.regressor or default_regressor(self.settings),
        }

    def training_rows(self, features: DataFrame, train: DataFrame) -> tuple[DataFrame, list[str]]:
        """Labelled customers that have features, split and assembled; staged."""
        joined = with_targets(dates_to_ordinals(features).join(train, "cust_id"))
        names = feature_names(joined)
        split = stratified_split(
            joined, "target_binary", share=self.settings.validation_share, seed=self.settings.seed
        )
        keep = ["target_binary", "target_reg", "target_log", "is_validation"]
        return staged(assembled(split, names, keep), "training"), names

    def validate(self, rows: DataFrame, names: list[str]) -> TwoStageRun:
        clf, reg = self.refit(rows.where("is_validation = 0"))
        checked = rows.where("is_validation = 1").withColumn("y", F.col("target_reg"))
        preds = sweeps.ranked_truth(predict(clf, reg, checked).select("cust_id", "y", "p_buy", "amount"))
        result = staged(evaluate(preds, self.settings.thresholds, 1.0), "evaluation")
        chosen = result.first()
        return TwoStageRun(clf, reg, names, preds, result, chosen.chosen_strategy, chosen.best_threshold)

    def refit(self, rows: DataFrame) -> tuple[Model, Model]:
        models = self.models()
        clf, reg = together(
            lambda: fit_classifier(models["classifier"], rows), lambda: fit_regressor(models["regressor"], rows)
        )
        return clf, reg

    def run(self, features: DataFrame, train: DataFrame, test: DataFrame) -> TwoStageRun:
        return self.complete(*self.training_rows(features, train), features, test)

    def complete(self, rows: DataFrame, names: list[str], features: DataFrame, test: DataFrame) -> TwoStageRun:
        """Everything after ``training_rows``; the refit does not wait for the validation."""
        checked, (clf, reg) = together(lambda: self.validate(rows, names), lambda: self.refit(rows))
        scored = score_customers(
            clf, reg, join_test_customers(features, test), names, checked.strategy, checked.threshold
        )
        return replace(checked, classifier=clf, regressor=reg, scored=scored)


def conformed_vectors(rows: DataFrame, names: list[str]) -> DataFrame:
    """Customers to be scored with the columns of training; absent ones are 0."""
    return assembled(conform_columns(dates_to_ordinals(rows), names), names, [])


def score_customers(
    classifier: Model,
    regressor: Model,
    rows: DataFrame,
    names: list[str],
    strategy: str,
    threshold: float,
) -> DataFrame:
    """The two-column result: the columns of training, absent ones as 0, then both models."""
    preds = predict(classifier, regressor, conformed_vectors(rows, names))
    if strategy == "expected":
        amount = sweeps.soft_score("p_buy", "amount")
    else:
        amount = sweeps.hard_score("p_buy", "amount", F.lit(float(threshold)))
    return scored_customers(preds.withColumn("prediction", amount))


def count_without_features(features: DataFrame, test: DataFrame) -> int:
    """Customers to be scored that have no feature row; counted before any fill."""
    return test.join(features.select("cust_id"), "cust_id", "left_anti").count()
