"""Grid searches over thresholds, exponents and weights, each as one job.

A grid is a literal array exploded next to every prediction, so all of its points are
scored in the same two groupings. Grids are built from whole numbers, so that the
values on both sides of a comparison are the same doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from buyerscope.functions.exprs import clip0
from buyerscope.operators.ranks import grid_metrics, with_rank
from buyerscope.sources.staging import staged

# The published grids, in hundredths (alphas in tenths).
PIPELINE_THRESHOLDS = tuple(range(5, 51, 5))
BOOSTING_THRESHOLDS = tuple(range(65, 82))
FOREST_THRESHOLDS = tuple(range(40, 61))
ALPHAS = (4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 16, 18, 20)
BLEND_WEIGHTS = tuple(range(0, 101, 10))
FIRST_MODEL_THRESHOLD = 0.50
SECOND_MODEL_THRESHOLD = 0.75


def grid(values, unit: float, name: str) -> Column:
    return F.explode(F.array(*[F.lit(v / unit) for v in values])).alias(name)


def soft_score(p: str, amount: str) -> Column:
    """Expected revenue: chance to buy times amount, never below 0."""
    return clip0(F.col(p) * clip0(amount))


def hard_score(p: str, amount: str, threshold: Column) -> Column:
    """The amount for those at or above the threshold, 0 for the rest."""
    return F.when(F.col(p) >= threshold, clip0(amount)).otherwise(F.lit(0.0))


def ranked_truth(preds: DataFrame, y: str = "y", key: str = "cust_id") -> DataFrame:
    """Adds the rank of the true value once, for every metric that follows.

    Predictions are read many times from here on, so they are staged before and after.
    """
    if "y_rank" in preds.columns:
        return preds
    return staged(with_rank(staged(preds, "predictions"), y, "y_rank"), "ranked")


def threshold_sweep(preds: DataFrame, values=PIPELINE_THRESHOLDS, unit: float = 100.0) -> DataFrame:
    """``threshold, pred_buyers, MAE, Spearman`` of the hard rule at every threshold (value / unit)."""
    rows = ranked_truth(preds).select("y", "y_rank", "p_buy", "amount", grid(values, unit, "threshold"))
    buys = (F.col("p_buy") >= F.col("threshold")).cast("long")
    scored = rows.withColumn("pred", hard_score("p_buy", "amount", F.col("threshold")))
    out = grid_metrics(scored, ["threshold"], "y", "y_rank", "pred", [buys])
    return out.select("threshold", F.col("_x0").alias("pred_buyers"), "MAE", "Spearman")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Lowest MAE; of equal ones the smallest threshold."""
    return sweep.orderBy("MAE", "threshold").limit(1)


def soft_metrics(preds: DataFrame) -> DataFrame:
    rows = ranked_truth(preds).withColumn("pred", soft_score("p_buy", "amount"))
    return grid_metrics(rows, [], "y", "y_rank", "pred").select("MAE", "Spearman")


def strategy_choice(preds: DataFrame, values=PIPELINE_THRESHOLDS, unit: float = 100.0) -> DataFrame:
    """One row: soft and best hard result side by side, and the one that is chosen."""
    ranked = ranked_truth(preds)
    soft = soft_metrics(ranked).select(
        F.col("MAE").alias("mae_expected"), F.col("Spearman").alias("spearman_expected"), F.lit(1).alias("_j")
    )
    hard = best_threshold(threshold_sweep(ranked, values, unit)).select(
        F.col("threshold").alias("best_threshold"),
        F.col("MAE").alias("best_threshold_mae"),
        F.col("Spearman").alias("best_threshold_spearman"),
        F.lit(1).alias("_j"),
    )
    return soft.join(hard, "_j").select(
        "mae_expected",
        "spearman_expected",
        "best_threshold",
        "best_threshold_mae",
        "best_threshold_spearman",
        F.when(F.col("mae_expected") <= F.col("best_threshold_mae"), F.lit("expected"))
        .otherwise(F.lit("threshold"))
        .alias("chosen_strategy"),
    )


def alpha_sweep(preds: DataFrame, values=ALPHAS, digits: int | None = None) -> DataFrame:
    """MAE and Spearman of ``p^alpha * amount``; with ``digits`` powers equal but for the last bit tie."""
    rows = ranked_truth(preds).select("y", "y_rank", "p_buy", "amount", grid(values, 10.0, "alpha"))
    pred = clip0(F.pow("p_buy", "alpha") * clip0("amount"))
    scored = rows.withColumn("pred", pred if digits is None else F.round(pred, digits))
    return grid_metrics(scored, ["alpha"], "y", "y_rank", "pred").select("alpha", "MAE", "Spearman")


def blend_sweep(preds: DataFrame, first: str, second: str, values=BLEND_WEIGHTS) -> DataFrame:
    """MAE and Spearman of weighted means of two predictions; weights of the first."""
    rows = ranked_truth(preds).select("y", "y_rank", first, second, grid(values, 100.0, "weight"))
    mixed = F.col("weight") * F.col(first) + (F.lit(1.0) - F.col("weight")) * F.col(second)
    scored = rows.withColumn("pred", clip0(mixed))
    out = grid_metrics(scored, ["weight"], "y", "y_rank", "pred")
    return out.select(
        F.col("weight").alias("weight_first"),
        F.round(F.lit(1.0) - F.col("weight"), 2).alias("weight_second"),
        "MAE",
        "Spearman",
    )


def blend_summary(preds: DataFrame, first: str, second: str, values=BLEND_WEIGHTS) -> DataFrame:
    """Both predictions alone and their best blend, best first."""
    sweep = blend_sweep(ranked_truth(preds), first, second, values)
    best = sweep.orderBy("MAE", F.desc("Spearman"), "weight_first").limit(1)

    def row(rows: DataFrame, name: Column) -> DataFrame:
        return rows.select(name.alias("model_name"), "MAE", "Spearman")

    label = F.format_string("blend_%.1f_%.1f", "weight_first", "weight_second")
    return (
        row(sweep.where("weight_first = 1"), F.lit(first))
        .unionByName(row(sweep.where("weight_first = 0"), F.lit(second)))
        .unionByName(row(best, label))
        .orderBy("MAE", F.desc("Spearman"), "model_name")
    )


def combo_table(preds: DataFrame, classifiers: dict[str, str], regressors: dict[str, str]) -> DataFrame:
    """Every classifier with every regressor; names map to the prediction columns."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("classifier"),
                    F.lit(r).alias("regressor"),
                    clip0(F.col(pc) * clip0(rc)).alias("pred"),
                )
                for c, pc in classifiers.items()
                for r, rc in regressors.items()
            ]
        )
    ).alias("c")
    rows = ranked_truth(preds).select("y", "y_rank", pairs).select("y", "y_rank", "c.*")
    out = grid_metrics(rows, ["classifier", "regressor"], "y", "y_rank", "pred")
    return out.select("classifier", "regressor", "MAE", "Spearman")


def weight_search(
    preds: DataFrame, first: str = "pred_first", second: str = "pred_second"
) -> DataFrame:
    """Coarse weights of the second model by tenths, then finer ones around the best.

    The fine grid runs from ten hundredths below the best coarse weight to ten above,
    in steps of two, inside 0 and 1. Only the one best weight comes to the driver.
    """
    ranked = ranked_truth(preds)

    def sweep(values, stage: str) -> DataFrame:
        return blend_sweep(ranked, second, first, values).select(
            F.lit(stage).alias("stage"),
            F.col("weight_second").alias("weight_first"),
            F.col("weight_first").alias("weight_second"),
            "MAE",
            "Spearman",
        )

    coarse = sweep(BLEND_WEIGHTS, "coarse")
    best = coarse.orderBy("MAE", "weight_second").first().weight_second
    middle = round(best * 100)
    fine = sweep(range(max(0, middle - 10), min(100, middle + 10) + 1, 2), "fine")
    return coarse.unionByName(fine)


def ensemble_score(preds: DataFrame, weight_second: float) -> DataFrame:
    """Weighted sum of the two thresholded predictions, never below 0."""
    w = F.lit(float(weight_second))
    first = (F.lit(1.0) - w) * F.col("pred_first")
    return preds.select("cust_id", clip0(first + w * F.col("pred_second")).alias("prediction"))


def leaderboard(results: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """Results of several models, ranked by MAE, then Spearman, then name.

    The table has one row per model, so the ranking window over all of it stays small.
    """
    from pyspark.sql import Window

    both = results.unionByName(other, allowMissingColumns=True) if other is not None else results
    order = Window.orderBy(F.col("MAE"), F.desc("Spearman"), F.col("model_name"))
    return both.withColumn("place", F.row_number().over(order))
