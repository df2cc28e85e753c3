"""Registered queries for metrics, sweeps and leaderboards.

They run on a prediction table that is plain arithmetic on each customer's items, so a
check query can compute the same numbers without training a model. Amounts and targets
are whole currency units before any division: sums of cents may differ in their last
bit between engines, and a rank must not depend on that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerscope.features import store
from buyerscope.models import sweeps
from buyerscope.models.twostage import DATE_FEATURES
from buyerscope.operators import profile
from buyerscope.operators.ranks import auc, grid_metrics
from buyerscope.plans.features_check import feature_check
from buyerscope.plans.shape import shaped, sql_int, sql_num
from buyerscope.settings import TARGET
from buyerscope.sources import files, retail_view as view
from buyerscope.sources.staging import staged, staged_path

QUERIES: dict = {}
ORACLE: dict = {}

_PREDICTIONS = {
    "y": "floor(revenue_2018_2019 + 0.00003)",
    "p_a": "((n_items * 7 + n_sales) % 100) / 100.0",
    "p_b": "((n_items * 13 + net) % 100) / 100.0",
    "amount_a": "net / (n_sales + 1.0)",
    "amount_b": "(n_items * 1000 + cust_id % 997) / 7.0",
}
_NET = "cast(floor(coalesce(sum(case when is_returned = 0 then sale_revenue end), 0) + 0.00003) as bigint)"


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """cust_id, y, buyer, two chances and two amounts, and two thresholded predictions."""
    facts = (
        view.transactions(spark, d)
        .groupBy("cust_id", "sale_id")
        .agg(
            F.count("*").alias("rows"),
            F.sum(F.when(F.col("is_returned") == 0, F.col("sale_revenue"))).alias("rev"),
        )
        .groupBy("cust_id")
        .agg(
            F.sum("rows").alias("n_items"),
            F.count("sale_id").alias("n_sales"),
            F.floor(F.coalesce(F.sum("rev"), F.lit(0.0)) + F.lit(0.00003)).alias("net"),
        )
    )
    rows = view.train_labels(spark, d).join(facts, "cust_id")
    exact = rows.select("cust_id", *[F.expr(f"cast({e} as double)").alias(n) for n, e in _PREDICTIONS.items()])
    return exact.withColumns(
        {
            "buyer": (F.col("y") > 0).cast("int"),
            "p_buy": F.col("p_a"),
            "amount": F.col("amount_a"),
            "pred_first": sweeps.hard_score("p_a", "amount_a", F.lit(sweeps.FIRST_MODEL_THRESHOLD)),
            "pred_second": sweeps.hard_score("p_b", "amount_b", F.lit(sweeps.SECOND_MODEL_THRESHOLD)),
        }
    )


_exprs = ", ".join(f"cast({e} as double) AS {n}" for n, e in _PREDICTIONS.items())
WITH = f"""{view.oracle_tables()},
facts AS (SELECT cust_id, count(*) AS n_items, count(DISTINCT sale_id) AS n_sales, {_NET} AS net FROM tx GROUP BY 1),
p0 AS (SELECT cust_id, {_exprs} FROM train JOIN facts USING (cust_id)),
preds AS (SELECT *, case when y > 0 then 1 else 0 end AS buyer, p_a AS p_buy, amount_a AS amount,
  case when p_a >= 0.5 then greatest(amount_a, 0) else 0 end AS pred_first,
  case when p_b >= 0.75 then greatest(amount_b, 0) else 0 end AS pred_second FROM p0)"""


def _grid_sql(keys: str, pred: str, source: str, extra: str = "") -> str:
    """CTE ``scored`` with one row per key: MAE and Spearman by average ranks."""
    part = f"PARTITION BY {keys}" if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""

    def avg_rank(col):
        own = f"PARTITION BY {lead}{col}"
        return f"rank() OVER ({part} ORDER BY {col}) + (count(*) OVER ({own}) - 1) / 2.0"

    return f"""guess AS (SELECT *, {pred} AS guess FROM {source}),
ranks AS (SELECT *, {avg_rank("y")} AS ry, {avg_rank("guess")} AS rp FROM guess),
scored AS (SELECT {lead}avg(abs(y - guess)) AS mae,
  coalesce(case when isnan(corr(ry, rp)) then 0 else corr(ry, rp) end, 0) AS rho{extra} FROM ranks {group})"""


_MAE, _RHO = sql_num("mae", "MAE"), sql_num("rho", "Spearman", 6)


_FINE = ("Spearman", "Spearman_buyers", "spearman_expected", "best_threshold_spearman", "AUC")


def _metrics(df: DataFrame) -> DataFrame:
    """Rank metrics at 6 digits, everything else at 4."""
    return shaped(df, 4, fine={c: 6 for c in _FINE})


def _add(name: str, sql: str):
    def keep(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn

    return keep


@_add("mae", f"{WITH}\nSELECT {sql_num('avg(abs(y - amount))', 'MAE')}, count(*) AS n FROM preds")
def mae(spark, d):
    rows = predictions(spark, d)
    return shaped(rows.agg(F.avg(F.abs(F.col("y") - F.col("amount"))).alias("MAE"), F.count("*").alias("n")))


@_add(
    "spearman",
    f"{WITH}, {_grid_sql('', 'amount', 'preds')}\nSELECT {_RHO} FROM scored",
)
def spearman(spark, d):
    rows = sweeps.ranked_truth(predictions(spark, d))
    return _metrics(grid_metrics(rows, [], "y", "y_rank", "amount").select("Spearman"))


@_add(
    "auc",
    f"""{WITH}, r AS (SELECT buyer, rank() OVER (ORDER BY p_buy) + (count(*) OVER (PARTITION BY p_buy) - 1) / 2.0 AS rp FROM preds)
SELECT round((sum(rp) FILTER (buyer = 1) - sum(buyer) * (sum(buyer) + 1) / 2.0) / (sum(buyer) * (count(*) - sum(buyer))) + 1e-7, 6) AS "AUC" FROM r""",
)
def auc_query(spark, d):
    return _metrics(auc(predictions(spark, d), [], "buyer", "p_buy"))


@_add(
    "soft_score",
    f"{WITH}\nSELECT {sql_int('cust_id', 'cust_id')}, {sql_num('greatest(p_buy * greatest(amount, 0), 0)', 'prediction')} FROM preds",
)
def soft_score(spark, d):
    rows = predictions(spark, d)
    return shaped(rows.select("cust_id", sweeps.soft_score("p_buy", "amount").alias("prediction")))


@_add(
    "threshold_apply",
    f"{WITH}\nSELECT {sql_int('cust_id', 'cust_id')}, {sql_num('case when p_buy >= 0.5 then greatest(amount, 0) else 0 end', 'prediction')} FROM preds",
)
def threshold_apply(spark, d):
    rows = predictions(spark, d)
    hard = sweeps.hard_score("p_buy", "amount", F.lit(0.5))
    return shaped(rows.select("cust_id", hard.alias("prediction")))


@_add(
    "prediction_summary",
    f"{WITH}, s AS (SELECT greatest(p_buy * greatest(amount, 0), 0) AS v FROM preds)\nSELECT count(*) AS n, "
    f"{sql_num('min(v)', 'min')}, {sql_num('max(v)', 'max')}, {sql_num('avg(v)', 'mean')} FROM s",
)
def prediction_summary(spark, d):
    rows = predictions(spark, d).withColumn("v", sweeps.soft_score("p_buy", "amount"))
    return shaped(profile.prediction_summary(rows, "v"))


def _sweep_sql(lo: int, hi: int, step: int) -> str:
    grid = f"grid AS (SELECT cast(k as double) / 100.0 AS threshold FROM range({lo}, {hi + 1}, {step}) t(k))"
    scored = _grid_sql(
        "threshold",
        "case when p_buy >= threshold then greatest(amount, 0) else 0 end",
        "preds, grid",
        ", sum(case when p_buy >= threshold then 1 else 0 end) AS buys",
    )
    return f"{WITH}, {grid}, {scored}"


_SWEEP_COLS = f"{sql_num('threshold', 'threshold')}, {sql_int('buys', 'pred_buyers')}, {_MAE}, {_RHO}"


@_add("threshold_sweep", f"{_sweep_sql(5, 50, 5)}\nSELECT {_SWEEP_COLS} FROM scored")
def threshold_sweep(spark, d):
    return _metrics(sweeps.threshold_sweep(predictions(spark, d)))


@_add("threshold_sweep_boosting", f"{_sweep_sql(65, 81, 1)}\nSELECT {_SWEEP_COLS} FROM scored")
def threshold_sweep_boosting(spark, d):
    return _metrics(sweeps.threshold_sweep(predictions(spark, d), sweeps.BOOSTING_THRESHOLDS))


@_add("threshold_sweep_forest", f"{_sweep_sql(40, 60, 1)}\nSELECT {_SWEEP_COLS} FROM scored")
def threshold_sweep_forest(spark, d):
    return _metrics(sweeps.threshold_sweep(predictions(spark, d), sweeps.FOREST_THRESHOLDS))


@_add(
    "strategy_choice",
    f"""{_sweep_sql(5, 50, 5)},
best AS (SELECT * FROM scored ORDER BY mae, threshold LIMIT 1),
sg AS (SELECT *, greatest(p_buy * greatest(amount, 0), 0) AS s FROM preds),
sr AS (SELECT *, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS a,
  rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS b FROM sg),
soft AS (SELECT avg(abs(y - s)) AS sm, corr(a, b) AS sc FROM sr)
SELECT {sql_num('sm', 'mae_expected')}, {sql_num('sc', 'spearman_expected', 6)}, {sql_num('threshold', 'best_threshold')},
  {sql_num('mae', 'best_threshold_mae')}, {sql_num('rho', 'best_threshold_spearman', 6)},
  case when sm <= mae then 'expected' else 'threshold' end AS chosen_strategy FROM soft, best""",
)
def strategy_choice(spark, d):
    return _metrics(sweeps.strategy_choice(predictions(spark, d)))


_ALPHAS = ", ".join(str(a) for a in sweeps.ALPHAS)


@_add(
    "alpha_sweep",
    f"""{WITH}, grid AS (SELECT cast(k as double) / 10.0 AS alpha FROM (SELECT unnest([{_ALPHAS}]) AS k)),
{_grid_sql("alpha", "round(greatest(pow(p_buy, alpha) * greatest(amount, 0), 0), 6)", "preds, grid")}
SELECT {sql_num('alpha', 'alpha')}, {_MAE}, {_RHO} FROM scored""",
)
def alpha_sweep(spark, d):
    return _metrics(sweeps.alpha_sweep(predictions(spark, d), digits=6))


_MIX = "greatest(w * pred_first + (1.0 - w) * pred_second, 0)"


@_add(
    "blend_sweep",
    f"""{WITH}, grid AS (SELECT cast(k as double) / 100.0 AS w FROM range(0, 101, 10) t(k)),
{_grid_sql("w", _MIX, "preds, grid")}
SELECT {sql_num('w', 'weight_first')}, {sql_num('round(1.0 - w, 2)', 'weight_second')}, {_MAE}, {_RHO} FROM scored""",
)
def blend_sweep(spark, d):
    return _metrics(sweeps.blend_sweep(predictions(spark, d), "pred_first", "pred_second"))


@_add(
    "blend_summary",
    f"""{WITH}, grid AS (SELECT cast(k as double) / 100.0 AS w FROM range(0, 101, 10) t(k)),
{_grid_sql("w", _MIX, "preds, grid")}
SELECT case w when 1 then 'pred_first' else 'pred_second' end AS model_name, {_MAE}, {_RHO} FROM scored WHERE w IN (0, 1)
UNION ALL SELECT printf('blend_%.1f_%.1f', w, round(1.0 - w, 2)), {_MAE}, {_RHO}
FROM (SELECT * FROM scored ORDER BY mae, rho DESC, w LIMIT 1)""",
)
def blend_summary(spark, d):
    return _metrics(sweeps.blend_summary(predictions(spark, d), "pred_first", "pred_second"))


@_add(
    "classifier_ranking",
    f"""{WITH}, long AS (SELECT 'a' AS model_name, buyer, p_a AS p FROM preds UNION ALL SELECT 'b', buyer, p_b FROM preds),
r AS (SELECT *, rank() OVER (PARTITION BY model_name ORDER BY p) + (count(*) OVER (PARTITION BY model_name, p) - 1) / 2.0 AS k FROM long)
SELECT model_name, round((sum(k) FILTER (buyer = 1) - sum(buyer) * (sum(buyer) + 1) / 2.0) / (sum(buyer) * (count(*) - sum(buyer)))
  + 1e-7, 6) AS "AUC" FROM r GROUP BY 1""",
)
def classifier_ranking(spark, d):
    long = predictions(spark, d).selectExpr(
        "buyer", "inline(array(named_struct('model_name', 'a', 'p', p_a), named_struct('model_name', 'b', 'p', p_b)))"
    )
    return _metrics(auc(long, ["model_name"], "buyer", "p").orderBy(F.desc("AUC"), "model_name"))


@_add(
    "regressor_ranking",
    f"""{WITH}, long AS (SELECT y, 'a' AS model_name, amount_a AS g FROM preds WHERE buyer = 1
  UNION ALL SELECT y, 'b', amount_b FROM preds WHERE buyer = 1),
{_grid_sql("model_name", "greatest(g, 0)", "long")}
SELECT model_name, {sql_num('mae', 'MAE_buyers')}, {sql_num('rho', 'Spearman_buyers', 6)} FROM scored""",
)
def regressor_ranking(spark, d):
    ranked = sweeps.ranked_truth(predictions(spark, d).where("buyer = 1"))
    long = ranked.selectExpr(
        "y", "y_rank",
        "inline(array(named_struct('model_name', 'a', 'g', amount_a), named_struct('model_name', 'b', 'g', amount_b)))",
    ).withColumn("g", sweeps.clip0("g"))
    scores = grid_metrics(long, ["model_name"], "y", "y_rank", "g").orderBy("MAE", F.desc("Spearman"), "model_name")
    return _metrics(scores.selectExpr("model_name", "MAE as MAE_buyers", "Spearman as Spearman_buyers"))


@_add(
    "combo_table",
    f"""{WITH}, grid AS (SELECT cust_id, y, 'a' AS classifier, 'a' AS regressor, p_a * greatest(amount_a, 0) AS g FROM preds
  UNION ALL SELECT cust_id, y, 'a', 'b', p_a * greatest(amount_b, 0) FROM preds
  UNION ALL SELECT cust_id, y, 'b', 'a', p_b * greatest(amount_a, 0) FROM preds
  UNION ALL SELECT cust_id, y, 'b', 'b', p_b * greatest(amount_b, 0) FROM preds),
{_grid_sql("classifier, regressor", "greatest(g, 0)", "grid")}
SELECT classifier, regressor, {_MAE}, {_RHO} FROM scored""",
)
def combo_table(spark, d):
    return _metrics(
        sweeps.combo_table(predictions(spark, d), {"a": "p_a", "b": "p_b"}, {"a": "amount_a", "b": "amount_b"})
    )


def _weights_sql(source: str, prefix: str) -> str:
    text = _grid_sql("w", "greatest(w * pred_second + (1.0 - w) * pred_first, 0)", source)
    for name in ("guess AS", "ranks AS", "scored AS", "FROM guess", "FROM ranks"):
        a, b = name.split(" ")
        text = text.replace(name, f"{prefix}{a} AS" if b == "AS" else f"FROM {prefix}{b}")
    return text


_SEARCH = f"""{WITH}, g1 AS (SELECT cast(k as double) / 100.0 AS w FROM range(0, 101, 10) t(k)),
{_weights_sql("preds, g1", "c_")},
mid AS (SELECT cast(round(w * 100) as bigint) AS m FROM c_scored ORDER BY mae, w LIMIT 1),
g2 AS (SELECT cast(k as double) / 100.0 AS w FROM (SELECT unnest(range(greatest(0, m - 10), least(100, m + 10) + 1, 2)) AS k FROM mid)),
{_weights_sql("preds, g2", "f_")},
stages AS (SELECT 'coarse' AS stage, * FROM c_scored UNION ALL SELECT 'fine', * FROM f_scored)"""


@_add(
    "weight_search",
    f"{_SEARCH}\nSELECT stage, {sql_num('round(1.0 - w, 2)', 'weight_first')}, {sql_num('w', 'weight_second')}, {_MAE}, {_RHO} FROM stages",
)
def weight_search(spark, d):
    return _metrics(sweeps.weight_search(predictions(spark, d)))


@_add(
    "ensemble_score",
    f"""{_SEARCH}, pick AS (SELECT w FROM f_scored ORDER BY mae, w LIMIT 1)
SELECT {sql_int('cust_id', 'cust_id')}, {sql_num('greatest((1.0 - w) * pred_first + w * pred_second, 0)', 'prediction')} FROM preds, pick""",
)
def ensemble_score(spark, d):
    preds = sweeps.ranked_truth(predictions(spark, d))
    fine = sweeps.weight_search(preds).where("stage = 'fine'")
    weight = fine.orderBy("MAE", "weight_second").first().weight_second
    return shaped(sweeps.ensemble_score(preds, weight))


def _board(preds: DataFrame) -> DataFrame:
    """AUC, MAE and Spearman of the two arithmetic models."""
    models = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f"model_{m}").alias("model_name"),
                    F.col(f"p_{m}").alias("p"),
                    sweeps.soft_score(f"p_{m}", f"amount_{m}").alias("pred"),
                )
                for m in ("a", "b")
            ]
        )
    ).alias("m")
    rows = preds.select("y", "y_rank", "buyer", models).select("y", "y_rank", "buyer", "m.*")
    scores = grid_metrics(rows, ["model_name"], "y", "y_rank", "pred").select("model_name", "MAE", "Spearman")
    return auc(rows, ["model_name"], "buyer", "p").join(scores, "model_name")


def _published(preds: DataFrame) -> DataFrame:
    """Results of a run that has no classifier, hence no AUC."""
    direct = grid_metrics(preds, [], "y", "y_rank", "amount_b")
    return direct.select(F.lit("direct").alias("model_name"), "MAE", "Spearman")


def _one_model(m: str) -> str:
    return f"""SELECT 'model_{m}' AS model_name, (SELECT (sum(r) FILTER (buyer = 1) - sum(buyer) * (sum(buyer) + 1) / 2.0)
    / (sum(buyer) * (count(*) - sum(buyer))) FROM (SELECT buyer, rank() OVER (ORDER BY p_{m})
      + (count(*) OVER (PARTITION BY p_{m}) - 1) / 2.0 AS r FROM preds)) AS auc, {_pair(f"p_{m} * greatest(amount_{m}, 0)")}"""


def _pair(expr: str) -> str:
    ranked = (
        f"SELECT y, {expr} AS g, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry, "
        f"rank() OVER (ORDER BY {expr}) + (count(*) OVER (PARTITION BY {expr}) - 1) / 2.0 AS rp FROM preds"
    )
    return f"(SELECT avg(abs(y - g)) FROM ({ranked})) AS mae, (SELECT corr(ry, rp) FROM ({ranked})) AS rho"


_BOARD = f"""{WITH}, board AS ({_one_model("a")} UNION ALL {_one_model("b")}
UNION ALL SELECT 'direct', null, {_pair("amount_b")})"""
_AUC = 'round(auc + 1e-7, 6) AS "AUC"'


@_add("leaderboard_union", f"{_BOARD}\nSELECT model_name, {_AUC}, {_MAE}, {_RHO} FROM board")
def leaderboard_union(spark, d):
    """The published results come from a CSV file, which is looked for first."""
    preds = sweeps.ranked_truth(predictions(spark, d))
    path = staged_path(spark, "published")
    files.write_csv(_published(preds), path)
    return _metrics(files.union_leaderboard_if_present(spark, _board(preds), path))


@_add(
    "leaderboard_rank",
    f"{_BOARD}\nSELECT model_name, {_AUC}, {_MAE}, {_RHO}, row_number() OVER (ORDER BY mae, rho DESC, model_name) AS place FROM board",
)
def leaderboard_rank(spark, d):
    preds = sweeps.ranked_truth(predictions(spark, d))
    return _metrics(sweeps.leaderboard(_board(preds), _published(preds)))


def _distance(columns: list[str]) -> str:
    """Squared distance in SQL, added up in the order of the columns."""
    gap = "(cast(q.{0} as double) - t.{0})"
    return " + ".join(f"{gap.format(c)} * {gap.format(c)}" for c in columns)


def _neighbour_check() -> str:
    """All features, rounded as the registered feature table shows them; dates as day numbers."""
    head, tail = feature_check(store.kept_features()).rsplit("\nSELECT ", 1)
    days = ", ".join(f"date_diff('day', date '1970-01-01', cast({c} as date)) AS {c}" for c in DATE_FEATURES)
    return f"""{head},
shown AS (SELECT {tail}),
facts AS (SELECT * REPLACE ({days}) FROM shown),
pairs AS (SELECT q.cust_id, case when l.revenue_2018_2019 > 0 then 1 else 0 end AS buyer,
  row_number() OVER (PARTITION BY q.cust_id ORDER BY {_distance(store.kept_features())}, t.cust_id) AS n
  FROM (SELECT facts.* FROM facts JOIN test USING (cust_id)) q, facts t JOIN train l ON l.cust_id = t.cust_id)
SELECT {sql_int('cust_id', 'cust_id')}, {sql_num('avg(buyer)', 'score')} FROM pairs WHERE n <= 25 GROUP BY 1"""


@_add("knn_score", _neighbour_check())
def knn_score(spark, d):
    """Mean buyer label of the 25 nearest training customers, on all features, unscaled as in the published model."""
    from buyerscope.models.neighbours import knn_score

    items = staged(view.transactions(spark, d).select(*store.columns_read(store.kept_features())), "items")
    shown = shaped(store.customer_features(items, view.FEATURES))
    day = {c: F.datediff(F.to_date(F.col(c)), F.lit("1970-01-01")) for c in DATE_FEATURES}
    facts = staged(shown.withColumns(day), "facts")
    train = facts.join(view.train_labels(spark, d), "cust_id").withColumn("buyer", (F.col(TARGET) > 0).cast("int"))
    test = facts.join(view.test_customers(spark, d), "cust_id")
    return shaped(knn_score(train, test, store.kept_features(), "buyer"))
