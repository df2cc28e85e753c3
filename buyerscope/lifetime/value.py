"""Purchase and spend models: BG/NBD (Fader, Hardie, Lee 2005) and Gamma-Gamma
(Fader, Hardie 2013). Scoring is column arithmetic with the fitted parameters."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from buyerscope.lifetime.fitting import log_gamma, maximise
from buyerscope.lifetime.rfm import repeaters, rfm_summary
from buyerscope.settings import LifetimeSettings
from buyerscope.sources.staging import staged

# Fixed value: ages are scaled so that the oldest customer is 10 before the penalty acts.
SCALED_AGE = 10.0


@dataclass(frozen=True)
class PurchaseModel:
    """BG/NBD parameters."""

    r: float
    alpha: float
    a: float
    b: float

    def prob_alive(self) -> Column:
        """1 for customers that never came back."""
        x, rec, age = F.col("frequency"), F.col("recency"), F.col("T")
        odds = (F.lit(self.a) / (F.lit(self.b) + F.greatest(x, F.lit(1)) - 1)) * F.pow(
            (F.lit(self.alpha) + age) / (F.lit(self.alpha) + rec), F.lit(self.r) + x
        )
        return F.when(x == 0, F.lit(1.0)).otherwise(F.lit(1.0) / (F.lit(1.0) + odds))

    def expected_purchases(self, horizon: float) -> Column:
        """Expected repeat purchases within the next ``horizon`` days.

        Euler's transformation takes the frequency out of the upper parameters of the
        hypergeometric function, which leaves a series that shrinks at least as fast as
        powers of z; each row's length follows from its own z. The formula divides by
        a - 1, so an a within a millionth of 1 is taken as that far from 1.
        """
        r, alpha, b = self.r, self.alpha, self.b
        a = self.a if abs(self.a - 1) > 1e-6 else 1 + 1e-6
        x, rec, age = F.col("frequency"), F.col("recency"), F.col("T")
        z = F.lit(horizon) / (F.lit(alpha) + age + F.lit(horizon))
        length = F.greatest(F.lit(20), F.ceil(F.lit(math.log(1e-13)) / F.log(z)) + 20).cast("int")
        c = F.lit(a + b - 1) + x
        start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"), c.alias("c"), z.alias("z"))

        def add(acc: Column, n: Column) -> Column:
            grow = (F.lit(a + b - 1 - r) + n) * (F.lit(a - 1) + n) / ((acc["c"] + n) * (n + 1.0))
            term = acc["term"] * grow * acc["z"]
            return F.struct(
                term.alias("term"), (acc["total"] + term).alias("total"),
                acc["c"].alias("c"), acc["z"].alias("z"),
            )

        steps = F.transform(F.sequence(F.lit(0), length), lambda n: n.cast("double"))
        series = F.aggregate(steps, start, add, lambda acc: acc["total"])
        gone = F.lit(1.0) - F.pow(F.lit(1.0) - z, F.lit(a - 1)) * series
        odds = (F.lit(a) / (F.lit(b) + F.greatest(x, F.lit(1)) - 1)) * F.pow(
            (F.lit(alpha) + age) / (F.lit(alpha) + rec), F.lit(r) + x
        )
        alive = F.lit(1.0) + F.when(x > 0, odds).otherwise(F.lit(0.0))
        return (F.lit(a + b - 1) + x) / F.lit(a - 1) * gone / alive


@dataclass(frozen=True)
class SpendModel:
    """Gamma-Gamma parameters."""

    p: float
    q: float
    v: float

    def expected_average(self) -> Column:
        """Expected mean spend; 0 for customers that are no repeaters."""
        x, m = F.col("frequency"), F.col("monetary_value")
        px = F.lit(self.p) * x
        own = px / (px + F.lit(self.q - 1))
        everyone = F.lit(self.v * self.p) / (px + F.lit(self.q - 1))  # weighted, so q = 1 is no special case
        value = everyone + own * m
        return F.when((x > 0) & (m > 0), F.greatest(value, F.lit(0.0))).otherwise(F.lit(0.0))


def purchase_likelihood(rows: pd.DataFrame, point: np.ndarray) -> np.ndarray:
    r, alpha, a, b = point
    x = rows["frequency"].to_numpy(float)
    rec, age = rows["recency"].to_numpy(float), rows["T"].to_numpy(float)
    common = log_gamma(r + x) - log_gamma(r) + r * np.log(alpha)
    common = common + log_gamma(a + b) + log_gamma(b + x) - log_gamma(b) - log_gamma(a + b + x)
    still = -(r + x) * np.log(alpha + age)
    left = np.log(a) - np.log(b + np.maximum(x, 1) - 1) - (r + x) * np.log(alpha + rec)
    return common + np.where(x > 0, np.logaddexp(still, left), still)


def spend_likelihood(rows: pd.DataFrame, point: np.ndarray) -> np.ndarray:
    p, q, v = point
    x, m = rows["frequency"].to_numpy(float), rows["monetary_value"].to_numpy(float)
    px = p * x
    return (
        log_gamma(px + q) - log_gamma(px) - log_gamma(q) + q * np.log(v)
        + (px - 1) * np.log(m) + px * np.log(x) - (px + q) * np.log(x * m + v)
    )


def fit_purchases(rfm: DataFrame, settings: LifetimeSettings = LifetimeSettings()) -> PurchaseModel:
    """Customers with equal frequency, recency and age collapse to one weighted row."""
    oldest = rfm.agg(F.max("T")).first()[0]
    scale = SCALED_AGE / max(float(oldest or 1), 1e-9)
    rows = rfm.groupBy("frequency", "recency", "T").agg(F.count("*").cast("double").alias("weight"))
    scaled = rows.withColumns({"recency": F.col("recency") * scale, "T": F.col("T") * scale})
    data = staged(scaled, "purchases")
    r, alpha, a, b = maximise(data, purchase_likelihood, [1.0, 1.0, 1.0, 1.0], settings.penalty)
    return PurchaseModel(float(r), float(alpha) / scale, float(a), float(b))


def fit_spend(rfm: DataFrame, settings: LifetimeSettings = LifetimeSettings()) -> SpendModel:
    rows = repeaters(rfm).groupBy("frequency", "monetary_value").agg(
        F.count("*").cast("double").alias("weight")
    )
    data = staged(rows, "spend")
    p, q, v = maximise(data, spend_likelihood, [1.0, 1.5, 1.0], settings.penalty)
    return SpendModel(float(p), float(q), float(v))


def score(rfm: DataFrame, purchases: PurchaseModel, spend: SpendModel, horizon: float) -> DataFrame:
    return rfm.select(
        "cust_id",
        purchases.prob_alive().alias("prob_alive"),
        purchases.expected_purchases(horizon).alias("pred_num_purchases"),
        spend.expected_average().alias("expected_avg_sales"),
    )


def join_enrichment(features: DataFrame, scored: DataFrame) -> DataFrame:
    """The three lifetime columns next to the features, 0 where there is no history."""
    names = ["prob_alive", "pred_num_purchases", "expected_avg_sales"]
    return features.join(scored.select("cust_id", *names), "cust_id", "left").fillna(0.0, subset=names)


def enrich(features: DataFrame, items: DataFrame, settings: LifetimeSettings = LifetimeSettings()) -> DataFrame:
    """Fit both models on the items, side by side, and add their predictions to the features."""
    rfm = staged(rfm_summary(items, settings), "rfm")
    with ThreadPoolExecutor(1) as beside:
        spend = beside.submit(fit_spend, rfm, settings)
        purchases = fit_purchases(rfm, settings)
    return join_enrichment(features, score(rfm, purchases, spend.result(), settings.horizon_days))
