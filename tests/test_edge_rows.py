"""Hand-written rows for the cases where Spark's defaults differ from the wanted result."""

import re
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from buyerscope.features import passes, preferences, store
from buyerscope.functions import exprs as x
from buyerscope.lifetime.fitting import maximise
from buyerscope.lifetime.rfm import rfm_summary
from buyerscope.models import sweeps
from buyerscope.operators import clean, profile
from buyerscope.schema import TEST_LABELS, TRAIN_LABELS, TRANSACTIONS, type_transactions
from buyerscope.settings import FeatureSettings, LifetimeSettings
from buyerscope.sources import files

REF = date(2017, 12, 31)
SETTINGS = FeatureSettings(reference_date=REF)
DAY0 = datetime(2017, 1, 1)


def items(spark, rows):
    """Typed transactions from dicts of raw text; unnamed columns are missing."""
    names = TRANSACTIONS.fieldNames()
    data = [tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows]
    return type_transactions(spark.createDataFrame(data, ", ".join(f"{n} string" for n in names)))


def row(cust, sale, when, revenue=10.0, **more):
    return {
        "cust_id": cust, "sale_id": sale, "order_date": when, "sale_revenue": revenue,
        "sale_discount_applied": -1.0, "prod_id": 1, **more,
    }


def features(spark, rows, names, settings=SETTINGS):
    out = store.select_features(items(spark, rows), settings, names).collect()
    return {r.cust_id: r.asDict() for r in out}


def test_rows_without_customer_are_left_out(spark):
    got = features(spark, [row(None, 1, DAY0), row(1, 2, DAY0), row(2, 3, DAY0)], ["n_items"])
    assert sorted(got) == [1, 2]


def test_first_order_counts_as_not_fast(spark):
    rows = [row(1, i, DAY0 + timedelta(days=d)) for i, d in enumerate((0, 30, 120))]
    assert features(spark, rows, ["share_fast_repeat_60d"])[1]["share_fast_repeat_60d"] == pytest.approx(1 / 3)


def test_customer_with_only_returns_gives_zeros(spark):
    got = features(spark, [row(1, 1, DAY0, 0.0, returned_to_shop_id=7)], store.kept_features())[1]
    assert got["return_rate"] == 1.0
    for name in ("avg_rev_per_item", "discount_ratio", "gap_cv", "revenue_velocity", "returned_revenue_ratio"):
        assert got[name] == 0


def test_unreadable_text_becomes_null(spark):
    got = items(spark, [row(1, 1, "x", "n/a", prod_size="n/a"), row(1, 1, DAY0, "NaN")]).collect()
    assert got[0].order_date is None and got[0].prod_size is None and got[0].sale_revenue is None
    assert got[1].sale_revenue is None


def test_days_round_down(spark):
    start = datetime(2017, 5, 1, 12)
    rows = [row(1, 1, start, pack_date=start - timedelta(hours=1)), row(1, 2, start, pack_date=start + timedelta(hours=25))]
    assert sorted(r.days_to_pack for r in items(spark, rows).collect()) == [-1, 1]


def test_window_is_closed_at_both_midnights(spark):
    end = datetime(2017, 12, 31)
    dates = [end, end + timedelta(hours=14), end - timedelta(days=89), end - timedelta(days=90)]
    got = features(spark, [row(1, i, d) for i, d in enumerate(dates)], ["n_items_last_90d"])
    assert got[1]["n_items_last_90d"] == 2


def test_size_bins(spark):
    rows = [row(1, i, DAY0, prod_size=s) for i, s in enumerate((0, 1, 35, 36, 44, 45, 100, 101))]
    got = clean.with_size_bins(items(spark, rows)).orderBy("sale_id").collect()
    assert [r.prod_size_bin for r in got] == [None, 1, 1, 2, 2, 3, 3, None]


def test_equal_quintile_edges_collapse(spark):
    rows = [row(1, i, DAY0, v) for i, v in enumerate((0, 0, 0, 0, 1, 2, 3))]
    got = preferences.with_quintiles(items(spark, rows), {"q": "sale_revenue"}).orderBy("sale_revenue").collect()
    assert [r.q[:2] for r in got] == ["Q1"] * 4 + ["Q4", "Q5", "Q5"]  # edges 0, 0, 0.6, 1.8


def test_season_codes(spark):
    df = spark.createDataFrame([("Z17",), ("NOS",), (None,), ("17",)], "prod_season string")
    got = clean.with_season_parts(df).collect()
    assert [r.season_code for r in got] == ["Z", "NOS", None, None]
    assert [r.season_year for r in got] == [2017.0, None, None, 2017.0]
    assert [r.season for r in got] == ["Summer", "Never Out of Stock", None, None]


def test_boolean_tokens(spark):
    tokens = ["True", " yes", "1", "1.0", "maybe", None, "NO"]
    rows = [row(1, i, DAY0, prod_outlet=t) for i, t in enumerate(tokens)]
    got = items(spark, rows).orderBy("sale_id").collect()
    assert [r.prod_outlet for r in got] == [1, 1, 1, None, None, None, 0]


def test_delta_is_zero_without_recent_orders(spark):
    rows = [row(1, 1, datetime(2017, 1, 5), prod_outlet="true", prod_brand="a")]
    got = features(spark, rows, ["share_outlet_last_90d_delta", "top_brand_share_last_90d_delta", "share_outlet"])[1]
    assert got["share_outlet"] == 1.0
    assert got["share_outlet_last_90d_delta"] == 0 and got["top_brand_share_last_90d_delta"] == 0


def test_missing_dates_are_not_filled(spark):
    got = features(spark, [row(1, 1, "x")], ["first_purchase", "customer_lifetime_days"])[1]
    assert got == {"cust_id": 1, "first_purchase": None, "customer_lifetime_days": 0}


def test_shares_count_returned_items_and_skip_missing_values(spark):
    rows = [row(1, 1, DAY0, prod_brand="a"), row(1, 2, DAY0, prod_brand="a", returned_to_shop_id=1),
            row(1, 3, DAY0, prod_brand="b"), row(1, 4, DAY0)]
    got = features(spark, rows, ["top_brand_share", "n_unique_brands", "n_brands_returned"])[1]
    assert got["top_brand_share"] == pytest.approx(2 / 3)
    assert (got["n_unique_brands"], got["n_brands_returned"]) == (2, 1)


def test_month_entropy(spark):
    import math

    one = [row(1, i, datetime(2017, 3, d)) for i, d in enumerate((1, 9))]
    two = [row(2, 9, datetime(2017, 3, 1)), row(2, 10, datetime(2017, 8, 1))]
    got = features(spark, one + two, ["month_purchase_entropy", "n_active_months"])
    assert got[1]["month_purchase_entropy"] == 0 and got[1]["n_active_months"] == 1
    assert got[2]["month_purchase_entropy"] == pytest.approx(math.log(2)) and got[2]["n_active_months"] == 2


def test_gaps_between_times_of_one_day(spark):
    """Checked against the plain definition: lag over distinct times, whole days rounded down."""
    hours = [0, 5, 5, 23, 24 * 3 + 1, 24 * 3 + 2, 24 * 70, 24 * 70 + 6, 24 * 70 + 7]
    stamps = sorted({DAY0 + timedelta(hours=h) for h in hours})
    gaps = [(b - a).days for a, b in zip(stamps, stamps[1:])]
    rows = [row(1, i, DAY0 + timedelta(hours=h)) for i, h in enumerate(hours)]
    names = [
        "avg_days_between_orders", "std_days_between_orders", "min_days_between_orders",
        "max_days_between_orders", "last_days_between_orders", "avg_last_2_gaps", "share_fast_repeat_60d",
    ]
    got = features(spark, rows, names)[1]
    mean = sum(gaps) / len(gaps)
    assert got["avg_days_between_orders"] == pytest.approx(mean)
    assert got["std_days_between_orders"] == pytest.approx((sum((g - mean) ** 2 for g in gaps) / len(gaps)) ** 0.5)
    assert got["min_days_between_orders"] == min(gaps) and got["max_days_between_orders"] == max(gaps)
    assert got["last_days_between_orders"] == gaps[-1]
    assert got["avg_last_2_gaps"] == pytest.approx(sum(gaps[-2:]) / 2)
    assert got["share_fast_repeat_60d"] == pytest.approx(sum(g <= 60 for g in gaps) / len(stamps))


def test_rows_without_sale_count_for_revenue_only(spark):
    rows = [row(1, 1, DAY0, 10.0), row(1, None, DAY0, 5.0)]
    got = features(spark, rows, ["n_items", "n_sales", "total_revenue_net", "avg_items_per_sale"],
                   SETTINGS.with_(keep_redundant=True))[1]
    assert (got["n_items"], got["n_sales"], got["total_revenue_net"]) == (1, 1, 15.0)
    assert got["avg_items_per_sale"] == 1.0


def test_rfm(spark):
    days, revenue = (1, 1, 4, 9), (5.0, 5.0, 6.0, 8.0)
    rows = [row(1, i, datetime(2017, 6, d), r) for i, (d, r) in enumerate(zip(days, revenue))]
    got = rfm_summary(items(spark, rows), LifetimeSettings(period_end=date(2017, 6, 10))).first()
    assert (got.frequency, got.recency, got["T"], got.monetary_value) == (2, 8, 9, 7.0)


def test_return_flag_is_taken_before_the_fill(spark):
    typed = items(spark, [row(1, 1, DAY0), row(1, 2, DAY0, returned_to_shop_id=4)])
    filled = clean.fill_missing(typed)
    assert sorted(r.is_returned for r in filled.collect()) == [0, 1]
    assert {r.returned_to_shop_id for r in filled.collect()} == {"missing", "4"}


def test_null_counts_as_a_value_only_where_asked(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    got = profile.distinct_counts(df, ["c"]).first()
    assert (got.n_unique, got.n_unique_with_null) == (1, 2)


def test_brand_spellings(spark):
    df = spark.createDataFrame([(b,) for b in ("Bana & Co", "Gabor Kids", "Other", None)], "prod_brand string")
    assert [r[0] for r in clean.merge_brand_spellings(df).collect()] == ["Bana", "Gabor", "Other", None]


def test_ordinal(spark):
    df = spark.createDataFrame([(date(2017, 12, 31),), (date(1, 1, 1),)], "d date")
    got = [r[0] for r in df.select(x.date_ordinal("d")).collect()]
    assert got == [date(2017, 12, 31).toordinal(), 1]


def test_prepare_frames_decides_on_training_rows(spark):
    train = spark.createDataFrame([("2017-01-01", "a"), ("2017-01-02", None)], "d string, c string")
    other = spark.createDataFrame([("x", "b")], "d string, c string")
    (a, b), categories = clean.prepare_frames(train, [other])
    assert categories == ["c"]
    assert [tuple(r) for r in a.collect()] == [(1483228800, "a"), (1483315200, "missing")]
    assert [tuple(r) for r in b.collect()] == [(0, "b")]


def test_deviation_of_many_large_values_keeps_its_digits(spark):
    """n * sum of squares is far above 2^53 here; half the days are one day longer, sizes differ by a millionth."""
    rows = spark.range(400_000).select(
        F.lit(1).alias("cust_id"), (F.col("id") % 1000).alias("sale_id"), F.lit(DAY0).cast("timestamp_ntz").alias("order_date"),
        F.lit(1.0).alias("sale_revenue"), F.lit(0.0).alias("sale_discount_applied"),
        (F.lit(40.0) + F.col("id") % 2 * 1e-6).alias("prod_size"), F.lit(0).alias("prod_web_only"), F.lit(0).alias("prod_outlet"),
        F.lit(0).alias("is_returned"), (F.lit(3_000_000) + F.col("id") % 2).alias("days_to_pack"),
    )
    got = passes.sale_features(rows, SETTINGS, lambda r: r).first()
    assert got.std_days_to_pack == 0.5 and got.avg_days_to_pack == 3_000_000.5
    assert got.size_std == pytest.approx(5e-7, rel=1e-12)
    same = passes.sale_features(rows.withColumns({"days_to_pack": F.lit(7), "prod_size": F.lit(38.333)}), SETTINGS, lambda r: r)
    assert [same.first().std_days_to_pack, same.first().size_std] == [0.0, 0.0]


def test_preview_of_negative_rows(spark):
    rows = [row(1, i, DAY0, float(v)) for i, v in enumerate((-3, -1, 2))]
    assert profile.preview_negative(items(spark, rows), "sale_revenue").count() == 2


def test_histogram_of_equal_values_fills_the_middle_bin(spark):
    rows = profile.histogram(spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double"), F.col("x")).collect()
    assert [(r.bin, r.n) for r in rows] == [(31, 2)]


def test_long_series_and_parameters_at_one(spark):
    from buyerscope.lifetime.value import PurchaseModel, SpendModel

    row = spark.createDataFrame([(0, 0.0, 0.0, 0.0), (3, 40.0, 50.0, 20.0)], "frequency int, recency double, T double, monetary_value double")
    model = PurchaseModel(r=0.5, alpha=1.0, a=1.5, b=2.0)
    got = [r[0] for r in row.select(model.expected_purchases(20_000.0)).collect()]
    z, term, total = 20_000 / 20_001, 1.0, 1.0
    for n in range(2_000_000):
        term *= (model.a + model.b - 1 - model.r + n) * (model.a - 1 + n) / ((model.a + model.b - 1 + n) * (n + 1)) * z
        total += term
    want = (model.a + model.b - 1) / (model.a - 1) * (1 - (1 - z) ** (model.a - 1) * total)
    assert abs(got[0] - want) < 1e-9 * abs(want)
    near, at = (
        [r[0] for r in row.select(PurchaseModel(r=0.5, alpha=3.0, a=a, b=2.0).expected_purchases(30.0)).collect()] for a in (1.0001, 1.0)
    )
    assert all(abs(x - y) < 1e-3 * abs(x) for x, y in zip(near, at))
    assert [r[0] for r in row.select(SpendModel(p=2.0, q=1.0, v=5.0).expected_average()).collect()] == [0.0, 10.0 / 6 + 20.0]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = str(tmp_path / "customers")
    spark.createDataFrame([(9.5, 1)], "revenue_2018_2019 double, cust_id long").write.option("header", True).csv(path)
    assert [tuple(r) for r in files.read_csv(spark, path, TEST_LABELS).collect()] == [(1,)]
    assert [tuple(r) for r in files.read_csv(spark, path, TRAIN_LABELS).collect()] == [(1, 9.5)]


def test_thresholds_between_hundredths_are_kept(spark):
    rows = [(1, 10.0, 0.155, 4.0), (2, 0.0, 0.16, 1.0), (3, 5.0, 0.15, 2.0)]
    preds = spark.createDataFrame(rows, "cust_id long, y double, p_buy double, amount double")
    found = {r.threshold: r.pred_buyers for r in sweeps.threshold_sweep(preds, (0.155, 0.1575), 1.0).collect()}
    assert found == {0.155: 2, 0.1575: 1}


def test_a_fit_that_still_gains_fails(spark):
    data = spark.createDataFrame([(1.0,)], "weight double")
    with pytest.raises(RuntimeError, match="still gains"):
        maximise(data, lambda rows, point: np.zeros(len(rows)) - point[0], [5.0], 0.0, steps=1)


def test_products_of_a_sale_are_counted_without_a_table_of_all_pairs(spark):
    rows = [(1, 5), (1, 5), (1, 6), (1, None), (2, None), (2, None), (3, 7), (None, 8), (None, None), (4, 9), (4, 8)]
    items = spark.createDataFrame(rows * 3, "sale_id long, prod_id long")
    out = profile.basket_products(items)
    assert [tuple(r) for r in out.collect()] == [(0, 1, False), (1, 1, False), (2, 2, True)]
    keys = re.findall(r"HashAggregate\(keys=\[(\w*)", out._jdf.queryExecution().sparkPlan().toString())
    assert keys and not {"sale_id", "prod_id"} & set(keys)
