"""Invariants of the feature store, its plan, and the file sources."""

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from buyerscope.features import store
from buyerscope.operators.skew import HotSplit
from buyerscope.schema import TRAIN_LABELS, conform_columns
from buyerscope.sources import files
from buyerscope.sources import retail_view as view
from buyerscope.sources.staging import staging_root
from tests.conftest import SMALL


@pytest.fixture()
def folder(spark):
    return f"{staging_root(spark)}/test-{uuid.uuid4().hex}"


def rounded(df):
    cols = [F.round(c, 8).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


def test_row_order_and_partitions_do_not_matter(spark, small_items):
    names = ["n_items", "total_revenue_net", "gap_cv", "top_brand_share", "month_purchase_entropy", "last_purchase"]
    base = store.select_features(small_items, view.FEATURES, names)
    mixed = store.select_features(small_items.orderBy(F.rand(5)).repartition(13), view.FEATURES, names)
    assert rounded(base) == rounded(mixed)


def test_hot_customers_give_the_same_features(spark, small_items):
    some = [r.cust_id for r in small_items.select("cust_id").distinct().limit(20).collect()]
    cold = store.customer_features(small_items, view.FEATURES, HotSplit("cust_id"))
    hot = store.customer_features(small_items, view.FEATURES, HotSplit("cust_id", tuple(some)))
    assert rounded(cold) == rounded(hot)


def test_one_row_per_customer(spark, small_items):
    f = store.customer_features(small_items, view.FEATURES)
    assert f.count() == f.select("cust_id").distinct().count() == small_items.select("cust_id").distinct().count()


def test_three_passes_need_three_shuffles(spark, small_items):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        f = store.customer_features(small_items, view.FEATURES, HotSplit("cust_id"))
        plan = f._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(cust_id") == 3
        assert plan.count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    f = store.select_features(view.transactions(spark, SMALL), view.FEATURES, ["n_items"], HotSplit("cust_id"))
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThanOrEqual(o_orderdate,2000-07-31" in plan
    assert "l_tax" not in plan and "p_retailprice" not in plan


def test_csv_round_trip(spark, folder):
    raw = view.observed_raw(spark, SMALL)
    files.write_csv(raw, folder)
    back = files.read_transactions_csv(spark, folder)
    want = view.transactions(spark, SMALL)
    assert back.schema == want.schema
    key = ["cust_id", "sale_id", "order_date", "pack_date", "prod_size", "prod_outlet", "is_returned", "prod_material"]
    assert sorted(map(str, back.select(*key).collect())) == sorted(map(str, want.select(*key).collect()))


def test_declared_csv_schema(spark, folder):
    files.write_csv(view.train_labels(spark, SMALL), folder)
    assert files.read_csv(spark, folder, TRAIN_LABELS).schema == TRAIN_LABELS
    assert dict(files.read_csv_as_text(spark, folder, TRAIN_LABELS).dtypes)["cust_id"] == "string"


def test_optional_leaderboard_file(spark, folder):
    mine = spark.createDataFrame([("a", 0.7, 1.0, 0.5)], "model_name string, AUC double, MAE double, Spearman double")
    assert files.union_leaderboard_if_present(spark, mine, folder).count() == 1
    files.write_csv(mine.drop("AUC").withColumn("model_name", F.lit("b")), folder)
    got = files.union_leaderboard_if_present(spark, mine, folder).orderBy("model_name").collect()
    assert [(r.model_name, r.AUC) for r in got] == [("a", 0.7), ("b", None)]


def test_absent_columns_become_typed_nulls(spark):
    raw = view.observed_raw(spark, SMALL).select("cust_id", "sale_id", "order_date", "sale_revenue")
    from buyerscope.schema import type_transactions

    typed = type_transactions(raw)
    assert set(typed.columns) >= {"prod_heel", "is_returned", "days_to_pack"}
    assert typed.where("is_returned <> 0 or prod_brand is not null").count() == 0
    assert store.customer_features(typed, view.FEATURES).count() > 0


def test_conformed_columns(spark):
    df = spark.createDataFrame([(1, None, 3)], "cust_id long, a double, extra int")
    assert conform_columns(df, ["a", "b"]).collect() == [(1, 0.0, 0.0)]


def test_transactions_go_through_compressed_files(spark, monkeypatch):
    from buyerscope.plans import cleaning_queries

    folders, real = [], cleaning_queries.staged_path
    monkeypatch.setattr(cleaning_queries, "staged_path", lambda *a: folders.append(real(*a)) or folders[-1])
    monkeypatch.setattr(files, "ROWS_A_FILE", 1_000)
    n = cleaning_queries.scan_text_cast(spark, SMALL).count()
    written = [p for p in Path(folders[0].removeprefix("file:")).iterdir() if p.name.startswith("part-")]
    assert n == view.raw_transactions(spark, SMALL).count()
    assert len(written) >= n / 1_000 and all(p.name.endswith(".csv.gz") for p in written)


def test_staged_items_hold_only_what_the_features_read(spark, small_items):
    from buyerscope.plans import feature_queries

    for names in (*feature_queries.FAMILIES.values(), store.catalogue()):
        some = small_items.select(*store.columns_read(names))
        out = store.select_features(some, view.FEATURES, names, HotSplit("cust_id"))
        assert out.columns == ["cust_id", *names]
    items = feature_queries._table(spark, SMALL, store.kept_features())
    assert not {"prod_title", "prod_id", "pack_date", "returned_to_shop_id"} & set(items.columns)
    assert items.count() == small_items.count()


def test_both_lifetime_models_are_fitted_at_the_same_time(spark, monkeypatch):
    from threading import Barrier

    from buyerscope.lifetime import value

    both = Barrier(2)
    models = {"fit_purchases": value.PurchaseModel(1.0, 2.0, 1.5, 2.5), "fit_spend": value.SpendModel(1.0, 2.0, 3.0)}
    for name, model in models.items():
        monkeypatch.setattr(value, name, lambda *_, model=model: (both.wait(30), model)[1])
    rows = "(1, timestamp_ntz'2017-01-01 00:00:00', 5D, 0), (1, timestamp_ntz'2017-02-01 00:00:00', 6D, 0)"
    items = spark.sql(f"select * from values {rows} as t(cust_id, order_date, sale_revenue, is_returned)")
    found = value.enrich(spark.sql("select 1 as cust_id union all select 2"), items).orderBy("cust_id").collect()
    assert found[0].prob_alive > 0 and found[1].prob_alive == 0
