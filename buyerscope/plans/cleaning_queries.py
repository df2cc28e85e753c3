"""Registered queries for sources, casts, cleaning, filters and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerscope.features import store
from buyerscope.functions import exprs as x
from buyerscope.models.sweeps import clip0
from buyerscope.operators import clean, target_stats
from buyerscope.operators.split import stratified_split
from buyerscope.plans.shape import shaped, sql_int, sql_num, sql_time
from buyerscope.schema import TRANSACTIONS, conform_columns
from buyerscope.settings import TARGET
from buyerscope.sources import files, retail_view as view
from buyerscope.sources.staging import staged, staged_path

QUERIES: dict = {}
ORACLE: dict = {}

WITH = view.oracle_tables()
REF = f"timestamp '{view.REFERENCE_DATE.isoformat()}'"
IDS = [sql_int("cust_id", "cust_id"), sql_int("sale_id", "sale_id"), sql_int("prod_id", "prod_id")]


def _add(name: str, sql: str):
    def keep(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn

    return keep


def _pick(source: str, *cols: str, with_: str = WITH) -> str:
    return f"{with_}\nSELECT {', '.join(cols)} FROM {source}"


@_add(
    "scan_text_cast",
    _pick(
        "alltx", *IDS, sql_time("order_date", "order_date"), sql_time("pack_date", "pack_date"),
        sql_num("sale_revenue", "sale_revenue"), sql_num("prod_size", "prod_size"),
        sql_int("prod_web_only", "prod_web_only"), sql_int("prod_outlet", "prod_outlet"),
        sql_int("returned_to_shop_id", "returned_to_shop_id"),
    ),
)
def scan_text_cast(spark: SparkSession, d: str) -> DataFrame:
    """Transactions written as compressed CSV, read back as text and typed."""
    path = staged_path(spark, "csv")
    files.write_csv(view.raw_transactions(spark, d), path, compression="gzip")
    typed = files.read_transactions_csv(spark, path)
    return shaped(
        typed.select(
            "cust_id", "sale_id", "prod_id", "order_date", "pack_date", "sale_revenue",
            "prod_size", "prod_web_only", "prod_outlet", "returned_to_shop_id",
        )
    )


@_add(
    "table_shape",
    _pick("raw", sql_int("count(*)", "n_rows"), f"cast({len(TRANSACTIONS)} as bigint) AS n_columns"),
)
def table_shape(spark, d):
    from buyerscope.operators.profile import table_shape

    return shaped(table_shape(view.raw_transactions(spark, d)))


_BAD_DATE = "case when prod_id % 13 = 0 then 'n/a' else cast(order_date as string) end"


@_add(
    "cast_dates",
    _pick("alltx", *IDS, sql_time(f"try_cast({_BAD_DATE} as timestamp)", "order_ts"),
          sql_time("pack_date", "pack_ts")),
)
def cast_dates(spark, d):
    rows = view.all_transactions(spark, d).withColumn("text", F.expr(_BAD_DATE))
    return shaped(
        rows.select(
            "cust_id", "sale_id", "prod_id",
            F.col("text").try_cast("timestamp_ntz").alias("order_ts"),
            F.col("pack_date").alias("pack_ts"),
        )
    )


@_add("cast_numbers", _pick("raw", *IDS, sql_num("try_cast(prod_size as double)", "prod_size")))
def cast_numbers(spark, d):
    raw = view.raw_transactions(spark, d)
    size = x.lenient("prod_size", raw.schema["prod_size"].dataType, TRANSACTIONS["prod_size"].dataType)
    return shaped(raw.select("cust_id", "sale_id", "prod_id", F.expr(size).alias("prod_size")))


@_add(
    "bool_tokens",
    _pick("alltx", *IDS, sql_int("prod_web_only", "prod_web_only"), sql_int("prod_outlet", "prod_outlet")),
)
def bool_tokens(spark, d):
    raw = view.raw_transactions(spark, d)
    flags = [F.expr(x.bool_token(c, raw.schema[c].dataType)).alias(c) for c in ("prod_web_only", "prod_outlet")]
    return shaped(raw.select("cust_id", "sale_id", "prod_id", *flags))


@_add("return_flag", _pick("alltx", *IDS, sql_int("is_returned", "is_returned")))
def return_flag(spark, d):
    return shaped(view.all_transactions(spark, d).select("cust_id", "sale_id", "prod_id", "is_returned"))


@_add("days_to_pack", _pick("alltx", *IDS, sql_int("days_to_pack", "days_to_pack")))
def days_to_pack(spark, d):
    return shaped(view.all_transactions(spark, d).select("cust_id", "sale_id", "prod_id", "days_to_pack"))


@_add(
    "fill_missing",
    _pick(
        "raw", *IDS,
        *[f"coalesce(cast({c} as varchar), 'missing') AS {c}" for c in clean.FILLED_COLUMNS],
    ),
)
def fill_missing(spark, d):
    filled = clean.fill_missing(view.all_transactions(spark, d))
    return shaped(filled.select("cust_id", "sale_id", "prod_id", *clean.FILLED_COLUMNS))


_PLANTED = (
    "case prod_id % 7 when 0 then 'Bana & Co' when 1 then 'Brako Anatomics' when 2 then 'Gabor Kids' "
    "when 3 then 'Ragazzi Sport' else prod_brand end"
)


@_add(
    "brand_synonyms",
    f"{WITH}\nSELECT brand AS prod_brand, count(*) AS n FROM (SELECT case prod_id % 7 when 0 then 'Bana' "
    "when 1 then 'Brako' when 2 then 'Gabor' when 3 then 'Ragazzi' else prod_brand end AS brand FROM alltx) GROUP BY 1",
)
def brand_synonyms(spark, d):
    planted = view.all_transactions(spark, d).withColumn("prod_brand", F.expr(_PLANTED))
    merged = clean.merge_brand_spellings(planted)
    return shaped(merged.groupBy("prod_brand").agg(F.count("*").alias("n")))


@_add(
    "first_token",
    _pick(
        "alltx", *IDS, "trim(split_part(prod_material, ',', 1)) AS material_main",
        "trim(split_part(prod_type_3, ',', 1)) AS prod_type_3_main",
    ),
)
def first_token(spark, d):
    out = clean.with_first_tokens(view.all_transactions(spark, d))
    return shaped(out.select("cust_id", "sale_id", "prod_id", "material_main", "prod_type_3_main"))


def _case(col: str, table: dict) -> str:
    return "case " + col + " " + " ".join(f"when '{k}' then '{v}'" for k, v in table.items()) + " end"


@_add(
    "season_parts",
    f"""{WITH}
SELECT {', '.join(IDS)}, code AS season_code, {sql_num("yr", "season_year")},
  {_case("code", x.SEASON_NAMES)} AS season, {_case("code", x.SEASON_TYPES)} AS season_type
FROM (SELECT *, nullif(regexp_extract(prod_season, '^[A-Z]+'), '') AS code,
  2000 + try_cast(nullif(regexp_extract(prod_season, '[0-9][0-9]$'), '') AS double) AS yr FROM alltx)""",
)
def season_parts(spark, d):
    out = clean.with_season_parts(view.all_transactions(spark, d))
    return shaped(
        out.select("cust_id", "sale_id", "prod_id", "season_code", "season_year", "season", "season_type")
    )


@_add(
    "size_bins",
    _pick(
        "alltx", *IDS,
        "cast(case when prod_size > 0 and prod_size <= 35 then 1 when prod_size > 35 and prod_size <= 44 then 2 "
        "when prod_size > 44 and prod_size <= 100 then 3 end as bigint) AS prod_size_bin",
    ),
)
def size_bins(spark, d):
    out = clean.with_size_bins(view.all_transactions(spark, d))
    return shaped(out.select("cust_id", "sale_id", "prod_id", "prod_size_bin"))


def _quintile(col: str, edges: str) -> str:
    labels = x.QUINTILE_LABELS
    whens = " ".join(f"when {col} <= {edges}[{i + 1}] then '{labels[i]}'" for i in range(4))
    return f"case when {col} is null then null {whens} else '{labels[4]}' end"


@_add(
    "quintile_bins",
    f"""{WITH}, e AS (SELECT quantile_cont(sale_discount_applied, [0.2, 0.4, 0.6, 0.8]) AS de,
  quantile_cont(sale_revenue, [0.2, 0.4, 0.6, 0.8]) AS re FROM alltx)
SELECT {', '.join(IDS)}, {_quintile("sale_discount_applied", "de")} AS discount_quantile,
  {_quintile("sale_revenue", "re")} AS revenue_quantile FROM alltx, e""",
)
def quintile_bins(spark, d):
    out = clean.with_quantile_bins(view.all_transactions(spark, d))
    return shaped(out.select("cust_id", "sale_id", "prod_id", "discount_quantile", "revenue_quantile"))


@_add(
    "calendar_parts",
    _pick(
        "alltx", *IDS, sql_int("month(order_date)", "order_month"), sql_int("quarter(order_date)", "order_quarter"),
        "strftime(order_date, '%Y-%m') AS year_month",
    ),
)
def calendar_parts(spark, d):
    return shaped(
        view.all_transactions(spark, d).select(
            "cust_id", "sale_id", "prod_id", F.month("order_date").alias("order_month"),
            F.quarter("order_date").alias("order_quarter"),
            F.date_format("order_date", "yyyy-MM").alias("year_month"),
        )
    )


@_add(
    "date_ordinal",
    _pick("alltx", *IDS, sql_int("date_diff('day', date '1970-01-01', cast(order_date as date)) + 719163", "ordinal")),
)
def date_ordinal(spark, d):
    return shaped(
        view.all_transactions(spark, d).select(
            "cust_id", "sale_id", "prod_id", x.date_ordinal("order_date").alias("ordinal")
        )
    )


_TEXT = {"order_text": _BAD_DATE, "prod_brand": "prod_brand", "prod_color": "prod_color"}


@_add(
    "infer_date_columns",
    WITH + "\n" + " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, round(avg(case when try_cast({sql} as timestamp) is null then 0.0 else 1.0 end) "
        f"+ 1e-7, 4) AS parse_ratio, cast(avg(case when try_cast({sql} as timestamp) is null then 0.0 else 1.0 end) > 0.9 "
        f"as bigint) AS is_date FROM alltx" for n, sql in _TEXT.items()
    ),
)
def infer_date_columns(spark, d):
    rows = view.all_transactions(spark, d).selectExpr(*[f"{sql} as {n}" for n, sql in _TEXT.items()])
    return shaped(clean.date_like_columns(rows, list(_TEXT)))


def _prepared_sql(part: str) -> str:
    return (
        f"SELECT '{part}' AS part, {', '.join(IDS)}, "
        f"""{sql_int("date_diff('second', timestamp '1970-01-01', order_date)", "order_date")}, """
        f"cast(coalesce(date_diff('second', timestamp '1970-01-01', try_cast({_BAD_DATE} as timestamp)), 0) as bigint) AS order_text, "
        f"coalesce(prod_brand, 'missing') AS prod_brand FROM alltx SEMI JOIN {part} USING (cust_id)"
    )


@_add("prepared_frames", f"{WITH}\n{_prepared_sql('train')} UNION ALL {_prepared_sql('test')}")
def prepared_frames(spark, d):
    """Rows of training customers decide what reads as a date; both parts are prepared alike."""
    rows = view.all_transactions(spark, d).select(
        "cust_id", "sale_id", "prod_id", "order_date", F.expr(_BAD_DATE).alias("order_text"), "prod_brand"
    )
    train = rows.join(view.train_labels(spark, d), "cust_id", "left_semi")
    test = rows.join(view.test_customers(spark, d), "cust_id", "left_semi")
    (a, b), _ = clean.prepare_frames(train, [test])
    return shaped(a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test"))))


FAVOURITES = ("prod_brand", "prod_season")
_SEED = 42


def _favourite_sql(c: str) -> str:
    return (
        f"f_{c} AS (SELECT cust_id, max({{'n': n, 'v': v}}) AS m FROM (SELECT cust_id, {c} AS v, count(*) AS n "
        f"FROM tx WHERE {c} IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"
    )


def _earlier_sql(c: str) -> str:
    w = f"over (PARTITION BY {c} ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return sql_num(f"(coalesce(sum(y) {w}, 0) + prior) / (count(y) {w} + 1)", f"{c}_target_mean")


def _trained_sql(c: str) -> str:
    of = f"FROM t WHERE t.{c} = e.{c}"
    return sql_num(f"(coalesce((SELECT sum(y) {of}), 0) + (SELECT avg(y) FROM t)) / ((SELECT count(*) {of}) + 1)", f"{c}_target_mean")


_FAVOURED = ", ".join(f"coalesce(f_{c}.m.v, 'missing') AS {c}" for c in FAVOURITES)
_FAVOURITE_JOINS = " ".join(f"LEFT JOIN f_{c} USING (cust_id)" for c in FAVOURITES)


@_add(
    "category_statistics",
    f"""{WITH}, {', '.join(map(_favourite_sql, FAVOURITES))},
t AS (SELECT cust_id, case when revenue_2018_2019 > 0 then 1.0 else 0.0 end AS y, md5('{_SEED}:' || cust_id) AS h,
  avg(case when revenue_2018_2019 > 0 then 1.0 else 0.0 end) over () AS prior, {_FAVOURED} FROM train {_FAVOURITE_JOINS}),
e AS (SELECT cust_id, {_FAVOURED} FROM test {_FAVOURITE_JOINS})
SELECT 'train' AS part, {sql_int('cust_id', 'cust_id')}, {', '.join(map(_earlier_sql, FAVOURITES))} FROM t
UNION ALL SELECT 'test', {sql_int('cust_id', 'cust_id')}, {', '.join(map(_trained_sql, FAVOURITES))} FROM e""",
)
def category_statistics(spark, d):
    """Favourite brand and season of every customer as numbers that stage one can learn from."""
    bought = view.transactions(spark, d).select("cust_id", *FAVOURITES)
    favourites = staged(target_stats.dominant_values(bought, "cust_id", list(FAVOURITES)), "favourites")
    labels = view.train_labels(spark, d).select("cust_id", (F.col(TARGET) > 0).cast("int").alias("target_binary"))
    train = staged(labels.join(favourites, "cust_id", "left"), "train-categories")
    test = view.test_customers(spark, d).join(favourites, "cust_id", "left")
    (train, test), categories = clean.prepare_frames(train, [test])
    a, b = target_stats.with_statistics(train, test, categories, "target_binary", ["cust_id"], seed=_SEED)
    parts = a.drop("target_binary").withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))
    return shaped(parts)


@_add(
    "math_suite",
    _pick(
        "alltx", *IDS, sql_num("abs(sale_discount_applied)", "abs_discount"),
        sql_num("ln(nullif(sale_revenue, 0))", "log_revenue"), sql_num("ln(1 + sale_revenue)", "log1p_revenue"),
        sql_num("exp(ln(1 + sale_revenue)) - 1", "back_revenue", 2),
        sql_num("greatest(sale_discount_applied + 1000, 0)", "clipped"),
        sql_num("pow(prod_size / 100.0, 1.4)", "powered"),
    ),
)
def math_suite(spark, d):
    t = view.all_transactions(spark, d).select(
        "cust_id", "sale_id", "prod_id", F.abs("sale_discount_applied").alias("abs_discount"),
        F.ln(x.nz("sale_revenue")).alias("log_revenue"), F.log1p("sale_revenue").alias("log1p_revenue"),
        F.expm1(F.log1p("sale_revenue")).alias("back_revenue"),
        clip0(F.col("sale_discount_applied") + 1000).alias("clipped"),
        F.pow(F.col("prod_size") / 100.0, F.lit(1.4)).alias("powered"),
    )
    return shaped(t).withColumn("back_revenue", F.round(F.col("back_revenue"), 2))


@_add(
    "filter_non_returned",
    _pick("alltx WHERE is_returned = 0", *IDS, sql_num("sale_revenue", "sale_revenue")),
)
def filter_non_returned(spark, d):
    kept = view.all_transactions(spark, d).where("is_returned = 0")
    return shaped(kept.select("cust_id", "sale_id", "prod_id", "sale_revenue"))


@_add(
    "negative_revenue",
    _pick(
        "alltx", sql_int("count(*) FILTER (sale_revenue + 15 * sale_discount_applied < 0)", "n_negative"),
        sql_num("min(sale_revenue + 15 * sale_discount_applied)", "lowest"),
    ),
)
def negative_revenue(spark, d):
    from buyerscope.operators.profile import negative_values

    rows = view.all_transactions(spark, d).withColumn(
        "adjusted", F.expr("sale_revenue + 15 * sale_discount_applied")
    )
    return shaped(negative_values(rows, "adjusted"))


@_add(
    "targets",
    _pick(
        "train", sql_int("cust_id", "cust_id"), sql_int("case when revenue_2018_2019 > 0 then 1 else 0 end", "target_binary"),
        sql_num("revenue_2018_2019", "target_reg"), sql_num("ln(1 + revenue_2018_2019)", "target_log"),
    ),
)
def targets(spark, d):
    from buyerscope.models.twostage import with_targets

    out = with_targets(view.train_labels(spark, d))
    return shaped(out.select("cust_id", "target_binary", "target_reg", "target_log"))


@_add(
    "buyers_only",
    _pick("train WHERE revenue_2018_2019 > 0", sql_int("cust_id", "cust_id"), sql_num("ln(1 + revenue_2018_2019)", "target_log")),
)
def buyers_only(spark, d):
    from buyerscope.models.twostage import buyers, with_targets

    return shaped(buyers(with_targets(view.train_labels(spark, d))).select("cust_id", "target_log"))


# Joins -------------------------------------------------------------------------------


@_add(
    "join_inner_labels",
    _pick("tx JOIN train USING (cust_id)", *IDS, sql_num("sale_revenue", "sale_revenue"),
          sql_num("revenue_2018_2019", TARGET)),
)
def join_inner_labels(spark, d):
    items = view.transactions(spark, d).select("cust_id", "sale_id", "prod_id", "sale_revenue")
    return shaped(items.join(view.train_labels(spark, d), "cust_id"))


_SMALL = (
    "feats AS (SELECT cust_id, count(sale_id) AS n_items, sum(sale_revenue) FILTER (is_returned = 0) AS total_revenue_net, "
    "max(order_date) AS last_purchase FROM tx GROUP BY 1), everyone AS (SELECT c_custkey AS cust_id FROM customer)"
)


def _small_features(spark, d) -> DataFrame:
    """A small feature table; customers that never ordered are not in it."""
    return store.select_features(
        view.transactions(spark, d), view.FEATURES, ["n_items", "total_revenue_net", "last_purchase"]
    )


@_add(
    "join_left_fill",
    f"{WITH}, {_SMALL}\nSELECT {sql_int('cust_id', 'cust_id')}, {sql_num('coalesce(revenue_2018_2019, 0)', TARGET)}, "
    f"{sql_int('coalesce(n_items, 0)', 'n_items')}, {sql_num('coalesce(total_revenue_net, 0)', 'total_revenue_net')} "
    "FROM everyone LEFT JOIN train USING (cust_id) LEFT JOIN feats USING (cust_id)",
)
def join_left_fill(spark, d):
    from buyerscope.models.twostage import join_labels_left

    labels = view.customers(spark, d).join(view.train_labels(spark, d), "cust_id", "left")
    joined = join_labels_left(labels, _small_features(spark, d))
    return shaped(joined.drop("last_purchase"))


@_add(
    "join_right_test",
    f"{WITH}, {_SMALL}\nSELECT {sql_int('cust_id', 'cust_id')}, {sql_int('n_items', 'n_items')}, "
    f"{sql_num('coalesce(total_revenue_net, case when n_items is not null then 0 end)', 'total_revenue_net')}, "
    f"{sql_time('last_purchase', 'last_purchase')} FROM everyone LEFT JOIN feats USING (cust_id)",
)
def join_right_test(spark, d):
    from buyerscope.models.twostage import join_test_customers

    return shaped(join_test_customers(_small_features(spark, d), view.customers(spark, d)))


@_add(
    "conform_columns",
    f"{WITH}, {_SMALL}\nSELECT {sql_int('cust_id', 'cust_id')}, {sql_num('coalesce(n_items, 0)', 'n_items')}, "
    f"{sql_num('coalesce(total_revenue_net, 0)', 'total_revenue_net')}, {sql_num('0', 'never_computed')} "
    "FROM everyone LEFT JOIN feats USING (cust_id)",
)
def conform_columns_query(spark, d):
    from buyerscope.models.twostage import join_test_customers

    rows = join_test_customers(_small_features(spark, d), view.customers(spark, d))
    return shaped(conform_columns(rows, ["n_items", "total_revenue_net", "never_computed"]))


def split_sql(share: float = 0.2, seed: int = 42) -> str:
    """CTE ``split``: the labelled customers with is_validation."""
    p = 2147483647
    h = f"(((((cust_id % {p}) + {seed}) % {p}) * 48271 % {p}) * 69621 + 12345) % {p}"
    return f"""split AS (SELECT *, cast(row_number() OVER (PARTITION BY buyer ORDER BY h, cust_id)
    <= floor(count(*) OVER (PARTITION BY buyer) * {share} + 0.5) as bigint) AS is_validation
  FROM (SELECT *, cast(revenue_2018_2019 > 0 as bigint) AS buyer, {h} AS h FROM train))"""


def split_train(spark, d) -> DataFrame:
    rows = view.train_labels(spark, d).withColumn("buyer", (F.col(TARGET) > 0).cast("int"))
    return stratified_split(rows, "buyer")


@_add(
    "stratified_split",
    f"{WITH}, {split_sql()}\nSELECT {sql_int('cust_id', 'cust_id')}, {sql_int('buyer', 'buyer')}, is_validation FROM split",
)
def stratified_split_query(spark, d):
    return shaped(split_train(spark, d).select("cust_id", "buyer", "is_validation"))


@_add(
    "semi_join_split",
    f"{WITH}, {split_sql()}\nSELECT {', '.join(IDS)} FROM tx WHERE cust_id IN "
    "(SELECT cust_id FROM split WHERE is_validation = 0)",
)
def semi_join_split(spark, d):
    items = view.transactions(spark, d).select("cust_id", "sale_id", "prod_id")
    chosen = split_train(spark, d).where("is_validation = 0").select("cust_id")
    return shaped(items.join(chosen, "cust_id", "left_semi"))


@_add(
    "split_leak_check",
    f"{WITH}, {split_sql()}\nSELECT cast(count(*) as bigint) AS n_shared FROM (SELECT cust_id FROM split WHERE "
    "is_validation = 0 INTERSECT SELECT cust_id FROM split WHERE is_validation = 1)",
)
def split_leak_check(spark, d):
    split = split_train(spark, d)
    left = split.where("is_validation = 0").select("cust_id")
    right = split.where("is_validation = 1").select("cust_id")
    return shaped(left.intersect(right).agg(F.count("*").alias("n_shared")))


@_add(
    "split_zero_rate",
    f"{WITH}, {split_sql()}\nSELECT case is_validation when 1 then 'validation' else 'calibration' end AS part, "
    f"count(*) AS n_customers, {sql_num('avg(case when revenue_2018_2019 = 0 then 1.0 else 0.0 end)', 'zero_rate')} "
    "FROM split JOIN (SELECT DISTINCT cust_id FROM tx) USING (cust_id) GROUP BY 1 "
    f"UNION ALL SELECT 'original', count(*), {sql_num('avg(case when revenue_2018_2019 = 0 then 1.0 else 0.0 end)', 'z')} FROM train",
)
def split_zero_rate(spark, d):
    seen = view.transactions(spark, d).select("cust_id")
    per_customer = split_train(spark, d).join(seen, "cust_id", "left_semi")
    zero = F.avg((F.col(TARGET) == 0).cast("double")).alias("zero_rate")
    parts = per_customer.groupBy(
        F.when(F.col("is_validation") == 1, "validation").otherwise("calibration").alias("part")
    ).agg(F.count("*").alias("n_customers"), zero)
    whole = view.train_labels(spark, d).agg(F.count("*").alias("n_customers"), zero)
    return shaped(parts.unionByName(whole.withColumn("part", F.lit("original"))))


@_add(
    "cleaned_transactions",
    f"""{WITH}, e AS (SELECT quantile_cont(sale_discount_applied, [0.2, 0.4, 0.6, 0.8]) AS de,
  quantile_cont(sale_revenue, [0.2, 0.4, 0.6, 0.8]) AS re FROM alltx)
SELECT prod_size_bin, season_type, discount_quantile, revenue_quantile, count(*) AS n_rows,
  {sql_num("sum(sale_revenue)", "revenue", 2)}
FROM (SELECT *, cast(case when prod_size > 0 and prod_size <= 35 then 1 when prod_size > 35 and prod_size <= 44 then 2
    when prod_size > 44 and prod_size <= 100 then 3 end as bigint) AS prod_size_bin,
  {_case("regexp_extract(prod_season, '^[A-Z]+')", x.SEASON_TYPES)} AS season_type,
  {_quintile("sale_discount_applied", "de")} AS discount_quantile,
  {_quintile("sale_revenue", "re")} AS revenue_quantile FROM alltx, e) GROUP BY ALL""",
)
def cleaned_transactions(spark, d):
    rows = clean.clean(view.all_transactions(spark, d))
    out = rows.groupBy("prod_size_bin", "season_type", "discount_quantile", "revenue_quantile").agg(
        F.count("*").alias("n_rows"), F.sum("sale_revenue").alias("revenue")
    )
    return shaped(out, 2)
