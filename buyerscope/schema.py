"""Declared schemas and the steps that bring any input to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from buyerscope.functions.exprs import bool_token, lenient, sql_days

_TS = T.TimestampNTZType()

TRANSACTIONS = T.StructType(
    [
        T.StructField("cust_id", T.LongType()),
        T.StructField("sale_id", T.LongType()),
        T.StructField("order_date", _TS),
        T.StructField("pack_date", _TS),
        T.StructField("sale_revenue", T.DoubleType()),
        T.StructField("sale_discount_applied", T.DoubleType()),
        T.StructField("prod_id", T.LongType()),
        T.StructField("prod_title", T.StringType()),
        T.StructField("prod_brand", T.StringType()),
        T.StructField("prod_color", T.StringType()),
        T.StructField("prod_type_1", T.StringType()),
        T.StructField("prod_type_3", T.StringType()),
        T.StructField("prod_type_4", T.StringType()),
        T.StructField("prod_type_5", T.StringType()),
        T.StructField("prod_material", T.StringType()),
        T.StructField("prod_season", T.StringType()),
        T.StructField("prod_size", T.DoubleType()),
        T.StructField("prod_web_only", T.IntegerType()),
        T.StructField("prod_outlet", T.IntegerType()),
        T.StructField("prod_heel", T.StringType()),
        T.StructField("prod_insole", T.StringType()),
        T.StructField("prod_print", T.StringType()),
        T.StructField("prod_comfort_sole", T.StringType()),
        T.StructField("prod_comfort_wear", T.StringType()),
        T.StructField("prod_clasp", T.StringType()),
        T.StructField("returned_to_shop_id", T.LongType()),
    ]
)

TRAIN_LABELS = T.StructType(
    [
        T.StructField("cust_id", T.LongType()),
        T.StructField("revenue_2018_2019", T.DoubleType()),
    ]
)

TEST_LABELS = T.StructType([T.StructField("cust_id", T.LongType())])

LEADERBOARD = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("AUC", T.DoubleType()),
        T.StructField("MAE", T.DoubleType()),
        T.StructField("Spearman", T.DoubleType()),
    ]
)

BOOL_TOKEN_COLUMNS = ("prod_web_only", "prod_outlet")


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all read as text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast leniently to ``schema``; absent columns become typed NULLs.

    Unreadable text turns to NULL instead of failing the job, and a NaN coming in
    from a float column is turned to NULL, so no later step has to guard for it.
    Columns outside the schema are kept as they are.
    """
    present = {f.name: f.dataType for f in df.schema}
    out = []
    for field in schema:
        if field.name not in present:
            sql = f"cast(null as {field.dataType.simpleString()})"
        elif field.name in BOOL_TOKEN_COLUMNS:
            sql = bool_token(field.name, present[field.name])
        else:
            sql = lenient(field.name, present[field.name], field.dataType)
        out.append(f"{sql} as {field.name}")
    known = set(schema.fieldNames())
    return df.selectExpr(*out, *[name for name in present if name not in known])


def type_transactions(df: DataFrame) -> DataFrame:
    """Typed transactions with ``is_returned`` and ``days_to_pack``.

    The return flag comes from the raw shop column before any fill, otherwise a
    filled marker would make every item look returned. Rows without a customer
    belong to no group and go away here, once.
    """
    typed = conform(df, TRANSACTIONS).where("cust_id is not null")
    given = "is_returned" in df.columns
    flag = "cast(is_returned as int)" if given else "cast(returned_to_shop_id is not null as int)"
    others = [c for c in typed.columns if c not in ("is_returned", "days_to_pack")]
    return typed.selectExpr(
        *others, f"{flag} as is_returned", f"{sql_days('order_date', 'pack_date')} as days_to_pack"
    )


def conform_columns(df: DataFrame, wanted: list[str], key: str = "cust_id") -> DataFrame:
    """Exactly ``key`` plus the ``wanted`` numeric columns; NULL and absent ones are 0."""
    have = set(df.columns)
    return df.select(
        key,
        *[
            (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in have else F.lit(0.0)).alias(c)
            for c in wanted
        ],
    )
