"""Bringing Spark results and check queries to one output form.

Numbers are rounded once, at the very end, after a small nudge; whole numbers become
bigint, dates become text. Both engines then print the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

NUDGE = "1e-7"


def shaped(df: DataFrame, digits: int = 4, fine: dict[str, int] | None = None) -> DataFrame:
    out = []
    for f in df.schema:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = f"round(cast({c} as double) + {NUDGE}D, {(fine or {}).get(f.name, digits)})"
        elif isinstance(f.dataType, (T.IntegralType, T.BooleanType)):
            c = f"cast({c} as bigint)"
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
        out.append(f"{c} as `{f.name}`")
    return df.selectExpr(*out)


def sql_num(expr: str, name: str, digits: int = 4) -> str:
    return f"round(cast({expr} as double) + {NUDGE}, {digits}) AS {name}"


def sql_int(expr: str, name: str) -> str:
    return f"cast({expr} as bigint) AS {name}"


def sql_time(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}"
