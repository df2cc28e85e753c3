"""Column expressions. Everything here stays inside Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MICROS_PER_DAY = 86_400_000_000

# The six tokens known as booleans, the season codes, the brand
# spellings that are merged, and the labels of the quintile bins.
BOOL_TOKENS = {"true": 1, "false": 0, "1": 1, "0": 0, "yes": 1, "no": 0}
SEASON_NAMES = {
    "Z": "Summer",
    "W": "Winter",
    "MZ": "Mid-season Summer",
    "MW": "Mid-season Winter",
    "SZ": "Special Summer",
    "SW": "Special Winter",
    "NOS": "Never Out of Stock",
    "CONS": "Consignment",
}
SEASON_TYPES = {
    "Z": "Main",
    "W": "Main",
    "MZ": "Mid-season",
    "MW": "Mid-season",
    "SZ": "Special",
    "SW": "Special",
    "NOS": "NOS",
    "CONS": "CONS",
}
BRAND_SYNONYMS = {
    "Bana & Co": "Bana",
    "Brako Anatomics": "Brako",
    "Gabor Kids": "Gabor",
    "Ragazzi Sport": "Ragazzi",
}
QUINTILE_LABELS = (
    "Q1 (0-20%)",
    "Q2 (20-40%)",
    "Q3 (40-60%)",
    "Q4 (60-80%)",
    "Q5 (80-100%)",
)
SIZE_EDGES = (0, 35, 44, 100)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nz(x: Column | str) -> Column:
    """NULL where the value is zero: the safe denominator."""
    return F.nullif(_c(x), F.lit(0))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end, rounded down: one hour early is -1 day."""
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.floor(micros / F.lit(float(MICROS_PER_DAY))).cast("long")


def day_start(day) -> Column:
    """Midnight of a Python date, as a timestamp without zone."""
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def lenient(name: str, have: T.DataType, want: T.DataType) -> str:
    """SQL text of a cast that gives NULL for text it cannot read and for NaN."""
    if have == want and not isinstance(have, (T.DoubleType, T.FloatType)):
        return name
    source = name
    if isinstance(have, T.StringType) and not isinstance(want, T.StringType):
        source = f"trim({name})"
    cast = f"try_cast({source} as {want.simpleString()})"
    if isinstance(want, T.DoubleType):
        return f"if(abs({cast}) < double('infinity'), {cast}, null)"
    return cast


def finite(x: Column | str) -> Column:
    """NULL for NaN and for both infinities."""
    col = _c(x)
    return F.when(~F.isnan(col) & (F.abs(col) != F.lit(float("inf"))), col)


def bool_token(name: str, have: T.DataType) -> str:
    """SQL text: 0 or 1 for the six known tokens, NULL for everything else."""
    if isinstance(have, T.BooleanType):
        return f"cast({name} as int)"
    whens = " ".join(f"when '{k}' then {v}" for k, v in BOOL_TOKENS.items())
    return f"case lower(trim(cast({name} as string))) {whens} end"


# SQL text, for tables with many columns: one text parses much faster than the same
# expression put together from hundreds of Column objects.


def sql_days(start: str, end: str) -> str:
    return f"cast(floor(timestampdiff(MICROSECOND, {start}, {end}) / {MICROS_PER_DAY}D) as bigint)"


def sql_ratio(a: str, b: str) -> str:
    return f"({a}) / nullif(cast(({b}) as double), 0D)"


def sql_midnight(day) -> str:
    return f"timestamp_ntz'{day.isoformat()} 00:00:00'"


def with_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` and new columns given as SQL text."""
    return df.selectExpr("*", *[f"{sql} as {name}" for name, sql in columns.items()])


def grouped(df: DataFrame, keys: dict[str, str] | list[str], columns: dict[str, str]) -> DataFrame:
    """``GROUP BY`` with keys and aggregates given as SQL text."""
    named = keys if isinstance(keys, dict) else {k: k for k in keys}
    select = [f"{sql} as {name}" for name, sql in {**named, **columns}.items()]
    by = ", ".join(named.values())
    return df.sparkSession.sql(f"select {', '.join(select)} from {{rows}} group by {by}", rows=df)


def lookup(x: Column | str, table: dict) -> Column:
    """Dictionary lookup in a literal map, so that ``x`` is worked out once; unknown keys give NULL."""
    flat = [F.lit(v) for pair in table.items() for v in pair]
    return F.try_element_at(F.create_map(*flat), _c(x))


def first_token(x: Column | str) -> Column:
    """First entry of a comma list, trimmed."""
    return F.trim(F.split_part(_c(x), F.lit(","), F.lit(1)))


def season_code(x: Column | str) -> Column:
    return F.regexp_substr(_c(x), F.lit("^[A-Z]+"))


def season_year(x: Column | str) -> Column:
    return F.regexp_substr(_c(x), F.lit("[0-9]{2}$")).try_cast("double") + F.lit(2000.0)


def season_name(code: Column | str) -> Column:
    return lookup(code, SEASON_NAMES)


def season_type(code: Column | str) -> Column:
    return lookup(code, SEASON_TYPES)


def merge_brands(x: Column | str) -> Column:
    col = _c(x)
    return F.coalesce(lookup(col, BRAND_SYNONYMS), col)


def size_bin(x: Column | str) -> Column:
    """1 kids, 2 standard, 3 big; bins are open below and closed above."""
    col = _c(x)
    lo, a, b, hi = SIZE_EDGES
    return (
        F.when((col > lo) & (col <= a), F.lit(1))
        .when((col > a) & (col <= b), F.lit(2))
        .when((col > b) & (col <= hi), F.lit(3))
    )


def quantile_bin(x: Column | str, edges: list[Column], labels=QUINTILE_LABELS) -> Column:
    """Label of the first bin whose upper edge is not below the value.

    Equal values share a bin, and where two edges coincide the lower bin wins.
    """
    col = _c(x)
    case = F.when(col <= edges[0], F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        case = case.when(col <= edge, F.lit(label))
    return case.when(col.isNotNull(), F.lit(labels[-1]))


def date_ordinal(x: Column | str) -> Column:
    """Day number counted from year 1 (1 January of year 1 is day 1)."""
    return F.unix_date(_c(x).cast("date")) + F.lit(719_163)


def epoch_seconds(x: Column | str) -> Column:
    origin = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", origin, _c(x))


def clip0(x: Column | str) -> Column:
    return F.greatest(_c(x), F.lit(0.0))
