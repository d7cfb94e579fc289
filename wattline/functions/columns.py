"""Column expressions: missing values, flags, bands, text clean-up, time steps."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def step_micros(step: str) -> int:
    """'30 minutes' -> microseconds; steps are fixed lengths of time."""
    match = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", step)
    if not match:
        raise ValueError(f"not a fixed time step: {step!r}")
    return int(match.group(1)) * _STEP_UNITS[match.group(2)] * 1_000_000


def floor_div(value: Column, width: int) -> Column:
    """Whole division that rounds down for negative values too (times before 1970)."""
    return ((value - F.pmod(value, F.lit(width))) / F.lit(width)).cast("long")


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing value only: NaN in a float column becomes null."""
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column."""
    return df.select(
        *[
            F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def in_range(column: str, low=None, high=None) -> Column:
    """Inclusive range flag; a null value gives a null flag."""
    value = F.col(column)
    tests = []
    if low is not None:
        tests.append(value >= F.lit(low))
    if high is not None:
        tests.append(value <= F.lit(high))
    return reduce(lambda a, b: a & b, tests)


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def above(column: str, threshold) -> Column:
    """True above the threshold, else false (null counts as false)."""
    return F.when(F.col(column) > F.lit(threshold), F.lit(True)).otherwise(F.lit(False))


def right_closed_band(column: str, edges: list[float], labels: list[str]) -> Column:
    """Label of the bin (edge[i], edge[i+1]]; the last bin is open above; outside is null."""
    value = F.col(column)
    uppers = [F.lit(e) for e in edges[1:]] + [None]
    expr = None
    for low, high, label in zip(edges, uppers, labels):
        test = value > F.lit(low)
        if high is not None:
            test = test & (value <= high)
        expr = F.when(test, F.lit(label)) if expr is None else expr.when(test, F.lit(label))
    return expr


def slug(name: str) -> str:
    """Column-name prefix of an entity: lower case, spaces to underscores."""
    return name.lower().replace(" ", "_")


def slug_column(column: Column) -> Column:
    return F.replace(F.lower(column), F.lit(" "), F.lit("_"))


def safe_name(column: Column) -> Column:
    """File-safe name: lower case, anything but a-z and 0-9 to an underscore."""
    return F.regexp_replace(F.lower(column), "[^a-z0-9]", "_")


def row_sum(columns: list[str]) -> Column:
    """Sum across columns with null counted as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])


def row_max(columns: list[str]) -> Column:
    """Largest value across columns, nulls skipped."""
    return F.greatest(*[F.col(c) for c in columns]) if len(columns) > 1 else F.col(columns[0])


def join_null_safe(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``names`` in which null keys match too; the names are kept once."""
    renamed = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
    condition = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_right_{n}")) for n in names])
    return left.join(renamed, condition, how).drop(*[f"_right_{n}" for n in names])


def non_null_keys(df: DataFrame, keys: list[str]) -> dict[str, Column]:
    """Columns that tell series apart as ``keys`` do and are never null.

    Joins and windows on them share one partitioning, which null-safe equality prevents.
    """
    out: dict[str, Column] = {}
    for i, key in enumerate(keys):
        field = df.schema[key]
        blank = F.lit("") if isinstance(field.dataType, T.StringType) else F.lit(0).cast(field.dataType)
        out[f"_series_{i}"] = F.coalesce(F.col(key), blank)
        out[f"_series_{i}_null"] = F.col(key).isNull()
    return out
