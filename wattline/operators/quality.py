"""Data-quality rules as violation rows, and the same rules as a strict check.

Every check gives (source, rule_no, field, key, message). Row rules are evaluated in one narrow
pass; cross-row rules (duplicates, spacing, missing cities) are aggregations or chunked windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.columns import row_max, row_sum
from wattline.functions.reference import (
    CITIES,
    FUELS,
    INTENSITY_BOUNDS,
    SETTLEMENT_STEP,
    WEATHER_CHECK_BOUNDS,
    WEATHER_VARS,
)
from wattline.operators.windows import duplicate_times, irregular_intervals

SUM_RULE = 4 + len(FUELS)
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

Rule = tuple[int, str, Column, str]  # number, field, test that is true for a bad row, message


class QualityError(ValueError):
    """A strict check failed; ``field`` and ``message`` are those of the lowest rule."""

    def __init__(self, field: str, message: str):
        self.field = field
        self.message = message
        super().__init__(f"{field}: {message}")


def _key_text(column: str, is_time: bool) -> Column:
    text = F.date_format(column, TIME_FORMAT) if is_time else F.col(column).cast("string")
    return F.coalesce(text, F.lit("null"))


def _row_violations(df: DataFrame, source: str, rules: list[Rule], key: Column) -> DataFrame:
    """A row for every rule an input row breaks. A null test counts as passed."""
    if not rules:
        return _no_violations(df)
    found = F.array(
        *[
            F.when(
                test,
                F.struct(F.lit(no).alias("rule_no"), F.lit(field).alias("field"), F.lit(text).alias("message")),
            )
            for no, field, test, text in rules
        ]
    )
    return df.select(key.alias("key"), F.explode(F.array_compact(found)).alias("v")).select(
        F.lit(source).alias("source"), "v.rule_no", "v.field", "key", "v.message"
    )


def _no_violations(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "source string, rule_no int, field string, key string, message string"
    )


def _first_violation(df: DataFrame, source: str, rules: list[Rule], key: Column) -> DataFrame:
    """At most one row per input row: its first broken rule in rule order."""
    first = F.coalesce(
        *[
            F.when(
                test,
                F.struct(F.lit(no).alias("rule_no"), F.lit(field).alias("field"), F.lit(text).alias("message")),
            )
            for no, field, test, text in rules
        ]
    )
    return (
        df.select(key.alias("key"), first.alias("v"))
        .filter("v IS NOT NULL")
        .select(F.lit(source).alias("source"), "v.rule_no", "v.field", "key", "v.message")
    )


def _bounds_rule(no: int, field: str, low, high) -> Rule:
    bad = F.col(field) < F.lit(low)
    text = f"below {low}"
    if high is not None:
        bad, text = bad | (F.col(field) > F.lit(high)), f"outside {low} to {high}"
    return no, field, bad, text


def carbon_rules(df: DataFrame) -> list[Rule]:
    fields = [c for c in ("intensity_actual", "intensity_forecast") if c in df.columns]
    null_time = (1, "settlement_period", F.col("settlement_period").isNull(), "no time")
    return [null_time, *[_bounds_rule(4 + i, c, *INTENSITY_BOUNDS) for i, c in enumerate(fields)]]


def generation_rules(df: DataFrame) -> list[Rule]:
    fuels = [c for c in FUELS if c in df.columns]
    rules: list[Rule] = [(1, "settlement_period", F.col("settlement_period").isNull(), "no time")]
    rules += [(4 + i, c, F.col(c) < 0, "output below 0") for i, c in enumerate(FUELS) if c in fuels]
    if fuels and "total" in df.columns:
        total, summed = F.col("total"), row_sum(fuels)
        off = (summed < total * 0.95) | (summed > total * 1.05)
        rules.append((SUM_RULE, "total", off, "fuels add up to over 5% more or less than the total"))
    elif fuels:
        off = row_sum(fuels) > row_max(fuels) * 1.05
        rules.append((SUM_RULE, "multiple", off, "fuels add up to over 1.05 times the largest"))
    return rules


def weather_rules(df: DataFrame) -> list[Rule]:
    return [
        _bounds_rule(1 + i, c, *WEATHER_CHECK_BOUNDS[c]) for i, c in enumerate(WEATHER_VARS) if c in df.columns
    ]


def session_rules(df: DataFrame) -> list[Rule]:
    rules: list[Rule] = []
    if "energy_kwh" in df.columns:
        rules.append((1, "energy_kwh", F.col("energy_kwh") <= 0, "not above 0"))
    if {"arrival_time", "departure_time"} <= set(df.columns):
        late = F.col("departure_time") <= F.col("arrival_time")
        rules.append((2, "departure_time", late, "departs no later than it arrives"))
    if "duration" in df.columns:
        rules.append((3, "duration", F.col("duration") <= 0, "not above 0"))
    if "station_id" in df.columns:
        rules.append((4, "station_id", F.col("station_id").isNull(), "no station"))
    return rules


def _time_rules(df: DataFrame, source: str, keys: list[str], step: str) -> list[DataFrame]:
    """Rules 2 and 3: each time once per series, and rows exactly one step apart."""
    ts = "settlement_period"
    key = F.concat_ws("/", *[F.col(k).cast("string") for k in keys], F.date_format(ts, TIME_FORMAT))

    def rows(found: DataFrame, no: int, text: str) -> DataFrame:
        return found.select(
            F.lit(source).alias("source"),
            F.lit(no).alias("rule_no"),
            F.lit(ts).alias("field"),
            key.alias("key"),
            F.lit(text).alias("message"),
        )

    return [
        rows(duplicate_times(df, ts, keys), 2, "time occurs more than once"),
        rows(irregular_intervals(df, ts, keys, step), 3, f"Expected {step} between rows"),
    ]


def _series_key(keys: list[str]) -> Column:
    return F.concat_ws("/", *[F.col(k).cast("string") for k in keys], _key_text("settlement_period", True))


def check_carbon(df: DataFrame, keys: list[str] = (), step: str = SETTLEMENT_STEP, source: str = "carbon_intensity"):
    own = _row_violations(df, source, carbon_rules(df), _series_key(list(keys)))
    return reduce(DataFrame.unionByName, [own, *_time_rules(df, source, list(keys), step)])


def check_generation(df: DataFrame, keys: list[str] = (), step: str = SETTLEMENT_STEP, source: str = "generation_mix"):
    own = _row_violations(df, source, generation_rules(df), _series_key(list(keys)))
    return reduce(DataFrame.unionByName, [own, *_time_rules(df, source, list(keys), step)])


def _weather_key() -> Column:
    return F.concat_ws("/", F.col("city"), _key_text("timestamp", True))


def check_weather(df: DataFrame, cities: list[str] | None = None, source: str = "weather") -> DataFrame:
    """Bounds per row, then one row per time at which an expected city is missing."""
    names = cities or [c for c, _, _ in CITIES]
    own = _row_violations(df, source, weather_rules(df), _weather_key())
    seen = df.groupBy("timestamp").agg(*[F.max(F.col("city") == n).alias(f"_c{i}") for i, n in enumerate(names)])
    complete = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"_c{i}"), F.lit(False)) for i in range(len(names))])
    missing = seen.filter(~complete).select(
        F.lit(source).alias("source"),
        F.lit(4).alias("rule_no"),
        F.lit("city").alias("field"),
        _key_text("timestamp", True).alias("key"),
        F.concat(
            F.lit("cities without a row: "),
            F.concat_ws(
                ", ",
                *[
                    F.when(~F.coalesce(F.col(f"_c{i}"), F.lit(False)), F.lit(n))
                    for i, n in sorted(enumerate(names), key=lambda pair: pair[1])
                ],
            ),
        ).alias("message"),
    )
    return own.unionByName(missing)


def check_sessions(df: DataFrame, source: str = "ev_sessions") -> DataFrame:
    return _row_violations(df, source, session_rules(df), _key_text("session_id", False))


def require(violations: DataFrame) -> None:
    """Strict form: raise for the lowest rule broken. An empty input has no violations."""
    worst = violations.orderBy("rule_no", "field", "key").limit(1).collect()
    if worst:
        raise QualityError(worst[0]["field"], worst[0]["message"])


def report(frames: dict[str, DataFrame]) -> DataFrame:
    """Every bad row once, with its first broken row rule; unknown sources are left out.

    Rows are judged alone, so cross-row rules cannot fire, except that one weather row never
    holds all cities. Messages stay one per row: a list per source would gather it in one task.
    """
    parts = []
    for source, df in frames.items():
        if source == "carbon_intensity":
            parts.append(_first_violation(df, source, carbon_rules(df), _key_text("settlement_period", True)))
        elif source == "generation_mix":
            parts.append(_first_violation(df, source, generation_rules(df), _key_text("settlement_period", True)))
        elif source == "weather":
            lonely: Rule = (4, "city", F.col("timestamp").isNotNull(), "other cities lack this time")
            parts.append(_first_violation(df, source, [*weather_rules(df), lonely], _weather_key()))
        elif source == "ev_sessions":
            parts.append(_first_violation(df, source, session_rules(df), _key_text("session_id", False)))
    if not parts:
        raise ValueError("no known source to report on")
    return reduce(DataFrame.unionByName, parts)


def report_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(source, n_messages); clean sources are absent."""
    return report(frames).groupBy("source").agg(F.count(F.lit(1)).alias("n_messages"))
