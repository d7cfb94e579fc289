"""Sessions and charging schedules: features, slot expansion, optimal and plain schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.columns import floor_div, join_null_safe, step_micros
from wattline.functions.reference import SETTLEMENT_STEP
from wattline.operators.aggregates import exact_percentile
from wattline.operators.chunks import cut
from wattline.session import broadcast_if_small

SLOT_HOURS = 0.5


def session_features(sessions: DataFrame) -> DataFrame:
    """arrival_hour, duration_hours, energy_kwh and day_of_week (Monday 0) of each session."""
    arrival = F.col("arrival_time")
    seconds = F.unix_micros("departure_time") - F.unix_micros("arrival_time")
    return sessions.select(
        "session_id",
        (F.hour(arrival) + F.minute(arrival) / 60).alias("arrival_hour"),
        (seconds / 3_600_000_000).alias("duration_hours"),
        "energy_kwh",
        F.weekday(arrival).alias("day_of_week"),
    )


def valid_sessions(features: DataFrame, min_hours: float = 0.5, max_kwh: float = 150.0, latest_hour: float = 48.0):
    """Drop sessions that are too short, ask for too much, or end after the next day."""
    bad = (
        (F.col("duration_hours") < min_hours)
        | (F.col("energy_kwh") > max_kwh)
        | (F.col("arrival_hour") + F.col("duration_hours") > latest_hour)
    )
    return features.filter(~bad)


def arrival_heatmap(features: DataFrame) -> DataFrame:
    return features.groupBy("day_of_week", F.floor("arrival_hour").cast("int").alias("hour")).agg(
        F.count(F.lit(1)).alias("n_sessions")
    )


def energy_histogram(features: DataFrame, low: float, high: float, buckets: int) -> DataFrame:
    """Counts per equal-width bucket; 0 and buckets + 1 hold what lies outside."""
    bucket = F.width_bucket(F.col("energy_kwh").cast("double"), F.lit(low), F.lit(high), F.lit(buckets))
    return features.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_sessions"))


def with_slot_bounds(sessions: DataFrame, step: str = SETTLEMENT_STEP) -> DataFrame:
    """Add the first and last whole slot inside [arrival, departure) and their number."""
    width = step_micros(step)
    first = F.negate(floor_div(F.negate(F.unix_micros("arrival_time")), width))
    last = floor_div(F.unix_micros("departure_time"), width) - 1
    return sessions.withColumns({"_first_slot": first, "_last_slot": last}).withColumn(
        "n_slots", F.coalesce(F.greatest(F.lit(0), F.col("_last_slot") - F.col("_first_slot") + 1), F.lit(0))
    )


def session_slots(
    sessions: DataFrame, forecast: DataFrame, keys: list[str] = ("region_id",), step: str = SETTLEMENT_STEP
) -> DataFrame:
    """One row per session and slot it can charge in, with the forecast of that slot.

    Sessions are spread by session_id before they are expanded: the narrow rows are shuffled
    rather than the slots, and the per-session windows that follow reuse the partitioning as
    long as the forecast is small enough to broadcast.
    """
    width = step_micros(step)
    spread = with_slot_bounds(sessions, step).filter("n_slots > 0").repartition("session_id")
    slots = spread.withColumn("_slot_no", F.explode(F.sequence("_first_slot", "_last_slot"))).withColumn(
        "slot", F.timestamp_micros(F.col("_slot_no") * width)
    )
    return join_null_safe(slots.drop("_first_slot", "_last_slot", "_slot_no"), broadcast_if_small(forecast), [*keys, "slot"])


def _filled_in_order(order: list[Column], max_rate_kw: float) -> Column:
    """Rate per slot when slots are filled to the maximum in a given order until the need is met."""
    full = max_rate_kw * SLOT_HOURS
    place = F.row_number().over(Window.partitionBy("session_id").orderBy(*order)) - 1
    energy = F.least(F.lit(full), F.greatest(F.lit(0.0), F.col("energy_kwh") - place * full))
    return energy / SLOT_HOURS


def schedules(slots: DataFrame, max_rate_kw: float) -> DataFrame:
    """Add ``optimal_kw`` and ``plain_kw``.

    With carbon >= 0, filling the cleanest slots first is the exact optimum of the linear
    programme (meet the need, rates within [0, max], least total carbon). The plain schedule
    starts at once and stops when the need is met. Ties go to the earlier slot.
    """
    return slots.withColumns(
        {
            "optimal_kw": _filled_in_order([F.col("carbon_intensity").asc(), F.col("slot").asc()], max_rate_kw),
            "plain_kw": _filled_in_order([F.col("slot").asc()], max_rate_kw),
        }
    )


def session_status(sessions: DataFrame, max_rate_kw: float, step: str = SETTLEMENT_STEP) -> DataFrame:
    """'infeasible' when the need exceeds what all slots can deliver, else 'optimal'."""
    bounded = with_slot_bounds(sessions, step).drop("_first_slot", "_last_slot")
    capacity = F.col("n_slots") * (max_rate_kw * SLOT_HOURS)
    return bounded.withColumn(
        "status", F.when(F.col("energy_kwh") > capacity, "infeasible").otherwise("optimal")
    )


def savings(scheduled: DataFrame, keys: list[str] = ("session_id",)) -> DataFrame:
    """Carbon (g) and cost (pounds, from prices in pence) saved against the plain schedule."""
    shifted = (F.col("plain_kw") - F.col("optimal_kw")) * SLOT_HOURS
    return scheduled.groupBy(*keys).agg(
        F.sum(shifted * F.col("carbon_intensity")).alias("carbon_saving_g"),
        (F.sum(shifted * F.col("price")) / 100).alias("cost_saving_gbp"),
        F.sum(F.col("optimal_kw") * SLOT_HOURS).alias("energy_delivered_kwh"),
    )


def optimise_sessions(
    sessions: DataFrame, forecast: DataFrame, max_rate_kw: float, keys: list[str] = ("region_id",), step: str = SETTLEMENT_STEP
) -> DataFrame:
    """Status and savings of every session.

    'infeasible' sessions have no schedule; 'short_forecast' ones lack a forecast in slots they
    would need, so less than the need is scheduled.
    """
    status = session_status(sessions, max_rate_kw, step)
    feasible = status.filter("status = 'optimal'").select(*sessions.columns)
    saved = savings(schedules(session_slots(feasible, forecast, keys, step), max_rate_kw))
    joined = status.select("session_id", "status", "n_slots", "energy_kwh").join(saved, "session_id", "left")
    delivered = F.coalesce(F.col("energy_delivered_kwh"), F.lit(0.0))
    short = (F.col("status") == "optimal") & (delivered < F.col("energy_kwh") - 1e-9)
    return joined.withColumn("status", F.when(short, "short_forecast").otherwise(F.col("status"))).drop("energy_kwh")


def greenest_window(forecast: DataFrame, keys: list[str] = ("region_id",), ts: str = "slot", slots: int = 8) -> DataFrame:
    """Start and mean carbon of the lowest run of ``slots`` consecutive rows; earliest on ties."""
    keys = list(keys)
    chunked = cut(forecast, keys, ts, after=slots - 1)
    frame = chunked.window().rowsBetween(0, slots - 1)
    means = chunked.with_columns(
        {"mean_carbon": F.avg("carbon_intensity").over(frame), "n_ahead": F.count(F.lit(1)).over(frame)}
    ).home_rows()
    best = means.filter(F.col("n_ahead") == slots).groupBy(*keys).agg(F.min(F.struct("mean_carbon", ts)).alias("best"))
    return best.select(*keys, F.col(f"best.{ts}").alias("window_start"), F.col("best.mean_carbon").alias("mean_carbon"))


def fleet_demand(scheduled: DataFrame, low_carbon_below: float) -> DataFrame:
    """Fleet load per slot under both schedules, and how much of it falls in low-carbon rows."""
    low = F.col("carbon_intensity") < low_carbon_below
    kwh = {n: F.col(f"{n}_kw") * SLOT_HOURS for n in ("optimal", "plain")}
    return scheduled.groupBy("slot").agg(
        *[F.sum(e).alias(f"{n}_kwh") for n, e in kwh.items()],
        *[F.coalesce(F.sum(F.when(low, e)), F.lit(0.0)).alias(f"{n}_low_kwh") for n, e in kwh.items()],
    )


def shifted_share(demand: DataFrame) -> DataFrame:
    """Percentage of the fleet's energy in low-carbon slots, optimised and plain, and the gain."""
    share = {n: 100 * F.try_divide(F.sum(f"{n}_low_kwh"), F.sum(f"{n}_kwh")) for n in ("optimal", "plain")}
    return demand.agg(
        share["optimal"].alias("optimal_low_pct"),
        share["plain"].alias("plain_low_pct"),
        (share["optimal"] - share["plain"]).alias("shifted_pct"),
    )


def carbon_heatmap(forecast: DataFrame, ts: str = "slot", value: str = "carbon_intensity") -> DataFrame:
    """Median carbon by weekday (Monday 0) and hour."""
    keyed = forecast.select(F.weekday(ts).alias("day_of_week"), F.hour(ts).alias("hour"), value)
    return exact_percentile(keyed, value, 0.5, ["day_of_week", "hour"], "median_carbon")


def cumulative_saving(per_session: DataFrame, arrival: str = "arrival_time") -> DataFrame:
    """Carbon saved per arrival day and its running total (one row per day)."""
    daily = per_session.groupBy(F.to_date(arrival).alias("day")).agg(F.sum("carbon_saving_g").alias("saving_g"))
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("total_saving_g", F.sum("saving_g").over(upto))


def intensity_band(df: DataFrame, green_below: float, red_from: float, value: str = "carbon_intensity") -> DataFrame:
    """Green, amber or red; null stays null."""
    v = F.col(value)
    return df.withColumn(
        "band", F.when(v < green_below, "green").when(v >= red_from, "red").when(v.isNotNull(), "amber")
    )
