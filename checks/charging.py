"""Sessions, schedules and the summaries built on them."""

from __future__ import annotations

from checks.common import Tables, add_cte, r, sql
from wattline.operators import charging as ch

MAX_KW = 7.0
LOW_CARBON = 300


def session_features(t: Tables):
    return ch.session_features(t.sessions)


def session_filter(t: Tables):
    return ch.valid_sessions(ch.session_features(t.sessions))


def arrival_heatmap(t: Tables):
    return ch.arrival_heatmap(ch.session_features(t.sessions))


def energy_histogram(t: Tables):
    return ch.energy_histogram(ch.session_features(t.sessions), 0.0, 100.0, 20)


def _slots(t: Tables):
    return ch.session_slots(t.sessions, t.dense_regional)


def _scheduled(t: Tables):
    status = ch.session_status(t.sessions, MAX_KW)
    feasible = status.filter("status = 'optimal'").select(*t.sessions.columns)
    return ch.schedules(ch.session_slots(feasible, t.dense_regional), MAX_KW)


def session_slots(t: Tables):
    return _slots(t).select("session_id", "slot", "region_id", "carbon_intensity", "price", "n_slots")


def optimal_schedule(t: Tables):
    return _scheduled(t).select("session_id", "slot", "carbon_intensity", "optimal_kw")


def plain_schedule(t: Tables):
    return _scheduled(t).select("session_id", "slot", "carbon_intensity", "plain_kw")


def infeasible(t: Tables):
    return ch.session_status(t.sessions, MAX_KW).select("session_id", "n_slots", "status")


def savings(t: Tables):
    return ch.savings(_scheduled(t))


def optimise_sessions(t: Tables):
    return ch.optimise_sessions(t.sessions, t.dense_regional, MAX_KW)


def greenest_window(t: Tables):
    return ch.greenest_window(t.dense_regional)


def fleet_demand(t: Tables):
    return ch.fleet_demand(_scheduled(t), LOW_CARBON)


def shifted_share(t: Tables):
    return ch.shifted_share(ch.fleet_demand(_scheduled(t), LOW_CARBON))


def charge_heatmap(t: Tables):
    return ch.carbon_heatmap(t.dense_regional)


def cumulative_saving(t: Tables):
    saved = ch.savings(_scheduled(t))
    return ch.cumulative_saving(saved.join(t.sessions.select("session_id", "arrival_time"), "session_id"))


def intensity_band(t: Tables):
    return ch.intensity_band(t.regional, 200, 400)


add_cte(
    "bounded",
    ["sessions"],
    """SELECT *, greatest(0, last_slot - first_slot + 1) AS n_slots, CASE WHEN energy_kwh > greatest(0, last_slot -
       first_slot + 1) * 3.5e0 THEN 'infeasible' ELSE 'optimal' END AS status FROM (SELECT *,
       (epoch_us(arrival_time) + 1799999999) // 1800000000 AS first_slot,
       epoch_us(departure_time) // 1800000000 - 1 AS last_slot FROM sessions)""",
)
add_cte(
    "slots",
    ["bounded", "dense"],
    """SELECT b.session_id, b.region_id, b.energy_kwh, b.n_slots, b.status, b.arrival_time, d.slot, d.carbon_intensity,
       d.price FROM bounded b JOIN dense d ON d.region_id = b.region_id AND epoch_us(d.slot) // 1800000000
       BETWEEN b.first_slot AND b.last_slot""",
)
add_cte(
    "scheduled",
    ["slots"],
    """SELECT *, least(3.5e0, greatest(0e0, energy_kwh - (row_number() OVER (PARTITION BY session_id
       ORDER BY carbon_intensity, slot) - 1) * 3.5e0)) / 0.5e0 AS optimal_kw, least(3.5e0, greatest(0e0, energy_kwh -
       (row_number() OVER (PARTITION BY session_id ORDER BY slot) - 1) * 3.5e0)) / 0.5e0 AS plain_kw
       FROM slots WHERE status = 'optimal'""",
)
add_cte(
    "saved",
    ["scheduled"],
    """SELECT session_id, any_value(arrival_time) AS arrival_time,
       sum((plain_kw - optimal_kw) * 0.5e0 * carbon_intensity) AS carbon_saving_g,
       sum((plain_kw - optimal_kw) * 0.5e0 * price) / 100 AS cost_saving_gbp,
       sum(optimal_kw * 0.5e0) AS energy_delivered_kwh FROM scheduled GROUP BY 1""",
)
add_cte(
    "demand",
    ["scheduled"],
    """SELECT slot, sum(optimal_kw * 0.5e0) AS optimal_kwh, sum(plain_kw * 0.5e0) AS plain_kwh,
       coalesce(sum(CASE WHEN carbon_intensity < 300 THEN optimal_kw * 0.5e0 END), 0) AS optimal_low_kwh,
       coalesce(sum(CASE WHEN carbon_intensity < 300 THEN plain_kw * 0.5e0 END), 0) AS plain_low_kwh
       FROM scheduled GROUP BY 1""",
)
_HOURS = "(epoch_us(departure_time) - epoch_us(arrival_time)) / 3600000000e0"
_ARRIVAL = "(hour(arrival_time) + minute(arrival_time) / 60e0)"
_SAVED = ", ".join(r(c, c) for c in ("carbon_saving_g", "cost_saving_gbp", "energy_delivered_kwh"))
_FEATURES = f"""SELECT session_id, {r(_ARRIVAL, 'arrival_hour')}, {r(_HOURS, 'duration_hours')},
    {r('energy_kwh', 'energy_kwh')}, CAST(isodow(arrival_time) - 1 AS INT) AS day_of_week FROM sessions"""

QUERIES = {
    "session_features": (session_features, sql("sessions", _FEATURES)),
    "session_filter": (
        session_filter,
        sql("sessions", f"{_FEATURES} WHERE NOT ({_HOURS} < 0.5 OR energy_kwh > 150 OR {_ARRIVAL} + {_HOURS} > 48)"),
    ),
    "arrival_heatmap": (
        arrival_heatmap,
        sql(
            "sessions",
            """SELECT CAST(isodow(arrival_time) - 1 AS INT) AS day_of_week, CAST(hour(arrival_time) AS INT) AS hour,
            count(*) AS n_sessions FROM sessions GROUP BY 1, 2""",
        ),
    ),
    "energy_histogram": (
        energy_histogram,
        sql(
            "sessions",
            """SELECT CAST(CASE WHEN energy_kwh < 0 THEN 0 WHEN energy_kwh >= 100 THEN 21 ELSE floor(energy_kwh / 5) + 1 END
            AS BIGINT) AS bucket, count(*) AS n_sessions FROM sessions GROUP BY 1""",
        ),
    ),
    "session_slots": (
        session_slots,
        sql("slots", f"SELECT session_id, slot, region_id, carbon_intensity, {r('price', 'price')}, n_slots FROM slots"),
    ),
    "optimal_schedule": (
        optimal_schedule,
        sql("scheduled", f"SELECT session_id, slot, carbon_intensity, {r('optimal_kw', 'optimal_kw')} FROM scheduled"),
    ),
    "plain_schedule": (
        plain_schedule,
        sql("scheduled", f"SELECT session_id, slot, carbon_intensity, {r('plain_kw', 'plain_kw')} FROM scheduled"),
    ),
    "infeasible": (infeasible, sql("bounded", "SELECT session_id, n_slots, status FROM bounded")),
    "savings": (savings, sql("saved", f"SELECT session_id, {_SAVED} FROM saved")),
    "optimise_sessions": (
        optimise_sessions,
        sql("bounded saved", f"""SELECT b.session_id, CASE WHEN status = 'optimal' AND coalesce(energy_delivered_kwh, 0) < energy_kwh - 1e-9
            THEN 'short_forecast' ELSE status END AS status, n_slots, {_SAVED} FROM bounded b LEFT JOIN saved USING (session_id)"""),
    ),
    "greenest_window": (
        greenest_window,
        sql(
            "dense",
            f"""SELECT region_id, slot AS window_start, {r('m', 'mean_carbon')} FROM (SELECT *, row_number() OVER (
            PARTITION BY region_id ORDER BY m, slot) AS rn FROM (SELECT *, avg(carbon_intensity) OVER w AS m, count(*) OVER w
            AS n FROM dense WINDOW w AS (PARTITION BY region_id ORDER BY slot ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING))
            WHERE n = 8) WHERE rn = 1""",
        ),
    ),
    "fleet_demand": (
        fleet_demand,
        sql(
            "demand",
            f"SELECT slot, {', '.join(r(c, c) for c in ('optimal_kwh', 'plain_kwh', 'optimal_low_kwh', 'plain_low_kwh'))} FROM demand",
        ),
    ),
    "shifted_share": (
        shifted_share,
        sql(
            "demand",
            f"""SELECT {r('100 * sum(optimal_low_kwh) / sum(optimal_kwh)', 'optimal_low_pct')},
            {r('100 * sum(plain_low_kwh) / sum(plain_kwh)', 'plain_low_pct')},
            {r('100 * sum(optimal_low_kwh) / sum(optimal_kwh) - 100 * sum(plain_low_kwh) / sum(plain_kwh)', 'shifted_pct')}
            FROM demand""",
        ),
    ),
    "charge_heatmap": (
        charge_heatmap,
        sql(
            "dense",
            f"""SELECT CAST(isodow(slot) - 1 AS INT) AS day_of_week, CAST(hour(slot) AS INT) AS hour,
            {r('quantile_cont(carbon_intensity, 0.5)', 'median_carbon')} FROM dense GROUP BY 1, 2""",
        ),
    ),
    "cumulative_saving": (
        cumulative_saving,
        sql(
            "saved",
            f"""SELECT day, {r('saving_g', 'saving_g')}, {r('sum(saving_g) OVER (ORDER BY day)', 'total_saving_g')} FROM (
            SELECT CAST(arrival_time AS DATE) AS day, sum(carbon_saving_g) AS saving_g FROM saved GROUP BY 1)""",
        ),
    ),
    "intensity_band": (
        intensity_band,
        sql(
            "regional",
            """SELECT *, CASE WHEN carbon_intensity < 200 THEN 'green' WHEN carbon_intensity >= 400 THEN 'red' ELSE 'amber' END
            AS band FROM regional""",
        ),
    ),
}
