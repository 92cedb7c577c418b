"""DuckDB SQL twins of the bindings and products, used as correctness oracles.

Written in the row-at-a-time SQL shape of the original models (self-joins,
``DISTINCT``/``row_number`` dedup, ``FILTER`` pivots) so that they check the
Spark plans (aggregate-based upsert, fan-out lags) independently.
"""

from __future__ import annotations

from collections.abc import Callable

from ampere.bindings import (DENSE_START, ENERGY_TYPES, EVENT_TYPES, EVENT_WEATHER_VARIABLE, EVENTS_CATALOG, REGION_ORDER,
                             RETIRED_CUT, REVISED_DAY, SLOTS_A_WEEK, VALUE_OFFSET)
from ampere.config import EASTER_HOLIDAYS, ENERGY, FIXED_HOLIDAYS, WEATHER_VARIABLES

CAT = EVENTS_CATALOG


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def inlist(xs) -> str:
    return ", ".join(q(x) for x in xs)


def rounded(sql: str, doubles=(), digits: int = 6, dates=()) -> str:
    """Wrap a query: listed double columns rounded, listed DATE columns as TIMESTAMP."""
    reps = [f'round(round("{c}", {digits + 3}), {digits}) AS "{c}"' for c in doubles]
    reps += [f'CAST("{c}" AS TIMESTAMP) AS "{c}"' for c in dates]
    if not reps:
        return sql
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM ({sql}) AS _q"


#: ``bindings.dense_events`` as a CTE that takes the place of the table ``events``.
DENSE_EVENTS = f"""events AS MATERIALIZED (
  WITH n AS (SELECT greatest(1, count(*) // {SLOTS_A_WEEK}) * {SLOTS_A_WEEK} AS slots FROM orders),
  e AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) % 1000 / 100.0 AS cents, o_orderkey % slots AS slot,
               o_orderkey // slots AS revision, unnest(generate_series(0, {4 * len(EVENT_TYPES) - 1})) AS k FROM orders, n),
  t AS (SELECT *, ([{inlist(EVENT_TYPES)}])[k // 4 + 1] AS event_type FROM e)
  SELECT o_orderkey * {4 * len(EVENT_TYPES)} + k AS event_id,
         TIMESTAMP '{DENSE_START}' + to_minutes(slot * 15) + to_seconds(revision) AS ts, k % 4 AS user_id, event_type,
         CASE event_type WHEN 'purchase' THEN 60 ELSE 75 END
         + CASE event_type WHEN 'purchase' THEN 30 ELSE 15 END * sin(2 * pi() * (slot % 96) / 96)
         + ((o_orderkey * 7919 + k * 31) % 1000 / 100.0 + cents) AS value
  FROM t WHERE NOT (event_type = 'error' AND slot % 97 = 5) AND NOT (event_type = 'click' AND (slot // 96) % 23 = 11))"""


def dense(sql: str) -> str:
    """A query over the dense binding."""
    return f"WITH {DENSE_EVENTS} SELECT * FROM ({sql}) AS _d"


def _over_dense(events: str, sql: str) -> str:
    inner = DENSE_EVENTS.replace("events AS MATERIALIZED", "dense AS MATERIALIZED", 1)
    return f"WITH {inner}, events AS MATERIALIZED ({events}) SELECT * FROM ({sql}) AS _d"


def revised(sql: str) -> str:
    """A query over the dense binding with the revised day."""
    return _over_dense(f"SELECT * REPLACE (value + CASE WHEN CAST(ts AS DATE) = DATE '{REVISED_DAY}' THEN 5.0 ELSE 0.0 END AS value) "
                       "FROM dense", sql)


def energy(sql: Callable[[], str]) -> str:
    """A query over the energy binding, its SQL built with the energy catalogue."""
    global CAT
    own, CAT = CAT, ENERGY
    try:
        text = sql()
    finally:
        CAT = own
    n = len(ENERGY_TYPES)
    return _over_dense(f"""SELECT event_id, ts, user_id, event_type, value FROM dense UNION ALL
  SELECT -1 - event_id * {n} - k AS event_id, ts, user_id, ([{inlist(ENERGY_TYPES)}])[k + 1] AS event_type,
         value + 30 + (event_id * (k + 3)) % 17 AS value
  FROM (SELECT *, unnest(generate_series(0, {n - 1})) AS k FROM dense WHERE event_type = 'purchase' AND user_id = 0)""", text)


def floor_expr(resolution: str, col: str = "ts") -> str:
    return f"date_trunc('hour', {col})" if resolution == "hour" else f"time_bucket(INTERVAL 15 MINUTE, {col})"


def region_expr() -> str:
    arr = "[" + inlist(REGION_ORDER) + "]"
    return f"({arr})[(user_id % 4) + 1]"


def variable_expr() -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in EVENT_WEATHER_VARIABLE.items())
    return f"CASE event_type {cases} END"


def unit_expr(col: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in WEATHER_VARIABLES.items())
    return f"CASE {col} {cases} END"


def latest(src: str, key: str, order: str = "fetched_at DESC, event_id DESC") -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY {order}) AS _rn FROM {src}) WHERE _rn = 1")


def signal_rows(resolution: str = "hour") -> str:
    return (f"SELECT {floor_expr(resolution)} AS timestamp, upper(event_type) AS signal, "
            f"value - {VALUE_OFFSET} AS value, 'MW' AS unit, {q(resolution)} AS resolution, "
            f"ts AS fetched_at, event_id FROM events")


def issue_expr(ts: str = "timestamp", sig: str = "signal") -> str:
    local_midnight = f"date_trunc('day', ({ts} AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin')"
    hour = f"CASE WHEN {sig} = 'ERROR_FC' THEN 10 ELSE 18 END"
    return (f"(({local_midnight} - to_hours(24 - {hour})) AT TIME ZONE 'Europe/Berlin') "
            f"AT TIME ZONE 'UTC'")


def forecast_rows(resolution: str = "hour") -> str:
    return (f"SELECT {floor_expr(resolution)} + INTERVAL 1 HOUR AS timestamp, "
            f"upper(event_type) || '_FC' AS signal, value - {VALUE_OFFSET} AS value, 'MW' AS unit, "
            f"{q(resolution)} AS resolution, ts AS fetched_at, event_id FROM events")


def weather_rows() -> str:
    return (f"SELECT date_trunc('hour', ts) AS timestamp, {region_expr()} AS region, "
            f"{variable_expr()} AS signal_type, value, ts AS fetched_at, event_id FROM events")


def weather_forecast_rows() -> str:
    return (f"SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS timestamp, "
            f"date_trunc('hour', ts) + INTERVAL 1 HOUR - INTERVAL 18 HOUR AS issue_timestamp, "
            f"{region_expr()} AS region, {variable_expr()} AS signal_type, value, "
            f"'icon_seamless' AS model, ts AS fetched_at FROM events")


def staging_ctes(resolution: str = "hour") -> str:
    """CTEs: sig, fc, wx, wxf (raw after upsert) and the staging views."""
    gen = list(CAT.generation_load)
    special = list(CAT.signed) + list(CAT.retired)
    retired_sig, retired_cut = next(iter(CAT.retired.items()))
    validity = (f"((signal NOT IN ({inlist(special)}) AND value >= 0) "
                f"OR (signal = {q(retired_sig)} AND timestamp <= TIMESTAMP {q(retired_cut)} AND value >= 0) "
                f"OR signal IN ({inlist(CAT.signed)}))")
    return f"""
sig_rows AS ({signal_rows(resolution)}),
sig AS ({latest('sig_rows', 'timestamp, signal, resolution')}),
fc_rows AS ({forecast_rows(resolution)}),
fc AS ({latest('fc_rows', 'timestamp, signal, resolution')}),
wx_rows AS ({weather_rows()}),
wx AS ({latest('wx_rows', 'timestamp, region, signal_type')}),
wxf AS ({weather_forecast_rows()}),
stg_gen AS (
  SELECT timestamp, signal AS signal_name, value, unit, resolution FROM (
    SELECT timestamp, signal, nullif(value, 'NaN'::DOUBLE) AS value, unit, resolution FROM sig
    WHERE signal IN ({inlist(gen)}))
  WHERE value IS NOT NULL AND {validity}),
stg_fc AS (
  SELECT timestamp, signal AS signal_name, value, resolution, fetched_at FROM (
    SELECT timestamp, signal, nullif(value, 'NaN'::DOUBLE) AS value, resolution, fetched_at FROM fc)
  WHERE value IS NOT NULL AND (signal IN ({inlist(CAT.forecast_signed)}) OR value >= 0)),
stg_prices AS (
  SELECT timestamp, signal AS signal_name, nullif(value, 'NaN'::DOUBLE) AS value, unit, resolution FROM sig
  WHERE signal = {q(CAT.home_price)} AND nullif(value, 'NaN'::DOUBLE) IS NOT NULL),
stg_nb AS (
  SELECT timestamp, signal AS signal_name, nullif(value, 'NaN'::DOUBLE) AS value, unit, resolution FROM sig
  WHERE signal IN ({inlist(CAT.neighbours)}) AND nullif(value, 'NaN'::DOUBLE) IS NOT NULL),
stg_wx AS (SELECT timestamp, region, signal_type AS signal_name, nullif(value, 'NaN'::DOUBLE) AS value FROM wx),
stg_wxf AS (SELECT timestamp, region, signal_type AS signal_name, nullif(value, 'NaN'::DOUBLE) AS value,
                   fetched_at FROM wxf)"""


def pivot_gen_sql(src: str = "stg_gen") -> str:
    cols = ",\n  ".join(f"max(value) FILTER (WHERE signal_name = {q(s)}) AS {c}"
                        for s, c in CAT.generation_load.items())
    return (f"SELECT timestamp, resolution,\n  {cols},\n  sum(value) FILTER (WHERE signal_name IN "
            f"({inlist(CAT.generation)})) AS total_generation_mw FROM {src} GROUP BY timestamp, resolution")


def pivot_fc_sql(src: str = "stg_fc") -> str:
    cols = ",\n  ".join(f"max(value) FILTER (WHERE signal_name = {q(s)}) AS {c}" for s, c in CAT.forecasts.items())
    return f"SELECT timestamp, resolution,\n  {cols} FROM {src} GROUP BY timestamp, resolution"


def spreads_sql() -> str:
    home = f"{CAT.home_price.lower()}_price_eur_mwh"
    parts = [f"max(p.value) AS {home}"]
    for s, a in CAT.neighbours.items():
        parts.append(f"max(np.value) FILTER (WHERE np.signal_name = {q(s)}) AS {a}_price_eur_mwh")
        parts.append(f"max(p.value - np.value) FILTER (WHERE np.signal_name = {q(s)}) AS {a}_spread_eur_mwh")
    return (f"SELECT np.timestamp, np.resolution, {', '.join(parts)} FROM stg_nb np JOIN stg_prices p "
            f"ON np.timestamp = p.timestamp AND np.resolution = p.resolution GROUP BY np.timestamp, np.resolution")


def pivot_weather_sql(src: str, suffix: str = "") -> str:
    cols = ",\n  ".join(f"max(value) FILTER (WHERE region = {q(r)} AND signal_name = {q(v)}) AS {n}"
                        for r, v, n in CAT.weather_columns(suffix))
    return f"SELECT timestamp,\n  {cols} FROM {src} GROUP BY timestamp"


def easter_sql(years: str) -> str:
    """Easter Sunday per year of the ``years(y)`` relation (anonymous Gregorian computus)."""
    return f"""SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS easter FROM (
  SELECT y, h, l, (a + 11 * h + 22 * l) // 451 AS m FROM (
    SELECT y, a, h, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM (
      SELECT y, a, e, i, k, (19 * a + b - d - g + 15) % 30 AS h FROM (
        SELECT y, y % 19 AS a, y // 100 AS b, (y // 100) // 4 AS d, (y // 100) % 4 AS e,
               ((y // 100) - ((y // 100) + 8) // 25 + 1) // 3 AS g, (y % 100) // 4 AS i, (y % 100) % 4 AS k
        FROM {years}))))"""


def holidays_sql(years: str) -> str:
    fixed = " UNION ALL ".join(f"SELECT make_date(y, {m}, {d}) AS date, {q(n)} AS holiday_name FROM {years}"
                               for m, d, n in FIXED_HOLIDAYS)
    movable = " UNION ALL ".join(f"SELECT CAST(easter + INTERVAL ({o}) DAY AS DATE) AS date, {q(n)} AS holiday_name "
                                 f"FROM easter_days" for o, n in EASTER_HOLIDAYS)
    return f"easter_days AS ({easter_sql(years)}),\nholidays AS ({fixed} UNION ALL {movable})"


def calendar_select(day: str) -> str:
    """Calendar columns of a DATE expression ``day`` joined with ``holidays h``."""
    return (f"year({day}) AS year, quarter({day}) AS quarter, month({day}) AS month, "
            f"weekofyear({day}) AS week_of_year, isodow({day}) - 1 AS day_of_week, "
            f"isodow({day}) >= 6 AS is_weekend, "
            f"CASE WHEN month({day}) IN (12, 1, 2) THEN 'winter' WHEN month({day}) IN (3, 4, 5) THEN 'spring' "
            f"WHEN month({day}) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season, "
            f"h.date IS NOT NULL AS is_german_public_holiday, h.holiday_name, "
            f"NOT (isodow({day}) >= 6) AND h.date IS NULL AS is_workday")


def ml_features_ctes(resolution: str = "hour") -> str:
    """CTEs through ``ml`` (= fct_ml_features)."""
    omit = [CAT.generation_load[s] for s in CAT.retired]
    g_cols = [c for c in CAT.generation_load.values() if c not in omit] + ["total_generation_mw"]
    gf_cols = list(CAT.forecasts.values())
    ps_cols = [f"{CAT.home_price.lower()}_price_eur_mwh"] + [
        f"{a}_{k}_eur_mwh" for a in CAT.neighbours.values() for k in ("price", "spread")]
    w_cols = [n for _, _, n in CAT.weather_columns()]
    wf_cols = [n for _, _, n in CAT.weather_columns("_forecast")]
    sel = ", ".join([f"g.{c}" for c in g_cols] + [f"gf.{c}" for c in gf_cols] + [f"ps.{c}" for c in ps_cols]
                    + [f"w.{c}" for c in w_cols] + [f"wf.{c}" for c in wf_cols])
    return f"""{staging_ctes(resolution)},
g AS ({pivot_gen_sql()}),
gf AS ({pivot_fc_sql()}),
ps AS ({spreads_sql()}),
w AS ({pivot_weather_sql('stg_wx')}),
wf AS ({pivot_weather_sql('stg_wxf', '_forecast')}),
yrs AS (SELECT DISTINCT CAST(year(CAST(timestamp AS DATE)) AS BIGINT) AS y FROM stg_prices),
{holidays_sql('yrs')},
ml AS (
  SELECT mp.timestamp, mp.resolution, mp.value AS price_eur_mwh, {sel},
         CAST(mp.timestamp AS DATE) AS date_day, {calendar_select('CAST(mp.timestamp AS DATE)')}
  FROM stg_prices mp
  LEFT JOIN g ON mp.timestamp = g.timestamp AND mp.resolution = g.resolution
  LEFT JOIN gf ON mp.timestamp = gf.timestamp AND mp.resolution = gf.resolution
  LEFT JOIN ps ON mp.timestamp = ps.timestamp AND mp.resolution = ps.resolution
  LEFT JOIN w ON mp.timestamp = w.timestamp
  LEFT JOIN wf ON mp.timestamp = wf.timestamp
  LEFT JOIN holidays h ON CAST(mp.timestamp AS DATE) = h.date)"""


LOCAL = "((t.timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin')"


def contract_sql(spec) -> str:
    """I12/I13 in the SQL shape: one self left join per lag offset."""
    lag_hours = sorted(set(spec.price_lags) | ({24, 48, 72, 96, 120, 144, 168} if spec.same_hour_avg else set())
                       | {24, 48})
    local = "((timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin')"
    qoh = f", CAST(minute({local}) // 15 AS BIGINT) AS quarter_of_hour" if spec.quarter_of_hour else ""
    base = (f"SELECT ml.*, {local} AS local_timestamp, CAST({local} AS DATE) AS delivery_date, "
            f"row_number() OVER (PARTITION BY CAST({local} AS DATE) ORDER BY timestamp) AS horizon{qoh} "
            f"FROM ml WHERE resolution = {q(spec.resolution)}")
    sel, doubles = ["t.timestamp", "t.resolution", "t.delivery_date", "t.local_timestamp", "t.horizon"], []
    if spec.quarter_of_hour:
        sel.append("t.quarter_of_hour")
    sel.append(f"t.{spec.price}")
    doubles.append(spec.price)
    sel += [f"t.{c}" for c in ("year", "quarter", "month", "week_of_year", "day_of_week", "is_weekend",
                               "is_german_public_holiday", "is_workday")]

    def add(expr, name):
        sel.append(f"{expr} AS {name}")
        doubles.append(name)
    for h in spec.price_lags:
        add(f"p{h}.{spec.price}", f"price{spec.suffix(h)}")
    if spec.same_hour_avg:
        add("(" + " + ".join(f"p{h}.{spec.price}" for h in (24, 48, 72, 96, 120, 144, 168)) + ") / 7.0",
            "price_rolling_avg_7d_same_hour")
    for c, b in spec.neighbour_prices.items():
        add(f"p24.{c}", f"{b}_price{spec.suffix(24)}")
    for fc, _act, _b, is_dir in spec.weather:
        if is_dir:
            add(f"sin(radians(t.{fc}))", f"{fc}_sin")
            add(f"cos(radians(t.{fc}))", f"{fc}_cos")
        else:
            add(f"t.{fc}", fc)
    for c, b in spec.load_lags.items():
        add(f"p48.{c}", f"{b}{spec.suffix(48)}")
    if spec.consumption:
        fc, act, name = spec.consumption
        add(f"t.{fc}", fc)
        add(f"p48.{fc} - p48.{act}", f"{name}{spec.suffix(48)}")
    for c in spec.forecast_lags:
        add(f"p24.{c}", f"{c}{spec.suffix(24)}")
    for fc, act, b, is_dir in spec.weather:
        if is_dir:
            add(f"sin(radians(p48.{fc} - p48.{act}))", f"{b}_error_sin{spec.suffix(48)}")
            add(f"cos(radians(p48.{fc} - p48.{act}))", f"{b}_error_cos{spec.suffix(48)}")
        else:
            add(f"p48.{fc} - p48.{act}", f"{b}_error{spec.suffix(48)}")
    joins = "\n".join(f"LEFT JOIN base p{h} ON p{h}.timestamp = t.timestamp - INTERVAL {h} HOUR" for h in lag_hours)
    sql = (f"WITH {ml_features_ctes(spec.resolution)},\nbase AS ({base})\n"
           f"SELECT {', '.join(sel)}\nFROM base t\n{joins}")
    return rounded(sql, doubles, dates=["delivery_date"])
