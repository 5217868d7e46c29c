"""DuckDB SQL for every registered query (the correctness oracle).

Each query is written independently of the Spark code, from the operator's
definition, on top of the fixture CTEs of :mod:`oracle_fixtures`.
"""

from __future__ import annotations

from .oracle_fixtures import with_fixtures

H = "cast(3600000 AS double)"


def _sec(types: list[str], with_km: bool) -> str:
    type_list = ", ".join(f"'{t}'" for t in types)
    km = (",\n   coalesce(cast(floor(max(CASE WHEN stype = 'drivingMileage' THEN value END) / 100) * 100 AS int), 0) AS km"
          ",\n   count(CASE WHEN stype = 'drivingMileage' THEN 1 END) > 0 AS has_odo"
          if with_km else "")
    return f"""sec AS (
  SELECT vin, cast(floor(epoch_us(ts) / 1000000) AS bigint) AS sec, cast(ts AS date) AS day,
   coalesce(sum(CASE WHEN stype = 'drivingSpeed' THEN value END), 0) AS speed,
   coalesce(sum(CASE WHEN stype = 'rotationlSpeed' THEN value END), 0) AS rpm,
   coalesce(sum(CASE WHEN stype = 'InsFuelInjection' THEN value END), 0) AS fuel,
   count(CASE WHEN stype = 'airConditioningState' AND value <> 0 THEN 1 END) AS aircon_on_votes{km}
  FROM signals WHERE stype IN ({type_list})
  GROUP BY 1, 2, 3)"""


DAY_TYPES = ["drivingSpeed", "rotationlSpeed", "InsFuelInjection", "airConditioningState"]
KM_TYPES = DAY_TYPES + ["drivingMileage"]
SEC_DAY = _sec(DAY_TYPES, False)
SEC_KM = _sec(KM_TYPES, True)

RATE = f"""inst AS (
  SELECT vin, ts,
   sum(CASE WHEN stype = 'airConditioningState' THEN (CASE WHEN value = 0 THEN -1 ELSE 1 END) ELSE 0 END) AS votes,
   coalesce(sum(CASE WHEN stype = 'InsFuelInjection' THEN value END), 0) AS fuel,
   count(CASE WHEN stype = 'InsFuelInjection' THEN 1 END) * 100 AS dur_ms
  FROM signals WHERE stype IN ('InsFuelInjection', 'airConditioningState') GROUP BY vin, ts),
tot AS (
  SELECT cast(sum(CASE WHEN votes >= 0 THEN dur_ms END) AS bigint) AS on_ms,
         cast(sum(CASE WHEN votes < 0 THEN dur_ms END) AS bigint) AS off_ms,
         sum(CASE WHEN votes >= 0 THEN fuel END) AS on_fuel,
         sum(CASE WHEN votes < 0 THEN fuel END) AS off_fuel
  FROM inst),
rate AS (
  SELECT on_ms, off_ms, on_fuel, off_fuel,
    ((on_fuel / nullif(on_ms / {H}, 0)) - (off_fuel / nullif(off_ms / {H}, 0))) * (on_ms / {H})
      / nullif(on_fuel + off_fuel, 0) AS rate
  FROM tot)"""

DAY_STATE = {"idle": "speed = 0 AND rpm > 0", "driving": "speed > 0 AND rpm > 0"}


def _fuel_day(state: str, code: str) -> str:
    return (f"SELECT vin, day AS now_date, '{code}' AS data_key, cast(sum(fuel) AS double) AS data_value "
            f"FROM sec WHERE {DAY_STATE[state]} GROUP BY vin, day")


def _fuel_km(state: str, code: str) -> str:
    return (f"SELECT vin, km AS mileage, '{code}' AS data_key, cast(sum(fuel) AS double) AS data_value "
            f"FROM sec WHERE {DAY_STATE[state]} GROUP BY vin, km")


AIRCON_DAY = ("SELECT vin, day AS now_date, 'D004' AS data_key, sum(fuel) * (SELECT rate FROM rate) AS data_value "
              "FROM sec WHERE aircon_on_votes > 0 GROUP BY vin, day")
AIRCON_KM = ("SELECT vin, km AS mileage, 'KM004' AS data_key, cast(sum(fuel) AS double) AS data_value "
             "FROM sec WHERE aircon_on_votes > 0 GROUP BY vin, km")

TOTAL_DAY_CTE = """tenth AS (
  SELECT vin, cast(floor(epoch_us(ts) / 100000) AS bigint) AS tenth, cast(ts AS date) AS day, max(value) AS v
  FROM signals WHERE stype = 'InsFuelInjection' GROUP BY 1, 2, 3)"""
TOTAL_DAY = "SELECT vin, day AS now_date, 'D001' AS data_key, sum(v) AS data_value FROM tenth GROUP BY vin, day"

MILEAGE_DAY = ("SELECT vin, cast(ts AS date) AS now_date, 'D006' AS data_key, max(value) - min(value) AS data_value "
               "FROM signals WHERE stype = 'drivingMileage' GROUP BY vin, cast(ts AS date)")

RESTART = """done AS (SELECT vin, max(per100) AS per100 FROM km_checkpoint WHERE stype = 'InsFuelInjection' GROUP BY vin),
reach AS (SELECT vin, floor(value / 100) AS bucket, min(ts) AS reach_ts FROM signals
          WHERE stype = 'drivingMileage' GROUP BY 1, 2),
restart AS (SELECT reach.vin, min(reach_ts) AS restart_ts FROM reach LEFT JOIN done ON reach.vin = done.vin
            WHERE bucket >= coalesce(done.per100, 0) GROUP BY reach.vin)"""


def _km_total(with_checkpoint: bool) -> str:
    src = ("SELECT sig.* FROM sig JOIN restart ON sig.vin = restart.vin WHERE sig.ts >= restart.restart_ts"
           if with_checkpoint else "SELECT * FROM sig")
    restart = RESTART + ",\n" if with_checkpoint else ""
    return f"""sig AS (SELECT * FROM signals WHERE stype IN ('InsFuelInjection', 'drivingMileage')),
{restart}kin AS ({src}),
tagged AS (
  SELECT vin, ts, stype, value,
    cast(floor(max(CASE WHEN stype = 'drivingMileage' THEN value END)
      OVER (PARTITION BY vin ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / 100) * 100 AS int) AS km
  FROM kin),
kagg AS (SELECT vin, km, sum(value * 100) AS v FROM tagged
         WHERE stype = 'InsFuelInjection' AND km IS NOT NULL GROUP BY vin, km),
newest AS (SELECT vin, cast(floor(max(value) / 100) * 100 AS int) AS newest_km FROM kin
           WHERE stype = 'drivingMileage' GROUP BY vin),
km_total AS (SELECT kagg.vin, kagg.km AS mileage, 'KM001' AS data_key, kagg.v AS data_value
             FROM kagg JOIN newest ON kagg.vin = newest.vin WHERE kagg.km < newest.newest_km)"""


NEW_FILLS = """nf AS (
  SELECT f.vin, f.fill_start_time, f.gas_id, f.fill_grade, f.price
  FROM fills f LEFT JOIN (SELECT vin, max(fill_ts) AS m FROM processed_fills GROUP BY vin) p ON f.vin = p.vin
  WHERE f.fill_start_time > coalesce(p.m, timestamp '1753-01-01 00:00:00'))"""
INTERVALS = NEW_FILLS + """,
ivall AS (SELECT vin, gas_id, fill_grade, price, fill_start_time AS start_ts,
          lead(fill_start_time) OVER (PARTITION BY vin ORDER BY fill_start_time, gas_id) AS end_ts FROM nf),
iv AS (SELECT * FROM ivall WHERE end_ts IS NOT NULL)"""


def _rows(types: list[str]) -> str:
    type_list = ", ".join(f"'{t}'" for t in types)
    return INTERVALS + f""",
irows AS (
  SELECT s.vin, s.ts, s.stype, s.value, iv.gas_id, iv.fill_grade, iv.start_ts, iv.price
  FROM signals s JOIN iv ON s.vin = iv.vin AND s.ts >= iv.start_ts AND s.ts < iv.end_ts
  WHERE s.stype IN ({type_list}))"""


COST_CTE = _rows(["InsFuelInjection", "drivingMileage"]) + """,
cagg AS (
  SELECT vin, gas_id, fill_grade, start_ts, price,
    sum(CASE WHEN stype = 'InsFuelInjection' THEN value * 100 END) AS fuel,
    max(CASE WHEN stype = 'drivingMileage' THEN value END) - min(CASE WHEN stype = 'drivingMileage' THEN value END) AS km
  FROM irows GROUP BY 1, 2, 3, 4, 5),
cost AS (
  SELECT vin, gas_id, fill_grade, start_ts AS fill_date, 'FF003' AS data_key,
         (fuel / nullif(km, 0)) * price AS data_value
  FROM cagg WHERE fuel IS NOT NULL AND km IS NOT NULL)"""

KPI_DAY_CTE = f"""{SEC_DAY},
{RATE},
{TOTAL_DAY_CTE},
kd AS (
  {TOTAL_DAY}
  UNION ALL {_fuel_day('idle', 'D002')}
  UNION ALL {_fuel_day('driving', 'D003')}
  UNION ALL {AIRCON_DAY}
  UNION ALL {MILEAGE_DAY})"""

KPI_KM_CTE = f"""{SEC_KM},
{_km_total(False)},
kk AS (
  SELECT * FROM km_total
  UNION ALL {_fuel_km('idle', 'KM002')}
  UNION ALL {_fuel_km('driving', 'KM003')}
  UNION ALL {AIRCON_KM})"""


def _other(src: str, key: str, codes: list[str], out: str, scale: int = 1) -> str:
    a, b, c, d = codes
    return f"""piv AS (
  SELECT vin, {key},
    sum(CASE WHEN data_key = '{a}' THEN data_value END) AS a,
    sum(CASE WHEN data_key = '{b}' THEN data_value END) AS b,
    sum(CASE WHEN data_key = '{c}' THEN data_value END) AS c,
    sum(CASE WHEN data_key = '{d}' THEN data_value END) AS d
  FROM {src} WHERE data_key IN ('{a}', '{b}', '{c}', '{d}') GROUP BY vin, {key})
SELECT vin, {key}, '{out}' AS data_key, a / {scale} - b - c - d AS data_value FROM piv
WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND d IS NOT NULL"""


def _window_sql(width: int, slide: int, unit_s: int = 3600) -> str:
    n = width // slide
    slide_us = slide * unit_s * 1_000_000
    return f"""lv AS (SELECT vin, ts, value FROM signals WHERE stype = 'fuelLevel'),
lw AS (
  SELECT vin, value,
    timestamp '1970-01-01 00:00:00'
      + to_microseconds(cast((floor(epoch_us(ts) / {slide_us}) - k) * {slide_us} AS bigint)) AS window_start
  FROM lv, range(0, {n}) t(k))"""


ENVELOPE_ROWS = """ex AS (
  SELECT s.vin, s.ts, s.stype, s.value,
    date_trunc('millisecond', s.ts + to_seconds(CASE WHEN e.et = 'click' THEN -1 ELSE 1 END)) AS send_ts
  FROM signals s JOIN ev e ON s.vin = e.vin AND s.ts = e.ts)"""


def _refuel(steps: bool, source: str = "FROM signals s") -> str:
    """Recursive walk over each vehicle's ordered tank levels (the T8 rule)."""
    if steps:
        src = """lvs AS (
  SELECT vin, max(ts) AS ts, arg_max(value, ts) AS value
  FROM signals WHERE stype = 'fuelLevel' GROUP BY vin, floor(epoch_us(ts) / 5000000)),
lvn AS (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY ts) AS rn,
               count(*) OVER (PARTITION BY vin) AS cnt FROM lvs),
lv AS (SELECT vin, ts, value, rn FROM lvn WHERE rn < cnt)"""
    else:
        src = f"""lv AS (SELECT vin, ts, value, row_number() OVER (PARTITION BY vin ORDER BY ts) AS rn
       {source} WHERE stype = 'fuelLevel')"""
    return src + """,
st(vin, rn, n, f, f_t, l3, l2, l, l_t, ev) AS (
  SELECT vin, rn, 1, value, ts, cast(NULL AS double), cast(NULL AS double), value, ts, false FROM lv WHERE rn = 1
  UNION ALL
  SELECT vin, rn, n0 + 1, f1, f_t1, l2_old, l_old, x, ts,
         (n0 + 1 > 4 AND x - f1 > 10 AND abs(x - l_old) < 1 AND abs(l_old - l2_old) < 1)
  FROM (
    SELECT vin, rn, x, ts, l_old, l2_old, n0,
           CASE WHEN n0 = 0 THEN x ELSE f_old END AS f1,
           CASE WHEN n0 = 0 THEN ts ELSE f_t_old END AS f_t1
    FROM (
      SELECT lv.vin, lv.rn, lv.value AS x, lv.ts, st.l AS l_old, st.l2 AS l2_old, st.f AS f_old, st.f_t AS f_t_old,
             CASE WHEN st.ev THEN 0
                  WHEN st.n > 0 AND lv.value < st.l AND lv.value < st.f THEN 0
                  ELSE st.n END AS n0
      FROM st JOIN lv ON lv.vin = st.vin AND lv.rn = st.rn + 1) a) b)
SELECT vin, l3 AS fuel_mass, l3 - f AS fill_amount, f_t AS fill_start_time, l_t AS fill_end_time,
       cast(0 AS double) AS gps_latitude, cast(0 AS double) AS gps_longitude
FROM st WHERE ev"""


SQL: dict[str, str] = {
    "signals_from_events": "SELECT vin, ts, stype, value FROM signals",
    "fill_records": "SELECT vin, fill_start_time, gas_id, fill_grade, price FROM fills",
    "processed_fills": "SELECT vin, fill_ts FROM processed_fills",
    "km_checkpoint": "SELECT vin, stype, per100 FROM km_checkpoint",
    "idle_fuel_day": f"{SEC_DAY}\n{_fuel_day('idle', 'D002')}",
    "idle_fuel_km": f"{SEC_KM}\n{_fuel_km('idle', 'KM002')}",
    "driving_fuel_day": f"{SEC_DAY}\n{_fuel_day('driving', 'D003')}",
    "driving_fuel_km": f"{SEC_KM}\n{_fuel_km('driving', 'KM003')}",
    "driving_fuel_km_asof": SEC_KM + """,
sec_asof AS (
  SELECT vin, sec, day, speed, rpm, fuel,
    coalesce(max(odo_km) OVER (PARTITION BY vin ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS km
  FROM (SELECT *, CASE WHEN has_odo THEN km END AS odo_km FROM sec))
SELECT vin, km AS mileage, 'KM003' AS data_key, cast(sum(fuel) AS double) AS data_value
FROM sec_asof WHERE speed > 0 AND rpm > 0 GROUP BY vin, km""",
    "aircon_rate": f"{RATE}\nSELECT on_ms, off_ms, on_fuel, off_fuel, rate FROM rate",
    "aircon_fuel_day": f"{SEC_DAY},\n{RATE}\n{AIRCON_DAY}",
    "aircon_fuel_km": f"{SEC_KM}\n{AIRCON_KM}",
    "total_fuel_day": f"{TOTAL_DAY_CTE}\n{TOTAL_DAY}",
    "mileage_day": MILEAGE_DAY,
    "total_fuel_km": f"{_km_total(True)}\nSELECT * FROM km_total",
    "total_fuel_km_full": f"{_km_total(False)}\nSELECT * FROM km_total",
    "daily_kpis": f"{KPI_DAY_CTE}\nSELECT * FROM kd",
    "km_kpis": f"{KPI_KM_CTE}\nSELECT * FROM kk",
    "other_fuel_day": f"{KPI_DAY_CTE},\n" + _other("kd", "now_date", ["D001", "D002", "D003", "D004"], "D005"),
    "other_fuel_km": f"{KPI_KM_CTE},\n" + _other("kk", "mileage", ["KM001", "KM002", "KM003", "KM004"], "KM005", 100),
    "lifetime_totals": f"""{KPI_DAY_CTE}
SELECT vin, CASE data_key WHEN 'D006' THEN 'C001' WHEN 'D001' THEN 'C002' WHEN 'D003' THEN 'C003'
                          WHEN 'D002' THEN 'C004' WHEN 'D004' THEN 'C005' END AS attribute_type,
       cast(sum(cast(data_value AS DECIMAL(38, 12))) AS double) AS attribute_value
FROM kd WHERE data_key IN ('D006', 'D001', 'D003', 'D002', 'D004') GROUP BY 1, 2""",
    "avg_fuel_per_100km": f"""{_km_total(False)}
SELECT vin, 'C006' AS attribute_type,
       cast(sum(cast(data_value AS DECIMAL(38, 12))) AS double) / count(data_value) AS attribute_value
FROM km_total GROUP BY vin""",
    "after_checkpoint": f"""{RESTART}
SELECT s.vin, s.ts, s.stype, s.value FROM signals s JOIN restart r ON s.vin = r.vin WHERE s.ts >= r.restart_ts""",
    "last_bucket": """SELECT vin, stype, max(per100) AS per100, cast(max(per100) * 100 AS int) AS km
FROM km_checkpoint WHERE stype = 'InsFuelInjection' GROUP BY vin, stype""",
    "new_fills": f"{NEW_FILLS}\nSELECT * FROM nf",
    "fill_intervals": f"{INTERVALS}\nSELECT vin, gas_id, fill_grade, price, start_ts, end_ts FROM iv",
    "fuel_prices": "SELECT vin, gas_id, fill_start_time, fill_grade, price FROM fills",
    "assign_fill_interval": f"{_rows(['InsFuelInjection'])}\nSELECT * FROM irows",
    "assign_fill_interval_asof": f"{_rows(['InsFuelInjection'])}\nSELECT * FROM irows",
    "cost_per_km": f"{COST_CTE}\nSELECT * FROM cost",
    "economy_ranking": f"""{COST_CTE}
SELECT vin, gas_id, fill_grade, fill_date, data_value AS cost_per_km,
       rank() OVER (PARTITION BY fill_grade ORDER BY data_value) AS rank
FROM cost WHERE data_value IS NOT NULL""",
    "average_speed": _rows(["drivingMileage", "rotationlSpeed"]) + f""",
sagg AS (
  SELECT vin, gas_id, fill_grade, start_ts, price,
    max(CASE WHEN stype = 'drivingMileage' THEN value END) - min(CASE WHEN stype = 'drivingMileage' THEN value END) AS km,
    count(CASE WHEN stype = 'rotationlSpeed' AND value > 0 THEN 1 END) AS n_on
  FROM irows GROUP BY 1, 2, 3, 4, 5)
SELECT vin, gas_id, fill_grade, start_ts AS fill_date, 'FF001' AS data_key,
       km / nullif(n_on * 10 / {H}, 0) AS data_value
FROM sagg WHERE km IS NOT NULL AND n_on > 0""",
    "fill_kpis": _rows(["InsFuelInjection", "drivingMileage", "rotationlSpeed", "fuelSupplyC-1"]) + f""",
fagg AS (
  SELECT vin, gas_id, fill_grade, start_ts, price,
    sum(CASE WHEN stype = 'InsFuelInjection' THEN value * 100 END) AS fuel,
    max(CASE WHEN stype = 'drivingMileage' THEN value END) - min(CASE WHEN stype = 'drivingMileage' THEN value END) AS km,
    count(CASE WHEN stype = 'rotationlSpeed' AND value > 0 THEN 1 END) AS n_on,
    count(CASE WHEN stype = 'fuelSupplyC-1' THEN 1 END) AS n_sup,
    avg(CASE WHEN stype = 'fuelSupplyC-1' THEN cast(1 AS double) / nullif(value, 0) END) AS heat
  FROM irows GROUP BY 1, 2, 3, 4, 5)
SELECT vin, gas_id, fill_grade, start_ts AS fill_date, 'FF001' AS data_key, km / nullif(n_on * 10 / {H}, 0) AS data_value
FROM fagg WHERE km IS NOT NULL AND n_on > 0
UNION ALL
SELECT vin, gas_id, fill_grade, start_ts, 'FF002', heat FROM fagg WHERE n_sup > 0
UNION ALL
SELECT vin, gas_id, fill_grade, start_ts, 'FF003', (fuel / nullif(km, 0)) * price FROM fagg
WHERE fuel IS NOT NULL AND km IS NOT NULL""",
    "fuel_heating": _rows(["fuelSupplyC-1"]) + """
SELECT vin, gas_id, fill_grade, start_ts AS fill_date, 'FF002' AS data_key,
       avg(cast(1 AS double) / nullif(value, 0)) AS data_value
FROM irows GROUP BY vin, gas_id, fill_grade, start_ts, price""",
    "low_fuel_windows": _window_sql(6, 2) + """
SELECT vin, window_start, window_start + INTERVAL 6 HOUR AS window_end, avg(value) AS avg_level
FROM lw GROUP BY vin, window_start HAVING avg(value) < 20""",
    "fuel_summary": """SELECT vin, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
  avg(CASE WHEN stype = 'fuelLevel' THEN value END) AS mean_level,
  arg_max(value, ts) FILTER (WHERE stype = 'fuelLevel') AS last_level,
  sum(CASE WHEN stype = 'drivingSpeed' THEN (CASE WHEN value > 0 THEN 1 ELSE -1 END) ELSE 0 END) > 0 AS is_drive
FROM signals WHERE stype IN ('fuelLevel', 'drivingSpeed') GROUP BY vin, date_trunc('day', ts)""",
    "refuel_events": _refuel(False),
    "refuel_events_steps": _refuel(True),
    "explode_envelopes": f"{ENVELOPE_ROWS}\nSELECT * FROM ex",
    "drop_future_readings": f"{ENVELOPE_ROWS}\nSELECT * FROM ex WHERE send_ts > ts",
    "date_functions": """SELECT event_id, cast(year(ts) AS int) AS year, cast(month(ts) AS int) AS month,
  cast(day(ts) AS int) AS day, strftime(ts, '%Y-%m-%d') AS date_string, cast(floor(epoch_us(ts) / 1000) AS bigint) AS epoch_ms,
  strftime(ts, '%Y-%m-%d') AS date_of_parts, ts AS parsed_iso, date_trunc('millisecond', ts) AS parsed_compact
FROM events""",
    "sql_functions": """SELECT event_id, cast(year(ts) AS int) AS y, cast(month(ts) AS int) AS m, cast(day(ts) AS int) AS d,
  strftime(ts, '%Y-%m-%d') AS date_string, strftime(ts, '%Y-%m-%d') AS rebuilt, date_trunc('second', ts) AS parsed
FROM events""",
    "read_range": """SELECT vin, bucket_ts, max(event_id) AS version, arg_max(value, event_id) AS value
FROM (SELECT concat('VIN', lpad(cast(user_id AS varchar), 5, '0')) AS vin, date_trunc('hour', ts) AS bucket_ts,
             event_id, value FROM events) t
WHERE bucket_ts >= timestamp '2024-01-05' AND bucket_ts < timestamp '2024-01-25'
GROUP BY vin, bucket_ts""",
    "write_by_date_roundtrip": "SELECT vin, ts, stype, value FROM signals",
    "etl_clean_zone": f"{ENVELOPE_ROWS}\nSELECT vin, ts, stype, value FROM ex WHERE send_ts > ts",
    "kpi_sink_roundtrip": f"{KPI_DAY_CTE}\nSELECT * FROM kd",
    "json_lines": f"""{TOTAL_DAY_CTE},
t AS ({TOTAL_DAY})
SELECT CAST(to_json(struct_pack(vin := vin, now_date := now_date, data_key := data_key, data_value := data_value))
            AS VARCHAR) AS value
FROM t""",
}




def _ranged(body: str, start: str, end: str) -> str:
    """``body`` over the signals of a range."""
    cte = f"rsig AS (SELECT * FROM signals WHERE ts >= timestamp '{start}' AND ts < timestamp '{end}'),\n"
    return cte + body.replace("FROM signals", "FROM rsig")


def _aircon_state(cond: str) -> str:
    return (f"{SEC_DAY}\nSELECT vin, day AS now_date, 'D004' AS data_key, cast(sum(fuel) AS double) AS data_value "
            f"FROM sec WHERE {cond} GROUP BY vin, day")


def _km_resumed() -> str:
    """KM001-KM005 of the buckets completed after the checkpoint, all by the as-of bucket."""
    types = ", ".join(f"'{t}'" for t in KM_TYPES)
    codes = [("KM002", "speed = 0 AND rpm > 0"), ("KM003", "speed > 0 AND rpm > 0"), ("KM004", "aircon_on_votes > 0")]
    parts = "".join(f"\n  UNION ALL SELECT vin, km, '{c}', cast(sum(fuel) AS double) FROM sec_asof WHERE {w} GROUP BY vin, km" for c, w in codes)
    sec = _sec(KM_TYPES, True).replace("FROM signals", "FROM kin")
    last = "(PARTITION BY vin ORDER BY {} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""{RESTART},
kin AS (SELECT s.* FROM signals s JOIN restart r ON s.vin = r.vin WHERE s.ts >= r.restart_ts AND s.stype IN ({types})),
{sec},
sec_asof AS (
  SELECT *, coalesce(max(odo) OVER {last.format('sec')}, 0) AS kmx FROM (SELECT *, CASE WHEN has_odo THEN km END AS odo FROM sec)),
tagged AS (
  SELECT vin, stype, value, cast(floor(max(CASE WHEN stype = 'drivingMileage' THEN value END) OVER {last.format('ts')} / 100) * 100 AS int) AS km FROM kin),
newest AS (SELECT vin, cast(floor(max(value) / 100) * 100 AS int) AS newest_km FROM kin WHERE stype = 'drivingMileage' GROUP BY vin),
raw_facts AS (
  SELECT vin, km AS mileage, 'KM001' AS data_key, sum(value * 100) AS data_value FROM tagged
  WHERE stype = 'InsFuelInjection' AND km IS NOT NULL GROUP BY vin, km{parts.replace('km,', 'kmx,').replace('vin, km ', 'vin, kmx ').replace('BY vin, km', 'BY vin, kmx')}),
kr AS (SELECT f.* FROM raw_facts f JOIN newest n ON f.vin = n.vin LEFT JOIN done d ON f.vin = d.vin
       WHERE f.mileage < n.newest_km AND f.mileage >= coalesce(d.per100, 0) * 100)"""


SQL |= {
    "km_sink_roundtrip": SQL["km_kpis"],
    "fill_sink_roundtrip": SQL["fill_kpis"],
    "attr_sink_roundtrip": SQL["lifetime_totals"],
    "read_json_signals": "SELECT vin, ts, stype, value FROM signals",
    "etl_corrupt_rows": """d AS (
  SELECT CASE WHEN event_id % 17 <> 0 THEN concat('VIN', lpad(cast(user_id AS varchar), 5, '0')) END AS vin,
    CASE WHEN event_id % 7 = 0 THEN 'payload' WHEN event_id % 17 = 0 THEN 'vin' WHEN event_id % 5 = 0 THEN 'send_time'
         WHEN event_id % 11 = 0 THEN 'time' WHEN event_id % 13 = 0 THEN 'value' ELSE 'clean' END AS reason
  FROM events)
SELECT vin, reason, count(*) AS n FROM d GROUP BY vin, reason""",
    "read_range_default_keys": """SELECT vin, ts, max(event_id) AS version, arg_max(value, event_id) AS value
FROM (SELECT concat('VIN', lpad(cast(user_id AS varchar), 5, '0')) AS vin, date_trunc('day', ts)::timestamp AS ts, event_id, value FROM events) t
WHERE ts >= timestamp '2024-01-05' AND ts < timestamp '2024-01-25' GROUP BY vin, ts""",
    "signals_range": "SELECT vin, ts, stype, value FROM signals WHERE ts >= timestamp '2024-01-05' AND ts < timestamp '2024-01-15'",
    "daily_kpis_range": _ranged(f"{KPI_DAY_CTE}\nSELECT * FROM kd", "2024-01-05", "2024-01-15"),
    "aircon_fuel_day_off": _aircon_state("aircon_on_votes = 0"),
    "aircon_fuel_day_all": _aircon_state("true"),
    "total_fuel_km_open": f"{_km_total(False)}\nSELECT vin, km AS mileage, 'KM001' AS data_key, v AS data_value FROM kagg",
    "km_job_rerun": f"{_km_resumed()},\n" + _other("kr", "mileage", ["KM001", "KM002", "KM003", "KM004"], "KM005", 100)
    + "\nUNION ALL SELECT vin, mileage, data_key, data_value FROM kr",
    "fill_job_rerun": SQL["fill_kpis"],
    "schema_fields": """dl AS (SELECT minute(ts) AS m, minute(ts) % 10 AS d, value FROM signals WHERE stype = 'fuelLevel' AND minute(ts) % 10 <> 0)
SELECT 'vin' AS key, 'string' AS type, count(*) AS n FROM dl HAVING count(*) > 0
UNION ALL SELECT 'minute', 'whole', count(*) FROM dl HAVING count(*) > 0
UNION ALL SELECT 'even', 'boolean', count(*) FROM dl HAVING count(*) > 0
UNION ALL SELECT 'level', CASE d WHEN 1 THEN 'numeric_string' WHEN 2 THEN 'string' WHEN 3 THEN 'null' ELSE 'number' END, count(*)
  FROM dl WHERE d <> 4 GROUP BY 2""",
    "schema_typed": """SELECT vin, cast(minute(ts) AS bigint) AS minute, minute(ts) % 2 = 0 AS even,
  CASE WHEN minute(ts) % 10 NOT IN (2, 3, 4) THEN value END AS level, cast(minute(ts) % 10 = 2 AS int) AS drifted
FROM signals WHERE stype = 'fuelLevel' AND minute(ts) % 10 <> 0""",
    "sql_parameters": """SELECT vin, count(*) AS n, max(ts) AS newest, max(value) AS highest FROM signals
WHERE stype = 'drivingSpeed' AND ts >= timestamp '2024-01-10' AND value >= 20 GROUP BY vin""",
    "fill_commit_job": SQL["fill_kpis"],
    "lifetime_incremental": SQL["lifetime_totals"],
    "attr_upsert": """SELECT {VIN} AS vin, event_type AS attribute_type, arg_max(value, event_id) AS attribute_value, max(event_id) AS version
FROM events GROUP BY ALL""".replace("{VIN}", "concat('VIN', lpad(cast(user_id as varchar),5,'0'))"),
    "economy_ranking_null_grade": f"""{COST_CTE},
ng AS (SELECT * REPLACE (CASE WHEN gas_id % 4 <> 0 THEN fill_grade END AS fill_grade) FROM cost)
SELECT vin, gas_id, fill_grade, fill_date, data_value AS cost_per_km, rank() OVER (PARTITION BY fill_grade ORDER BY data_value) AS rank
FROM ng WHERE data_value IS NOT NULL""",
    "refuel_events_nulls": SQL["refuel_events"],
    "refuel_events_stream": SQL["refuel_events"],
    "low_fuel_windows_stream": SQL["low_fuel_windows"],
    "read_runs": SQL["read_range"],
    "read_runs_keys": f"""SELECT * FROM ({SQL["read_range"]}) WHERE vin >= 'VIN00020' AND vin < 'VIN00060'""",
    "log_stream": """SELECT cast(right(vin, 5) AS int) % 4 AS "partition",
  row_number() OVER (PARTITION BY cast(right(vin, 5) AS int) % 4 ORDER BY ts, vin) - 1 AS "offset", vin, ts, stype, value
FROM signals WHERE stype = 'fuelLevel'""",
    "refuel_events_timed": SQL["refuel_events"],
    "refuel_events_timed_steps": SQL["refuel_events_steps"].replace(" WHERE rn < cnt", ""),  # time closes the newest step too
    "low_fuel_panes": _window_sql(360, 1, 60) + """
SELECT vin, window_start, window_start + INTERVAL 6 HOUR AS window_end, avg(value) AS avg_level
FROM lw GROUP BY vin, window_start HAVING avg(value) < 20""",
    "low_fuel_panes_stream": SQL["low_fuel_windows"],
    "fuel_summary_stream": SQL["fuel_summary"],
    "detector_refuel_alerts": _refuel(False, "FROM signals s SEMI JOIN (SELECT vin, ts FROM ev WHERE et <> 'click') k ON s.vin = k.vin AND s.ts = k.ts")
    .replace(", cast(0 AS double) AS gps_latitude, cast(0 AS double) AS gps_longitude", "")
    .replace(",\n       cast(0 AS double) AS gps_latitude, cast(0 AS double) AS gps_longitude", ""),
    "low_fuel_windows_short": _window_sql(30, 10, 1) + """
SELECT vin, window_start, window_start + INTERVAL 30 SECOND AS window_end, avg(value) AS avg_level
FROM lw GROUP BY vin, window_start HAVING avg(value) < 20""",
    "fuel_summary_short": SQL["fuel_summary"].replace("date_trunc('day', ts)", "time_bucket(INTERVAL 5 SECOND, ts)").replace("INTERVAL 1 DAY", "INTERVAL 5 SECOND"),
    "low_fuel_alert_payload": _window_sql(6, 2) + """
SELECT window_start, 'lowFuel' AS msg_type, vin, 'currentFuel' AS para_type, avg(value) AS para_value
FROM lw GROUP BY vin, window_start HAVING avg(value) < 20""",
}

_SENT = "signals s SEMI JOIN (SELECT vin, ts FROM ev WHERE et <> 'click') k ON s.vin = k.vin AND s.ts = k.ts"
SQL["detectors_one_scan"] = (
    _refuel(False, f"FROM {_SENT}").rsplit("\nSELECT vin, l3", 1)[0] + ",\n"
    + _window_sql(6, 2).replace("lv AS", "wv AS").replace("FROM lv,", "FROM wv,").replace("FROM signals WHERE", f"FROM {_SENT} WHERE") + """
SELECT vin, 'refuel' AS kind, f_t AS start_ts, l_t AS end_ts, l3 AS value FROM st WHERE ev
UNION ALL SELECT vin, 'low_fuel', window_start, window_start + INTERVAL 6 HOUR, avg(value) FROM lw GROUP BY vin, window_start HAVING avg(value) < 20""")
SQL["after_checkpoint_zoned"] = SQL["after_checkpoint"]
SQL["km_commit_job"] = SQL["km_job_rerun"]

#: On the dense table levels may be null: the walk and the last level of a step leave those out.
DENSE_BODY = {
    "refuel_events": _refuel(False).replace("stype = 'fuelLevel'", "stype = 'fuelLevel' AND value IS NOT NULL"),
    "refuel_events_steps": _refuel(True).replace("stype = 'fuelLevel'", "stype = 'fuelLevel' AND value IS NOT NULL"),
}

RECURSIVE = {"refuel_events", "refuel_events_steps", "refuel_events_nulls", "refuel_events_stream", "refuel_events_timed", "refuel_events_timed_steps",
             "detectors_one_scan", "detector_refuel_alerts"}


def oracle_sql() -> dict[str, str]:
    out = {name: with_fixtures(body, name in RECURSIVE) for name, body in SQL.items()}
    for name, body in SQL.items():
        dense = DENSE_BODY.get(name, body)
        out[f"{name}_dense"] = with_fixtures(dense, name in RECURSIVE, dense=True)
    return out
